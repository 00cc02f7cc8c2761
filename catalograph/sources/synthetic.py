"""Synthetic policyholder, policy and claim tables of any size, and a wide catalog.

Every value is a hash of the row id and a seed, so the rows do not depend on
how Spark partitions the range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rates and code lists of the generated tables.
NULL_RATE, ORPHAN_RATE, DUPLICATE_RATE = 0.07, 0.02, 0.01
PRODUCT_CODES = ("PERSONAL_AUTO", "HOMEOWNERS", "RENTERS", "CONDO", "UMBRELLA",
                 "MOTORCYCLE", "BOAT", "RV", "FLOOD", "EARTHQUAKE")
POLICY_STATUSES = ("ACTIVE", "CANCELLED", "EXPIRED", "PENDING", "SUSPENDED", "LAPSED")
PARTY_TYPES = ("PERSON", "ORGANIZATION", "TRUST")
CLAIM_STATUSES = ("OPEN", "CLOSED", "PENDING_REVIEW", "DENIED", "SETTLED", "INVESTIGATION")
CONTACT_CHANNELS = ("EMAIL", "PHONE", "MAIL", "PORTAL", "IN_PERSON", "AGENT")
TERM_DAYS = (180, 365, 365, 365, 365, 730)


def _draw(name: str, seed: int) -> Column:
    """Uniform [0,1) from the row id, the column name and the seed."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(name), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def _pick(values: tuple, name: str, seed: int) -> Column:
    index = F.floor(_draw(name, seed) * len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 6, "0"))


def synthetic_tables(spark: SparkSession, rows: int = 50_000, seed: int = 42,
                     as_of: str = "2026-07-13") -> dict[str, DataFrame]:
    """Three linked tables with nulls, orphaned references and duplicate ids."""
    base = spark.range(1, rows + 1)
    updated = F.lit(f"{as_of} 00:00:00").cast("timestamp").alias("source_updated_ts")
    duplicate = F.col("id") <= F.lit(int(rows * DUPLICATE_RATE))
    own_id = F.when(duplicate, F.floor((F.col("id") + 1) / 2) * 2 - 1).otherwise(F.col("id"))
    party_type = F.when(_draw("pt_null", seed) > NULL_RATE, _pick(PARTY_TYPES, "pt", seed))
    holder = base.select(
        _numbered("PTY-", F.col("id")).alias("party_id"), party_type.alias("party_type"),
        F.when(party_type == "ORGANIZATION", F.concat(F.lit("Sample Organization "), F.col("id").cast("string")))
        .when(_draw("nm_null", seed) > NULL_RATE, F.concat(F.lit("Sample Person "), F.col("id").cast("string")))
        .alias("display_name"),
        F.when(_draw("ch_null", seed) > NULL_RATE, _pick(CONTACT_CHANNELS, "ch", seed)).alias("contact_channel"),
        updated)
    start = F.date_sub(F.lit(as_of).cast("date"), F.floor(_draw("eff", seed) * 1096).cast("int"))
    policy = base.select(
        _numbered("POL-", own_id).alias("policy_id"),
        F.concat_ws("-", _pick(PRODUCT_CODES, "pn", seed), F.lit(as_of[:4]),
                    F.lpad(F.col("id").cast("string"), 6, "0")).alias("policy_number"),
        _pick(POLICY_STATUSES, "ps", seed).alias("policy_status"),
        start.alias("effective_date"),
        F.date_add(start, _pick(TERM_DAYS, "term", seed)).alias("expiration_date"),
        _pick(PRODUCT_CODES, "pc", seed).alias("product_code"),
        F.when(_draw("orph", seed) < ORPHAN_RATE, F.lit("PTY-999999"))
        .otherwise(_numbered("PTY-", F.col("id"))).alias("insured_party_id"),
        updated)
    claim = base.select(
        _numbered("CLM-", own_id).alias("claim_id"),
        F.when(_draw("corph", seed) < ORPHAN_RATE, F.lit("POL-999999"))
        .otherwise(_numbered("POL-", own_id)).alias("policy_id"),
        F.date_sub(F.lit(as_of).cast("date"), F.floor(_draw("loss", seed) * 366).cast("int")).alias("loss_date"),
        _pick(CLAIM_STATUSES, "cs", seed).alias("claim_status"),
        F.when(_draw("am_null", seed) > NULL_RATE / 2,
               F.round(_draw("am", seed) * 999999.98 + 0.01, 2).cast("decimal(12,2)")).alias("claimed_amount"),
        updated)
    return {"policyholder": holder, "policy": policy, "claim": claim}


def wide_catalog(spark: SparkSession, tables: int, columns_per_table: int = 20, seed: int = 42) -> DataFrame:
    """An attribute inventory of ``tables * columns_per_table`` rows for load tests."""
    stems = ("policy", "claim", "party", "product", "coverage", "premium", "account", "invoice")
    tails = ("number", "status", "date", "amount", "code", "type", "limit", "text")
    table_no = F.floor((F.col("id") - 1) / columns_per_table)
    ordinal = (F.pmod(F.col("id") - 1, F.lit(columns_per_table)) + 1).cast("int")
    entity = F.concat(F.lit("entity"), table_no.cast("string"))
    other = F.pmod(table_no + 1 + F.floor(_draw("link", seed) * (tables - 1)), F.lit(tables))
    linked = F.concat(F.lit("entity"), other.cast("string"))
    name = (F.when(ordinal == 1, F.concat(entity, F.lit("_id")))
            .when(ordinal == 2, F.concat(linked, F.lit("_id")))
            .otherwise(F.concat_ws("_", _pick(stems, "stem", seed), _pick(tails, "tail", seed),
                                   ordinal.cast("string"))))
    return spark.range(1, tables * columns_per_table + 1).select(
        F.concat(F.lit("stg_"), entity).alias("source_table"), name.alias("source_column"),
        ordinal.alias("ordinal_position"),
        F.when(ordinal <= 2, "LongType()").otherwise(_pick(("StringType()", "DateType()", "DoubleType()"), "ty", seed))
        .alias("physical_type"),
        (ordinal > 2).alias("nullable"))

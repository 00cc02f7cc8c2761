"""Column names to business meaning, by versioned token rules and concepts.

Work is done once per distinct name. Segmentation and hypothesis expansion are
row expressions; concept matching is an inverted-index join on words, so its
cost follows the number of shared words and not names x concepts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.functions.skew import spread
from catalograph.functions.text import name_parts, naming_convention, title_case
from catalograph.operators.asof import asof_join
from catalograph.sources.packs import token_options, token_pattern

LIMIT_STATUS = "TOKEN_HYPOTHESIS_LIMIT"


def name_segments(names: DataFrame, pack: dict, column: str = "source_column") -> DataFrame:
    """Add ``segments``: tokens of the name with every expansion each may have.

    A part without separators is cut greedily, longest token first; if that
    does not consume the whole part, the part stays as one unknown token.
    """
    pattern, options = F.lit(token_pattern(pack)), token_options(pack)

    def cut(part: Column) -> Column:
        upper = F.upper(part)
        tokens = F.regexp_extract_all(upper, pattern)
        return F.when(F.array_join(tokens, "") == upper, tokens).otherwise(F.array(upper))

    def with_options(part: Column) -> Column:
        unknown = F.array(F.struct(F.lower(part).alias("expansion"),
                                   F.lit(None).cast("string").alias("rule_id")))
        return F.transform(cut(part), lambda token: F.struct(
            token.alias("token"), F.coalesce(F.try_element_at(options, token), unknown).alias("options")))

    return names.withColumn("segments", F.flatten(F.transform(name_parts(F.col(column)), with_options)))


def dictionary_segments(parts: DataFrame, tokens: DataFrame) -> DataFrame:
    """part, tokens: each distinct ``part`` cut by a token table (token, upper case) of any size.

    Every piece of a part looks itself up among the tokens, by an equi-join; the
    longest token at each place is kept, and the part is walked from its
    start. A part that this does not consume stays whole, as in ``name_segments``.
    """
    distinct = parts.select(F.upper("part").alias("part")).distinct().where("part <> ''")
    known = tokens.select(F.upper("token").alias("token")).distinct().where("token <> ''")
    longest = known.agg(F.max(F.length("token"))).first()[0] or 0
    size = F.length("part")
    pieces = distinct.select("part", F.explode(F.sequence(F.lit(1), size)).alias("at")).select(
        "part", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(max(longest, 1)), size - F.col("at") + 1))).alias("length"))
    found = (pieces.withColumn("token", F.expr("substring(part, at, length)")).join(known, "token")
             .groupBy("part", "at").agg(F.max("length").alias("length")))
    ways = found.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("at", "length"))).alias("ways"))
    none = F.array().cast("array<string>")

    def step(state: Column, at: Column) -> Column:
        length = F.try_element_at("ways", at)
        taken = (state["next"] == at) & length.isNotNull()
        return F.struct(F.when(taken, at + length).otherwise(state["next"]).alias("next"),
                        F.when(taken, F.concat(state["tokens"], F.array(F.expr("part").substr(at, length)))).otherwise(state["tokens"]).alias("tokens"))

    walked = F.aggregate(F.sequence(F.lit(1), size), F.struct(F.lit(1).alias("next"), none.alias("tokens")), step)
    return (distinct.join(ways, "part", "left").withColumn("walk", F.when(F.col("ways").isNotNull(), walked))
            .select("part", F.when(F.col("walk.next") == size + 1, F.col("walk.tokens")).otherwise(F.array("part")).alias("tokens")))


def name_tokens(names: DataFrame, tokens: DataFrame, column: str = "source_column") -> DataFrame:
    """``column`` and the tokens of each distinct name, its parts cut by ``dictionary_segments``."""
    parts = names.select(column).distinct().select(column, F.posexplode(name_parts(F.col(column))).alias("place", "raw")).withColumn(
        "part", F.upper("raw"))
    cut = dictionary_segments(parts, tokens)
    return parts.join(cut, "part").groupBy(column).agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "tokens"))), lambda p: p["tokens"])).alias("tokens"))


def name_hypotheses(names: DataFrame, pack: dict, column: str = "source_column") -> DataFrame:
    """Add the naming convention and every expansion of the name, in rule order.

    The last token varies fastest. A name with more than ``max_hypotheses``
    readings is not guessed: it keeps its own text as its only one, and
    ``name_status`` says so.
    """
    segmented = name_segments(names, pack, column)
    count = F.aggregate("segments", F.lit(1.0), lambda n, s: n * F.size(s["options"]))
    over = count > pack["max_hypotheses"]
    start = F.array(F.struct(F.lit("").alias("expanded"), F.lit("").alias("rules")))

    def extend(found: Column, segment: Column) -> Column:
        return F.flatten(F.transform(found, lambda h: F.transform(segment["options"], lambda o: F.struct(
            F.concat_ws(" ", F.nullif(h["expanded"], F.lit("")), o["expansion"]).alias("expanded"),
            F.concat_ws(",", F.nullif(h["rules"], F.lit("")), o["rule_id"]).alias("rules")))))

    return (
        segmented.withColumn("over_limit", over)
        .withColumns({
            "naming_convention": naming_convention(F.col(column)),
            "hypotheses": F.when(F.col("over_limit"), F.array(F.struct(
                F.lower(F.col(column)).alias("expanded"), F.lit("").alias("rules"))))
            .otherwise(F.aggregate("segments", start, extend)),
            "ambiguous_tokens": F.array_sort(F.array_distinct(F.transform(
                F.filter("segments", lambda s: F.size(s["options"]) > 1), lambda s: s["token"]))),
            "name_status": F.when(F.col("over_limit"), LIMIT_STATUS).otherwise("OK"),
        })
        .drop("segments", "over_limit")
    )


def variant_index(concepts: DataFrame) -> DataFrame:
    """Lower-case physical variant -> sorted concepts that declare it."""
    return (concepts.select("concept_id", F.explode("physical_name_variants").alias("v"))
            .groupBy(F.lower("v").alias("variant"))
            .agg(F.array_sort(F.collect_set("concept_id")).alias("variant_concepts")))


def concept_names(concepts: DataFrame) -> DataFrame:
    """Per concept its lower-case name and synonyms."""
    lowered = F.transform(F.concat(F.array("name"), F.coalesce("synonyms", F.array())), lambda n: F.lower(n))
    return concepts.select("concept_id", F.array_distinct(lowered).alias("names"))


def concept_words(concepts: DataFrame) -> DataFrame:
    """Inverted index: word -> concept, words of names and synonyms."""
    words = F.flatten(F.transform("names", lambda n: F.split(n, r"\s+")))
    return (concept_names(concepts).select("concept_id", F.explode(F.array_distinct(words)).alias("word"))
            .where(F.col("word") != ""))


def concept_matches(expansions: DataFrame, concepts: DataFrame, strengths: dict) -> DataFrame:
    """(expanded, concept_id, strength, kind) for distinct ``expanded`` texts.

    expanded_exact: equals a name or synonym; expanded_partial: all words occur
    in the concept; token_overlap: more than half do. One kind per concept.
    """
    words = F.array_distinct(F.filter(F.split("expanded", " "), lambda w: w != ""))
    exploded = (expansions.select("expanded").distinct()
                .select("expanded", F.size(words).alias("words"), F.explode(words).alias("word")))
    shared = (exploded.join(concept_words(concepts), "word")
              .groupBy("expanded", "words", "concept_id").agg(F.count(F.lit(1)).alias("shared")))
    ratio = F.col("shared") / F.col("words")
    kind = (F.when(F.array_contains("names", F.col("expanded")), "expanded_exact")
            .when(F.col("shared") == F.col("words"), "expanded_partial")
            .when(ratio > 0.5, "token_overlap"))
    strength = F.create_map(*[F.lit(v) for k in ("expanded_exact", "expanded_partial", "token_overlap")
                              for v in (k, strengths[k])])
    return (shared.join(concept_names(concepts), "concept_id")
            .withColumn("kind", kind).where(F.col("kind").isNotNull())
            .select("expanded", "concept_id", strength[F.col("kind")].alias("strength"), "kind"))


def classify_names(names: DataFrame, concepts: DataFrame, pack: dict, column: str = "source_column",
                   store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Resolve each distinct name to one concept, or leave it to a steward.

    Order: exact physical variant, ambiguous token, unique strongest match, tie,
    fallback. ``names`` must be unique per ``column``; how ``concepts`` are joined
    is left to their real size. The hypotheses are read
    three times below; ``store(frame, name)`` may write them once and return
    the written relation.
    """
    strengths = pack["strengths"]
    version = f"via {pack['pack_id']} v{pack['pack_version']}"
    hyps = name_hypotheses(spread(names, column), pack, column)
    if store is not None:
        hyps = store(hyps, "name_hypotheses")
    exploded = hyps.select(column, F.explode("hypotheses.expanded").alias("expanded"))
    per_text = (concept_matches(exploded, concepts, strengths).groupBy("expanded")
                .agg(F.collect_list(F.struct("strength", "concept_id", "kind")).alias("found")))
    per_name = (exploded.join(per_text, "expanded").groupBy(column)
                .agg(F.flatten(F.collect_list("found")).alias("found")))
    index = variant_index(concepts)
    facts = concepts.select(
        F.col("concept_id").alias("ontology_concept_id"), F.col("name").alias("concept_name"),
        F.col("concept_type").alias("ontology_concept_type"), F.col("domain").alias("concept_domain"))

    joined = (hyps.join(per_name, column, "left")
              .join(index, F.lower(F.col(column)) == F.col("variant"), "left").drop("variant"))
    none = F.array().cast("array<struct<strength:double,concept_id:string,kind:string>>")
    found = F.coalesce("found", none)
    top = F.col("top_strength")
    expanded = F.col("hypotheses.expanded")
    case_text = title_case(F.get(expanded, F.lit(0)))
    prepared = joined.withColumn(
        "top_strength", F.array_max(F.transform(found, lambda m: m["strength"]))).withColumns({
        "candidates": F.array_sort(F.array_distinct(F.transform(found, lambda m: m["concept_id"]))),
        "tops": F.array_sort(F.array_distinct(F.transform(
            F.filter(found, lambda m: m["strength"] == top), lambda m: m["concept_id"]))),
        "top_kind": F.get(F.filter(found, lambda m: m["strength"] == top), F.lit(0))["kind"],
        "proposed": case_text,
        "ambiguous": F.size("ambiguous_tokens") > 0,
        "rule_ids": F.array_sort(F.array_distinct(F.filter(
            F.split(F.array_join("hypotheses.rules", ","), ","), lambda r: r != ""))),
        "variants": F.coalesce(F.size("variant_concepts"), F.lit(0)),
    })
    outcome = (
        F.when(F.col("name_status") != "OK", "limit")
        .when(F.col("variants") == 1, "variant_exact")
        .when(F.col("variants") > 1, "variant_conflict")
        .when(F.col("ambiguous"), "ambiguous_token")
        .when(F.size("tops") == 1, F.col("top_kind"))
        .when(F.size("tops") > 1, "tie")
        .otherwise("fallback")
    )
    resolved = prepared.withColumn("naming_outcome", outcome)
    is_match = F.col("naming_outcome").isin("variant_exact", "expanded_exact", "expanded_partial", "token_overlap")
    resolved = resolved.withColumn(
        "ontology_concept_id",
        F.when(F.col("naming_outcome") == "variant_exact", F.get("variant_concepts", F.lit(0)))
        .when(is_match, F.get("tops", F.lit(0))),
    ).join(facts, "ontology_concept_id", "left")

    raw = F.col(column)
    o = F.col("naming_outcome")
    title_or_raw = F.coalesce(F.nullif(F.col("proposed"), F.lit("")), raw)
    no_rules = F.size("rule_ids") == 0
    contradictions = (
        F.when(o == "limit", F.concat(F.col("name_status"), F.lit(
            f": more than {pack['max_hypotheses']} governed readings.")))
        .when(o == "variant_conflict", F.concat(
            F.lit("The physical name '"), raw, F.lit("' belongs to several concepts: "),
            F.array_join("variant_concepts", ", "), F.lit(".")))
        .when(o == "ambiguous_token", F.concat(
            F.lit("Tokens with several readings: "), F.array_join("ambiguous_tokens", ", "),
            F.lit("; readings: "), F.array_join(F.array_sort(F.array_distinct(expanded)), ", "),
            F.lit("; concepts to choose from: "),
            F.when(F.size("candidates") > 0, F.array_join("candidates", ", ")).otherwise("none"), F.lit(".")))
        .when(o == "tie", F.concat(F.lit("Concepts that match equally well: "),
                                   F.array_join("tops", ", "), F.lit(".")))
    )
    reason = (
        F.when(is_match, F.concat(F.lit("Matched by rules ("), o, F.lit(f") {version}")))
        .when(o == "limit", "The name has too many governed readings to choose from; a steward decides.")
        .when(o == "variant_conflict", "More than one concept lists this physical name.")
        .when(o == "ambiguous_token", "A token can be read in several ways; choose a listed concept or ask a steward.")
        .when(o == "tie", "Several concepts match equally well; a steward chooses.")
        .otherwise("No rule matched; the spelled-out name is all there is for the steward.")
    )
    nobody = F.array().cast("array<string>")
    return resolved.select(
        column, "naming_convention", "name_status", "hypotheses", "rule_ids", "naming_outcome",
        F.when(o == "token_overlap", F.col("proposed"))
        .when(is_match, F.col("concept_name"))
        .when(o.isin("variant_conflict", "ambiguous_token", "limit"), raw)
        .when((o == "fallback") & (F.col("naming_convention") == "AS400_ABBREVIATED") & no_rules, raw)
        .otherwise(title_or_raw).alias("proposed_business_name"),
        "ontology_concept_id", "ontology_concept_type",
        F.coalesce("concept_domain", F.lit("Shared")).alias("domain"),
        F.when(o == "variant_exact", F.lit(strengths["variant_exact"]))
        .when(is_match, F.col("top_strength"))
        .otherwise(F.lit(pack["fallback_strength"])).alias("naming_strength"),
        reason.alias("naming_reason"), contradictions.alias("naming_contradictions"),
        contradictions.isNotNull().alias("naming_contradicted"),
        F.when(is_match, F.array("ontology_concept_id")).when(o == "variant_conflict", F.col("variant_concepts"))
        .when(o == "ambiguous_token", F.col("candidates")).when(o == "tie", F.col("tops"))
        .otherwise(nobody).alias("semantic_candidates"),
    )


def resolve_packs(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Pick one pack per (capability, source_system, naming_convention, as_of).

    Exact source system, then exact convention, then priority, then the newest
    effective date up to ``as_of``. Without an applicable pack the status is
    NO_PACK, with several equal ones AMBIGUOUS.

    Packs meet the distinct (capability, system, convention) by equi-joins on
    their lists' entries. The best offer so far is a running maximum over each
    combination's dates, and requests take it by an as-of join; a request without a
    date takes the last one.
    """
    names = ["capability", "source_system", "naming_convention"]
    asked = requests.select(*names, F.to_date("as_of").alias("as_of")).distinct()
    combos = asked.select(*names).distinct()
    packs = registry.select(
        "capability", "pack_id", "pack_version", "priority", F.to_date("effective_date").alias("effective_date"),
        F.explode(F.array_distinct(F.transform("source_systems", lambda s: F.lower(s)))).alias("system"),
        F.array_distinct(F.transform("naming_conventions", lambda s: F.lower(s))).alias("conventions"))
    # a request without a convention takes any pack of its system
    packs = packs.select("*", F.explode(F.concat("conventions", F.array(F.lit(None).cast("string")))).alias("convention")).drop("conventions")
    wanted = combos.select(
        *names, F.explode(F.array_distinct(F.array(F.lower("source_system"), F.lit("*")))).alias("system"),
        F.when(F.col("naming_convention").isNull(), F.array(F.lit(None).cast("string"))).otherwise(
            F.array_distinct(F.array(F.lower("naming_convention"), F.lit("*")))).alias("conventions"))
    wanted = wanted.select(*names, "system", F.explode("conventions").alias("convention"))
    meets = ((wanted["capability"] == packs["capability"]) & (wanted["system"] == packs["system"])
             & wanted["convention"].eqNullSafe(packs["convention"]))
    system, convention = F.lower(wanted["source_system"]), F.lower(wanted["naming_convention"])
    score = F.struct(((packs["system"] == system) & (system != "*")).cast("int").alias("s"),
                     F.coalesce(packs["convention"] == convention, F.lit(False)).cast("int").alias("c"),
                     F.col("priority").alias("p"), F.col("effective_date").alias("d"))
    offers = wanted.join(packs, meets).select(*[wanted[c] for c in names], "pack_id", "pack_version", "effective_date", score.alias("score"))
    # a pack can meet a request by several entries: its best one counts
    offers = offers.groupBy(*names, "pack_id", "pack_version", "effective_date").agg(F.max("score").alias("score"))
    equal = offers.groupBy(*names, "effective_date", "score").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("pack_id", "pack_version")).alias("first"),
        F.array_join(F.array_sort(F.collect_list("pack_id")), ",").alias("tied"))
    top = equal.groupBy(*names, "effective_date").agg(F.max(F.struct("score", "n", "first", "tied")).alias("best"))
    running = Window.partitionBy(*names).orderBy("effective_date").rowsBetween(Window.unboundedPreceding, 0)
    steps = top.withColumn("best", F.max("best").over(running))
    dated = asof_join(asked.where("as_of IS NOT NULL"), steps, names, "as_of", "effective_date", ["best"])
    last = steps.groupBy(*names).agg(F.max_by("best", "effective_date").alias("best"))
    undated = asked.where("as_of IS NULL").alias("a").join(last.alias("l"), [F.col(f"a.{c}").eqNullSafe(F.col(f"l.{c}")) for c in names], "left")
    found = dated.select(*names, "as_of", "best").unionByName(undated.select(*[f"a.{c}" for c in names], "a.as_of", "l.best"))
    unique, several = F.col("best.n") == 1, F.col("best.n") > 1
    return found.select(
        *names, "as_of", F.when(F.col("best").isNull(), "NO_PACK").when(unique, "RESOLVED").otherwise("AMBIGUOUS").alias("status"),
        F.when(unique, F.col("best.first.pack_id")).alias("pack_id"), F.when(unique, F.col("best.first.pack_version")).alias("pack_version"),
        F.when(several, F.col("best.tied")).alias("tied_packs"))


def provenance_references(pack: dict, rule_ids: Column, source_system: str = "*",
                          convention: Column | None = None, as_of: str | None = None) -> Column:
    """Sorted distinct evidence references of the applied rules of one pack."""
    def safe(value: Column) -> Column:
        return F.regexp_replace(F.coalesce(F.nullif(value, F.lit("")), F.lit("AUTO")), "[^A-Za-z0-9._*-]", "_")

    stem = f"{pack['pack_id']}:{pack['pack_version']}"
    convention = F.lit(None).cast("string") if convention is None else convention
    selection = F.concat(
        F.lit(f"pack_selection:{stem}:source="), safe(F.lit(source_system)), F.lit(":convention="),
        safe(convention), F.lit(":as_of="), safe(F.lit(as_of).cast("string")))
    rules = F.transform(rule_ids, lambda r: F.concat(F.lit(f"rule:{stem}:"), r))
    return F.array_sort(F.array_distinct(F.concat(rules, F.when(F.size(rule_ids) > 0, F.array(selection))
                                                  .otherwise(F.array().cast("array<string>")))))

"""Versioned rule packs: small JSON rule tables, loaded once and checked for size."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.functions.small import rule_frame, sql_literal


@lru_cache(maxsize=None)
def load_pack(name: str) -> dict:
    """One of the packaged packs: naming, privacy, types or concepts."""
    return json.loads(files("catalograph.packs").joinpath(f"{name}.json").read_text("utf-8"))


def pack_registry(spark: SparkSession, packs: list[dict]) -> DataFrame:
    """Selection metadata of rule packs, one row per pack."""
    return rule_frame(
        spark,
        [{"capability": p["capability"], "pack_id": p["pack_id"], "pack_version": p["pack_version"],
          "source_systems": p.get("source_systems", ["*"]),
          "naming_conventions": p.get("naming_conventions", ["*"]),
          "priority": p.get("priority", 0), "effective_date": p["effective_date"]} for p in packs],
        "capability string, pack_id string, pack_version string, source_systems array<string>, "
        "naming_conventions array<string>, priority int, effective_date string",
    ).withColumn("effective_date", F.to_date("effective_date"))


def active_pack_versions(packs: list[dict], pack_ids: set[str] | None = None) -> dict[str, str]:
    """pack id -> version of the packs a run uses."""
    return {p["pack_id"]: p["pack_version"] for p in packs if pack_ids is None or p["pack_id"] in pack_ids}


def concept_frame(spark: SparkSession, pack: dict) -> DataFrame:
    """Concept rows of an ontology pack, relationships nested."""
    rows = [{**{k: c.get(k) for k in ("concept_id", "name", "domain", "concept_type", "definition",
                                      "lifecycle_state", "privacy_sensitivity", "temporality")},
             "synonyms": c.get("synonyms", []), "physical_name_variants": c.get("physical_name_variants", []),
             "lob_applicability": (c.get("lob_applicability", "ALL")
                                   if isinstance(c.get("lob_applicability", "ALL"), list)
                                   else [c.get("lob_applicability", "ALL")]),
             "relationships": c.get("relationships", [])} for c in pack["concepts"]]
    return rule_frame(
        spark, rows,
        "concept_id string, name string, domain string, concept_type string, definition string, "
        "lifecycle_state string, privacy_sensitivity string, temporality string, "
        "synonyms array<string>, physical_name_variants array<string>, lob_applicability array<string>, "
        "relationships array<struct<type:string,target:string>>")


def token_pattern(pack: dict) -> str:
    """Alternation of all tokens, longest first, for greedy segmentation."""
    tokens = sorted({r["token"].upper() for r in pack["token_rules"]}, key=lambda t: (-len(t), t))
    return "(" + "|".join(map(re.escape, tokens)) + ")"


def token_options(pack: dict) -> Column:
    """Literal map: token -> array of (expansion, rule_id) in rule order."""
    options: dict[str, list[dict]] = {}
    for rule in pack["token_rules"]:
        options.setdefault(rule["token"].upper(), []).append(rule)
    pairs = [
        f"{sql_literal(token)}, array(" + ", ".join(
            f"named_struct('expansion', {sql_literal(r['expansion'])}, 'rule_id', {sql_literal(r['rule_id'])})"
            for r in rules) + ")"
        for token, rules in options.items()]
    return F.expr(f"map({', '.join(pairs)})")

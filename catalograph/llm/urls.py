"""URL filters: pattern rules found through their rarest literal token.

A rule is a pattern in filter-list style: ``||`` anchors at a host or one of its
parent domains, ``|`` at the start or end, ``*`` is any run, ``^`` is a
separator or the end, all else is literal. Every rule is filed under the
literal token that fewest URLs hold; the tokens of a URL fetch candidates, and
only those run their regular expression.

A null or empty URL, or one without ``://``, has an empty host and path and
gets the default verdict. Repeated URLs are judged once and all get the same
row. Equal best rules are settled by the pattern's text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_RULES = 20_000


@dataclass(frozen=True)
class UrlRule:
    """``strength`` orders rules that fit the same URL: the largest wins."""

    pattern: str
    verdict: str
    strength: int
    name: str | None = None


def host_rule(name: str, verdict: str) -> UrlRule:
    """``example.com/en/``: the host and its subdomains, under the path. Longer names are stronger.

    The strengths stand above those of plain patterns.
    """
    return UrlRule(f"||{name}", verdict, 1_000_000 + len(name), name)


def regular_expression(pattern: str) -> str:
    """The pattern as a regular expression on ``host + path`` lines, see ``subject``."""
    out, rest = "", pattern
    if rest.startswith("||"):
        out, rest = r"(?:^|^[^/?#]*\.)", rest[2:]
    elif rest.startswith("|"):
        out, rest = "^", rest[1:]
    end = rest.endswith("|")
    for c in rest[:-1] if end else rest:
        out += ".*" if c == "*" else "(?:[^A-Za-z0-9_.%-]|$)" if c == "^" else re.escape(c)
    return out + ("$" if end else "")


def literal_tokens(pattern: str) -> list[str]:
    """Lower-case runs of letters and digits that every match holds as whole tokens."""
    body = pattern.lstrip("|")
    anchored = pattern.startswith("|")
    found = []
    for m in re.finditer("[a-z0-9]+", body.lower()):
        left = m.start() > 0 and body[m.start() - 1] != "*" or m.start() == 0 and anchored
        right = m.end() < len(body) and body[m.end()] != "*"
        if left and right:
            found.append(m[0])
    return sorted(set(found))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def subject_of(url: Column) -> Column:
    """What patterns are held against: the URL without scheme, its host in lower case."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1), F.lit(""))
    return F.concat(host_of(url), rest)


def _rows(spark: SparkSession, rules: list[UrlRule]) -> DataFrame:
    """One row for each rule and literal token; a null token where it has none."""
    rows = [(i, r.pattern, regular_expression(r.pattern), r.verdict, r.strength, r.name, t)
            for i, r in enumerate(rules) for t in literal_tokens(r.pattern) or [None]]
    return spark.createDataFrame(rows, "rule_id long, pattern string, expression string, verdict string, "
                                       "strength long, rule string, token string")


def rule_index(urls: DataFrame, rules: list[UrlRule]) -> DataFrame:
    """Each rule once, under its token that is rarest over all ``urls`` (token ties: by the alphabet).

    ``urls`` has one array column ``tokens``.
    """
    rows = _rows(urls.sparkSession, rules)
    counted = (urls.select(F.explode("tokens").alias("token"))
               .join(_small(rows.where("token IS NOT NULL").select("token").distinct(), rules), "token", "left_semi")
               .groupBy("token").count())
    best = (rows.join(counted, "token", "left")
            .groupBy("rule_id", "pattern", "expression", "verdict", "strength", "rule")
            .agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token")).alias("key")))
    return best.withColumn("token", F.col("key.token")).drop("key")


def _small(frame: DataFrame, rules: list[UrlRule]) -> DataFrame:
    """Broadcast only below ``BROADCAST_RULES`` rules; else the optimizer joins by shuffle."""
    return F.broadcast(frame) if len(rules) <= BROADCAST_RULES else frame


def judge_urls(urls: DataFrame, rules: list[UrlRule], default: str = "allow", url: str = "url") -> DataFrame:
    """``url``, host, path, rule, verdict and pattern of every distinct URL (null among them)."""
    tokens = F.array_distinct(F.filter(F.split(F.lower("subject"), "[^a-z0-9]+"), lambda t: t != ""))
    distinct = (urls.select(F.col(url).cast("string").alias("url")).distinct()
                .withColumn("subject", subject_of(F.col("url"))).withColumn("tokens", tokens))
    index = _small(rule_index(distinct, rules), rules)
    fetched = distinct.where("subject <> ''").select("url", "subject", F.explode(
        F.concat("tokens", F.array(F.lit(None).cast("string")))).alias("__token"))
    fits = (fetched.join(index, F.col("__token").eqNullSafe(F.col("token")))
            .where(F.expr("regexp_like(subject, expression)"))
            .groupBy("url").agg(F.max_by(F.struct("rule", "verdict", "pattern"),
                                         F.struct("strength", "pattern")).alias("best")))
    return (distinct.select("url").join(fits, "url", "left").select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.col("best.pattern").alias("pattern")))


def filter_pages(pages: DataFrame, rules: list[UrlRule], default: str = "allow") -> DataFrame:
    """page_id with the judgement of its URL; one row for each row of ``pages``."""
    judged = judge_urls(pages, rules, default)
    rows = pages.select("page_id", F.col("url").cast("string").alias("__url"))
    return (rows.join(judged, F.col("__url").eqNullSafe(F.col("url")), "left")
            .select("page_id", "host", "path", "rule", "verdict", "pattern"))

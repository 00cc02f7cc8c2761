"""Column-name shape, tokens and number formatting as built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Warehouse-layer prefixes that carry no entity meaning, and the
# last tokens that make a column an identifier.
LAYER_PREFIXES = ("bronze", "raw", "source", "src", "stage", "staging", "stg")
IDENTIFIER_SUFFIXES = ("id", "key")


def break_camel(name: Column) -> Column:
    """``policyStatus`` -> ``policy_Status``."""
    return F.when(name == F.lower(name), name).otherwise(F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2"))


def naming_convention(name: Column) -> Column:
    """Physical shape of a name: snake_case, camelCase or AS400_ABBREVIATED."""
    return (
        F.when(name.rlike(r"[_\-\s]"), "snake_case")
        .when(name.rlike("[a-z0-9][A-Z]"), "camelCase")
        .when((name == F.upper(name)) & (name != F.lower(name))
              & name.rlike(r"^[\p{L}\p{N}]+$"), "AS400_ABBREVIATED")
        .otherwise("snake_case")
    )


def name_parts(name: Column) -> Column:
    """Non-empty parts between ``_``, ``-``, blanks and camel boundaries."""
    return F.filter(F.split(break_camel(name), r"[_\-\s]+"), lambda p: p != "")


def identifier_text(name: Column) -> Column:
    """Lower-case tokens, cut at any non-alphanumeric run or camel boundary, blank-joined.

    Plain snake_case names are told by one match and need no replacement by patterns.
    """
    return (F.when(name.rlike("\\A[a-z0-9]+(?:_[a-z0-9]+)*\\z"), F.replace(name, F.lit("_"), F.lit(" ")))
            .otherwise(F.lower(F.trim(F.regexp_replace(break_camel(name), "[^A-Za-z0-9]+", " ")))))


def identifier_tokens(name: Column) -> Column:
    """The same tokens as an array."""
    return F.filter(F.split(identifier_text(name), " "), lambda t: t != "")


def entity_text(table: Column) -> Column:
    """Blank-joined entity tokens of a table name, leading layer prefixes removed."""
    return F.regexp_replace(identifier_text(table), "^(?:(?:%s)(?: |$))+" % "|".join(LAYER_PREFIXES), "")


def may_identify(name: Column) -> Column:
    """Whether a name holds the letters of an identifier suffix: cheap, and true for every identifier."""
    found = reduce(lambda a, b: a | b, [F.lower(name).contains(s) for s in IDENTIFIER_SUFFIXES])
    return F.coalesce(found, F.lit(False))


def identifier_signature(name: Column) -> Column:
    """Blank-joined last two tokens of an identifier-like name, else null.

    Names that cannot be identifiers are not cut into tokens.
    """
    return F.when(may_identify(name), signature_of(identifier_text(name)))


def signature_of(text: Column) -> Column:
    """The signature of a name whose ``identifier_text`` is at hand."""
    return F.when(F.substring_index(text, " ", -1).isin(*IDENTIFIER_SUFFIXES), F.substring_index(text, " ", -2))


def identifier_lead(name: Column) -> Column:
    """All tokens but the last, blank-joined."""
    return lead_of(identifier_text(name))


def lead_of(text: Column) -> Column:
    """The lead of a name whose ``identifier_text`` is at hand."""
    return text.substr(F.lit(1), F.length(text) - F.length(F.substring_index(text, " ", -1)) - 1)


def title_case(text: Column) -> Column:
    """Capitalize every letter run, including the ones that follow a digit."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"))
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)),
                                             F.lower(F.substring(r, 2, 1 << 30)))), "")


def rate_text(rate: Column) -> Column:
    """A rate in [0,1] at six decimals, printed in its shortest decimal form.

    ``0.07``, ``0.0``, ``1.0``; below 1e-4 scientific, e.g. ``1.2e-05``.
    """
    micros = F.round(rate * 1000000).cast("long")
    fixed = F.regexp_replace(F.format_string("%.6f", F.round(rate, 6)), r"(\.\d+?)0+$", "$1")
    tens, ones = F.floor(micros / 10), micros % 10
    tiny = (
        F.when(micros < 10, F.concat(micros.cast("string"), F.lit("e-06")))
        .when(ones == 0, F.concat(tens.cast("string"), F.lit("e-05")))
        .otherwise(F.concat(tens.cast("string"), F.lit("."), ones.cast("string"), F.lit("e-05")))
    )
    return F.when((micros > 0) & (micros < 100), tiny).otherwise(fixed)


def round_exact(value: Column, digits: int = 4) -> Column:
    """Round a double by its exact binary value, ties to even.

    ``F.round`` rounds the printed decimal half-up, which moves scores such as
    0.73125. Dekker's product gives the error of ``value * 10**digits`` so the
    tie is decided exactly with plain arithmetic.
    """
    scale = float(10 ** digits)
    product = value * scale
    spread = value * 134217729.0
    high = spread - (spread - value)
    error = (high * scale - product) + (value - high) * scale
    base = F.floor(product).cast("double")
    part = product - base
    up = (
        (part > 0.5)
        | ((part == 0.5) & (error > 0))
        | ((part == 0.5) & (error == 0) & (base % 2 == 1))
    )
    return (base + F.when(up, 1.0).otherwise(0.0)) / scale

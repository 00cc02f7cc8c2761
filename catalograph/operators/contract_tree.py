"""Contracts over nested values, compiled into one expression per row.

A tree of nodes mirrors the value: structs have named fields, arrays one node
for every item, maps one for every value. Each node turns into built-in
higher-order functions that list the broken constraints with their paths, so a row
is checked where it stands, without exploding it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a text is read to see whether it has the type that its node asks for.
_READABLE = {"integer": "bigint", "number": "double", "boolean": "boolean", "date": "date", "timestamp": "timestamp"}


@dataclass(frozen=True)
class Node:
    """Constraints of a value; ``readable`` asks a text to be read as integer, number, boolean, date or timestamp."""

    required: bool = True
    enum: tuple = ()
    const: object = None
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None
    readable: str | None = None
    min_items: int | None = None
    max_items: int | None = None
    fields: dict[str, Node] = field(default_factory=dict)
    items: Node | None = None
    values: Node | None = None
    keys: Node | None = None


def _own(node: Node, value: Column) -> list[tuple[str, Column]]:
    """(constraint, condition of a valid value) of the node itself."""
    checks = []
    if node.enum:
        checks.append(("enum", value.isin(*node.enum)))
    if node.const is not None:
        checks.append(("const", value == F.lit(node.const)))
    if node.pattern is not None:
        checks.append(("pattern", value.rlike(node.pattern)))
    if node.readable is not None:
        checks.append(("type", value.try_cast(_READABLE[node.readable]).isNotNull()))
    number = value.try_cast("double") if node.readable is not None else value
    # what cannot be read as a number breaks its type, not its bounds
    if node.minimum is not None:
        checks.append(("minimum", F.coalesce(number >= node.minimum, F.lit(True))))
    if node.maximum is not None:
        checks.append(("maximum", F.coalesce(number <= node.maximum, F.lit(True))))
    if node.min_items is not None:
        checks.append(("minItems", F.size(value) >= node.min_items))
    if node.max_items is not None:
        checks.append(("maxItems", F.size(value) <= node.max_items))
    return checks


def broken(node: Node, value: Column, path: Column) -> Column:
    """``array<struct<path, constraint>>``: what a value breaks, its own constraints first, then those inside it."""
    def finding(where: Column, name: str) -> Column:
        return F.struct(where.alias("path"), F.lit(name).alias("constraint"))

    none = F.array().cast("array<struct<path:string,constraint:string>>")
    parts = [F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), finding(path, name)) for name, ok in _own(node, value)]))
             ] if _own(node, value) else []
    parts += [broken(child, value[name], F.concat(path, F.lit(f".{name}"))) for name, child in node.fields.items()]
    if node.items is not None:
        parts.append(F.flatten(F.transform(value, lambda x, i: broken(
            node.items, x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))))
    for child, side in ((node.keys, "key"), (node.values, "value")):
        if child is not None:
            parts.append(_entries(value, child, side, path))
    inside = F.concat(*parts) if parts else none
    missing = F.array(finding(path, "required")) if node.required else none
    return F.when(value.isNull(), missing).otherwise(inside)


def _entries(value: Column, child: Node, side: str, path: Column) -> Column:
    return F.flatten(F.transform(F.map_entries(value), lambda e: broken(
        child, e[side], F.concat(path, F.lit("{"), e["key"].cast("string"), F.lit("}")))))


def tree_violations(rows: DataFrame, keys: list[str], tree: dict[str, Node]) -> DataFrame:
    """keys, path, constraint: every broken constraint of every row; ``tree`` names the checked columns."""
    found = F.concat(*[broken(node, F.col(name), F.lit(name)) for name, node in tree.items()])
    return rows.select(*keys, F.inline(found))

"""Values of a family are grouped in its own type."""

from __future__ import annotations

from catalograph.operators import inclusion


def _optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_values_are_counted_in_the_type_of_their_family(spark):
    tables = {
        "a": spark.sql("SELECT * FROM VALUES (1, 0.0D, 'x', timestamp_ntz'2024-01-01 00:00:00', 1.50BD, true),"
                       " (2, -0.0D, 'y', NULL, 2.50BD, NULL), (2, double('NaN'), NULL, NULL, 2.50BD, false) AS t(i, f, s, n, d, b)"),
        "b": spark.sql("SELECT * FROM VALUES (2L, float(0.5), repeat('z', 70), timestamp_ntz'2024-01-01 00:00:00', 1.50BD, true),"
                       " (3L, float('NaN'), 'x', NULL, NULL, NULL) AS t(i, f, s, n, d, b)")}
    own = inclusion.comparable_columns(tables, alone=True)
    sets = inclusion.column_sets(tables, own)
    counts = {(r.source_table, r.source_column): r.distinct_count for r in inclusion.distinct_counts(sets, own).collect()}
    assert counts == {("a", "i"): 2, ("a", "f"): 2, ("a", "s"): 2, ("a", "n"): 1, ("a", "d"): 2, ("a", "b"): 2,
                      ("b", "i"): 2, ("b", "f"): 2, ("b", "s"): 2, ("b", "n"): 1, ("b", "d"): 1, ("b", "b"): 1}
    links = {(r.child_table, r.child_column, r.parent_column): r.matched_values for r in inclusion.inclusions(sets, own).collect()}
    assert links == {(t, c, c): 1 for t in "ab" for c in "ifsndb"}
    assert "as string" not in _optimized(inclusion.column_sets({n: df.select("i", "f") for n, df in tables.items()}, [c for c in own if c[1] in "if"])).lower()

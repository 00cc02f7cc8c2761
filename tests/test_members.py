"""Links of all columns as both sides of each key: they span the same pairs as the pair form."""

from checks.base import catalogue
from checks.observed import roles
from checks.rows import dq_type_conflict
from checks.names_and_keys import relationship_candidates
from catalograph.operators import keys as K
from test_scale import _skewed_attributes


def _pairs(members, conflicting=False):
    sides = {"FROM": {}, "TO": {}}
    for r in members.collect():
        sides[r.side].setdefault(r.match_key, []).append(r)
    return sorted((f.source_table, f.source_column, t.source_table, t.source_column)
                  for key, froms in sides["FROM"].items() for f in froms for t in sides["TO"].get(key, [])
                  if f.source_table != t.source_table and (key.startswith("S:") or f.signature != t.signature)
                  and (not conflicting or f.physical_type != t.physical_type))


def _same(rows, hot_rows):
    pairs = K.relationship_candidates(rows).select("from_table", "from_column", "to_table", "to_column", "type_compatible").collect()
    for conflicting in (False, True):
        found = K.relationship_members(rows, conflicting, hot_rows=hot_rows)
        assert _pairs(found, conflicting) == sorted(tuple(p)[:4] for p in pairs if not (conflicting and p.type_compatible))
        linked = {k for p in pairs if not (conflicting and p.type_compatible) for k in ((p[0], p[1]), (p[2], p[3]))}
        assert {(r.source_table, r.source_column) for r in found.collect()} == linked


def test_members_span_all_pairs(spark):
    _same(K.key_roles(_skewed_attributes(spark)), hot_rows=3)


def test_registered_queries_take_every_table(spark, sf_dir):
    _same(roles(spark, sf_dir), hot_rows=100)
    for run in (relationship_candidates, dq_type_conflict):
        tables = {r.source_table.rstrip("0123456789") for r in run(spark, sf_dir).where("side = 'FROM'").collect()}
        assert {"src_cust", "staging_supp"} <= tables
    assert catalogue(spark, sf_dir).where("source_column = 'id' AND source_table LIKE 'src_cust%'").count() == \
        relationship_candidates(spark, sf_dir).where("match_key = 'S:id' AND side = 'FROM'").count()

"""Queries over the given tables, each with the SQL that must give the same rows."""

from checks import evidence, governance, integrity, names_and_keys, rows

MODULES = (rows, evidence, names_and_keys, governance, integrity)

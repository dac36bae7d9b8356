"""Operators bound to the benchmark tables, each with the SQL that must give the same rows."""

from munimetrics.bindings import ingest, modelling, municipal, relational, values  # noqa: F401
from munimetrics.bindings.registry import QUERIES, SQL  # noqa: F401

"""All queries of the engine, by name, and the SQL of those that SQL can repeat."""

from __future__ import annotations

from decisionloom.plans import answering, assembly, chunking, citing, evaluation, lexical, profiling, records, reports, stored, topics, vector, vectors_stored

MODULES = [lexical, vector, chunking, records, assembly, reports, stored, citing, answering, evaluation, profiling, topics, vectors_stored]
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}

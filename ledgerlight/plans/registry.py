"""All queries of the library by name, and the SQL that each one is checked against."""

from __future__ import annotations

from ledgerlight.plans import boards, custom, extraction, forms, gating, matching, registers, views
from ledgerlight.plans.dialect import duck_sql, query

SQL: dict[str, str] = views.SQL | boards.SQL

QUERIES = {name: query(text) for name, text in (SQL | forms.SQL).items()} | custom.QUERIES | matching.QUERIES | extraction.QUERIES | registers.QUERIES | gating.QUERIES
ORACLES = {name: duck_sql(text) for name, text in SQL.items()} | custom.ORACLES | matching.ORACLES | extraction.ORACLES | registers.ORACLES | gating.ORACLES

#: Queries that SQL can't express; tests hold them against golden cases.
WITHOUT_SQL = (set(custom.QUERIES) - set(custom.ORACLES)) | (set(matching.QUERIES) - set(matching.ORACLES))

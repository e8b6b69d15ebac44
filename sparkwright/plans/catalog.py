"""All registered queries and their DuckDB twins, merged from the per-stage modules."""

from __future__ import annotations

from sparkwright.plans import profile_oracle, profile_queries, relate_oracle, relate_queries, model_free_oracle, model_free_queries, explain_oracle, explain_queries, model_oracle, model_queries, source_oracle, source_queries

_MODULES_Q = [profile_queries, relate_queries, model_free_queries, explain_queries, model_queries, source_queries]
_MODULES_SQL = [profile_oracle, relate_oracle, model_free_oracle, explain_oracle, model_oracle, source_oracle]


def all_queries() -> dict:
    out = {}
    for m in _MODULES_Q:
        out.update(m.QUERIES)
    return out


def all_sql() -> dict:
    out = {}
    for m in _MODULES_SQL:
        out.update(m.SQL)
    return out

"""DuckDB twins of the source/sink round trips (computed straight from the tables)."""

from sparkwright.plans.fixtures import LINEITEM_GAPS_SQL
from sparkwright.plans.profile_oracle import SQL as _P
from sparkwright.plans.profile_oracle import _NUM, _fill_sql

SQL = {
    "s1_csv_scan": """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice, o_orderpriority,
        '{"key": "' || o_orderkey || '", "note": "a, ""b""' || chr(10) || o_orderpriority || '"}' AS note FROM orders""",
    "s2_stage_scan": f"WITH {LINEITEM_GAPS_SQL}, f AS ({_fill_sql('lg', _NUM, True)}) SELECT DISTINCT * FROM f",
    "s5_csv_report": f"""SELECT CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS row, *
        FROM ({_P["a7_group_stats"]})""",
    "s4_literal_rows_joined": """SELECT o_orderpriority, l.rank, count(*) AS orders FROM orders
        LEFT JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3)) l(o_orderpriority, rank) USING (o_orderpriority)
        GROUP BY ALL""",
}

"""DuckDB twins of the rank / correlation / chart-table queries."""

from itertools import combinations

from sparkwright.plans.fixtures import CORR_COLUMNS, LINEITEM_CORR_SQL

_PAIRS = list(combinations(range(len(CORR_COLUMNS)), 2))


def _pearson_rows() -> str:
    parts = []
    for i, j in _PAIRS:
        a, b = CORR_COLUMNS[i], CORR_COLUMNS[j]
        both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        parts.append(f"""SELECT '{a}' AS col_a, '{b}' AS col_b, {i} AS ord_a, {j} AS ord_b,
            covar_samp(CASE WHEN {both} THEN {a} END, CASE WHEN {both} THEN {b} END)
            / (stddev_samp(CASE WHEN {both} THEN {a} END) * stddev_samp(CASE WHEN {both} THEN {b} END)) AS value FROM lc""")
    return " UNION ALL ".join(parts)


def _spearman_rows() -> str:
    parts = []
    for i, j in _PAIRS:
        a, b = CORR_COLUMNS[i], CORR_COLUMNS[j]
        parts.append(f"""SELECT '{a}' AS col_a, '{b}' AS col_b, {i} AS ord_a, {j} AS ord_b,
            covar_samp(ra, rb) / (stddev_samp(ra) * stddev_samp(rb)) AS value FROM (
              SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0::DOUBLE AS ra,
                     rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0::DOUBLE AS rb
              FROM lc WHERE {a} IS NOT NULL AND {b} IS NOT NULL)""")
    return " UNION ALL ".join(parts)


_EV = ["event_id", "user_id", "value"]


def _spearman_events() -> str:
    parts = []
    for i, j in combinations(range(3), 2):
        a, b = _EV[i], _EV[j]
        parts.append(f"""SELECT '{a}' AS col_a, '{b}' AS col_b,
            round(covar_samp(ra, rb) / (stddev_samp(ra) * stddev_samp(rb)), 6) AS value FROM (
              SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0::DOUBLE AS ra,
                     rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0::DOUBLE AS rb
              FROM events)""")
    return " UNION ALL ".join(parts)


def _wide_sql() -> str:
    cols = []
    for i in range(30):
        v = f"(l_extendedprice * {(i % 5) - 2} + l_quantity * {i * 37 % 11} + l_discount * {1000 * (i % 3)})"
        cols.append((f"CASE WHEN l_orderkey % {i + 2} = 0 THEN NULL ELSE {v} END" if i % 2 else v) + f"::DOUBLE AS c{i}")
    pairs = " UNION ALL ".join(f"SELECT 'c{i}' AS col_a, 'c{j}' AS col_b, CASE WHEN stddev_samp(c{i}) FILTER (WHERE c{j} IS NOT NULL) > 0 "
                               f"AND stddev_samp(c{j}) FILTER (WHERE c{i} IS NOT NULL) > 0 THEN round(corr(c{i}, c{j}), 6) END AS value FROM w"
                               for i, j in combinations(range(30), 2))
    return f"WITH w AS MATERIALIZED (SELECT {', '.join(cols)} FROM lineitem) {pairs}"


SQL = {
    "a10_pearson_wide": _wide_sql(),
    "a11_spearman_complete": _spearman_events(),
    "r1_average_rank": """SELECT user_id, cnt::DOUBLE AS cnt, cum::DOUBLE AS cum, cum - (cnt - 1) / 2.0::DOUBLE AS rank FROM (
        SELECT user_id, cnt, sum(cnt) OVER (ORDER BY user_id) AS cum FROM (
          SELECT user_id, count(*) AS cnt FROM events WHERE user_id IS NOT NULL GROUP BY 1))""",
    "r1_rank_rows": """SELECT event_id, value, CASE WHEN value IS NULL THEN NULL ELSE
        rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0::DOUBLE END AS value_rank FROM events""",
    "r2_sort_by_abs": f"WITH {LINEITEM_CORR_SQL} SELECT col_a, col_b, round(value, 6) AS value FROM ({_pearson_rows()}) "
                      "ORDER BY abs(value) DESC NULLS LAST, ord_a, ord_b",
    "r3_head_tail": """(SELECT o_orderkey, o_totalprice, 'head' AS "end" FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5)
        UNION ALL (SELECT o_orderkey, o_totalprice, 'tail' FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5)""",
    "a10_pearson": f"WITH {LINEITEM_CORR_SQL} SELECT col_a, col_b, round(value, 6) AS value FROM ({_pearson_rows()})",
    "a10_pearson_square": f"""WITH {LINEITEM_CORR_SQL}, p AS ({_pearson_rows()}),
        names AS (SELECT DISTINCT col_a AS c FROM p UNION SELECT DISTINCT col_b FROM p)
        SELECT col_a, col_b, round(value, 6) AS value FROM p
        UNION ALL SELECT col_b, col_a, round(value, 6) FROM p
        UNION ALL SELECT c, c, 1.0::DOUBLE FROM names""",
    "a11_spearman": f"WITH {LINEITEM_CORR_SQL} SELECT col_a, col_b, round(value, 6) AS value FROM ({_spearman_rows()})",
    "a12_strongest_pair": f"""WITH {LINEITEM_CORR_SQL} SELECT col_a, col_b, round(value, 6) AS value FROM ({_pearson_rows()})
        WHERE abs(value) > 0 ORDER BY abs(value) DESC, ord_a, ord_b LIMIT 1""",
    "a13_corr_difference": f"""WITH {LINEITEM_CORR_SQL}, p AS ({_pearson_rows()}), s AS ({_spearman_rows()})
        SELECT p.col_a || ' vs ' || p.col_b AS pair, round(p.value, 6) AS pearson, round(s.value, 6) AS spearman,
               round(abs(s.value - p.value), 6) AS abs_diff
        FROM p JOIN s ON p.col_a = s.col_a AND p.col_b = s.col_b""",
    "a17_histogram": """WITH v AS (SELECT n_chars::DOUBLE AS v FROM documents WHERE n_chars IS NOT NULL),
        mm AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
        c AS (SELECT least(CASE WHEN hi - lo = 0 THEN 0 ELSE floor((v - lo) / (hi - lo) * 20) END, 19)::INTEGER AS bin,
                     count(*) AS count FROM v, mm GROUP BY 1),
        ids AS (SELECT range::INTEGER AS bin FROM range(20))
        SELECT ids.bin, round(lo + (hi - lo) * ids.bin / 20, 6) AS lower, round(lo + (hi - lo) * (ids.bin + 1) / 20, 6) AS upper,
               coalesce(c.count, 0) AS count
        FROM ids CROSS JOIN mm LEFT JOIN c ON c.bin = ids.bin""",
    "a18_box_table": """WITH b AS (SELECT event_type, value AS v FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL),
        q AS (SELECT event_type, quantile_cont(v, 0.25)::DOUBLE AS q1, quantile_cont(v, 0.5)::DOUBLE AS median,
                     quantile_cont(v, 0.75)::DOUBLE AS q3 FROM b GROUP BY 1)
        SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
               round(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
               round(max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
               CAST(count_if(v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS fliers
        FROM b JOIN q USING (event_type) GROUP BY event_type, q1, median, q3""",
    "a19_ordered_series": """WITH n AS (SELECT count(*) AS n FROM orders),
        p AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders)
        SELECT floor((pos - 1) * 50 / n)::INTEGER AS bucket, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
               round(min(o_totalprice), 6) AS min, round(avg(o_totalprice), 6) AS mean, round(max(o_totalprice), 6) AS max,
               count(*) AS rows
        FROM p, n GROUP BY 1""",
    "a20_density_2d": """WITH b AS (SELECT l_extendedprice AS x, l_quantity AS y FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL),
        mm AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM b)
        SELECT least(CASE WHEN x1 - x0 = 0 THEN 0 ELSE floor((x - x0) / (x1 - x0) * 10) END, 9)::INTEGER AS bin_x,
               least(CASE WHEN y1 - y0 = 0 THEN 0 ELSE floor((y - y0) / (y1 - y0) * 10) END, 9)::INTEGER AS bin_y,
               count(*) AS count FROM b, mm GROUP BY 1, 2""",
}

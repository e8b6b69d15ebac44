"""DuckDB twins of the profile queries (same fixtures, same column names)."""

from sparkwright.plans.fixtures import LINEITEM_DUPS_SQL, LINEITEM_FEATURES_SQL, LINEITEM_GAPS_SQL, LINEITEM_TEXT_SQL

_GAPS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "qty_sparse", "l_returnflag", "l_linestatus"]
_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "qty_sparse"]


def _null_profile_sql(src: str, cols: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {i} AS ordinal, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, count(*) AS n FROM {src}"
        for i, c in enumerate(cols))
    return f"""SELECT column_name, null_count, round(null_count * 100.0::DOUBLE / n, 6) AS null_pct
               FROM ({parts}) ORDER BY null_pct DESC, ordinal"""


def _fill_sql(src: str, cols: list[str], guarded: bool) -> str:
    stats = ", ".join(f"count_if({c} IS NULL) AS nn_{c}, quantile_cont({c}, 0.5) AS med_{c}" for c in cols)
    sel = []
    for c in _GAPS:
        if c in cols:
            fill = f"coalesce({c}, med_{c})"
            if guarded:
                fill = f"CASE WHEN nn_{c} > 0 AND nn_{c} * 100.0::DOUBLE / n < 20 THEN {fill} ELSE {c} END"
            sel.append(f"{fill} AS {c}")
        else:
            sel.append(c)
    return f"SELECT {', '.join(sel)} FROM {src}, (SELECT count(*) AS n, {stats} FROM {src}) s"


SQL = {
    "s3_shape": "SELECT count(*) AS rows, 11 AS columns FROM lineitem",
    "s3_schema": """SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS ordinal, column_name,
        CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
             WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
             WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'timestamp' ELSE lower(column_type) END AS type
        FROM (DESCRIBE lineitem)""",
    "s3_preview": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "q1_null_profile": f"WITH {LINEITEM_GAPS_SQL} " + _null_profile_sql("lg", _GAPS),
    "q2_high_null_columns": f"WITH {LINEITEM_GAPS_SQL}, np AS ({_null_profile_sql('lg', _GAPS)}) "
                            "SELECT column_name, null_pct FROM np WHERE null_pct > 20",
    "p3_summary_filter": f"WITH {LINEITEM_GAPS_SQL}, np AS ({_null_profile_sql('lg', _GAPS)}) "
                         "SELECT column_name, null_pct FROM np WHERE null_pct > 5",
    "q3_conditional_median_fill": f"WITH {LINEITEM_GAPS_SQL} " + _fill_sql("lg", _NUM, True),
    "q4_median_fill_named": f"WITH {LINEITEM_GAPS_SQL} " + _fill_sql("lg", ["qty_sparse", "l_tax"], False),
    "q5_post_fill_nulls": f"WITH {LINEITEM_GAPS_SQL}, f AS ({_fill_sql('lg', ['qty_sparse', 'l_tax'], False)}) "
                          + _null_profile_sql("f", ["qty_sparse", "l_tax"]),
    "q6_duplicate_count": f"""WITH {LINEITEM_DUPS_SQL}, g AS (SELECT count(*) AS c FROM ld GROUP BY l_quantity, l_discount, l_tax, l_returnflag, l_linestatus)
        SELECT CAST(sum(c - 1) AS BIGINT) AS duplicates, CAST(sum(c) AS BIGINT) AS rows, count(*) AS distinct_rows FROM g""",
    "q7_drop_duplicates": f"WITH {LINEITEM_DUPS_SQL} SELECT DISTINCT * FROM ld",
    "q8_null_drift": f"""WITH {LINEITEM_GAPS_SQL}, f AS ({_fill_sql('lg', _NUM, True)}), a AS (SELECT DISTINCT * FROM f),
        b0 AS ({_null_profile_sql('lg', _GAPS)}), a0 AS ({_null_profile_sql('a', _GAPS)})
        SELECT coalesce(b0.column_name, a0.column_name) AS column_name, b0.null_pct AS pct_before, a0.null_pct AS pct_after,
               round(a0.null_pct - b0.null_pct, 6) AS drift
        FROM b0 FULL OUTER JOIN a0 ON b0.column_name = a0.column_name""",
    "q9_coerce_numeric": f"""WITH {LINEITEM_TEXT_SQL}
        SELECT l_orderkey, l_linenumber, qty_text,
               CASE WHEN regexp_matches(qty_text, '{'^\\s*[+-]?((\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\\s*$'}')
                         AND NOT isnan(TRY_CAST(trim(qty_text) AS DOUBLE))
                    THEN TRY_CAST(trim(qty_text) AS DOUBLE) END AS qty
        FROM lt""",
    "q10_category_codes": """WITH dom AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS priority_code
                                  FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL))
        SELECT o_orderpriority, o_orderkey, priority_code FROM orders LEFT JOIN dom USING (o_orderpriority)""",
    "q11_storage_profile": """WITH n AS (SELECT count(*) AS n FROM lineitem),
        r AS (SELECT 'l_returnflag' AS column_name, CAST(sum(octet_length(encode(l_returnflag))) AS BIGINT) AS raw_bytes FROM lineitem
              UNION ALL SELECT 'l_linestatus', CAST(sum(octet_length(encode(l_linestatus))) AS BIGINT) FROM lineitem),
        d AS (SELECT 'l_returnflag' AS column_name, count(*) AS distinct_values, CAST(sum(octet_length(encode(v))) AS BIGINT) AS dvb
              FROM (SELECT DISTINCT l_returnflag AS v FROM lineitem WHERE l_returnflag IS NOT NULL)
              UNION ALL SELECT 'l_linestatus', count(*), CAST(sum(octet_length(encode(v))) AS BIGINT)
              FROM (SELECT DISTINCT l_linestatus AS v FROM lineitem WHERE l_linestatus IS NOT NULL)),
        j AS (SELECT r.column_name, raw_bytes, distinct_values,
                     CAST(CASE WHEN distinct_values <= 256 THEN 1 WHEN distinct_values <= 65536 THEN 2 ELSE 4 END AS INTEGER) AS code_width,
                     dvb FROM r JOIN d USING (column_name))
        SELECT column_name, raw_bytes, distinct_values, code_width, CAST(dvb + n * code_width AS BIGINT) AS dict_bytes,
               CAST(raw_bytes - (dvb + n * code_width) AS BIGINT) AS saved_bytes FROM j, n""",
    "a1_describe": f"WITH {LINEITEM_GAPS_SQL} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
                   round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
                   round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM lg""" for c in _NUM),
    "a2_quantiles": """SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p100, round(quantile_cont(value, 0.25), 6) AS p250,
        round(quantile_cont(value, 0.5), 6) AS p500, round(quantile_cont(value, 0.75), 6) AS p750,
        round(quantile_cont(value, 0.9), 6) AS p900 FROM events GROUP BY event_type""",
    "a3_skewness": f"WITH {LINEITEM_GAPS_SQL} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(skewness({c}), 6) AS skew FROM lg" for c in _NUM),
    "a4_top_skewed": """SELECT column_name, skew FROM (
        SELECT 'event_id' AS column_name, 0 AS o, round(skewness(event_id), 6) AS skew FROM events UNION ALL
        SELECT 'user_id', 1, round(skewness(user_id), 6) FROM events UNION ALL
        SELECT 'value', 2, round(skewness(value), 6) FROM events) ORDER BY abs(skew) DESC NULLS LAST, o LIMIT 2""",
    "a5_iqr_outliers": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(q1, 6) AS Q1, round(q3, 6) AS Q3, round(q3 - q1, 6) AS IQR,
                   round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper,
                   (SELECT count(*) FROM events WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outlier_count
            FROM (SELECT quantile_cont({c}, 0.25)::DOUBLE AS q1, quantile_cont({c}, 0.75)::DOUBLE AS q3 FROM events)"""
        for c in ["value", "user_id"]),
    "a6_group_mean_sorted": "SELECT o_orderpriority, round(avg(o_totalprice), 6) AS mean FROM orders "
                            "WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY mean, o_orderpriority",
    "a7_group_stats": """SELECT o_orderpriority, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std,
        count(o_totalprice) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""",
    "a8_group_argmax": """WITH g AS (SELECT o_orderpriority, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS std
                                     FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1)
        SELECT 'mean' AS metric, arg_min(o_orderpriority, (-mean, o_orderpriority)) AS "group", round(max(mean), 6) AS value FROM g
        UNION ALL
        SELECT 'std', arg_min(o_orderpriority, (-std, o_orderpriority)), round(max(std), 6) FROM g""",
    "a9_spread_ratio": """WITH g AS (SELECT avg(o_totalprice) AS mean FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority)
        SELECT round(max(mean) / min(mean), 6) AS ratio FROM g""",
    "a14_imputation_comparison": f"WITH {LINEITEM_GAPS_SQL}, t AS (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {i} AS o, skewness({c}) AS skew, avg({c}) AS mean, quantile_cont({c}, 0.5)::DOUBLE AS median,
                   CAST(count_if({c} IS NULL) AS BIGINT) AS nulls_before FROM lg""" for i, c in enumerate(_NUM))
        + ") SELECT column_name, round(skew, 6) AS skew, round(mean, 6) AS mean, round(median, 6) AS median, nulls_before "
          "FROM t ORDER BY abs(skew) DESC NULLS LAST, o LIMIT 2",
    "a15_value_counts": "SELECT l_quantity, count(*) AS count FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1",
    "a16_min_max": "SELECT min(l_extendedprice) AS min, max(l_extendedprice) AS max FROM lineitem",
    "a21_percentile_interval": """SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.025), 6) AS ci_low,
        round(quantile_cont(value, 0.975), 6) AS ci_high FROM events GROUP BY 1""",
    "a22_mean_pop_std": """SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(value) AS n
        FROM events GROUP BY 1""",
    "p1_drop_columns": "SELECT * EXCLUDE (o_orderdate, o_orderstatus) FROM orders",
    "p2_numeric_columns": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
    "p4_median_label": f"WITH {LINEITEM_FEATURES_SQL} SELECT row_key, round(net, 6) AS net, label FROM lf",
    "p5_outside_range": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice < 2000.0 OR l_extendedprice > 90000.0",
    "p13_keyed_lookup_default": """SELECT d.doc_id, d.lang, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic
        FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "a6_group_mean_nan": """SELECT event_type, round(avg(value), 6) AS mean FROM events WHERE event_type IS NOT NULL AND event_id % 7 <> 0
        GROUP BY 1 ORDER BY 2, 1""",
    "a15_value_counts_nan": """SELECT floor(value)::DOUBLE AS whole, count(*) AS count FROM events WHERE event_id % 7 <> 0 AND value IS NOT NULL
        GROUP BY 1""",
    "a8_argmax_null_std": """WITH g AS (SELECT CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders) THEN 'alone' ELSE o_orderpriority END AS grp,
                                          o_totalprice AS v FROM orders),
        s AS (SELECT grp, stddev_samp(v) AS std, count(v)::DOUBLE AS count FROM g GROUP BY 1)
        SELECT * FROM (SELECT 'std' AS metric, grp AS "group", round(std, 6) AS value FROM s WHERE std IS NOT NULL ORDER BY std DESC, grp LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'count', grp, count FROM s ORDER BY count DESC, grp LIMIT 1)""",
    "a7_group_stats_domain": """SELECT l.o_orderpriority, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std,
               count(o_totalprice) AS count
        FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW'), ('6-NEVER')) l(o_orderpriority)
        LEFT JOIN orders USING (o_orderpriority) GROUP BY 1""",
    "q10_category_codes_wide": """SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT 'order-' || o_orderkey AS value FROM orders)""",
}

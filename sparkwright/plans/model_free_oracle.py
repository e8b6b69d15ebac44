"""DuckDB twins of the feature-preparation and evaluation queries."""

from sparkwright.functions.hashing import POISSON1_CDF
from sparkwright.plans.fixtures import LINEITEM_FEATURES_SQL, SCORED_SQL

_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "rf_code", "ls_code"]
_U = "(('0x' || substr(md5({k}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
_H60 = "('0x' || substr(md5({k}), 1, 15))::BIGINT"


def _auc_sql(src: str, by: str, weight: str = "1") -> str:
    """AUC per group by rank sum over the (group, score) histogram."""
    return f"""(WITH h AS (SELECT {by}, score, sum({weight})::DOUBLE AS cnt, sum({weight} * label)::DOUBLE AS pos
                         FROM {src} GROUP BY {by}, score HAVING sum({weight}) > 0),
                  r AS (SELECT *, sum(cnt) OVER (PARTITION BY {by} ORDER BY score) - (cnt - 1) / 2.0::DOUBLE AS rank FROM h),
                  a AS (SELECT {by}, sum(pos) AS n1, sum(cnt) AS n, sum(pos * rank) AS srank FROM r GROUP BY {by})
             SELECT {by}, CASE WHEN n1 > 0 AND n - n1 > 0 THEN (srank - n1 * (n1 + 1.0::DOUBLE) / 2.0::DOUBLE) / (n1 * (n - n1)) END AS auc
             FROM a)"""


_POIS = "CASE " + " ".join(f"WHEN u < {c!r}::DOUBLE THEN {k}" for k, c in enumerate(POISSON1_CDF)) + \
        f" ELSE {len(POISSON1_CDF)} END"

# replicate r draws word (r - 1) % 4 of md5(key|(r - 1) // 4|seed)
_DRAW = "(('0x' || substr(md5(p.row_key || '|' || ((r.replicate - 1) // 4) || '|42'), 1 + 8 * ((r.replicate - 1) % 4), 8))::BIGINT / 4294967296.0::DOUBLE)"

_BOOT = SCORED_SQL + f""",
reps AS (SELECT range::INTEGER AS replicate FROM range(1, 501)),
wu AS (SELECT p.model, p.row_key, p.label, p.score, r.replicate,
              {_DRAW} AS u
       FROM pr p CROSS JOIN reps r WHERE p.model IN ('model_a', 'model_b')),
w AS (SELECT *, {_POIS} AS w FROM wu),
wp AS (SELECT * FROM w WHERE w > 0),
aucs AS {_auc_sql('wp', 'replicate, model', 'w')},
boot AS (SELECT replicate, max(CASE WHEN model = 'model_a' THEN auc END) AS auc_a,
                max(CASE WHEN model = 'model_b' THEN auc END) AS auc_b FROM aucs GROUP BY replicate),
diffs AS (SELECT replicate, auc_a, auc_b, auc_a - auc_b AS diff FROM boot WHERE auc_a IS NOT NULL AND auc_b IS NOT NULL),
ci AS (SELECT avg(diff) AS mean, quantile_cont(diff, 0.025) AS ci_low, quantile_cont(diff, 0.975) AS ci_high,
              count(diff) AS replicates FROM diffs)"""

_COUNTS = """SELECT model, CAST(count_if(label = 1 AND pred = 1) AS BIGINT) AS tp, CAST(count_if(label = 0 AND pred = 1) AS BIGINT) AS fp,
                    CAST(count_if(label = 1 AND pred = 0) AS BIGINT) AS fn, CAST(count_if(label = 0 AND pred = 0) AS BIGINT) AS tn
             FROM pr GROUP BY model"""


def _prf(tp, fp, fn):
    p = f"coalesce(CASE WHEN {tp} + {fp} > 0 THEN {tp}::DOUBLE / ({tp} + {fp}) END, 0.0::DOUBLE)"
    r = f"coalesce(CASE WHEN {tp} + {fn} > 0 THEN {tp}::DOUBLE / ({tp} + {fn}) END, 0.0::DOUBLE)"
    f = f"coalesce(CASE WHEN 2 * {tp} + {fp} + {fn} > 0 THEN 2 * {tp}::DOUBLE / (2 * {tp} + {fp} + {fn}) END, 0.0::DOUBLE)"
    return p, r, f


_P1, _R1, _F1 = _prf("tp", "fp", "fn")
_P0, _R0, _F0 = _prf("tn", "fn", "fp")

_SWEEP = SCORED_SQL + ", sw AS (" + " UNION ALL ".join(
    f"""SELECT model, {t}::DOUBLE AS threshold,
          count_if(score >= {t}::DOUBLE AND label = 1) AS tp, count_if(score >= {t}::DOUBLE AND label = 0) AS fp,
          count_if(score < {t}::DOUBLE AND label = 1) AS fn FROM pr GROUP BY model"""
    for t in (0.3, 0.4, 0.5, 0.6, 0.7)) + f"""),
swr AS (SELECT model, threshold, round({_P1}, 4) AS precision, round({_R1}, 4) AS recall, round({_F1}, 4) AS f1 FROM sw)"""

_F7_BASE = f"""WITH li AS (SELECT concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_key, l_quantity,
                                 nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem),
    s AS (SELECT *, {_U.format(k="row_key || '|42'")} < 0.2 AS is_test FROM li),
    m AS (SELECT quantile_cont(l_quantity, 0.5) AS mq, quantile_cont(l_discount, 0.5) AS md, quantile_cont(l_tax, 0.5) AS mt
          FROM s WHERE NOT is_test),
    im AS (SELECT row_key, is_test, coalesce(l_quantity, mq) AS l_quantity, coalesce(l_discount, md) AS l_discount,
                  coalesce(l_tax, mt) AS l_tax FROM s, m),
    st AS (SELECT avg(l_quantity) AS aq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS ad, stddev_pop(l_discount) AS sd,
                  avg(l_tax) AS atx, stddev_pop(l_tax) AS stx FROM im WHERE NOT is_test)"""

# keyed by order: a repeated key's n-th row (by label, score) draws with the key 'key#n'
_BOOT_KEYS = _BOOT.replace("reps AS (", """prn AS (SELECT * REPLACE (split_part(row_key, '|', 1) AS row_key),
    row_number() OVER (PARTITION BY model, split_part(row_key, '|', 1) ORDER BY label, score) AS i FROM pr),
prk AS (SELECT * REPLACE (CASE WHEN i = 1 THEN row_key ELSE row_key || '#' || i END AS row_key) FROM prn),
reps AS (""", 1).replace("range(1, 501)", "range(1, 51)").replace("FROM pr p CROSS JOIN reps", "FROM prk p CROSS JOIN reps")

SQL = {
    "p9_bootstrap_weights": "WITH " + SCORED_SQL + f""",
        reps AS (SELECT range::INTEGER AS replicate FROM range(1, 501)),
        wu AS (SELECT r.replicate, {_U.format(k="p.row_key || '|' || r.replicate || '|42'")} AS u
               FROM pr p CROSS JOIN reps r WHERE p.model = 'model_a'),
        w AS (SELECT replicate, {_POIS} AS weight FROM wu)
        SELECT replicate, count(*) AS drawn_rows, CAST(sum(weight) AS BIGINT) AS total_weight FROM w WHERE weight > 0
        GROUP BY replicate""",
    "p9_gather": f"""WITH {LINEITEM_FEATURES_SQL}, r AS (SELECT row_key, net, row_number() OVER (ORDER BY row_key, l_extendedprice, net) - 1 AS i FROM lf0),
        p AS (SELECT row_key, CAST(floor({_U.format(k="row_key || '|pick|42'")} * ((SELECT count(*) FROM lf0) * 1.01::DOUBLE)) AS BIGINT) AS index FROM lf0)
        SELECT p.row_key, index, r.row_key AS picked_key, round(r.net, 6) AS picked_net FROM p LEFT JOIN r ON r.i = index""",
    "j2_zip_by_position": """WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders),
        b AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position FROM orders)
        SELECT position, a.o_orderkey AS key_by_key, b.o_orderkey AS key_by_price FROM a JOIN b USING (position)""",
    "p7_drop_list_columns": f"WITH {LINEITEM_FEATURES_SQL} SELECT row_key, l_quantity, l_extendedprice, l_discount, rf_code FROM lf",
    "f7_fitted_stages": _F7_BASE + """
        SELECT row_key, round((l_quantity - aq) / CASE WHEN sq > 0 THEN sq ELSE 1.0::DOUBLE END, 6) AS l_quantity,
               round((l_discount - ad) / CASE WHEN sd > 0 THEN sd ELSE 1.0::DOUBLE END, 6) AS l_discount,
               round((l_tax - atx) / CASE WHEN stx > 0 THEN stx ELSE 1.0::DOUBLE END, 6) AS l_tax FROM im, st""",
    "f8_feature_vector": f"""WITH {LINEITEM_FEATURES_SQL} SELECT row_key,
        [l_quantity, l_extendedprice, l_discount, l_tax, rf_code, ls_code]::DOUBLE[] AS features FROM lf""",
    "f1_ordinal_encode": """SELECT o_orderkey, o_orderpriority,
        CAST(coalesce(list_position(['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH'], o_orderpriority), 0) - 1 AS DOUBLE) AS o_orderpriority_ord
        FROM orders""",
    "p10_replace_columns": """SELECT l_orderkey, l_linenumber,
        CAST(coalesce(list_position(['N', 'R', 'A'], l_returnflag), 0) - 1 AS DOUBLE) AS l_returnflag,
        CAST(coalesce(list_position(['O', 'F'], l_linestatus), 0) - 1 AS DOUBLE) AS l_linestatus FROM lineitem""",
    "p11_round_half_even": """SELECT l_orderkey, l_linenumber, l_quantity / 2 AS half, round_even(l_quantity / 2, 0) AS r_even,
        round(l_quantity / 2, 0) AS r_up FROM lineitem""",
    "f2_split": f"SELECT o_orderkey, {_U.format(k="o_orderkey || '|42'")} < 0.2 AS is_test FROM orders",
    "f2_split_exact": f"""WITH h AS (SELECT o_orderkey, {_H60.format(k="o_orderkey || '|42'")} AS h FROM orders),
        r AS (SELECT o_orderkey, rank() OVER (ORDER BY h) + (count(*) OVER (PARTITION BY h) - 1) / 2.0::DOUBLE AS r,
                     count(*) OVER () AS n FROM h)
        SELECT o_orderkey, r <= ceil(n * 0.2::DOUBLE) AS is_test FROM r""",
    "f3_standardize": f"WITH {LINEITEM_FEATURES_SQL}, st AS (SELECT "
                      + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _FEATS)
                      + " FROM lf WHERE NOT is_test) SELECT row_key, "
                      + ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0::DOUBLE ELSE s_{c} END, 6) AS {c}"
                                  for c in _FEATS) + " FROM lf, st",
    "f4_median_imputer": f"""WITH li AS (SELECT concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_key, nullif(l_discount, 0) AS l_discount,
                                         nullif(l_tax, 0) AS l_tax FROM lineitem),
        s AS (SELECT *, {_U.format(k="row_key || '|42'")} < 0.2 AS is_test FROM li),
        m AS (SELECT quantile_cont(l_discount, 0.5) AS md, quantile_cont(l_tax, 0.5) AS mt FROM s WHERE NOT is_test)
        SELECT row_key, coalesce(l_discount, md) AS l_discount, coalesce(l_tax, mt) AS l_tax, is_test FROM s, m""",
    "f5_class_weights": f"""WITH {LINEITEM_FEATURES_SQL}, t AS (SELECT row_key, label FROM lf WHERE NOT is_test),
        c AS (SELECT label, count(*) AS n_k FROM t GROUP BY label),
        w AS (SELECT label, (SELECT sum(n_k) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n_k) AS weight FROM c)
        SELECT label, row_key, weight FROM t JOIN w USING (label)""",
    "f6_stratified_folds": f"""WITH {LINEITEM_FEATURES_SQL}, t AS (SELECT row_key, label, {_H60.format(k="row_key || '|42'")} AS h
                                                             FROM lf WHERE NOT is_test)
        SELECT label, row_key, CAST((row_number() OVER (PARTITION BY label ORDER BY h) - 1) % 5 AS INTEGER) AS fold FROM t""",
    "p8_nested_prefix": f"""WITH {LINEITEM_FEATURES_SQL}, t AS (SELECT row_key, label, {_H60.format(k="row_key || '|42'")} AS h
                                                          FROM lf WHERE NOT is_test),
        r AS (SELECT *, row_number() OVER (ORDER BY h) AS r, count(*) OVER () AS n FROM t)
        SELECT f.fraction, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives
        FROM r, (VALUES (0.2::DOUBLE), (0.4::DOUBLE), (0.6::DOUBLE), (0.8::DOUBLE), (1.0::DOUBLE)) f(fraction)
        WHERE r <= floor(n * f.fraction) GROUP BY f.fraction""",
    "p6_threshold_predicate": f"WITH {SCORED_SQL} SELECT model, row_key, CAST(score >= 0.4::DOUBLE AS INTEGER) AS pred_t040 FROM pr",
    "v1_mse": f"WITH {SCORED_SQL} SELECT model, round(avg((net - pred_net) * (net - pred_net)), 2) AS mse FROM pr GROUP BY model",
    "v2_r2": f"""WITH {SCORED_SQL} SELECT model, round(1 - sum((net - pred_net) * (net - pred_net)) / (count(net) * var_pop(net)), 6) AS r2
        FROM pr GROUP BY model""",
    "v3_confusion_matrix": f"""WITH {SCORED_SQL}, g AS (SELECT DISTINCT model FROM pr),
        cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(label, pred)),
        n AS (SELECT model, label, pred, count(*) AS n FROM pr GROUP BY ALL)
        SELECT g.model, cells.label, cells.pred, coalesce(n.n, 0) AS n FROM g CROSS JOIN cells
        LEFT JOIN n ON n.model = g.model AND n.label = cells.label AND n.pred = cells.pred""",
    "v4_classification_report": f"""WITH {SCORED_SQL}, c AS ({_COUNTS}),
        m AS (SELECT *, {_P1} AS p1, {_R1} AS r1, {_F1} AS f1, {_P0} AS p0, {_R0} AS r0, {_F0} AS f0,
                     tp + fn AS s1, tn + fp AS s0, (tp + tn)::DOUBLE / (tp + tn + fp + fn) AS acc FROM c)
        SELECT model, '0' AS cls, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM m
        UNION ALL SELECT model, '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM m
        UNION ALL SELECT model, 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), s0 + s1 FROM m
        UNION ALL SELECT model, 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), s0 + s1 FROM m
        UNION ALL SELECT model, 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
                         round((f0 * s0 + f1 * s1) / (s0 + s1), 6), s0 + s1 FROM m""",
    "v5_roc_auc": f"WITH {SCORED_SQL} SELECT model, round(auc, 6) AS auc FROM {_auc_sql('pr', 'model')}",
    "v6_roc_curve": f"""WITH {SCORED_SQL}, h AS (SELECT model, score, count(*) AS cnt, sum(label) AS pos FROM pr GROUP BY ALL),
        c AS (SELECT model, score, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
                     sum(cnt - pos) OVER (PARTITION BY model ORDER BY score DESC) AS fp FROM h),
        t AS (SELECT model, sum(label)::DOUBLE AS P, sum(1 - label)::DOUBLE AS N FROM pr GROUP BY model)
        SELECT model, score AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM c JOIN t USING (model)
        UNION ALL SELECT model, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM t""",
    "v6_roc_corners": f"""WITH {SCORED_SQL}, h AS (SELECT model, score, count(*) AS cnt, sum(label) AS pos FROM pr GROUP BY ALL),
        c AS (SELECT model, score, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
                     sum(cnt - pos) OVER (PARTITION BY model ORDER BY score DESC) AS fp FROM h),
        n AS (SELECT *, lag(tp) OVER w AS ptp, lag(fp) OVER w AS pfp, lead(tp) OVER w AS ntp, lead(fp) OVER w AS nfp
              FROM c WINDOW w AS (PARTITION BY model ORDER BY score DESC)),
        k AS (SELECT * FROM n WHERE ptp IS NULL OR ntp IS NULL OR ntp - 2 * tp + ptp <> 0 OR nfp - 2 * fp + pfp <> 0),
        t AS (SELECT model, sum(label)::DOUBLE AS P, sum(1 - label)::DOUBLE AS N FROM pr GROUP BY model)
        SELECT model, score AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM k JOIN t USING (model)
        UNION ALL SELECT model, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM t""",
    "r5_descending_cumulative": f"""WITH {SCORED_SQL}, h AS (SELECT model, score, count(*)::DOUBLE AS n_at_score,
                                                          sum(label)::DOUBLE AS pos_at_score FROM pr GROUP BY ALL)
        SELECT model, score, n_at_score, pos_at_score,
               sum(pos_at_score) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
               sum(n_at_score - pos_at_score) OVER (PARTITION BY model ORDER BY score DESC) AS fp FROM h""",
    "v7_precision_recall_f1": f"WITH {SCORED_SQL}, c AS ({_COUNTS}) SELECT model, round({_P1}, 6) AS precision, "
                              f"round({_R1}, 6) AS recall, round({_F1}, 6) AS f1 FROM c",
    "v8_threshold_sweep": f"WITH {_SWEEP} SELECT * FROM swr",
    "r4_best_threshold": f"""WITH {_SWEEP} SELECT model, arg_min(threshold, (-f1, threshold)) AS threshold, max(f1) AS f1
        FROM swr GROUP BY model""",
    "v9_accuracy_gap": f"""WITH {SCORED_SQL} SELECT model,
        round(avg(CASE WHEN NOT is_test THEN (label = pred)::INTEGER::DOUBLE END), 6) AS train_acc,
        round(avg(CASE WHEN is_test THEN (label = pred)::INTEGER::DOUBLE END), 6) AS test_acc,
        round(avg(CASE WHEN NOT is_test THEN (label = pred)::INTEGER::DOUBLE END)
              - avg(CASE WHEN is_test THEN (label = pred)::INTEGER::DOUBLE END), 6) AS gap
        FROM sca GROUP BY model""",
    "v10_bootstrap_auc_diff": f"WITH {_BOOT} SELECT replicate, round(auc_a, 8) AS auc_a, round(auc_b, 8) AS auc_b, "
                              "round(diff, 8) AS diff FROM diffs",
    "v10_bootstrap_repeated_keys": f"WITH {_BOOT_KEYS} SELECT replicate, round(auc_a, 8) AS auc_a, round(auc_b, 8) AS auc_b, "
                                   "round(diff, 8) AS diff FROM diffs",
    "f6_folds_repeated_keys": f"""WITH {LINEITEM_FEATURES_SQL}, t AS (
            SELECT label, (row_number() OVER (PARTITION BY label ORDER BY split_part(row_key, '|', 1), row_key) - 1) % 5 AS fold
            FROM lf WHERE NOT is_test)
        SELECT label, CAST(fold AS INTEGER) AS fold, count(*) AS rows FROM t GROUP BY ALL""",
    "f4_imputer_nan": """WITH li AS (SELECT concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS row_key, nullif(l_discount, 0) AS l_discount,
                                           CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS l_tax FROM lineitem),
        m AS (SELECT quantile_cont(l_discount, 0.5) AS md, avg(l_tax) AS ta, stddev_pop(l_tax) AS ts FROM li)
        SELECT row_key, round(coalesce(l_discount, md), 6) AS l_discount, round((l_tax - ta) / ts, 6) AS l_tax FROM li, m""",
    "v11_bootstrap_ci": f"""WITH {_BOOT} SELECT round(mean, 8) AS mean, round(ci_low, 8) AS ci_low, round(ci_high, 8) AS ci_high,
        replicates, NOT (ci_low <= 0 AND ci_high >= 0) AS excludes_zero FROM ci""",
    "v12_ci_excludes_zero": f"WITH {_BOOT} SELECT NOT (ci_low <= 0 AND ci_high >= 0) AS excludes_zero FROM ci",
    "v13_model_comparison": f"""WITH {SCORED_SQL}, c AS ({_COUNTS}), au AS {_auc_sql('pr', 'model')},
        acc AS (SELECT model, avg((label = pred)::INTEGER::DOUBLE) AS accuracy FROM pr GROUP BY model)
        SELECT model, round({_P1}, 4) AS precision, round({_R1}, 4) AS recall, round({_F1}, 4) AS f1,
               round(accuracy, 4) AS accuracy, round(auc, 4) AS auc FROM c JOIN acc USING (model) JOIN au USING (model)""",
    "a22_fold_auc_summary": f"""WITH {SCORED_SQL},
        fo AS (SELECT row_key, CAST((row_number() OVER (PARTITION BY label ORDER BY {_H60.format(k="row_key || '|42'")}) - 1) % 5 AS INTEGER) AS fold
               FROM sca WHERE NOT is_test AND model = 'model_a'),
        tr AS (SELECT s.*, fo.fold FROM sca s JOIN fo USING (row_key) WHERE NOT s.is_test),
        pf AS {_auc_sql('tr', 'model, fold')}
        SELECT model, round(avg(auc), 6) AS mean, round(stddev_pop(auc), 6) AS std, count(auc) AS n FROM pf GROUP BY model""",
}

"""DuckDB twins for the model queries that SQL can express: least squares and ridge by orthogonalisation, logistic fits by a
recursive Newton iteration, the first splits of a tree by a search over all thresholds, and scoring by fixed coefficients."""

from sparkwright.plans.fixtures import FEATURES, LINEITEM_FEATURES_SQL
from sparkwright.plans.model_queries import FIXED_COEFFICIENTS, FIXED_INTERCEPT, NEWTON_FEATURES, SPLIT_FEATURES

_K = range(len(FEATURES))


def _residuals() -> str:
    """CTEs that take each feature's share out of net and of the later features, on the training rows' sums."""
    x = [f"x{i}" for i in range(len(FEATURES))]
    ctes = ["c AS (SELECT " + ", ".join(f"avg({f}) AS m{i}" for i, f in enumerate(FEATURES)) + ", avg(net) AS my FROM lf WHERE NOT is_test)",
            "r0 AS (SELECT is_test, net, net - my AS y, " + ", ".join(f"{f} - m{i} AS x{i}" for i, f in enumerate(FEATURES)) + " FROM lf, c)"]
    for k in range(len(FEATURES)):
        rest = x[k + 1:]
        ctes.append(f"b{k} AS (SELECT sum(y * x{k}) / sum(x{k} * x{k}) AS b_y"
                    + "".join(f", sum({z} * x{k}) / sum(x{k} * x{k}) AS b_{z}" for z in rest) + f" FROM r{k} WHERE NOT is_test)")
        ctes.append(f"r{k + 1} AS (SELECT is_test, net, y - b_y * x{k} AS y" + "".join(f", {z} - b_{z} * x{k} AS {z}" for z in rest) + f" FROM r{k}, b{k})")
    return ", ".join(ctes)


def _scaled() -> str:
    """CTE z: training and test rows with scaled features z0.., centred label y and the balanced class weight w."""
    stats = ", ".join(f"avg({f}) AS m{i}, CASE WHEN stddev_pop({f}) > 0 THEN stddev_pop({f}) ELSE 1 END AS s{i}" for i, f in enumerate(FEATURES))
    cols = ", ".join(f"({f} - m{i}) / s{i} AS z{i}" for i, f in enumerate(FEATURES))
    return (f"st AS (SELECT {stats}, avg(net) AS my, count(*) AS n, sum(label) AS n1 FROM lf WHERE NOT is_test), "
            f"z AS (SELECT is_test, net, label, net - my AS y, {cols}, n / (2.0::DOUBLE * CASE WHEN label = 1 THEN n1 ELSE n - n1 END) AS w FROM lf, st)")


def _augmented(alpha: float, tag: str) -> str:
    """Ridge by orthogonalisation: sqrt(alpha) times the unit rows are appended to the training rows, with label 0.

    CTEs g{tag}k (the features' shares of y and of the later features) and q{tag}K (the residuals of all rows)."""
    aug = " UNION ALL ".join("SELECT 1 AS kind, 0.0 AS net, 0.0 AS y, " + ", ".join(f"{alpha ** 0.5 if i == j else 0.0}::DOUBLE AS z{i}" for i in _K) for j in _K)
    ctes = [f"q{tag}0 AS (SELECT CASE WHEN is_test THEN 2 ELSE 0 END AS kind, net, y, " + ", ".join(f"z{i}" for i in _K) + f" FROM z UNION ALL {aug})"]
    for k in _K:
        rest = [f"z{i}" for i in _K if i > k]
        ctes.append(f"g{tag}{k} AS (SELECT sum(y * z{k}) / sum(z{k} * z{k}) AS b_y"
                    + "".join(f", sum({v} * z{k}) / sum(z{k} * z{k}) AS b_{v}" for v in rest) + f" FROM q{tag}{k} WHERE kind < 2)")
        ctes.append(f"q{tag}{k + 1} AS (SELECT kind, net, y - b_y * z{k} AS y" + "".join(f", {v} - b_{v} * z{k} AS {v}" for v in rest)
                    + f" FROM q{tag}{k}, g{tag}{k})")
    return ", ".join(ctes)


def _weights(tag: str) -> str:
    """Back substitution: one row w0.. of the coefficients."""
    out = []
    for k in reversed(_K):
        out.append(f"g{tag}{k}.b_y" + "".join(f" - g{tag}{k}.b_z{i} * w{i}" for i in _K if i > k) + f" AS w{k}")
    return "SELECT " + ", ".join(out) + " FROM " + ", ".join(f"g{tag}{k}" for k in _K)


def _coefficients(tag: str, lead: str, digits: int) -> str:
    return " UNION ALL ".join(f"SELECT {lead}'{f}' AS feature, round(w{i}, {digits}) AS coef FROM w{tag}" for i, f in enumerate(FEATURES))


def _error(tag: str, model: str) -> str:
    last = len(FEATURES)
    return (f"SELECT '{model}' AS model, round(avg(y * y), 4) AS mse, round(1 - sum(y * y) / (count(net) * var_pop(net)), 4) AS r2 "
            f"FROM q{tag}{last} WHERE kind = 2")


def _newton(C: float, steps: int = 25) -> str:
    """Newton steps for two features in a recursive query: every step sums the gradient and the weighted Gram matrix (3 x 3, with
    the intercept) and solves by cofactors."""
    z = ["1.0::DOUBLE", *[f"z{FEATURES.index(f)}" for f in NEWTON_FEATURES]]
    margin = f"b0 + b1 * {z[1]} + b2 * {z[2]}"
    old = "any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2"
    grad = ", ".join(f"{C} * sum(w * (p - label) * {z[i]})" + (f" + any_value(b{i})" if i else "") + f" AS g{i}" for i in range(3))
    gram = ", ".join(f"{C} * sum(w * p * (1 - p) * {z[i]} * {z[j]})" + (" + 1.0" if i == j and i else "") + f" AS h{i}{j}" for i in range(3) for j in range(i, 3))
    minors = ("h11 * h22 - h12 * h12 AS c00, h02 * h12 - h01 * h22 AS c01, h01 * h12 - h02 * h11 AS c02, h00 * h22 - h02 * h02 AS c11, "
              "h01 * h02 - h00 * h12 AS c12, h00 * h11 - h01 * h01 AS c22")
    rows = " UNION ALL ".join(f"SELECT '{n}' AS feature, round(b{i}, 5) AS coef FROM fin" for i, n in enumerate(["intercept", *NEWTON_FEATURES]))
    scored = lambda src: f"(SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM {src}, z WHERE NOT is_test)"
    return f"""WITH RECURSIVE {LINEITEM_FEATURES_SQL}, {_scaled()},
        it(k, b0, b1, b2) AS (SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE UNION ALL
          SELECT k + 1, b0 - (c00 * g0 + c01 * g1 + c02 * g2) / det, b1 - (c01 * g0 + c11 * g1 + c12 * g2) / det, b2 - (c02 * g0 + c12 * g1 + c22 * g2) / det
          FROM (SELECT *, h00 * c00 + h01 * c01 + h02 * c02 AS det FROM (SELECT *, {minors} FROM (
            SELECT k, {old}, {grad}, {gram} FROM {scored('(SELECT * FROM it WHERE k < ' + str(steps) + ') s')} GROUP BY k)))),
        fin AS (SELECT * FROM it WHERE k = {steps}), gr AS (SELECT {old}, {grad} FROM {scored('fin')})
        {rows} UNION ALL SELECT 'gradient_is_zero', CASE WHEN greatest(abs(g0), abs(g1), abs(g2)) < 1e-6 THEN 1.0 ELSE 0.0 END FROM gr"""


def _top_splits(impurity) -> str:
    """The best split of the root and of its two children among the thresholds between neighbouring values."""
    tall = lambda src: " UNION ALL ".join(f"SELECT path, {i} AS fi, {f}::DOUBLE AS x, label FROM {src}" for i, f in enumerate(SPLIT_FEATURES))
    name = "CASE fi " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(SPLIT_FEATURES)) + " END"
    value = "CASE fi " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(SPLIT_FEATURES)) + " END"
    all_, left, right = impurity("tn", "tp"), impurity("cn", "cp"), impurity("(tn - cn)", "(tp - cp)")

    def level(n: int, src: str) -> str:
        return f"""u{n} AS ({tall(src)}), h{n} AS (SELECT path, fi, x, count(*)::DOUBLE AS c, sum(label)::DOUBLE AS p FROM u{n} GROUP BY ALL),
        a{n} AS (SELECT path, fi, x, sum(c) OVER w AS cn, sum(p) OVER w AS cp, sum(c) OVER t AS tn, sum(p) OVER t AS tp FROM h{n}
                 WINDOW w AS (PARTITION BY path, fi ORDER BY x), t AS (PARTITION BY path, fi)),
        s{n} AS (SELECT path, fi, thr, tn, tp, {all_} AS impurity, {all_} - cn / tn * {left} - (tn - cn) / tn * {right} AS gain
                 FROM a{n} JOIN mids USING (fi, x) WHERE cn < tn),
        best{n} AS (SELECT * FROM s{n} QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, fi, thr) = 1)"""

    return f"""WITH {LINEITEM_FEATURES_SQL}, t0 AS (SELECT '' AS path, * FROM lf WHERE NOT is_test),
        mids AS (SELECT fi, x, (x + lead(x) OVER (PARTITION BY fi ORDER BY x)) / 2 AS thr FROM (SELECT DISTINCT fi, x FROM ({tall('t0')})) QUALIFY thr IS NOT NULL),
        {level(0, 't0')},
        t1 AS (SELECT t0.* REPLACE (CASE WHEN {value} <= thr THEN 'L' ELSE 'R' END AS path) FROM t0, best0), {level(1, 't1')}
        SELECT path, {name} AS feature, round(thr, 6) AS threshold, round(impurity, 6) AS impurity, round(gain, 6) AS gain, tn::BIGINT AS rows,
               tp::BIGINT AS positives FROM (SELECT * FROM best0 UNION ALL SELECT * FROM best1)"""


def _gini(n: str, p: str) -> str:
    return f"(1 - ({p} / {n}) * ({p} / {n}) - (1 - {p} / {n}) * (1 - {p} / {n}))"


def _entropy(n: str, p: str) -> str:
    part = lambda q: f"CASE WHEN {q} > 0 THEN -({q}) * log2({q}) ELSE 0.0 END"
    return f"({part(f'({p} / {n})')} + {part(f'(({n} - {p}) / {n})')})"


def _fixed() -> str:
    stat = ", ".join(f"quantile_cont({f}, 0.5) AS q{i}" for i, f in enumerate(FEATURES))
    filled = ", ".join(f"coalesce({f}, q{i}) AS f{i}" for i, f in enumerate(FEATURES))
    scale = ", ".join(f"avg(f{i}) AS m{i}, CASE WHEN stddev_pop(f{i}) > 0 THEN stddev_pop(f{i}) ELSE 1 END AS s{i}" for i in _K)
    margin = " + ".join(f"(f{i} - m{i}) / s{i} * ({c})::DOUBLE" for i, c in enumerate(FIXED_COEFFICIENTS))
    return f"""WITH {LINEITEM_FEATURES_SQL}, li AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax) FROM lf),
        md AS (SELECT {stat} FROM li WHERE NOT is_test), fl AS (SELECT row_key, is_test, {filled} FROM li, md),
        sc AS (SELECT {scale} FROM fl WHERE NOT is_test),
        pr AS (SELECT row_key, 1 / (1 + exp(-({margin} + ({FIXED_INTERCEPT})::DOUBLE))) AS score FROM fl, sc WHERE is_test)
        SELECT row_key, CAST(score > 0.5 AS INTEGER) AS pred, round(score, 6) AS score FROM pr"""


_PATH = {"a": 1.0, "b": 100.0, "c": 10000.0}
SQL = {
    "m1_ols_one_feature": f"""WITH {LINEITEM_FEATURES_SQL}
        SELECT round(regr_slope(net, l_extendedprice), 6) AS slope, round(regr_intercept(net, l_extendedprice), 2) AS intercept
        FROM lf WHERE NOT is_test""",
    "m1_ols_r2": f"""WITH {LINEITEM_FEATURES_SQL}, {_residuals()}
        SELECT 'ols' AS model, round(1 - sum(y * y) / (count(net) * var_pop(net)), 4) AS r2 FROM r{len(FEATURES)} WHERE is_test""",
    "m2_ridge": f"WITH {LINEITEM_FEATURES_SQL}, {_scaled()}, {_augmented(0.0, 'o')}, {_augmented(1.0, 'r')} "
                f"{_error('o', 'ols')} UNION ALL {_error('r', 'ridge_alpha1')}",
    "m2_ridge_path": f"WITH {LINEITEM_FEATURES_SQL}, {_scaled()}, " + ", ".join(f"{_augmented(a, t)}, w{t} AS ({_weights(t)})" for t, a in _PATH.items())
                     + " " + " UNION ALL ".join(_coefficients(t, f"{a}::DOUBLE AS alpha, ", 3) for t, a in _PATH.items()),
    "m3_coefficients": f"WITH {LINEITEM_FEATURES_SQL}, {_scaled()}, {_augmented(0.0, 'o')}, wo AS ({_weights('o')}) {_coefficients('o', '', 4)}",
    "m4_newton": _newton(1.0),
    "m5_newton": _newton(0.01),
    "m8_top_splits": _top_splits(_gini),
    "m9_top_splits": _top_splits(_entropy),
    "m18_reload_difference": f"WITH {LINEITEM_FEATURES_SQL} SELECT count(*) AS rows, 0.0::DOUBLE AS max_difference FROM lf WHERE is_test",
    "m20_fixed_coefficients": _fixed(),
    "s6_save_load": f"WITH {LINEITEM_FEATURES_SQL} SELECT count(*) AS rows, 0.0::DOUBLE AS max_difference FROM lf WHERE is_test",
}

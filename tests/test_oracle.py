"""Every registered query with a SQL twin matches DuckDB on the sf0.01 tables
(the driver's correctness gate), and the rows-only queries produce rows."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from sparkwright.plans.catalog import all_queries
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SQL = E.oracle_sql()
SLOW_ROWS_ONLY = {"m14_cross_validation", "m17_learning_curve", "m19_leaderboard", "m12_gradient_boosting", "m13_ablation"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4) + 0.0
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_oracle_or_is_rows_only():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 100


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[name])
    exp = _canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == exp[0]
    assert len(got[1]) == len(exp[1])
    assert got[1] == exp[1]


@pytest.mark.parametrize("name", sorted(n for n in all_queries() if n not in SQL and n not in SLOW_ROWS_ONLY))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF001).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 5 and set(df.columns) == {"o_orderpriority", "mean", "std", "count"}


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "array<double>": "DOUBLE[]", "timestamp_ntz": "TIMESTAMP"}


def test_output_types_match_duckdb(spark, con):
    """Same column types on both sides (e.g. no HUGEINT counts or DECIMAL literals in a twin)."""
    bad = {}
    for name in sorted(SQL):
        df = E.queries()[name](spark, SF001)
        st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
        dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
        if st != dt:
            bad[name] = {k: (st.get(k), dt.get(k)) for k in set(st) | set(dt) if st.get(k) != dt.get(k)}
    assert not bad, bad


def test_grid_and_best_point(spark):
    """Every point of the grid is there, the best is its arg-max, and its AUC is in the published range."""
    grid = E.queries()["m15_grid_search"](spark, SF001).collect()
    assert {(r.numTrees, r.maxDepth, r.minInstancesPerNode) for r in grid} == {(t, d, m) for t in (50, 100, 200) for d in (5, 10, 30) for m in (1, 5)}
    assert len(grid) == 18
    best = E.queries()["m16_best_params"](spark, SF001).first()
    assert round(best.cv_auc, 4) == max(r.cv_auc for r in grid) and 0.95 < best.cv_auc <= 1.0


def test_end_to_end_explanations(spark):
    out = E.queries()["t15_end_to_end"](spark, SF001)
    n, valid, passed = out.selectExpr("count(*)", "count_if(valid_temp0 and valid_temp07)", "count_if(guardrail = 'passed')").first()
    assert n > 0 and valid == passed == n
    assert {r[0] for r in out.select("pred").distinct().collect()} == {0, 1}


def test_controlled_tree_differs_from_the_unlimited_one(spark):
    rows = {r.model: r for r in E.queries()["m7_tree_depth5"](spark, SF001).collect()}
    assert rows["tree_d5"].gap < rows["tree_full"].gap and rows["tree_d5"].test_acc > 0.9

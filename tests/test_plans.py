"""Physical-plan properties of the registered queries (what the optimizer was given to work with)."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_column_pruning_reaches_the_scan(spark):
    plan = _formatted(E.queries()["a7_group_stats"](spark, SF001))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    assert schemas and all(s == "struct<o_totalprice:double,o_orderpriority:string>" for s in schemas)


def test_filter_pushdown_reaches_the_scan(spark):
    plan = _formatted(E.queries()["p5_outside_range"](spark, SF001))
    pushed = re.findall(r"PushedFilters: \[([^\n]*)\]", plan)
    assert pushed and "l_extendedprice" in pushed[0] and "Or(" in pushed[0]


def test_rank_windows_are_bucketed(spark):
    """Every window in the rank machinery is keyed by a bucket: none spans a whole group or table."""
    for name in ("r1_rank_rows", "a11_spearman", "f6_stratified_folds", "v5_roc_auc", "a1_describe"):
        plan = _formatted(E.queries()[name](spark, SF001))
        windows = re.findall(r"\(\d+\) Window\nInput[^\n]*\nArguments: ([^\n]*)", plan)
        assert windows, name
        assert all("__bucket" in w or "__b#" in w for w in windows), (name, windows)


@pytest.mark.parametrize("name, columns", [("t10_validate", 1), ("t11_fallback_record", 1), ("t12_ab_compare", 2), ("t13_result_table", 1),
                                           ("t14_guardrail_audit", 1)])
def test_one_parse_per_response(spark, name, columns):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    branches = 3 if name in ("t10_validate", "t11_fallback_record") else 1      # a union of three sources may be parsed in each
    assert columns <= len(re.findall(r"tryparsejson|try_parse_json|parseJson", plan, re.I)) <= columns * branches


def test_bootstrap_bounds_are_broadcast(spark):
    plan = _formatted(E.queries()["v10_bootstrap_auc_diff"](spark, SF001))
    assert "BroadcastHashJoin" in plan
    assert not re.search(r"SortMergeJoin[^\n]*\n[^\n]*\n[^\n]*model#", plan)

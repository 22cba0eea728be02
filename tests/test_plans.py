"""Plan checks on the hot operators: no cartesian product, no nested-loop join except
against a one-row global aggregate (a broadcast scalar), and no single-partition
exchange (a window or sort pulling a whole input into one task)."""
import re

import pytest

from vigil.plans.catalog import QUERIES

D = "/root/testdata/sf0.001"
HOT = ["first_block", "asof_weight", "window_features_wide", "score_ladder", "roc_points", "topn_sweep",
       "dose_summary", "organ_score", "fairness", "settings_summary", "exact_quantiles_global",
       "initial_mode_table", "state_blocks", "bootstrap_ci", "bootstrap_poisson_ci", "describe_features",
       "calibration_equal_width", "histogram30", "curve_areas", "model_matrix"]


def plan_lines(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def _indent(line):
    m = re.search(r"[A-Za-z*(]", line)
    return m.start() if m else 0


def subtree(lines, i):
    base = _indent(lines[i])
    out = []
    for ln in lines[i + 1:]:
        if _indent(ln) <= base:
            break
        out.append(ln)
    return out


def check(lines, name):
    for i, line in enumerate(lines):
        assert "CartesianProduct" not in line, name
        if "Exchange SinglePartition" in line:
            # allowed only for the partial results of a global aggregate (one row per task)
            assert "keys=[]" in lines[i + 1], f"single-partition exchange of rows in {name}"
        if "BroadcastNestedLoopJoin" in line:
            kids = subtree(lines, i)
            top = min(_indent(k) for k in kids)
            direct = [j for j, k in enumerate(kids) if _indent(k) == top]
            b = direct[-1] if "BuildRight" in line else direct[0]
            assert "Broadcast" in kids[b], f"nested loop join without broadcast side in {name}"
            side = "\n".join([kids[b]] + subtree(kids, b))
            assert "keys=[]" in side, f"nested loop join against a non-scalar side in {name}"


@pytest.mark.parametrize("name", HOT)
def test_hot_plans(spark, name):
    if name == "exact_quantiles_global":
        from vigil.operators.ordered import exact_quantiles
        df = spark.read.parquet(f"{D}/lineitem.parquet")
        check(plan_lines(exact_quantiles(df, [], "l_quantity", [0.25, 0.5])), name)
        return
    check(plan_lines(QUERIES[name](spark, D)), name)


def test_scan_pruning_and_pushdown(spark):
    lines = plan_lines(QUERIES["organ_score"](spark, D))
    scans = [ln for ln in lines if "FileScan parquet" in ln and "lineitem" in ln]
    assert scans and all("l_comment" not in s and "l_partkey" not in s for s in scans)
    lines = plan_lines(QUERIES["dose_converted"](spark, D))
    scans = [ln for ln in lines if "FileScan parquet" in ln and "events" in ln]
    assert any("PushedFilters" in s and "event_type" in s for s in scans)
    assert all("props" not in s for s in scans)


@pytest.mark.parametrize("name", ["calibration_equal_width", "histogram30", "curve_areas", "score_ladder", "topn_sweep"])
def test_no_checkpoint_and_no_row_shuffle_on_a_few_keys(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        lines = plan_lines(QUERIES[name](spark, D))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not any("ExistingRDD" in line for line in lines), "reads a checkpoint"
    for i, line in enumerate(lines):
        if re.search(r"hashpartitioning\((site|feature)#\d+, \d+\)", line):
            assert "partial_" in lines[i + 1], f"rows are shuffled on a few keys in {name}: {line}"

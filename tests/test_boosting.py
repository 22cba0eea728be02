"""The blocked trainer against Spark ML's own learner, on rows with missing values, ties, equal and constant columns."""
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vigil.operators import boosting as bo
from vigil.operators import model as mdl

FEATURES = ["a", "b", "c", "same", "g"]


def _rows(spark, n, seed=4):
    rng, rows = random.Random(seed), []
    for i in range(n):
        a, b, g = rng.random(), rng.random(), rng.choice([0.0, 0.0, rng.gauss(0, 1)])
        rows.append((int(a + 0.5 * b + 0.1 * g + 0.2 * rng.random() > 0.8), a if i % 7 else None, b if i % 7 else None, float(rng.randrange(5)), 1.0, g))
    return spark.createDataFrame(rows, "label int, a double, b double, c double, same double, g double").coalesce(1)


def _nodes(spark, model, at):
    model.stages[-1].save(str(at))
    return spark.read.parquet(f"{at}/data").orderBy("treeID", "nodeData.id").collect()


def test_trees_are_those_of_sparks_learner_without_its_pass_over_row_objects(spark, tmp_path, monkeypatch):
    df = _rows(spark, 600)
    own = mdl.gbt_pipeline(FEATURES, trees=12, depth=6).fit(mdl.feature_matrix(df, FEATURES))  # a checkpoint is due after ten trees
    monkeypatch.setattr(GBTClassifier, "_fit", lambda *_: pytest.fail("a pass over row objects"))
    got = mdl.train(df, FEATURES, trees=12, depth=6)
    assert _nodes(spark, got, tmp_path / "got") == _nodes(spark, own, tmp_path / "own")
    assert got.stages[-1].featureImportances == own.stages[-1].featureImportances


def test_thresholds_come_from_sparks_sample(spark):
    df = _rows(spark, 12_000, seed=8)
    own = mdl.gbt_pipeline(FEATURES, trees=2, depth=5).fit(mdl.feature_matrix(df, FEATURES))
    got = mdl.train(df, FEATURES, trees=2, depth=5)
    assert got.stages[-1].toDebugString.splitlines()[1:] == own.stages[-1].toDebugString.splitlines()[1:]


def test_equal_thresholds_between_adjacent_doubles(spark):
    rng = random.Random(11)
    near = [0.07, 0.07000000000000002, 0.06999999999999999, 0.07000000000000003, 0.07000000000000001, 0.02, 0.05]
    rows = [(int(rng.random() < 0.3 + 0.05 * k), near[k], rng.random()) for k in (rng.randrange(7) for _ in range(600))]
    df = spark.createDataFrame(rows, "label int, a double, b double").coalesce(1)
    assert len(set(t := bo.thresholds(np.array([r[1] for r in rows]), 600, 32))) < len(t)
    own = mdl.gbt_pipeline(["a", "b"], trees=4, depth=6).fit(mdl.feature_matrix(df, ["a", "b"]))
    got = mdl.train(df, ["a", "b"], trees=4, depth=6)
    assert got.stages[-1].toDebugString.splitlines()[1:] == own.stages[-1].toDebugString.splitlines()[1:]


def test_blocks_in_many_partitions_and_derived_sums_give_the_same_splits(spark, monkeypatch):
    df = _rows(spark, 3_000, seed=9).na.fill(0.3)  # Spark's medians depend on the partitions
    shape = lambda m: [x.split("Predict")[0] for x in m.stages[-1].toDebugString.splitlines()[1:]]
    one = shape(mdl.train(df, FEATURES, trees=2, depth=3))
    summed = []
    monkeypatch.setattr(bo, "_gathered", lambda data, make, f=bo._gathered: summed.append(f(data, make)) or summed[-1])
    monkeypatch.setattr(bo, "ROWS", 500)  # of the driver: that many tasks
    monkeypatch.setattr(bo, "DIRECT", 0)
    assert shape(mdl.train(df.repartition(6), FEATURES, trees=2, depth=3)) == one
    assert len(summed[1]) == len(summed[0]), "of the root's two children one is summed up"


def test_a_block_holds_a_byte_per_bin():
    b = pa.record_batch({"x": [0.5, 2.0, 2.5, 9.0], "label": [0.0, 1.0, 1.0, 0.0]})
    (got,) = bo._blocks(iter([b, b]), ["x"], [np.array([2.0, 3.0])])
    assert got["bins"][0].as_py() == bytes([0, 0, 1, 2] * 2) and np.frombuffer(got["sign"][0].as_py()).tolist() == [-1, 1, 1, -1] * 2
    with pytest.raises(ValueError, match="infinite"):
        list(bo._blocks(iter([pa.record_batch({"x": [np.inf], "label": [0.0]})]), ["x"], [np.array([2.0])]))


def test_exp_is_that_of_the_jvm(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, s, 2_000) for s in (1e-9, 0.1, 1, 3, 40)] + [[0.0, -0.0, 700.0, -700.0, 800.0, -800.0]])
    rows = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double")
    want = np.array([r[0] for r in rows.orderBy("i").select(F.exp("x")).collect()])
    with np.errstate(over="ignore"):
        assert (bo._exp(x) == want).all()


def test_equal_columns_are_equal_in_every_block():
    a, b = bo._equal(bytes([1, 2, 1, 2, 1, 2]), 2), bo._equal(bytes([1, 2, 1, 2, 1, 3]), 2)
    assert (a, b, bo._both(a, b), bo._both(b, b)) == ((0, 0, 0), (0, 0, 2), (0, 0, 2), (0, 0, 2))


def test_constant_columns_and_bad_labels(spark):
    df = spark.createDataFrame([(1, 2.0), (0, 2.0), (1, 2.0)], "label int, a double")
    model = mdl.train(df, ["a"], trees=2, depth=3)
    assert [t.numNodes for t in model.stages[-1].trees] == [1, 1] and not model.stages[-1].featureImportances.toArray().any()
    for bad in (2, None):
        with pytest.raises(Exception, match="Labels must be in"):
            mdl.train(df.union(spark.createDataFrame([(bad, 1.0)], df.schema)), ["a"], trees=2, depth=3)


def test_scores_are_those_of_the_model_and_walk_whole_batches(spark):
    df = _rows(spark, 500, seed=5)
    model = mdl.train(df, FEATURES, trees=4, depth=5)
    want = [r[0] for r in model.transform(mdl.feature_matrix(df, FEATURES)).select(vector_to_array("probability")[1]).collect()]
    odd = df.union(spark.createDataFrame([(None, None, float("nan"), float("inf"), -0.0, None)], df.schema))
    got = mdl.score(model, odd, FEATURES)
    assert got.columns == [*df.columns, "pred_proba"]
    rows = got.collect()
    assert [r.pred_proba for r in rows[:-1]] == pytest.approx(want, abs=1e-12) and len({round(x, 6) for x in want}) > 50
    (last,) = model.transform(mdl.feature_matrix(odd, FEATURES)).where("label is null").select(vector_to_array("probability")[1]).collect()
    assert rows[-1].pred_proba == pytest.approx(last[0], abs=1e-12)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "probability" not in plan, "no vector per row is built"


def test_scores_of_a_model_without_splits(spark):
    df = spark.createDataFrame([(1, 2.0), (0, 2.0), (1, 2.0)], "label int, a double")
    model = mdl.train(df, ["a"], trees=2, depth=3)
    want = [r[0] for r in model.transform(mdl.feature_matrix(df, ["a"])).select(vector_to_array("probability")[1]).collect()]
    assert [r.pred_proba for r in mdl.score(model, df, ["a"]).collect()] == pytest.approx(want, abs=1e-12)

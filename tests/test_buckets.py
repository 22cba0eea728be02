"""Prefix sums over data-driven buckets: results as with one bucket, task sizes bounded; counter-based bootstrap draws."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.operators import bootstrap as bs
from vigil.operators.ordered import in_buckets, running_totals

YEAR = int(dt.datetime(2024, 1, 1).timestamp())


def column(kind, n=6000):
    rng = random.Random(4)
    if kind == "epoch seconds":
        return rng.sample(range(YEAR, YEAR + 366 * 86400), n)
    if kind == "ids":
        return range(10**12, 10**12 + n)
    if kind == "prices":
        return [1000 + i / 1e4 for i in range(n)]
    return [-1e300, 1e300, float("inf"), *[rng.expovariate(1) * 1e-9 for _ in range(n)]]


@pytest.mark.parametrize("kind", ["epoch seconds", "ids", "prices", "outliers"])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_in_bounded_buckets(spark, kind, descending):
    rows = [("hot", float(v), i % 7) for i, v in enumerate(column(kind))] + [("cold", float(v), 1) for v in range(50)] + [(None, None, 3), ("hot", None, 2)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    t, split = in_buckets(df, ["g"], "v", rows=100)
    sizes = t.groupBy("_k", "_bk").count()
    assert split and sizes.agg(F.max("count")).first()[0] <= 100
    assert sizes.where("_k.g = 'hot'").count() >= 60
    # buckets rise with the value
    ends = [(r.lo, r.hi) for r in t.where("g = 'hot' and v is not null").groupBy("_bk").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_bk").collect()]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    got, want = [{(r.g, r.v): (r.cum_w, r.tot_w, r.next_w) for r in running_totals(df, ["g"], "v", ["w"], descending=descending, rows_per_bucket=n, leads=["w"]).collect()}
                 for n in (100, 10**6)]
    assert got == want and len(got) == len(rows)


def test_one_value_in_many_groups_is_not_split_for_ever(spark):
    df = spark.range(3000).select((F.col("id") % 1000).alias("g"), (F.col("id") % 3).cast("double").alias("v"), F.lit(1).alias("w"))
    assert running_totals(df.distinct(), ["g"], "v", ["w"], rows_per_bucket=2).agg(F.max("cum_w")).first()[0] in (1, 2, 3)


def test_the_upstream_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for b in it:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("w")).mapInArrow(count, "v double, w int")
    running_totals(df, [], "v", ["w"], rows_per_bucket=10, leads=["w"]).collect()
    assert seen.value == 1000


def test_poisson_thresholds_are_the_distribution():
    for mean in (1, 2, 8, 1 << 12, 1 << 20):
        t = bs.poisson_thresholds(mean) / bs.PRIME
        mass = np.diff(np.append(0, np.minimum(t, 1)))
        k = np.arange(len(mass))
        assert abs((mass * k).sum() - mean) < 1e-3 * mean ** 0.5 and abs((mass * (k - mean) ** 2).sum() / mean - 1) < 1e-3
    assert np.allclose(bs.poisson_thresholds(1)[:5] / bs.PRIME, bs.poisson_cdf(4), atol=1e-9)


def test_draws_look_independent():
    keys = np.random.default_rng(1).integers(0, 1 << 28, (2000, 3))
    x = bs.draws(keys, 0, np.arange(200)) / bs.PRIME
    y = bs.draws(keys, 64, np.arange(200)) / bs.PRIME
    n = x.size
    assert abs(x.mean() - 0.5) < 4 * (1 / 12 / n) ** 0.5 and abs(x.var() - 1 / 12) < 1e-3
    for a, b in ((x[:, 1:], x[:, :-1]), (x[1:], x[:-1]), (x, y)):
        assert abs(np.corrcoef(a.ravel(), b.ravel())[0, 1]) < 4 / n ** 0.5
    assert np.histogram(x, 64)[0].std() < 4 * (n / 64) ** 0.5


def test_bootstrap_does_not_depend_on_blocks(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(rng.choice(["A", "B", None]), rng.random() < 0.4, round(rng.random(), 2)) for _ in range(1500)]
    df = spark.createDataFrame(rows, "site string, label boolean, score double").withColumn("label", F.col("label").cast("int"))
    ask = lambda **k: sorted((r.site or "", r.metric, round(r.ci_lower, 9), round(r.ci_upper, 9)) for r in bs.bootstrap_ci(df, by=["site"], replicates=70, **k).collect())
    whole = ask(block=4096)
    monkeypatch.setattr(bs, "FAN", 3)  # 3 levels hold 27 of these blocks of 5 cells
    assert len(whole) == 15 and ask(block=5) == whole

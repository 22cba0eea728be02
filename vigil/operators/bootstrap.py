"""Bootstrap confidence intervals (EVL-3) without multiplying the data.

A replicate gives every row a Poisson(1) weight, so a ladder cell of n equal rows gets a Poisson(n) weight: the sum of
independent Poisson(2 ** k) weights over the binary digits of n.  Each is read by the inverse distribution from a number that is
a function of (seed, group, rank of the score, class, k, replicate) alone: no stream and no order, so any engine draws
the same weights, and a lost task draws them again.

Cells are drawn in blocks of bounded size.  A block's result is, per replicate, its weighted counts and its ordered
(positive above negative) pairs; two neighbours combine by adding up, with the pairs between them being the upper
one's positives times the lower one's negatives.  Blocks are folded up a tree of bounded fan, one keyed step per
level, so no task holds a group.
"""

from __future__ import annotations

from collections.abc import Sequence

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from .ordered import join_on, running_totals

METRICS = ["Accuracy", "Recall", "Precision", "ROC AUC", "Brier Score Loss"]


def bootstrap_cells(df: DataFrame, *, label="label", score="score", by: Sequence[str] = (),
                    thr: float = fixed.THRESHOLD, block: int = 4096) -> DataFrame:
    """(by..., rank, block_no, above, pos, neg, se_pos, se_neg): one cell per distinct score, rank 1
    the highest, in blocks of ``block`` ranks.  One aggregate (counts and squared errors) and the
    two-level prefix sum; no score is merged with another."""
    by = list(by)
    y = F.col(label) == 1
    per = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
           .groupBy(*by, F.col(score).alias("score"))
           .agg(F.sum(y.cast("long")).alias("pos"), F.sum((~y).cast("long")).alias("neg"),
                F.sum(F.when(y, (F.col(score) - 1) * (F.col(score) - 1)).otherwise(0.0)).alias("se_pos"),
                F.sum(F.when(~y, F.col(score) * F.col(score)).otherwise(0.0)).alias("se_neg"))
           .withColumn("one", F.lit(1).cast("long")))
    rt = running_totals(per, by, "score", ["one"], descending=True, totals_prefix=None)
    return rt.select(*by, F.col("cum_one").alias("rank"), F.floor((F.col("cum_one") - 1) / block).alias("block_no"),
                     (F.col("score") >= thr).alias("above"), "pos", "neg", "se_pos", "se_neg")


#: Draws are numbers modulo this prime; x ** 5 permutes them.
PRIME = (1 << 31) - 1
#: Steps of the counter: per replicate, and per (class, binary digit).
STEP_REPLICATE, STEP_DIGIT = 1_103_515_245, 1_140_671_485
SUMS = ("p", "q", "tp", "fp", "se", "u")
#: Cells drawn at a time for 64 replicates, so that the arrays of one draw stay in a core's cache.
SLICE = 256
#: Children of a node of the tree, and its levels above the blocks.
FAN, LEVELS = 256, 3


def poisson_thresholds(mean: int) -> np.ndarray:
    """Draws x below PRIME map to a Poisson(mean) weight: the number of thresholds that are not above x."""
    spread = 12 * math.sqrt(mean) + 12
    k = np.arange(max(0, int(mean - spread)), int(mean + spread) + 1)
    mode = max(mean, k[0])
    logs = np.where(k > mode, np.log(mean / np.maximum(k, 1)), 0.0).cumsum()
    below = np.where(k <= mode, np.log(np.maximum(k, 1) / mean), 0.0)
    logs += below[::-1].cumsum()[::-1] - np.where(k <= mode, below, 0.0)
    mass = np.exp(logs - logs.max())
    first = np.zeros(int(k[0]), np.int64)  # weights below the first one have no chance to speak of
    return np.append(first, np.ceil(np.cumsum(mass / mass.sum()) * PRIME).astype(np.int64))


def _fold31(x: np.ndarray, low: np.ndarray) -> np.ndarray:
    """In place: a smaller number that is the same modulo PRIME; ``low`` is scratch."""
    np.bitwise_and(x, PRIME, out=low)
    np.right_shift(x, 31, out=x)
    return np.add(x, low, out=x)


def _fifth(x: np.ndarray, square: np.ndarray, low: np.ndarray) -> np.ndarray:
    """In place: x ** 5 modulo PRIME, at most 2 ** 32 + 8.  Given x up to 2 ** 31 no product reaches 2 ** 64."""
    np.multiply(x, x, out=square)
    _fold31(square, low)
    np.multiply(square, square, out=square)
    _fold31(_fold31(square, low), low)
    np.multiply(x, square, out=x)
    return _fold31(x, low)


def draws(keys: np.ndarray, digit: int, replicates: np.ndarray) -> np.ndarray:
    """One number below PRIME per (key, replicate); ``keys`` are rows of three 28-bit numbers."""
    a, b, c = (keys[:, i, None].astype(np.uint64) for i in range(3))
    step = (replicates + 1) * STEP_REPLICATE % PRIME + (digit + 1) * STEP_DIGIT % PRIME
    x = a + (step % PRIME).astype(np.uint64)
    square, low = np.empty_like(x), np.empty_like(x)
    _fifth(_fold31(x, low), square, low)
    x += b
    _fifth(_fold31(x, low), square, low)
    x += c
    _fold31(x, low)
    # at most 2 ** 31 by now; where x is below PRIME the difference wraps round to a huge number
    np.subtract(x, PRIME, out=low)
    return np.minimum(x, low, out=x).view(np.int64)


#: Draws are looked up by their upper bits first: one cell of the table for 2 ** SHIFT draws.
SHIFT = 15


def poisson_lookup(mean: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of Poisson(mean), and the weight of each cell's draws, -1 for a cell that a threshold divides."""
    thresholds = poisson_thresholds(mean)
    first = np.arange(1 << (31 - SHIFT), dtype=np.int64) << SHIFT
    weight = np.searchsorted(thresholds, first, "right")
    last = np.searchsorted(thresholds, first + ((1 << SHIFT) - 1), "right")
    return thresholds, np.where(weight == last, weight, -1).astype(float)


def _weights(keys: np.ndarray, count: np.ndarray, cls: int, replicates: np.ndarray, tables: dict) -> np.ndarray:
    out = np.zeros((len(count), len(replicates)))
    for k in range(int(count.max()).bit_length() if len(count) else 0):
        has = np.flatnonzero(count >> k & 1)
        if len(has) and k not in tables:
            tables[k] = poisson_lookup(1 << k)
        for lo in range(0, len(has), SLICE):
            at = has[lo:lo + SLICE]
            x = draws(keys[at], 64 * cls + k, replicates)
            thresholds, weight = tables[k]
            w = weight[x >> SHIFT]
            rest = np.nonzero(w < 0)
            w[rest] = np.searchsorted(thresholds, x[rest], "right")
            out[at] += w
    return out


def _draw_block(replicates: int):
    def run(key, cells: pd.DataFrame) -> pd.DataFrame:
        c = cells.sort_values("rank")
        pos, neg = c["pos"].to_numpy(np.int64), c["neg"].to_numpy(np.int64)
        mse_pos = np.divide(c["se_pos"].to_numpy(float), pos, out=np.zeros(len(c)), where=pos > 0)
        mse_neg = np.divide(c["se_neg"].to_numpy(float), neg, out=np.zeros(len(c)), where=neg > 0)
        above = c["above"].to_numpy(bool)
        keys = np.array([[int(h[i:i + 7], 16) for i in (0, 7, 14)] for h in c["key"]], np.int64).reshape(-1, 3)
        tables, sums = {}, []
        for lo in range(0, replicates, 64):
            r = np.arange(lo, min(lo + 64, replicates))
            p, q = _weights(keys, pos, 0, r, tables), _weights(keys, neg, 1, r, tables)
            sums.append((p.sum(0), q.sum(0), p[above].sum(0), q[above].sum(0), mse_pos @ p + mse_neg @ q,
                         (q * (np.cumsum(p, 0) - 0.5 * p)).sum(0)))
        out = {"_gid": [key[0]], "node": [key[1]]}
        return pd.DataFrame(out | {n: [np.concatenate(x)] for n, x in zip(SUMS, zip(*sums))})
    return run


def _fold(key, nodes: pd.DataFrame) -> pd.DataFrame:
    """Children of one node, the highest scores first, into one row."""
    nodes = nodes.sort_values("node")
    part = {n: np.stack(nodes[n].to_list()) for n in SUMS}
    above = np.cumsum(part["p"], 0) - part["p"]
    total = {n: v.sum(0) for n, v in part.items()}
    total["u"] = total["u"] + (part["q"] * above).sum(0)
    return pd.DataFrame({"_gid": [key[0]], "node": [key[1]]} | {n: [v] for n, v in total.items()})


def bootstrap_ci(df: DataFrame, *, label="label", score="score", by: Sequence[str] = (),
                 thr: float = fixed.THRESHOLD, replicates: int = fixed.BOOTSTRAP_REPLICATES, seed: int = 42,
                 alpha: float = 0.05, ci_method: str = "interpolated", block: int = 4096) -> DataFrame:
    """EVL-3: percentile intervals (``interpolated``, or ``index`` = sorted replicate at
    position int(a/2 R) as in the Python variant) of accuracy, recall, precision (at
    ``score >= thr``), ROC AUC and probability Brier score over ``replicates`` resamples
    of each group.  Rows (by..., metric, ci_lower, ci_upper, replicates); a NULL key is a group.

    A task holds ``block`` cells and 64 replicates at a time, or ``FAN`` rows of ``replicates`` sums; blocks
    and nodes are numbered by rank, so ``FAN`` ** ``LEVELS`` blocks (7e10 distinct scores at 4,096) end in one row per group
    and more in a few.  The result does not depend on ``block``."""
    by = list(by)
    name = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(b).cast("string"), F.lit("")) for b in by], F.col("rank").cast("string"))
    cells = (bootstrap_cells(df, label=label, score=score, by=by, thr=thr, block=block)
             .withColumns({"_gid": F.xxhash64(F.lit(0), *by), "key": F.md5(name)}))
    groups = cells.groupBy("_gid").agg(*[F.first(b).alias(b) for b in by] or [F.first(F.lit(0)).alias("_one")])
    schema = "_gid bigint, node bigint, " + ", ".join(f"{c} array<double>" for c in SUMS)
    nodes = cells.drop(*by).groupBy("_gid", "block_no").applyInPandas(_draw_block(replicates), schema)
    for _ in range(LEVELS):
        parent = F.floor(F.col("node") / FAN).alias("parent")
        nodes = nodes.groupBy("_gid", parent).applyInPandas(_fold, schema)
    rep = nodes.select("_gid", F.inline(F.arrays_zip(*[F.col(c) for c in SUMS])))
    n, called = F.col("p") + F.col("q"), F.col("tp") + F.col("fp")
    rep = rep.select("_gid", F.try_divide(F.col("tp") + F.col("q") - F.col("fp"), n).alias("Accuracy"),
                     F.when(F.col("p") == 0, 0.0).otherwise(F.try_divide(F.col("tp"), F.col("p"))).alias("Recall"),
                     F.when(called == 0, 0.0).otherwise(F.try_divide(F.col("tp"), called)).alias("Precision"),
                     F.try_divide(F.col("u"), F.col("p") * F.col("q")).alias("ROC AUC"),
                     F.try_divide(F.col("se"), n).alias("Brier Score Loss")).unpivot(["_gid"], METRICS, "metric", "v")
    a_lo, a_hi = alpha / 2, 1 - alpha / 2
    if ci_method == "index":
        srt = F.array_sort(F.collect_list("v"))
        lo = F.get(srt, F.lit(int(a_lo * replicates)))
        hi = F.get(srt, F.lit(min(int(a_hi * replicates), replicates - 1)))
    else:
        lo, hi = F.percentile("v", a_lo), F.percentile("v", a_hi)
    out = rep.groupBy("_gid", "metric").agg(lo.alias("ci_lower"), hi.alias("ci_upper"), F.lit(replicates).alias("replicates"))
    return out.join(groups, "_gid").select(*by, "metric", "ci_lower", "ci_upper", "replicates")


def metrics_table(headline: DataFrame, ci: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """EVL-4: Metric, Value, CI Lower, CI Upper per group."""
    by = list(by)
    return join_on(headline, ci, by + ["metric"], "left").select(*by, "metric", "value", "ci_lower", "ci_upper")


# ---- deterministic Poisson bootstrap (counts and Brier; reproducible in SQL) ---------------
POISSON_METRICS = ["Accuracy", "Recall", "Precision", "Brier Score Loss"]


def poisson_cdf(k_max: int = 12) -> list[float]:
    """P(X <= k) for X ~ Poisson(1), k = 0..k_max (from the series, not a table)."""
    out, term, acc = [], 1.0, 0.0
    for k in range(k_max + 1):
        term = 1.0 if k == 0 else term / k
        acc += term
        out.append(acc * math.exp(-1.0))
    return out


def _digest(id_col: str, block: int, seed: int) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"), F.lit(f":{block}")))


def poisson_weight(id_col: str, rep: int, seed: int = 42, digest: F.Column | None = None) -> F.Column:
    """Poisson(1) resampling weight of a row in replicate ``rep``: the inverse CDF of a
    uniform read from the row's md5 (four 32-bit uniforms per digest), so every engine
    that has md5 draws the same weights.  ``digest`` may pass a precomputed md5 column."""
    d = digest if digest is not None else _digest(id_col, rep // 4, seed)
    u = F.conv(F.substring(d, 1 + 8 * (rep % 4), 8), 16, 10).cast("long") / F.lit(4294967296.0)
    return sum((F.when(u >= F.lit(c), 1).otherwise(0) for c in poisson_cdf()), F.lit(0)).cast("double")


def poisson_bootstrap_ci(df: DataFrame, *, id_col: str, label: str = "label", score: str = "score",
                         by: Sequence[str] = (), thr: float = fixed.THRESHOLD, replicates: int = 20,
                         seed: int = 42, alpha: float = 0.05) -> DataFrame:
    """EVL-3, hash-seeded variant: Poisson(1) weights per (row, replicate) from md5, all
    replicates summed in ONE pass (``replicates`` x 6 weighted sums per group; rows are
    never copied), then accuracy, recall, precision (0 when empty) and Brier per replicate
    and interpolated percentile intervals over the replicates.  Rows (by..., metric,
    ci_lower, ci_upper).  ROC AUC is left to ``bootstrap_ci`` (it needs a ladder per
    replicate)."""
    by = list(by)
    one = lambda e: F.when(e, 1.0).otherwise(0.0)
    base = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    # row indicators and one md5 per four replicates, computed once per row in a projection
    # (the weights below read these columns instead of re-hashing in every aggregate)
    nd = (replicates + 3) // 4
    rows = base.select(*by, one(F.col(label) == 1).alias("_y"), one(F.col(score) >= thr).alias("_yh"),
                       ((F.col(score) - F.col(label)) * (F.col(score) - F.col(label))).alias("_sq"),
                       *[_digest(id_col, b, seed).alias(f"_h{b}") for b in range(nd)])
    rows = rows.select(*by, "_y", "_yh", "_sq",
                       (F.col("_y") * F.col("_yh") + (1 - F.col("_y")) * (1 - F.col("_yh"))).alias("_ok"),
                       (F.col("_y") * F.col("_yh")).alias("_tp"),
                       *[poisson_weight(id_col, r, seed, F.col(f"_h{r // 4}")).alias(f"_w{r}")
                         for r in range(replicates)])
    aggs = []
    for r in range(replicates):
        w = F.col(f"_w{r}")
        aggs += [F.sum(w).alias(f"n{r}"), F.sum(w * F.col("_ok")).alias(f"c{r}"),
                 F.sum(w * F.col("_tp")).alias(f"tp{r}"), F.sum(w * F.col("_y")).alias(f"p{r}"),
                 F.sum(w * F.col("_yh")).alias(f"pp{r}"), F.sum(w * F.col("_sq")).alias(f"se{r}")]
    wide = rows.groupBy(*by).agg(*aggs)
    reps = F.array(*[F.struct(F.lit(r).alias("r"), *[F.col(f"{k}{r}").alias(k) for k in
                                                     ("n", "c", "tp", "p", "pp", "se")])
                     for r in range(replicates)])
    long = wide.select(*by, F.explode(reps).alias("x")).select(*by, "x.*")
    m = long.select(*by, "r",
                    F.try_divide(F.col("c"), F.col("n")).alias("Accuracy"),
                    F.when(F.col("p") == 0, 0.0).otherwise(F.try_divide(F.col("tp"), F.col("p"))).alias("Recall"),
                    F.when(F.col("pp") == 0, 0.0).otherwise(F.try_divide(F.col("tp"), F.col("pp"))).alias("Precision"),
                    F.try_divide(F.col("se"), F.col("n")).alias("Brier Score Loss"))
    vals = m.unpivot(by + ["r"], POISSON_METRICS, "metric", "v")
    return vals.groupBy(*by, "metric").agg(F.percentile("v", alpha / 2).alias("ci_lower"),
                                           F.percentile("v", 1 - alpha / 2).alias("ci_upper"))

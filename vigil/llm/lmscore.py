"""Language-model scoring: a log-bilinear model trained in NumPy with noise-contrastive estimation.

Tokens are words and one end per text.  Spark counts every training token; the counts are a table that
grows with the corpus and never leaves the executors.  Only three bounded pieces go out: the
``head`` most frequent words and the counts of at most the ``wide`` most frequent ones, and sums per class.

The model predicts symbols: head words, the end, and for all other words the class of their last two
bytes; within a class a word has its add-one share of the class's training tokens.  So the
probabilities of all words add up to one.  The two symbols before predict the next one: their vectors, each
through the matrix of its place, add up to a vector whose product with a symbol's output vector, plus a
bias, is the symbol's energy.  Tasks train on their own texts with noise-contrastive estimation (noise from the
symbols' frequencies, shared by a minibatch, so that all steps are matrix products) and their
parameters are averaged by tokens seen; ``rounds`` such rounds go over disjoint shares of the training
texts, each starting from the last average.

Scoring normalises exactly: log Z is found once for each distinct context of a batch by matrix products.
Words beyond the wide table meet their counts in a join; as none of them is frequent, no key is hot.

Defined results: a null or empty text is one end token; rows with a null id are training rows; repeated
rows are scored each; with no training text every word is unknown and the model is that of no counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import sent, written
from .words import LOWER, mix, slices, words

CLASSES = 64
PLACES = 2
END = np.uint64(0x0E4D)  # the end's hash; no word is expected to have it
BATCH = 2048
SLICE = 8 << 20


@dataclass
class Vocabulary:
    """Symbols: head words, then the end, then classes; the begin mark is one more input symbol."""
    wide: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # hashes, sorted
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    symbol: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of a wide word, -1 for its class
    n_head: int = 0
    class_mass: np.ndarray = field(default_factory=lambda: np.ones(CLASSES))  # tokens + words + 1
    share: np.ndarray = field(default_factory=lambda: np.ones(CLASSES + 1))  # training tokens per symbol
    tokens: int = 0
    types: int = 0
    ends: int = 0

    @property
    def size(self) -> int:
        return self.n_head + 1 + CLASSES


@dataclass
class Parameters:
    inputs: np.ndarray   # (symbols + 1) x d
    outputs: np.ndarray  # symbols x d
    bias: np.ndarray
    places: np.ndarray   # PLACES x d x d

    def flat(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in (self.inputs, self.outputs, self.bias, self.places)])

    def like(self, flat: np.ndarray) -> Parameters:
        out, at = [], 0
        for x in (self.inputs, self.outputs, self.bias, self.places):
            out.append(flat[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Parameters(*out)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, class, where each text's tokens begin); an end's class is 0."""
    h, start, end, at = words(data, offsets)
    low = LOWER[data]
    two = low[end - 1].astype(np.uint64) << np.uint64(8) | np.where(end - start > 1, low[np.maximum(end - 2, 0)], 0).astype(np.uint64)
    cls = (mix(two + np.uint64(1)) % np.uint64(CLASSES)).astype(np.int64)
    bounds = at + np.arange(len(at))
    hashes, classes = np.full(int(bounds[-1]), END, np.uint64), np.zeros(int(bounds[-1]), np.int64)
    place = np.ones(len(hashes), bool)
    place[bounds[1:] - 1] = False
    hashes[place], classes[place] = h, cls
    return hashes, classes, bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, _, data, offsets in slices(b.column(0), SLICE):
            h, cls, _ = tokens(data, offsets)
            u, first, n = np.unique(h, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(cls[first].astype(np.int32)), pa.array(n)], names=["h", "cls", "n"])


def _symbols(v: Vocabulary, h: np.ndarray, cls: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, count or -1 beyond the wide table, context: two earlier symbols) of each token."""
    at = np.minimum(np.searchsorted(v.wide, h), max(len(v.wide) - 1, 0))
    known = v.wide[at] == h if len(v.wide) else np.zeros(len(h), bool)
    count, symbol = np.full(len(h), -1, np.int64), np.full(len(h), -1, np.int64)
    count[known], symbol[known] = v.counts[at[known]], v.symbol[at[known]]
    symbol = np.where(symbol < 0, v.n_head + 1 + cls, symbol)
    ends = bounds[1:] - 1
    symbol[ends], count[ends] = v.n_head, v.ends
    context = np.full((len(h), PLACES), v.size, np.int64)
    for p in range(PLACES):
        context[p + 1:, p] = symbol[:-p - 1]
        for q in range(p + 1):  # nothing before a text's start
            first = bounds[:-1] + q
            context[first[first < bounds[1:]], p] = v.size
    return symbol, count, context


def _predicted(m: Parameters, context: np.ndarray) -> np.ndarray:
    return sum(m.inputs[context[:, p]] @ m.places[p] for p in range(PLACES))


def _scatter(ids: np.ndarray, g: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(ids, g[:, d], size) for d in range(g.shape[1])], axis=1)


class Trainer:
    """Noise-contrastive estimation with AdaGrad steps."""

    def __init__(self, v: Vocabulary, m: Parameters, noise: int, rate: float, seed: int):
        self.v, self.m, self.noise, self.rate = v, m, noise, rate
        self.rng = np.random.default_rng(seed)
        p = (v.share + 1) / (v.share + 1).sum()
        self.cumulative, self.log_noise = np.cumsum(p), np.log(noise * p).astype(np.float32)
        self.squares = [np.full(x.shape, 1e-4, np.float32) for x in (m.inputs, m.outputs, m.bias, m.places)]

    def step(self, target: np.ndarray, context: np.ndarray) -> None:
        m, n = self.m, len(target)
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(self.noise)), self.v.size - 1)
        before = [m.inputs[context[:, p]] for p in range(PLACES)]
        q = sum(b @ c for b, c in zip(before, m.places))
        data = (q * m.outputs[target]).sum(axis=1) + m.bias[target] - self.log_noise[target]
        noise = q @ m.outputs[drawn].T + m.bias[drawn] - self.log_noise[drawn]
        # d loss / d energy: sigmoid - 1 on data, sigmoid on noise
        gd = (-1 / (1 + np.exp(np.clip(data, -30, 30)))) / n
        gn = (1 / (1 + np.exp(-np.clip(noise, -30, 30)))) / n
        gq = gd[:, None] * m.outputs[target] + gn @ m.outputs[drawn]
        go = _scatter(target, gd[:, None] * q, self.v.size)
        np.add.at(go, drawn, gn.T @ q)
        gb = np.bincount(target, gd, self.v.size) + np.bincount(drawn, gn.sum(axis=0), self.v.size)
        gp = np.stack([b.T @ gq for b in before])
        gi = sum(_scatter(context[:, p], gq @ m.places[p].T, self.v.size + 1) for p in range(PLACES))
        for x, s, g in zip((m.inputs, m.outputs, m.bias, m.places), self.squares, (gi, go, gb, gp)):
            s += np.square(g, dtype=np.float32)
            x -= (self.rate * g / np.sqrt(s)).astype(np.float32)


def _train(vocabulary, start, noise: int, rate: float, seed: int):
    """A task's parameters after its texts, each times the tokens seen."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, m, seen = vocabulary(), start(), 0
        trainer = Trainer(v, m.like(m.flat().copy()), noise, rate, seed)
        for b in batches:
            for _, _, data, offsets in slices(b.column(0), SLICE):
                symbol, _, context = _symbols(v, *tokens(data, offsets))
                order = np.random.default_rng(seed).permutation(-(-len(symbol) // BATCH))
                for i in order * BATCH:
                    trainer.step(symbol[i:i + BATCH], context[i:i + BATCH])
                seen += len(symbol)
        if seen:
            flat = trainer.m.flat().astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * seen),
                                              pa.array(np.full(len(flat), float(seen)))], names=["i", "x", "w"])
    return run


def _score(vocabulary, parameters):
    """A row per text (``h`` null) and a row per token beyond the wide table (only ``rid`` and ``h``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, m = vocabulary(), parameters()
        for b in batches:
            for i, j, data, offsets in slices(b.column(1), SLICE):
                h, cls, bounds = tokens(data, offsets)
                symbol, count, context = _symbols(v, h, cls, bounds)
                key, which = np.unique(context[:, 0] * (v.size + 1) + context[:, 1], return_inverse=True)
                q = _predicted(m, np.stack([key // (v.size + 1), key % (v.size + 1)], axis=1))
                log_z = np.zeros(len(key))
                for lo in range(0, len(key), 4096):
                    e = q[lo:lo + 4096] @ m.outputs.T + m.bias
                    top = e.max(axis=1, keepdims=True)
                    log_z[lo:lo + 4096] = np.log(np.exp(e - top).sum(axis=1, dtype=np.float64)) + top[:, 0]
                log_p = np.zeros(len(h))
                for lo in range(0, len(h), 1 << 18):
                    part = slice(lo, lo + (1 << 18))
                    log_p[part] = (q[which[part]] * m.outputs[symbol[part]]).sum(axis=1) + m.bias[symbol[part]]
                log_p = (log_p - log_z[which]) / np.log(10)
                share = np.log10(np.maximum(count, 0) + 1.0)  # 0 for the tail, whose counts the join adds
                in_class = symbol > v.n_head
                log_p[in_class] += share[in_class] - np.log10(v.class_mass[symbol[in_class] - v.n_head - 1])
                tail = np.flatnonzero(count < 0)
                owner = np.searchsorted(bounds, tail, "right") - 1
                rid = b.column(0).to_numpy()[i:j]
                n = j - i
                known = np.add.reduceat((count > 0).astype(np.int64), bounds[:-1])
                none = np.zeros(len(tail))
                rows = {"rid": np.concatenate([rid, rid[owner]]),
                        "h": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(h[tail].view(np.int64))]),
                        "row": pa.array(np.concatenate([np.arange(i, j), none]).astype(np.int64), mask=np.arange(n + len(tail)) >= n),
                        "n_tokens": np.concatenate([np.diff(bounds), none]).astype(np.int64),
                        "n_known": np.concatenate([known, none]).astype(np.int64),
                        "base": np.concatenate([np.add.reduceat(share, bounds[:-1]), none]),
                        "score": np.concatenate([np.add.reduceat(log_p, bounds[:-1]), none])}
                take = rows.pop("row")
                id_col = b.column(2).take(take)
                yield pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in rows.values()] + [id_col],
                                                 names=[*rows, "id"])
    return run


def vocabulary(counts: DataFrame, head: int, wide: int) -> Vocabulary:
    """The bounded pieces of the counts table (h, cls, n)."""
    end = int(END)
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                      F.coalesce(F.sum(F.when(F.col("h") == end, F.col("n"))), F.lit(0)).alias("ends")).first()
    if not size["n"]:
        return Vocabulary()
    # the most frequent words, cut at a step of counts (a sixteenth of a doubling) so that only those
    # words leave the executors, not each task's candidates; below the cut the join takes over
    own = counts.where(F.col("h") != end).withColumn("step", F.floor(16 * F.log2("n")))
    steps = sorted(own.groupBy("step").count().collect(), key=lambda r: -r["step"])
    reach = list(accumulate(r["count"] for r in steps))
    taken = [r["step"] for r, n in zip(steps, reach) if n <= wide]
    top = own.where(F.col("step") >= (taken[-1] if taken else steps[0]["step"] + 1 if steps else 0)).toPandas()
    top = top.sort_values(["n", "h"], ascending=[False, True], ignore_index=True)
    mass = own.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    n[mass["cls"]], v[mass["cls"]] = mass["n"], mass["v"]
    chosen = top.iloc[:head]
    np.subtract.at(n, chosen["cls"].to_numpy(), chosen["n"].to_numpy())
    np.subtract.at(v, chosen["cls"].to_numpy(), 1)
    symbol = np.where(np.arange(len(top)) < head, np.arange(len(top)), -1)
    hashes = top["h"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], top["n"].to_numpy()[order], symbol[order], len(chosen), n + v + 1,
                      np.concatenate([chosen["n"].to_numpy(), [size["ends"]], n]).astype(float), size["n"], size["v"], size["ends"])


def train(texts: DataFrame, v: Vocabulary, dim: int = 16, noise: int = 64, rate: float = 0.1, rounds: int = 2) -> Parameters:
    """Average parameters after ``rounds`` rounds over ``texts`` (t binary, part long)."""
    spark = texts.sparkSession
    rng = np.random.default_rng(1)
    p = (v.share + 1) / (v.share + 1).sum()
    draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    m = Parameters(draw(v.size + 1, dim), draw(v.size, dim), np.log(p).astype(np.float32),
                   np.stack([np.eye(dim, dtype=np.float32)] * PLACES))
    given = sent(spark, v)
    for r in range(rounds):
        share = texts.where(F.pmod(F.col("part"), F.lit(rounds)) == r).select("t")
        mean = (share.mapInArrow(_train(given, sent(spark, m), noise, rate, r), "i int, x double, w double")
                .groupBy("i").agg((F.sum("x") / F.sum("w")).alias("x")).toPandas())
        if len(mean):
            flat = m.flat()
            flat[mean["i"]] = mean["x"]
            m = m.like(flat)
    return m


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", head: int = 512, wide: int = 65536,
          dim: int = 16, rounds: int = 2) -> DataFrame:
    """One row per row of ``docs``: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigram) and ``score`` (the model), both log10 of the text's probability."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))
    learnt = rows.where(~F.col("held_out")).select("t", F.xxhash64("id").alias("part"))
    counts = written(learnt.select("t").mapInArrow(_count, "h bigint, cls int, n bigint")
                     .groupBy("h").agg(F.min("cls").alias("cls"), F.sum("n").alias("n")), "token-counts")
    v = vocabulary(counts, head, wide)
    m = train(learnt, v, dim, rounds=rounds)
    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.select(F.xxhash64("id", "t").alias("rid"), "t", F.struct("id", "held_out").alias("id"))
    made = written(out.mapInArrow(_score(sent(spark, v), sent(spark, m)),
                                  f"rid bigint, h bigint, n_tokens bigint, n_known bigint, base double, score double, id struct<id:{kind},held_out:boolean>"), "scores")
    tail = made.where("h is not null").select("rid", "h").join(counts.select("h", "n"), "h")
    tail = tail.groupBy("rid").agg(F.sum(F.log10(F.col("n") + 1)).alias("more"), F.count("*").alias("found"))
    # equal rows share a rid: their tails are added up, so each has its share
    texts = made.where("h is null").groupBy("rid", "id", "n_tokens", "n_known", "base", "score").agg(F.count("*").alias("copies"))
    each = F.coalesce(F.col("more") / F.col("copies"), F.lit(0.0))
    return (texts.join(tail, "rid", "left").select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_")).select(
        F.col("id.id").alias(id_col), F.col("id.held_out").alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce((F.col("found") / F.col("copies")).cast("bigint"), F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + each - F.col("n_tokens") * F.lit(float(np.log10(v.tokens + v.types + 1)))).alias("base_score"),
        (F.col("score") + each).alias("score")))

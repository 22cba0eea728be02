"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

A benchmark item of L words is compared with the windows of L words of every document, as multisets
of word shingles: similarity is the sum of the smaller counts over the sum of the larger ones.  A
window reaches the threshold only if 2t/(1+t) of its shingles are shingles of items of that
length, so only such windows are fingerprinted.  The fingerprint is the 64-bit SimHash of the
window's shingles, weighted by their counts.  Items stand in one table per 8-bit block; of two
fingerprints within ``radius`` some block differs in at most radius // 8 bits, so probing all such
neighbours of all blocks finds every item within the radius.  Candidates are verified on the counts.
At similarity 0.8 a fingerprint differs in 10 of 64 bits on average (deviation 2.9); the default radius
is 24, where a miss has a chance of 1e-6.

The benchmark goes out to the workers in blocks of at most about ``block_bytes`` of text, each found by
a hash of the item, as many as it needs; documents are never shuffled.

Defined results: null or empty texts on either side match nothing; an item or a document under ``k`` words
is one shingle, so such an item matches only whole documents; a document shorter than an item is one
window; repeated items give repeated rows, repeated documents too; an item with a null id is
matched like any other.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name, sent
from .words import shingles, slices, words

BLOCKS = 8
FOUND = "array<struct<item:string,start:int,n_words:int,common:int,total:int>>"


def _signs(values: np.ndarray) -> np.ndarray:
    """Bits of each 64-bit value as +1 and -1."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """64-bit fingerprints from rows of 64 sums."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").reshape(-1)


class Index:
    """Items of one block of the benchmark, by length in words."""

    def __init__(self, ids: list[str | None], texts: list[bytes], k: int, percent: int, radius: int):
        col = pa.array(texts, pa.binary())
        self.ids, self.k, self.percent, self.radius = ids, k, percent, radius
        self.items: dict[int, Counter] = {}
        self.prints: dict[int, int] = {}
        self.tables: dict[int, list[dict[int, list[int]]]] = {}
        by_length: dict[int, list[np.ndarray]] = {}
        for i, _, data, offsets in slices(col):
            h, _, _, at = words(data, offsets)
            values, bounds = shingles(h, at, k)
            for r in range(len(at) - 1):
                own = values[bounds[r]:bounds[r + 1]]
                if len(own):
                    length = int(at[r + 1] - at[r])
                    by_length.setdefault(length, []).append(own)
                    self.items[i + r] = Counter(own.tolist())
                    self.prints[i + r] = int(_pack(_signs(own).sum(axis=0, keepdims=True))[0])
                    tables = self.tables.setdefault(length, [{} for _ in range(BLOCKS)])
                    for b in range(BLOCKS):
                        tables[b].setdefault(self.prints[i + r] >> 8 * b & 255, []).append(i + r)
        self.lengths = sorted(by_length)
        self.shingles = np.unique(np.concatenate([v for x in by_length.values() for v in x])) if by_length else np.zeros(0, np.uint64)
        self.of_length = np.zeros((len(self.shingles), len(self.lengths)), bool)
        for j, length in enumerate(self.lengths):
            for v in by_length[length]:
                self.of_length[np.searchsorted(self.shingles, v), j] = True
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.shingles >> np.uint64(44)).astype(np.int64)] = True
        near = range(radius // BLOCKS + 1)
        self.flips = [sum(1 << b for b in c) for n in near for c in combinations(range(8), n)]

    def _similar(self, length: int, print_: int, window: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, common, total) of the items of that length that are similar enough."""
        tables = self.tables[length]
        near = {i for b in range(BLOCKS) for f in self.flips for i in tables[b].get(print_ >> 8 * b & 255 ^ f, ())}
        out, counts = [], None
        for i in sorted(near):
            if (self.prints[i] ^ print_).bit_count() <= self.radius:
                counts = counts or Counter(window.tolist())
                common = (counts & self.items[i]).total()
                total = len(window) + self.items[i].total() - common
                if 100 * common >= self.percent * total:
                    out.append((i, common, total))
        return out

    def search(self, values: np.ndarray, n_words: int, hits: np.ndarray, rows: np.ndarray) -> list[tuple]:
        """Best window per item of one document: ``hits`` are the positions of its shingles that
        occur in the benchmark, ``rows`` their rows in ``shingles``."""
        best: dict[int, tuple] = {}
        mine = self.of_length[rows]
        for j in np.flatnonzero(mine.any(axis=0)):
            length = self.lengths[j]
            n = max(1, length - self.k + 1)
            size = min(n, len(values))
            at = hits[mine[:, j]]
            # of equal totals n, common >= 2t / (1 + t) n; a shorter document needs common >= t n
            need = -(-2 * self.percent * n // (100 + self.percent)) if size == n else -(-self.percent * n // 100)
            if len(at) < need:
                continue
            ends = at[need - 1:]
            close = ends - at[:len(ends)] < size
            mark = np.zeros(len(values) - size + 2, np.int32)  # a run of hits fits windows starting in a range
            np.add.at(mark, np.maximum(ends[close] - size + 1, 0), 1)
            np.add.at(mark, np.minimum(at[:len(ends)][close], len(values) - size) + 1, -1)
            starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            for lo in range(0, len(starts), 4096):
                part = starts[lo:lo + 4096]
                a, b = int(part[0]), int(part[-1]) + size
                total = np.zeros((b - a + 1, 64), np.int32)
                np.cumsum(_signs(values[a:b]), axis=0, out=total[1:])
                prints = _pack(total[part - a + size] - total[part - a])
                for s, p in zip(part.tolist(), prints.tolist()):
                    for i, common, all_ in self._similar(length, p, values[s:s + size]):
                        if i not in best or common * best[i][4] > best[i][3] * all_:
                            best[i] = (i, s, min(length, n_words), common, all_)
        return [(self.ids[i], *best[i][1:]) for i in sorted(best)]


def _finder(index, k: int):
    """Column function text -> FOUND; ``index`` gives the Index."""
    @F.arrow_udf(FOUND)
    def find(text: pa.Array) -> pa.Array:
        x = index()
        found, ends = [], [0]
        for i, j, data, offsets in slices(text):
            h, _, _, at = words(data, offsets)
            values, bounds = shingles(h, at, k)
            hits = np.flatnonzero(x.seen[(values >> np.uint64(44)).astype(np.int64)])
            rows = np.searchsorted(x.shingles, values[hits])
            real = rows < len(x.shingles)
            real[real] = x.shingles[rows[real]] == values[hits[real]]
            hits, rows = hits[real], rows[real]
            cut = np.searchsorted(hits, bounds)
            for r in range(j - i):
                if cut[r + 1] > cut[r]:
                    own = slice(cut[r], cut[r + 1])
                    found += x.search(values[bounds[r]:bounds[r + 1]], int(at[r + 1] - at[r]), hits[own] - bounds[r], rows[own])
                ends.append(len(found))
        cols = list(zip(*found)) or [[]] * 5
        rows = pa.StructArray.from_arrays([pa.array(cols[0], pa.string()), *(pa.array(c, pa.int32()) for c in cols[1:])], names=["item", "start", "n_words", "common", "total"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)

    return find


def matches(text: Column, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", k: int = 5,
            percent: int = 80, radius: int = 24, block_bytes: int = 8 << 20) -> Column:
    """array of (item_id, start, n_words, common, total): the best window of ``text`` for each
    benchmark item that it reaches ``percent`` with."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).cast("binary").alias("t"))
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = size // block_bytes + 1
    kind = benchmark.schema[item_col].dataType.simpleString()
    parts = [F.array().cast(FOUND)]
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == b).orderBy("id").collect()
        if own:
            index = sent(spark, Index([r["id"] for r in own], [bytes(r["t"] or b"") for r in own], k, percent, radius))
            parts.append(_finder(index, k)(text.cast("binary")))
    return F.concat(*parts).cast(f"array<struct<item_id:{kind},start:int,n_words:int,common:int,total:int>>")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document and benchmark item found in it: id, ``item_id``, ``start_word`` and
    ``n_words`` of the best window, ``similarity``."""
    found = docs.select(F.col(id_col).alias("_id"), matches(F.col(text_col), benchmark, **how).alias("_m"))
    return (found.where(F.size("_m") > 0).select("_id", F.explode("_m").alias("m"))
            .select(F.col("_id").alias(id_col), F.col("m.item_id").alias("item_id"), F.col("m.start").alias("start_word"),
                    F.col("m.n_words").alias("n_words"), (F.col("m.common") / F.col("m.total")).alias("similarity")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with all their columns (of any name)."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    found = free_name("_matches", docs)
    return docs.select(*names, matches(F.col(text_col), benchmark, **how).alias(found)).where(F.size(found) == 0).select(*names)

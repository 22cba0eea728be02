"""Variable-capacity best-fit packing of documents into training sequences.

Every text is cut into pieces of at most the largest permitted length (nothing is dropped), and the
pieces are packed longest first: a piece goes to the open bin with the least room that holds it, and
when there is none a new bin is opened of the size whose cost per packed token is least for such
pieces.  At the end every bin shrinks to the smallest permitted size that holds its contents.

Pieces of one length are interchangeable, so the packing is decided on the histogram of lengths, whose
size the largest permitted length bounds, for all documents at once: bins with the same room form a
range of numbers, and each decision ("pieces 500 to 900 of length 37 go, 3 each, to bins 120 to 253")
is one row of a plan.  Spark ranks the pieces of each length (in salted shares, with offsets from the
histogram per share, so that no length is one task) and joins them to the plan.

Defined results: a null or empty text, or one of blanks, makes one piece that holds only its end token;
repeated rows are packed as often as they occur; an empty table gives no bins.  Extra columns are
not read.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import sent, written
from .words import IS_SPACE, slices

CAPACITIES = (512, 1024, 2048, 4096)


def _word_counter():
    @F.arrow_udf("bigint")
    def word_count(text: pa.Array) -> pa.Array:
        out = []
        for _, _, data, offsets in slices(text):
            gap = np.ones(len(data) + 1, bool)
            gap[1:] = IS_SPACE[data]
            start = ~gap[1:] & gap[:-1]
            first = offsets[:-1][offsets[:-1] < len(data)]
            start[first] = ~gap[first + 1]
            total = np.concatenate([[0], np.cumsum(start)])
            out.append(total[offsets[1:]] - total[offsets[:-1]])
        return pa.array(np.concatenate(out) if out else [], pa.int64())

    return word_count


def opening_size(length: int, capacities: tuple[int, ...], bin_cost: int) -> int:
    """The permitted size whose cost (its tokens and ``bin_cost``) per packed token is least when
    filled with pieces of this length; the smaller one on ties."""
    return min((c for c in capacities if c >= length), key=lambda c: ((c + bin_cost) / (c // length * length), c))


def plan(histogram: dict[int, int], capacities: tuple[int, ...], bin_cost: int) -> tuple[list[tuple], list[tuple]]:
    """(placements, bins): placements (length, first piece, end piece, pieces per bin, first bin, room
    of those bins before), bins (first bin, end bin, opened size, room left)."""
    rooms: list[int] = []  # sorted; open bins with that room are at ranges[room]
    ranges: dict[int, list[tuple[int, int, int]]] = {}

    def put(room: int, a: int, b: int, size: int) -> None:
        if room not in ranges:
            bisect.insort(rooms, room)
        ranges.setdefault(room, []).append((a, b, size))

    placed, bins, next_bin = [], [], 0
    for length in sorted(histogram, reverse=True):
        done, n = 0, histogram[length]

        def fill(room: int, a: int, b: int, size: int) -> None:
            nonlocal done
            per = room // length
            full = min(b - a, (n - done) // per)
            if full:
                placed.append((length, done, done + full * per, per, a, room))
                done += full * per
                put(room - per * length, a, a + full, size)
            if a + full < b and done < n:
                left = n - done
                placed.append((length, done, n, left, a + full, room))
                done = n
                put(room - left * length, a + full, a + full + 1, size)
                full += 1
            if a + full < b:
                put(room, a + full, b, size)

        while done < n and (at := bisect.bisect_left(rooms, length)) < len(rooms):
            room = rooms.pop(at)
            for a, b, size in ranges.pop(room):
                fill(room, a, b, size)
        if done < n:
            size = opening_size(length, capacities, bin_cost)
            count = -(-(n - done) // (size // length))
            next_bin += count
            fill(size, next_bin - count, next_bin, size)
    for room, parts in ranges.items():
        bins += [(a, b, size, room) for a, b, size in parts]
    return placed, sorted(bins)


def pieces(docs: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """(id, n_words, piece_no, start_token, n_tokens): each text's words and its end token, cut."""
    total = _word_counter()(F.col(text_col).cast("binary")) + 1
    out = docs.select(F.col(id_col).alias("id"), total.alias("n"))
    out = out.select("id", "n", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / most).cast("int"))).alias("piece_no"))
    start = F.col("piece_no").cast("bigint") * most
    return out.select("id", "piece_no", start.alias("start_token"), F.least(F.lit(most), F.col("n") - start).cast("int").alias("n_tokens"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities: tuple[int, ...] = CAPACITIES,
         bin_cost: int = 64, share: int = 100_000) -> DataFrame:
    """One row per piece: id, ``piece_no``, ``start_token``, ``n_tokens``, ``bin_id``, ``bin_capacity``,
    ``bin_offset`` (tokens before it in the bin)."""
    capacities = tuple(sorted(capacities))
    spark = docs.sparkSession
    # the piece length and the salted share are fixed by the row; a share holds about ``share`` pieces of a length
    cut = written(pieces(docs, id_col, text_col, capacities[-1]), "pieces")
    most = cut.groupBy("n_tokens").count().agg(F.max("count")).first()[0] or 0
    salt = F.pmod(F.xxhash64("id", "piece_no"), F.lit(most // share + 1))
    cut = cut.withColumn("salt", salt)
    shares = cut.groupBy("n_tokens", "salt").count()
    before = Window.partitionBy("n_tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("n_tokens", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("n_tokens", "salt").orderBy("id", "piece_no")
    ranked = (cut.withColumn("rank", F.row_number().over(order) - 1).join(shares, ["n_tokens", "salt"])
              .select("id", "piece_no", "start_token", "n_tokens", (F.col("rank") + F.col("before")).alias("rank")))
    histogram = {r["n_tokens"]: r["count"] for r in cut.groupBy("n_tokens").count().collect()}
    placed, bins = plan(histogram, capacities, bin_cost)
    # one row per length: its placements in order of rank, to be searched
    steps: dict[int, list[tuple]] = {}
    for length, first, last, per, a, room in placed:
        steps.setdefault(length, []).append((first, per, a, room))
    final = [next(c for c in capacities if c >= size - room) for _, _, size, room in bins]
    shared = sent(spark, (
        {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in steps.items()},
        np.array([b[0] for b in bins], np.int64), np.array([b[2] for b in bins], np.int64), np.array(final, np.int64)))

    @F.arrow_udf("struct<bin_id:bigint,bin_capacity:int,bin_offset:int>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        by_length, first_bin, opened, shrunk = shared()
        lengths, ranks = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        out = np.zeros((3, len(lengths)), np.int64)
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            first, per, a, room = by_length[int(n)]
            k = np.searchsorted(first, ranks[rows], "right") - 1
            within = ranks[rows] - first[k]
            bin_id = a[k] + within // per[k]
            b = np.searchsorted(first_bin, bin_id, "right") - 1
            out[:, rows] = bin_id, shrunk[b], opened[b] - room[k] + within % per[k] * n
        return pa.StructArray.from_arrays([pa.array(out[0]), pa.array(out[1].astype(np.int32)), pa.array(out[2].astype(np.int32))],
                                          names=["bin_id", "bin_capacity", "bin_offset"])

    out = ranked.select("id", "piece_no", "start_token", "n_tokens", place("n_tokens", "rank").alias("p"))
    return out.select(F.col("id").alias(id_col), "piece_no", "start_token", "n_tokens", "p.bin_id", "p.bin_capacity", "p.bin_offset")

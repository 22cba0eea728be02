"""Source divergence audit: how far the sources of a language part in their word use, and by which terms.

Chunk factorisation.  A term never holds white space, so a text's terms are those of its white-space chunks.
The documents are dealt by ranges of (lang, source, hash of the text), so that a task counts for few groups and a hot
source has many tasks.  A task cuts its texts into blocks; a block numbers its distinct chunks, each of these is
tokenised once, and a text is read as its chunks' numbers.  One sort of (group, term, document) then gives a
block's occurrences and documents of every term of a group.  A document lies in one block, so both add up over
blocks and tasks, exactly; a task adds up its blocks before anything is shuffled, so a frequent term is one row per
group and task.

Probabilities are integers: p = 1 + floor(1e9 (count + 5) / (N + 5 V)) over the V terms that a language
keeps, N the kept occurrences; the arithmetic is exact (decimals of 38 digits in Spark, 64-bit integers
below 2e9 (1 + terms) in NumPy).  The distance of two sources is the sum of |p - p'| over all kept terms.  A term that neither
holds adds the difference of the two sources' floors, so only terms that occur are laid out, in tiles of
at most ``TILE`` by ``TILE`` sources and about ``TERMS_PER_TASK`` terms.

Defined results: every row is a document, repeated rows and rows with a null id included; null text, lang or
source is ''; an empty or term-free text still makes its (lang, source) group; a language without kept
terms has distances of 0 and no term rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written
from .words import IS_SPACE, LOWER, slices

#: Rows that a task holds before it hands them on, and bits of text in a block (a longer text is a block of its own).
HELD_CHUNKS, BITS = 1 << 19, 1 << 25
#: Sources on one side of a tile of pairs, and kept terms (about) per task of the distances.
TILE, TERMS_PER_TASK = 128, 2_000
SCALE, ADDED = 1_000_000_000, 5
#: Bytes of terms: A-Z, a-z and all of characters beyond ASCII.
IS_TERM = np.ones(256, bool)
IS_TERM[:65] = IS_TERM[91:97] = IS_TERM[123:128] = False
BLANK = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))


def _starts(inside: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where runs of ``inside`` start; a run ends at each of the ``bounds`` too."""
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[bounds] = inside[bounds]
    return start


def _numbered(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each of the byte strings that lie end to end in ``data``, and the distinct ones by number."""
    values = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    values = values.dictionary_encode()
    return values.indices.to_numpy(), values.dictionary


def _chunk_terms(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Term numbers of the distinct chunks in turn, where each chunk's end, and the distinct terms by number."""
    bounds = np.frombuffer(chunks.buffers()[1], np.int64)[:len(chunks) + 1]
    data = np.frombuffer(chunks.buffers()[2], np.uint8)[:bounds[-1]]
    inside = IS_TERM[data]
    start = _starts(inside, bounds[:-1])
    term, terms = _numbered(LOWER[data[inside]], np.append(np.flatnonzero(start[inside]), np.count_nonzero(inside)))
    return term, np.searchsorted(np.flatnonzero(start), bounds[1:]), terms


def _block(lang: pa.Array, source: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.Table:
    """A block's (lang, source, term, n, docs), and a row without term for each of its (lang, source)."""
    lang, source = lang.dictionary_encode(), source.dictionary_encode()
    many = max(len(source.dictionary), 1)
    groups, group = np.unique(lang.indices.to_numpy().astype(np.int64) * many + source.indices.to_numpy(), return_inverse=True)
    # a chunk is taken with the blanks behind it, so chunks lie end to end
    at = np.flatnonzero(_starts(~IS_SPACE[data], offsets[:-1][offsets[:-1] < len(data)]))
    n, docs, row_group, row_term, terms = (np.zeros(0, np.int64),) * 4 + (pa.array([], pa.large_binary()),)
    if len(at):
        chunk, chunks = _numbered(data[at[0]:], np.append(at, len(data)) - at[0])
        term, end, terms = _chunk_terms(chunks)
        size = np.diff(end, prepend=0)[chunk]
        found = term[np.repeat(end[chunk] - np.cumsum(size), size) + np.arange(size.sum())]
        doc = np.repeat(np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(at, offsets))), size)
        bits, many_terms = len(offsets).bit_length(), max(len(terms), 1)
        key = (group[doc] * many_terms + found) << bits | doc
        key.sort()
        fresh = np.diff(key, prepend=-1) != 0
        key >>= bits
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n, docs = np.diff(first, append=len(key)), np.diff(np.cumsum(fresh)[first], append=np.count_nonzero(fresh) + 1)
        row_group, row_term = np.divmod(key[first], many_terms)
    none = np.zeros(len(groups), np.int64)
    of = groups[np.concatenate([row_group, np.arange(len(groups))])]
    return pa.table({"lang": lang.dictionary.take(pa.array(of // many)), "source": source.dictionary.take(pa.array(of % many)),
                     "term": pa.concat_arrays([terms.take(pa.array(row_term)).cast(pa.binary()), pa.nulls(len(groups), pa.binary())]),
                     "n": np.concatenate([n, none]), "docs": np.concatenate([docs, none])})


def _added(tables: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.rename_columns(["lang", "source", "term", "n", "docs"])


def term_uses(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in a group, added up within each task;
    every (lang, source) has a row without term too."""
    most, block = HELD_CHUNKS, BITS // 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(2), block):
                held.append(_block(batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), data, offsets))
                if sum(map(len, held)) > most:
                    held = [_added(held)]
                    if len(held[0]) > most // 2:
                        yield from held.pop().to_batches()
        if held:
            yield from _added(held).to_batches()

    dealt = docs.repartitionByRange("lang", "source", F.xxhash64("text"))
    return dealt.mapInArrow(run, "lang string, source string, term binary, n long, docs long")


def term_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, count, lang_count) of the terms that ``min_docs`` documents of the language hold, and the rows without term."""
    w = Window.partitionBy("lang", "term")
    # one exchange serves the counts of a group and of its language
    sums = term_uses(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("count"), F.sum("docs").alias("docs"))
    return (sums.select("*", F.sum("count").over(w).alias("lang_count"), F.sum("docs").over(w).alias("lang_docs"))
            .where(F.col("term").isNull() | (F.col("lang_docs") >= min_docs))
            .select("lang", "source", F.col("term").cast("string").alias("term"), "count", "lang_count"))


def _p(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(1e9 (count + 5) / (total + 5 kept)), 0 without kept terms."""
    big = lambda c: c.cast("decimal(19,0)")
    share = F.call_function("div", big(F.lit(SCALE)) * big(count + ADDED), F.nullif(big(total + ADDED * kept), big(F.lit(0))))
    return F.when(kept > 0, share + 1).otherwise(F.lit(0)).cast("long")


def _tile(left: dict, right: dict, terms: dict, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of |p - p'| less the difference of the floors, over a tile's terms, for pairs (left, right)."""
    def laid_out(side):
        m = np.repeat(side["floor"][:, None], terms["n"], 1)
        m[side["row"], side["col"]] = side["p"]
        return m
    a = laid_out(left)
    b = a if same else laid_out(right)
    floor_a, floor_b = left["floor"], right["floor"]
    out = np.empty((len(a), len(b)), np.int64)
    for i in range(len(a)):
        out[i] = np.abs(b - a[i]).sum(axis=1) - terms["n"] * np.abs(floor_b - floor_a[i])
    return out


PAIR_SUMS = "lang string, source string, other string, over long"


def _pair_sums(key, terms: pa.Table, sources: pa.Table) -> pa.Table:
    """One tile of source pairs over one share of the terms: both orders of every pair."""
    lang, _, a, b = (k.as_py() for k in key)
    number = sources.column("number").to_numpy()
    at = np.argsort(number)
    number, floors = number[at], sources.column("floor").to_numpy()[at]
    names = np.array(sources.column("source").to_pylist(), object)[at]
    codes = terms.column("term").combine_chunks().dictionary_encode()
    codes = codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes
    col, row, p = codes.indices.to_numpy(zero_copy_only=False), terms.column("number").to_numpy(), terms.column("p").to_numpy()

    def side(tile):
        lo, hi = np.searchsorted(number, [tile * TILE, (tile + 1) * TILE])
        mine = (row >= tile * TILE) & (row < (tile + 1) * TILE)
        return {"floor": floors[lo:hi], "row": row[mine] - tile * TILE, "col": col[mine], "p": p[mine]}, names[lo:hi]

    (left, left_names), (right, right_names) = side(a), side(b)
    over = _tile(left, right, {"n": len(codes.dictionary)}, a == b)
    i, j = np.nonzero(np.ones(over.shape, bool) if a != b else ~np.eye(len(over), dtype=bool))
    s, o, v = left_names[i], right_names[j], over[i, j]
    if a != b:
        s, o, v = np.concatenate([s, o]), np.concatenate([o, s]), np.concatenate([v, v])
    return pa.table({"lang": pa.array([lang] * len(v), pa.string()), "source": pa.array(s, pa.string()),
                     "other": pa.array(o, pa.string()), "over": pa.array(v, pa.int64())})


def divergence(docs: DataFrame, *, min_docs: int = 30, top_terms: int = 50, text: str = "text", lang: str = "lang",
               source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has a source's distance to each other source of
    the language, part ``term`` the ``top_terms`` kept terms it uses most above the language."""
    rows = docs.select(BLANK(lang).alias("lang"), BLANK(source).alias("source"), F.make_valid_utf8(F.col(f"`{text}`").cast("string")).cast("binary").alias("text"))
    counted = written(term_counts(rows, min_docs), "term-counts")
    used = counted.where(F.col("term").isNotNull())
    of_lang = used.groupBy("lang").agg(F.countDistinct("term").alias("V"), F.sum("count").alias("lang_N"))
    of_source = used.groupBy("lang", "source").agg(F.sum("count").alias("N"))
    # one row per (lang, source), numbered within the language for the tiles
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    groups = (counted.where(F.col("term").isNull()).select("lang", "source")
              .join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left")
              .select("lang", "source", zero("N"), zero("V"), zero("lang_N")))
    w = Window.partitionBy("lang")
    groups = written(groups.select("*", (F.row_number().over(w.orderBy("source")) - 1).alias("number"),
                                   F.count(F.lit(1)).over(w).alias("sources"), _p(F.lit(0), F.col("N"), F.col("V")).alias("floor")), "sources")

    p = used.join(groups, ["lang", "source"]).withColumns({
        "p": _p(F.col("count"), F.col("N"), F.col("V")), "q": _p(F.col("lang_count"), F.col("lang_N"), F.col("V"))})
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = (p.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                                     (F.col("p") - F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms))

    shares = (1 + F.floor(F.col("V") / TERMS_PER_TASK)).cast("long")
    tiles = F.floor((F.col("sources") - 1) / TILE)
    mine = F.floor(F.col("number") / TILE)
    both = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), tiles.cast("long")),
                                 lambda t: F.struct(F.least(t, mine).alias("a"), F.greatest(t, mine).alias("b"))))
    cells = p.where(F.col("sources") > 1).select("lang", "term", "number", "p", F.pmod(F.xxhash64("term"), shares).alias("share"), both.alias("tile"))
    every = (groups.where(F.col("sources") > 1).withColumn("tile", both)
             .select("lang", "source", "number", "floor", "tile", F.explode(F.sequence(F.lit(0).cast("long"), shares - 1)).alias("share")))
    fresh = lambda d: d.select(*[F.col(c).alias(c) for c in d.columns])  # noqa: E731  (both sides come from ``groups``)
    key = lambda d: fresh(d.select("*", "tile.a", "tile.b").drop("tile")).groupBy("lang", "share", "a", "b")
    over = (key(cells).cogroup(key(every))
            .applyInArrow(_pair_sums, PAIR_SUMS))
    sums = over.groupBy("lang", "source", "other").agg(F.sum("over").alias("over"))
    mine_, its = groups.select("lang", "source", "V", "floor"), groups.select("lang", F.col("source").alias("other"), F.col("floor").alias("other_floor"))
    pairs = (sums.join(mine_, ["lang", "source"]).join(its, ["lang", "other"])
             .select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"),
                     (F.col("over") + F.col("V") * F.abs(F.col("floor") - F.col("other_floor"))).alias("value"))
             .withColumn("rank", F.row_number().over(by_value)))
    return pairs.unionByName(terms)

"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find grouping.

Signatures.  Each distinct shingle seeds a stream of random numbers that both ranks it and walks a
random permutation of the signature's places (one Fisher-Yates step per round), so a shingle's ranks
are correlated and every round fills places evenly.  A text stops as soon as no later round can
lower any place.  Rounds run over all shingles of a batch at once.

Banding.  Texts with the same shingle set form one class and only its smallest id goes on, so copies
cost one row each.  ``bands`` x ``rows`` values per signature; at similarity 0.8 the chance that no band of
4 agrees in 32 is 5e-8.  Sets under four shingles cannot be similar at 0.8 without being equal.

Verification without all pairs.  In each bucket the smallest id (the hub) meets all others of suitable
size; links are confirmed on the full shingle sets and merged to groups.  Texts of buckets that still
hold several groups (often texts that share one long passage, half alike) are dealt anew by their rarest
shingles: two sets of the wanted similarity share a shingle among their n - ceil(percent n) + 1 rarest,
whatever else they have in common, and from the place of the first one they share in each text's order
follows the most they can share, so pairs that fall short are never made.  In these finer buckets hubs
(first the texts with the fewest rare shingles before the key) meet all others that are not yet in their group and then leave;
buckets that still hold several groups take 64 times as many hubs in the next round, until none is
left.  So a pair of a bucket stays untested only if it can't be similar or a
chain of confirmed links joins it already, and groups come out as if all pairs had been tested.

Grouping.  Links are merged by union-find in shares of bounded size; several forests are then merged by
rounds in which every node points its neighbours at the smallest one it sees (large and small stars),
on tables.

Defined results: a null or empty text, or one of blanks, has no shingles and is linked with nothing; a
text under ``k`` words is one shingle; rows that share an id are one node, each with its own
``n_shingles``, and each distinct set of an id is compared once; a row with a null id is its own group and kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import free_name, written
from .words import distinct, lists, mix, shingles, slices, words

PLACES = 128
#: Links that one union-find holds; more links are shared out and their forests merged by rounds.
LINKS_PER_TASK = 200_000
GOLDEN = 0x9E3779B97F4A7C15


def superminhash(values: np.ndarray, bounds: np.ndarray, places: int = PLACES) -> np.ndarray:
    """Signatures (texts x places) of sets of distinct 64-bit values; a place holds
    (round << 32 | rank), the highest number for an empty set."""
    n = len(bounds) - 1
    sig = np.full(n * places, np.iinfo(np.uint64).max, np.uint64)
    doc = np.repeat(np.arange(n), np.diff(bounds))
    seeds, perm = values, None
    for j in range(places):
        if not len(seeds):
            break
        u = mix(seeds + np.uint64((j + 1) * GOLDEN & 0xFFFFFFFFFFFFFFFF))
        k = j + ((u & np.uint64(0xFFFFFFFF)) * np.uint64(places - j) >> np.uint64(32)).astype(np.int64)
        if perm is None:
            place = k
        else:
            at = np.arange(len(seeds))
            place = perm[at, k].astype(np.int64)
            perm[at, k] = perm[:, j]
        np.minimum.at(sig, doc * places + place, (u >> np.uint64(32)) | np.uint64(j << 32))
        open_doc = sig.reshape(n, places).max(axis=1) >= np.uint64((j + 1) << 32)
        go = open_doc[doc]
        seeds, doc = seeds[go], doc[go]
        if perm is None:
            perm = np.tile(np.arange(places, dtype=np.int16 if places > 128 else np.int8), (len(seeds), 1))
            perm[np.arange(len(seeds)), k[go]] = 0
        else:
            perm = perm[go]
    return sig.reshape(n, places)


def _shingle_sets(text: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, _, data, offsets in slices(text):
        h, _, _, at = words(data, offsets)
        yield distinct(*shingles(h, at, k))


def _digest(values: np.ndarray, at: np.ndarray, salt: int) -> np.ndarray:
    """Order-free digest of each whole set."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values + np.uint64(salt * GOLDEN & 0xFFFFFFFFFFFFFFFF)))])
    return (total[at[1:]] - total[at[:-1]]).view(np.int64)


def _signer(k: int, bands: int, rows: int):
    @F.arrow_udf("struct<n:bigint,a:bigint,b:bigint,bands:array<bigint>>")
    def sign(text: pa.Array) -> pa.Array:
        size, a, b, keys = [], [], [], []
        for values, at in _shingle_sets(text, k):
            n = np.diff(at)
            a.append(_digest(values, at, 1))
            b.append(_digest(values, at, 2))
            sig = superminhash(values, at, bands * rows).reshape(len(n), bands, rows)
            key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(GOLDEN), (len(n), bands)).copy()
            for r in range(rows):
                key = mix(key ^ sig[:, :, r])
            size.append(n)
            keys.append(key.view(np.int64))
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        flat = cat(keys).reshape(-1)
        return pa.StructArray.from_arrays([pa.array(cat(size), pa.int64()), pa.array(cat(a)), pa.array(cat(b)),
                                           lists(flat.view(np.uint64), np.arange(0, len(flat) + 1, bands))], names=["n", "a", "b", "bands"])

    return sign


def _set_maker(k: int):
    @F.arrow_udf("struct<a:bigint,shingles:array<bigint>>")
    def shingle_set(text: pa.Array) -> pa.Array:
        a, parts = [np.zeros(0, np.int64)], [pa.array([], pa.list_(pa.int64()))]
        for v, at in _shingle_sets(text, k):
            a.append(_digest(v, at, 1))
            parts.append(lists(v, at))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(a)), pa.concat_arrays(parts)], names=["a", "shingles"])

    return shingle_set


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over a partition's links: each node with the smallest id of its group."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (p := up.setdefault(x, x)) != x:
            up[x] = x = up[p] if p in up else p
        return x

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    pairs = [(x, top(x)) for x in up if top(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every node of ``links`` (u, v; longs) whose smallest reachable id is another."""
    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    links = written(links, "all-links")
    parts = links.count() // LINKS_PER_TASK + 1
    edges = written(links.coalesce(parts).mapInArrow(_forest, "u bigint, v bigint"), "forest")
    if parts == 1:  # one forest has every node once, under its group's smallest id
        return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    edges = written(edges.distinct(), "forests")
    seen = state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(small.where("u <> v").distinct(), "stars")
        now = state(edges)
        if now == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        seen = now


def _candidates(active: DataFrame, salts: int, round_no: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, hubs) of one round.  ``active``: (key, id, a, n, p, c): a text's id and digest, n shingles, p of
    them before the key, c the id's group so far.  Two texts whose first common key this is share at most n - p shingles."""
    def enough(most: Column, n: Column, other: Column) -> Column:
        return (100 + percent) * most >= percent * (n + other)

    alive = active.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("n").alias("least")).where("lo < hi")
    mine = active.join(alive, "key").where(enough(F.col("n") - F.col("p"), F.col("n"), F.col("least"))).select("key", "id", "a", "n", "p", "c")
    hubs = (mine.groupBy("key", F.pmod(F.xxhash64("id", "a", F.lit(round_no)), F.lit(salts)).alias("s"))
            .agg(F.min(F.struct("p", "id", "a", "n", "c")).alias("hub")).groupBy("key").agg(F.collect_list("hub").alias("hubs")))
    hubs = hubs.select("key", F.explode("hubs").alias("hub"))
    pairs = mine.join(hubs, "key").where(
        (F.col("id") != F.col("hub.id")) & (F.col("c") != F.col("hub.c"))
        & enough(F.least(F.col("n") - F.col("p"), F.col("hub.n") - F.col("hub.p")), F.col("n"), F.col("hub.n")))
    one, two = F.struct("id", "a"), F.struct("hub.id", "hub.a")
    pairs = pairs.select(F.least(one, two).alias("x"), F.greatest(one, two).alias("y"))
    pairs = pairs.select(F.col("x.id").alias("u"), F.col("x.a").alias("ua"), F.col("y.id").alias("v"), F.col("y.a").alias("va")).distinct()
    return pairs, hubs.select("key", "hub.id", "hub.a")


def _rare_buckets(ids: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, id, a, n, p): the texts under each of their rarest shingles that another one of them has, too."""
    rows = sets.join(ids, ["id", "a"], "left_semi").select("id", "a", F.size("shingles").alias("n"), F.explode("shingles").alias("key"))
    common = written(rows.groupBy("key").count().where("count > 1"), "shingle-counts")
    order = Window.partitionBy("id", "a").orderBy(F.coalesce("count", F.lit(1)), "key")
    prefix = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    ranked = rows.join(common, "key", "left").withColumn("place", F.row_number().over(order))
    return ranked.where((F.col("place") <= prefix) & F.col("count").isNotNull()).select("key", "id", "a", "n", (F.col("place") - 1).cast("bigint").alias("p"))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough: 100 * common >= percent * all."""
    one = pairs.join(sets.select(F.col("id").alias("v"), F.col("a").alias("va"), F.col("shingles").alias("sv")), ["v", "va"])
    two = one.join(sets.select(F.col("id").alias("u"), F.col("a").alias("ua"), F.col("shingles").alias("su")), ["u", "ua"])
    common = F.size(F.array_intersect("su", "sv"))
    return two.where(100 * common >= percent * (F.size("su") + F.size("sv") - common)).select("u", "v")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
                    bands: int = 32, rows: int = 4) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` (the smallest id reachable over
    links), ``kept``."""
    text = F.col(text_col).cast("binary")
    base = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    signed = written(base.select("id", _signer(k, bands, rows)("t").alias("s")).select("id", "s.*"), "signatures")
    full = signed.where("n > 0 and id is not null")
    # rows of one text are one class; rows of one id are one node
    classes = written(full.groupBy("n", "a", "b").agg(F.min("id").alias("rep"), F.max("id").alias("last")), "classes")
    # n and n + 1 shingles can reach the similarity only from n >= percent / (100 - percent)
    large = full.where(F.col("n") * (100 - percent) >= percent)
    reps = large.join(classes.select("n", "a", "b", F.col("rep").alias("id")), ["n", "a", "b", "id"], "left_semi")
    rows_ = reps.select(F.explode("bands").alias("key"), "id", "a", "n").distinct()
    shared_keys = rows_.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
    active = written(rows_.join(shared_keys, "key", "left_semi").withColumn("p", F.lit(0).cast("bigint")), "buckets")
    # a row may be repeated, but its set has to come once per id and text: only ids of several rows are shuffled for that
    often = full.groupBy("id").count().where("count > 1").select("id", F.lit(True).alias("often"))
    wanted = active.select("id").distinct().join(often, "id", "left").select(F.col("id").alias("w"), F.coalesce("often", F.lit(False)).alias("often"))
    fetched = base.join(wanted, F.col("id") == F.col("w")).select("id", "often", _set_maker(k)("t").alias("s")).select("id", "often", "s.*")
    fetched = written(fetched.where(F.size("shingles") > 0), "sets")
    again = written(fetched.where("often").dropDuplicates(["id", "a"]), "repeated-sets")
    sets = fetched.where("not often").union(again).select("id", "a", "shingles")
    # equal sets are links, of every id to its class's smallest
    links = [full.join(classes.where("rep < last"), ["n", "a", "b"]).where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))]
    group, tested = None, None
    for round_no in range(64):
        named = active.withColumn("c", F.col("id")) if group is None else (
            active.join(group, "id", "left").select("key", "id", "a", "n", "p", F.coalesce("component", "id").alias("c")))
        if round_no == 1:
            alive = named.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi")
            ids = written(named.join(alive, "key", "left_semi").select("id", "a").distinct(), "unsettled")
            named = written(_rare_buckets(ids, sets, percent), "rare-buckets").join(group, "id", "left").select(
                "key", "id", "a", "n", "p", F.coalesce("component", "id").alias("c"))
        pairs, hubs = _candidates(named, 64 ** max(0, round_no - 1), round_no, percent)
        hubs = written(hubs, "hubs")
        if hubs.isEmpty():
            break
        pairs = written(pairs if tested is None else pairs.join(tested, ["u", "ua", "v", "va"], "left_anti"), "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        more = written(_links(pairs, sets, percent), "links")
        if group is None or not more.isEmpty():
            links.append(more)
            group = components(reduce(DataFrame.union, links[1:]))
        active = written(named.select("key", "id", "a", "n", "p").join(hubs, ["key", "id", "a"], "left_anti"), "rest")
    else:
        raise RuntimeError("near-duplicate hubs are left after 64 rounds")
    group = components(reduce(DataFrame.union, links)).withColumnRenamed("id", "node")
    out = signed.select("id", "n").join(group, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with all their columns."""
    name = free_name("_gone", docs)
    gone = near_duplicates(docs, id_col, **how).where("not kept").select(F.col(id_col).alias(name))
    return docs.join(gone, F.col(id_col) == F.col(name), "left_anti")

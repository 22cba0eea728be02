"""The pipeline's stages against brute force, and every registered query of the subpackage on the small tables."""
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tools.oracle_check import TABLES, close, rows as sorted_rows
from vigil.llm import decontaminate, langid, linededup, neardup, oracle, pii, queries, tokencount

from . import brute
from .test_text import corpus, prose

D = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def stage_docs(spark, tmp_path_factory):
    rng = random.Random(9)
    items = [(i, prose(rng, 20)) for i in range(5)]
    rows = corpus(8) + [(1000 + i, f"{prose(rng, 30)} {items[i][1]}") for i in range(5)]
    rows += [(2000, "a line that is shared\nown line of 2000"), (2001, "own line of 2001\nA LINE that is shared "), (2002, "123 456")]
    rows += [(3000, "a line that is shared\n own LINE of 2000\n \n")]  # every line with a word is in a smaller id
    d = str(tmp_path_factory.mktemp("stage"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    return rows, items, docs, d


def test_stages_and_run_match_brute_force(spark, stage_docs):
    rows, items, docs, d = stage_docs
    docs.write.parquet(f"{d}/documents.parquet")
    left = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    now = docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, d)
        if name == "line_dedup":
            left = [(i, x[2]) for i, x in brute.dedup_lines(left).items() if not x[1] or x[2].encode().split()]
            assert 3000 not in dict(left) and 2000 in dict(left)
        elif name == "near_dedup":
            group = brute.groups(left, 5)
            left = [(i, t) for i, t in left if group[i][1] == i]
        elif name == "decontamination":
            hit = {i for i, _ in brute.contaminated(left, items)}
            left = [(i, t) for i, t in left if i not in hit]
        assert now.columns == docs.columns
        got = {r.doc_id: (r.text, r.n_chars) for r in now.collect()}
        if name == "language_id":
            assert set(got) == {i for i, _ in left}
        else:
            assert got == {i: (t, len(t)) for i, t in left}
    out = corpus_pipeline.run(spark, d).collect()
    total = {}
    for r in out:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
    assert total == {i: len(t.encode().split()) + 1 for i, t in left}
    assert names == ["language_id", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]


def test_stages_on_odd_rows(spark, stage_docs):
    _, _, docs, d = stage_docs
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, None), (1, "", None, None, None), (2, "x " * 40_000, "en", None, 1)], SCHEMA)
    for table in (odd, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, d).collect()
            if name == "line_dedup":
                assert len(out) == table.count()


INTERNAL = ["_th", "_id", "_own", "_pii", "_lost", "_lost_id", "_r", "_p", "_c", "_gone", "_Matches", "_language", "_language_"]


def test_columns_named_like_internal_ones(spark, stage_docs):
    """Extra columns of any name come through every operator and stage with their values."""
    rows, _, docs, d = stage_docs
    benchmark = spark.read.parquet(f"{d}/benchmark.parquet")
    wide = docs.where("doc_id < 12 or doc_id >= 1000").withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in INTERNAL})
    wide = wide.withColumn("text", F.concat("text", F.lit(" a@b.co")))
    made = {"pii": pii.sanitise(wide), "lines": linededup.dedup_lines(wide), "tokens": tokencount.count_tokens(wide, [b"a"], [b"a"]),
            "language": langid.identify(wide, langid.train(wide)), "near": neardup.drop_near_duplicates(wide),
            "clean": decontaminate.decontaminate(wide, benchmark)}
    n = wide.count()
    for name, out in made.items():
        got = out.select("doc_id", *INTERNAL).collect()
        assert got and (len(got) == n or name in ("near", "clean"))
        assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in INTERNAL)
    now = wide.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in ("n_lines", "n_dropped")})
    columns = now.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, d)
        got = now.collect()
        assert now.columns == columns and got
        assert all(r[c] == f"{c}{r.doc_id}" for r in got for c in (*INTERNAL, "n_lines", "n_dropped"))


def test_unlabelled_texts_stay(spark, stage_docs):
    _, _, _, d = stage_docs
    texts = ["clean text", "", None, "12 34", "\u043c\u0438\u0440"]
    docs = spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, docs, d).collect()} == {0, 4}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_matches_sql(spark, con, name):
    names, got = sorted_rows(queries.QUERIES[name](spark, D).toPandas())
    want_names, want = sorted_rows(con.execute(oracle.SQL[name]).df())
    assert names == want_names and len(got) == len(want)
    assert all(close(a, b) for x, y in zip(got, want) for a, b in zip(x, y))


def test_near_dedup_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op6_near_dedup(spark, D).collect()}
    assert got == brute.groups(texts, 2)


def test_decontamination_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.op10_decontamination(spark, D).collect()}
    assert got == pytest.approx(brute.contaminated(texts, items))


def test_language_query_on_held_out_rows(spark):
    out = queries.op9_language_id(spark, D).join(spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r.lang == r.lang_pred for r in out if r.held_out]
    assert len(held) > 30 and sum(held) / len(held) > 0.97

"""WARC archives, personal data, language-model scores and exact top-k against brute force."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigil.llm import knnjoin, langid, lmscore, pii, queries, shared, warc

from . import brute


def test_warc_round_trip(spark):
    rng = random.Random(1)
    pay = [None, b"", b"\n", b"\r\n", b"\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n", b"\xff\xfe\n" * 70, b"z" * 99, b"z" * 100, b"z" * 101, b"z" * 1000]
    rows = [(i, rng.choice([None, "http://x\r\ny", "u"]), rng.choice(pay + [bytes(rng.randrange(256) for _ in range(rng.randrange(400)))]), "clash") for i in range(200)]
    docs = spark.createDataFrame(rows, "page_id bigint, url string, body binary, digest string").repartition(4)
    for least in (0, 3):
        path = shared.new_path(spark, "test-warc")
        warc.write(docs, path, "page_id", "url", F.col("body"), chunk_bytes=100, revisit_bytes=least)
        chunks = warc.read_chunks(spark, path, chunk_bytes=64)
        read = {}
        for r in sorted(chunks.collect(), key=lambda r: (r.record_id, r.chunk_no)):
            assert len(r.chunk) <= 64
            whole = read.get(r.record_id, b"")
            assert r.chunk_start == len(whole)
            read[r.record_id] = whole + bytes(r.chunk)
            assert r.running_digest == brute.base32_sha1(read[r.record_id])
        out = warc.records(chunks).collect()
        assert len(out) == len(rows) and all(r.intact for r in out)
        first = {}
        for i, _, p, _ in rows:
            first[p or b""] = min(first.get(p or b"", i), i)
        got = {r.record_id: r for r in out}
        for i, _, p, _ in rows:
            p, r = p or b"", got[f"<urn:record:{i}>"]
            revisit = len(p) >= least and first[p] != i
            assert (r.record_type, r.refers_to) == (("revisit", f"<urn:record:{first[p]}>") if revisit else ("response", None))
            assert (r.payload_bytes, r.payload_digest) == (len(p), brute.base32_sha1(p))
            assert read[r.record_id] == (b"" if revisit else p)


def test_warc_odd_rows(spark):
    rows = spark.createDataFrame([(None, "u", "same"), (5, "u", "same"), (5, "u", "same"), (6, None, "same")], "page_id bigint, url string, html string")
    path = shared.new_path(spark, "test-warc")
    warc.write(rows, path, "page_id", "url", F.col("html").cast("binary"))
    got = sorted((r.record_id, r.record_type, r.refers_to) for r in warc.records(warc.read_chunks(spark, path)).collect())
    assert got == [("<urn:record:5>", "response", None)] * 2 + [("<urn:record:6>", "revisit", "<urn:record:5>"), ("<urn:record:null>", "response", None)]
    path = shared.new_path(spark, "test-warc")
    warc.write(rows.where("false"), path, "page_id", "url", F.col("html").cast("binary"))
    assert warc.records(warc.read_chunks(spark, path)).count() == 0


def test_warc_cut_off_file(spark):
    lines = [("f", x) for x in b"WARC/1.1\r\nWARC-Record-ID: <a>\r\nContent-Length: 10\r\n\r\n12345".split(b"\n")]
    lines += [("g", x) for x in b"junk\r\n\r\nWARC/1.0\r\nWARC-Record-ID: <b>\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n".split(b"\n")]
    out = list(warc._walk(iter(lines), 100))
    assert [(r[0], r[8], r[10]) for r in out] == [("<b>", b"xyz", True)]


def pii_text(rng):
    parts = ["a@b.c", "x_y%z@d.e.f", "a@b.co_x@d.e", "@", "+1 ", "(0", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "é", "ß", " ", ".",
             "-", "1", "22", "333", "+49 (30) 123.456-7", "00255.0.0.1", "\n", "w", "ab", "..", "_", "\U0001d4b3", "a..b@c--d.e-", "@x.y", "378282246310005"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(25)))


def test_pii_base_spans(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, pii_text(rng)) for i in range(800)]
    rows += [(5000, None), (5001, ""), (5002, "a" * 100_000), (5003, "1" * 100_000 + "."), (5004, "a@" + "b." * 20_000 + "c"), (5005, "1.2.3.4 " * 300),
             (5006, "+" + "1 " * 50_000), (None, "1.2.3.4"), (7, rows[7][1])]
    monkeypatch.setattr(queries, "table", lambda *a: spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("base", F.lit("clash")))
    got = queries.op2_pii(spark, "").collect()
    assert len(got) == len(rows)
    import hashlib
    text = dict(rows)
    for r in got:
        spans = brute.base_spans(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert r.base_sha256 == hashlib.sha256(brute.digest(spans).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("term")] == [x for x in brute.digest(spans).split(",") if x]


def test_pii_disclosing_terms(spark):
    rows = [(i, f"common words about nothing zanzibar ann{i}@x.org at 10.0.0.7" if i < 4 else "common words about nothing at all") for i in range(60)]
    rows += [(100, "zanzibar alone says nothing here"), (101, "quiet text")]
    out = {r.doc_id: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id bigint, text string"), generalise=0.8, remove=0.95).collect()}
    for i in range(4):
        values = {s.value for s in out[i].all_spans if s.kind_no == 4}
        assert values == {"zanzibar"} and "zanzibar" not in out[i].sanitised and "[EMAIL]" in out[i].sanitised and "common words" in out[i].sanitised
    assert "[TERM]" in out[0].sanitised  # 4 of 5 documents with the term hold the entity: generalised, not removed
    assert out[100].all_spans == [] and out[100].sanitised == rows[60][1] and out[101].sanitised == "quiet text"
    assert pii.sanitise(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_language_model(spark):
    rng = random.Random(2)
    chain = {w: [f"v{rng.randrange(60)}" for _ in range(2)] for w in [f"v{i}" for i in range(60)]}
    rows = []
    for i in range(600):
        w = [f"v{rng.randrange(60)}"]
        while len(w) < 40:
            w.append(rng.choice(chain[w[-1]]))
        rows.append((i, " ".join(w) + (f" rare{i}" if i % 3 else "")))
    rows += [(900, None), (901, ""), (902, "unseen " * 3), (None, "v1 v2"), (3, rows[3][1]), (904, "v1 " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("clash")).repartition(2)
    out = lmscore.score(docs, langid.training_split(F.col("doc_id"), 7, 2), head=40, rounds=2).collect()
    assert len(out) == len(rows)
    want = brute.unigram([r for r in rows if r[0] is not None and r[0] < 900], lambda i: zlib.crc32(str(i).encode()) % 7 == 2)
    assert {r.held_out for r in out} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in out if r.doc_id is not None)
    assert all((r.n_tokens, r.n_known) == want[r.doc_id][:2] for r in out if r.doc_id is not None and r.doc_id < 900 and r.held_out is False)
    held = [r for r in out if r.held_out and r.doc_id < 900]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # it learns the chain


def test_language_model_base_scores_and_empty(spark):
    rows = [(i, t) for i, t in enumerate(["a b b", "A c", None, "", "d" * 1000, "b b c x", "zz yy"] * 3)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute.unigram(rows, held)
    for wide in (2, 65536):
        for r in lmscore.score(docs, langid.training_split(F.col("doc_id"), 7, 2), head=1, wide=wide, rounds=1).collect():
            assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
            assert r.base_score == pytest.approx(want[r.doc_id][3], abs=1e-9) and r.score < 0
    nothing = lmscore.score(docs, F.lit(True)).collect()
    assert len(nothing) == len(rows) and all(r.n_known == 0 and r.base_score == 0 for r in nothing)
    assert lmscore.score(docs.where("false"), F.lit(False)).count() == 0


def test_model_probabilities_add_up():
    v = lmscore.Vocabulary(n_head=5, share=np.arange(6 + lmscore.CLASSES, dtype=float))
    rng = np.random.default_rng(1)
    m = lmscore.Parameters(*(rng.standard_normal(s).astype(np.float32) for s in ((v.size + 1, 4), (v.size, 4), (v.size,), (2, 4, 4))))
    e = lmscore._predicted(m, np.array([[1, v.size]])) @ m.outputs.T + m.bias
    p = np.exp(e - np.log(np.exp(e).sum()))
    assert p.sum() == pytest.approx(1)


def vectors(rng, n, dim):
    out = []
    centre = rng.standard_normal((6, dim))
    for i in range(n):
        v = (centre[i % 6] + 0.3 * rng.standard_normal(dim)) * 0.2
        out.append([float(np.float32(x)) for x in v])
    return out


@pytest.mark.parametrize("cells,block", [(512, 8192), (5, 17)])
def test_exact_top_k(spark, cells, block):
    rng = np.random.default_rng(4)
    v = vectors(rng, 300, 8)
    for i in range(100, 180):
        v[i] = v[100]
    rows = [[i, x] for i, x in enumerate(v)]
    rows[20][1], rows[21][1], rows[40][1], rows[41][1], rows[60][1] = None, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [None] + [0.0] * 7, []
    rows[80][1] = rows[80][1][:3]
    rows += [[None, v[0]], [7, v[7]]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("clash"))
    got = sorted(tuple(r) for r in knnjoin.top_k(df, F.col("vec_id") % 20 == 0, cell_queries=cells, block_rows=block).collect())
    good = {i: [int(np.floor(64 * y)) for y in x] + [0] * (8 - len(x)) for i, x in rows
            if i is not None and x is not None and all(y is not None and np.isfinite(y) for y in x)}
    want = []
    for q in (q for q in good if q % 20 == 0):
        best = sorted((-int(np.dot(good[q], good[s])), s) for s in good if s != q)[:20]
        want += [(q, n + 1, s, -score) for n, (score, s) in enumerate(best)]
    assert got == sorted(want)
    assert knnjoin.top_k(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_exact_top_k_of_huge_components(spark):
    rows = [(0, [1e17, 1.0]), (1, [1e17, 2.0]), (2, [1.0, 1.0]), (3, [-1e17, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r.vec_id, r.score) for r in sorted(knnjoin.top_k(df, F.col("vec_id") == 2, scale=1).collect(), key=lambda r: r.rank)]
    assert got == [(1, 10**17 + 2), (0, 10**17 + 1), (3, -10**17)]


def test_exact_top_k_of_repeated_rows(spark):
    rng = np.random.default_rng(6)
    v = vectors(rng, 80, 8)
    rows = [(i, x) for i, x in enumerate(v)]
    best = max(range(1, 80), key=lambda i: np.dot(np.floor(64 * np.array(v[0])), np.floor(64 * np.array(v[i]))))
    # more than k repeats of the best row, of the query, and of rows that are equal only when quantised or padded
    rows += [(best, v[best])] * 30 + [(0, v[0])] * 30 + [(1, [(np.floor(64 * x) + n / 50) / 64 for x in v[1]]) for n in range(30)]
    rows += [(2, v[2] + [0.0])] * 30
    df = spark.createDataFrame([(i, [float(x) for x in y]) for i, y in rows], "vec_id bigint, embedding array<double>").repartition(4)
    good = {i: [int(np.floor(64 * y)) for y in x] for i, x in enumerate(v)}
    for every in (80, 20):  # one query, then four
        got = sorted(tuple(r) for r in knnjoin.top_k(df, F.col("vec_id") % every == 0, k=20).collect())
        want = []
        for q in range(0, 80, every):
            scores = sorted((-int(np.dot(good[q], good[s])), s) for s in good if s != q)[:20]
            want += [(q, n + 1, s, -score) for n, (score, s) in enumerate(scores)]
        assert got == sorted(want)


def test_bounds_count_an_id_once():
    ids, v = np.repeat(np.arange(8), 5), np.repeat(np.arange(8.0), 5)
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array([[x] for x in v[at]])], names=["id", "v"]) for at in (slice(0, 23), slice(13, 40))]
    out = pa.Table.from_batches(knnjoin._reached(lambda: np.ones((1, 1)), lambda: np.zeros(1), 1, 1, 3)(iter(batches))).to_pydict()
    assert sorted(zip(out["id"], out["low"])) == [(4, 4.0), (5, 5.0), (6, 6.0), (7, 7.0)]

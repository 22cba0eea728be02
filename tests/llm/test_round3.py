"""License scan, source divergence and token alignment against brute force, and their odd rows."""
import functools
import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tools.oracle_check import close, rows
from vigil.llm import aligntokens as al
from vigil.llm import divergence as dv
from vigil.llm import licenses as lic
from vigil.llm.queries import BYTE_BPE, VOCABULARY

D = "/root/testdata/sf0.001"


def docs(spark, rows_, schema="doc_id bigint, text string, lang string, source string"):
    return spark.createDataFrame(rows_, schema)


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_source_divergence"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{D}/documents.parquet')")
    (c1, got), (c2, want) = rows(E.queries()[name](spark, D).toPandas()), rows(con.execute(E.oracle_sql()[name]).df())
    assert c1 == c2 and len(got) == len(want)
    assert all(close(a, b) for x, y in zip(got, want) for a, b in zip(x, y))


# ---- op11 ---------------------------------------------------------------------------------

MIT = lic.TEMPLATES[1][2]


def scanned(spark, texts, **k):
    out = lic.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), **k).collect()
    return {r.doc_id: r for r in out}


def test_base_places_and_labels(spark):
    texts = ["MIT License, mit-license\nand the Apache (license)", None, "", "license mit", "general public  LICENSE", "mit mit license license",
             "mitt license", "mit lİcense", "MKT mit élicense", "smit license"]
    got = scanned(spark, texts)
    places = {i: sorted(p for b in got[i].base for p in b.places) for i in got}
    assert places == {0: [0, 2, 6], 1: [], 2: [], 3: [], 4: [0], 5: [1], 6: [], 7: [], 8: [], 9: []}
    assert got[0].base_labels == ["apache", "mit"] and got[4].base_labels == ["gpl"]
    assert [got[i].n_words for i in (0, 1, 2, 9)] == [8, 0, 0, 2]
    assert got[1].score == 0 and got[5].score >= lic.BASE_SCORE


def test_notices_are_found_in_place_and_need_their_key_phrases(spark):
    filler = [" ".join(f"word{i}" for i in range(n)) for n in (0, 50, 3000)]
    texts = [f"{f}\n// {MIT.upper()}." for f in filler]
    texts.append(MIT.replace("free of charge", "at a charge"))          # a key phrase is broken
    texts.append(" ".join(reversed(MIT.split())))                       # same words, other places
    texts.append(f"{MIT} x y z {lic.TEMPLATES[8][2]}")                  # two notices
    texts += ["of the and to in"] * 40                                  # common words are no evidence
    got = scanned(spark, texts)
    for i, f in enumerate(filler):
        assert [(n.template, n.start) for n in got[i].notices] == [("mit-text", len(f.split()))] and got[i].score == 1
    assert got[3].labels == [] and got[4].labels == [] and got[5].labels == ["bsd", "mit"]
    assert all(got[i].labels == [] and got[i].score == 0 for i in range(6, 46))


def test_license_scan_odd_rows(spark):
    rows_ = [(None, MIT, "a"), (None, MIT, "a"), (3, None, None), (3, MIT, "b"), (4, "x " * 200_000 + MIT, "c")]
    df = spark.createDataFrame(rows_, "doc_id bigint, text string, words string").withColumn("key", F.lit(1))
    got = sorted((r.doc_id or 0, r.n_words, tuple(r.labels)) for r in lic.scan(df).collect())
    n = len(MIT.split())
    assert got == [(0, n, ("mit",))] * 2 + [(3, 0, ()), (3, n, ("mit",)), (4, 200_000 + n, ("mit",))]
    assert lic.scan(df.limit(0)).count() == 0


def test_license_scan_runs_no_python(spark):
    plan = lic.scan(spark.read.parquet(f"{D}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "ExistingRDD"))


# ---- op12 ---------------------------------------------------------------------------------

def divergence_brute(rows_, min_docs, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df, count = Counter(), Counter()
    groups = {((r[2] or ""), (r[3] or "")) for r in rows_}
    for _, text, lang, source in rows_:
        found = term.findall((text or "").translate(low))
        df.update((lang or "", t) for t in set(found))
        count.update((lang or "", source or "", t) for t in found)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), n in df.items() if x == lang and n >= min_docs)
        sources = sorted(s for x, s in groups if x == lang)

        def p(counts):
            total = sum(counts)
            return [1 + 10**9 * (c + 5) // (total + 5 * len(kept)) for c in counts]
        of = {s: p([count[lang, s, t] for t in kept]) for s in sources}
        q = p([sum(count[lang, s, t] for s in sources) for t in kept])
        for s in sources:
            pairs = [(sum(abs(a - b) for a, b in zip(of[s], of[o])), o) for o in sources if o != s]
            terms = [(of[s][i] - q[i], t) for i, t in enumerate(kept) if count[lang, s, t] and of[s][i] > q[i]]
            for part, items in (("pair", pairs), ("term", terms)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(items) if part == "pair" or i < top}
    return out


def test_divergence_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dv, "TILE", 3)          # several tiles and shares of terms
    monkeypatch.setattr(dv, "TERMS_PER_TASK", 7)
    monkeypatch.setattr(dv, "HELD_CHUNKS", 16)
    monkeypatch.setattr(dv, "BITS", 256)        # many false hits
    rng = random.Random(5)
    word = lambda: rng.choice(["Aa", "aa,", "bé", "É", "c-d", "e1f", "(g)", "h i", "zz"]) + rng.choice(["", ".", "x", "KK"])
    rows_ = [(i, rng.choice([" ", "\n", "\t"]).join(word() for _ in range(rng.choice([0, 1, 8, 40]))), rng.choice(["en", "fr", None]),
              rng.choice([f"s{j}" for j in range(8)] + [None])) for i in range(150)]
    rows_ += [(None, None, "xx", "lonely"), (7, "  ", "xx", "other"), (7, "  ", "xx", "other"), (8, "Aa " * 20_000, "en", "s1")] + [rows_[0]] * 3
    got = {tuple(r) for r in dv.divergence(docs(spark, rows_).repartition(6), min_docs=5, top_terms=4).collect()}
    assert got == divergence_brute(rows_, 5, 4)


def test_divergence_odd_rows(spark):
    clash = docs(spark, [(1, "a b", "en", "s")]).withColumn("block", F.lit(1)).withColumn("term", F.lit("x"))
    assert dv.divergence(clash, min_docs=1).count() == 0  # one source: no pair, and no term above the language
    assert dv.divergence(clash.limit(0)).count() == 0
    two = docs(spark, [(1, "a b", "en", "s"), (2, None, "en", "t")])
    assert {(r.source, r.part, r.item, r.value) for r in dv.divergence(two, min_docs=30).collect()} == {("s", "pair", "t", 0), ("t", "pair", "s", 0)}


def test_divergence_reads_the_texts_in_one_pass(spark, monkeypatch):
    sizes, keep = {}, dv.written

    def counted(df, label):
        out = keep(df, label)
        sizes[label] = out.count()
        return out
    monkeypatch.setattr(dv, "written", counted)
    rows_ = [(i, f"of the {i}of; rare{'x' * i}\tÉ", "en", f"s{i % 3}") for i in range(60)] + [(60, None, "fr", "s0")]
    got = {tuple(r) for r in dv.divergence(docs(spark, rows_), min_docs=30, top_terms=4).collect()}
    assert got == divergence_brute(rows_, 30, 4)
    # neither texts, chunks nor the documents of a chunk are written: of, the and É of three sources, and four groups
    assert sizes == {"term-counts": 9 + 4, "sources": 4}


@pytest.mark.parametrize("held, bits", [(1 << 19, 1 << 25), (2, 8), (2, 400)])
def test_term_uses_equal_brute_force(spark, monkeypatch, held, bits):
    monkeypatch.setattr(dv, "HELD_CHUNKS", held)
    monkeypatch.setattr(dv, "BITS", bits)
    texts = ["aa", "bb aa", "", None, " \n\t ", "  lead aa", "1", "1 2-3", "Aa.aa,AA aA1aa", "x\x00y\x7fz{Z}[é]", "É é\xa0e a\u2003b", "😀a 😀", "\x1caa\x85bb", "aa\x0b\x0cbb\r",
             "w" * 5000 + " " * 300 + "w", "aa" * 3, "bb"]
    rows_ = [(i, t, "en" if i % 5 else "", f"s{i % 2}") for i, t in enumerate(texts * 3)] + [(None, "aa", "en", "s1")] * 2
    found = dv.term_uses(docs(spark, rows_).select("lang", "source", F.col("text").cast("binary")))
    got = {(r.lang, r.source, bytes(r.term).decode() if r.term is not None else None): (r.n, r.docs)
           for r in found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).collect()}
    want = {(lang, source, None): (0, 0) for _, _, lang, source in rows_}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang, source in rows_:
        for t, n in Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(low))).items():
            old = want.get((lang, source, t), (0, 0))
            want[lang, source, t] = (old[0] + n, old[1] + 1)
    assert got == want


# ---- op13 ---------------------------------------------------------------------------------

@functools.cache
def tokenizers():
    with open(BYTE_BPE, encoding="utf-8") as f, open(VOCABULARY, "rb") as g:
        return al.Tokenizers(f.read(), g.read())


def whole_text(text):
    """(A ids, A sizes, B ids, B sizes) of the text encoded as a whole; nothing if the bytes differ."""
    tok = tokenizers()
    a = tok.a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = tok.b.encode(text) if text else []
    pa, pb = [tok.a_bytes[i] for i in a], [tok.b_bytes[i] for i in b]
    if not text or not b"".join(pa) == b"".join(pb) == b" " + text.encode():
        return [], [], [], []
    return a, [len(x) for x in pa], b, [len(x) for x in pb]


def align_brute(texts):
    per_doc, count = [], Counter()
    for text in texts:
        a, size_a, b, size_b = whole_text(text or "")
        own_a = [i for i, n in enumerate(size_a) for _ in range(n)]
        own_b = [j for j, n in enumerate(size_b) for _ in range(n)]
        links = sorted(set(zip(own_a, own_b)))
        count.update((a[i], b[j]) for i, j in links)
        ends = sorted({*np.cumsum(size_a).tolist()} & {*np.cumsum(size_b).tolist()})
        groups, start = [], 0
        for e in ends:
            groups.append(",".join(str(a[i]) for i in dict.fromkeys(own_a[start:e])) + "|" + ",".join(str(b[j]) for j in dict.fromkeys(own_b[start:e])))
            start = e
        per_doc.append((a, b, links, groups))
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = []
    for a, b, links, groups in per_doc:
        c = [count[a[i], b[j]] for i, j in links]
        out.append((len(a), len(b), len(groups), len(links), sum(n == best[b[j]] for n, (i, j) in zip(c, links)), sum(c),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return out


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def odd_texts():
    rng = random.Random(9)
    alphabet = ["a", "b", "the", "Zürich", "été", " ", "  ", "\n", "\t", ".", "'s", "1", "²", "᠎", " ", "😀", "<s>", "<|endoftext|>", "<0x41>", "\x00", " ", "ﬁ", "中文"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([1, 4, 30]))) for _ in range(300)]
    return texts + ["", None, " ", "▁x", "a ▁ b", "x" * 3000, " lead", "trail ", "a\r\nb", "word " * 20_000] + ["a copied text, twice"] * 3


@pytest.mark.parametrize("piece, block", [(1 << 16, 8192), (7, 5)])
def test_alignment_equals_brute_force(spark, monkeypatch, piece, block):
    monkeypatch.setattr(al, "PIECE", piece)
    monkeypatch.setattr(al, "BLOCK_DOCS", block)
    real = [r.text for r in spark.read.parquet(f"{D}/documents.parquet").limit(60).collect()]
    texts = odd_texts() + real
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: tuple(r[c] for c in FIELDS) for r in al.align(df, BYTE_BPE, VOCABULARY).collect()}
    want = align_brute(texts)
    assert [i for i, w in enumerate(want) if got[i] != w] == []
    assert len(got) == len(texts)


def test_merge_paths_cut_equal_pieces():
    rng = np.random.default_rng(1)
    ends = np.cumsum(rng.integers(1, 5, 4000))
    a, b = np.sort(rng.choice(ends, 3000, False)), np.sort(rng.choice(ends, 500, False))
    last = max(a[-1], b[-1])
    a, b = np.append(a[a < last], last), np.append(b[b < last], last)
    d = np.append(np.arange(0, len(a) + len(b), 64), len(a) + len(b))
    i = al.diagonals(a, b, d)
    assert np.diff(i + (d - i)).max() == 64 and (np.diff(i) >= 0).all() and (np.diff(d - i) >= 0).all()
    for piece in (1, 64, 10_000):
        x, y, cut_a, cut_b = al.merge(a, b, piece)
        assert len(set(zip(x.tolist(), y.tolist()))) == len(x) == len(np.union1d(a, b))
        assert (a[cut_a - 1] == b[cut_b - 1]).all() and len(cut_a) == len(np.intersect1d(a, b))


def test_alignment_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id string, text string").withColumn("block", F.lit("x")).withColumn("codes", F.lit(1))
    got = al.align(df, BYTE_BPE, VOCABULARY).collect()
    assert sorted((r.doc_id or "", r.n_a, r.n_links, r.count_sum) for r in got) == [("", 2, 2, 4)] * 2 + [("1", 0, 0, 0)]
    assert al.align(df.limit(0), BYTE_BPE, VOCABULARY).count() == 0


def test_license_scan_takes_the_words_of_a_text_once(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License, really"), (2, None), (3, "no such words")], "doc_id long, text string")
    got = lic.scan(df)
    assert [(r.doc_id, r.n_words, r.base_labels, r.labels) for r in got.orderBy("doc_id").collect()] == [(1, 6, ["mit"], ["mit"]), (2, 0, [], []), (3, 3, [], [])]
    assert "regexp" not in got._jdf.queryExecution().optimizedPlan().toString()

"""Line dedup, near-duplicates, decontamination, language ID, token counts, packing against brute force."""
import random

import pytest
from pyspark.sql import functions as F

from vigil.llm import decontaminate, langid, linededup, neardup, packing, tokencount

from . import brute

SCHEMA = "doc_id bigint, text string, lang string, n_lines string, kept boolean"


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


def corpus(seed=1):
    rng = random.Random(seed)
    base = prose(rng, 150)
    rows = [prose(rng, rng.choice([3, 5, 40, 200])) for _ in range(40)]
    rows += [base] * 30 + [edited(rng, base, rng.choice([0.01, 0.03, 0.06, 0.1])) for _ in range(60)]
    passage = prose(rng, 100)
    rows += [prose(rng, 25, 10**6) + " " + passage + " " + prose(rng, 25, 10**6) for _ in range(60)]
    rows += ["", None, " \n\t", "One", "one", "two words", "Two  words", prose(rng, 9000), "word" * 50_000]
    return list(enumerate(rows))


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_are_all_similar_pairs(spark, k):
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame(spark, rows).repartition(5), k=k).collect()}
    assert got == brute.groups(rows, k)


def test_near_duplicates_odd_rows(spark):
    text = "a b c d e f g h i j k l"
    rows = [(None, text), (7, text), (7, text), (3, "q r s t u v"), (9, text.upper()), (3, text)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0, r.kept) for r in neardup.near_duplicates(frame(spark, rows)).collect())
    assert got == [(False, 3, 3, True)] * 2 + [(False, 7, 3, False)] * 2 + [(False, 9, 3, False), (True, 0, 0, True)]
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    clash = frame(spark, [(1, text, "en", "x", None), (2, text, None, None, True)], SCHEMA)
    assert [r.asDict() for r in neardup.drop_near_duplicates(clash).collect()] == [
        {"doc_id": 1, "text": text, "lang": "en", "n_lines": "x", "kept": None}]


@pytest.fixture(scope="module")
def unsettled():
    """Triples of texts: an unlike one with the smallest id, which shares a passage with two similar ones."""
    rng, rows = random.Random(3), []
    for i in range(0, 180, 3):
        shared, own = [prose(rng, n, 10**9).split(" ") for n in (90, 90)]
        x = shared + own
        y = shared + own[:-8] + prose(rng, 8, 10**9).split(" ")
        rows += [(i, " ".join(shared + prose(rng, 90, 10**9).split(" "))), (i + 1, " ".join(x)), (i + 2, " ".join(y))]
    return rows


def test_near_duplicates_of_repeated_rows(spark, unsettled):
    # one band of one value: a pair shares its only bucket with the unlike text or with nothing
    groups = lambda rows: {(r.doc_id, r.component_id) for r in neardup.near_duplicates(frame(spark, rows), k=1, bands=1, rows=1).collect()}
    want = groups(unsettled)
    assert sum(i != c for i, c in want) > 40
    repeated = unsettled * 2 + unsettled[::2]
    assert groups(repeated) == want


def test_near_duplicates_of_two_texts_under_one_id(spark, unsettled):
    groups = lambda rows: dict((r.doc_id, r.component_id) for r in neardup.near_duplicates(frame(spark, rows), k=1, bands=1, rows=1).collect())
    alone = groups(unsettled)
    # the triples' second texts share ids in pairs, as do the third ones with texts of their own
    rng = random.Random(4)
    twin = {i: i - i % 6 + i % 3 for i, _ in unsettled if i % 3 == 1}
    rows = [(twin.get(i, i), t) for i, t in unsettled] + [(i, prose(rng, 40 + i, 10**9)) for i, _ in unsettled if i % 3 == 2]
    links = [(twin.get(i, i), twin.get(c, c)) for i, c in alone.items()]
    want = {i: i for pair in links for i in pair}
    for _ in links:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    assert groups(rows) == want


def test_line_dedup(spark):
    rng = random.Random(4)
    lines = ["  Shared  line one ", "shared  line ONE", "ten chars!", "9 chars..", "ünïcödé ünï", "", " ", "\x0bvertical tab line\x0c",
             "vertical tab line", "a\x85unicode blank line", "solitary " + "z" * 50_000]
    rows = [(i, None if i == 5 else "\n".join(rng.choice(lines) for _ in range(rng.randrange(9)))) for i in range(60)]
    for k in (2, 5):
        got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in linededup.dedup_lines(frame(spark, rows).repartition(4), min_docs=k).collect()}
        assert got == brute.dedup_lines(rows, min_docs=k)


def test_line_dedup_odd_rows(spark):
    line = "a line of some length"
    rows = [(None, line, "en", "x", None), (4, line, None, "y", True), (4, f"{line}\nx", None, None, None), (5, line, None, None, None)]
    got = linededup.dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert set(got.columns) == {"doc_id", "text", "lang", "n_lines", "kept", "n_dropped"}
    assert sorted((r.doc_id or 0, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == [
        (0, line, 1, 0), (4, line, 1, 0), (4, f"{line}\nx", 2, 0), (5, "", 1, 1)]
    assert linededup.dedup_lines(frame(spark, [])).count() == 0


def test_decontamination(spark):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.choice([14, 20, 20, 33]))) for i in range(25)] + [(90, "only three words"), (91, ""), (92, None), (93, "rep " * 20)]
    rows = [(i, prose(rng, 60)) for i in range(30)]
    for i in range(60):
        item = rng.choice(items)[1] or ""
        w = edited(rng, item, rng.choice([0, 0, 0.02, 0.1])).split(" ")
        if i % 7 == 0:
            w.insert(rng.randrange(len(w) + 1), "inserted")
        rows.append((100 + i, prose(rng, rng.choice([0, 40])) + "\n" + " ".join(w).upper() + "\t " + prose(rng, rng.choice([0, 40]))))
    rows += [(300, None), (301, ""), (302, "Only  three\nwords"), (303, "rep " * 500), (304, items[0][1] * 3), (305, "u" * 100_000)]
    docs, bench = frame(spark, rows).repartition(3), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute.contaminated(rows, items)
    for size in (8 << 20, 400):  # one block, many blocks
        got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, bench, block_bytes=size).collect()}
        assert got == pytest.approx(want)
    kept = {r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()}
    assert kept == {i for i, _ in rows} - {d for d, _ in want}
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.decontaminate(docs, none).count() == len(rows) and decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.contaminated(frame(spark, []), bench).count() == 0
    odd = spark.createDataFrame([(None, items[0][1], "x"), (1, items[0][1], None), (1, items[0][1], None)], "doc_id bigint, text string, _matches string")
    assert decontaminate.contaminated(odd, bench).count() == 3
    assert decontaminate.decontaminate(odd.select("doc_id", "text"), bench).columns == ["doc_id", "text"]


def test_language_id(spark):
    rng = random.Random(3)
    sounds = {"aa": "kalo nimu sepa", "bb": "strength wurz pfei", "cc": "éàù çon ñol"}
    rows = [(i, " ".join(rng.choice(sounds[lang].split()) + rng.choice(sounds[lang].split()) for _ in range(rng.choice([2, 30]))), lang)
            for i in range(150) for lang in [rng.choice([*sounds])]]
    odd = [(500, None, "aa"), (501, "", "bb"), (502, "123 ?!", "aa"), (503, "kalonimu", None), (None, "kalosepa nimu", "aa"), (504, "strengthwurz " * 20_000, None)]
    docs = frame(spark, rows + odd + [rows[0]], "doc_id bigint, text string, lang string").withColumn("score", F.lit("clash"))
    held = langid.training_split(F.col("doc_id"), 3, 1)
    model = langid.train(docs.where(~held))
    out = langid.identify(docs.withColumn("held", held), model).collect()
    assert len(out) == len(rows) + len(odd) + 1
    right = [r.lang_pred == r.lang for r in out if r.held and r.doc_id is not None and r.doc_id < 500]
    assert len(right) > 30 and sum(right) / len(right) > 0.95
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (500, 501, 502, 503, None, 504)] == ["und", "und", "und", "aa", "aa", "bb"]
    assert by[500].score == 0 and all(0 <= r.score <= 1 for r in out)
    empty = langid.train(docs.where("false"))
    assert {(r.lang_pred, r.score) for r in langid.identify(docs, empty).collect()} == {("und", 0.0)}
    assert langid.identify(docs.where("false"), model).count() == 0


def test_language_scores_do_not_depend_on_windows(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(1)
    model = langid.Model(["x", "y"], np.log(rng.random((1 << 10, 2))), np.log([0.5, 0.5]), 10, (1, 2, 3))
    codes, bounds, _ = langid._codes([b"", b"ab", b"some longer text", b"", b"x"])
    whole = langid._scores(model, codes, bounds)
    monkeypatch.setattr(langid, "GATHER", 2)
    assert np.allclose(langid._scores(model, codes, bounds), whole)
    lone = [langid._scores(model, *langid._codes([t])[:2])[0] for t in (b"", b"ab", b"some longer text", b"", b"x")]
    assert np.allclose(lone, whole)


def test_token_counts(spark):
    initial, continuation = [b"a", b"abcd", b"b", "é".encode()], [b"b", b"bc", b"c", b"bcdy", b"a", "éa".encode()]
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdyzé") for _ in range(rng.randint(1, 9)))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(40)))) for i in range(80)] + [(90, None), (91, ""), (92, "ab" * 60_000), (93, "A a"), (93, "A a")]
    docs = frame(spark, rows).withColumn("n_words", F.lit("clash"))
    got = sorted(tuple(r) for r in tokencount.count_tokens(docs, initial, continuation).select("doc_id", "n_words", "n_tokens", "n_unknown").collect())
    want = []
    for i, t in rows:
        n = [brute.greedy(w, set(initial), set(continuation)) for w in (t or "").encode().split()]
        want.append((i, len(n), sum(max(x, 1) for x in n), n.count(0)))
    assert got == sorted(want)
    assert tokencount.count_tokens(frame(spark, []), initial, continuation).count() == 0


def test_token_counts_of_a_public_vocabulary(spark):
    from tokenizers import models

    from vigil.llm.queries import VOCABULARY, op5_token_counts
    initial, continuation = tokencount.sentencepiece_vocabulary(VOCABULARY)
    vocabulary = {"[UNK]": 0}
    for piece in [x.decode() for x in initial] + ["##" + x.decode() for x in continuation]:
        vocabulary.setdefault(piece, len(vocabulary))
    model = models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10**6)
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    seen = {}
    for r in op5_token_counts(spark, d).collect():
        pieces = [seen.setdefault(w, [t.value for t in model.tokenize(w.decode())]) for w in texts[r.doc_id].encode().split()]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(pieces), sum(map(len, pieces)), sum(p == ["[UNK]"] for p in pieces))


def test_packing_plan_is_sequential_best_fit():
    rng = random.Random(6)
    for _ in range(200):
        sizes = tuple(sorted(rng.sample(range(3, 40), 3)))
        histogram = {n: rng.randint(1, 30) for n in rng.sample(range(1, sizes[-1] + 1), rng.randint(0, sizes[-1] // 2))}
        placed, bins = packing.plan(histogram, sizes, 2)
        rooms = []
        for n in sorted(histogram, reverse=True):
            for _ in range(histogram[n]):
                fit = [i for i, r in enumerate(rooms) if r >= n]
                if not fit:
                    rooms.append(packing.opening_size(n, sizes, 2))
                    fit = [len(rooms) - 1]
                rooms[min(fit, key=lambda i: rooms[i])] -= n
        assert sorted(rooms) == sorted(room for a, b, _, room in bins for _ in range(a, b))
        used = {}
        for n, first, last, per, a, _ in placed:
            for k in range(first, last):
                used[a + (k - first) // per] = used.get(a + (k - first) // per, 0) + n
        assert all(used[i] == size - room for a, b, size, room in bins for i in range(a, b))


@pytest.mark.parametrize("share", [100_000, 3])
def test_packing(spark, share):
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.choice([0, 1, 5, 5, 5, 30, 70, 200]))) for i in range(120)] + [(200, None), (201, " \n"), (202, prose(rng, 5000)), (3, "x y"), (3, "x y"), (None, "a b")]
    docs = frame(spark, rows).withColumn("bin_id", F.lit("clash"))
    sizes = (32, 64, 128)
    out = packing.pack(docs, capacities=sizes, bin_cost=4, share=share).collect()
    total = {}
    for i, t in rows:
        total[i] = total.get(i, 0) + len((t or "").encode().split()) + 1
    packed, bins = {}, {}
    for r in out:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.n_tokens
        bins.setdefault(r.bin_id, []).append(r)
    assert packed == total
    for rows_ in bins.values():
        rows_.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in rows_:
            assert r.bin_offset == at
            at += r.n_tokens
        assert {r.bin_capacity for r in rows_} == {min(c for c in sizes if c >= at)}
    assert packing.pack(frame(spark, [])).count() == 0


@pytest.mark.parametrize("share", [200_000, 7])
def test_components_of_chains_and_stars(spark, monkeypatch, share):
    monkeypatch.setattr(neardup, "LINKS_PER_TASK", share)
    links = [(i + 1, i) for i in range(40)] + [(100, x) for x in range(101, 120)] + [(200, 150), (150, 201), (201, 39), (300, 299), (300, 299)]
    random.Random(1).shuffle(links)
    got = {r.id: r.component for r in neardup.components(spark.createDataFrame(links, "u bigint, v bigint").repartition(6)).collect()}
    want = {i: 0 for i in [*range(1, 41), 150, 200, 201]} | {i: 100 for i in range(101, 120)} | {300: 299}
    assert got == want

"""Alignment of two tokenizers' tokens over the same bytes, and how usual each link is in the corpus.

Both tokenizations of a text end tokens at byte offsets.  Merging the two rising lists of ends gives the links
(every A token with every B token that it shares bytes with) and the groups (cut where both end).  The merge is
divided by merge paths: a diagonal d holds the first d ends of the merged order, and a binary search tells how
many of them are A's (A first where both end).  The pieces between diagonals hold ``PIECE`` ends each, whatever the
two lengths, and need nothing of one another; each emits its overlaps and its cuts.  The groups that a piece boundary
divides are stitched from the cuts on both sides.  A block of documents is one merge, so short texts share a piece
and a long text has many.

Corpus counts.  A block keeps its distinct id pairs and, per document, which of them it holds and how often.  Pairs are
counted over blocks, a pair with one row per block, marked if no pair of their B id has more, and come
back to the block, where each document adds up its own.

A text is tokenised in the parts between its single blanks, which no token of either kind crosses, and a task encodes
each of its distinct parts once.  Memory: a block ends at ``BLOCK_BYTES`` of text or ``BLOCK_DOCS`` documents.

Defined results: null, empty and undecodable texts, and those whose tokens' bytes differ from a blank and the text, have no
tokens: zeros and an empty digest; repeated rows are documents each, and so are rows with a null
id; an empty table gives no rows; only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .shared import sent, written

PIECE = 1 << 16
BLOCK_BYTES, BLOCK_DOCS = 2 << 20, 8192
#: Characters given to the tokenizers at once.
BATCH = 1 << 20
#: Parts (and their characters) that a task remembers before it starts anew.
KNOWN_PARTS, KNOWN_CHARS = 1 << 18, 8 << 20
#: A single blank between other characters (U+180E counts as white space in some tables): no token of either kind crosses it.
CUT_PLACE = re.compile("(?<=[^\\s\u180e\u2581]) (?=[^\\s\u180e\u2581])")
BLANK = "▁"


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """The two encoders and the bytes of their entries; built in the worker from the files' contents."""

    def __init__(self, byte_bpe: str, piece_bpe: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        alphabet = byte_alphabet()
        size = 1 + max(self.a.get_vocab().values())
        self.a_bytes = [b""] * size
        for entry, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(alphabet[c] for c in entry) if all(c in alphabet for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        most = max(size, len(pieces))
        self.printed = [b"%d%s" % (i, sep) for sep in (b",", b"|", b";") for i in range(most)]
        self.printed_size = np.array([len(x) for x in self.printed], np.int64)
        self.most = most

        # no B piece goes on after a blank, so texts may be cut before single blanks
        self.cuttable = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.held = 0
        none = np.zeros(0, np.int64)
        self.a_ids, self.b_ids, self.a_at, self.b_at, self.same = none, none, none[:0], none[:0], np.zeros(0, bool)
        self.a_len, self.b_len = none, none

    def learn(self) -> None:
        """Encode the parts that were numbered since the last call."""
        new = list(islice(self.number, len(self.same), None))
        a, b, i = [], [], 0
        while i < len(new):
            j, size = i, 0
            while j < len(new) and (j == i or size + len(new[j]) <= BATCH):
                size += len(new[j])
                j += 1
            a += [e.ids for e in self.a.encode_batch_fast([" " + p for p in new[i:j]], add_special_tokens=False)]
            b += self.b.encode(new[i:j], num_threads=1)
            self.held += size
            i = j
        flat = lambda lists: np.fromiter(chain.from_iterable(lists), np.int64)
        sizes = lambda lists: np.fromiter(map(len, lists), np.int64, len(lists))
        new = [b" " + p.encode() for p in new]
        a_new, b_new, a_len, b_len = flat(a), flat(b), sizes(a), sizes(b)
        same = self.equal(new, a_new, a_len, self.a_bytes, self.a_size) & self.equal(new, b_new, b_len, self.b_bytes, self.b_size)
        self.a_len, self.b_len = np.append(self.a_len, a_len), np.append(self.b_len, b_len)
        self.a_ids, self.b_ids = np.append(self.a_ids, a_new), np.append(self.b_ids, b_new)
        self.same = np.append(self.same, same)
        self.a_at, self.b_at = np.cumsum(self.a_len) - self.a_len, np.cumsum(self.b_len) - self.b_len

    @staticmethod
    def equal(parts: list[bytes], ids: np.ndarray, length: np.ndarray, table: list[bytes], size: np.ndarray) -> np.ndarray:
        """Which parts their tokens' bytes spell: those of equal size are compared at once, then one by one if need be."""
        ends = np.append(0, np.cumsum(size[ids]))[np.append(0, np.cumsum(length))]
        same = np.diff(ends) == np.fromiter(map(len, parts), np.int64, len(parts))
        spelt = b"".join(map(table.__getitem__, ids[np.repeat(same, length)].tolist()))
        if spelt != b"".join(compress(parts, same.tolist())):
            at = 0
            for i in np.flatnonzero(same).tolist():
                same[i] = spelt[at:at + len(parts[i])] == parts[i]
                at += len(parts[i])
        return same

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids, where each text's begin, B ids, where each text's begin), one more bound than texts."""
        if len(self.number) > KNOWN_PARTS or self.held > KNOWN_CHARS:
            self.forget()
        split = CUT_PLACE.split if self.cuttable else lambda t: [t]
        parts = [split(t) if t else [] for t in texts]
        size = np.array([len(p) for p in parts], np.int64)
        code = np.fromiter(map(self.number.__getitem__, chain.from_iterable(parts)), np.int64, int(size.sum()))
        del parts
        self.learn()
        doc = np.repeat(np.arange(len(texts)), size)
        good = np.bincount(doc[~self.same[code]], minlength=len(texts)) == 0
        code, doc = code[good[doc]], doc[good[doc]]

        def laid_out(ids, at, length):
            n = length[code]
            ends = np.cumsum(n)
            take = np.repeat(at[code] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
            bounds = np.append(0, np.cumsum(np.bincount(doc, n, len(texts)).astype(np.int64)))
            return ids[take], bounds

        return *laid_out(self.a_ids, self.a_at, self.a_len), *laid_out(self.b_ids, self.b_at, self.b_len)


def diagonals(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """How many of the first ``d`` ends of the merged order are ``a``'s, by binary searches side by side."""
    lo, hi = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        more = np.zeros(len(d), bool)
        more[open_] = a[mid[open_]] <= b[d[open_] - mid[open_] - 1]
        lo, hi = np.where(open_ & more, mid + 1, lo), np.where(open_ & ~more, mid, hi)
    return lo


def merge_piece(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """Overlaps (A token, B token) and cuts (A tokens, B tokens up to it) of one piece of the merge path."""
    mine_a, mine_b = a[i0:i1], b[j0:j1]
    under_a = j0 + np.searchsorted(mine_b, mine_a, "left")  # the B token that holds the last byte of an A token
    done = i0 + np.searchsorted(mine_a, mine_b, "right")
    common = (done > 0) & (a[np.maximum(done - 1, 0)] == mine_b) if len(a) else np.zeros(len(mine_b), bool)
    j = np.arange(j0, j1)
    return (np.concatenate([np.arange(i0, i1), done[~common]]), np.concatenate([under_a, j[~common]]),
            done[common], j[common] + 1)


def merge(a: np.ndarray, b: np.ndarray, piece: int | None = None):
    """Overlaps and cuts of two rising lists of ends, piece by piece; cuts come in order."""
    d = np.append(np.arange(0, len(a) + len(b), piece or PIECE), len(a) + len(b))
    i = diagonals(a, b, d)
    j = d - i
    out = [merge_piece(a, b, *x) for x in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist())]
    return tuple(np.concatenate([o[k] for o in out] or [np.zeros(0, np.int64)]) for k in range(4))


def printed_groups(tok: Tokenizers, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The tokens of both kinds as ``a1,a2|b1;`` in the order of the groups, and the end of each group's text.
    A piece's first cut ends the group that the pieces before it left open: groups are what lies between cuts."""
    start_a, start_b = np.append(0, cut_a[:-1]), np.append(0, cut_b[:-1])
    code = np.empty(len(a) + len(b), np.int64)
    group_a, group_b = np.repeat(np.arange(len(cut_a)), cut_a - start_a), np.repeat(np.arange(len(cut_b)), cut_b - start_b)
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[cut_a - 1], last_b[cut_b - 1] = True, True
    code[np.arange(len(a)) + start_b[group_a]] = a + np.where(last_a, tok.most, 0)
    code[np.arange(len(b)) + cut_a[group_b]] = b + np.where(last_b, 2 * tok.most, 0)
    sizes = np.append(0, np.cumsum(tok.printed_size[code]))
    return [tok.printed[c] for c in code.tolist()], sizes[cut_a + cut_b]


class _Blocks:
    """Documents of one task, aligned block by block."""

    def __init__(self, tok: Tokenizers, doc_type: pa.DataType):
        self.tok, self.doc_type = tok, doc_type

    def rows(self, block: int, ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        tok, n = self.tok, len(ids)
        a, a_at, b, b_at = tok.encode(texts)
        cross_a, cross_b, cut_a, cut_b = merge(np.cumsum(tok.a_size[a]), np.cumsum(tok.b_size[b]))
        doc_of_link = np.searchsorted(a_at, cross_a, "right") - 1
        doc_of_cut = np.searchsorted(a_at, cut_a - 1, "right") - 1
        n_links, n_groups = np.bincount(doc_of_link, minlength=n), np.bincount(doc_of_cut, minlength=n)
        digests = [""] * n
        if len(a):
            text, ends = printed_groups(tok, a, b, cut_a, cut_b)
            text = b"".join(text)
            ends = np.append(0, ends)[np.append(0, np.cumsum(n_groups))].tolist()
            digests = [hashlib.sha256(text[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(ends, ends[1:])]
            del text
        codes, which = np.unique(a[cross_a] * len(tok.b_bytes) + b[cross_b], return_inverse=True)
        totals = np.bincount(which, minlength=len(codes))
        held, times = np.unique(doc_of_link * len(codes) + which, return_counts=True)
        bounds = np.searchsorted(held, np.arange(n + 1) * len(codes))
        held = held % max(len(codes), 1)
        steps = np.diff(held, prepend=0)  # within a document; the first one counts from 0
        first = bounds[:-1][bounds[:-1] < bounds[1:]]
        steps[first] = held[first]
        lists = lambda v, at, kind: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(v.astype(kind)))
        none = pa.nulls(n, pa.list_(pa.int64()))
        yield pa.record_batch(
            [pa.array(np.full(n, block)), pa.array(ids, self.doc_type), pa.array(np.diff(a_at)), pa.array(np.diff(b_at)), pa.array(n_groups.astype(np.int64)),
             pa.array(n_links.astype(np.int64)), pa.array(digests, pa.string()), lists(steps, bounds, np.int32), lists(times, bounds, np.int32), none, none], NAMES)
        one = [pa.nulls(1, t) for t in (self.doc_type, *[pa.int64()] * 4, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))]
        whole = np.array([0, len(codes)])
        yield pa.record_batch([pa.array([block]), *one, lists(codes, whole, np.int64), lists(totals, whole, np.int64)], NAMES)

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc, data in zip(batch.column(0), batch.column(1)):
                data = data.as_py() or b""
                try:
                    text = data.decode()
                except UnicodeDecodeError:
                    text = ""
                ids.append(doc.as_py())
                texts.append(text)
                size += len(data)
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield from self.rows(block, ids, texts)
                    block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield from self.rows(block, ids, texts)


NAMES = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "steps", "times", "codes", "totals"]


def blocks(docs: DataFrame, byte_bpe: str, piece_bpe: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document (its sizes, digest, and the block's pairs it holds) and one per block (its pairs)."""
    with open(byte_bpe, encoding="utf-8") as f, open(piece_bpe, "rb") as g:
        files = sent(docs.sparkSession, (f.read(), g.read()))
    kind = docs.schema[doc_id].dataType
    arrow = to_arrow_type(kind)
    make, aligner = Tokenizers, _Blocks

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        yield from aligner(make(*files()), arrow).run(batches)

    long, ints, longs = T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    kinds = [long, kind, long, long, long, long, T.StringType(), ints, ints, longs, longs]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(NAMES, kinds)])
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(run, schema)


def pair_counts(table: DataFrame, n_b: int) -> DataFrame:
    """(code, count, best): links of every id pair in the corpus, and whether no pair of its B id has more."""
    pairs = table.where(F.col("codes").isNotNull()).select(F.explode(F.arrays_zip("codes", "totals")).alias("x"))
    counts = pairs.groupBy(F.col("x.codes").alias("code")).agg(F.sum("x.totals").alias("count"))
    most = counts.groupBy(F.pmod("code", F.lit(n_b)).alias("b")).agg(F.max("count").alias("most"))
    return counts.join(most, F.pmod("code", F.lit(n_b)) == F.col("b")).select("code", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_bpe: str, piece_bpe: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id (named ``doc_id``), tokens of both kinds, groups, links, the digest of the groups, ``n_best`` links
    whose pair is the most usual of its B id and ``count_sum``, the corpus counts of its links added up."""
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe).get_piece_size()
    table = written(blocks(docs, byte_bpe, piece_bpe, doc_id, text), "alignment")
    counts = written(pair_counts(table, n_b), "pair-counts")
    known = (table.where(F.col("codes").isNotNull()).select(F.col("block").alias("block"), F.explode("codes").alias("code")).join(counts, "code"))
    per_doc = table.where(F.col("codes").isNull()).drop("codes", "totals")
    names = [f.name for f in per_doc.schema if f.name not in ("block", "steps", "times")]
    schema = T.StructType([f for f in per_doc.schema if f.name in names] + [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")])

    def add_up(mine: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs.column("code").to_numpy())
        count, best = (pairs.column(c).to_numpy()[order] for c in ("count", "best"))
        sums = [[], []]
        for chunk in mine.to_batches():
            steps, times = chunk.column(chunk.schema.names.index("steps")), chunk.column(chunk.schema.names.index("times"))
            at = steps.offsets.to_numpy()
            held, n = np.cumsum(steps.values.to_numpy()[at[0]:at[-1]].astype(np.int64)), times.values.to_numpy()[at[0]:at[-1]]
            at = at - at[0]
            before = np.append(0, held)[at[:-1]]  # steps start anew at each document
            held = held - np.repeat(before, np.diff(at))
            for total, value in zip(sums, (n * best[held], n * count[held])):
                run = np.append(0, np.cumsum(value))
                total.append(run[at[1:]] - run[at[:-1]])
        out = mine.select(names)
        for name, total in zip(("n_best", "count_sum"), sums):
            out = out.append_column(name, pa.array(np.concatenate(total or [np.zeros(0, np.int64)]).astype(np.int64)))
        return out

    return per_doc.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(add_up, schema)

"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams (1 to 3 code points, lower-cased, everything in ASCII but letters read
as a blank) of every labelled text per language inside the tasks; Spark sums them.  The model is one
matrix of log probabilities, languages x 2**bits buckets x 8 bytes, whose size the labels and
``bits`` bound, never the corpus.  Scoring gathers the matrix rows of a text's n-grams, that is a
sparse count vector times the matrix, window by window.

Defined results: a null text, an empty one, or one without any letter is ``und`` with score 0; so is
every text when nothing was learned.  Rows with a null label teach nothing.  Equal posteriors go to
the language that sorts first.  Repeated rows are predicted alike, each in its own row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name, sent
from .words import slices

UNKNOWN = "und"
TEXT_SLICE = 1 << 20
GATHER = 1 << 18


@dataclass(frozen=True)
class Model:
    """``log_prob``: buckets x languages, ``prior``: languages, both natural logarithms."""
    languages: list[str]
    log_prob: np.ndarray
    prior: np.ndarray
    bits: int
    orders: tuple[int, ...]


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts in turn, where each begins, and whether it has a letter."""
    low = [t.decode("utf-8", "replace").lower() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in low])]).astype(np.int64)
    codes = np.frombuffer("".join(low).encode("utf-32-le", "replace"), np.uint32)
    other = (codes < 128) & ~((codes >= 97) & (codes <= 122))
    ascii_letter = np.concatenate([[0], np.cumsum((codes >= 97) & (codes <= 122))])
    letter = ascii_letter[bounds[1:]] > ascii_letter[bounds[:-1]]
    for i in np.flatnonzero(~letter):
        letter[i] = any(c.isalpha() for c in low[i])
    return np.where(other, np.uint32(32), codes), bounds, letter


def _buckets(codes: np.ndarray, bounds: np.ndarray, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of one order of each text, and where each text's begin."""
    size = np.maximum(np.diff(bounds) - order + 1, 0)
    out = np.concatenate([[0], np.cumsum(size)])
    if not out[-1]:
        return np.zeros(0, np.uint32), out
    h = np.full(len(codes) - order + 1, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for j in range(order):
        h = (h ^ codes[j:len(codes) - order + 1 + j]) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    h = h * np.uint32(0xC2B2AE35) >> np.uint32(32 - bits)
    keep = np.ones(len(codes) + 1, bool)
    full = np.diff(bounds) > 0
    for j in range(order - 1):  # no n-gram starts at a text's last places
        keep[np.maximum(bounds[1:] - 1 - j, bounds[:-1])[full]] = False
    keep = keep[:len(h)]
    return h[keep], out


def _count(batches: Iterator[pa.RecordBatch], orders: tuple[int, ...], bits: int) -> Iterator[pa.RecordBatch]:
    """One row per language and bucket of a task's texts; bucket -1 counts the texts."""
    known: dict[str, int] = {}
    counts: list[np.ndarray] = []
    docs: list[int] = []
    for batch in batches:
        lang = batch.column(1).to_pylist()
        for i, j, data, offsets in slices(batch.column(0), TEXT_SLICE):
            raw = data.tobytes()
            codes, bounds, _ = _codes([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            which = []
            for name in lang[i:j]:
                if name not in known:
                    known[name] = len(known)
                    counts.append(np.zeros(1 << bits, np.int64))
                    docs.append(0)
                which.append(known[name])
                docs[known[name]] += 1
            which = np.array(which)
            for order in orders:
                h, at = _buckets(codes, bounds, order, bits)
                owner = np.repeat(which, np.diff(at))
                for k in np.unique(which):
                    counts[k] += np.bincount(h[owner == k], minlength=1 << bits)
    for name, k in known.items():
        at = np.flatnonzero(counts[k])
        yield pa.RecordBatch.from_arrays([pa.array([name] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int32()),
                                          pa.array(np.append(counts[k][at], docs[k]), pa.int64())], names=["lang", "bucket", "n"])


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", bits: int = 14,
          orders: tuple[int, ...] = (1, 2, 3)) -> Model:
    """Fit on every row whose label and text are not null."""
    rows = labelled.select(F.col(text_col).cast("binary").alias("t"), F.col(lang_col).alias("l")).where("t is not null and l is not null")
    counts = (rows.mapInArrow(lambda b: _count(b, orders, bits), "lang string, bucket int, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(counts["lang"].unique())
    table = np.zeros((1 << bits, len(languages)))
    prior = np.zeros(len(languages))
    for k, name in enumerate(languages):
        own = counts[counts["lang"] == name]
        grams = own[own["bucket"] >= 0]
        table[grams["bucket"].to_numpy(), k] = grams["n"]
        prior[k] = own[own["bucket"] < 0]["n"].sum()
    total = table.sum(axis=0)
    return Model(languages, np.log(table + 1) - np.log(total + (1 << bits)), np.log(prior / max(prior.sum(), 1)), bits, orders)


def _scores(model: Model, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.tile(model.prior, (len(bounds) - 1, 1))
    step = max(1, GATHER // max(1, len(model.languages)) * 4)
    for order in model.orders:
        h, at = _buckets(codes, bounds, order, model.bits)
        doc = np.flatnonzero(np.diff(at))
        begin = at[:-1][doc]
        for lo in range(0, len(h), step):
            part = model.log_prob[h[lo:lo + step]]
            a = int(np.searchsorted(begin, lo, "right")) - 1
            b = int(np.searchsorted(begin, lo + step, "left"))
            out[doc[a:b]] += np.add.reduceat(part, np.maximum(begin[a:b] - lo, 0), axis=0)
    return out


def predictor(model: Model, spark):
    """A column function: text -> struct(lang_pred, score)."""
    shared = sent(spark, model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(text: pa.Array) -> pa.Array:
        m = shared()
        names, scores = [], []
        for _, _, data, offsets in slices(text, TEXT_SLICE):
            raw = data.tobytes()
            codes, bounds, letter = _codes([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            if not m.languages:
                letter = np.zeros(len(letter), bool)
                posterior = np.zeros((len(letter), 1))
            else:
                s = _scores(m, codes, bounds)
                posterior = np.exp(s - s.max(axis=1, keepdims=True))
                posterior /= posterior.sum(axis=1, keepdims=True)
            best = posterior.argmax(axis=1)
            names += [m.languages[k] if ok else UNKNOWN for k, ok in zip(best, letter)]
            scores.append(np.where(letter, posterior.max(axis=1), 0.0))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                                          names=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    predict = predictor(model, docs.sparkSession)
    p = free_name("_p", docs)
    other = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*other, predict(F.col(text_col).cast("binary")).alias(p)).select(
        *other, F.col(f"{p}.lang_pred").alias("lang_pred"), F.col(f"{p}.score").alias("score"))


def training_split(doc_id: Column, parts: int, held: int) -> Column:
    """True for held-out rows: crc32 of the id as text, modulo ``parts``, is ``held``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == held, F.lit(False))

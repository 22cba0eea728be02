"""Line deduplication across documents: explode normalised lines, hash, count distinct documents
per hash, drop the lines over the threshold, reassemble by position.

A line's key is the line stripped of blanks, tabs, newlines, vertical tabs, form feeds and carriage
returns at both ends, with A-Z lower-cased; only keys of at least ``min_chars`` code points count.
A key found in at least ``min_docs`` documents loses its lines everywhere but in the smallest id that
holds it.  Keys meet as 128-bit digests, once per document, and the grouping pre-aggregates, so a
line in a third of all documents shuffles as a few rows.  Only the digests that a document loses
are brought back to it.

Defined results: a null or empty text is one empty line and comes back as the empty text; rows with a
null id are not counted and lose nothing; rows that share an id are one document for the count and
each loses what that id loses; an empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free_name, written
from .words import SPACES

HASH = "struct<a:bigint,b:bigint>"


def key_digest(line: bytes, min_chars: int) -> bytes | None:
    """16-byte digest of a line's key, or None for a key under ``min_chars`` code points."""
    key = line.strip(SPACES).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return blake2b(key, digest_size=16).digest()


def _digests(min_chars: int):
    @F.arrow_udf(f"array<{HASH}>")
    def digests(text: pa.Array) -> pa.Array:
        out, at = [], [0]
        for t in text:
            found = {key_digest(x, min_chars) for x in (t.as_py() or b"").split(b"\n")}
            found.discard(None)
            out += found
            at.append(len(out))
        two = np.frombuffer(b"".join(out), np.int64).reshape(-1, 2)
        pairs = pa.StructArray.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1])], names=["a", "b"])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pairs)

    return digests


def _reassembler(min_chars: int):
    @F.arrow_udf("struct<text:string,n_lines:bigint,n_dropped:bigint>")
    def reassemble(text: pa.Array, lost: pa.Array) -> pa.Array:
        texts, n_lines, n_dropped = [], [], []
        for t, gone in zip(text, lost):
            lines = (t.as_py() or b"").split(b"\n")
            kept = lines
            if gone.is_valid:
                v = gone.values
                two = np.column_stack([v.field(0).to_numpy(), v.field(1).to_numpy()]).astype(np.int64)
                drop = {two[i].tobytes() for i in range(len(two))}
                kept = [x for x in lines if key_digest(x, min_chars) not in drop]
            texts.append(b"\n".join(kept))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
        return pa.StructArray.from_arrays([pa.array(texts, pa.binary()).cast(pa.string(), safe=False), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                                          names=["text", "n_lines", "n_dropped"])

    return reassemble


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                   min_docs: int = 2) -> DataFrame:
    """(id, a, b): the line digests that each document loses."""
    lines = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("id"), F.explode(_digests(min_chars)(F.col(text_col).cast("binary"))).alias("h"))
             .select("id", "h.a", "h.b"))
    # one row per document and digest (rows repeating an id apart), so min < max means two documents
    found = lines.groupBy("a", "b").agg(F.min("id").alias("keeper"), F.max("id").alias("last"), F.count("*").alias("n"))
    found = found.where((F.col("keeper") != F.col("last")) & (F.col("n") >= min_docs))
    if min_docs > 2:
        exact = lines.distinct().groupBy("a", "b").count().where(F.col("count") >= min_docs)
        found = found.join(exact, ["a", "b"], "left_semi")
    # as a table of its own, so that the join's partitions of a frequent line can be split
    found = written(found.select("a", "b", "keeper"), "repeated-lines")
    return lines.join(found, ["a", "b"]).where(F.col("id") != F.col("keeper")).select("id", "a", "b")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                min_docs: int = 2) -> DataFrame:
    """``docs`` with the text of its kept lines, ``n_lines`` (before) and ``n_dropped``; columns of
    these names are replaced, all others stay."""
    gone, gone_id, r = (free_name(c, docs) for c in ("_lost", "_lost_id", "_r"))
    lost = repeated_lines(docs, id_col, text_col, min_chars, min_docs)
    lost = lost.groupBy("id").agg(F.collect_set(F.struct("a", "b")).alias(gone)).withColumnRenamed("id", gone_id)
    other = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped", text_col)]
    out = docs.join(lost, F.col(id_col) == F.col(gone_id), "left")
    out = out.select(*other, _reassembler(min_chars)(F.col(text_col).cast("binary"), F.col(gone)).alias(r))
    made = {text_col: f"{r}.text", "n_lines": f"{r}.n_lines", "n_dropped": f"{r}.n_dropped"}
    order = [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    return out.select(*(F.col(made[c]).alias(c) if c in made else F.col(f"`{c}`") for c in order))

"""Token counts of greedy longest-match word pieces by a linear automaton, without building pieces.

The vocabulary holds word-initial pieces and continuation pieces.  Both stand in one byte trie with
two roots.  A node that is a piece fails to the continuation root and pops one token; any other node
fails to where its parent's failure chain can go on with its byte, and pops what that chain pops.
With the number of popped tokens stored at every node, one pass over a word's bytes gives its count.
A word that no sequence of pieces covers is one unknown token.

A batch's distinct words run through the automaton once each; words are told apart by their bytes'
64-bit hash within the batch.

Defined results: a null or empty text, or one of blanks, has no words and no tokens; repeated rows
are counted each; extra columns stay, those named like the results are replaced.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free_name, sent
from .words import slices, words

INITIAL, CONTINUATION, NOWHERE = 0, 1, -1
MARK = "▁"  # begins the word-initial pieces of the vocabulary file


def sentencepiece_vocabulary(path: str) -> tuple[list[bytes], list[bytes]]:
    """(word-initial, continuation) pieces of a model file, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    pieces = [model.id_to_piece(i) for i in ids]
    return ([p[1:].encode() for p in pieces if p.startswith(MARK) and len(p) > 1],
            [p.encode() for p in pieces if not p.startswith(MARK)])


class Automaton:
    """``step[node << 8 | byte]`` is the next node, ``fail[node]`` the failure link and ``popped[node]``
    the number of tokens that following it pops."""

    def __init__(self, initial: Iterable[bytes], continuation: Iterable[bytes]):
        step: dict[int, int] = {}
        ends: set[int] = set()
        children: list[list[tuple[int, int]]] = [[], []]
        for root, pieces in ((INITIAL, initial), (CONTINUATION, continuation)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in step:
                        step[key] = len(children)
                        children[node].append((byte, len(children)))
                        children.append([])
                    node = step[key]
                if piece:
                    ends.add(node)
        fail, popped = [NOWHERE] * len(children), [0] * len(children)
        todo = deque([INITIAL, CONTINUATION])
        while todo:
            u = todo.popleft()
            for byte, v in children[u]:
                if v in ends:
                    fail[v], popped[v] = CONTINUATION, 1
                else:
                    z, n = fail[u], popped[u]
                    while z != NOWHERE and z << 8 | byte not in step:
                        n += popped[z]
                        z = fail[z]
                    if z != NOWHERE:
                        fail[v], popped[v] = step[z << 8 | byte], n
                todo.append(v)
        self.step, self.fail, self.popped = step, fail, popped

    def count(self, word: bytes) -> int:
        """Number of pieces of the word, 0 if pieces can't cover it."""
        step, fail, popped = self.step, self.fail, self.popped
        node, n = INITIAL, 0
        for byte in word:
            while (go := step.get(node << 8 | byte)) is None:
                n += popped[node]
                node = fail[node]
                if node == NOWHERE:
                    return 0
            node = go
        while node != CONTINUATION:
            n += popped[node]
            node = fail[node]
            if node == NOWHERE:
                return 0
        return n


def _counter(automaton):
    @F.arrow_udf("struct<n_words:bigint,n_tokens:bigint,n_unknown:bigint>")
    def count(text: pa.Array) -> pa.Array:
        a = automaton()
        cols: list[list[np.ndarray]] = [[], [], []]
        for _, _, data, offsets in slices(text, 16 << 20):
            raw = data.tobytes()
            hashes, starts, ends, at = words(data, offsets, lower=False)
            exact, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            pieces = np.array([a.count(raw[s:e]) for s, e in zip(starts[first].tolist(), ends[first].tolist())], np.int64)
            pieces = pieces[which] if len(exact) else np.zeros(0, np.int64)
            unknown = np.concatenate([[0], np.cumsum(pieces == 0)])
            tokens = np.concatenate([[0], np.cumsum(np.maximum(pieces, 1))])
            for col, values in zip(cols, (at[1:] - at[:-1], tokens[at[1:]] - tokens[at[:-1]], unknown[at[1:]] - unknown[at[:-1]])):
                col.append(values)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in cols],
                                          names=["n_words", "n_tokens", "n_unknown"])

    return count


def count_tokens(docs: DataFrame, initial: Iterable[bytes], continuation: Iterable[bytes], text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_tokens`` and ``n_unknown``.  The automaton goes out to the workers;
    the vocabulary bounds its size."""
    automaton = sent(docs.sparkSession, Automaton(initial, continuation))
    made = ("n_words", "n_tokens", "n_unknown")
    counts = free_name("_c", docs)
    other = [F.col(f"`{c}`") for c in docs.columns if c not in made]
    out = docs.select(*other, _counter(automaton)(F.col(text_col).cast("binary")).alias(counts))
    return out.select(*other, *(F.col(f"{counts}.{c}").alias(c) for c in made))

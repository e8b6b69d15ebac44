"""Token counts by trie-shared dynamic programming.

A text's pre-tokens are its white-space separated words behind a word mark. A fixed public piece
vocabulary gets unigram log-probabilities by rank (Zipf: the piece of rank r has probability 1 / (r H)),
and a character outside it falls back to its UTF-8 bytes. The best segmentation of every *distinct* pre-token
of a run of texts is found over their trie: the pre-tokens are visited in lexicographic order, which is a
depth-first walk of the trie, so the forward scores of a shared prefix are computed once and stay on the path
stack; a terminal stores its token count and score. Terminals are remembered between runs up to a bound.

Defined cases: null or empty text has 0 pre-tokens, 0 tokens and score 0; equal scores prefer fewer tokens;
a very long word is one pre-token; repeated rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame

from sparkwright.llm.textutil import DEFAULT_PIECES, piece_vocabulary, slices, texts_of

MARK = "▁"
REMEMBERED = 300_000


class PieceScores:
    """log-probability of every piece, the longest piece, and the cost of a fallback byte."""

    def __init__(self, pieces: list[str]):
        norm = math.log(sum(1.0 / (r + 1) for r in range(len(pieces) + 256)))
        self.score = {p: -math.log(r + 1) - norm for r, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.byte = -math.log(len(pieces) + 256) - norm


def terminals(sorted_tokens: list[str], v: PieceScores):
    """(tokens, score) of the best segmentation of each pre-token, given in lexicographic order."""
    get, longest = v.score.get, v.longest
    best, count, before = [0.0], [0], ""
    for token in sorted_tokens:
        shared = len(commonprefix((before, token)))
        del best[shared + 1:], count[shared + 1:]
        for end in range(shared + 1, len(token) + 1):
            top, n = -math.inf, 0
            for start in range(max(0, end - longest), end):
                s = get(token[start:end])
                if s is not None:
                    s += best[start]
                    if s > top or s == top and count[start] + 1 < n:
                        top, n = s, count[start] + 1
            if token[end - 1] not in v.score:
                width = len(token[end - 1].encode("utf-8", "replace"))
                s = best[end - 1] + width * v.byte
                if s > top or s == top and count[end - 1] + width < n:
                    top, n = s, count[end - 1] + width
            best.append(top)
            count.append(n)
        before = token
        yield count[-1], best[-1]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", pieces_path: str = DEFAULT_PIECES) -> DataFrame:
    """id_col, n_bytes, n_pretokens, n_tokens, log_score for every row of docs; no shuffle."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(piece_vocabulary(pieces_path))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        v = PieceScores(vocabulary.value)
        known: dict[bytes, tuple[int, float]] = {}
        for whole in batches:
            for batch in slices(whole):
                texts = texts_of(batch)
                counted = [Counter(t.split()) for t in texts]
                new = sorted((MARK + w.decode("utf-8", "replace"), w) for w in set().union(*counted) - known.keys())
                known.update(zip([w for _, w in new], terminals([t for t, _ in new], v)))
                rows = [(sum(c.values()), *map(sum, zip(*((n * known[w][0], n * known[w][1]) for w, n in c.items()))))
                        if c else (0, 0, 0.0) for c in counted]
                if len(known) > REMEMBERED:
                    known.clear()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.float64())],
                    names=[id_col, "n_bytes", "n_pretokens", "n_tokens", "log_score"])

    return docs.select(id_col, "text").mapInArrow(
        run, f"`{id_col}` {id_type}, n_bytes long, n_pretokens long, n_tokens long, log_score double")

"""Language ID by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary (plus the 256 single bytes, so that
any text can be segmented). A word's probability is the sum over *all* its segmentations, found by the forward
algorithm; words are independent, so a text's log-probability is the sum over its words, and each distinct word is
computed once for a run of texts. The probabilities come from expectation maximisation (forward-backward) over the
word counts of a bounded sample of labelled rows: about ``per_language`` training documents of each language, whole,
chosen by hash. The prediction is the language of highest probability; the score is its posterior under equal priors.

Defined cases: null text, or a text without a letter, gives ``und`` and score 0; rows with null lang are not learned
from; with no labelled row at all every row is ``und``; ties go to the language first by code point; repeated rows
are predicted each; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from sparkwright.llm.textutil import DEFAULT_PIECES, piece_vocabulary, slices, texts_of, train_row, words_of

PER_LANGUAGE = 1000
EM_ROUNDS = 2
SMOOTHING = 0.05
WIDTHS = (8, 16, 32)          # words are packed in arrays of these widths
AT_ONCE = 8192                # words whose forward tables are held together
REMEMBERED = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F))
_TABLE_BITS = 20


def _hash(piece: bytes) -> int:
    h = 0
    for c in piece:
        h = (h * int(_BASE) + c + 1) & 0xFFFFFFFFFFFFFFFF
    return h


class Pieces:
    """Vocabulary lookup of many substrings at once: polynomial hashes in two direct-addressed tables."""

    def __init__(self, pieces: list[str]):
        units = [bytes([b]) for b in range(256)]
        self.units = units + sorted({p.replace("▁", " ").encode() for p in pieces} - set(units))
        self.index = {u: i for i, u in enumerate(self.units)}
        self.longest = max(map(len, self.units))
        keys = np.array([_hash(u) for u in self.units], np.uint64)
        self.tables, left = [], np.arange(len(keys))
        for mix in _MIX:
            slot = (keys[left] * mix) >> np.uint64(64 - _TABLE_BITS)
            _, firsts = np.unique(slot, return_index=True)
            key, unit = np.zeros(1 << _TABLE_BITS, np.uint64), np.full(1 << _TABLE_BITS, -1, np.int32)
            key[slot[firsts]], unit[slot[firsts]] = keys[left][firsts], left[firsts]
            self.tables.append((mix, key, unit))
            left = np.delete(left, firsts)
        self.rest = {int(keys[i]): int(i) for i in left}

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece number of each hash, -1 where there is none."""
        out = np.full(len(h), -1, np.int32)
        for mix, key, unit in self.tables:
            slot = (h * mix) >> np.uint64(64 - _TABLE_BITS)
            hit = key[slot] == h
            np.copyto(out, unit[slot], where=hit & (out < 0))
        for k, i in self.rest.items():
            out[h == np.uint64(k)] = i
        return out


def _packed(words: list[bytes], width: int):
    size = np.array([len(w) for w in words])
    text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    prefix = np.zeros((width + 1, len(words)), np.uint64)
    for d in range(width):
        prefix[d + 1] = prefix[d] * _BASE + text[:, d].astype(np.uint64) + np.uint64(1)
    return size, prefix


def _substrings(pieces: Pieces, words: list[bytes], width: int):
    """For every end d and start j: the words that have a piece there, and the piece."""
    size, prefix = _packed(words, width)
    power = [np.uint64(pow(int(_BASE), k, 1 << 64)) for k in range(width + 1)]
    for d in range(1, width + 1):
        live = np.flatnonzero(size >= d)
        if not len(live):
            break
        for j in range(max(0, d - pieces.longest), d):
            unit = pieces.find(prefix[d, live] - prefix[j, live] * power[d - j])
            has = unit >= 0
            if has.any():
                yield d, j, live[has], unit[has]


def _by_width(words: list[bytes]):
    """Index lists of the words that fit each width, AT_ONCE at a time, and of the longer ones."""
    size = np.array([len(w) for w in words])
    low = 0
    for width in WIDTHS:
        rows = np.flatnonzero((size > low) & (size <= width))
        for start in range(0, len(rows), AT_ONCE):
            yield width, rows[start:start + AT_ONCE]
        low = width
    yield None, np.flatnonzero(size > low)


def _long_word(pieces: Pieces, prob: np.ndarray, word: bytes, weight=None, counts=None) -> np.ndarray:
    """Forward (and, with counts, backward) pass over one word of any length, scaled at each position."""
    n, longest = len(word), pieces.longest
    alpha, scale = np.zeros((n + 1, prob.shape[1])), np.zeros((n + 1, prob.shape[1]))
    alpha[0] = 1.0      # alpha[d] is the forward sum divided by exp(scale[d])
    found = []
    for d in range(1, n + 1):
        at = [(j, pieces.index[word[j:d]]) for j in range(max(0, d - longest), d) if word[j:d] in pieces.index]
        found.append(at)
        total = sum(alpha[j] * np.exp(scale[j] - scale[d - 1]) * prob[u] for j, u in at)
        alpha[d], scale[d] = 1.0, scale[d - 1] + np.log(total)
    if counts is not None:
        back = np.zeros((n + 1, prob.shape[1]))     # posterior that a boundary lies at d
        back[n] = 1.0
        for d in range(n, 0, -1):
            for j, u in found[d - 1]:
                g = back[d] * np.exp(scale[j] - scale[d]) * prob[u]
                back[j] += g
                counts[u] += g * weight
    return scale[n]


def word_scores(pieces: Pieces, prob: np.ndarray, words: list[bytes]) -> np.ndarray:
    """log-probability of each word in each language, all segmentations summed. prob: pieces x languages."""
    out = np.zeros((len(words), prob.shape[1]))
    for width, rows in _by_width(words):
        if not len(rows):
            continue
        if width is None:
            for r in rows:
                out[r] = _long_word(pieces, prob, words[r])
            continue
        own = [words[r] for r in rows]
        alpha = np.zeros((width + 1, len(own), prob.shape[1]))
        alpha[0] = 1.0
        for d, j, at, unit in _substrings(pieces, own, width):
            alpha[d, at] += alpha[j, at] * prob[unit]
        out[rows] = np.log(alpha[[len(w) for w in own], range(len(own))])
    return out


def _expected(pieces: Pieces, prob: np.ndarray, words: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Expected piece counts (forward-backward) over words with their weights in each language."""
    counts = np.zeros_like(prob)
    for width, rows in _by_width(words):
        if not len(rows):
            continue
        if width is None:
            for r in rows:
                _long_word(pieces, prob, words[r], weights[r], counts)
            continue
        own, size = [words[r] for r in rows], np.array([len(words[r]) for r in rows])
        found = [*_substrings(pieces, own, width)]
        alpha, beta = (np.zeros((width + 1, len(own), prob.shape[1])) for _ in range(2))
        alpha[0] = 1.0
        for d, j, at, unit in found:
            alpha[d, at] += alpha[j, at] * prob[unit]
        beta[size, range(len(own))] = weights[rows] / alpha[size, range(len(own))]
        for d, j, at, unit in reversed(found):
            beta[j, at] += beta[d, at] * prob[unit]
        for d, j, at, unit in found:
            np.add.at(counts, unit, alpha[j, at] * prob[unit] * beta[d, at])
    return counts


def fit(pieces: Pieces, words: list[bytes], weights: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Piece probabilities (pieces x languages) from word counts (words x languages)."""
    prob = np.full((len(pieces.units), weights.shape[1]), 1.0 / len(pieces.units))
    for _ in range(rounds):
        counts = _expected(pieces, prob, words, weights) + SMOOTHING
        prob = counts / counts.sum(axis=0)
    return prob


def _word(w: bytes) -> bytes:
    return b" " + w


def train(docs: DataFrame, held_out, per_language: int = PER_LANGUAGE, pieces_path: str = DEFAULT_PIECES):
    """(languages, Pieces, probabilities) from docs (doc_id, text, lang) that are not held out.

    The sample is bounded: in each language the rows whose hash falls below per_language / rows of that language.
    """
    pool = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = {r["lang"]: r["count"] for r in pool.groupBy("lang").count().collect()}
    languages = sorted(rows, key=lambda s: s.encode())
    pieces = Pieces(piece_vocabulary(pieces_path))
    if not languages:
        return [], pieces, np.zeros((len(pieces.units), 0))
    rate = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, per_language / rows[k]))])
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30) < rate[F.col("lang")]

    def count(batches):
        for batch in batches:
            by_lang: dict[str, Counter] = {}
            for lang, text in zip(batch.column(1).to_pylist(), texts_of(batch)):
                by_lang.setdefault(lang, Counter()).update(words_of(text))
            rows = [(k, w, n) for k, c in by_lang.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (
                pa.string(), pa.binary(), pa.int64()))], names=["lang", "word", "n"])

    sample = pool.where(drawn).select("text", "lang").mapInArrow(count, "lang string, word binary, n long") \
        .groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    words, at = [], {}
    weights = np.zeros((len(set(sample["word"].to_pylist())), len(languages)))
    for lang, word, n in zip(*(sample[c].to_pylist() for c in ("lang", "word", "n"))):
        if word not in at:
            at[word] = len(words)
            words.append(_word(word))
        weights[at[word], languages.index(lang)] += n
    return languages, pieces, fit(pieces, words, weights)


def predict(docs: DataFrame, model, pieces_path: str = DEFAULT_PIECES, names: tuple = ("lang_pred", "score")) -> DataFrame:
    """docs (any columns, text among them) with the prediction and its score under the given names; no shuffle."""
    languages, _, prob = model
    sent = docs.sparkSession.sparkContext.broadcast((languages, piece_vocabulary(pieces_path), prob.astype(np.float32)))
    docs = docs.drop(*names)
    schema = StructType([*docs.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())])

    def run(batches):
        languages, vocabulary, prob = sent.value
        pieces, prob = Pieces(vocabulary), prob.astype(np.float64)
        known: dict[bytes, int] = {}
        scores = np.zeros((1 << 16, max(1, len(languages))), np.float32)
        for whole in batches:
            for batch in slices(whole):
                texts = texts_of(batch)
                counted = [Counter(words_of(t)) for t in texts]
                if languages:
                    new = list(set().union(*counted) - known.keys())
                    while len(known) + len(new) > len(scores):
                        scores = np.concatenate([scores, np.zeros_like(scores)])
                    scores[len(known):len(known) + len(new)] = word_scores(pieces, prob, [_word(w) for w in new])
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                out = []
                for text, c in zip(texts, counted):
                    if not languages or not any(ch.isalpha() for ch in text.decode("utf-8", "replace")):
                        out.append(("und", 0.0))
                        continue
                    at = np.fromiter(map(known.__getitem__, c), np.int64, len(c))
                    total = np.fromiter(c.values(), np.float64, len(c)) @ scores[at].astype(np.float64)
                    best = int(np.argmax(total))
                    out.append((languages[best], float(1.0 / np.exp(total - total[best]).sum())))
                if len(known) > REMEMBERED:
                    known.clear()
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())],
                    names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs whose language is told with a score of at least ``least``, all columns kept."""
    model = train(docs.select("doc_id", "text", "lang"), train_row(F.col("doc_id"), 3, 1))
    names = ("_lang_pred", "_lang_score")
    return predict(docs, model, names=names).where(f"{names[0]} <> 'und' and {names[1]} >= {least}").drop(*names)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from rows whose crc32(doc_id) mod 3 is not 1."""
    held = train_row(F.col("doc_id"), 3, 1)
    model = train(docs.select("doc_id", "text", "lang"), held)
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")

"""LM scoring by online logistic context mixing.

A text is scored as its lower-cased tokens and its end: the same events as the unigram base's. A token is coded as the
bits of a code tree over the training words with at least a ``CODED``-th of all occurrences, and one leaf for all rarer
words. Each tree node starts from its log odds in the training counts. Three hashed contexts (``contexts``) then predict
each bit: a (context, node) pair hashes to a cell with the counts of ones and zeros over all training texts, and its
input is how far these counts move the node's odds. Inputs and start are combined by a gated linear mixer: the gate is
how much the second context has seen, the weights move along the coding gradient after every ``STEP`` tokens. A last
stage corrects the mixed log odds by buckets, learned the same way. So a bit's prediction uses only bits before it, and
the log probabilities of all bits add up to the text's. Mixer and correction start afresh every ``LANE`` tokens of a
text, which lets many stretches be scored side by side and makes a text's score independent of its neighbours.

A word of the rare leaf is then told by its own training count, whatever their number: counts of the words with at least
a ``COMMON``-th of all occurrences are broadcast (at most COMMON words), all others are found by a join. A word not
seen in training is spelled byte by byte, each predicted from the two before it.

So what is gathered grows with the input: token counts without bound, context cells with the training tokens up to
2^``MOST_CELLS`` (one byte each when scoring). Counting tasks send their non-zero counters, blocks of them are added up and
finished on a task each, and the driver gets the finished bytes.

Defined cases: null text is empty; an empty text is its end alone; without training rows all counts are 0; repeated
rows are scored each; an empty table gives no rows. Tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from sparkwright.session import cut_lineage
from sparkwright.llm.textutil import WordHashes, mixed, slices, texts_of, train_row, words_of

LANE, STEP = 512, 8                       # tokens
GATES, BUCKETS = 4, 24
RATE, BUCKET_RATE, TRUST = 0.02, 0.02, 2.0
START_WEIGHTS = (1.0, 0.3, 0.4, 0.3)
CODED, COMMON = 1 << 16, 1 << 21
CUES, CLASSES = 1 << 7, 61                # least share of a cue word; ending classes of other words
FEWEST_CELLS, MOST_CELLS = 15, 24         # log2
TOKENS_A_CELL = 16
TASK_TOKENS = 1 << 26
SPELLINGS, BACKOFF = 1 << 12, 4.0         # slots: a byte and the low half of the one before it
SLICE = 1 << 20                           # bytes of text worked on together
BLOCK = 1 << 16                           # counters added up together
END = b"\n"
COUNTS = np.array([0, 1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128, 512, 2048, 8192])   # a cell's byte names one each of ones and zeros
ONES, ZEROS = np.repeat(COUNTS, 16).astype(np.float32), np.tile(COUNTS, 16).astype(np.float32)
LEVEL = np.digitize(ONES + ZEROS, [1, 4, 64]).astype(np.int64)
GRID = 64                                 # levels of a node's start odds, a quarter apart
_START = (np.arange(GRID) - GRID // 2) / 4
_ONE = 1 / (1 + np.exp(-_START[:, None]))
# how far a cell moves the odds, by (level of the start odds, cell byte)
MOVES = (np.log((ONES + TRUST * _ONE) / (ZEROS + TRUST * (1 - _ONE))) - _START[:, None]).astype(np.float32).ravel()


def cell_bits(tokens: int) -> int:
    return min(MOST_CELLS, max(FEWEST_CELLS, (max(1, tokens) // TOKENS_A_CELL).bit_length()))


_SPREAD = np.uint64(0xD1342543DE82EF95)


def hash_of(word: bytes) -> int:
    return int(np.array([xxh3_64_intdigest(word) | 1], np.uint64).view(np.int64)[0])


class Code:
    """Tree over leaves of falling mass: a node covers low <= leaf < high and is split where its mass is halved."""

    def __init__(self, mass: np.ndarray):
        total = np.concatenate([[0.0], np.cumsum(mass)])
        low, high, levels, odds, made = np.zeros(1, np.int64), np.array([len(mass)]), [], [], 0
        leaf = np.arange(len(mass))
        while len(low := low[(wide := high - low > 1)]):
            high = high[wide]
            mid = np.clip(np.searchsorted(total, (total[low] + total[high]) / 2), low + 1, high - 1)
            at = np.maximum(np.searchsorted(low, leaf, "right") - 1, 0)
            inside = (leaf >= low[at]) & (leaf < high[at])
            levels.append((np.where(inside, made + at, -1).astype(np.int32), leaf >= mid[at]))
            odds.append(np.log((total[high] - total[mid]) / (total[mid] - total[low])))
            made += len(low)
            low, high = np.stack([low, mid], 1).ravel(), np.stack([mid, high], 1).ravel()
        self.odds = np.concatenate(odds or [np.zeros(0)]).astype(np.float32)
        node = np.stack([n for n, _ in levels], 1) if levels else np.zeros((len(mass), 0), np.int32)
        bit = np.stack([b for _, b in levels], 1) if levels else np.zeros((len(mass), 0), bool)
        self.length = (node >= 0).sum(1)
        self.first = np.cumsum(self.length) - self.length
        node, self.bit = node[node >= 0], bit[node >= 0].astype(np.int32)
        self.key = (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) * _SPREAD
        self.start = self.odds[node]
        self.row = np.clip(np.rint(self.start * 4) + GRID // 2, 0, GRID - 1).astype(np.int64) * 256
        self.sign = (2 * self.bit - 1).astype(np.float32)

    def bits(self, leaf: np.ndarray):
        """(number of bits of each leaf, index of every bit in the arrays of bits)."""
        length = self.length[leaf]
        ahead = self.first[leaf] - (np.cumsum(length) - length)
        return length, np.arange(length.sum()) + np.repeat(ahead, length)


class Vocabulary:
    """Known words as sorted hashes with their counts; the most frequent have a leaf of the code tree (0: the rare leaf)."""

    def __init__(self, known: np.ndarray, times: np.ndarray, tokens: int, once: int):
        order = np.argsort(known)
        self.known, self.times, self.tokens = known[order], times[order], tokens
        coded = np.flatnonzero(self.times >= max(1.0, tokens / CODED))
        self.rare = tokens - int(self.times[coded].sum())
        self.new = once + 1                    # words met once stand for those never met
        mass = np.concatenate([[self.rare + self.new], self.times[coded]])
        rank = np.argsort(-mass, kind="stable")
        number = np.argsort(rank)
        self.rare_leaf = int(number[0])
        self.leaf = np.full(len(self.known) + 1, self.rare_leaf, np.int32)       # the last entry is of unknown words
        self.leaf[coded] = number[1:]
        self.mass = mass[rank]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash, or the number of known words."""
        at = np.searchsorted(self.known, h)
        if len(self.known):
            at[self.known[np.minimum(at, len(self.known) - 1)] != h] = len(self.known)
        return at


class Words(dict):
    """Number of each word met by a task, and by number: hash, place among the known words, leaf, contexts' view, length;
    for learning also whether its spelling counts (rare words, and those met once) and the cells of its bytes."""

    def __init__(self, vocabulary: Vocabulary, cells: int, spell: bool = False, bound: int = 300_000):
        super().__init__()
        self.spell, self.vocabulary, self.bound, self.common = spell, vocabulary, bound, 1 << max(0, cells - 13)
        self.restart()

    def restart(self):
        self.clear()
        self.list, self.h = [], np.zeros(0, np.int64)
        self.at, self.leaf, self.cue, self.kind, self.length = (np.zeros(0, t) for t in (np.int64, np.int32, bool, np.uint64, np.int64))
        self.rare, self.start, self.spelling = np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.list)
        self.list.append(word)
        return number

    def numbers(self, flat: list[bytes]) -> np.ndarray:
        if len(self.list) > self.bound:
            self.restart()
        out, old = np.fromiter(map(self.__getitem__, flat), np.int32, len(flat)), len(self.h)
        new, v = self.list[old:], self.vocabulary
        h = np.fromiter((xxh3_64_intdigest(w) | 1 for w in new), np.uint64, len(new)).view(np.int64)
        at = v.find(h)
        times = np.append(v.times, 0)[at]
        cue = (times * CUES >= v.tokens) & (times > 0) & (h != hash_of(END))
        ending = np.fromiter((int.from_bytes(w[-2:], "little") % CLASSES for w in new), np.int64, len(new))
        kind = np.where(times * self.common >= max(v.tokens, 1), h, ending).view(np.uint64)
        more = (h, at, v.leaf[at], cue, kind, np.fromiter(map(len, new), np.int64, len(new)))
        self.h, self.at, self.leaf, self.cue, self.kind, self.length = (np.concatenate(x) for x in zip(
            (self.h, self.at, self.leaf, self.cue, self.kind, self.length), more))
        if self.spell and new:
            start, cell = spelled(new)
            self.rare = np.concatenate([self.rare, (times <= 1) | (times * CODED < v.tokens)])
            self.start = np.concatenate([self.start, start + len(self.spelling)])
            self.spelling = np.concatenate([self.spelling, cell.astype(np.int32)])
        return out


class Run:
    """The tokens of some texts as arrays: the text, the offset in it, the word's number, the leaf and the contexts."""

    def __init__(self, texts: list[bytes], words: Words):
        flat, size = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = words_of(text)
            flat += own
            flat.append(END)
            size[i] = len(own) + 1
        self.word = words.numbers(flat)
        self.size, self.doc = size, np.repeat(np.arange(len(texts)), size)
        self.offset = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        self.leaf = words.leaf[self.word]
        self.contexts = self._contexts(words)

    def _contexts(self, words: Words) -> list[np.ndarray]:
        """Hashes of: the last cue word; the word before, or its ending if it is not common; the last two cue words."""
        i = np.arange(len(self.word))
        start = i - self.offset
        last = np.concatenate([[-1], np.maximum.accumulate(np.where(words.cue[self.word], i, -1))[:-1]])
        in_text = last >= start
        two = np.where(in_text, last[np.maximum(last, 0)], -1)
        word = lambda at, ok: np.where(ok, words.h[self.word[np.maximum(at, 0)]], 0).view(np.uint64)
        a = mixed(word(last, in_text) + np.uint64(1))
        b = mixed(np.where(self.offset > 0, words.kind[self.word[np.maximum(i - 1, 0)]], np.uint64(CLASSES)) + np.uint64(2))
        slot = mixed(a * np.uint64(3) + word(two, two >= start)) % np.uint64(words.common)
        return [x * _SPREAD for x in (a, b, mixed(slot + np.uint64(3)))]


def cells_of(run_contexts: list[np.ndarray], length: np.ndarray, key: np.ndarray, cells: int):
    """The cell of every bit in each context: the top bits of a multiplied sum."""
    for context in run_contexts:
        yield ((np.repeat(context, length) + key) >> np.uint64(64 - cells)).view(np.int64)


def spelled(words: list[bytes]):
    """(start of each word, cell of each byte) with an end behind each word; a cell is a slot of two bytes and the byte."""
    size = np.array([len(w) + 1 for w in words], np.int64)
    data = np.frombuffer(b"".join(w + END for w in words), np.uint8).astype(np.int64)
    start = np.cumsum(size) - size
    offset = np.arange(len(data)) - np.repeat(start, size)
    one, two = (np.where(offset >= k, np.roll(data, k), 10) for k in (1, 2))
    return start, (one * 16 + two % 16) * 256 + data


class Counters:
    """Ones and zeros of every cell, then the counts of spelled bytes, in one array."""

    def __init__(self, cells: int):
        self.cells, self.all = cells, np.zeros((2 << cells) + SPELLINGS * 256, np.int32)

    def learn(self, run: Run, code: Code, words: Words):
        length, bit = code.bits(run.leaf)
        ones = code.bit[bit]
        for cell in cells_of(run.contexts, length, code.key[bit], self.cells):
            np.add.at(self.all, cell * 2 + ones, np.int32(1))
        word = run.word[words.rare[run.word]]
        length = words.length[word] + 1
        at = np.arange(length.sum()) + np.repeat(words.start[word] - (np.cumsum(length) - length), length)
        np.add.at(self.all, words.spelling[at].astype(np.int64) + (2 << self.cells), np.int32(1))


def finished(block: np.ndarray, spelling: bool) -> bytes:
    """A block of counters as scoring wants it: a byte per cell; spelling counts stay as they are."""
    if spelling:
        return block.astype(np.int64).tobytes()
    level = (np.searchsorted(COUNTS, block, "right") - 1).astype(np.uint8).reshape(-1, 2)
    return (level[:, 1] * 16 + level[:, 0]).astype(np.uint8).tobytes()


def spelling_table(counts: np.ndarray) -> np.ndarray:
    """log10 probability of each byte in each slot, smoothed by the byte before alone and that by all bytes."""
    n = counts.reshape(256, SPELLINGS // 256, 256).astype(float)
    p = np.full(256, 1 / 256)
    for level in (n.sum((0, 1)), n.sum(1)[:, None, :], n):
        p = (level + BACKOFF * p) / (level.sum(-1, keepdims=True) + BACKOFF)
    return np.log10(p).astype(np.float32).ravel()


class Model:
    def __init__(self, vocabulary: Vocabulary, cells: int, table: np.ndarray, spelling: np.ndarray):
        self.vocabulary, self.cells, self.code = vocabulary, cells, Code(vocabulary.mass)
        self.table, self.spelling = table, spelling

    def leaf_costs(self, run: Run) -> np.ndarray:
        """Cost in nats of each token's leaf."""
        lanes_of = -(-run.size // LANE)
        lane = ((np.cumsum(lanes_of) - lanes_of)[run.doc] + run.offset // LANE)
        step = (run.offset % LANE // STEP).astype(np.uint8)
        order = np.argsort(step, kind="stable")
        bounds = np.searchsorted(step[order], np.arange(LANE // STEP + 1))
        weights = np.tile(np.array(START_WEIGHTS, np.float32)[:, None], (1, int(lanes_of.sum()) * GATES))
        adjust = np.zeros(int(lanes_of.sum()) * BUCKETS, np.float32)
        lost = np.zeros(len(run.leaf))
        for a, b in zip(bounds, bounds[1:]):
            if a < b:
                at = order[a:b]
                lost[at] = self._step(run.leaf[at], [c[at] for c in run.contexts], lane[at], weights, adjust)
        return lost

    def _step(self, leaf, contexts, lane, weights, adjust):
        """Costs under the current weights, which are then moved."""
        length, bit = self.code.bits(leaf)
        lane = np.repeat(lane, length)
        row, sign, inputs = self.code.row[bit], self.code.sign[bit], [self.code.start[bit]]
        for i, cell in enumerate(cells_of(contexts, length, self.code.key[bit], self.cells)):
            seen = self.table.take(cell)
            inputs.append(MOVES.take(row + seen))
            if i == 1:
                gate = lane * GATES + LEVEL.take(seen)
        odds = weights[0].take(gate) * inputs[0]
        for w, x in zip(weights[1:], inputs[1:]):
            odds += w.take(gate) * x
        bucket = np.minimum(np.maximum(odds * 2 + BUCKETS / 2, 0), BUCKETS - 1).astype(np.int64) + lane * BUCKETS
        odds += adjust.take(bucket)
        e = np.exp(np.minimum(np.maximum(-sign * odds, -18), 18))
        error = sign * (e / (1 + e))
        for w, x in zip(weights, inputs):
            w += (RATE * np.bincount(gate, weights=error * x, minlength=len(w))).astype(np.float32)
        adjust += (BUCKET_RATE * np.bincount(bucket, weights=error, minlength=len(adjust))).astype(np.float32)
        return np.bincount(np.repeat(np.arange(len(leaf)), length), weights=np.log(1 + e), minlength=len(leaf))

    def spelling_costs(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word, spelled."""
        if not words:
            return np.zeros(0)
        start, cell = spelled(words)
        return np.add.reduceat(self.spelling[cell].astype(np.float64), start)


def _fit(train: DataFrame, vocabulary: Vocabulary, partitions: int) -> Model:
    """Counters of every training text: non-zero ones per task, added up and finished by block on a task each."""
    spark, cells = train.sparkSession, cell_bits(vocabulary.tokens)
    sent = spark.sparkContext.broadcast(vocabulary)
    edge = (2 << cells) // BLOCK             # blocks of cells; spelling follows

    def count(batches):
        words, counters, code = Words(sent.value, cells, spell=True), Counters(cells), Code(sent.value.mass)
        for whole in batches:
            for batch in slices(whole, SLICE):
                counters.learn(Run(texts_of(batch), words), code, words)
        for b in range(-(-len(counters.all) // BLOCK)):
            part = counters.all[b * BLOCK:(b + 1) * BLOCK]
            at = np.flatnonzero(part)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                                                  pa.array([part[at].tobytes()], pa.binary())], names=["b", "at", "n"])

    def add(batches):
        key, total = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([finished(total, key >= edge)], pa.binary())], names=["b", "cells"])

        for batch in batches:
            for b, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                if b != key:
                    if key is not None:
                        yield done()
                    key, total = b, np.zeros(BLOCK, np.int64)
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int32)
        if key is not None:
            yield done()

    tasks = max(2 * spark.sparkContext.defaultParallelism, vocabulary.tokens // TASK_TOKENS)
    blocks = train.select("text").coalesce(tasks).mapInArrow(count, "b int, at binary, n binary") \
        .repartition(partitions, "b").sortWithinPartitions("b").mapInArrow(add, "b int, cells binary").collect()   # 2^MOST_CELLS bytes at most
    parts = {r["b"]: r["cells"] for r in blocks}
    none = [finished(np.zeros(BLOCK, np.int64), spelling) for spelling in (False, True)]
    table, spelling = (b"".join(parts.get(b, none[b >= edge]) for b in some)
                       for some in (range(edge), range(edge, edge + SPELLINGS * 256 // BLOCK)))
    return Model(vocabulary, cells, np.frombuffer(table, np.uint8), spelling_table(np.frombuffer(spelling, np.int64)))


def _token_counts(train: DataFrame) -> DataFrame:
    """h (token hash), n over all training tokens, ends among them."""
    end = hash_of(END)

    def count(batches):
        words, c, ends = WordHashes(), Counter(), 0

        def rows():
            h = np.fromiter(map(words.__getitem__, c), np.uint64, len(c)).view(np.int64)
            out = pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.fromiter(c.values(), np.int64, len(c)))], names=["h", "n"])
            c.clear()
            words.clear()
            return out

        for batch in batches:
            for t in texts_of(batch):
                c.update(words_of(t))
                ends += 1
                if len(c) > 400_000:
                    yield rows()
        yield rows()
        yield pa.RecordBatch.from_arrays([pa.array([end], pa.int64()), pa.array([ends], pa.int64())], names=["h", "n"])

    return train.select("text").mapInArrow(count, "h long, n long").where("n > 0").groupBy("h").agg(F.sum("n").alias("n"))


def score(docs: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte for every row of docs.

    n_bytes counts the bytes scored (the tokens, a blank between two, the line end); bits_per_byte is what the model
    spends on each of them. docs has doc_id and text.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    train = docs.where(~held_out)
    counts = cut_lineage(_token_counts(train))
    tokens, distinct, once = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("n") == 1)).first()
    common = counts.where(F.col("n") >= max(1.0, tokens / COMMON)).toArrow()      # at most COMMON rows
    vocabulary = Vocabulary(*(common[c].to_numpy() for c in ("h", "n")), tokens, once)
    model = _fit(train, vocabulary, partitions)
    sent = spark.sparkContext.broadcast((vocabulary, model.cells, model.table, model.spelling))

    def run(batches):
        model = Model(*sent.value)
        vocabulary = model.vocabulary
        words = Words(vocabulary, model.cells)
        worth = np.log10(np.append(vocabulary.times, 0) + 1.0)
        share = np.log10(np.append(vocabulary.times, 1) / (vocabulary.rare + vocabulary.new))     # of the rare leaf
        share[:-1][vocabulary.leaf[:-1] != vocabulary.rare_leaf] = 0.0
        share[-1] = 0.0
        for whole in batches:
            for batch in slices(whole, SLICE):
                texts = texts_of(batch)
                made, n = Run(texts, words), len(texts)
                at = words.at[made.word]
                hit = at < len(vocabulary.known)
                total = lambda x: np.bincount(made.doc, weights=x, minlength=n)
                mixed_part = total(share[at] - model.leaf_costs(made) / log(10))
                n_bytes = np.maximum(1, total(words.length[made.word] + 1).astype(np.int64) - 2)
                base = total(np.where(hit, worth[at], 0.0))
                # words without a count here: one row for each of a text's
                pair, often = np.unique(made.doc[~hit] << 32 | made.word[~hit], return_counts=True)
                of, (word, spelling_of) = pair >> 32, np.unique(pair & 0xFFFFFFFF, return_inverse=True)
                spelling = model.spelling_costs([words.list[i] for i in word])[spelling_of]
                k, rid = len(pair), batch.column(0).to_numpy()
                pad = lambda x, t: pa.concat_arrays([pa.array(x, t), pa.nulls(k, t)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([rid, rid[of]])), pa.array(np.concatenate([rid, words.h[word][spelling_of]])),
                    pa.array(np.concatenate([np.zeros(n, np.int64), often])),
                    pa.concat_arrays([pa.nulls(n, pa.float32()), pa.array(spelling, pa.float32())]),
                    pa.concat_arrays([batch.column(1), pa.nulls(k, batch.column(1).type)]),
                    pa.concat_arrays([batch.column(2), pa.nulls(k, batch.column(2).type)]),
                    pad(made.size, pa.int64()), pad(total(hit).astype(np.int64), pa.int64()), pad(base, pa.float64()),
                    pad(mixed_part, pa.float64()), pad(n_bytes, pa.int64())],
                    names=["rid", "h", "k", "spelling", "doc_id", "held", "n_tokens", "n_known", "base", "score", "n_bytes"])

    scored = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                         held_out.cast("int").alias("held"), "text") \
        .mapInArrow(run, "rid long, h long, k long, spelling float, doc_id long, held int, n_tokens long, n_known long, base double, score double, n_bytes long")
    # rare and unseen tokens find their counts by a join; a text's own row (k = 0) passes through it unchanged
    found = scored.join(counts, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rare, new = F.lit(float(vocabulary.rare + vocabulary.new)), F.lit(float(vocabulary.new))
    told = F.when(F.col("n") > 0, F.log10(F.col("n") / rare)).otherwise(F.log10(new / rare) + F.col("spelling"))
    per_doc = found.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), (F.max("held") == 1).alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0))).alias("n_known"),
        (F.sum("base") + F.sum(F.col("k") * F.log10(F.col("n") + F.lit(1.0)))).alias("base"),
        (F.sum("score") + F.sum(F.when(F.col("k") > 0, F.col("k") * told).otherwise(0.0))).alias("score"),
        F.sum("n_bytes").alias("n_bytes"))
    return per_doc.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                          (F.col("base") - F.col("n_tokens") * F.log10(F.lit(float(tokens + distinct + 1)))).alias("base_score"), "score",
                          "n_bytes", (-F.col("score") * F.lit(log(10) / log(2)) / F.col("n_bytes")).alias("bits_per_byte"))


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of all documents, learned from those whose crc32(doc_id) mod 7 is not 2."""
    return score(docs, train_row(F.col("doc_id"), 7, 2))

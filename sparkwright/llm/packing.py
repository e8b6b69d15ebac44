"""Packing documents into fixed windows with a controlled mixture: deficit round-robin over source queues.

A document's tokens are the ids of a public tokenizer and one end id. Every source is a queue of its documents'
tokens. In round r every source is credited ``window * share`` tokens; it emits what its credit holds in whole
quanta (its last tokens in any case), and carries the rest, its deficit, to the next round. The rounds' output, one
source after the other, is one stream that is cut every ``window`` tokens, so every window is full and holds the
target shares within a quantum per source; a source that runs out leaves the rotation and the others go on by their
weights. By default the targets are the sources' shares of all tokens, so that all queues last to the end; other
weights may be given.

The credit after r rounds is a function of r alone, so the round-robin's state (deficits, position in the stream)
at any token is computed where the token lies. The only things gathered are the token totals: one pass tokenises
and stores the documents together with the tokens of the same source before them in their task; the totals
per (task, source) give every task the place of its tokens in the queues; a second pass cuts pieces. No
document is shuffled while that table of totals is small enough to be broadcast (BROADCAST_BLOCKS rows); beyond it,
the stored rows are joined to it. A hot source is many (task, source) blocks.

Defined cases: null or empty text has the end id alone; a null source is a queue of its own; repeated rows and
repeated or null ids are documents of their own; a document longer than a window is cut into several; special tokens'
strings in a text are ordinary text; an empty table gives no rows; other columns are not read. Up to MAX_QUEUES sources have
a queue each, the largest ones; the documents of all others share one more queue. The stream's last tokens, fewer than a
window, are cut at powers of two, lengths that need no padding. Which document comes first in a queue follows the order
of the stored rows, so another run may cut elsewhere; within one run all decisions read the stored rows.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sparkwright.llm.textutil import slices
from sparkwright.session import stored

WINDOW, QUANTUM, END_ID = 2048, 32, 1
MAX_QUEUES, BROADCAST_BLOCKS = 1024, 500_000
LONG_RUN = 2000
_LONG_BLANK = re.compile(r"\s{%d}" % LONG_RUN)


class Tokenizer:
    """Ids of the public byte-level vocabulary as uint32 arrays.

    The library that reads the rank file is several times faster and gives the same ids; texts with a very long run
    without a break between words go to the library whose merges take linear memory there."""

    def __init__(self, rank_file: str, json_file: str, pattern: str):
        import tiktoken
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.json_file, self.slow = json_file, None

    @classmethod
    def public(cls, name: str = "byte_bpe_50k"):
        import public_tokenizers
        return cls(public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.path(f"{name}.json"), public_tokenizers.PATTERN)

    def ids(self, text: str) -> np.ndarray:
        if max(map(len, text.split()), default=0) < LONG_RUN and _LONG_BLANK.search(text) is None:
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        if self.slow is None:
            from tokenizers import Tokenizer as Reference
            self.slow = Reference.from_file(self.json_file)
            self.slow.encode_special_tokens = True
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


# ---------------------------------------------------------------- deficit round-robin, in closed form
class RoundRobin:
    """Tokens emitted by every queue after any number of rounds, and their places in the stream.

    totals: tokens per queue; weights: whole numbers per queue (scaled to a sum of about 2^24 if it is larger, at least 1
    each). After r rounds a queue was credited floor(r * window * weight / sum of weights) and has emitted the whole quanta
    of that, or all it has once its credit covers it."""

    SCALE = 1 << 24

    def __init__(self, totals: list[int], weights: list[int] | None = None, window: int = WINDOW, quantum: int = QUANTUM):
        weights = [int(w) for w in (totals if weights is None else weights)]
        total = sum(weights)
        if total > self.SCALE:
            weights = [max(1, w * self.SCALE // total) for w in weights]
        self.totals, self.weights = np.array(totals, np.int64), np.array(weights, np.int64)
        self.all, self.window, self.quantum = max(1, sum(weights)), window, quantum
        self.length = int(self.totals.sum())
        self._total, self._weight = self.totals.tolist(), self.weights.tolist()
        self._rounds: dict[int, tuple] = {}    # rounds asked for: (emitted before, after, places of their runs)

    def emitted(self, rounds: int) -> np.ndarray:
        """Tokens of every queue in the first ``rounds`` rounds."""
        turns, left = divmod(rounds, self.all)     # products stay under 64 bits: at most the stream's length, and left < sum
        credit = turns * self.window * self.weights + left * self.window * self.weights // self.all
        return np.where(credit >= self.totals, self.totals, credit - credit % self.quantum)

    def deficits(self, rounds: int) -> np.ndarray:
        """Credit carried over, in tokens."""
        return rounds * self.window * self.weights / self.all - self.emitted(rounds)

    def round_of(self, queue: int, token: int) -> int:
        """The round (from 1) that emits a queue's token (from 0)."""
        need = min(self._total[queue], (token // self.quantum + 1) * self.quantum)
        return -(-need * self.all // (self.window * self._weight[queue]))

    def _round(self, number: int) -> tuple:
        held = self._rounds.get(number)
        if held is None:
            if len(self._rounds) * len(self._total) > 1 << 21:
                self._rounds.clear()
            before, after = self.emitted(number - 1), self.emitted(number)
            sent = after - before
            held = self._rounds[number] = (before, after, int(before.sum()) + np.cumsum(sent) - sent)
        return held

    def runs(self, queue: int, start: int, stop: int):
        """(first token, end, place in the stream) of the runs that hold the queue's tokens start..stop-1."""
        while start < stop:
            before, after, places = self._round(self.round_of(queue, start))
            end = min(stop, int(after[queue]))
            yield start, end, int(places[queue] - before[queue]) + start
            start = end


def sequence_at(place: int, total: int, window: int) -> tuple[int, int, int]:
    """(sequence, offset in it, its length) of a place in a stream of ``total`` tokens; the tail goes by powers of two."""
    full = total // window
    sequence, offset = divmod(place, window)
    if sequence < full:
        return sequence, offset, window
    tail, start = total - full * window, 0
    while True:
        length = 1 << (tail - start).bit_length() - 1
        if offset < start + length:
            return sequence, offset - start, length
        start += length
        sequence += 1


def pieces_of(robin: RoundRobin, queue: int, start: int, length: int, window: int):
    """(start in the document, length, sequence, offset) of a document that begins at ``start`` of its queue."""
    for first, end, place in robin.runs(queue, start, start + length):
        while first < end:
            sequence, offset, size = sequence_at(place, robin.length, window)
            taken = min(end - first, size - offset)
            yield first - start, taken, sequence, offset
            first, place = first + taken, place + taken


# ---------------------------------------------------------------- Spark side
def tokenized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
              tokenizer=Tokenizer.public, end_id: int = END_ID) -> DataFrame:
    """Stored rows: id_col, source, part (the task), before (its earlier tokens of the source), n_tokens, ids.

    ids are little-endian unsigned 16-bit numbers if the batch's ids fit, else 32-bit; n_tokens tells which."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        from pyspark import TaskContext
        part, t, used = TaskContext.get().partitionId(), tokenizer(), {}
        for whole in batches:
            for batch in slices(whole):
                before, counts, ids = [], [], []
                for source, text in zip(batch.column("source").to_pylist(), batch.column("text").to_pylist()):
                    found = np.append(t.ids(text), np.uint32(end_id)) if text else np.array([end_id], np.uint32)
                    before.append(used.get(source, 0))
                    used[source] = before[-1] + len(found)
                    counts.append(len(found))
                    ids.append(found.astype("<u2" if found.max() < 1 << 16 else "<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("source"), pa.array([part] * len(ids), pa.int32()), pa.array(before, pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                    names=["id", "source", "part", "before", "n_tokens", "ids"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, source string, part int, before long, n_tokens long, ids binary"
    return stored(rows.mapInArrow(run, schema), "tokenized")


def _queues(blocks: DataFrame, weights: dict | None) -> tuple[dict, list[int], list[int] | None]:
    """(source -> queue, tokens per queue, weights per queue); the last queue takes the sources beyond MAX_QUEUES."""
    totals = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    top = totals.orderBy(F.col("tokens").desc(), "source").limit(MAX_QUEUES).collect()
    tokens = [int(r["tokens"]) for r in top]
    rest = int(blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]) - sum(tokens)
    if weights is None:
        shares = None
    else:                                      # whole numbers; a source without a weight comes last, one quantum at a time
        shares = [max(1, round(1e9 * float(weights.get(r["source"], 0)) / max(1e-300, sum(map(float, weights.values()))))) for r in top]
    if rest:
        tokens.append(rest)
        shares = None if shares is None else [*shares, 1]
    return {r["source"]: q for q, r in enumerate(top)}, tokens, shares


def pack(docs: DataFrame, weights: dict | None = None, window: int = WINDOW, quantum: int = QUANTUM, id_col: str = "doc_id",
         source_col: str = "source", text_col: str = "text", tokenizer=Tokenizer.public, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id_col, source, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit)."""
    rows = tokenized(docs, id_col, source_col, text_col, tokenizer, end_id)
    blocks = stored(rows.groupBy("part", "source").agg(F.max(F.col("before") + F.col("n_tokens")).alias("tokens")), "blocks")
    queues, totals, shares = _queues(blocks, weights)
    last = len(totals) - 1
    robin = RoundRobin(totals, shares, window, quantum)

    # where a (task, source) block begins in its queue: inside the task first, then over the tasks
    names = blocks.sparkSession.createDataFrame([(s, q) for s, q in queues.items()], "name string, queue int")
    queued = blocks.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name")), "left") \
        .select("part", "source", "tokens", F.coalesce("queue", F.lit(last)).alias("queue"))
    upto = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    inside = queued.withColumn("inside", F.coalesce(F.sum("tokens").over(upto("queue", "part").orderBy("source")), F.lit(0)))
    tasks = queued.groupBy("queue", "part").agg(F.sum("tokens").alias("tokens")) \
        .withColumn("outside", F.coalesce(F.sum("tokens").over(upto("queue").orderBy("part")), F.lit(0))).drop("tokens")
    begins = stored(inside.join(tasks, ["queue", "part"]).select(
        F.col("part").alias("b_part"), F.col("source").alias("b_source"), "queue", (F.col("inside") + F.col("outside")).alias("begin")), "begins")
    if begins.count() <= BROADCAST_BLOCKS:
        begins = F.broadcast(begins)
    placed = rows.join(begins, (F.col("part") == F.col("b_part")) & F.col("source").eqNullSafe(F.col("b_source"))) \
        .select("id", "source", "n_tokens", "ids", "queue", (F.col("begin") + F.col("before")).alias("at"))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, name="ids"):
                kept, starts, lengths, sequences, offsets, parts = [], [], [], [], [], []
                columns = (batch.column(c).to_pylist() for c in ("n_tokens", "ids", "queue", "at"))
                for row, (n, raw, queue, at) in enumerate(zip(*columns)):
                    ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4").tobytes()
                    for start, length, sequence, offset in pieces_of(robin, queue, at, n, window):
                        kept.append(row)
                        starts.append(start)
                        lengths.append(length)
                        sequences.append(sequence)
                        offsets.append(offset)
                        parts.append(ids[4 * start:4 * (start + length)])
                kept = pa.array(kept, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(kept), batch.column("source").take(kept), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                     batch.column("n_tokens").take(kept), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64()), pa.array(parts, pa.binary())],
                    names=["id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    schema = (f"id {rows.schema['id'].dataType.simpleString()}, source string, start long, length long, doc_tokens long, "
              "sequence_id long, offset long, ids binary")
    return placed.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the pieces of a sequence put together (at most a window's tokens per group)."""
    put = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.transform(put, lambda p: F.hex(p["ids"])).alias("hex"))
    return whole.select("sequence_id", "length", F.unhex(F.concat_ws("", "hex")).alias("ids"))


def digests(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")

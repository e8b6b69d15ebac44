"""Mixing sources to target weights: fixed-length word blocks drawn through index permutations.

Each source's documents are laid end to end and cut into blocks of ``block_words`` words. A source with
target t gets as many slots as blocks of mean length fill t. All slots are dealt to output shards by a pseudorandom
permutation of the slot numbers, so a shard's source counts are multinomial draws conditioned on the
source totals (the totals meet the targets to within a block). Slot i of a source maps to block
perm(i mod blocks) of pass i div blocks; a per-source swap-or-not permutation makes each block come once
per pass, so no block is taken more than ceil(target / size) times. Blocks are joined to the documents by
(source, block), each with the output shards its slots were dealt to. Texts are read once for their sizes, which are
stored. Everything is DataFrame functions.

Defined cases: null text has no words and takes nothing; null source is a source of its own, last; repeated
rows are laid down one after the other; sources without words get target 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkwright.llm.textutil import whole_row
from sparkwright.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUCKETS = 256          # stretches a source's documents are split into for prefix sums
CHUNK = 4096           # slots generated per row
ROUNDS = 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permute(i: Column, n: Column, *key: Column) -> Column:
    """Swap-or-not shuffle of 0..n-1: every round pairs i with k - i and swaps on a hashed bit."""
    def step(x, r):
        k = F.pmod(F.xxhash64(F.lit("k"), r, *key), n)
        y = F.pmod(k - x, n)
        bit = F.pmod(F.xxhash64(F.lit("b"), r, F.greatest(x, y), *key), F.lit(2))
        return F.when(bit == 1, y).otherwise(x)
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), i, step)


def water_fill(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Targets summing to share x total by weight, none above most x its size (excess reshared)."""
    left, target = share * sum(sizes), [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not over:
            for i in open_:
                target[i] = unit * weights[i]
            break
        for i in over:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ = [i for i in open_ if i not in set(over)]
    return target


def source_targets(sized: DataFrame, share: float = 1.5, most: float = 2.0,
                   weights: tuple = WEIGHTS) -> list[tuple[str | None, int, float]]:
    """(source, words, target), one entry per source, by code point, null last."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [int(r["n"] or 0) for r in rows]
    w = [float(weights[i % len(weights)]) for i in range(len(rows))]
    return [(r["source"], n, t) for r, n, t in zip(rows, sizes, water_fill(sizes, w, share, most))]


def slots_of(size: int, target: float, block_words: int) -> int:
    """Slots whose expected words are the target: a block's mean length is size / blocks (the last one is short)."""
    return max(1, round(target * -(-size // block_words) / size)) if target > 0 else 0


def source_table(spark, targets, block_words: int) -> DataFrame:
    """One row per source: sid, source, source_size, target, blocks, slots, first (global slot number)."""
    rows, first = [], 0
    for sid, (source, size, target) in enumerate(targets):
        blocks = -(-size // block_words)
        slots = slots_of(size, target, block_words)
        rows.append(F.struct(F.lit(sid).cast("long").alias("sid"), F.lit(source).cast("string").alias("source"),
                             F.lit(size).cast("long").alias("source_size"), F.lit(target).alias("target"),
                             F.lit(blocks).cast("long").alias("blocks"), F.lit(slots).cast("long").alias("slots"),
                             F.lit(first).cast("long").alias("first")))
        first += slots
    return spark.range(1).select(F.inline(F.array(*rows)))


def draw_slots(sources: DataFrame, slots_total: int, n_shards: int, seed: int = 0) -> DataFrame:
    """All slots: sid, slot, block, position (in the dealt order), out_shard."""
    per_shard = max(1, -(-slots_total // n_shards))
    chunk = sources.where("slots > 0").withColumn(
        "c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK))))
    slot = chunk.repartition("sid", "c").withColumn("slot", F.explode(F.sequence(
        F.col("c") * CHUNK, F.least((F.col("c") + 1) * CHUNK, F.col("slots")) - 1)))
    turn = F.floor(F.col("slot") / F.col("blocks"))
    block = permute(F.pmod(F.col("slot"), F.col("blocks")), F.col("blocks"), F.col("sid"), turn, F.lit(seed))
    position = permute(F.col("first") + F.col("slot"), F.lit(slots_total).cast("long"), F.lit(seed))
    return slot.select("sid", "slot", block.alias("block"), position.alias("position")) \
               .withColumn("out_shard", F.floor(F.col("position") / per_shard).cast("int"))


def lay_out(sized: DataFrame, key: list[str]) -> DataFrame:
    """Each document's first word position in its source: bucketed prefix sums, no window over a whole source.

    sized has sid, size and the key columns; identical keys are laid down together and numbered by ``copy``.
    """
    grouped = sized.groupBy("sid", "size", *key).agg(F.count(F.lit(1)).alias("m")) \
        .withColumn("_b", F.pmod(F.xxhash64(*key, F.col("size")), F.lit(BUCKETS)))
    words = F.col("size") * F.col("m")
    buckets = grouped.groupBy("sid", "_b").agg(F.sum(words).alias("n"))
    before = Window.partitionBy("sid").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select("sid", "_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("sid", "_b").orderBy(*key, "size").rowsBetween(Window.unboundedPreceding, -1)
    at = grouped.withColumn("_in", F.coalesce(F.sum(words).over(inside), F.lit(0))).join(starts, ["sid", "_b"])
    return at.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1))) \
             .withColumn("offset", F.col("_start") + F.col("_in") + F.col("copy") * F.col("size")) \
             .drop("_b", "_start", "_in", "m")


def pieces(laid: DataFrame, block_words: int, cols: list[str]) -> DataFrame:
    """One row per (document, block) overlap: the block, first word inside the document, words."""
    L = F.lit(block_words)
    last = F.floor((F.col("offset") + F.col("size") - 1) / L)
    p = laid.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("offset") / L), last)))
    lo = F.greatest(F.col("block") * L, F.col("offset"))
    hi = F.least((F.col("block") + 1) * L, F.col("offset") + F.col("size"))
    return p.select(*cols, "sid", "block", (lo - F.col("offset")).alias("from_word"), (hi - lo).alias("n"))


def mix(docs: DataFrame, block_words: int = 256, n_shards: int = 64, share: float = 1.5,
        most: float = 2.0, seed: int = 0, weights: tuple = WEIGHTS):
    """Plan the mix of docs (doc_id, source, text). Returns (documents, pieces_with_uses, slots).

    documents: doc_id, h (text hash), copy, sid, size, offset; pieces_with_uses adds the times a block is
    drawn and the output shard of each time; slots lists every drawn block with its output shard. All are lazy.
    """
    spark = docs.sparkSession
    sized = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"),
                               F.xxhash64("text").alias("h")), "mixing_sizes")
    targets = source_targets(sized, share, most, weights)
    if not targets:
        targets = [(None, 0, 0.0)]
    sources = source_table(spark, targets, block_words)
    total = sum(slots_of(n, t, block_words) for _, n, t in targets)
    with_sid = sized.join(F.broadcast(sources.select("sid", F.col("source").alias("_s"))),
                          F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "source")
    laid = lay_out(with_sid, ["doc_id", "h"])
    slots = draw_slots(sources, max(1, total), n_shards, seed)
    uses = slots.groupBy("sid", "block").agg(
        F.count(F.lit(1)).alias("uses"), F.array_sort(F.collect_list("out_shard")).alias("out_shards"))   # as many as passes
    parts = pieces(laid, block_words, ["doc_id", "h", "copy", "size"]).join(
        uses.hint("merge"), ["sid", "block"])       # the blocks grow with the data, which the planner cannot see: no broadcast
    return laid, parts, slots, sources


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, by_shard: one row per document row.

    by_shard lists the words that each output shard takes of it as shard:words, by shard; they add up to taken.
    """
    laid, parts, _, sources = mix(docs, **options)
    keys = ["doc_id", "h", "copy", "size", "sid"]
    dealt = parts.select(*keys, F.explode("out_shards").alias("shard"), "n").groupBy(*keys, "shard").agg(F.sum("n").alias("n"))
    # a document that nothing is taken of has one row without a shard
    rows = laid.select(*keys, F.lit(None).cast("int").alias("shard"), F.lit(0).cast("long").alias("n")).unionByName(dealt) \
        .groupBy(*keys).agg(F.sum("n").alias("taken"), F.array_sort(F.collect_list(
            F.when(F.col("shard").isNotNull(), F.struct("shard", "n")))).alias("shards"))
    return rows.join(F.broadcast(sources.select("sid", "source_size", "target")), "sid") \
        .select("doc_id", "size", "source_size", "target", "taken",
                F.array_join(F.transform("shards", lambda x: F.concat_ws(":", x["shard"], x["n"])), ",").alias("by_shard"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: copy p of a document holds its words whose block is drawn at least p times.

    Columns as in docs. A copy whose blocks were all drawn keeps its text unchanged; a partial one joins its
    words by blanks, and ``n_chars`` (if present) follows the text.
    """
    _, parts, _, _ = mix(docs, **options)
    spans = parts.groupBy("doc_id", "h", "copy", "size").agg(
        F.array_sort(F.collect_list(F.struct("from_word", "n", "uses"))).alias("p"))
    spans = spans.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.array_max("p.uses")))) \
        .withColumn("q", F.filter("p", lambda x: x["uses"] >= F.col("pass"))) \
        .withColumn("n", F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x["n"])) \
        .select(F.xxhash64("doc_id", "h").alias("k"), "copy", "size", "q", "n")
    # rows that are equal in doc_id and text are numbered; the window and the join share one shuffle by k
    # by their other columns, so that reruns agree
    same = Window.partitionBy("k").orderBy("_h")
    keyed = docs.select(whole_row(docs), F.xxhash64("doc_id", F.xxhash64("text")).alias("k"),
                        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("_h")) \
        .withColumn("own", F.row_number().over(same) - 1)
    got = keyed.join(spans, "k").where(F.col("own") - F.col("copy") == 0)
    words = F.regexp_extract_all("_row.text", F.lit(WORD), F.lit(0))
    cut = F.array_join(F.flatten(F.transform("q", lambda x: F.slice(
        words, (x["from_word"] + 1).cast("int"), x["n"].cast("int")))), " ")
    text = F.when(F.col("n") == F.col("size"), F.col("_row.text")).otherwise(cut)
    made = {"text": text}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return got.select(*[made.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])

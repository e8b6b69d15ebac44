"""Document fingerprints: 64-bit SimHash, and the search for fingerprints within a Hamming radius.

Every distinct word of a text votes with weight 1 + ln(occurrences) for or against each bit by the bits of its
64-bit hash; the fingerprint keeps the signs. ``within`` finds all pairs of distinct fingerprints that differ
in at most ``radius`` bits with permuted block tables: the 64 bits are cut in ``blocks`` blocks, and for every
choice of blocks - radius of them a table is keyed by those blocks; at most radius differing bits leave one
choice untouched, so nothing within the radius is missed.

Defined cases: null text is empty; an empty text has fingerprint 0; a bit with equal votes is 0; equal texts have
equal fingerprints; repeated doc_ids follow one another in some order; the only row of a table is its own next.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import combinations
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sparkwright.session import cut_lineage
from sparkwright.llm.textutil import slices, texts_of, words_of

_LOG = np.array([0.0] + [1.0 + log(n) for n in range(1, 4096)], np.float32)


def fingerprints(texts: list[bytes], terms_at_once: int = 1 << 15) -> np.ndarray:
    """uint64 fingerprints; votes are summed for about terms_at_once distinct words at a time."""
    out = np.zeros(len(texts), np.uint64)
    hashes, weights, starts, rows = [], [], [], []

    def flush():
        if starts:
            bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
            w = np.array(weights, np.float32)
            votes = np.add.reduceat((bits.astype(np.float32) - 0.5) * w[:, None], starts, axis=0)
            out[rows] = np.packbits(votes > 1e-4, axis=1).view(">u8").ravel()
        for part in (hashes, weights, starts, rows):
            part.clear()

    digest = xxhash.xxh3_64_intdigest
    for row, text in enumerate(texts):
        counts = Counter(words_of(text))
        if not counts:
            continue
        starts.append(len(hashes))
        rows.append(row)
        # one fixed order of the terms, so that equal word counts give equal sums
        own = sorted((digest(t), n) for t, n in counts.items())
        hashes.extend([h for h, _ in own])
        weights.extend([_LOG[n] if n < 4096 else 1.0 + log(n) for _, n in own])
        if len(hashes) >= terms_at_once:
            flush()
    flush()
    return out


def likeness(a: int, b: int) -> float:
    return 1.0 - (a ^ b).bit_count() / 64


def edited(text: str, following: str) -> str:
    """text with its last half replaced by as many code points of the start of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _rows(pairs):
    """Result rows of (doc_id, text bytes, fingerprint, next text bytes, next fingerprint)."""
    made = []
    for doc_id, text, _, following, _ in pairs:
        s = text.decode("utf-8", "replace")
        made.append((len(s), edited(s, following.decode("utf-8", "replace")).encode("utf-8", "replace")))
    prints = fingerprints([e for _, e in made])
    return [(p[0], n, hashlib.sha256(e).hexdigest(), f"{p[2]:016x}", f"{int(f):016x}", likeness(p[2], int(f)), likeness(p[2], p[4]))
            for p, (n, e), f in zip(pairs, made, prints)]


def _batch(rows, part, edges=()):
    cols = list(zip(*rows)) if rows else [[]] * len(_OUT)
    nulls = lambda n: [None] * n
    full = len(rows), len(edges)
    arrays = [pa.array([*c, *nulls(full[1])], t) for c, t in zip(cols, (
        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))]
    return pa.RecordBatch.from_arrays(arrays + [
        pa.array([part] * sum(full), pa.int32()), pa.array(nulls(full[0]) + [e[0] for e in edges], pa.string()),
        pa.array(nulls(full[0]) + [e[1] for e in edges], pa.int64()),
        pa.array(nulls(full[0]) + [e[2] for e in edges], pa.binary())],
        names=[*_OUT, "_part", "_edge", "_edge_id", "_edge_text"])


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, _part int, _edge string, _edge_id long, _edge_text binary")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text and of its edited text; the next document is by descending doc_id, cyclic.

    One range shuffle sorts the rows; each task walks its stretch with the row before in hand. The first and last
    row of a stretch come out with their texts, and are matched with the neighbouring stretches' by a small join.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc_nulls_last("doc_id"), F.col("_rid")]
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("_rid")) \
        .repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())

    def walk(batches):
        first = held = None
        for whole in batches:
            for batch in slices(whole):
                ids, texts = batch.column(0).to_pylist(), texts_of(batch)
                part = batch.column(batch.schema.get_field_index("_part"))[0].as_py()
                own = [*zip(ids, texts, map(int, fingerprints(texts)))]
                first = first or (part, own[0])
                run = [held, *own] if held else own
                held = run[-1]
                yield _batch(_rows([(*a, *b[1:]) for a, b in zip(run, run[1:])]), part)
        if first:
            part, row = first
            yield _batch([], part, [("first", row[0], row[1]), ("last", held[0], held[1])])

    walked = cut_lineage(ranged.mapInArrow(walk, _SCHEMA))
    edges = walked.where("_edge is not null").select("_part", "_edge", "_edge_id", "_edge_text")
    stretches = sorted(r["_part"] for r in edges.where("_edge = 'last'").select("_part").collect())
    inner = walked.where("_edge is null").select(*_OUT)
    if not stretches:
        return inner
    after = F.create_map(*[F.lit(x) for p, q in zip(stretches, stretches[1:] + stretches[:1]) for x in (p, q)])
    last = edges.where("_edge = 'last'").select(after[F.col("_part")].alias("_part"), F.col("_edge_id").alias("doc_id"), F.col("_edge_text").alias("text"))
    joined = last.join(edges.where("_edge = 'first'").select("_part", F.col("_edge_text").alias("following")), "_part") \
        .select("doc_id", "text", "following")

    def close(batches):
        for batch in batches:
            ids, texts, following = batch.column(0).to_pylist(), texts_of(batch), texts_of(batch, "following")
            prints, nexts = fingerprints(texts), fingerprints(following)
            yield _batch(_rows([(i, t, int(f), g, int(h)) for i, t, f, g, h in zip(ids, texts, prints, following, nexts)]), 0)

    return inner.unionByName(joined.mapInArrow(close, _SCHEMA).select(*_OUT))


def within(prints: DataFrame, radius: int = 3, blocks: int = 6, col: str = "fingerprint") -> DataFrame:
    """All pairs (a < b, distance) of distinct hexadecimal fingerprints at most radius bits apart."""
    bits = F.conv(F.col(col), 16, -10).cast("long")
    distinct = prints.where(F.col(col).isNotNull()).select(F.col(col).alias("a"), bits.alias("x")).distinct()
    edges = [64 * i // blocks for i in range(blocks + 1)]

    def table(choice) -> Column:
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in choice)
        return F.col("x").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))

    keyed = distinct.select("a", "x", F.posexplode(F.array(*[table(c) for c in combinations(range(blocks), blocks - radius)])).alias("t", "key"))
    other = keyed.select("t", "key", F.col("a").alias("b"), F.col("x").alias("y"))
    distance = F.bit_count(F.col("x").bitwiseXOR(F.col("y")))
    return keyed.join(other, ["t", "key"]).where((F.col("a") < F.col("b")) & (distance <= radius)) \
        .select("a", "b", distance.cast("int").alias("distance")).distinct()

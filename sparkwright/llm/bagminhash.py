"""Near-duplicate classes with BagMinHash signatures, banding and exact multiset verification.

A text's weighted set is its five-word shingles with their counts. Weights are discretised in unit levels, and the
levels form the dyadic blocks [0,1), [1,2), [2,4), [4,8), ... A (shingle, block) pair owns one Poisson process whose
rate is the block's length; its points come in ascending time from hashes, each with a random signature component
and a random level of the block, and a point counts only if its level is below the weight. Component i of the signature
is the earliest counting point: two texts agree there with probability equal to their weighted Jaccard similarity. Only
points up to a horizon are generated, m (ln m + 6) / total weight, which fills all m components nearly always; texts
with an empty component go on with a doubled horizon.

Signatures are cut in ``BANDS`` bands; each text is linked to the least text of its bucket, which costs one link per
text and band, never all pairs. The linked groups are then verified: within a group all pairs that are not connected
yet are compared exactly (multiset Jaccard >= 0.8) and the classes are the connected parts. Groups of more than
``CHUNK`` different texts are verified in chunks; every connected part sends up to ``REPS`` members to the next round,
until a group fits one chunk or rounds stop shrinking it. These rounds only save comparisons: after them, all members
of such a group that share a band bucket and are still in different parts are compared, large buckets in block pairs.

Defined cases: null text is empty, and all texts without words are equal; fewer than five words are one shingle; equal texts
(whatever their doc_id) are one class; class_id is the least doc_id of the class, null if all are null; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkwright.session import cut_lineage
from sparkwright.llm.textutil import WordHashes, mixed, shingles, slices, texts_of, whole_row

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 25, 5            # a pair at similarity 0.8 shares a band with probability 0.99995
CHUNK, REPS = 512, 32
BROADCAST_ROWS = 1 << 21
_U = np.uint64


def weighted_sets(texts: list[bytes], words: WordHashes):
    """(text number, shingle, count) arrays of all texts, sorted by text and shingle."""
    sets = [np.unique(shingles(words.of(t), SHINGLE), return_counts=True) for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(h) for h, _ in sets])
    return doc, np.concatenate([h for h, _ in sets]), np.concatenate([n for _, n in sets])


def signatures(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, n_docs: int, m: int = BANDS * ROWS) -> np.ndarray:
    """uint64 signature matrix (n_docs x m): the bits of each component's earliest time; rows without shingles stay inf."""
    first = np.full((n_docs, m), np.inf)
    total = np.bincount(doc, weights=count, minlength=n_docs)
    horizon = np.divide(m * (np.log(m) + 6), total, out=np.zeros(n_docs), where=total > 0)
    todo = total > 0
    while todo.any():
        pick = todo[doc]
        _points(first, doc[pick], shingle[pick], count[pick], horizon, m)
        todo &= np.isinf(first).any(axis=1)
        horizon *= 2
    return first.view(np.uint64)


def _points(first, doc, shingle, count, horizon, m):
    flat = first.reshape(-1)
    for block in range(int(count.max()).bit_length() + 1):
        low, length = (0, 1) if block == 0 else (1 << (block - 1), 1 << (block - 1))
        inside = count > low
        if not inside.any():
            break
        d, w = doc[inside], count[inside]
        state = mixed(shingle[inside] + _U(block * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
        end, time, i = horizon[d], np.zeros(len(d)), 0
        while len(d):
            i += 1
            h = mixed(state + _U(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            time = time - np.log(((h >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / length
            go = time <= end
            d, w, state, end, time = d[go], w[go], state[go], end[go], time[go]
            h = mixed(h[go])
            part = ((h >> _U(32)) * _U(m)) >> _U(32)
            at = d * m + part.astype(np.int64)
            if length > 1:
                counts = low + (h & _U(length - 1)).astype(np.int64) < w
                np.minimum.at(flat, at[counts], time[counts])
            else:
                np.minimum.at(flat, at, time)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """int64 bucket keys (rows x BANDS), different bands hashed apart."""
    s = signature.reshape(len(signature), BANDS, ROWS)
    h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), s.shape[:2])
    for r in range(ROWS):
        h = mixed(h * _U(0x9E3779B97F4A7C15) + s[:, :, r])
    return h.view(np.int64)


def _key():
    """Hash of the text; a text without words counts as the empty text."""
    return F.xxhash64(F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.col("text")).otherwise(""))


def _sign(docs: DataFrame) -> DataFrame:
    """doc_id, k (hash of the text), bands (null for a text without words)."""
    def run(batches):
        words = WordHashes()
        for whole in batches:
            for batch in slices(whole):
                texts = texts_of(batch)
                doc, shingle, count = weighted_sets(texts, words)
                keys = band_keys(signatures(doc, shingle, count, len(texts)))
                has = np.bincount(doc, minlength=len(texts)) > 0
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(has, BANDS, 0))]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(
                    offsets, pa.array(keys[has].ravel()))], names=["doc_id", "k", "bands"])

    return docs.select("doc_id", _key().alias("k"), "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, k long, bands array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of an edge table (a, b): the least node of each connected part, by neighbour minima and pointer jumps."""
    both = cut_lineage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("l"))
                         .select("node", F.least("node", "l").alias("label")))
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("l"))
        near = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        moved = cut_lineage(near.join(up, "label").select("node", "old", F.least("label", "up").alias("label")))
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels


class _Bag:
    def __init__(self, text: bytes, words: WordHashes):
        self.h, self.n = np.unique(shingles(words.of(text), SHINGLE), return_counts=True)
        self.total = int(self.n.sum())

    def similar(self, other) -> bool:
        a, b = self.total, other.total
        if min(a, b) < THRESHOLD * max(a, b):
            return False
        at = np.minimum(np.searchsorted(other.h, self.h), len(other.h) - 1) if len(other.h) else None
        if at is None or not len(self.h):
            return a == b
        same = other.h[at] == self.h
        shared = int(np.minimum(self.n[same], other.n[at[same]]).sum())
        return shared >= THRESHOLD * (a + b - shared) - 1e-9


def closure(parts: list, bags: list) -> list:
    """Merge the given parts (a label for each bag) along all exact links: new labels, the least of each connected part."""
    root = {p: p for p in parts}

    def find(p):
        while root[p] != p:
            root[p] = p = root[root[p]]
        return p

    members: dict = {}
    for p, bag in zip(parts, bags):
        for q in list(members):
            own = find(p)
            if q in members and find(q) != own and any(bag.similar(x) for x in members[q]):
                low, high = sorted((own, find(q)))
                root[high] = low
                joined = members.pop(q) + (members.pop(own) if own in members and own != q else [])
                members[low] = joined
        members.setdefault(find(p), []).append(bag)
    return [find(p) for p in parts]


_GROUPED = "part long, into long"


def _close(groups: DataFrame) -> DataFrame:
    """(part, into) for the parts of each group g, groups being runs of rows (g, part, text) of one partition."""
    def run(batches):
        words, g, parts, bags = WordHashes(), None, [], []

        def flush():
            merged = {p: q for p, q in zip(parts, closure(parts, bags))}
            return pa.RecordBatch.from_arrays([pa.array(merged.keys(), pa.int64()), pa.array(merged.values(), pa.int64())],
                                              names=["part", "into"])

        for batch in batches:
            for own, part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch)):
                if own != g and parts:
                    yield flush()
                    parts, bags = [], []
                g = own
                parts.append(part)
                bags.append(_Bag(text, words))
        if parts:
            yield flush()

    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return groups.select("g", "part", "text").repartition(n, "g").sortWithinPartitions("g", "part").mapInArrow(run, _GROUPED)


def _verified(members: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between parts of members (label, k, text) that are linked exactly; null if there are no members.

    labels: (node, label) of all members, nodes: (k, bands)."""
    state = members.select("label", "k", F.col("k").alias("part"))        # carried members and the part each is in
    merges = before = large = None
    while True:
        sizes = state.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        largest, carried = sizes.agg(F.max("n"), F.sum(F.when(F.col("n") > CHUNK, F.col("n")))).first()
        if largest is None:
            break
        if large is None and largest > CHUNK:
            large = cut_lineage(sizes.where(F.col("n") > CHUNK).select("label"))
        if before is not None and (carried or 0) > 0.75 * before:
            break
        sized = state.join(sizes, "label").withColumn("blocks", F.ceil(F.col("n") / CHUNK))
        placed = sized.withColumn("g", F.xxhash64("label", F.pmod(F.xxhash64("part", F.lit(before or 0)), "blocks")))
        # a part's carried members stay together, so a chunk is complete for the parts that it holds
        texts = placed.select("g", "part", "k").join(members.select("k", "text"), "k")
        into = cut_lineage(_close(texts).where("part <> into").select(F.col("part").alias("a"), F.col("into").alias("b")))
        merges = into if merges is None else merges.unionByName(into)
        if largest <= CHUNK:
            break
        before = carried
        # a part was in one chunk only, so its merge is one row
        moved = state.join(sizes.where(F.col("n") > CHUNK).select("label"), "label") \
            .join(into.select(F.col("a").alias("part"), "b"), "part", "left") \
            .select("label", "k", F.coalesce("b", "part").alias("part"))
        state = cut_lineage(_carry(moved))
    if large is None:
        return merges
    inside = labels.join(F.broadcast(large), "label").select(F.col("node").alias("k"))       # a label has over CHUNK texts
    return merges.unionByName(_across(members, nodes.join(inside, "k"), components(merges)))


def _across(members: DataFrame, nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """Edges (a, b) between the parts (node, label) of nodes (k, bands) that share a bucket, from all pairs of their members.

    A bucket's largest part is cut in ``tops`` blocks, its other members in ``rests``; every block of others meets every
    block of the largest part and every other block of others, so pairs inside the largest part cost nothing."""
    in_parts = nodes.join(parts.withColumnRenamed("node", "k"), "k", "left").withColumn("part", F.coalesce("label", "k"))
    bucket = cut_lineage(in_parts.select("k", "part", F.explode("bands").alias("h")))
    held = bucket.groupBy("h", "part").agg(F.count(F.lit(1)).alias("n"))
    half = lambda n: F.when(F.col("total") > CHUNK, F.ceil(2 * n / CHUNK)).otherwise(1)
    shared = held.groupBy("h").agg(F.sum("n").alias("total"), F.max(F.struct("n", "part")).alias("top")) \
        .where("total > top.n").select("h", F.col("top.part").alias("top"), half(F.col("top.n")).alias("tops"),
                                       half(F.col("total") - F.col("top.n")).alias("rests"))
    own = F.pmod(F.xxhash64("k"), F.when(F.col("part") == F.col("top"), F.col("tops")).otherwise(F.col("rests")))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    pair = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    mine = F.col("own")
    met = F.when(F.col("part") == F.col("top"), F.transform(upto(F.col("rests")), lambda j: pair("top", mine, j))).otherwise(
        F.concat(F.transform(upto(F.col("tops")), lambda i: pair("top", i, mine)),
                 F.transform(F.filter(upto(F.col("rests")), lambda j: j != mine),
                             lambda j: pair("rest", F.least(mine, j), F.greatest(mine, j)))))
    placed = bucket.join(shared, "h").withColumn("own", own).withColumn("at", F.explode(met)) \
        .select(F.xxhash64("h", "at.kind", "at.i", "at.j").alias("g"), "part", "k")
    texts = placed.join(members.select("k", "text"), "k")
    return cut_lineage(_close(texts).where("part <> into").select(F.col("part").alias("a"), F.col("into").alias("b")).distinct())


def _carry(state: DataFrame) -> DataFrame:
    """Up to REPS members of each part (the lowest by hash): a bounded minimum per part, combined before the shuffle."""
    slot = F.pmod(F.xxhash64("k", F.lit(1)), F.lit(REPS))
    return state.groupBy("label", "part", slot.alias("slot")).agg(F.min("k").alias("k")).select("label", "k", "part")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, k, root for every row of docs: rows with one root are one near-duplicate class."""
    signed = cut_lineage(_sign(docs))
    nodes = signed.where("bands is not null and size(bands) > 0").dropDuplicates(["k"])
    bucket = nodes.select("k", F.explode("bands").alias("h"))
    leaders = bucket.groupBy("h").agg(F.min("k").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    edges = bucket.join(leaders, "h").where("k <> b").select(F.col("k").alias("a"), "b").distinct()
    labels = components(edges)
    text = docs.select(_key().alias("k"), "text")
    linked = labels.select(F.col("node").alias("k"), "label")
    if labels.count() <= BROADCAST_ROWS:     # two longs a row; beyond that the texts are shuffled to the join
        linked = F.broadcast(linked)
    members = cut_lineage(text.join(linked, "k").dropDuplicates(["k"]))
    merges = _verified(members, labels, nodes)
    rows = signed.select("doc_id", "k")
    if merges is None:
        return rows.withColumn("root", F.col("k"))
    roots = components(merges).select(F.col("node").alias("k"), F.col("label").alias("root"))
    return rows.join(roots, "k", "left").select("doc_id", "k", F.coalesce("root", "k").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size for every row of docs."""
    found = cut_lineage(classes(docs))
    ids = found.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return found.join(ids, "root").select("doc_id", "class_id", "class_size")


def first_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class: the least doc_id's (null last); of rows equal in doc_id and text, any one."""
    found = cut_lineage(classes(docs))
    kept = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "k")).alias("r")) \
        .select(F.col("r.doc_id").alias("_id"), F.col("r.k").alias("_k"))
    repeats = found.groupBy("doc_id", "k").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("doc_id", "_id2").withColumnRenamed("k", "_k2")
    kept = kept.join(repeats, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_k") == F.col("_k2"))).select("_id", "_k", "_n")
    keyed = docs.select(whole_row(docs), F.col("doc_id").alias("_own"), _key().alias("_key"))
    chosen = keyed.join(kept, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")))
    once = chosen.where("_n = 1").select("_row.*")
    return once.unionByName(chosen.where("_n > 1").dropDuplicates(["_id", "_k"]).select("_row.*"))

"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Words are compared lower-cased and without surrounding punctuation. An item's shingles are its runs of five words
(a shorter item is one run). Every window of a document that has an item's number of words is a candidate, unless
it holds too few of the benchmark's shingles for any item to be similar enough (similarity s needs at least s x the
item's shingles, so that test loses nothing). Candidates get a 64-bit SimHash over their shingles. At this radius block
values alone select next to nothing, so the blocks are asked only for items that the window's shingles name: a window
of similarity s misses at most (1 - s) x an item's m shingles, so of any floor((1 - s) m) + 1 of them it holds one, and
an item is posted under that many of its rarest shingles. For every item so named, some block of ``BLOCKS`` differs in at most
RADIUS // BLOCKS bits if its fingerprint is within ``RADIUS`` bits; the whole distance is then taken. The multiset
Jaccard similarity of the shingles, weighted by their counts, decides exactly.

The benchmark is used in parts of at most ``part_bytes`` of text; a part's index (sorted arrays) is built once and broadcast,
and all documents are read against it. With several parts, rows are stored with a number and each part's matches are stored
before the next part is sent; the best window of a row and item_id over all parts is kept, so the result does not depend on
the number of parts. Defined cases: null text is empty; empty items and documents match nothing; items that share an
item_id are one item with several texts, the most similar counts; of equally similar windows the first is given, then the
shorter; repeated rows are matched each; an empty table on either side gives no matches.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkwright.llm.textutil import WordHashes, mixed, shingles, texts_of
from sparkwright.session import stored

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 23            # at similarity 0.8 a fingerprint bit differs with chance 0.15: 9.7 of 64, standard deviation 2.9
BLOCKS = 8
PART_BYTES = 32 << 20
PAIRS = 1 << 20        # postings of windows looked up together


def _signs(h: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(mixed(h).astype(">u8").view(np.uint8)).reshape(-1, 64)
    return bits.astype(np.int32) * 2 - 1


def _print(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=-1).view(">u8").astype(np.uint64).reshape(-1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Multiset Jaccard of two shingle arrays: shared occurrences over all occurrences."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = int(np.minimum(nx[i], ny[j]).sum())
    return shared / (len(a) + len(b) - shared)


class _Class:
    """Items of one number of words: fingerprints, and postings of their rarest shingles as sorted arrays."""

    def __init__(self, items, often: Counter, threshold: float):
        ids = defaultdict(list)
        for item_id, own in items:
            ids[own.tobytes()].append(item_id)
        self.items = [(i, np.frombuffer(own, np.uint64)) for own, i in ids.items()]      # equal texts are looked up once
        self.prints = np.concatenate([_print(_signs(own).sum(axis=0)) for _, own in self.items])
        named = []
        for i, (_, own) in enumerate(self.items):
            rare = sorted(own.tolist(), key=lambda h: (often[h], h))
            named += [(h, i) for h in set(rare[:len(own) - ceil(threshold * len(own) - 1e-9) + 1])]
        named.sort()
        self.posted, self.first = np.unique(np.array([h for h, _ in named], np.uint64), return_index=True)
        self.first = np.append(self.first, len(named))
        self.item = np.array([i for _, i in named], np.int64)
        self.probed = 0

    def hits(self, shingle: np.ndarray):
        """(place, item) for every posting of the given shingles, places in order."""
        at = np.minimum(np.searchsorted(self.posted, shingle), len(self.posted) - 1)
        place = np.flatnonzero(self.posted[at] == shingle)
        low, n = self.first[at[place]], self.first[at[place] + 1] - self.first[at[place]]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(place, n), self.item[np.repeat(low, n) + step]

    def near(self, place, item, starts: np.ndarray, size: int, votes: np.ndarray):
        """(start, item, distance) of the named items within the radius; votes are running sums over the shingles."""
        low, high = np.searchsorted(place, starts), np.searchsorted(place, starts + size)
        upto = np.cumsum(high - low)
        cuts = np.unique(np.searchsorted(upto, np.arange(0, upto[-1], PAIRS), "right"))
        for a, b in zip(cuts, np.append(cuts[1:], len(starts))):
            some, n = starts[a:b], (high - low)[a:b]
            at = np.repeat(low[a:b], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            window, named = np.divmod(np.unique(np.repeat(np.arange(len(some)), n) * len(self.items) + item[at]), len(self.items))
            self.probed += len(window)
            apart = _print(votes[some + size] - votes[some])[window] ^ self.prints[named]
            blocks = np.bitwise_count(apart.view(np.uint8).reshape(-1, BLOCKS))
            distance = blocks.sum(axis=1, dtype=np.int64)
            ok = (blocks <= RADIUS // BLOCKS).any(axis=1) & (distance <= RADIUS)
            yield from zip(some[window[ok]].tolist(), named[ok].tolist(), distance[ok].tolist())


class Index:
    """Benchmark items: shingle length -> (sorted shingles of all items, classes by number of words)."""

    def __init__(self, items: list[tuple], threshold: float = THRESHOLD):
        words = WordHashes(strip=True)
        self.threshold = threshold
        groups = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            w = words.of(text)
            if len(w):
                groups[min(SHINGLE, len(w))][len(w)].append((item_id, shingles(w, SHINGLE)))
        self.groups = []
        for k, sizes in groups.items():
            every = np.concatenate([s for c in sizes.values() for _, s in c])
            known, n = np.unique(every, return_counts=True)
            often = Counter(dict(zip(known.tolist(), n.tolist())))
            seen = np.zeros(1 << 20, bool)
            seen[known & np.uint64((1 << 20) - 1)] = True
            self.groups.append((k, known, seen, {n: _Class(c, often, threshold) for n, c in sorted(sizes.items())}))

    def matches(self, words: np.ndarray) -> list[tuple]:
        """(item_id, similarity, distance, start word, words) of the best window for each item a document holds."""
        best = {}
        for k, known, seen, classes in self.groups:
            if len(words) < k:
                continue
            doc = shingles(words, k)
            at = np.flatnonzero(seen[doc & np.uint64((1 << 20) - 1)])
            at = at[known[np.minimum(np.searchsorted(known, doc[at]), len(known) - 1)] == doc[at]]
            if not len(at):
                continue
            hit = np.zeros(len(doc) + 1, np.int32)
            hit[at + 1] = 1
            hit = hit.cumsum()
            lo, hi = max(0, at[0] - max(classes)), min(len(doc), at[-1] + max(classes))
            votes = None
            for n, items in classes.items():
                size = min(n - k + 1, len(doc))
                starts = lo + np.flatnonzero(hit[lo + size:hi + 1] - hit[lo:hi + 1 - size] >= self.threshold * (n - k + 1) - 1e-9)
                if not len(starts):
                    continue
                if votes is None:
                    votes = np.zeros((hi - lo + 1, 64), np.int32)
                    np.cumsum(_signs(doc[lo:hi]), axis=0, out=votes[1:])
                place, item = items.hits(doc[lo:hi])
                for start, i, distance in items.near(place, item, starts - lo, size, votes):
                    item_ids, own = items.items[i]
                    start, s = start + lo, None
                    for item_id in item_ids:
                        had = best.get(item_id, (0.0,))
                        if (1.0, -start, -(size + k - 1), -distance) > had:
                            s = similarity(doc[start:start + size], own) if s is None else s
                            if s >= self.threshold:
                                best[item_id] = max(had, (s, -start, -(size + k - 1), -distance))
        return [(item_id, s, -d, -at, -n) for item_id, (s, at, n, d) in sorted(best.items(), key=lambda x: (x[0] is None, x[0]))]


def _parts(bench: DataFrame, part_bytes: int):
    """The number of parts, and the parts (rows of bounded size), one on the driver at a time."""
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + total // part_bytes
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return n, ([(r[0], (r[1] or "").encode("utf-8", "replace")) for r in bench.where(part == p).select("item_id", "text").collect()]
               for p in range(n))


def _matched(rows: DataFrame, sent, item_type) -> DataFrame:
    """The first column of rows (with text) and item_id, similarity, distance, start_word, n_words."""
    key = rows.columns[0]
    types = (to_arrow_type(item_type), pa.float64(), pa.int32(), pa.int64(), pa.int64())
    names = ["item_id", "similarity", "distance", "start_word", "n_words"]

    def run(batches):
        index, words = sent.value, WordHashes(strip=True)
        for batch in batches:
            found = [index.matches(words.of(t)) for t in texts_of(batch)]
            rows = [m for ms in found for m in ms]
            ids = batch.column(0).take(pa.array([i for i, ms in enumerate(found) for _ in ms], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([r[c] for r in rows], t) for c, t in enumerate(types))], names=[key, *names])

    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, item_id {item_type.simpleString()}, similarity double, " \
             "distance int, start_word long, n_words long"
    return rows.mapInArrow(run, schema)


def matches(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", part_bytes: int = PART_BYTES) -> DataFrame:
    """id_col, item_id, similarity, distance, start_word, n_words: a row per document and benchmark item it holds."""
    sc, item_type = docs.sparkSession.sparkContext, bench.schema["item_id"].dataType
    n, parts = _parts(bench, part_bytes)
    if n == 1:
        return _matched(docs.select(id_col, "text"), sc.broadcast(Index(next(parts))), item_type)
    rows, found = stored(docs.select(F.monotonically_increasing_id().alias("_rid"), F.col(id_col).alias("_id"), "text"), "decontaminate"), None
    for items in parts:
        sent = sc.broadcast(Index(items))
        part = stored(_matched(rows.select(F.struct("_rid", "_id").alias("_doc"), "text"), sent, item_type), "decontaminate_part")
        sent.destroy()
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("similarity", (-F.col("start_word")).alias("start"), (-F.col("n_words")).alias("n"), (-F.col("distance")).alias("d")))
    return found.groupBy("_doc", "item_id").agg(best.alias("_best")).select(
        F.col("_doc._id").alias(id_col), "item_id", "_best.similarity", (-F.col("_best.d")).cast("int").alias("distance"),
        (-F.col("_best.start")).alias("start_word"), (-F.col("_best.n")).alias("n_words"))


def clean(docs: DataFrame, bench: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of docs that hold no benchmark item, all columns kept."""
    n, parts = _parts(bench, part_bytes)
    for items in parts:
        sent = docs.sparkSession.sparkContext.broadcast(Index(items))

        def run(batches, sent=sent):
            index, words = sent.value, WordHashes(strip=True)
            for batch in batches:
                yield batch.filter(pa.array([not index.matches(words.of(t)) for t in texts_of(batch)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if n > 1:       # one part's index at a time
            docs = stored(docs, "decontaminate_clean")
            sent.destroy()
    return docs

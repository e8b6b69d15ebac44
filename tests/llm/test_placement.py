"""Ring sharding and source mixing."""
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.llm import mixture as M, ring_shards as R


def check_shards(rows, n, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert len(rows) == n and all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_are_level_and_slots_gapless(spark, docs01, odd, none):
    check_shards(R.assign(docs01, 24, ["doc_id"]).collect(), docs01.count(), 24)
    out = R.assign(odd, 3, ["doc_id", "text"])
    check_shards(out.collect(), odd.count(), 3)
    assert sorted(out.columns) == sorted(odd.columns) and R.assign(none, 3, ["doc_id"]).count() == 0
    hot = spark.range(9000).select(F.when(F.col("id") < 3000, F.lit(7)).otherwise(F.col("id")).alias("doc_id"))
    check_shards(R.assign(hot.repartition(5), 24, ["doc_id"]).collect(), 9000, 24)


def test_shards_of_rows_in_another_order_each_time(spark):
    def shuffled(batches):
        for batch in batches:
            yield batch.take(np.random.default_rng().permutation(batch.num_rows))

    df = spark.range(5000, numPartitions=3).withColumnRenamed("id", "doc_id").mapInArrow(shuffled, "doc_id long")
    check_shards(R.assign(df, 24, ["doc_id"]).collect(), 5000, 24)


def test_place_equals_walking_the_ring():
    rng = np.random.default_rng(0)
    counts = np.zeros(R.CELLS, int)
    np.add.at(counts, rng.integers(0, R.CELLS, 3000), 1)
    counts[77] += 1500
    nodes, want, free = R.ring(7), Counter(), [4500 // 7 + (s < 4500 % 7) for s in range(7)]
    for cell in np.random.default_rng(0).permutation(R.CELLS):
        for _ in range(counts[cell]):
            clockwise = sorted(range(len(nodes)), key=lambda i: ((nodes[i][0] - cell) % R.CELLS, i))
            shard = next(nodes[i][1] for i in clockwise if free[nodes[i][1]])
            free[shard] -= 1
            want[(int(cell), shard)] += 1
        if sum(want.values()) > 2500:
            break
    got = Counter()
    for cell, shard, n in R.place(counts, 7):
        got[(cell, shard)] += n
    assert all(got[k] == want[k] for k in want if k[0] != int(cell)) and sum(got.values()) == 4500


def test_another_shard_moves_few_rows(docs01):
    a = {r.doc_id: r.shard for r in R.assign(docs01, 24, ["doc_id"]).collect()}
    b = {r.doc_id: r.shard for r in R.assign(docs01, 25, ["doc_id"]).collect()}
    assert sum(a[k] != b[k] for k in a) < 0.6 * len(a)      # a fresh hash would move 96 %


def test_water_fill():
    assert M.water_fill([100, 100, 100], [5, 2, 1], 1.5, 2.0) == pytest.approx([200, 500 / 3, 250 / 3])
    assert M.water_fill([], [], 1.5, 2.0) == [] and M.water_fill([0, 10], [5, 2], 1.5, 2.0) == [0, 15]
    t = M.water_fill([10, 1000, 500], [5, 2, 1], 1.5, 2.0)
    assert sum(t) == pytest.approx(2265) and all(x <= 2 * s + 1e-9 for x, s in zip(t, [10, 1000, 500]))


@pytest.mark.parametrize("n", [1, 2, 3, 100, 997])
def test_permutation_is_a_bijection(spark, n):
    out = [r[0] for r in spark.range(n).select(M.permute(F.col("id"), F.lit(n).cast("long"), F.lit(3))).collect()]
    assert sorted(out) == list(range(n)) and (n < 100 or out != sorted(out))


def words(text):
    return len((text or "").encode().split())


@pytest.mark.parametrize("block", [1, 16, 256])
def test_taken_words(docs01, block):
    rows = M.taken_words(docs01, block_words=block).collect()
    again = M.taken_words(docs01.repartition(7), block_words=block).collect()
    key = lambda r: tuple(r)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    docs = {r.doc_id: r for r in docs01.collect()}
    assert len(rows) == len(docs) and all(r.size == words(docs[r.doc_id].text) and r.taken <= 2 * r.size for r in rows)
    size, target, taken = Counter(), {}, Counter()
    for r in rows:
        s = docs[r.doc_id].source
        size[s] += r.size
        taken[s] += r.taken
        target[s] = (r.target, r.source_size)
    names = sorted(size)
    want = M.water_fill([size[s] for s in names], [[5, 2, 1][i % 3] for i in range(len(names))], 1.5, 2.0)
    for s, t in zip(names, want):
        assert target[s] == (pytest.approx(t), size[s])
        assert abs(taken[s] - t) <= max(2 * block, 0.02 * t)


def test_mixed_documents_hold_the_taken_words(docs001):
    out = M.mixed_documents(docs001, block_words=32)
    assert out.columns == docs001.columns
    taken = {r.doc_id: r.taken for r in M.taken_words(docs001, block_words=32).collect()}
    got, texts = Counter(), {r.doc_id: r.text for r in docs001.collect()}
    for r in out.collect():
        got[r.doc_id] += words(r.text)
        assert r.n_chars == len(r.text) and not Counter(r.text.split()) - Counter(texts[r.doc_id].split())
    assert got == Counter({k: n for k, n in taken.items() if n})


def test_shards_draw_their_sources(docs01):
    _, _, slots, sources = M.mix(docs01, block_words=16, n_shards=8)
    rows = slots.collect()
    assert sorted(r.position for r in rows) == list(range(len(rows)))
    total, share = Counter(r.out_shard for r in rows), Counter((r.out_shard, r.sid) for r in rows)
    assert max(total.values()) - min(total.values()) <= 8
    for s in sources.collect():
        for shard in range(8):
            p = s.slots / len(rows)
            assert abs(share[(shard, s.sid)] - total[shard] * p) < 5 * (total[shard] * p) ** 0.5 + 1


def test_mixing_odd_rows(odd, none):
    rows = M.taken_words(odd).collect()
    assert len(rows) == odd.count() and all(r.taken <= 2 * r.size for r in rows)
    assert M.taken_words(none).count() == 0 and M.mixed_documents(none).count() == 0
    assert M.mixed_documents(odd).columns == odd.columns
    blank = odd.where("doc_id in (2, 3)")
    assert [(r.size, r.target, r.taken) for r in M.taken_words(blank).collect()] == [(0, 0.0, 0)] * 2


def test_words_per_output_shard_come_through_the_draw(docs001):
    block, shards = 32, 8
    laid, _, slots, _ = M.mix(docs001, block_words=block, n_shards=shards)
    drawn = defaultdict(list)
    for s in slots.collect():
        drawn[(s.sid, s.block)].append(s.out_shard)
    want = {}
    for d in laid.collect():
        by = Counter()
        for w in range(d.offset, d.offset + d["size"]):               # every word of the document, one by one
            by.update(drawn[(d.sid, w // block)])
        want[d.doc_id] = by
    rows = M.taken_words(docs001, block_words=block, n_shards=shards).collect()
    got = {r.doc_id: Counter({int(a): int(b) for a, b in (x.split(":") for x in r.by_shard.split(",") if x)}) for r in rows}
    assert got == want and all(r.taken == sum(got[r.doc_id].values()) for r in rows)
    total = sum(got.values(), Counter())
    assert len(total) == shards and max(total.values()) < 1.2 * min(total.values())


def test_equal_rows_are_cut_alike_in_reruns(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, text, "a", f"t{i % 7}") for i in range(40)], "doc_id long, text string, source string, lang string")
    runs = [sorted(map(str, M.mixed_documents(df.repartition(p), block_words=16).collect())) for p in (2, 5)]
    assert runs[0] == runs[1]

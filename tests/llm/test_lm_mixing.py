import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkwright.llm import lm_mixing as L


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")) + ["\n"]


def base_scores(rows):
    held = {r: zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows}
    c = Counter(t for r in rows if not held[r] for t in tokens(r[1]))
    n, v = sum(c.values()), len(c)
    return sorted((r[0] is None, r[0] or 0, held[r], len(tokens(r[1])), sum(c[t] > 0 for t in tokens(r[1])), n,
                   round(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(r[1])), 5)) for r in rows)


def got_base(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in df.collect())


@pytest.mark.parametrize("common", [1 << 21, 50])
def test_base_equals_brute_force(docs001, monkeypatch, common):
    monkeypatch.setattr(L, "COMMON", common)
    rows = [tuple(r) for r in docs001.select("doc_id", "text").collect()]
    assert got_base(L.score_documents(docs001.select("doc_id", "text"))) == base_scores(rows)


def test_odd_rows(odd, none):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    out = L.score_documents(odd)
    assert got_base(out) == base_scores(rows)
    assert all(r.score <= 0 for r in out.collect())
    assert L.score_documents(none).count() == 0


def model(texts, cells=15):
    c = Counter(w for t in texts for w in [*L.words_of(t), L.END])
    h, n = np.array([L.hash_of(w) for w in c], np.int64), np.array(list(c.values()), np.int64)
    tokens = sum(c.values())
    known = n >= max(1.0, tokens / L.COMMON)
    v = L.Vocabulary(h[known], n[known], tokens, int((n == 1).sum()))
    words, counters, code = L.Words(v, cells, spell=True), L.Counters(cells), L.Code(v.mass)
    for t in texts:
        counters.learn(L.Run([t], words), code, words)
    edge = 2 << cells
    table = b"".join(L.finished(counters.all[b:b + L.BLOCK], False) for b in range(0, edge, L.BLOCK))
    return L.Model(v, cells, np.frombuffer(table, np.uint8), L.spelling_table(counters.all[edge:].astype(np.int64)))


def leaf_costs(m, texts):
    run = L.Run(texts, L.Words(m.vocabulary, m.cells))
    return run, m.leaf_costs(run)


def test_next_leaf_probabilities_sum_to_one():
    m = model([b"the cat sat on the mat and the dog sat too"] * 5)
    for prefix in (b"", b"the", b"the cat sat on the mat and the dog sat on the cat"):
        after = [w for w in set(b"the cat sat on mat and dog too".split())] + [b"zzz"]
        run, cost = leaf_costs(m, [prefix + b" " + w for w in after] + [prefix])
        at = np.cumsum(run.size) - 2
        end = cost[-1]          # the end behind the prefix is a leaf, too
        assert np.exp(-cost[at[:-1]]).sum() + np.exp(-end) == pytest.approx(1.0, abs=1e-4)


def test_spelling_probabilities_sum_to_one():
    m = model([b"alpha beta gamma delta"])
    one = 10 ** m.spelling.reshape(-1, 256).astype(float)
    assert np.allclose(one.sum(1), 1, atol=1e-4)
    assert m.spelling_costs([b"alpha"])[0] > m.spelling_costs([b"qqqqq"])[0]


def test_costs_do_not_depend_on_neighbours_and_learn():
    texts = [b"one two three " * 900, b"", b"three two one", b"zqx jjv kkw"]
    m = model([texts[0]])
    run, together = leaf_costs(m, texts)
    by_text = np.bincount(run.doc, weights=together)
    assert np.allclose(by_text, [leaf_costs(m, [t])[1].sum() for t in texts], rtol=1e-5)
    assert by_text[2] < by_text[3]


def test_cells_grow_with_the_tokens():
    assert [L.cell_bits(n) for n in (0, 1000, 1 << 22, 1 << 24, 1 << 40)] == [15, 15, 19, 21, L.MOST_CELLS]


def test_code_is_a_prefix_code_near_the_entropy():
    mass = np.sort(np.random.default_rng(0).integers(1, 1000, 300))[::-1]
    code = L.Code(mass)
    assert sum(2.0 ** -n for n in code.length) == pytest.approx(1.0)
    p = mass / mass.sum()
    assert (p * code.length).sum() < -(p * np.log2(p)).sum() + 1
    assert L.Code(np.array([5])).length.tolist() == [0]


M64 = (1 << 64) - 1


def mix(x):
    return int(L.mixed(np.array([x & M64], np.uint64))[0])


def one_bit_at_a_time(m, text):
    """log10 probability of a text in plain Python: contexts, gated mixing and correction of every single bit, then rare words."""
    v, code, total = m.vocabulary, m.code, 0.0
    counts, place = dict(zip(v.known.tolist(), v.times.tolist())), {h: i for i, h in enumerate(v.known.tolist())}
    common = 1 << (m.cells - 13)
    words = L.words_of(text) + [L.END]
    cues = []
    for i, w in enumerate(words):
        if i % L.LANE == 0:
            weights = [list(L.START_WEIGHTS) for _ in range(L.GATES)]
            adjust = [0.0] * L.BUCKETS
        if i % L.STEP == 0:
            moves, shifts = [[0.0] * 4 for _ in range(L.GATES)], [0.0] * L.BUCKETS
        h = L.hash_of(w)
        last, before = (cues[-1] if cues else 0), (cues[-2] if len(cues) > 1 else 0)
        if i:
            p = L.hash_of(words[i - 1])
            kind = p if counts.get(p, 0) * common >= v.tokens else int.from_bytes(words[i - 1][-2:], "little") % L.CLASSES
        else:
            kind = L.CLASSES
        a, b = mix(last + 1), mix(kind + 2)
        contexts = [a, b, mix(mix(a * 3 + before) % common + 3)]
        leaf = int(v.leaf[place[h]]) if h in place else v.rare_leaf
        for j in range(code.first[leaf], code.first[leaf] + code.length[leaf]):
            start, row, sign = float(code.start[j]), int(code.row[j]), int(code.sign[j])
            seen = [int(m.table[((c * int(L._SPREAD) + int(code.key[j])) & M64) >> (64 - m.cells)]) for c in contexts]
            x = [start] + [float(L.MOVES[row + s]) for s in seen]
            gate = int(L.LEVEL[seen[1]])
            odds = sum(p * q for p, q in zip(weights[gate], x))
            bucket = int(min(max(odds * 2 + L.BUCKETS / 2, 0), L.BUCKETS - 1))
            odds = min(max(odds + adjust[bucket], -18), 18)
            p = 1 / (1 + math.exp(-sign * odds))
            total += math.log10(p)
            moves[gate] = [o + L.RATE * sign * (1 - p) * y for o, y in zip(moves[gate], x)]
            shifts[bucket] += L.BUCKET_RATE * sign * (1 - p)
        if leaf == v.rare_leaf:
            n = counts.get(h, 0)
            total += math.log10((n or v.new) / (v.rare + v.new))
            if not n:
                total += float(m.spelling_costs([w])[0])
        if i % L.STEP == L.STEP - 1:
            weights = [[p + q for p, q in zip(*s)] for s in zip(weights, moves)]
            adjust = [p + q for p, q in zip(adjust, shifts)]
        if h in counts and counts[h] * L.CUES >= v.tokens and w != L.END:
            cues.append(h)
    return total


@pytest.mark.parametrize("coded", [1 << 16, 300])
def test_costs_equal_one_bit_at_a_time(docs001, monkeypatch, coded):
    monkeypatch.setattr(L, "CODED", coded)
    texts = [(r.text or "").encode() for r in docs001.select("text").limit(40).collect()]
    m = model(texts[:30])
    v = m.vocabulary
    some = texts[25:36] + [b"", b" ".join(texts[:12])[:9000]]
    assert max(len(t.split()) for t in some) > 2 * L.LANE
    run, cost = leaf_costs(m, some)
    got = -np.bincount(run.doc, weights=cost) / math.log(10)
    for i, t in enumerate(some):
        rare = [w for w in [*L.words_of(t), L.END] if (v.leaf[v.find(np.array([L.hash_of(w)]))[0]]) == v.rare_leaf]
        c = {L.hash_of(w): n for w, n in Counter(w for x in texts[:30] for w in [*L.words_of(x), L.END]).items()}
        for w in rare:
            n = c.get(L.hash_of(w), 0)
            got[i] += math.log10((n or v.new) / (v.rare + v.new)) + (0 if n else m.spelling_costs([w])[0])
    assert np.allclose(got, [one_bit_at_a_time(m, t) for t in some], rtol=2e-3)


def test_query_equals_the_model_trained_in_one_place(docs001):
    """All of it through Spark: counters added up from tasks, rare counts joined; any number of partitions."""
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs001.select("doc_id", "text").collect()]
    m = model([t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2])
    want = {i: one_bit_at_a_time(m, t) for i, t in rows[:60]}
    for parts in (1, 5):
        got = {r.doc_id: r.score for r in L.score_documents(docs001.select("doc_id", "text").repartition(parts)).collect()}
        assert all(got[i] == pytest.approx(s, rel=2e-3, abs=1e-3) for i, s in want.items())


def test_held_out_text_gains_from_contexts(docs01):
    """Against the same code without contexts and mixing."""
    rows = [((r.text or "").encode(), zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in docs01.select("doc_id", "text").collect()]
    m = model([t for t, held in rows if not held], L.cell_bits(400_000))
    run, cost = leaf_costs(m, [t for t, held in rows if held])
    assert cost.sum() < 0.97 * -np.log(m.vocabulary.mass / m.vocabulary.mass.sum())[run.leaf].sum()


def test_bits_per_byte(odd):
    for r in L.score_documents(odd).collect():
        assert r.bits_per_byte * r.n_bytes == pytest.approx(-r.score / math.log10(2))
    sizes = {r.doc_id: r.n_bytes for r in L.score_documents(odd).collect()}
    assert sizes[2] == sizes[3] == sizes[7] == 1 and sizes[6] == len("12 34 +1 (555) 123-4567\n")

"""Near-duplicates, decontamination and fingerprints against brute force."""
import hashlib
import random
import string
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkwright.llm import bagminhash as B, decontaminate as D, simhash as S
from sparkwright.llm.textutil import WordHashes


def shingle_counts(text, words=None):
    w = (text or "").lower().split() if words is None else words
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute_classes(rows):
    bags = [(i, shingle_counts(t)) for i, t in rows]
    holds = defaultdict(set)
    for n, (_, c) in enumerate(bags):
        for s in c or ["empty"]:
            holds[s].add(n)
    root = list(range(len(bags)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (_, c) in enumerate(bags):
        for m in set().union(*(holds[s] for s in c or ["empty"])):
            if m < n and (not c or jaccard(c, bags[m][1]) >= 0.8):
                a, b = sorted((find(n), find(m)))
                root[b] = a
    out = defaultdict(list)
    for n, (i, _) in enumerate(bags):
        out[find(n)].append(i)
    return sorted(sorted(v) for v in out.values())


def got_classes(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.class_id].append(r.doc_id)
        assert r.class_id is not None
    return sorted(sorted(v) for v in out.values())


def family(rng, n, size, edits):
    base = [f"w{rng.randrange(4000)}" for _ in range(size)]
    for _ in range(n):
        copy = list(base)
        for _ in range(edits):
            copy[rng.randrange(size)] = f"z{rng.randrange(10 ** 6)}"
        yield " ".join(copy)


def planted():
    rng = random.Random(11)
    texts = [*family(rng, 70, 120, 1), *family(rng, 40, 200, 3), *["one same line of text here"] * 50, *family(rng, 5, 6, 0)]
    texts += [" ".join(f"v{rng.randrange(5000)}" for _ in range(rng.randint(1, 150))) for _ in range(80)]
    texts += ["a b c d e f " * 30, "a b c d e f " * 31, "short one", "short  ONE", ""]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("chunk, reps", [(512, 32), (16, 16)])
def test_classes_equal_brute_force(spark, monkeypatch, chunk, reps):
    monkeypatch.setattr(B, "CHUNK", chunk)
    monkeypatch.setattr(B, "REPS", reps)
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got_classes(B.near_duplicates(df)) == brute_classes(rows)


def test_one_base_links_more_texts_than_a_chunk(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(base))]
    for n in range(1, 701):
        copy = list(base)
        for i in range(8):                       # the base is similar to each copy, the copies are not similar to each other
            copy[25 + 50 * i + rng.randrange(-20, 20)] = f"z{n}x{i}"
        rows.append((n, " ".join(copy)))
    bags = [shingle_counts(t) for _, t in rows[:40]]
    assert all(jaccard(bags[0], b) >= 0.8 for b in bags[1:]) and all(jaccard(bags[1], b) < 0.8 for b in bags[2:])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got_classes(B.near_duplicates(df)) == [list(range(701))]


def test_classes_of_the_documents(docs001):
    rows = [tuple(r) for r in docs001.select("doc_id", "text").collect()]
    want = brute_classes(rows)
    assert got_classes(B.near_duplicates(docs001)) == want
    assert sorted(r.doc_id for r in B.first_of_each(docs001).collect()) == sorted(c[0] for c in want)


def test_signature_agreement_estimates_weighted_jaccard():
    rng = np.random.default_rng(2)
    for same, own, times in ((80, 20, 1), (30, 50, 3), (10, 10, 9)):
        h = rng.integers(0, 2 ** 63, same + 2 * own).astype(np.uint64)
        n = rng.integers(1, times + 1, len(h))
        a = [*range(same), *range(same, same + own)]
        b = [*range(same), *range(same + own, same + 2 * own)]
        nb = n.copy()
        nb[:same] = rng.integers(1, times + 1, same)
        doc = np.repeat([0, 1], [len(a), len(b)])
        s = B.signatures(doc, np.concatenate([h[a], h[b]]), np.concatenate([n[a], nb[b]]), 2, 4000)
        true = np.minimum(n[:same], nb[:same]).sum() / (np.maximum(n[:same], nb[:same]).sum() + n[same:same + own].sum() + nb[same + own:].sum())
        assert (s[0] == s[1]).mean() == pytest.approx(true, abs=0.035)
        assert not np.isinf(s.view(float)).any()


def test_signature_does_not_depend_on_the_other_texts():
    words = WordHashes()
    texts = [b"x", b"a b c d e f g h", b"", b"q " * 500]
    whole = B.signatures(*B.weighted_sets(texts, words), len(texts))
    for i, t in enumerate(texts):
        assert (B.signatures(*B.weighted_sets([t], words), 1)[0] == whole[i]).all()


def test_duplicates_odd_rows(odd, none):
    out = sorted(((r.doc_id, r.class_id, r.class_size) for r in B.near_duplicates(odd).collect()), key=str)
    assert (8, 1, 2) in out and out.count((5, 5, 2)) == 2 and (2, 2, 3) in out and (3, 2, 3) in out and (7, 2, 3) in out
    assert (None, None, 1) in out and len(out) == odd.count()
    first = B.first_of_each(odd)
    assert first.columns == odd.columns and sorted(map(str, (r.doc_id for r in first.collect()))) == ["1", "2", "4", "5", "6", "None"]
    assert B.near_duplicates(none).count() == 0 and B.first_of_each(none).count() == 0


def norm(text):
    return [w for w in (w.strip(string.punctuation) for w in (text or "").lower().split()) if w]


def brute_matches(docs, items):
    out = {}
    for doc, text in docs:
        w = norm(text)
        for item, own in items:
            v = norm(own)
            k = min(5, len(v))
            if not v or len(w) < k:
                continue
            a = Counter(tuple(v[i:i + k]) for i in range(len(v) - k + 1))
            s = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
            size = min(sum(a.values()), len(s))
            best = max(jaccard(a, Counter(s[i:i + size])) for i in range(len(s) - size + 1))
            if best >= 0.8:
                out[(doc, item)] = round(best, 9)
    return out


def leaks():
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(12, 60)))) for i in range(25)] + [(25, "just three words"), (26, ""), (27, None)]
    items.append((28, items[0][1]))
    docs = []
    for n in range(120):
        text = [word() for _ in range(rng.randint(0, 80))]
        if n % 2:
            leak = items[rng.randrange(26)][1].split()
            for _ in range(rng.randrange(3)):
                if rng.random() < 0.6:
                    leak[rng.choice([0, -1])] = word()
                else:
                    leak.insert(rng.choice([1, len(leak) - 1]), word())
            at = rng.randint(0, len(text))
            text[at:at] = [leak[0].capitalize(), *leak[1:-1], leak[-1] + "."]
        docs.append((n, " ".join(text)))
    return docs + [(120, None), (121, ""), (121, items[3][1])], items


@pytest.mark.parametrize("part_bytes", [1 << 20, 700])
def test_matches_equal_brute_force(spark, part_bytes):
    docs, items = leaks()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in D.matches(df, bench, part_bytes=part_bytes).collect()}
    assert got == brute_matches(docs, items)
    held = {d for d, _ in got}
    assert sorted(r.doc_id for r in D.clean(df, bench, part_bytes).collect() if r.doc_id != 121) == [d for d, _ in docs if d not in held and d != 121]


def test_matches_with_far_fingerprints():
    rng = random.Random(3)
    words = WordHashes(strip=True)
    far = 0
    for _ in range(4000):
        item = [f"w{rng.randrange(10 ** 6)}" for _ in range(49)]
        doc = item[:44] + [f"z{rng.randrange(10 ** 6)}" for _ in range(5)]       # 40 of 50 shingles shared
        a, b = (D.shingles(words.of(" ".join(x).encode()), D.SHINGLE) for x in (item, doc))
        distance = (int(D._print(D._signs(a).sum(axis=0))[0]) ^ int(D._print(D._signs(b).sum(axis=0))[0])).bit_count()
        if distance > 18:
            far += 1
            found = D.Index([(7, " ".join(item).encode())]).matches(words.of(" ".join(doc).encode()))
            assert [(i, round(s, 9), d) for i, s, d, *_ in found] == [(7, 0.8, distance)]
    assert far


def test_decontamination_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "un texte de la rue")], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in D.matches(odd, bench).collect()] == [(None, 1)]
    assert D.clean(odd, bench).columns == odd.columns and D.clean(odd, bench).count() == odd.count() - 1
    assert D.matches(none, bench).count() == 0 and D.matches(odd, bench.limit(0)).count() == 0
    assert D.clean(odd, bench.limit(0)).count() == odd.count()


def simhash(text):
    import xxhash
    from math import log
    votes = [0.0] * 64
    for w, n in Counter((text or "").encode().lower().split()).items():
        h = xxhash.xxh3_64_intdigest(w)
        for b in range(64):
            votes[b] += (1 + log(n)) * (1 if h >> b & 1 else -1)
    return sum(1 << b for b in range(64) if votes[b] > 2e-4)


def test_edited_pairs_equal_brute_force(docs001):
    rows = sorted(((r.doc_id, r.text) for r in docs001.select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in S.edited_pairs(docs001).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]
        r, f, g, h = got[i], simhash(t), simhash(e), simhash(u)
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (int(r.fingerprint, 16), int(r.edited_fingerprint, 16)) == (f, g)
        assert (r.near_edited, r.near_next) == (1 - (f ^ g).bit_count() / 64, 1 - (f ^ h).bit_count() / 64)


def test_edited_pairs_odd_rows(odd, none):
    out = S.edited_pairs(odd).collect()
    assert len(out) == odd.count() and {r.fingerprint for r in out if r.doc_id in (2, 3)} == {"0" * 16}
    assert len({r.fingerprint for r in out if r.doc_id in (1, 8)}) == 1
    assert S.edited_pairs(none).count() == 0
    alone = S.edited_pairs(odd.where("doc_id = 1")).first()
    assert alone.near_next == 1.0


def test_within_finds_every_pair(spark):
    rng = random.Random(9)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for p in prints[:30]:
        for n in (1, 2, 3, 4):
            q = p
            for b in rng.sample(range(64), n):
                q ^= 1 << b
            prints.append(q)
    df = spark.createDataFrame([(f"{p:016x}",) for p in prints + prints[:5]], "fingerprint string")
    got = {(r.a, r.b): r.distance for r in S.within(df).collect()}
    own = sorted({f"{p:016x}" for p in prints})
    want = {(a, b): d for i, a in enumerate(own) for b in own[i + 1:] if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= 3}
    assert got == want


@pytest.mark.parametrize("item_type", ["long", "smallint", "string", "decimal(9,0)"])
def test_repeated_item_ids_and_parts(spark, item_type):
    docs, items = leaks()
    same = [(None if i % 5 == 4 else i % 5, t) for i, t in items]         # five ids, several texts each
    df = spark.createDataFrame(docs + docs[:30], "doc_id long, text string")
    bench = spark.createDataFrame(same, "item_id long, text string").selectExpr(f"cast(item_id AS {item_type}) AS item_id", "text")
    one, many = (sorted(map(str, D.matches(df, bench, part_bytes=p).collect())) for p in (1 << 20, 600))
    assert one == many and one
    assert D.matches(df, bench).schema["item_id"].dataType == bench.schema["item_id"].dataType


def test_few_items_are_probed():
    rng = random.Random(6)
    words = WordHashes(strip=True)
    common = [" ".join(f"c{rng.randrange(400)}" for _ in range(12)) for _ in range(20)]       # passages that many items share
    items = [f"{rng.choice(common)} " + " ".join(f"w{rng.randrange(3000)}" for _ in range(28)) for _ in range(5000)]
    index = D.Index([(i, t.encode()) for i, t in enumerate(items)])
    (_, _, _, classes), = index.groups
    (only,) = classes.values()
    for i in range(0, 5000, 10):
        leak = items[i].split()
        leak[-1] = "changed"
        text = " ".join([*(f"x{rng.randrange(3000)}" for _ in range(50)), *leak, *(f"x{rng.randrange(3000)}" for _ in range(50))])
        before = only.probed
        assert i in {m[0] for m in index.matches(words.of(text.encode()))}
        assert 0 < only.probed - before < 0.05 * len(items)               # all windows of the document together

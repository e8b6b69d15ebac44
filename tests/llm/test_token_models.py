"""Trie token counts and segmentation-marginalised language ID against enumeration."""
import itertools
import math
import random

import numpy as np
import pytest

from sparkwright.llm import langid as G, trie_tokens as T


def segmentations(word, pieces):
    if not word:
        yield ()
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            for rest in segmentations(word[k:], pieces):
                yield (word[:k], *rest)


def test_terminals_equal_enumeration():
    v = T.PieceScores(["a", "b", "▁", "ab", "▁a", "abb", "ba", "bab", "▁abba"])
    words = sorted("▁" + "".join(w) for n in range(1, 7) for w in itertools.product("ab", repeat=n)) + ["▁é", "▁éab"]
    for word, (n, s) in zip(words, T.terminals(words, v)):
        if "é" in word:
            head, tail = word.split("é")
            options = [(sum(v.score[p] for p in a + b) + 2 * v.byte, -(len(a) + len(b) + 2))
                       for a in segmentations(head, v.score) for b in segmentations(tail, v.score)]
        else:
            options = [(sum(v.score[p] for p in seg), -len(seg)) for seg in segmentations(word, v.score)]
        best = max(options)
        assert s == pytest.approx(best[0]) and n == -max(o[1] for o in options if o[0] > best[0] - 1e-9)


def test_count_tokens(odd, none, docs001):
    from sparkwright.llm.textutil import piece_vocabulary
    v = T.PieceScores(piece_vocabulary())
    rows = docs001.select("doc_id", "text").collect()
    want = {}
    for r in rows:
        per = [next(T.terminals(["▁" + w], v)) for w in r.text.encode().split() for w in [w.decode()]]
        want[r.doc_id] = (len(r.text.encode()), len(per), sum(n for n, _ in per), round(sum(s for _, s in per), 4))
    got = {r.doc_id: (r.n_bytes, r.n_pretokens, r.n_tokens, round(r.log_score, 4)) for r in T.count_tokens(docs001).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][:3] == want[k][:3] and got[k][3] == pytest.approx(want[k][3], abs=1e-3) for k in want)
    out = {(r.doc_id, r.n_bytes): r for r in T.count_tokens(odd).collect()}
    assert out[(2, 0)].n_tokens == 0 and out[(3, 0)].log_score == 0 and T.count_tokens(odd).count() == odd.count()
    assert T.count_tokens(none).count() == 0


@pytest.mark.parametrize("word", [b" ab", b" abcab", b"a" * 40, " né".encode(), b" " + b"ab" * 30])
def test_forward_sums_all_segmentations(word):
    pieces = G.Pieces(["a", "ab", "ca", "abc", "▁a", "aa"])
    prob = np.random.default_rng(1).random((len(pieces.units), 2)) / 50
    total = np.zeros((len(word) + 1, 2))
    total[0] = 1
    for d in range(1, len(word) + 1):
        for j in range(d):
            if word[j:d] in pieces.index:
                total[d] += total[j] * prob[pieces.index[word[j:d]]]
    assert np.allclose(G.word_scores(pieces, prob, [word])[0], np.log(total[-1]))


def test_em_raises_the_likelihood_and_wide_and_long_words_agree():
    rng = random.Random(3)
    pieces = G.Pieces(["ab", "abc", "bc", "▁a", "cab"])
    words = [b" " + bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 45))) for _ in range(80)]
    weights = np.array([[rng.randint(0, 3), rng.randint(0, 3)] for _ in words], float)
    last = -math.inf
    prob = np.full((len(pieces.units), 2), 1 / len(pieces.units))
    for _ in range(4):
        value = (weights * G.word_scores(pieces, prob, words)).sum()
        assert value >= last - 1e-6
        last = value
        counts = G._expected(pieces, prob, words, weights)
        slow = np.zeros_like(prob)
        for w, k in zip(words, weights):
            G._long_word(pieces, prob, w, k, slow)
        assert np.allclose(counts, slow)
        prob = (counts + 1e-9) / (counts + 1e-9).sum(axis=0)


def test_held_out_accuracy(docs01):
    got = G.identify(docs01)
    right = got.where("held_out").join(docs01.select("doc_id", "lang"), "doc_id").selectExpr("avg(cast(lang = lang_pred as int)) a", "min(score) lo", "max(score) hi").first()
    assert right.a > 0.98 and 0 <= right.lo and right.hi <= 1


def test_language_odd_rows(odd, none, docs001):
    out = {(r.doc_id, r.lang_pred) for r in G.identify(odd).collect()}
    assert {(2, "und"), (3, "und"), (7, "und"), (6, "und")} <= out and G.identify(odd).count() == odd.count()
    assert G.identify(none).count() == 0
    assert G.keep_identified(odd).columns == odd.columns and G.keep_identified(none).count() == 0
    from pyspark.sql import functions as F
    unlabelled = G.identify(docs001.withColumn("lang", F.lit(None).cast("string")))
    assert [r[0] for r in unlabelled.select("lang_pred").distinct().collect()] == ["und"]

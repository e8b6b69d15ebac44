"""Packing: round trips of every id, gapless windows, target shares, and a round-robin simulated step by step."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Reference

from sparkwright.llm import packing as K
from sparkwright.llm.queries import QUERIES

SF01, SF001 = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    return Reference.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def whole_windows(rows, window=2048):
    """Checks offsets and lengths of all sequences; returns their lengths."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    lengths = {}
    for s, parts in by.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        lengths[s] = at
    assert sorted(lengths) == list(range(len(lengths)))
    short = [v for v in lengths.values() if v != window]
    assert all(v < window and v & (v - 1) == 0 for v in short) and len(set(short)) == len(short)
    return lengths


def test_query_packs_every_id_once(spark, reference):
    """op12 over its whole table, against the tokenizer's own ids."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = QUERIES["op12_packing"](spark, SF01).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(docs)
    order = list(docs)
    for d, e in zip(order, reference.encode_batch([docs[d].text or "" for d in order], add_special_tokens=False)):
        ids, at = np.array([*e.ids, 1], "<u4"), 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    lengths = whole_windows(rows)
    # every full window holds the corpus's shares, within a quantum per source on either side
    total = sum(lengths.values())
    share, held = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for r in rows:
        share[r.source] += r.length
        held[r.sequence_id][r.source] += r.length
    spare = K.QUANTUM * (len(share) + 1)
    for s, n in lengths.items():
        if n == 2048 and s < len(lengths) - 20:
            assert sum(abs(held[s][q] - 2048 * share[q] / total) for q in share) < 2 * spare


def simulated(totals, weights, window, quantum):
    """The round-robin step by step: the queue of every token of the stream, in order."""
    sent, credit, stream, rounds = [0] * len(totals), [0] * len(totals), [], 0
    while sum(sent) < sum(totals):
        rounds += 1
        for q in range(len(totals)):
            credit[q] = rounds * window * weights[q] // sum(weights) - sent[q]       # what is carried over and the round's own
            n = totals[q] - sent[q] if credit[q] >= totals[q] - sent[q] else credit[q] // quantum * quantum
            stream += [(q, sent[q] + i) for i in range(n)]
            sent[q] += n
    return stream


@pytest.mark.parametrize("totals,weights,window,quantum", [
    ([100, 50, 7], [100, 50, 7], 16, 4), ([10, 300, 41, 1], [5, 1, 3, 9], 32, 5), ([64], [1], 16, 32), ([1, 1, 1000], [1, 1, 1], 8, 3),
    ([500, 0, 20], [3, 1, 1], 16, 1)])
def test_closed_form_equals_the_rounds(totals, weights, window, quantum):
    robin = K.RoundRobin(totals, weights, window, quantum)
    stream = simulated(totals, weights, window, quantum)
    place = {token: i for i, token in enumerate(stream)}
    for q, total in enumerate(totals):
        seen = [(q, t, at + t - a) for a, b, at in robin.runs(q, 0, total) for t in range(a, b)] if total else []
        assert [(q, t) for _, t, _ in seen] == [(q, t) for t in range(total)]
        assert all(place[q, t] == at for q, t, at in seen)
    for r in range(1, 8):
        active = robin.emitted(r) < robin.totals
        assert (robin.deficits(r)[active] >= 0).all() and (robin.deficits(r)[active] < quantum + 1).all()


def test_large_totals_stay_exact():
    """A stream of 10^13 tokens: far rounds agree with whole-number arithmetic of any size."""
    totals = [4 * 10**12, 6 * 10**12 - 7, 10**6, 3]
    robin = K.RoundRobin(totals)
    for r in (1, 10**6 + 1, 4 * 10**9 + 3):
        exact = [r * 2048 * int(w) // robin.all for w in robin.weights]
        assert robin.emitted(r).tolist() == [t if c >= t else c - c % K.QUANTUM for c, t in zip(exact, totals)]
    at = 5 * 10**12
    pieces = list(K.pieces_of(robin, 1, at, 5000, 2048))
    assert [p[0] for p in pieces] == np.cumsum([0] + [p[1] for p in pieces[:-1]]).tolist() and sum(p[1] for p in pieces) == 5000


def test_given_weights_hold_until_a_source_runs_out(spark):
    rows = [(i, "a" if i % 2 else "b", "one two three four five six seven eight") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    out = K.pack(df, {"a": 3, "b": 1}, window=64, quantum=4).collect()
    lengths = whole_windows(out, 64)
    held = defaultdict(lambda: defaultdict(int))
    for r in out:
        held[r.sequence_id][r.source] += r.length
    total_a = sum(r.length for r in out if r.source == "a")
    mixed = [s for s in lengths if s < total_a / 48 - 2]
    assert len(mixed) > 10 and all(abs(held[s]["a"] - 48) <= 8 for s in mixed)
    assert held[len(lengths) - 5]["a"] == 0


def test_defined_cases(spark, odd, none, reference):
    out = K.pack(odd)
    rows = out.collect()
    whole_windows(rows)
    assert sorted(str(r.doc_id) for r in rows if r.start == 0) == sorted(str(r.doc_id) for r in odd.collect())
    assert {r.doc_tokens for r in rows if r.doc_id in (2, 3)} == {1}
    put = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in K.sequences(out).collect()}
    docs = {}
    for r in rows:
        assert np.array_equal(put[r.sequence_id][r.offset:r.offset + r.length], np.frombuffer(r.ids, "<u4"))
        docs.setdefault(r.doc_id, []).append((r.start, r.ids))
    text = odd.where("doc_id = 4").first().text
    assert b"".join(i for _, i in sorted(docs[4])) == np.array([*reference.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
    assert K.pack(none).count() == 0 and set(K.pack(none).columns) == set(out.columns)


def test_joined_when_blocks_are_many_and_sources_pooled(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").repartition(6)
    monkeypatch.setattr(K, "BROADCAST_BLOCKS", 0)
    monkeypatch.setattr(K, "MAX_QUEUES", 3)
    rows = K.pack(docs).collect()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert sum(r.start == 0 for r in rows) == docs.count()
    whole_windows(rows)


@pytest.mark.parametrize("text", ["  a  b\n\n c\t ", "x" * 5000, " " * 5000 + "y", "é" * 2500 + " 日本語 " * 20, "I'll <|endoftext|> we're 12345!!", "\x00\x01 ﻿"])
def test_both_tokenizers_agree(reference, text):
    mine = K.Tokenizer.public()
    reference.encode_special_tokens = True
    assert mine.ids(text).tolist() == reference.encode(text, add_special_tokens=False).ids

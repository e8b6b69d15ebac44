"""Collocations: brute force on small tables, colliding fingerprints, the bitmap, defined cases, and the SQL twin."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from sparkwright.llm import phrases as P
from sparkwright.llm.queries import QUERIES, SQL

SF01, SF0001 = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if a >= min_count and len(p) > 1}
        rows, around = [], Counter()
        for q, fq in cand.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    around[q[i:i + m]] = max(around[q[i:i + m]], fq)
        for p, a in cand.items():
            if p in around and 100 * around[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def test_query_matches_duckdb(spark):
    """op13 over its whole table."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    out = QUERIES["op13_phrases"](spark, SF01)
    cur = con.execute(SQL["op13_phrases"])
    assert [d[0] for d in cur.description] == out.columns
    exp = sorted(cur.fetchall())
    assert len(exp) > 100 and sorted(map(tuple, out.collect())) == exp


@pytest.mark.parametrize("bits", [64, 13, 9])
def test_brute_force_also_when_fingerprints_collide(spark, docs001, bits):
    rows = [(r.lang, r.text) for r in docs001.collect()]
    for min_count, top in ((4, 50),) if bits < 64 else ((3, 10**6), (30, 7)):
        got = P.collocations(docs001.repartition(3), min_count, top, bits=bits)
        assert sorted(map(tuple, got.collect())) == brute(rows, min_count, top)


def test_beyond_the_broadcast_bound(spark, docs001, monkeypatch):
    exp = brute([(r.lang, r.text) for r in docs001.collect()], 5, 100)
    monkeypatch.setattr(P, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(P, "MOST_BITS", 1 << 10)               # a full bitmap prunes nothing
    assert sorted(map(tuple, P.collocations(docs001, 5, 100).collect())) == exp


def test_defined_cases(spark, odd, none):
    rows = [(r.lang, r.text) for r in odd.collect()]
    got = P.collocations(odd, 2, 500)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, 500)
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *[(c, "bigint") for c in ("a", "l", "r", "n", "score")]]
    assert P.collocations(none).count() == 0 and P.collocations(none).dtypes == got.dtypes


def test_separators_case_and_hot_rows(spark):
    texts = ["A b\tB  C", "É b, a b; c:d!e?f\ng\x0bh\x0ci\rj k", "a b a b a b a b", "É É É", " , ,\t", "a\x00b c\x00 d a b c"]
    rows = [(None if i % 3 else "en", texts[i % len(texts)]) for i in range(60)] + [("en", texts[2])] * 300 + [("und", None)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert sorted(map(tuple, P.collocations(df, 10).collect())) == brute(rows, 10, 2000)


def test_scores_past_64_bits(spark):
    """2000000 * a does not fit a long; the decimal arithmetic is exact."""
    a = 9 * 10**18 - 1
    row = spark.sql(f"SELECT CAST({a} AS bigint) AS a, CAST({a} AS bigint) AS l, CAST({a - 1} AS bigint) AS r").select(
        P.F.expr("CAST(a AS decimal(20,0)) * 2000000BD div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))").alias("s")).first()
    assert row.s == 2000000 * a // (2 * a - 1)


def test_bitmap_forgets_nothing(spark):
    fps = np.random.default_rng(0).integers(-2**63, 2**63 - 1, 5000)
    b = P.Bitmap.of(spark.createDataFrame([(int(v),) for v in fps], "fp long"), "fp")
    assert b(fps.view(np.uint64)).all()
    assert b(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)).mean() < 0.05


@pytest.mark.parametrize("hot_cuts", [1, 4, 10_000])
def test_salts_of_hot_parts_only(spark, monkeypatch, hot_cuts):
    rows = [("en", f"the w{i % 40} of the w{i % 7} w{i % 11}") for i in range(2000)] + [(None, "the the of the")] * 50
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    monkeypatch.setattr(P, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(P, "HOT_CUTS", hot_cuts)
    assert sorted(map(tuple, P.collocations(df, 10, 50).collect())) == brute(rows, 10, 50)
    table = spark.createDataFrame([("a", 10), ("b", 9), ("c", 1000)], "w string, f long")
    got = [(r.w, r._t) for r in P._salted(table, "f", 10 * hot_cuts).collect()]
    salts = [w for w, f in (("a", 10), ("b", 9), ("c", 1000)) if f >= 10 * hot_cuts]
    assert len(got) == 3 + (P.SALTS - 1) * len(salts) and ("b", 0) in got


def test_first_pass_sends_few_bytes_and_loses_nothing(spark, docs001):
    """What the tasks of the counting pass send for the n-grams, frequent or not; the fingerprint rows it replaces took 28 bytes each."""
    texts, number = P._texts(docs001, "text", "lang").coalesce(1).cache(), P.Buckets(4)
    sent = P.bucket_counts(texts, 30, number).collect()
    entries = sum(len(r.counts) for r in sent)
    rows = [(r.lang, r.text) for r in texts.collect()]
    grams, frequent = set(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", text.translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            frequent.update((lang, *w[i:i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    grams.update(frequent)
    assert 0.95 * len(grams) < entries <= len(grams)           # equal n-grams of a task are one entry
    assert sum(len(r.buckets) + len(r.counts) for r in sent) == 4 * entries
    survivors = P.frequent_buckets(texts, 30, number, 2)
    enough = sum(f >= 30 for f in frequent.values())
    assert enough <= survivors.count() + 2 and survivors.count() < 1.01 * enough + 2
    texts.unpersist()


def test_counts_are_cut_without_loss(spark):
    """Buckets in many tasks reach the least count by the sum of their cut counts, also where that needs several bytes."""
    for least in (30, 300, 70_000):
        rows = [("en", "a b")] * (least if least < 1000 else 400)
        df = spark.createDataFrame(rows, "lang string, text string").repartition(7)
        assert P.frequent_buckets(df, least, P.Buckets(2), 2).count() == (3 if least < 1000 else 0)
        assert P.frequent_buckets(df.limit(least - 1), least, P.Buckets(2), 2).count() == 0

import __spark_entry__ as E
import corpus_pipeline as P
from sparkwright.llm import bagminhash, decontaminate, langid

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert [n for n, _ in P.STAGES] == ["language", "near_dedup", "decontamination", "mixing", "sharding"]


def test_stages_take_effect(spark, docs001, tmp_path):
    kept, docs = {}, docs001
    for name, stage in P.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        if name != "sharding":
            assert docs.columns == docs001.columns
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    assert ids(kept["language"]) == ids(docs001)
    classes = bagminhash.near_duplicates(kept["language"])
    assert sorted(r[0] for r in kept["near_dedup"].select("doc_id").collect()) == sorted({r.class_id for r in classes.collect()})
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert ids(kept["decontamination"]) == ids(kept["near_dedup"]) - ids(decontaminate.matches(kept["near_dedup"], bench))
    counts = [r[0] for r in kept["sharding"].groupBy("shard").count().select("count").collect()]
    assert sum(counts) == kept["mixing"].count() and max(counts) - min(counts) <= 1
    assert P.run(spark, SF).count() == sum(counts)


def test_run_stores_every_stage(spark, docs001, monkeypatch):
    seen = []
    watched = lambda name, stage: (name, lambda s, docs, d: (seen.append((name, docs.inputFiles())), stage(s, docs, d))[1])
    monkeypatch.setattr(P, "STAGES", [watched(*x) for x in P.STAGES])
    out = P.run(spark, SF)
    names = [n for n, _ in P.STAGES]
    for (_, files), before in zip(seen[1:], names):
        assert files and all(f"/stored/{before}-" in f for f in files)
    assert all("/stored/sharding-" in f for f in out.inputFiles())
    assert out.columns == [*docs001.columns, "shard", "slot"]
    slots = {}
    for r in out.select("shard", "slot").collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(P.SHARDS)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(P.SHARDS)]
    assert max(sizes) - min(sizes) <= 1


def test_pipeline_on_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in P.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() >= 0
    assert langid.keep_identified(odd).where("text is null or text = ''").count() == 0

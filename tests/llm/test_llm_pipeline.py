"""The five stages, one after the other, each against its own input."""

import corpus_pipeline as P
from conftest import SF_SMALL

from tessera.llm import decontaminate, secret_scan
from tessera.llm.common import stored, with_rank
from pyspark.sql import functions as F


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    index = decontaminate.BenchmarkIndex(items)
    for n, (name, stage) in enumerate(P.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stored(stage(spark, docs, SF_SMALL), "test")
        if n == len(P.STAGES) - 1:
            assert {r["doc_id"] for r in out.select("doc_id").collect()} == set(before)
            break
        assert out.columns == names
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        assert out.count() == len(after) and set(after) <= set(before)
        if name == "benchmark_decontamination":
            assert set(after) == {i for i, t in before.items() if not index.hits(t)}
        elif name == "secret_scan":
            assert set(after) == set(before)
            assert not any(secret_scan.find_secrets(t) for t in after.values())
        else:
            assert all(after[i] == before[i] for i in after)
        docs = out
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "best_fit_packing"]


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF_SMALL), "test")
    whole = stored(P.run(spark, SF_SMALL), "test")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    assert whole.columns == docs.columns
    assert whole.select(columns).exceptAll(docs.select(columns)).count() == 0 and whole.count() == docs.count()
    assert whole.select("sequence_id").distinct().count() == docs.select("sequence_id").distinct().count()
    # sequences: gapless from 0, no longer than they may be, and made of the ids of the pieces
    sequences = {}
    for r in whole.collect():
        assert len(r["ids"]) == 4 * r["length"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None, 1, "t"), (1, None, None, None, None, 1, "t"), (None, "", "en", "s", 0, 2, "u"), (3, "word " * 60_000, "en", "s", 5, 3, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int, hits string")
    for frame in (docs, docs.limit(0)):
        for name, stage in P.STAGES:
            frame = stored(stage(spark, frame, SF_SMALL), "test")
            if name != "best_fit_packing":
                assert frame.columns == docs.columns


def test_rank_is_gapless_in_every_group(spark):
    rows = [(p, g, n) for p in range(5) for g in ("a", "b", None) for n in range(p * (2 if g == "a" else 1))]
    out = with_rank(stored(spark.createDataFrame(rows, "part long, g string, n long"), "test"), "g", "part", "n", "rank").collect()
    for g in ("a", "b", None):
        numbers = sorted(r["rank"] for r in out if r["g"] == g)
        assert numbers == list(range(len(numbers))) and numbers

"""Jump hashing against the plain loop."""

import zlib

import numpy as np
from conftest import SF_SMALL

from tessera.llm import jump_shard as J
from tessera.llm import queries


def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_vector_equals_plain_loop():
    keys = J.spread(np.arange(2000, dtype=np.uint64))
    for shards in (1, 2, 8, 9, 1000):
        assert J.jump_hash(keys, shards).tolist() == [plain_jump(int(k), shards) for k in keys]


def test_only_the_new_shard_gains():
    keys = J.spread(np.arange(100_000, dtype=np.uint64))
    was, now = J.jump_hash(keys, 8), J.jump_hash(keys, 9)
    assert set(now[was != now].tolist()) == {8}
    assert abs((was != now).mean() - 1 / 9) < 0.005
    assert np.ptp(np.bincount(was)) < 0.05 * len(keys) / 8


def check(rows, docs):
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs
    )
    slots = {}
    for r in rows:
        assert r["grown_shard"] in (r["shard"], 8)
        slots.setdefault(r["shard"], []).append(r["slot"])
    for numbers in slots.values():
        assert sorted(numbers) == list(range(len(numbers)))


def test_query_deals_every_row(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = queries.op8_jump_sharding(spark, SF_SMALL).collect()
    check(rows, docs)
    assert {r["law"] for r in rows} == {"key"} and len({r["shard"] for r in rows}) == 8


def test_defined_cases(spark):
    docs = [(0, None), (0, "ä"), (-5, ""), (2**62 + 1, "x" * 200_000), (7, "same"), (7, "same")]
    table = spark.createDataFrame([(i, t, 3, 4) for i, t in docs], "doc_id long, text string, shard int, slot int").repartition(4)
    check(J.assign_shards(table).collect(), docs)
    nulls = J.assign_shards(spark.createDataFrame([(None, "a"), (2**62 + 1, "b")], "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in nulls} == {None, 2**62 + 1}
    assert J.assign_shards(table.limit(0)).count() == 0


def test_written_shards_hold_every_row(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    J.write_shards(docs, f"{tmp_dir}/shards")
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 8
    want = {r["doc_id"]: r["shard"] for r in J.assign_shards(docs).collect()}
    assert {r["doc_id"]: r["shard"] for r in back.select("doc_id", "shard").collect()} == want

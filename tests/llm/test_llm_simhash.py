"""SimHash groups against all pairs."""

import random

import pandas as pd
import pytest
import xxhash
from conftest import SF_SMALL

from tessera.llm import simhash_dedup as S
from tessera.llm.common import connected_components, stored


def plain_simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    every = sorted(parent)
    for i, a in enumerate(every):
        for b in every[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
                parent[find(b)] = find(a)
    return {p: find(p) for p in every}


def check(rows, out):
    """rows: (id, text); out: dict of id -> (fingerprint, component)."""
    prints = {i: plain_simhash(t) for i, t in rows}
    root = plain_components(set(prints.values()), 2)
    smallest = {}
    for i, p in prints.items():
        smallest[root[p]] = min(i, smallest.get(root[p], i))
    for i, p in prints.items():
        assert out[i] == (f"{p:016x}", smallest[root[p]])


@pytest.mark.parametrize("hot", [S.HOT_BUCKET, 2])
def test_documents_match_all_pairs(spark, hot):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = S.near_duplicates(docs, hot_bucket=hot).collect()
    check([(r["doc_id"], r["text"]) for r in docs.collect()], {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found})
    assert len(found) == docs.count()


def test_defined_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \t\x0b"), (4, "Two Words"), (5, "two\x1fwords"), (6, "two words"), (7, "ÄB c d"), (8, "Äb C D"), (9, long), (10, long)]
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, fp string, id int")
    out = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in S.near_duplicates(docs).collect()}
    check(rows, out)
    assert out[1] == out[2] == out[3] == ("0" * 16, 1)
    twice = docs.unionByName(docs)
    assert S.near_duplicates(twice).count() == 20
    empty = S.near_duplicates(docs.limit(0))
    assert empty.count() == 0 and empty.columns[:3] == ["doc_id", "fingerprint", "component_id"]


def test_one_of_each_group_keeps_one_row(spark):
    rows = [(5, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, "other words stand here"), (None, "lonely null id text"), (None, "another null id, another text")]
    docs = spark.createDataFrame([(i, t, "u", 1) for i, t in rows], "doc_id long, text string, doc string, row int")
    kept = S.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "another null id, another text"), (0, "lonely null id text"), (3, "a b c d"), (9, "other words stand here")]


@pytest.mark.parametrize("seed,distance,hot", [(0, 2, 1024), (1, 2, 3), (2, 3, 1024), (3, 3, 2), (4, 1, 1024)])
def test_clustered_fingerprints_match_all_pairs(spark, seed, distance, hot):
    rng = random.Random(seed)
    values = set()
    for _ in range(20):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 40])):
            near = centre
            for _ in range(rng.randint(0, 4)):
                near ^= 1 << rng.randrange(64)
            values.add(near)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = stored(spark.createDataFrame([(v,) for v in signed], "fp long"), "test")
    links = S.link_fingerprints(frame, distance, hot)
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    want = plain_components(set(signed), distance)
    groups = lambda m: sorted(sorted(k for k in m if m[k] == r) for r in set(m.values()))
    assert groups({v: got.get(v, v) for v in signed}) == groups(want)


def test_allotments_spend_all_units_and_prefer_rare_values(spark):
    values = pd.DataFrame({"fp": [i << 32 | 7 for i in range(2000)]})
    plan = S.fit_allotment(spark.createDataFrame(values), 2, (3,))
    units = plan.for_values(values["fp"].to_numpy())
    assert (units.sum(axis=1) == 3).all()
    assert sorted(b for g in plan.groups for b in g) == list(range(64))


def test_components_of_a_long_chain(spark):
    chain = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    out = connected_components(chain)
    assert out.count() == 301 and out.where("root <> 0").count() == 0

"""Hits against every window of every document."""

import random

import numpy as np
from conftest import SF_SMALL

from tessera.llm import decontaminate as D

WORDS = [f"w{i}" for i in range(400)]


def brute(text, items):
    """Best similarity of each item over all item-sized windows."""
    words = D.words_of(text)
    out = {}
    for item, item_text in items:
        own = D.words_of(item_text)
        if not own or not words:
            continue
        span = min(len(own), len(words))
        counts = D.shingle_counts(own)
        values = [D.weighted_similarity(D.shingle_counts(words[s : s + span]), counts) for s in range(len(words) - span + 1)]
        best = int(np.argmax(values))
        if values[best] >= 0.8:
            out[item] = (best, span, values[best])
    return out


def make(seed):
    rng = random.Random(seed)
    passage = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    items = [(i, passage(rng.choice([3, 8, 20, 45, 60]))) for i in range(25)] + [(99, ""), (98, None), (97, "!?")]
    docs = []
    for i in range(60):
        text = passage(rng.randint(0, 120))
        if i % 2:
            words = rng.choice(items[:25])[1].split()
            for _ in range(i % 3):
                words[rng.randrange(len(words))] = "changed"
            if i % 7 == 0:
                words.insert(len(words) // 2, "more")
            text += " " + ", ".join(words).upper() + ". " + passage(30)
        docs.append((i, text))
    return items, docs


def test_hits_match_all_windows(spark):
    for seed in range(3):
        items, docs = make(seed)
        index = D.BenchmarkIndex(items)
        for _, text in docs:
            got = {h[0]: (h[1], h[2], h[4]) for h in index.hits(text)}
            assert got == brute(text, items)


def test_many_indexes_give_the_same_hits(spark):
    items, docs = make(7)
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, hits string, doc int")
    one = sorted(map(tuple, D.contaminated(table, bench).collect()))
    assert one and {r[0] for r in one} == {i for i, t in docs if brute(t, items)}
    many = D.with_hits(table, bench, items_per_index=4)
    assert sorted((r["doc"]["doc_id"], *h) for r in many.collect() for h in r["hits"]) == one
    kept = D.without_benchmark(table, bench)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in docs if not brute(t, items)}


def test_defined_cases(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven"), (1, "one two three four five six seven"), (2, "short item")], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, "One two THREE four, five six seven!"), (4, "a short item here"), (5, "one two three four five"),
            (6, "x " * 100_000 + "one two three four five six seven " * 3_000), (None, "short item")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0), r["item_id"]) for r in D.contaminated(docs, bench).distinct().collect())
    assert got == [(0, 2), (3, 1), (4, 2), (6, 1)]
    assert D.contaminated(docs.limit(0), bench).count() == 0
    assert D.without_benchmark(docs, bench.limit(0)).count() == len(rows)


def test_planted_benchmark_text_is_found(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    index = D.BenchmarkIndex(items)
    docs = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(30).collect()]
    for (item, text), doc in zip(items, docs, strict=False):
        assert item in {h[0] for h in index.hits(doc[: len(doc) // 2] + "\n" + text + "\n" + doc[len(doc) // 2 :])}


def test_a_long_text_that_repeats_a_long_item():
    import time
    import tracemalloc

    rng = random.Random(9)
    item = [rng.choice(WORDS) for _ in range(200)]
    index = D.BenchmarkIndex([(1, " ".join(item)), (2, " ".join(WORDS[:60]))])
    text = " ".join(item * 2_500)
    tracemalloc.start()
    began = time.process_time()
    hits = index.hits(text)
    took, peak = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    assert [h[:3] for h in hits] == [(1, 0, 200)] and hits[0][4] == 1.0
    assert took < 60 and peak < 500e6


def test_sliding_counts_equal_counting_anew():
    rng = random.Random(2)
    for _ in range(200):
        codes = [rng.randint(-1, 4) for _ in range(60)]
        count = rng.randint(1, 12)
        wanted = [rng.randint(1, 3) for _ in range(5)]
        starts = sorted(rng.sample(range(60 - count + 1), rng.randint(1, 20)))
        got = D.sliding_similarity(codes, starts, count, wanted)
        for s, value in zip(starts, got, strict=True):
            common = sum(min(codes[s : s + count].count(c), n) for c, n in enumerate(wanted))
            assert value == common / (count + sum(wanted) - common)


def test_recall_by_similarity():
    """Share of windows of each band that the whole chain finds."""
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.choice([40, 80, 150])))) for i in range(40)]
    index = D.BenchmarkIndex(items)
    seen, found = {}, {}
    for trial in range(900):
        i, text = rng.choice(items)
        words = text.split()
        for _ in range(trial % 4):
            at = rng.randrange(len(words))
            words[at] = "other" + str(rng.randrange(50))
        noisy = " ".join(words)
        value = brute(noisy, [(i, text)]).get(i)
        if value:
            band = 0.8 if value[2] < 0.85 else 0.85 if value[2] < 0.9 else 0.9
            seen[band] = seen.get(band, 0) + 1
            found[band] = found.get(band, 0) + any(h[0] == i for h in index.hits(noisy))
    assert set(seen) == {0.8, 0.85, 0.9}
    assert found[0.9] == seen[0.9] and found[0.85] >= 0.99 * seen[0.85] and found[0.8] >= 0.98 * seen[0.8]

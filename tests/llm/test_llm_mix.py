"""Curriculum mixing against a plain loop and against SQL."""

import hashlib
import math
import re

import duckdb
import pytest
from conftest import SF_SMALL

from tessera.llm import curriculum_mix as C
from tessera.llm import queries

SCHEMA = "doc_id long, source string, text string"


def plain_targets(sizes, weights, budget=1.5, most=2):
    """Share by weight; what is over a source's most is shared again among the others."""
    left, open_, out = budget * sum(sizes.values()), dict(weights), {}
    while open_:
        total = sum(open_.values())
        over = [s for s in open_ if left * open_[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * w / total for s, w in open_.items()}
        for s in over:
            out[s] = float(most * sizes[s])
            del open_[s]
        left = budget * sum(sizes.values()) - sum(out.values())
    return out


def plain_mix(docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_source = {}
    for i, s, t in docs:
        by_source.setdefault(s, []).append((hashlib.md5(("" if i is None else str(i)).encode()).hexdigest(), -1 if i is None else i, size(t)))
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(r[2] for r in rows) for s, rows in by_source.items()}
    targets = plain_targets(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)})
    out = []
    for s, rows in by_source.items():
        left = [0] * len(rows)
        need = math.floor(targets[s] + 1e-9)
        rows.sort()
        for _ in range(2):
            for k, (_, _, n) in enumerate(rows):
                took = min(n, need)
                left[k] += took
                need -= took
        out += [(None if r[1] < 0 else r[1], r[2], sizes[s], round(targets[s], 6), took) for r, took in zip(rows, left, strict=True)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect()), key=str)


ODD = [
    (1, "a", "one two  three"), (2, "a", ""), (3, "a", None), (4, "b", "x " * 500), (5, "b", "  y\x0bz\x1c"),
    (6, None, "q r s t"), (None, "c", "lost id"), (None, "c", "lost id"), (7, "é", "w " * 40), (7, "é", "w " * 40),
    (8, "Z", "v" * 100_000), (9, "", "empty name"),
]


def test_odd_rows_equal_the_plain_loop(spark):
    got = C.mix(spark.createDataFrame(ODD, SCHEMA))
    assert rows_of(got) == plain_mix(ODD)


def test_a_hot_source_and_repeated_rows(spark):
    docs = [(i, "hot" if i % 3 else f"s{i % 7}", "w " * (1 + i % 11)) for i in range(1500)] + [(5, "hot", "w w")] * 400
    got = C.mix(spark.createDataFrame(docs, SCHEMA).repartition(7))
    assert rows_of(got) == plain_mix(docs)
    again = C.mix(spark.createDataFrame(docs[::-1], SCHEMA).repartition(3))
    key = lambda df: sorted((r["doc_id"], r["source"], r["taken"], r["position"] or -1) for r in df.collect())
    assert key(got) == key(again)
    placed = [r["position"] for r in got.collect()]
    taken = [p for p in placed if p is not None]
    assert taken == sorted(taken) and placed[: len(taken)] == taken


def test_positions_follow_the_schedules(spark):
    docs = [(i, f"s{i % 3}", "w " * 10) for i in range(3000)]
    copies = C.training_order(C.mix(spark.createDataFrame(docs, SCHEMA), budget=0.9)).collect()
    positions = [c["position"] for c in copies]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] < 1
    for number, schedule in enumerate(C.SCHEDULES):
        own = [c for c in copies if c["source"] == f"s{number}"]
        for lo, hi in ((0.0, 0.25), (0.25, 0.5), (0.5, 1.0)):
            (_, a), (_, b) = schedule
            share = (hi - lo) * (a + (b - a) * (lo + hi) / 2) / C.integral(schedule)
            words = sum(c["words"] for c in own if lo <= c["position"] < hi)
            assert abs(words - share * sum(c["words"] for c in own)) <= 10


def test_schedules_with_flat_stretches(spark):
    plans = [((0.0, 0.0), (0.5, 0.0), (0.5, 2.0), (1.0, 2.0)), ((0.0, 1.0), (0.5, 1.0), (0.5, 0.0), (1.0, 0.0)), ((0.0, 0.0), (1.0, 0.0))]
    docs = [(i, f"s{i % 3}", "w") for i in range(300)]
    got = C.mix(spark.createDataFrame(docs, SCHEMA), plans, budget=0.3).collect()
    late = [r["position"] for r in got if r["source"] == "s0" and r["position"] is not None]
    soon = [r["position"] for r in got if r["source"] == "s1" and r["position"] is not None]
    assert late and min(late) >= 0.5 and soon and max(soon) <= 0.5
    assert not any(r["taken"] for r in got if r["source"] == "s2")


def test_everything_full_and_bad_schedules(spark):
    docs = spark.createDataFrame([(1, "a", "x y"), (2, "b", "z")], SCHEMA)
    assert sorted(r["taken"] for r in C.mix(docs, budget=9.0).collect()) == [2, 4]
    with pytest.raises(ValueError):
        C.mix(docs, [((0.0, 0.0), (1.0, 0.0))])
    with pytest.raises(ValueError):
        C.segments(((0.0, 1.0), (0.5, -1.0)))


def test_empty_table_and_clashing_columns(spark):
    assert C.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    wide = spark.createDataFrame([(1, "a", "x y", 7, 8, 9)], SCHEMA + ", size long, part int, position long")
    assert rows_of(C.mix(wide)) == [(1, 2, 2, 3.0, 3)]
    blank = C.mix(spark.createDataFrame([(1, "a", None), (2, "b", " ")], SCHEMA)).collect()
    assert [(r["taken"], r["position"], r["target"]) for r in blank] == [(0, None, 0.0)] * 2


def test_query_equals_sql_and_stays_native(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = queries.op11_curriculum_mix(spark, SF_SMALL)
    wanted = con.execute(queries.ORACLE["op11_curriculum_mix"])
    names = [d[0] for d in wanted.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(wanted.fetchall())
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan

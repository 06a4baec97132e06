"""Reply trees and their format."""

import hashlib
import importlib

import duckdb
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import chat_trees as C
from tessera.llm import queries

TREE = "tree long, id long, parent long, role string, text string, score double"


def brute_paths(nodes, branches):
    """Best root-to-leaf paths by plain recursion."""
    ids = {n[0] for n in nodes}
    children, score = {}, {}
    for i, parent, s in nodes:
        score[i] = s
        children.setdefault(parent if parent in ids and parent != i else None, []).append(i)

    def walk(i, path, total):
        path, total = [*path, i], total + score[i]
        if not children.get(i):
            yield total, i, path
        for c in children.get(i, []):
            yield from walk(c, path, total)

    every = [p for root in children.get(None, []) for p in walk(root, [], 0.0)]
    return [p[2] for p in sorted(every, key=lambda p: (-p[0], p[1]))[:branches]]


def test_paths_match_plain_recursion(spark):
    import random

    rng = random.Random(3)
    trees = {}
    for tree in range(6):
        size = rng.choice([1, 2, 9, 40])
        trees[tree] = [(i, rng.randrange(i) if i and rng.random() < 0.9 else None, float(rng.randrange(-3, 4))) for i in range(size)]
    rows = [(t, i, p, "user", f"t{i}", s) for t, nodes in trees.items() for i, p, s in nodes]
    out = C.branch_paths(spark.createDataFrame(rows, TREE), branches=3).collect()
    for tree, nodes in trees.items():
        for rank, want in enumerate(brute_paths(nodes, 3), 1):
            got = sorted((-r["above"], r["id"]) for r in out if r["tree"] == tree and r["branch"] == rank)
            assert [i for _, i in got] == want


def test_deep_chain_and_defined_cases(spark):
    rows = [(1, i, i - 1 if i else None, None if i == 5 else "user", None if i == 7 else f"x{i}", 1.0) for i in range(400)]
    rows += [(2, 0, 0, "user", "own parent is a root", None), (None, 4, 99, "user", "absent parent", 0.0)]
    rows += [(3, 1, 2, "user", "cycle", 0.0), (3, 2, 1, "user", "cycle", 0.0)]
    out = {r["tree"]: r for r in C.format_branches(spark.createDataFrame(rows, TREE)).collect()}
    turns = C.read_back(out[1]["formatted"])
    assert turns == [("" if i == 5 else "user", "" if i == 7 else f"x{i}") for i in range(400)]
    assert C.read_back(out[2]["formatted"]) == [("user", "own parent is a root")]
    assert C.read_back(out[None]["formatted"]) == [("user", "absent parent")]
    assert 3 not in out
    assert C.format_branches(spark.createDataFrame([], TREE)).count() == 0


ODD = st.text(alphabet="\\#<: \n/turn>xé😀", max_size=30)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "### a: <"]), ODD), min_size=1, max_size=5))
def test_format_is_reversible(spark, turns):
    rows = [(1, n, role, text) for n, (role, text) in enumerate(turns)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    row = C.format_branches(C.chain_messages(table, "conv_id", "turn", "role", "text")).first()
    assert C.read_back(row["formatted"]) == turns
    learned = [C.unescaped(row["formatted"][s["start"] : s["end"]]) for s in row["loss_spans"]]
    assert learned == [t for r, t in turns if r == "assistant"]


def test_plain_turns_defined_cases(spark):
    rows = [(1, 1, "user", "same"), (1, 1, "user", "same"), (1, 1, "assistant", "equal turn"), (1, None, None, "first"), (None, 5, "user", None), (2, 0, "assistant", "x# " * 200_000)]
    table = spark.createDataFrame([(*r, "t", 1.5) for r in rows], "conv_id long, turn long, role string, text string, tree string, score double")
    chats = C.format_branches(C.chain_messages(table, "conv_id", "turn", "role", "text"))
    got = {r["tree"]: C.read_back(r["formatted"]) for r in chats.collect()}
    assert got[1] == [("", "first"), ("assistant", "equal turn"), ("user", "same"), ("user", "same")]
    assert got[None] == [("user", "")] and got[2] == [("assistant", "x# " * 200_000)] and len(got) == 3
    assert C.format_branches(C.chain_messages(table.limit(0), "conv_id", "turn", "role", "text")).count() == 0


def test_reading_a_long_text_back_takes_little_memory():
    import tracemalloc

    formatted = "### user: " + "ab\\#" * 1_000_000 + "</turn>\n"
    tracemalloc.start()
    try:
        assert C.read_back(formatted) == [("user", "ab#" * 1_000_000)]
        assert tracemalloc.get_traced_memory()[1] < 60 * len(formatted)
    finally:
        tracemalloc.stop()


def test_query_has_probe_and_matches_sql(spark):
    got = queries.op2_chat_formatting(spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    want = con.execute(queries.ORACLE["op2_chat_formatting"])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(want.fetchall())
    probe = got.where("conv_id = -7").first()
    text = queries.PROBE_TEXT
    assert probe["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and probe["loss_chars"] == len(text)


@pytest.mark.parametrize("bad", ["### user: a<b</turn>\n", "user: x", "### user: x</turn>"])
def test_malformed_strings_raise(bad):
    with pytest.raises(ValueError, match="no turn"):
        C.read_back(bad)


def test_entry_registers_every_operator():
    entry = importlib.import_module("__spark_entry__")
    numbers = sorted(int(k[2:].split("_")[0]) for k in entry.queries() if k[:2] == "op" and k[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()

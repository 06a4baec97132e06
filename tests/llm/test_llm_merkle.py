"""The manifest against a plain tree."""

import hashlib
import zlib

from conftest import SF_SMALL

from tessera.llm import merkle_manifest as M
from tessera.llm import queries
from tessera.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return digest(*parts)


def tree(nodes):
    """Root and, for every node, its siblings and sides."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            other = place ^ 1
            paths[k].append((nodes[other] if other < len(nodes) else "", place % 2 == 1))
            at[k] = place // 2
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def plain(docs):
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append(d)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = {}
    for g in order:
        rows = sorted(groups[g], key=lambda d: (d[0] is not None, d[0] or 0, leaf(*d)))
        tops[g] = (rows, *tree([leaf(*d) for d in rows]))
    root, above = tree([tops[g][1] for g in order])
    out = []
    for g, up in zip(order, above, strict=True):
        rows, subroot, paths = tops[g]
        for d, path in zip(rows, paths, strict=True):
            doc_id, text, lang, source, n_chars = d
            changed = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            node = leaf(doc_id, text, lang, source, n_chars + 1) if changed else leaf(*d)
            for sibling, left in path + up:
                node = digest(sibling, node) if left else digest(node, sibling)
            proof = digest(*[s for s, _ in path + up])
            out.append((doc_id, leaf(*d), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def run(spark, tmp_dir, docs, monkeypatch=None):
    frame = docs if hasattr(docs, "columns") else spark.createDataFrame(docs, SCHEMA)
    frame.write.mode("overwrite").parquet(f"{tmp_dir}/documents.parquet")
    return sorted(map(tuple, queries.op13_merkle_manifest(spark, tmp_dir).select(*COLUMNS).collect()), key=str)


ODD = [
    (3, "three", "en", "a", 5), (1, None, "en", None, None), (None, "", None, "b", 0), (2, "zwei é", "de", "ä", 6),
    (9, "x" * 300_000, "", "c", 300_000), (4, "rep", "en", "a", 3), (4, "rep", "en", "a", 3), (4, "other", "en", "a", 5),
    (None, "", None, "b", 0), (20, "t", "é", "z", 1),
]


def test_odd_rows(spark, tmp_dir):
    assert run(spark, tmp_dir, ODD) == plain(ODD)


def test_blocks_of_many_passes(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(M, "LEVELS", 2)
    docs = [(i, f"t{i}", ("en", "de", None, f"l{i}")[0 if i < 300 else i % 4], "s", i) for i in range(403)]
    assert run(spark, tmp_dir, docs) == plain(docs)


def test_two_passes_and_a_hot_row(spark, tmp_dir):
    docs = [(i, f"t{i}", "en" if i % 5 else "fr", "s", i) for i in range(2100)] + [(7, "copy", "en", "s", 4)] * 900
    assert run(spark, tmp_dir, docs) == plain(docs)


def test_lone_and_empty(spark, tmp_dir):
    lone = [(1, "a", "en", "s", 1)]
    got = run(spark, tmp_dir, lone)
    assert got == plain(lone) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == digest("")
    assert M.merkle_manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_clashing_columns_and_own_leaves(spark):
    wide = spark.createDataFrame([(1, "a", "en", "s", 1, "x", 2), (2, "b", None, "s", 1, "y", 3)], SCHEMA + ", node string, rank int")
    got = M.verify(M.merkle_manifest(wide)).collect()
    assert all(r["verified"] for r in got) and {r["group"] for r in got} == {"en", None}


def test_query_on_the_given_table(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = sorted(map(tuple, queries.op13_merkle_manifest(spark, SF_SMALL).select(*COLUMNS).collect()), key=str)
    assert got == plain(docs)

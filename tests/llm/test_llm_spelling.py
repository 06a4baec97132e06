"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF_SMALL

from tessera.llm import queries
from tessera.llm import spelling_variants as S
from tessera.llm.common import table


def plain_words(docs):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if mark % 31 == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            if len(run) >= 7:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(words):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words.get(form[w], 0)) for w, n in words.items())


def got(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def vocabulary(seed, rows):
    draw = random.Random(seed)
    words = {}
    for _ in range(rows):
        base = "".join(draw.choice("abé") for _ in range(draw.randint(7, 9)))
        words[base] = draw.choice([2, 3, 30, 400, 5000])
    return words


@pytest.mark.parametrize("hot", [1_000, 3, 0])
def test_pairs_equal_all_pairs_on_both_sides_of_hot(spark, hot):
    words = vocabulary(7, 400)
    frame = S.stored(spark.createDataFrame(list(words.items()), "word string, n long"), "words")
    assert got(S.spelling_variants(frame, hot=hot)) == plain_variants(words)


def test_odd_documents(spark):
    docs = [
        (1, "Variante variante VARIANTE variänte ÉCLAIRS éclairs"), (2, None), (3, ""), (None, "variante varianten varianten"),
        (4, "variante " * 300 + "varianto varianto varianto"), (4, "variante " * 300 + "varianto varianto varianto"),
        (5, "x" * 1_500_000 + " " + "langwort " * 200_000), (6, "abcdef× abcdef× abcdefghāabcdefg abc_defghij"),
    ]
    words = plain_words(docs)
    assert got(S.group_variants(spark.createDataFrame(docs, "doc_id long, text string"))) == plain_variants(words)


def test_forms_are_followed_to_the_last(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20000, "zzzzzzz": 2}
    frame = S.stored(spark.createDataFrame(list(words.items()), "word string, n long"), "words")
    rows = {r["word"]: r for r in S.spelling_variants(frame).collect()}
    assert rows["aaaaaaa"]["form"] == "aaaaaab" and rows["aaaaaaa"]["root"] == "aaabbbb"
    assert rows["zzzzzzz"]["root"] == "zzzzzzz" and rows["zzzzzzz"]["n_near"] == 0


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, word string, n string, key long"
    assert S.group_variants(spark.createDataFrame([], schema)).collect() == []
    rows = S.group_variants(spark.createDataFrame([(1, "letters letters", "w", "n", 5)], schema)).collect()
    assert [(r["word"], r["n"]) for r in rows] == [("letters", 2)]


def test_query_counts_the_given_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect()]
    words = plain_words(docs)
    rows = got(queries.op12_spelling_variants(spark, SF_SMALL))
    assert {r[0]: r[3] for r in rows} == words
    some = dict(random.Random(3).sample(sorted(words.items()), min(300, len(words))))
    by_word = {r[0]: r for r in rows}
    for w in some:
        near = [v for v in words if abs(len(v) - len(w)) < 2 and v != w and one_edit(w, v)]
        assert by_word[w][4] == len(near)

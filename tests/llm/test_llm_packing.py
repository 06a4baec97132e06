"""Packed pieces against a plain encoder."""

import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import nnls_packing as P
from tessera.llm import queries


@pytest.fixture(scope="module")
def encoders():
    from tokenizers import Tokenizer

    own = P.TextEncoder(queries.tokenizer_path())
    assert own.ranked
    return own, Tokenizer.from_file(queries.tokenizer_path())


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


ODD = " \n\t\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u2028ab'srevmlldé1²½_.,-<|endoftext>\x00\xad€’–ßĳǆ😀中"


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(alphabet=ODD, max_size=40), st.text(max_size=30)))
def test_encoder_equals_tokenizers(encoders, text):
    own, plain = encoders
    assert ids_of(own.encode(text)) == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "a", "é ", "word"]), max_size=8))
def test_strings_of_added_tokens(encoders, parts):
    own, plain = encoders
    text = "".join(parts)
    assert ids_of(own.encode(text)) == plain.encode(text, add_special_tokens=False).ids


def test_end_of_text_inside_a_text(encoders):
    assert ids_of(encoders[0].encode("a <|endoftext|> b")) == [64, 220, 50256, 275]


def test_encoder_equals_tokenizers_on_every_document(encoders):
    import duckdb

    own, plain = encoders
    texts = [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    texts += ["a" * 30_000, "x " * 5_000, "é" * 3_000, "1" * 2_500, "\n" * 9_000, " " * 9_000]
    for text, want in zip(texts, plain.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert ids_of(own.encode(text)) == want.ids


def check_pieces(rows, docs, plain):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, text in docs:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        for n, r in enumerate(pieces):
            assert (r["piece"], r["start"]) == (n, at)
            assert r["length"] <= 1024 and (len(pieces) == 1 or n == 0 or r["length"] == 1024)
            raw = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(raw)
            at += r["length"]
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by_sequence)


def test_query_packs_every_token(spark, encoders):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = queries.op5_pattern_packing(spark, SF_SMALL).collect()
    used = check_pieces(rows, docs, encoders[1])
    assert used <= 1.05 * -(-sum(r["length"] for r in rows) // 1024) + 1


def test_defined_cases(spark, encoders):
    text = "word " * 5000
    docs = [(1, None), (2, ""), (3, text), (4, "a"), (5, "x y  z\n\n  q ")]
    table = spark.createDataFrame([(i, t, 1, "p") for i, t in docs], "doc_id long, text string, length int, part string")
    pieces = P.tokenize(table, queries.tokenizer_path())
    check_pieces(queries.packed_rows(pieces).collect(), docs, encoders[1])
    null_id = spark.createDataFrame([(None, "a b"), (2**60 + 1, "c")], "doc_id long, text string")
    got = queries.packed_rows(P.tokenize(null_id, queries.tokenizer_path())).collect()
    assert {r["doc_id"] for r in got} == {None, 2**60 + 1}
    assert queries.packed_rows(P.tokenize(table.limit(0), queries.tokenizer_path())).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 5000), max_size=12))
def test_plan_uses_the_histogram_exactly(counts):
    histogram = np.zeros(33, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    plan = P.plan_patterns(histogram, steps=100)
    used = np.zeros(33, np.int64)
    for pattern, times in plan:
        assert sum(pattern) <= 32 and times > 0
        for length in pattern:
            used[length] += times
    assert (used == histogram).all()
    placement = P.Placement(plan)
    seen = set()
    for length in np.flatnonzero(histogram):
        numbers = np.arange(histogram[length])
        sequence, offset = placement.find(np.full(len(numbers), length), numbers)
        pairs = set(zip(sequence.tolist(), offset.tolist(), strict=True))
        assert len(pairs) == len(numbers) and not pairs & seen
        seen |= pairs
    assert placement.sequences == sum(t for _, t in plan)


def test_fit_fills_sequences_of_a_mixed_histogram():
    rng = np.random.default_rng(0)
    lengths = np.clip(rng.gamma(2.0, 180.0, 200_000).astype(int), 1, 1024)
    histogram = np.bincount(lengths, minlength=1025)
    used = sum(t for _, t in P.plan_patterns(histogram))
    assert used <= 1.002 * -(-int(lengths.sum()) // 1024)


def test_repeated_rows_have_pieces_of_their_own(spark, encoders):
    docs = [(1, "same text here")] * 5 + [(2, None)] * 3 + [(3, "long " * 3_000)] * 2
    rows = queries.packed_rows(P.tokenize(spark.createDataFrame(docs, "doc_id long, text string"), queries.tokenizer_path()), with_ids=True).collect()
    assert sum(r["doc_id"] == 1 for r in rows) == 5 and sum(r["doc_id"] == 2 for r in rows) == 3
    places = [(r["sequence_id"], r["offset"]) for r in rows]
    assert len(set(places)) == len(places)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]

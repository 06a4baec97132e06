"""Cross-parsing against the letter-by-letter parse, and held-out texts."""

import random
import zlib

import numpy as np
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import language_id as L
from tessera.llm import queries

SAMPLES = {"a": "the cat sat on the mat and the rat ", "b": "der hund und die katze auf dem dach ", "c": "le chat est sur la table "}
PARSER = L.CrossParser(SAMPLES)


def plain_phrases(text, sample):
    """Longest substrings of the sample, one after the other."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="thecatsondr uxé", max_size=60), min_size=1, max_size=6))
def test_phrases_equal_plain_substrings(texts):
    got = PARSER.phrases(texts)
    for i, text in enumerate(texts):
        assert got[i].tolist() == [plain_phrases(text, SAMPLES[k]) for k in PARSER.languages]
        assert got[i].tolist() == [L.SuffixAutomaton(SAMPLES[k]).phrases(text) for k in PARSER.languages]


def test_long_texts_are_cut_into_stretches(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("the catsond") for _ in range(5_000))
    want = sum(plain_phrases(text[i : i + L.STRETCH], SAMPLES["a"]) for i in range(0, len(text), L.STRETCH))
    assert PARSER.phrases([text, "the"])[0, 0] == want
    monkeypatch.setattr(L, "SLAB", 2 * L.STRETCH)
    assert PARSER.phrases(["x", text, "the"])[1, 0] == want


def test_defined_cases(spark):
    rows = [(1, None, "en"), (1, "", "en"), (2, "12 -- 34", "fr"), (3, "der hund", None), (4, "日本", "de"), (None, "the cat", "de"), (6, "x" * 200_000, "")]
    docs = spark.createDataFrame([(i, t, x, 1) for i, t, x in rows], "doc_id long, text string, lang string, score int")
    out = {(r["doc_id"], r["lang_pred"]) for r in L.identify(docs).collect()}
    assert {(1, "und"), (2, "und")} <= out and len(out) >= 5
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in L.identify(docs.withColumn("lang", docs["lang"].substr(1, 0))).collect())
    assert L.identify(docs.limit(0)).count() == 0


def test_held_out_languages_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op10_language_id(spark, sf).collect()
    assert len(out) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in out)
    tested = [r["lang_pred"] == lang[r["doc_id"]] for r in out if r["held_out"] and lang[r["doc_id"]]]
    assert np.mean(tested) >= 0.95


def test_every_learned_letter_has_its_own_class():
    rng = random.Random(2)
    scripts = {k: [chr(0x4E00 + first + i) for i in range(300)] for k, first in (("p", 0), ("q", 150), ("r", 5_000))}
    samples = {k: "".join(rng.choice(v) for _ in range(3_000)) for k, v in scripts.items()} | {"a": SAMPLES["a"]}
    parser = L.CrossParser(samples)
    texts = ["".join(rng.choice(v) for _ in range(200)) for v in scripts.values()] + ["the cat 永 sat"]
    texts += [samples["q"][50:400], samples["r"][:90] + "xyz" + samples["p"][7:70]]
    got = parser.phrases(texts)
    assert got.tolist() == [[plain_phrases(t, samples[k]) for k in parser.languages] for t in texts]
    assert parser.predict([samples["q"][50:400], samples["r"][:90]])[0] == ["q", "r"]


def test_a_parser_opened_from_its_file_equals_the_built_one(tmp_path):
    samples = SAMPLES | {"日\0": "".join(chr(0x4E00 + 7 * i % 400) for i in range(900))}
    built, file = L.CrossParser(samples), tmp_path / "parser"
    file.write_bytes(built.pack())
    opened = L.CrossParser.opened(str(file))
    texts = ["the katze est sur", "", "\u4e07\u4e0e\u4e15 dach", "x" * 1_500]
    assert opened.languages == built.languages
    assert opened.phrases(texts).tolist() == built.phrases(texts).tolist()


def test_every_labelled_language_is_learned(spark):
    rng = random.Random(4)
    rows, names = [], [f"l{k:02}" for k in range(70)]
    for k, name in enumerate(names):
        words = ["".join(chr(0x61 + rng.randrange(26)) for _ in range(6)) for _ in range(8)]
        rows += [(100 * k + i, " ".join(rng.choice(words) for _ in range(25)), name) for i in range(12 if k else 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(L.learning_samples(docs)) == set(names)
    out = {r["doc_id"]: r["lang_pred"] for r in L.identify(docs).collect()}
    assert all(out[i] == name for i, _, name in rows)


def test_samples_are_the_same_without_a_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    broadcast = L.learning_samples(docs)
    monkeypatch.setattr(L, "BROADCAST_LANGUAGES", 0)
    assert len(broadcast) > 1 and L.learning_samples(docs) == broadcast


def test_samples_reach_the_whole_text_and_take_copies_once(spark):
    rng = random.Random(6)
    header, body = "licence " * 200, lambda: " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(3_000))
    rows = [(i, header + body() + " end" * 400, "x") for i in range(60)]
    rows += [(1_000 + i, header + "copied " * 2_000, "x") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = L.learning_samples(docs)["x"]
    assert len(sample) <= L.SAMPLE_CHARS and "beta" in sample and " end" in sample
    assert sample.count("copied") < 300 and sample.count("licence") < 700
    assert [len(t) for t in L._even(["a" * 10, "b" * 900, "c" * 900], 403)] == [10, 195, 195]

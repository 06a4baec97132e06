"""Lexicon, automaton and scores."""

import random
import zlib

import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import queries
from tessera.llm import toxicity as X


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


WORD = st.text(alphabet="abcé", min_size=0, max_size=8)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text(alphabet="abcé", min_size=1, max_size=8), max_size=12), WORD)
def test_automaton_finds_all_terms_within_one_edit(terms, word):
    assert X.Trie(dict.fromkeys(terms, 1.0)).near(word) == sorted(t for t in terms if edits(t, word) <= 1)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="ab", min_size=5, max_size=9), min_size=1, max_size=8), st.text(alphabet="ab", min_size=4, max_size=10))
def test_prefilter_loses_no_misspelling(terms, word):
    lexicon = X.Lexicon(dict.fromkeys(terms, 1.0), {})
    assert bool(lexicon.fuzzy(word)) == any(edits(t, word) <= 1 for t in terms)


def corpus(seed, rows=400):
    rng = random.Random(seed)
    plain = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("lan", "mir", "nos", "pet")]
    bad = ["stupid", "worthless", "grumblord"]
    out = []
    for i in range(rows):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) if rng.random() < 0.7 else "zorka" + rng.choice(plain))
        out.append((i, " ".join(words), int(toxic)))
    return out


@pytest.fixture(scope="module")
def model(spark):
    rows = corpus(1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return X.fit_toxicity(docs, labels)


def test_learns_words_and_stems_only_from_labels(model):
    assert set(model.lexicon.words) == {"stupid", "worthless", "grumblord"}
    assert set(model.lexicon.stems) == {"zorka"}


def test_scores_of_unseen_texts(model):
    toxic = ["falan mir Stupid", "balan worthles dunos", "balan worth1ess", "zorkaxyz dilan", "BALAN STUPYD GRUMBLORD"]
    clean = [None, "", "balan dunos", "12 34 ??", "balan " * 50_000]
    assert all(s >= 0.3 for s in model.scores(toxic))
    assert all(s < 0.3 for s in model.scores(clean))
    said, used = model.lexicon.evidence('he said "stupid" once'), model.lexicon.evidence("he is a stupid one")
    assert 0 < said[0] < used[0]


def test_ordinary_neighbours_of_terms_are_spared(spark):
    rows = corpus(2)
    rows = [(i, t + (" stupor" if not x and i % 3 == 0 else ""), x) for i, t, x in rows]
    rows += [(1000 + i, "stupod dunos" if i % 2 else "stupad balan", 0) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    fitted = X.fit_toxicity(docs, labels)
    assert {"stupod", "stupad"} <= fitted.lexicon.exonerated
    assert fitted.scores(["stupod dunos"])[0] < 0.3 <= fitted.scores(["stuxpid dunos"])[0]


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "a", 5), (None, "b", 5), (3, "", 5)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(1, None), (None, 1), (3, 0)], "doc_id long, toxic int")):
        out = X.score_documents(docs, labels).collect()
        assert len(out) == 4 and all(r["score"] < 0.01 and r["predicted"] == 0 for r in out)
    assert X.score_documents(docs.limit(0), none).count() == 0
    kept = X.without_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == 4


def test_held_out_texts_of_the_query(spark):
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    out = queries.op9_toxicity(spark, "/root/testdata/sf0.01").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in out)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in out)
    tested = [(marks[r["doc_id"]], r["predicted"]) for r in out if r["held_out"] and r["doc_id"] in marks]
    # toxic texts in other languages than English have no marks of their own in so small a table
    assert sum(a == b for a, b in tested) / len(tested) >= 0.9
    assert all(a == b for a, b in tested if not a or b)
    assert queries.op9_toxicity(spark, SF_SMALL).count() == 200


def with_family(seed, rows=800):
    """A toxic family of many rare words, a fifth of whose uses are clean; one of its words is always clean."""
    rng = random.Random(seed)
    out = []
    for i, text, toxic in corpus(seed, rows):
        words = text.split()
        member = "bomente" + "".join(rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(2))
        if toxic and i % 16 == 0:
            words = [w for w in words if w not in ("stupid", "worthless", "grumblord") and not w.startswith("zorka")]
            words.insert(rng.randrange(len(words)), member)
        elif i % 57 == 1:
            words.append(member)
        elif i % 5 == 1:
            words.append("bomenteca")
        out.append((i, " ".join(words), toxic))
    return out


def test_families_with_some_clean_use_are_found(spark):
    rows = with_family(3)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    fitted = X.fit_toxicity(docs, labels)
    held = [(t, "bomente" in t and "bomenteca" not in t, x) for i, t, x in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    family = [t for t, has, x in held if x and has]
    assert len(family) >= 5 and (fitted.scores(family) >= 0.3).all()
    # the stem's own log-odds: less than a term of toxic texts alone
    assert 0 < fitted.lexicon.weight("bomentexyz")[0] < fitted.lexicon.weight("stupid")[0]
    clean = [t for t, _, x in held if not x and "bomenteca" in t]
    assert clean and (fitted.scores(clean) < 0.3).all()


def test_terms_that_begin_alike_share_their_counts():
    def row(word, toxic, other):
        return {"word": word, "toxic": toxic, "other": other, "texts": [toxic, other, 0, 0], "witnesses": toxic, "certainty": X._ratio(toxic, other, 0.1)}

    stems = [row("inte", 300, 500), row("intebad", 150, 2), row("bome", 104, 25), row("bomente", 104, 25)]
    words = [row("bomentela", 30, 8), row("intes", 140, 20), row("vile", 9, 0)]
    families, alone, members = X._families(stems, words, 0.1, 24.0)
    # the rest of inte* is 10 toxic of 488: no stem
    assert {s: x[0] for s, x in families.items()} == {"intebad": (150, 2), "bomente": (104, 25)}
    assert {w: x[0] for w, x in alone.items()} == {"intes": (140, 20), "vile": (9, 0)} and members == {"bomentela": "bomente"}
    lexicon = X.Lexicon({"vile": 1.0}, {"bomente": 2.0}, members=members, lone={"bomente": 0.5})
    assert lexicon.evidence("bomentexa")[0] == 0.5 and lexicon.evidence("bomentexa bomentela")[0] == 4
    assert lexicon.weight("bomentexa") == (2.0, False) and lexicon.weight("bomemtela") == (2.0, True)


def test_every_passing_term_and_every_spared_word_is_kept(spark):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    codes = [i * 7919 % 26**4 for i in range(2_010)]
    terms = ["".join(letters[c // 26**k % 26] for k in range(4)) + "qv" for c in codes]
    beside = [chr(0x430 + k) + term[1:] for term in terms for k in range(25)]
    rows = [(" ".join(rng.sample(terms, len(terms))), 1) for _ in range(15)]
    rows += [(" ".join(beside[i::45]), 0) for i in range(45)]
    lexicon = X.fit_lexicon(spark.createDataFrame(rows, "text string, toxic int"), 15, 45)
    assert set(lexicon.words) == set(terms) and len(terms) > 2_000
    assert lexicon.exonerated == set(beside) and len(lexicon.exonerated) > 50_000


def test_filter_holds_for_every_id(spark):
    ids = spark.range(0, 40_000, 7)
    may_be = X.id_filter(ids)
    passed = {r["id"] for r in spark.range(40_000).where(may_be(X.F.col("id"))).collect()}
    own = set(range(0, 40_000, 7))
    assert own <= passed and len(passed - own) < 0.01 * 40_000
    nothing = X.id_filter(spark.range(0))
    assert spark.range(100).where(nothing(X.F.col("id"))).count() == 0


def test_labels_of_one_id_and_unlabelled_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(None, "none"), (3, "again")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, None), (3, 0), (5, None), (7, 1), (None, 1), (900, 1)], "doc_id long, toxic int")
    marks = X.stored(X.label_marks(labels), "test")
    got = sorted((r["id"], r["text"], r["toxic"]) for r in X.labelled(docs, marks, X.id_filter(marks)).collect())
    free = lambda i: zlib.crc32(str(i).encode()) % 4 != 2
    assert got == sorted((i, t, x) for i, t, x in [(1, "text 1", 1), (3, "text 3", 0), (3, "again", 0), (7, "text 7", 1)] if free(i))

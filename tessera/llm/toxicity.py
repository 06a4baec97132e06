"""Toxicity by a learned lexicon, misspellings and context.

Learning (from labelled rows only):

1. For every word and every word stem of the labelled texts, the cluster counts
   in how many toxic and other texts it occurs. Terms that occur with toxic texts
   far more often than chance allows make the lexicon, whole words or stems
   (``stem*``), by the same test and each with its own log-odds: for a
   stem of the texts that have its words, or of those with one of them. Words that
   certainly differ from their stem keep their own, or are no hits. A term's witnesses are its toxic texts, but no more than the
   different words before it, so copies of one toxic text make no lexicon of
   their own. Every term that passes is kept.
2. The terms form a trie. A Levenshtein automaton for one edit is run against
   it for words of five letters and more, so misspelled terms are caught too.
   Words near a term that other texts use as a matter of course
   are counted as well and are no misspellings.
3. A logistic curve over a text's evidence is fitted to about ``max_rows``
   labelled texts (never more than twice as many), taken by a hash of their id.

Scoring: every hit brings its term's log-odds. Hits between quotation marks or
after a reporting word within the context window count for ``QUOTED`` of it, hits
with other hits in their window count in full, and misspellings for
``MISSPELLED``. The score is the curve's value for what the text brings together.

Defined results: a null text is scored like an empty one; a text without hits
gets the score of no evidence; labels that are null or absent teach nothing,
several labels of one id count as toxic if one of them is; without both kinds
of labels there is no lexicon and every score is the share of toxic
labels (0 if there are none). Extra columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import hash_share, map_batches, pandas_udf, stored

#: Labelled rows the curve is fitted to.
MAX_ROWS = 20_000
STEMS = (4, 5, 6, 7)
LEAST_FUZZY = 5
MISSPELLED = 0.6
QUOTED = 0.35
WINDOW = 60
THRESHOLD = 0.3
#: Bits of the filter that keeps documents without a label out of the shuffle.
FILTER_BITS = 1 << 25
#: Words whose weight a worker remembers.
REMEMBERED = 800_000
#: Counted words a task holds before it hands them on.
COUNT_SLAB = 400_000

_WORDS = re.compile(r"[^\W_]+")
_LOOKALIKES = str.maketrans("013457@$", "oieastas")
# Words that report speech rather than use it.
_REPORTING = frozenset(
    "said says wrote writes quote quoted quotes called word words term slur "
    "sagte schrieb zitat wort dit écrit mot citation dijo escribió palabra cita".split()
)
_OPENING, _CLOSING = "\"“„«‘'(", "\"”“»’')"


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


class Trie:
    """Lexicon trie; ``near`` intersects it with a Levenshtein automaton."""

    def __init__(self, terms: dict[str, float]):
        self.root: dict = {}
        for term in terms:
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term

    def near(self, word: str) -> list[str]:
        """Terms one edit away from the word or equal to it.

        The automaton's state after reading a trie path is two bit sets: the
        prefixes of the word that match it without and with one edit."""
        size = len(word)
        masks: dict[str, int] = {}
        for i, letter in enumerate(word):
            masks[letter] = masks.get(letter, 0) | 1 << i
        accept, out = 1 << size, []
        # bit i: the path equals word[:i]; with one edit: also one letter skipped
        stack = [(self.root, 1, 0b11)]
        while stack:
            node, exact, edited = stack.pop()
            for letter, child in node.items():
                if letter == "":
                    if edited & accept:
                        out.append(child)
                    continue
                mask = masks.get(letter, 0)
                new = (exact & mask) << 1
                # match, replace a letter, drop the path's letter, skip a letter of the word
                near = (edited & mask) << 1 | exact << 1 | exact | new << 1
                near &= (accept << 1) - 1
                if near:
                    stack.append((child, new, near | new))
        return sorted(out)


class Lexicon:
    """Words, stems and what words near them mean."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], exonerated: frozenset[str] = frozenset(), members: dict[str, str] | None = None, lone: dict[str, float] | None = None):
        """``members``: words of the stems (word -> stem) that may be misspelled too;
        ``lone``: weight of a stem where one word of it is all that the text has."""
        self.words, self.stems, self.exonerated, self.members = words, stems, exonerated, members or {}
        self.lone = lone or {}
        self.targets = {w: stems[s] for w, s in self.members.items()} | words
        long_words = {w: x for w, x in self.targets.items() if len(w) >= LEAST_FUZZY}
        self.trie = Trie(long_words)
        # by length of the term: one edit leaves its first or its last half as it is
        self.heads: dict[int, set[str]] = {}
        self.tails: dict[int, set[str]] = {}
        for w in long_words:
            self.heads.setdefault(len(w), set()).add(w[: len(w) // 2])
            self.tails.setdefault(len(w), set()).add(w[len(w) // 2 :])
        self.beginnings = {s[: STEMS[0]] for s in stems}
        self.known: dict[str, tuple[float, bool] | None] = {}

    @property
    def parts(self) -> tuple:
        """What another process needs to make the same lexicon."""
        return self.words, self.stems, self.exonerated, self.members, self.lone

    def stem(self, word: str) -> str | None:
        """The longest stem of the lexicon that the word begins with."""
        if word[: STEMS[0]] in self.beginnings:
            for size in reversed(STEMS):
                if word[:size] in self.stems:
                    return word[:size]
        return None

    def fuzzy(self, word: str) -> list[str]:
        """Terms within one edit of a word that is itself no term."""
        for size in range(len(word) - 1, len(word) + 2):
            heads = self.heads.get(size)
            if heads and (word[: size // 2] in heads or word[size // 2 - size :] in self.tails[size]):
                return self.trie.near(word)
        return []

    def weight(self, word: str) -> tuple[float, bool] | None:
        """(log-odds, misspelled) of a word, None if it is no hit."""
        if word in self.known:
            return self.known[word]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found = self._weight(word)
        if found is None and not word.isalpha():
            plain = word.translate(_LOOKALIKES)
            if plain.isalpha() and any(c.isalpha() for c in word):
                again = self._weight(plain)
                found = again and (again[0], True)
        self.known[word] = found
        return found

    def _weight(self, word: str) -> tuple[float, bool] | None:
        if word in self.words:
            return self.words[word], False
        if word in self.exonerated:
            return None
        if (stem := self.stem(word)) is not None:
            return self.stems[stem], False
        near = self.fuzzy(word)
        return (max(self.targets[t] for t in near), True) if near else None

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """Summed weight, largest weight, and summed weight for a hundred words."""
        words, known, any_hit = words_of(text), self.known, False
        for word in set(words):
            if (known[word] if word in known else self.weight(word)) is not None:
                any_hit = True
        if not any_hit:
            return 0.0, 0.0, 0.0
        low, hits = text.lower(), []
        families = Counter(self.stem(w) for w in set(words) if w not in self.words and w not in self.exonerated)
        alone = {s: self.lone[s] for s, n in families.items() if n == 1 and s in self.lone}
        for match in _WORDS.finditer(low):
            found = self.weight(match[0])
            if found:
                weight = found[0] * (MISSPELLED if found[1] else 1.0)
                if alone and match[0] not in self.words and (stem := self.stem(match[0])) in alone:
                    weight = alone[stem]
                hits.append((match.start(), match.end(), weight))
        total = largest = 0.0
        for i, (start, end, weight) in enumerate(hits):
            crowd = (i and start - hits[i - 1][1] < WINDOW) or (i + 1 < len(hits) and hits[i + 1][0] - end < WINDOW)
            if not crowd and _is_quoted(low, start, end):
                weight *= QUOTED
            total += weight
            largest = max(largest, weight)
        return total, largest, 100 * total / len(words)


def _is_quoted(text: str, start: int, end: int) -> bool:
    """Whether the context window shows that the word is mentioned, not used."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    if before.rstrip()[-1:] in _OPENING and before and after.lstrip()[:1] in _CLOSING and after:
        return True
    return any(w in _REPORTING for w in _WORDS.findall(before)[-3:])


# --- learning ----------------------------------------------------------------


def label_marks(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """``id``, ``toxic`` (0 or 1), one row for each id that may teach."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    return rows.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))


def _id_hash(doc_id: Column) -> Column:
    return F.xxhash64(doc_id.cast("string"))


def id_filter(ids: DataFrame) -> Callable[[Column], Column]:
    """A test of ids that holds for all of ``ids`` and for few others: a Bloom filter of
    ``FILTER_BITS`` bits and two hashes. The bits are made by an aggregate, so the driver gets no more than them."""
    mark, h = F.lit(FILTER_BITS - 1).cast("long"), _id_hash(F.col("id"))
    spots = ids.select(F.explode(F.array(h.bitwiseAND(mark), F.shiftrightunsigned(h, 32).bitwiseAND(mark))).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    words = spots.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)

    def may_be(hashes: pd.Series) -> pd.Series:
        h = hashes.to_numpy(np.int64).view(np.uint64)
        held = np.ones(len(h), bool)
        for at in (h & np.uint64(FILTER_BITS - 1), (h >> np.uint64(32)) & np.uint64(FILTER_BITS - 1)):
            held &= (table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return pd.Series(held)

    return lambda doc_id: pandas_udf(may_be, "boolean")(_id_hash(doc_id))


def labelled(docs: DataFrame, marks: DataFrame, may_be: Callable[[Column], Column], id_col: str = "doc_id", text_col: str | None = "text") -> DataFrame:
    """``id``, ``toxic`` and (with ``text_col``) ``text`` of the documents that have a mark. Only those
    that pass the filter are shuffled."""
    text = [F.col(text_col).cast("string").alias("text")] if text_col else []
    rows = docs.select(F.col(id_col).alias("id"), *text).where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    # always a merge join: a broadcast of the labels would only do while they are few
    return rows.where(may_be(F.col("id"))).join(marks.hint("shuffle_merge"), "id")


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: CRC-32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_counts(rows: DataFrame) -> DataFrame:
    """``word``, ``kind``, ``toxic``, ``other``: texts of either kind that have the
    word (kind 0), or one word (1) or several words (2) of the stem, and ``contexts``:
    a set of 64 bits, one for each (hashed) word that stood before a word in toxic texts."""

    def count(frames):
        counts, contexts = (Counter(), Counter()), {}
        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                words = words_of(text)
                distinct = set(words)
                counts[toxic].update((w, 0) for w in distinct)
                families = Counter(w[:n] for w in distinct for n in STEMS if len(w) >= n)
                counts[toxic].update((stem, min(n, 2)) for stem, n in families.items())
                if toxic:
                    for before, word in set(zip(["", *words], words, strict=False)):
                        contexts[word] = contexts.get(word, 0) | 1 << zlib.crc32(before.encode()) % 64
                if len(counts[0]) + len(counts[1]) > COUNT_SLAB:
                    yield rows_of(counts, contexts)
                    counts, contexts = (Counter(), Counter()), {}
        yield rows_of(counts, contexts)

    def rows_of(counts, contexts):
        keys = list(counts[0].keys() | counts[1].keys())
        bits = np.array([0 if kind else contexts.get(w, 0) for w, kind in keys], np.uint64).view(np.int64)
        words, kinds = [w for w, _ in keys], np.array([k for _, k in keys], np.int32)
        return pd.DataFrame({"word": words, "kind": kinds, "toxic": [counts[1][k] for k in keys], "other": [counts[0][k] for k in keys], "contexts": bits})

    partial = map_batches(rows.select("text", "toxic"), count, "word string, kind int, toxic long, other long, contexts long")
    return partial.groupBy("word", "kind").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.bit_or("contexts").alias("contexts"))


def _independent(toxic: Column, contexts: Column) -> Column:
    """Toxic texts that have a term, but no more than the different words before
    it let expect (linear counting): copies of one text are one witness."""
    seen = F.bit_count(contexts)
    return F.when(seen >= 64, toxic).otherwise(F.least(toxic, -64 * F.log(1 - seen / 64)))


def _certainty(toxic: Column, other: Column, toxic_rows: int, other_rows: int) -> Column:
    """Log-likelihood ratio of the counts against the share of toxic rows."""
    share = toxic_rows / (toxic_rows + other_rows)
    seen = toxic + other
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    return 2 * (part(toxic, seen * share) + part(other, seen * (1 - share)))


def fit_lexicon(rows: DataFrame, toxic_rows: int, other_rows: int) -> Lexicon:
    """Lexicon of rows ``text``, ``toxic``, of which so many are toxic and not; they are read once."""
    if not toxic_rows or not other_rows:
        return Lexicon({}, {})
    terms = stored(word_counts(rows), "toxicity_words")
    words = terms.where("kind = 0").drop("kind")
    total = words.count()
    certain = 2 * math.log(max(total, 2)) + 1
    share = toxic_rows / (toxic_rows + other_rows)

    def passing(counts: DataFrame) -> list:
        """The terms that pass the test; each is a row of counts and witnesses."""
        witnesses = _independent(F.col("toxic").cast("double"), F.col("contexts"))
        marked = counts.withColumn("witnesses", witnesses).withColumn("certainty", _certainty(F.col("witnesses"), F.col("other"), toxic_rows, other_rows))
        marked = marked.where((F.col("certainty") >= certain) & (F.col("toxic") > 2 * share * (F.col("toxic") + F.col("other"))))
        return marked.select("word", "toxic", "other", "texts", "witnesses", "certainty").collect()

    def weight(toxic: float, other: float) -> float:
        return math.log((toxic + 0.5) / (toxic_rows + 1)) - math.log((other + 0.5) / (other_rows + 1))

    sizes = F.filter(F.array(*[F.lit(n) for n in STEMS]), lambda n: n <= F.length("word"))
    forms = words.select(F.explode(F.transform(sizes, lambda n: F.substring(F.col("word"), F.lit(1), n))).alias("word"), "toxic", "other", "contexts")
    # a stem is one if several words have it; the test counts each of them in each text
    several = forms.groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.bit_or("contexts").alias("contexts"), F.count(F.lit(1)).alias("forms")
    ).where(F.col("forms") >= 2)
    one = lambda n: F.coalesce(F.sum(F.when(F.col("kind") == 1, F.col(n))), F.lit(0))
    texts = terms.where("kind > 0").groupBy("word").agg(F.array(F.sum("toxic"), F.sum("other"), one("toxic"), one("other")).alias("texts"))
    alike = words.withColumn("texts", F.array("toxic", "other", "toxic", "other"))
    families, alone, members = _families(passing(several.join(texts.hint("shuffle_merge"), "word")), passing(alike), share, certain)
    stems = {s: weight(*texts[:2]) for s, (_, texts) in families.items()}
    lone = {s: max(weight(*texts[2:]), 0.0) for s, (_, texts) in families.items()}
    lexicon = Lexicon({w: weight(*texts[:2]) for w, (_, texts) in alone.items()}, stems, members=members, lone=lone)
    shares = {s: (toxic + 0.5) / (toxic + other + 1) for s, ((toxic, other), _) in families.items()}

    def ordinary(frames):
        for frame in frames:
            keep = []
            for word, toxic, other in zip(frame["word"], frame["toxic"], frame["other"], strict=True):
                if word in lexicon.words:
                    keep.append(False)
                elif (stem := lexicon.stem(word)) is not None:
                    keep.append(toxic < shares[stem] * (toxic + other) and _ratio(toxic, other, shares[stem]) >= certain)
                else:
                    keep.append(toxic < 3 * other and bool(lexicon.fuzzy(word)))
            yield frame[keep]

    spared = map_batches(words.where(F.col("other") > 0), ordinary, words.schema).select("word").collect()
    return Lexicon(lexicon.words, stems, frozenset(r["word"] for r in spared), members, lone)


def _ratio(toxic: float, other: float, share: float) -> float:
    """Log-likelihood ratio of the counts against a share of toxic texts."""
    seen = toxic + other
    return 2 * sum(n * math.log(n / (seen * p)) for n, p in ((toxic, share), (other, 1 - share)) if n > 0)


def _families(stems: list, words: list, share: float, certain: float) -> tuple[dict, dict, dict]:
    """Stems and words that explain the counts, with (toxic, other) counts of words and
    counts of texts (with any word of theirs, with one), and the words of these stems that are certain themselves, with their stem.

    Terms that begin alike compete: the most certain one (the longest, if alike) is
    taken, the texts that have it are taken off the shorter ones around it, and those go on
    with the rest if that still passes. A word that certainly differs from its
    stem keeps its own counts."""
    families: dict[str, tuple] = {}
    alone: dict[str, tuple] = {}
    members: dict[str, str] = {}
    groups: dict[str, list] = {}
    for is_stem, rows in ((True, stems), (False, words)):
        for r in rows:
            counts, texts = (r["toxic"], r["other"]), r["texts"]
            groups.setdefault(r["word"][: STEMS[0]], []).append((r["certainty"], is_stem, r["word"], counts, texts, r["witnesses"]))
    for nodes in groups.values():
        while nodes:
            best = max(nodes, key=lambda n: (n[0], n[1], len(n[2]), n[2]))
            _, best_is_stem, name, (toxic, other), taken, _ = best
            (families if best_is_stem else alone)[name] = (toxic, other), taken
            inside = (toxic + 0.5) / (toxic + other + 1)
            rest = []
            for node in nodes:
                _, is_stem, word, counts, texts, witnesses = node
                if node is best:
                    continue
                if best_is_stem and word.startswith(name):
                    if not is_stem and _ratio(*counts, inside) >= certain:
                        alone[word] = counts, texts
                    elif not is_stem:
                        members[word] = name
                    continue
                if is_stem and name.startswith(word):
                    left = counts[0] - toxic, counts[1] - other
                    witnesses *= left[0] / counts[0]
                    certainty = _ratio(witnesses, left[1], share)
                    if certainty < certain or left[0] <= 2 * share * sum(left):
                        continue
                    # texts that have both are the taken term's
                    texts = [max(a - b, 0) for a, b in zip(texts, taken, strict=True)]
                    node = certainty, True, word, left, texts, witnesses
                rest.append(node)
            nodes = rest
    return families, alone, members


def _features(evidence: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(evidence)), np.log1p(np.maximum(evidence, 0))])


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; hits never speak against toxicity."""
    x = _features(evidence)
    w = np.zeros(x.shape[1])
    share = np.clip(toxic.mean(), 1e-3, 1 - 1e-3) if len(toxic) else 0.5
    w[0] = math.log(share / (1 - share))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) / len(x) + ridge * np.append(0, w[1:])
        curvature = (x * (p * (1 - p))[:, None]).T @ x / len(x) + np.diag(np.append(1e-6, np.full(len(w) - 1, ridge)))
        w = w - np.linalg.solve(curvature, gradient)
    w[1:] = np.maximum(w[1:], 0)
    return w


class ToxicityModel:
    def __init__(self, lexicon: Lexicon, curve: np.ndarray):
        self.lexicon, self.curve = lexicon, curve

    def scores(self, texts) -> np.ndarray:
        evidence = np.array([self.lexicon.evidence(t) for t in texts], float).reshape(-1, 3)
        return 1 / (1 + np.exp(-np.clip(_features(evidence) @ self.curve, -30, 30)))

    def column(self, text: Column) -> Column:
        """Score of a text column; the model goes out with the tasks."""
        parts, curve, made = self.lexicon.parts, self.curve, []

        def score(texts: pd.Series) -> pd.Series:
            if not made:
                made.append(ToxicityModel(Lexicon(*parts), curve))
            return pd.Series(made[0].scores(texts), dtype="float64")

        return pandas_udf(score, "double")(text.cast("string"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> ToxicityModel:
    """Fit to the labelled rows that are not held out: counts over all of them, the
    curve over about ``max_rows``."""
    marks = stored(label_marks(labels), "toxicity_labels")
    may_be = id_filter(marks)
    sums = labelled(docs, marks, may_be, text_col=None).agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    lexicon = fit_lexicon(labelled(docs, marks, may_be), int(sums[0]), int(sums[1] - sums[0]))
    parts = lexicon.parts
    made: list[Lexicon] = []

    def evidence(texts: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(Lexicon(*parts))
        return pd.DataFrame([made[0].evidence(t) for t in texts], columns=["total", "largest", "dense"])

    found_in = pandas_udf(evidence, "total double, largest double, dense double")
    # by hash, so no task gathers more than the few numbers of the rows chosen
    few = hash_share("id") < max_rows / max(int(sums[1]), 1)
    chosen = labelled(docs.where(hash_share("doc_id") < max_rows / max(int(sums[1]), 1)), marks.where(few), may_be)
    sample = chosen.select("toxic", found_in("text").alias("e")).select("toxic", "e.*").limit(2 * max_rows)
    found = np.array([(r["toxic"], r["total"], r["largest"], r["dense"]) for r in sample.collect()], float).reshape(-1, 4)
    if not len(found) or not found[:, 0].any():
        return ToxicityModel(lexicon, np.array([-30.0, 0, 0, 0]))
    if found[:, 0].all():
        return ToxicityModel(lexicon, np.array([30.0, 0, 0, 0]))
    return ToxicityModel(lexicon, fit_curve(found[:, 1:], found[:, 0]))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row of ``docs``."""
    model = fit_toxicity(docs, labels)
    scored = docs.select(F.col(id_col).alias("doc_id"), model.column(F.col(text_col)).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns kept."""
    model = fit_toxicity(docs, labels)
    scored = docs.select(F.struct("*").alias("doc"), model.column(F.col(text_col)).alias("score"))
    return scored.where(F.col("score") < threshold).select("doc.*")

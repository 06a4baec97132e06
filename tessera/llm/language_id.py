"""Language by cross-parsing entropy.

For each language the automaton of all substrings (suffix automaton) of labelled
text is built. A text is cross-parsed against it: the longest match from the
current place is one phrase, the next phrase begins behind it. The fewer
phrases a text needs, for its length, the more it is like the language; the
language that needs fewest wins.

The parse runs for many stretches of text at once: the automata are laid out as one
transition table, dense for the ``ALPHABET`` most frequent letters and sorted keys for all other
learned ones, in which a missing transition starts a new phrase, and every step moves all stretches and all languages by a letter.
Texts are cut into stretches of ``STRETCH`` letters, so a very long text is spread
over many of them; a cut ends a phrase.

Learning uses at most ``SAMPLE_CHARS`` letters for each labelled language, from texts
taken by a hash of the text, copies once: one piece of up to ``CHARS_OF_ROW`` characters
from each of up to ``SAMPLE_ROWS`` texts, at a place given by the hash, and as
even a share of the letters from each as their lengths allow. Tasks build the automata and write their
transitions, one file for each ``LANGUAGES_OF_FILE`` languages; Spark hands the files to the executors, whose
workers only lay out the table. A batch is parsed against one file after the other, and the fewest phrases of
all win, at any number of languages.

Defined results: ``und`` with score 0 if the text is null or has no letter, or if
nothing was learned; ties go to the first language in alphabetical order; rows
with a null or empty language teach nothing. Extra columns are not read.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import hash_share, map_arrays, pack_arrays, pandas_udf, share_files, ship_package

#: Bounds of the fitted model.
SAMPLE_CHARS = 24_000
SAMPLE_ROWS = 60
CHARS_OF_ROW = 1_500
#: Languages whose automata share a file (about 1 MB each) and a table (12 MB each).
LANGUAGES_OF_FILE = 8
#: Languages whose shares (some 50 bytes each) are broadcast; a join deals more.
BROADCAST_LANGUAGES = 20_000
#: Columns of the dense table: the most frequent letters; all others are sparse.
ALPHABET = 64
STRETCH = 512
#: Letters parsed at a time (a multiple of STRETCH).
SLAB = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def normalised(text: str) -> str:
    """Lower-cased letters; anything between them is one blank."""
    return _OTHER.sub(" ", text.lower())


class SuffixAutomaton:
    """All substrings of a text: ``next[state][letter]``, from state 0."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for letter in text:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            state = last
            while state >= 0 and letter not in self.next[state]:
                self.next[state][letter] = new
                state = link[state]
            if state >= 0:
                target = self.next[state][letter]
                if length[target] == length[state] + 1:
                    link[new] = target
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[target]))
                    length.append(length[state] + 1)
                    link.append(link[target])
                    link[target] = link[new] = copy
                    while state >= 0 and self.next[state].get(letter) == target:
                        self.next[state][letter] = copy
                        state = link[state]
            last = new

    def phrases(self, text: str) -> int:
        """Phrases of the cross-parse, letter by letter (for tests)."""
        count, state = 0, 0
        for letter in text:
            step = self.next[state].get(letter)
            if step is None or state == 0:
                count += 1
                step = self.next[0].get(letter, 0)
            state = step
        return count


class CrossParser:
    """Automata of some languages in one transition table."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        counts = Counter(c for text in samples.values() for c in text)
        # class 0: letters that were not learned; every learned one has its own
        letters = sorted(counts, key=lambda c: (-counts[c], c))
        classes = {c: i + 1 for i, c in enumerate(letters)}
        size, states, sizes, roots = len(letters) + 1, 0, [], []
        first = np.zeros((len(self.languages), size), np.int32)
        # target states of the dense table (by place) and of other letters (by state and letter)
        dense: dict[int, int] = {}
        sparse: dict[int, int] = {}
        for k, language in enumerate(self.languages):
            automaton = SuffixAutomaton(samples[language])
            first[k] = states
            for c, target in automaton.next[0].items():
                first[k, classes[c]] = target + states
            for state, steps in enumerate(automaton.next[1:], states + 1):
                for c, target in steps.items():
                    letter = classes[c]
                    if letter < ALPHABET:
                        dense[state * ALPHABET + letter] = target + states
                    else:
                        sparse[state * size + letter] = target + states
            roots.append(states)
            sizes.append(len(automaton.next))
            states += len(automaton.next)
        keys = np.array(sorted(sparse), np.int64)
        self._lay_out(
            {
                "letters": np.array([ord(c) for c in letters], np.uint32),
                "first": first,
                "roots": np.array(roots, np.int32),
                "sizes": np.array(sizes, np.int64),
                "dense_at": np.fromiter(dense.keys(), np.int64, len(dense)),
                "dense_to": np.fromiter(dense.values(), np.int32, len(dense)),
                "sparse_at": keys,
                "sparse_to": np.array([sparse[x] for x in keys.tolist()], np.int32),
            }
        )

    def _lay_out(self, arrays: dict[str, np.ndarray]) -> None:
        """The table of all transitions; values are 2 x target state, plus 1 where a new phrase begins."""
        self.arrays = arrays
        self.first, self.roots = arrays["first"], arrays["roots"]
        self.size = self.first.shape[1]
        self.class_of = np.zeros(0x110000, np.int32)
        self.class_of[arrays["letters"]] = np.arange(1, self.size)
        restart = np.zeros((len(self.languages), ALPHABET), np.int32)
        restart[:, : self.size] = 2 * self.first[:, :ALPHABET] + 1
        restart[:, self.size :] = 1
        self.table = np.repeat(restart, arrays["sizes"], axis=0).ravel()
        self.table[arrays["dense_at"]] = 2 * arrays["dense_to"]
        self.keys, self.values = arrays["sparse_at"], 2 * arrays["sparse_to"].astype(np.int64)

    def pack(self) -> bytes:
        """The automata as the bytes of one file: transitions only, so it is small."""
        names = np.frombuffer(json.dumps(self.languages).encode(), np.uint8)
        return pack_arrays({"names": names, **self.arrays})

    @classmethod
    def opened(cls, path: str) -> CrossParser:
        """The parser of a file of :meth:`pack`; only its table is laid out anew."""
        arrays, out = map_arrays(path), cls.__new__(cls)
        out.languages = json.loads(arrays.pop("names").tobytes())
        out._lay_out(arrays)
        return out

    def _sparse(self, state: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Table values (languages x places) for letters outside the dense table."""
        restart = 2 * self.first[:, letters].astype(np.int64) + 1
        if not len(self.keys):
            return restart
        wanted = state.astype(np.int64) * self.size + letters
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[place] == wanted, self.values[place], restart)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases each language needs for each normalised text (texts x languages)."""
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        parts, owners, size = [], [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), SLAB):
                parts.append(text[at : at + SLAB])
                owners.append(i)
                size += len(parts[-1])
                if size >= SLAB:
                    np.add.at(out, owners, self._slab(parts))
                    parts, owners, size = [], [], 0
        if parts:
            np.add.at(out, owners, self._slab(parts))
        return out

    def _slab(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        codes = self.class_of[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        sizes = np.array([len(t) for t in texts], np.int64)
        pieces = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(np.cumsum(sizes) - sizes, pieces) + number * STRETCH
        length = np.minimum(np.repeat(sizes, pieces) - number * STRETCH, STRETCH)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        state = np.repeat(self.roots[:, None], len(owner), axis=1)
        count = np.zeros(state.shape, np.int32)
        alive = np.searchsorted(-length, -np.arange(1, STRETCH + 1), "right")
        for step in range(STRETCH):
            n = alive[step]
            if not n:
                break
            letters = codes[begin[:n] + step]
            rare = np.flatnonzero(letters >= ALPHABET) if self.size > ALPHABET else ()
            moved = self.table[state[:, :n] * ALPHABET + (letters if not len(rare) else np.where(letters < ALPHABET, letters, 0))]
            if len(rare):
                moved[:, rare] = self._sparse(state[:, rare], letters[rare])
            count[:, :n] += moved & 1
            state[:, :n] = moved >> 1
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(owner, weights=count[k], minlength=len(texts)).astype(np.int64)
        return out

    def predict(self, texts) -> tuple[list[str], list[float]]:
        """Language and score of each raw text."""
        return choose([self], texts)


def choose(parsers, texts) -> tuple[list[str], list[float]]:
    """Language and score of each raw text over all parsers (in order of their
    languages). The score is how far the winner lies ahead: one minus its phrases
    over those of the runner-up."""
    found, scores = ["und"] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
    step, names, counts = 2_000, [], []
    for parser in parsers:
        if parser.languages:
            names += parser.languages
            parts = [parser.phrases([normalised(texts[i]) for i in known[at : at + step]]) for at in range(0, len(known), step)]
            counts.append(np.concatenate(parts) if parts else np.zeros((0, len(parser.languages)), np.int64))
    if names:
        for i, row in zip(known, np.concatenate(counts, axis=1), strict=True):
            best = int(np.argmin(row))
            found[i] = names[best]
            rest = np.delete(row, best)
            scores[i] = float(1 - row[best] / rest.min()) if len(rest) else 1.0
    return found, scores


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: CRC-32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learning_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """Bounded labelled text of each language: pieces of ``SAMPLE_ROWS`` different
    texts, each at a hashed place of its text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(~held_out(F.col("id")) & F.col("text").isNotNull() & (F.col("lang") != ""))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    counts = rows.select("lang", "h").distinct().groupBy("lang").count().collect()
    if not counts:
        return {}
    # a few times the texts wanted, by hash, so that no task gathers more than those
    shares = docs.sparkSession.createDataFrame([(r["lang"], 8.0 * SAMPLE_ROWS / r["count"]) for r in counts], "lang string, share double")
    rows = rows.join(F.broadcast(shares) if len(counts) <= BROADCAST_LANGUAGES else shares, "lang").where(hash_share("h") < F.col("share"))
    # every start of a whole piece is as likely
    starts = F.greatest(F.length("text") - CHARS_OF_ROW, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64("h", F.lit(1)), starts.cast("long")) + 1).cast("int")
    pieces = rows.select("lang", "h", F.substring(F.col("text"), start, F.lit(CHARS_OF_ROW)).alias("text"))
    pieces = pieces.groupBy("lang", "h").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h")
    taken = pieces.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_ROWS)
    each = taken.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("n", "text"))).alias("rows"))
    out = {}
    for r in each.collect():
        out[r["lang"]] = " ".join(_even([normalised(x["text"]) for x in r["rows"]], SAMPLE_CHARS))
    return {k: v for k, v in out.items() if v.strip()}


def _even(texts: list[str], total: int) -> list[str]:
    """The texts, cut so that they and the blanks between them have ``total``
    letters at most: the longest are cut, all to about the same length."""
    left, out = total - len(texts), list(texts)
    for rest, i in enumerate(sorted(range(len(texts)), key=lambda i: len(texts[i]))):
        out[i] = texts[i][: max(left, 0) // (len(texts) - rest)]
        left -= len(out[i])
    return out


def share_parsers(spark: SparkSession, samples: dict[str, str]) -> list[str]:
    """Names of the files with the parsers of all sampled languages."""
    names = sorted(samples)
    rows = [(i // LANGUAGES_OF_FILE, name, samples[name]) for i, name in enumerate(names)]
    count = -(-len(names) // LANGUAGES_OF_FILE)
    if not count:
        return []

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "data": [CrossParser(dict(zip(rows["lang"], rows["text"], strict=True))).pack()]})

    ship_package(spark)
    table = spark.createDataFrame(rows, "part int, lang string, text string")
    return share_files(table.groupBy("part").applyInPandas(build, "part int, data binary"), count, "language_parsers")


_open: dict[str, CrossParser] = {}


def _parsers(names: Sequence[str]) -> Iterator[CrossParser]:
    """The parsers of the files, one in memory at a time; a worker keeps the last one open."""
    from pyspark import SparkFiles

    for name in names:
        if name not in _open:
            _open.clear()
            _open[name] = CrossParser.opened(SparkFiles.get(name))
        yield _open[name]


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row of ``docs``."""
    files = share_parsers(docs.sparkSession, learning_samples(docs, id_col, text_col, lang_col))

    def predict(texts: pd.Series) -> pd.DataFrame:
        languages, scores = choose(_parsers(files), texts.tolist())
        return pd.DataFrame({"lang_pred": pd.Series(languages, dtype=object), "score": pd.Series(scores, dtype="float64")})

    found = docs.select(F.col(id_col).alias("doc_id"), pandas_udf(predict, "lang_pred string, score double")(F.col(text_col).cast("string")).alias("p"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score")

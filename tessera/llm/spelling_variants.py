"""Spelling variants grouped by PartEnum signatures.

1. Words are counted in all texts: runs of letters, lower-cased A-Z only, of a least
   length and a least number of occurrences.
2. A word is the multiset of its letters, a binary vector with one dimension for each
   letter and occurrence. One edit changes at most two dimensions: a replaced letter two
   (and no length), an inserted or deleted one (and the length).
3. The dimensions are dealt into parts, letters by their frequency in the vocabulary. For
   two changed dimensions all but two of ``parts`` parts are equal, so every
   choice of the other parts is a signature (partition and enumerate); for one changed
   dimension all but one of two parts. One edit also leaves the first or the last half of a word as it is:
   each signature is given once with each half, and with the length.
4. Equal signatures are joined and every pair verified by its edit distance.
5. A signature that more than ``hot`` words share leaves that join. Its words write all their strings
   with one letter deleted instead, under the same signature. Two words of one edit share such a
   string, and a string is that of at most (length + 1) x alphabet words, so
   the exact way has no large groups.
6. A word's form is its near word of largest count if that is ``ratio`` times its
   own; forms are followed to the last by pointer doubling. Counts rise at least ``ratio``-fold along
   it, so few rounds do.

Defined results: null and empty texts have no words; a null id counts as an empty one;
rows that repeat count again; ties between forms go to the smallest in code-point
order; an empty table gives no rows. Texts are read whole. Extra columns are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: One in so many (document, run) pairs loses a letter.
SLIP = 31
RATIO = 10
#: Parts for replaced letters, and for inserted or deleted ones.
PARTS = 4
LONE_PARTS = 2
#: Words of a signature beyond which its pairs are found by deletions.
HOT = 1_000
#: Distinct words a task holds before it hands their counts on.
COUNT_SLAB = 300_000
#: Characters of a text whose runs are held at a time.
PIECE = 1 << 20
#: Letters of a run, A-Z already lower-cased (a fixed value).
LETTERS = "a-zÀ-ÿ"


def runs_of(text: str, least: int) -> Counter:
    """Maximal runs of at least ``least`` letters with their numbers."""
    pattern = re.compile(f"[{LETTERS}]{{{least},}}")
    low = text.encode().lower().decode()  # bytes: A-Z only
    if len(low) <= PIECE:
        return Counter(pattern.findall(low))
    return Counter(m[0] for m in pattern.finditer(low))


def count_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, slip: int = SLIP
) -> DataFrame:
    """``word``, ``n`` over all documents. With ``slip``, a run whose CRC-32 of ``id:run`` it divides
    loses the letter at the CRC modulo its length."""

    def count(frames):
        total: Counter = Counter()
        for frame in frames:
            for key, text in zip(frame["id"], frame["text"], strict=True):
                if not text:
                    continue
                prefix = zlib.crc32(f"{key or ''}:".encode())
                for run, n in runs_of(text, least_length).items():
                    if slip:
                        mark = zlib.crc32(run.encode(), prefix)
                        if mark % slip == 0:
                            at = mark % len(run)
                            run = run[:at] + run[at + 1 :]
                            if len(run) < least_length:
                                continue
                    total[run] += n
            if len(total) > COUNT_SLAB:
                yield pd.DataFrame({"word": list(total), "n": list(total.values())})
                total = Counter()
        if total:
            yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def deal_letters(words: DataFrame, parts: int) -> list[str]:
    """The letters of each part: the most frequent first, to and fro over the parts.
    The alphabet of a run has under a hundred letters."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
    order = [r["letter"] for r in sorted(letters.groupBy("letter").count().collect(), key=lambda r: (-r["count"], r["letter"]))]
    dealt = [""] * parts
    for i, letter in enumerate(order):
        turn, place = divmod(i, parts)
        dealt[place if turn % 2 == 0 else parts - 1 - place] += letter
    return dealt


def _projections(dealt: list[str]) -> list[Column]:
    """The sorted letters a word has in each part."""
    out = []
    for own in dealt:
        others = "".join(p for p in dealt if p != own)
        out.append(F.array_join(F.array_sort(F.split(F.translate("word", others, ""), "")), ""))
    return out


def _keys(kind: int, dealt: list[str], changed: int, length: Column) -> Column:
    """The signatures of a word whose shorter partner (or itself) has ``length`` letters."""
    projections = [F.col(f"p{kind}")[i] for i in range(len(dealt))]
    half = F.floor(length / 2).cast("int")
    size = F.length("word")
    sides = [F.substring(F.col("word"), F.lit(1), half), F.substring(F.col("word"), size - (length - half) + 1, length - half)]
    keys = []
    for number, dropped in enumerate(itertools.combinations(range(len(dealt)), changed)):
        kept = [p for i, p in enumerate(projections) if i not in dropped]
        keys += [F.xxhash64(F.lit(kind), F.lit(number), F.lit(side), length, text, *kept) for side, text in enumerate(sides)]
    return F.array(*keys)


def signatures(words: DataFrame, parts: int = PARTS, lone_parts: int = LONE_PARTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(``key``, ``word``, ``n``) of words as partners of words of their own length, as the
    shorter and as the longer of two whose lengths differ by one."""
    many, few = deal_letters(words, parts), deal_letters(words, lone_parts)
    with_parts = words.withColumns({"p0": F.array(*_projections(many)), "p1": F.array(*_projections(few))})
    size = F.length("word")
    row = lambda keys: with_parts.select(F.explode(keys).alias("key"), "word", "n")
    return row(_keys(0, many, 2, size)), row(_keys(1, few, 1, size)), row(_keys(1, few, 1, size - 1))


def _by_deletion(rows: DataFrame) -> DataFrame:
    """Rows under the strings with one letter deleted, and the word itself, of the same key."""
    size = F.length("word")
    cut = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.concat(F.substring(F.col("word"), F.lit(1), i - 1), F.substring(F.col("word"), i + 1, size)),
    )
    strings = F.array_distinct(F.concat(cut, F.array("word")))
    return rows.select(F.explode(F.transform(strings, lambda s: F.xxhash64("key", s))).alias("key"), "word", "n")


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """All pairs of stored ``words`` (``word``, ``n``) one edit apart: ``a``, ``b``, ``a_n``, ``b_n``."""
    same, shorter, longer = signatures(words)

    def joined(left: DataFrame, right: DataFrame, ordered: bool) -> DataFrame:
        other = right.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
        pairs = left.select("key", F.col("word").alias("a"), F.col("n").alias("a_n")).join(other, "key")
        if ordered:
            pairs = pairs.where("a < b")
        return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "b", "a_n", "b_n")

    found = []
    for left, right, ordered in ((same, same, True), (shorter, longer, False)):
        of_key = left.select("key") if ordered else left.select("key").unionAll(right.select("key"))
        crowded = stored(of_key.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > hot).select("key"), "hot_keys")
        if crowded.isEmpty():
            found.append(joined(left, right, ordered))
            continue
        rest = [side.join(crowded, "key", "left_anti") for side in (left, right)]
        full = [_by_deletion(side.join(crowded, "key", "left_semi")) for side in (left, right)]
        found += [joined(*rest, ordered), joined(*full, ordered)]
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionAll(more)
    return pairs.distinct()


def spelling_variants(words: DataFrame, ratio: int = RATIO, hot: int = HOT) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of stored ``words`` (``word``, ``n``)."""
    pairs = stored(near_words(words, hot), "near_words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    # the smallest struct: largest count, then smallest word
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    has_form = -F.col("best.minus") >= F.lit(ratio) * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.near")).alias("form"), F.when(has_form, -F.col("best.minus")).alias("form_n"),
    )
    formed = stored(formed, "word_forms")
    last = roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    out = formed.join(last, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(pointers: DataFrame) -> DataFrame:
    """``word``, ``root``: pointers followed to a word that has none, by doubling."""
    pointers = stored(pointers, "word_roots")
    while True:
        ahead = pointers.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = pointers.join(ahead, "root", "left")
        further = stored(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "word_roots")
        pointers = further.select("word", "root")
        if further.where("moved").isEmpty():
            return pointers


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_count: int = LEAST_COUNT) -> DataFrame:
    """Words of all documents with their forms."""
    words = stored(count_words(docs, id_col, text_col).where(F.col("n") >= least_count), "words")
    return spelling_variants(words)

"""Benchmark passages in documents, by SimHash of item-sized windows.

1. Texts become words (lower-cased runs of letters and digits); five words in
   a row are a shingle, fewer words in all are one shingle.
2. Only windows that share a shingle with an item can be similar to it, so
   windows of an item's size are taken wherever one of its shingles occurs, at
   every start that covers it. Nothing that could verify is left out.
3. Each window gets a 64-bit SimHash of its shingles, repeats included.
4. Multi-index Hamming: fingerprints are cut into eight blocks. Two fingerprints
   within the radius differ by at most radius // 8 bits in one block at least;
   the items near a window in any block are its candidates, so all items within
   the radius are found.
5. The weighted similarity of the shingles themselves (sum of the smaller counts
   by sum of the larger) verifies: ``similarity`` or more is a hit. One table of counts slides
   along an item's windows, so a text costs time in proportion to its length however often it
   repeats an item, and arrays are bounded by a stretch of window starts.

The radius of 20 bits is 3.5 standard deviations above the distance that two
texts of similarity 0.8 have on average, so about one in several thousand
windows at the very threshold is missed; closer windows practically never are.

Items are indexed ``items_per_index`` at a time, so what a task holds is
bounded; a larger benchmark takes more indexes, never fewer items.

Defined results: null and empty texts have no words and no hits; items
without words hit nothing; a document with fewer words than an item is one
window; repeated items each hit; of several windows of one item the most
similar one is given, the first on ties. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import pandas_udf

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 8
ITEMS_PER_INDEX = 5_000
_WORDS = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 20
#: Window starts taken at a time, so a very long text needs bounded arrays.
_STRETCH = 1 << 12


class WordHashes(dict):
    """64-bit hash of each word, remembered."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, mixed so that each bit counts."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for i in range(1, size):
        total = total * _BASE + hashes[i : i + count]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def shingle_counts(words: list[str]) -> Counter:
    size = min(SHINGLE, len(words))
    return Counter(zip(*(words[i:] for i in range(size)), strict=False))


def weighted_similarity(a: Counter, b: Counter) -> float:
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    both = a.total() + b.total() - common
    return common / both if both else 0.0


def window_fingerprints(shingles: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash (uint64) of the ``size`` shingles from each start."""
    low = int(starts.min())
    bits = np.unpackbits(shingles[low : int(starts.max()) + size].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=sums[1:])
    at = starts - low
    return np.packbits((sums[at + size] - sums[at]) * 2 > size, axis=1, bitorder="little").view(np.uint64).ravel()


class BenchmarkIndex:
    """Shingles and fingerprints of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY, radius: int = RADIUS):
        self.similarity, self.radius = similarity, radius
        self.hashes = WordHashes()
        self.ids, self.words = [], []
        self.shingles: dict[int, tuple[np.ndarray, list[int]]] = {}
        for item, text in items:
            if words := words_of(text):
                self.ids.append(item)
                self.words.append(words)
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.counts = [shingle_counts(w) for w in self.words]
        self.prints = np.zeros(len(self.words), np.uint64)
        #: shingle length -> (sorted hashes, item of each, prefilter)
        self.anchors = {}
        by_length: dict[int, list[tuple[int, int]]] = {}
        for k, words in enumerate(self.words):
            length = min(SHINGLE, len(words))
            shingles = shingle_hashes(self.word_hashes(words), length)
            self.prints[k] = window_fingerprints(shingles, np.zeros(1, np.int64), len(shingles))[0]
            by_length.setdefault(length, []).extend((int(h), k) for h in set(shingles.tolist()))
        for length, pairs in by_length.items():
            pairs.sort()
            keys = np.array([p[0] for p in pairs], np.uint64)
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[keys >> np.uint64(64 - _FILTER_BITS)] = True
            self.anchors[length] = (keys, np.array([p[1] for p in pairs], np.int64), seen)
        octets = np.arange(256, dtype=np.uint8)
        near = np.bitwise_count(octets[:, None] ^ octets[None, :]) <= radius // BLOCKS
        self.by_size = {}
        for size in np.unique(self.sizes):
            items_of = np.flatnonzero(self.sizes == size)
            blocks = self.prints[items_of].view(np.uint8).reshape(-1, BLOCKS)
            # for each block and value: which items are near
            self.by_size[int(size)] = (items_of, near[:, blocks.T].transpose(1, 0, 2))

    def word_hashes(self, words: list[str]) -> np.ndarray:
        known = self.hashes
        return np.fromiter((known[w] for w in words), np.uint64, len(words))

    def candidates(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, bits) of all pairs within the radius."""
        items, near = self.by_size[size]
        blocks = prints.view(np.uint8).reshape(-1, BLOCKS)
        any_near = near[0][blocks[:, 0]]
        for b in range(1, BLOCKS):
            any_near = any_near | near[b][blocks[:, b]]
        window, place = np.nonzero(any_near)
        bits = np.bitwise_count(prints[window] ^ self.prints[items[place]])
        keep = bits <= self.radius
        return window[keep], items[place[keep]], bits[keep]

    def hits(self, text: str | None) -> list[tuple]:
        """(item id, first word, words, bits, similarity) for each item found."""
        words = words_of(text)
        if not words or not self.anchors:
            return []
        hashed = self.word_hashes(words)
        found: dict[int, tuple] = {}
        for length, (keys, items, seen) in self.anchors.items():
            shingles = shingle_hashes(hashed, length)
            spots = np.flatnonzero(seen[shingles >> np.uint64(64 - _FILTER_BITS)])
            if not len(spots):
                continue
            first = np.searchsorted(keys, shingles[spots], "left")
            last = np.searchsorted(keys, shingles[spots], "right")
            near: dict[int, list[int]] = {}
            for spot, a, b in zip(spots.tolist(), first.tolist(), last.tolist(), strict=True):
                for k in items[a:b].tolist():
                    near.setdefault(int(self.sizes[k]), []).append(spot)
            for size, places in near.items():
                self._windows(words, shingles, length, size, np.unique(places), found)
        return [found[k] for k in sorted(found)]

    def _windows(self, words: list[str], shingles: np.ndarray, length: int, size: int, spots: np.ndarray, found: dict[int, tuple]) -> None:
        span = min(size, len(words))
        # a spot is covered by the starts from ``span - length`` before it to itself
        last = len(words) - span
        opened = np.zeros(last + 2, np.int32)
        np.add.at(opened, np.minimum(np.maximum(spots - (span - length), 0), last + 1), 1)
        np.add.at(opened, np.minimum(spots, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(opened[:-1]) > 0)
        for stretch in np.split(starts, np.flatnonzero(np.diff(starts // _STRETCH)) + 1):
            if len(stretch):
                self._stretch(words, shingles, length, size, span, stretch, found)

    def _stretch(self, words: list[str], shingles: np.ndarray, length: int, size: int, span: int, starts: np.ndarray, found: dict[int, tuple]) -> None:
        count = span - length + 1
        window, item, bits = self.candidates(window_fingerprints(shingles, starts, count), size)
        low = int(starts[0])
        near = shingles[low : int(starts[-1]) + count]
        for k in np.unique(item).tolist():
            own = item == k
            at, apart = starts[window[own]], bits[own]
            keys, wanted = self.item_shingles(k)
            place = np.minimum(np.searchsorted(keys, near), len(keys) - 1)
            codes = np.where(keys[place] == near, place, -1).tolist()
            values = sliding_similarity(codes, (at - low).tolist(), count, wanted)
            best = int(np.argmax(values))
            if values[best] < self.similarity or (k in found and values[best] <= found[k][4]):
                continue
            exact = self._exact(words, int(at[best]), span, k)
            if exact != values[best]:  # hashes of different shingles met: compare the words everywhere
                values = [self._exact(words, s, span, k) for s in at.tolist()]
                best = int(np.argmax(values))
                if values[best] < self.similarity or (k in found and values[best] <= found[k][4]):
                    continue
            found[k] = (self.ids[k], int(at[best]), span, int(apart[best]), values[best])

    def _exact(self, words: list[str], start: int, span: int, k: int) -> float:
        return weighted_similarity(shingle_counts(words[start : start + span]), self.counts[k])

    def item_shingles(self, k: int) -> tuple[np.ndarray, list[int]]:
        """Sorted distinct shingle hashes of an item and how often it has each."""
        if k not in self.shingles:
            words = self.words[k]
            keys, counts = np.unique(shingle_hashes(self.word_hashes(words), min(SHINGLE, len(words))), return_counts=True)
            self.shingles[k] = keys, counts.tolist()
        return self.shingles[k]


def sliding_similarity(codes: list[int], starts: list[int], count: int, wanted: list[int]) -> list[float]:
    """Weighted similarity of an item to the ``count`` shingles from each (ascending) start. ``codes``
    number the item's shingles (-1: not one of them), ``wanted`` says how often it has each.
    One table of counts slides along, so a step costs what enters and leaves the window."""
    have, common, total, out = [0] * len(wanted), 0, sum(wanted), []
    left = right = 0  # the window that ``have`` counts
    for start in starts:
        if start >= right:
            have, common, left, right = [0] * len(wanted), 0, start, start
        for c in codes[left:start]:
            if c >= 0:
                common -= have[c] <= wanted[c]
                have[c] -= 1
        for c in codes[right : start + count]:
            if c >= 0:
                have[c] += 1
                common += have[c] <= wanted[c]
        left, right = start, start + count
        out.append(common / (count + total - common))
    return out


HITS = "array<struct<item_id:long,first_word:long,words:long,bits:int,similarity:double>>"
_HIT_NAMES = ("item_id", "first_word", "words", "bits", "similarity")


def hits_column(text: Column, items: list[tuple[int, str]]) -> Column:
    """Hits of one bounded list of items in a text column."""
    cache: list[BenchmarkIndex] = []

    def scan(texts: pd.Series) -> pd.Series:
        if not cache:
            cache.append(BenchmarkIndex(items))
        return pd.Series([[dict(zip(_HIT_NAMES, h, strict=True)) for h in cache[0].hits(t)] for t in texts], dtype=object)

    return pandas_udf(scan, HITS)(text)


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", items_per_index: int = ITEMS_PER_INDEX) -> DataFrame:
    """``doc`` (struct of all columns of ``docs``) and ``hits``.

    The items come to the driver one index at a time, dealt by hash, and each
    index goes out with its tasks."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("id"), F.col(item_text).cast("string").alias("text")).where(
        F.col("text").isNotNull()
    )
    total = rows.count()
    parts = max(1, -(-total * 5 // (items_per_index * 4)))
    out = docs.select(F.struct("*").alias("doc"), F.col(text_col).cast("string").alias("text"))
    found = []
    for part in range(parts):
        some = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part) if parts > 1 else rows
        items = [(r["id"], r["text"]) for r in some.orderBy("id", "text").collect()]
        found.append(hits_column(F.col("text"), items))
    return out.select("doc", (F.concat(*found) if len(found) > 1 else found[0]).alias("hits"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each document and item found in it."""
    scanned = with_hits(docs, benchmark).where(F.size("hits") > 0)
    return scanned.select(F.col(f"doc.{id_col}").alias("doc_id"), F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item was found, all columns kept."""
    return with_hits(docs, benchmark).where(F.size("hits") == 0).select("doc.*")

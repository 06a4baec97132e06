"""Best-fit packing of token sequences by fitted length patterns.

1. Every text becomes token ids and an end id; longer ones are cut into pieces of
   the sequence length, the first piece taking what is left over. The pieces are
   stored once, with the task that made them and a running number for each length.
2. Only the histogram of lengths reaches the driver: one number for each length.
3. Patterns of up to three lengths that fill a sequence exactly are enumerated.
   Non-negative least squares fit how often each is used to the histogram
   (accelerated projected gradient on the sparse pattern matrix).
4. The fitted counts are rounded down; what the histogram still holds is packed
   by best fit, longest first, over counts of equal sequences, not single pieces.
5. The result is a list of (pattern, repeats). Each pattern gives the pieces of one length
   a range of running numbers, so every piece finds its sequence and offset by
   its own number alone, wherever it lies.

The driver's work and the list depend on the sequence length, not on the number
of documents.

Defined results: a null or empty text is the end id alone. Repeated ids and rows
are packed like any others. Empty table: no rows. Extra columns are kept by
``place`` and ignored by ``tokenize``.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right, insort
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, pandas_udf, partition_id, stored, with_rank

MAX_TOKENS = 1024
END_ID = 2
#: Steps of the least-squares fit.
FIT_STEPS = 600


# --- tokens ------------------------------------------------------------------


#: Fixed value: how a byte-level pre-tokenizer cuts text into words.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of other characters, or with a run this long, take the plain encoder.
_UNCOMMON = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e]|\\S{2000}")


class TextEncoder:
    """Token ids of whole texts, as ``tokenizers`` gives them for the file.

    Where the file is a byte-level BPE whose ids follow its merges, the same
    vocabulary read as ranks encodes most texts several times faster; its ids are
    the same. Texts with uncommon characters (whose classes may differ between
    versions of Unicode), very long runs or strings of added tokens go to ``tokenizers`` itself.
    """

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        file = json.loads(Path(tokenizer_path).read_text())
        self.ranked = _ranked_encoding(file)
        added = [re.escape(t["content"]) for t in file.get("added_tokens", [])]
        #: Texts that hold an added token, too: the file says what becomes of it.
        self.special = re.compile("|".join(added)) if added else None

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.ranked and not _UNCOMMON.search(text) and not (self.special and self.special.search(text)):
            return np.array(self.ranked.encode_ordinary(text), "<u4").tobytes()
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _ranked_encoding(file: dict):
    """The vocabulary of a tokenizer file as ranks, None if it is no such BPE."""
    import tiktoken

    model, cut = file["model"], file.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or file.get("normalizer"):
        return None
    # a byte is written as its own character if that is visible, else as one from 256 on
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in file.get("added_tokens", [])}
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)) or any(c not in byte_of for t in vocab for c in t):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}
    return tiktoken.Encoding("file", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})


_encoders: dict[str, TextEncoder] = {}


def _encoder(path: str) -> TextEncoder:
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


PIECES = "doc_id long, no_id boolean, piece int, start long, length long, ids binary, part long, number long"


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Stored pieces: ``doc_id``, ``piece``, ``start``, ``length``, ``ids`` (little-endian
    unsigned 32-bit), and for ``place`` the writing task ``part`` and the running
    ``number`` of the piece among that task's pieces of its length."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(frames):
        encoder, part, seen = _encoder(tokenizer_path), partition_id(), np.zeros(max_tokens + 1, np.int64)
        for frame in frames:
            for at in range(0, len(frame), 256):
                some, rows = frame.iloc[at : at + 256], []
                for doc, no_id, text in zip(some["doc_id"], some["no_id"], some["text"], strict=True):
                    raw = encoder.encode(text or "")
                    raw += end
                    start, piece, total = 0, 0, len(raw) // 4
                    first = total if total <= max_tokens else total % max_tokens or max_tokens
                    while start < total:
                        length = first if piece == 0 else max_tokens
                        rows.append((doc, no_id, piece, start, length, raw[4 * start : 4 * (start + length)], part, seen[length]))
                        seen[length] += 1
                        start, piece = start + length, piece + 1
                yield pd.DataFrame(rows, columns=["doc_id", "no_id", "piece", "start", "length", "ids", "part", "number"])

    own = F.col(id_col).cast("long")
    source = docs.select(F.coalesce(own, F.lit(0)).alias("doc_id"), own.isNull().alias("no_id"), F.col(text_col).cast("string").alias("text"))
    pieces = stored(map_batches(source, cut, PIECES), "packing_pieces")
    return pieces.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("no_id")


# --- patterns ----------------------------------------------------------------


def fill_patterns(max_tokens: int) -> np.ndarray:
    """All sets of one to three lengths (descending, 0 for none) that add up to
    ``max_tokens``."""
    out = [(max_tokens, 0, 0)]
    for a in range(max_tokens - 1, 0, -1):
        for b in range(min(a, max_tokens - a), 0, -1):
            c = max_tokens - a - b
            if c <= b:
                out.append((a, b, c))
    return np.array(out, np.int64)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Non-negative least squares: repeats x >= 0 with little ||W (A x - h)||, where A
    counts the lengths of each pattern; short lengths weigh less, as they fit into
    gaps anywhere. Nesterov steps on the projected gradient."""
    size = len(histogram)
    weight = np.sqrt(np.arange(size) / size)
    weight[0] = 0
    target = histogram * weight
    used = [p > 0 for p in patterns.T]

    def forward(x):
        total = np.zeros(size)
        for column, mask in zip(patterns.T, used, strict=True):
            total += np.bincount(column[mask], weights=x[mask], minlength=size)
        return total * weight

    def backward(r):
        r = r * weight
        return sum(np.where(mask, r[column], 0.0) for column, mask in zip(patterns.T, used, strict=True))

    v = np.ones(len(patterns))
    for _ in range(20):  # largest eigenvalue of A'A
        v = backward(forward(v))
        v /= np.linalg.norm(v)
    step = 1 / max(float(v @ backward(forward(v))), 1e-12) / 1.05
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - step * backward(forward(y) - target), 0)
        if (y - new) @ (new - x) > 0:  # restart when the momentum points uphill
            t = 1.0
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit_rest(left: np.ndarray, max_tokens: int) -> dict[tuple, int]:
    """Pack a histogram by best fit, longest lengths first: {pattern: repeats}.
    Open sequences are kept as (pattern, how many) by their free space."""
    open_by_space: dict[int, dict[tuple, int]] = {}
    spaces: list[int] = []
    done: dict[tuple, int] = {}

    def put(pattern: tuple, space: int, count: int) -> None:
        if space == 0:
            done[pattern] = done.get(pattern, 0) + count
            return
        if space not in open_by_space:
            open_by_space[space] = {}
            insort(spaces, space)
        open_by_space[space][pattern] = open_by_space[space].get(pattern, 0) + count

    for length in range(max_tokens, 0, -1):
        count = int(left[length])
        while count:
            at = bisect_right(spaces, length - 1)
            if at == len(spaces):
                each = max_tokens // length
                full, over = divmod(count, each)
                if full:
                    put((length,) * each, max_tokens - each * length, full)
                if over:
                    put((length,) * over, max_tokens - over * length, 1)
                break
            space = spaces[at]
            group = open_by_space[space]
            pattern, many = group.popitem()
            if not group:
                del open_by_space[space]
                spaces.pop(at)
            fits = min(space // length, count)
            full = min(many, count // fits)
            if many > full:
                put(pattern, space, many - full)
            put(pattern + (length,) * fits, space - fits * length, full)
            count -= fits * full
    for group in open_by_space.values():
        for pattern, many in group.items():
            done[pattern] = done.get(pattern, 0) + many
    return done


def plan_patterns(histogram: np.ndarray, steps: int = FIT_STEPS) -> list[tuple[tuple, int]]:
    """(pattern, repeats) that use exactly the pieces of the histogram."""
    max_tokens = len(histogram) - 1
    patterns = fill_patterns(max_tokens)
    repeats = np.floor(fit_repeats(patterns, histogram, steps) + 1e-6).astype(np.int64)
    left = histogram.astype(np.int64).copy()
    plan: dict[tuple, int] = {}
    for k in np.argsort(-repeats, kind="stable"):
        if repeats[k] == 0:
            break
        pattern = tuple(int(n) for n in patterns[k] if n)
        need = {n: pattern.count(n) for n in pattern}
        times = min(int(repeats[k]), *(int(left[n]) // m for n, m in need.items()))
        if times > 0:
            plan[pattern] = plan.get(pattern, 0) + times
            for n, m in need.items():
                left[n] -= times * m
    for pattern, times in best_fit_rest(left, max_tokens).items():
        plan[pattern] = plan.get(pattern, 0) + times
    return sorted(plan.items(), reverse=True)


class Placement:
    """Where the n-th piece of each length goes."""

    def __init__(self, plan: list[tuple[tuple, int]]):
        rows, first, taken = [], 0, {}
        for pattern, times in plan:
            offset = 0
            for length in pattern:
                rows.append((length, taken.get(length, 0), first, offset))
                taken[length] = taken.get(length, 0) + times
                offset += length
            first += times
        rows.sort()
        self.sequences = first
        table = np.array(rows, np.int64).reshape(-1, 4)
        #: length and first number in one ascending key
        self.shift = 40
        self.key = (table[:, 0] << self.shift) | table[:, 1]
        self.start, self.sequence, self.offset = table[:, 1], table[:, 2], table[:, 3]

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << self.shift) | number, "right") - 1
        return self.sequence[at] + number - self.start[at], self.offset[at]


def place(pieces: DataFrame, max_tokens: int = MAX_TOKENS, steps: int = FIT_STEPS) -> DataFrame:
    """Stored pieces (``length``, ``part``, ``number``) with ``sequence_id`` and ``offset``."""
    histogram = np.zeros(max_tokens + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # one row for each length
        histogram[r["length"]] = r["count"]
    placement = Placement(plan_patterns(histogram, steps))

    def where(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = placement.find(length.to_numpy(np.int64), number.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = with_rank(pieces, "length", "part", "number", "_nth").withColumn("_place", pandas_udf(where, "sequence_id long, offset long")("length", "_nth"))
    return ranked.withColumn("sequence_id", F.col("_place.sequence_id")).withColumn("offset", F.col("_place.offset")).drop("_nth", "_place")


def ids_crc32(ids: Column) -> Column:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return F.crc32(ids)

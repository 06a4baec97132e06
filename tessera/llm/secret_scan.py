"""Secrets in texts: keyword automaton, anchored expressions, checksums.

One pass of an Aho-Corasick automaton over the lower-cased text finds the
keywords; a regular expression is then tried only where a keyword starts (or,
for runs of hex digits, where 32 of them stand in a row). Spans of one kind are
leftmost and do not overlap. Token kinds whose last characters are a checksum of
the rest are kept only if the checksum is right.

Kinds, in this order: ``assign``, ``access``, ``hex`` (the base kinds), ``github``
and ``npm`` (tokens with an embedded CRC-32). Positions are code points, end
exclusive.

Defined results: null and empty texts have no spans; spans of different kinds may
overlap and are all given; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import pandas_udf

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")
MASK = "[SECRET]"

# Keywords, patterns, least lengths.
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_GITHUB = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_NPM = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_GITHUB_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_HEX_DIGITS = frozenset(b"0123456789abcdef")
_HEX_CLASS = bytes(ord("x") if i in _HEX_DIGITS else ord(" ") for i in range(256))


def base62_crc32(body: str) -> str:
    """CRC-32 in six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = _BASE62[digit] + out
    return out


def checksum_holds(token: str) -> bool:
    body = token.split("_", 1)[1]
    return base62_crc32(body[:30]) == body[30:]


_state: dict = {}


def _automaton():
    if "automaton" not in _state:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for kind, words in (("assign", _ASSIGN_WORDS), ("access", ("akia",)), ("github", _GITHUB_WORDS), ("npm", ("npm_",))):
            for word in words:
                automaton.add_word(word, (kind, len(word)))
        automaton.make_automaton()
        _state["automaton"] = automaton
    return _state["automaton"]


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end), by start, then kind as listed."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower().decode("utf-8", "surrogatepass")  # A-Z only: positions stay
    starts: dict[str, list[int]] = {}
    for last, (kind, size) in _automaton().iter(low):
        starts.setdefault(kind, []).append(last - size + 1)
    spans = []
    for kind, places in starts.items():
        taken = 0
        for at in sorted(places):
            if at < taken:
                continue
            if kind == "assign":
                match = _ASSIGN.match(text, at)
                good = match and len(match[2]) >= LEAST_ASSIGN
            elif kind == "access":
                match = _ACCESS.match(text, at)
                good = match and len(match[0]) >= LEAST_ACCESS
            else:
                match = (_GITHUB if kind == "github" else _NPM).match(text, at)
                good = match and checksum_holds(match[0])
            if match:
                taken = match.end()
            if good:
                spans.append((kind, at, match.end()))
    classes = raw.translate(_HEX_CLASS)
    at = classes.find(b"x" * LEAST_HEX)
    if at >= 0:
        ascii_only = len(raw) == len(text)
        while at >= 0:
            end = classes.find(b" ", at)
            end = len(classes) if end < 0 else end
            start = at if ascii_only else len(raw[:at].decode("utf-8", "surrogatepass"))
            spans.append(("hex", start, _HEX.match(text, start).end()))
            at = classes.find(b"x" * LEAST_HEX, end)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def span_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def masked(text: str | None) -> str | None:
    """The text with every span (overlapping ones as one) replaced by a mark."""
    spans = find_secrets(text)
    if not spans:
        return text
    out, at, end = [], 0, -1
    for _, start, stop in spans:
        if start >= end:
            if end >= 0:
                at = end
            out += [text[at:start], MASK]
        end = max(end, stop)
    return "".join(out) + text[end:]


def secret_spans(text: Column) -> Column:
    """All spans of each text."""

    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t)] for t in texts], dtype=object)

    return pandas_udf(spans, "array<struct<kind:string,start:long,end:long>>")(text)


def secret_digest(text: Column) -> Column:
    """Counts of the base kinds, digest of their spans, and all spans as text."""
    return pandas_udf(_digests, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")(text)


def _digests(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        spans = find_secrets(text)
        base = [s for s in spans if s[0] in BASE_KINDS]
        counts = [sum(s[0] == kind for s in base) for kind in BASE_KINDS]
        rows.append((*counts, hashlib.sha256(span_text(base).encode()).hexdigest(), span_text(spans)))
    return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def masked_text(text: Column) -> Column:
    """The text column with its secrets masked."""

    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t) for t in texts], dtype=object)

    return pandas_udf(mask, "string")(text)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id`` and ``spans`` (array)."""
    return docs.select(F.col(id_col).alias("doc_id"), secret_spans(F.col(text_col).cast("string")).alias("spans"))


def without_secrets(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs`` with secrets masked; ``length_col``, where
    there is one, follows the new text if it changed."""
    rows = docs.select(F.struct("*").alias("doc"), masked_text(F.col(text_col).cast("string")).alias("clean"))

    def column(name: str) -> Column:
        own = F.col("doc").getField(name)
        if name == text_col:
            return F.col("clean").alias(name)
        if name == length_col:
            kind = docs.schema[name].dataType
            changed = ~F.col("clean").eqNullSafe(F.col("doc").getField(text_col))
            return F.when(changed, F.length("clean")).otherwise(own).cast(kind).alias(name)
        return own.alias(name)

    return rows.select(*[column(name) for name in docs.columns])

"""URL rules in a sorted digest array.

Every rule (host, path) is one string ``host + path``. The 64-bit XXH64 digests of
these strings are kept sorted in one array, cut into equal ranges of the digests
with about ``array_rules`` rules each. Tasks pack the ranges, Spark's own file
distribution hands them to the executors and each worker maps them into memory. A
url is probed with every string a fitting rule could have: each suffix of its
host that starts at a label, followed by each of the path lengths that rules with
this host have. A probe's digest names its range; a vectorised binary search finds
it there, and the stored full string is compared, so a digest collision decides nothing.
A host with most of the rules fills all ranges like any other, since its rules have digests of their own.

A rule fits its host and all subdomains if the url's path starts with the
rule's path. The longest rule wins (host and path together; of equally long
ones the longer host). A rule given twice counts once; given with both actions,
it blocks. Without a rule the verdict is ``default_verdict``.

Defined results: a null url or one without ``://`` has empty host and path and
fits no rule, unless a rule has an empty host and path; rules with a null host or path
read as empty strings; empty url table: empty result; empty rule table: every
url gets the default. Extra columns of the urls stay as they are.

The array lies whole on each executor's disk, about 100 bytes a rule; a task or the
driver holds a few ranges at a time, at any number of rules.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_arrays, pack_arrays, pandas_udf, share_files, ship_package, stored

#: Rules of one range of the digest array.
ARRAY_RULES = 500_000
#: Seed of Spark's ``xxhash64``, so that tasks of either kind agree on a string's range.
SEED = 42


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower())


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def clean_rules(rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``action`` with one row for each rule; block before allow."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("host", "path")]
    return rules.select(*text, "action").groupBy("host", "path").agg(F.max("action").alias("action"))


def digests(strings: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(s, SEED) for s in strings], np.uint64)


class DigestArray:
    """Sorted digests with their strings, mapped from one file for each range of the digests."""

    def __init__(self, *paths: str):
        self.ranges = [map_arrays(p) for p in paths]

    @staticmethod
    def pack(rows: list[tuple[str, str, str]]) -> bytes:
        """Rules (host, path, action) as an array of one range."""
        lengths: dict[str, set[int]] = {}
        for host, path, _ in rows:
            lengths.setdefault(host, set()).add(len(path))
        return DigestArray.pack_range(lengths.items(), [(h + p, len(h), a == "block") for h, p, a in rows])

    @staticmethod
    def pack_range(hosts: Iterable[tuple[str, Iterable[int]]], rules: Iterable[tuple[str, int, bool]]) -> bytes:
        """File of hosts with the path lengths of their rules and of rules (string, length of its
        host, whether it blocks): digests of both, each with offsets into their strings."""

        def by_digest(entries):
            entries = sorted(entries, key=lambda e: e[:2])
            keys = digests([e[0] for e in entries])
            order = np.argsort(keys, kind="stable")
            return keys[order], [entries[i] for i in order]

        host_keys, hosts = by_digest((h, tuple(sorted(n))) for h, n in hosts)
        rule_keys, rules = by_digest(rules)
        host_bytes, rule_bytes = [h[0].encode() for h in hosts], [r[0].encode() for r in rules]
        offsets = lambda sizes: np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return pack_arrays(
            {
                "host_key": host_keys,
                "host_at": offsets([len(b) for b in host_bytes]),
                "host_text": np.frombuffer(b"".join(host_bytes), np.uint8),
                "length_at": offsets([len(h[1]) for h in hosts]),
                "length": np.array([n for h in hosts for n in h[1]], np.int64),
                "rule_key": rule_keys,
                "rule_at": offsets([len(b) for b in rule_bytes]),
                "rule_text": np.frombuffer(b"".join(rule_bytes), np.uint8),
                "rule_host": np.array([r[1] for r in rules], np.int64),
                "blocks": np.array([r[2] for r in rules], np.uint8),
            }
        )

    def _find(self, kind: str, strings: list[str]) -> list[list[tuple[dict, int]]]:
        """Entries (range and place in it) whose stored string equals each of the strings."""
        probes = digests(strings)
        owner = ((probes >> np.uint64(32)) * np.uint64(len(self.ranges))) >> np.uint64(32)
        found: list[list[tuple[dict, int]]] = [[] for _ in strings]
        for number in np.unique(owner):
            part, mine = self.ranges[int(number)], np.flatnonzero(owner == number)
            keys, offsets, text = part[f"{kind}_key"], part[f"{kind}_at"], part[f"{kind}_text"]
            first, last = np.searchsorted(keys, probes[mine], "left"), np.searchsorted(keys, probes[mine], "right")
            for hit in np.flatnonzero(first < last):
                raw = strings[mine[hit]].encode()
                found[mine[hit]] = [(part, j) for j in range(first[hit], last[hit]) if text[offsets[j] : offsets[j + 1]].tobytes() == raw]
        return found

    def longest(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None]]:
        """Rule string and action of the longest rule that fits each url."""
        probes: dict[str, None] = {}
        suffixes = [host_suffixes(h) for h in hosts]
        for each in suffixes:
            probes.update(dict.fromkeys(each))
        known = list(probes)
        lengths = {}
        for suffix, entries in zip(known, self._find("host", known), strict=True):
            for part, j in entries:
                lengths[suffix] = part["length"][part["length_at"][j] : part["length_at"][j + 1]].tolist()
        wanted = [
            [(len(s) + n, len(s), s + path[:n]) for s in each if s in lengths for n in lengths[s] if n <= len(path)]
            for each, path in zip(suffixes, paths, strict=True)
        ]
        strings = list(dict.fromkeys(w[2] for each in wanted for w in each))
        entries = dict(zip(strings, self._find("rule", strings), strict=True))
        out = []
        for each in wanted:
            best = max(
                ((size, host, text, int(part["blocks"][j])) for size, host, text in each for part, j in entries[text] if part["rule_host"][j] == host),
                default=None,
            )
            out.append((best[2], "block" if best[3] else "allow") if best else (None, None))
        return out


def host_suffixes(host: str) -> list[str]:
    """The host and what follows each of its dots."""
    out, at = [host], host.find(".")
    while at >= 0:
        out.append(host[at + 1 :])
        at = host.find(".", at + 1)
    return out


def packed_ranges(rules: DataFrame, count: int) -> DataFrame:
    """``part``, ``data``: the files of ``count`` equal ranges of the digests of clean rules."""
    ship_package(rules.sparkSession)
    whole = rules.select(
        F.concat("host", "path").alias("text"), F.length("host").alias("host_length"), (F.col("action") == "block").alias("blocks"), F.lit(None).cast("array<int>").alias("lengths")
    )
    hosts = rules.groupBy(F.col("host").alias("text")).agg(F.collect_set(F.length("path")).alias("lengths"))
    hosts = hosts.select("text", F.lit(-1).alias("host_length"), F.lit(False).alias("blocks"), "lengths")
    high = F.call_function("shiftrightunsigned", F.xxhash64("text"), F.lit(32))
    entries = whole.unionAll(hosts).withColumn("part", F.call_function("shiftright", high * count, F.lit(32)).cast("int"))
    every = rules.sparkSession.range(count).select(F.col("id").cast("int").alias("part"))

    def pack(key: tuple, rows: pd.DataFrame, _: pd.DataFrame) -> pd.DataFrame:
        of_host = rows["host_length"] < 0
        hosts = zip(rows["text"][of_host], rows["lengths"][of_host], strict=True)
        whole = zip(rows["text"][~of_host], rows["host_length"][~of_host], rows["blocks"][~of_host], strict=True)
        return pd.DataFrame({"part": [key[0]], "data": [DigestArray.pack_range(hosts, whole)]})

    # every range has a file, also one without entries
    return entries.groupBy("part").cogroup(every.groupBy("part")).applyInPandas(pack, "part int, data binary")


def judge_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url", default_verdict: str = "allow", array_rules: int = ARRAY_RULES) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict`` beside ``page``
    (a struct of all their own columns)."""
    rules = stored(clean_rules(rules), "url_rules")
    pages = urls.select(F.struct("*").alias("page"), url_host(F.col(url_col).cast("string")).alias("host"), url_path(F.col(url_col).cast("string")).alias("path"))
    count = max(1, -(-rules.count() // array_rules))
    names = tuple(share_files(packed_ranges(rules, count), count, "url_ranges"))

    def probe(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = _mapped(names).longest(host.tolist(), path.tolist())
        return pd.DataFrame({"rule": pd.Series([r for r, _ in found], dtype=object), "verdict": pd.Series([v for _, v in found], dtype=object)})

    judged = pages.withColumn("judged", pandas_udf(probe, "rule string, verdict string")("host", "path"))
    return judged.select("page", "host", "path", F.col("judged.rule").alias("rule"), F.coalesce("judged.verdict", F.lit(default_verdict)).alias("verdict"))


_arrays: dict[tuple[str, ...], DigestArray] = {}


def _mapped(names: tuple[str, ...]) -> DigestArray:
    """The mapped array of this worker (opened once)."""
    from pyspark import SparkFiles

    if names not in _arrays:
        _arrays.clear()
        _arrays[names] = DigestArray(*[SparkFiles.get(n) for n in names])
    return _arrays[names]

"""Digest array against plain rule matching."""

import random

import duckdb
from conftest import SF_SMALL

from tessera.llm import queries
from tessera.llm import url_filter as U

RULES = "host string, path string, action string"


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), h + p, a == "block") for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], ("block" if best[3] else "allow") if best else "allow"


def test_random_rules_in_any_number_of_ranges(spark):
    rng = random.Random(5)
    labels, paths = ["a", "b", "cc", "net", "É"], ["", "/", "/a", "/a/b", "/ab"]
    name = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    rules = [(name(), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(60)]
    urls = [f"http://{name()}{rng.choice(paths)}{rng.choice(['', '/x', '?q=/a', '#f://'])}" for _ in range(300)]
    urls += [None, "", "no scheme/a", "HTTP://A.NET/A", "x://", "x://?://b", "http://é.É/a", "http://net:80/", "http://" + "a." * 500 + "net/" + "a" * 9000]
    table = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    lookup = spark.createDataFrame(rules + rules, RULES)
    for most in (1000, 10, 1):
        got = {r["page"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge_urls(table, lookup, array_rules=most).collect()}
        assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_a_host_with_most_rules_is_spread_over_the_ranges(spark):
    rules = [("big.net", f"/{i}/", "block") for i in range(400)] + [(f"h{i}.org", "/", "allow") for i in range(50)]
    lookup = U.clean_rules(spark.createDataFrame(rules, RULES))
    sizes = {r["part"]: len(r["data"]) for r in U.packed_ranges(lookup, 9).collect()}
    assert sorted(sizes) == list(range(9)) and max(sizes.values()) < 2 * min(sizes.values())
    urls = [f"http://{h}/{i}/x" for i in range(0, 400, 13) for h in ("big.net", "a.big.net", "h7.org", "net")]
    table = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge_urls(table, U.clean_rules(lookup), array_rules=50).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_empty_tables(spark):
    urls = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    rules = spark.createDataFrame([], RULES)
    assert [(r["rule"], r["verdict"]) for r in U.judge_urls(urls, rules).collect()] == [(None, "allow")]
    assert U.judge_urls(urls.limit(0), rules).count() == 0


def test_colliding_digests_are_confirmed(tmp_path, monkeypatch):
    import xxhash

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda s, *a: 7)
    file = tmp_path / "rules"
    file.write_bytes(U.DigestArray.pack([("a.b", "/x", "block"), ("b", "/", "allow")]))
    array = U.DigestArray(str(file))
    assert array.longest(["a.b", "c.b", "c"], ["/x1", "/x1", "/x1"]) == [("a.b/x", "block"), ("b/", "allow"), (None, None)]


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    want = con.execute(queries.ORACLE["op4_url_filter"])
    names = [d[0] for d in want.description]
    got = queries.op4_url_filter(spark, SF_SMALL)
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, want.fetchall()))

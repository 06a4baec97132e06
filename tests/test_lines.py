"""First lines, row caps, line numbers, quarantine."""

import gzip
import os

import pytest

from tessera.config import CleanConfig
from tessera.plans.job import ingest
from tessera.sources import lines, readers


def _files(tmp_dir, *texts):
    for i, text in enumerate(texts):
        with open(os.path.join(tmp_dir, f"part-{i}.txt"), "w", newline="") as fh:
            fh.write(text)
    return tmp_dir


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 9, 10, 11, 500])
def test_first_lines_over_files(spark, tmp_dir, n):
    _files(tmp_dir, "a1\na2\n\n", "", "b1\r\nb2\nb3", "c1\nc2\nc3\nc4\n")
    every = ["a1", "a2", "", "b1", "b2", "b3", "c1", "c2", "c3", "c4"]
    got = lines.first_lines(spark, tmp_dir, n).orderBy(lines.FILE, lines.BLOCK, lines.PLACE)
    assert [r["value"] for r in got.collect()] == every[:n]


def test_first_lines_inside_splits_of_one_file(spark, tmp_dir):
    path = os.path.join(tmp_dir, "big file.txt")
    with open(path, "w") as fh:
        fh.writelines(f"line {i}\n" for i in range(50_000))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = lines.first_lines(spark, path, 23_457)
        assert got.rdd.getNumPartitions() > 3
        assert sorted(int(r["value"].split()[1]) for r in got.collect()) == list(range(23_457))
        plan = got._jdf.queryExecution().toString()
        assert "Exchange" not in plan and "GlobalLimit" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    with pytest.raises(ValueError):
        lines.first_lines(spark, path, -1)


def test_files_behind_the_lines_wanted_are_not_counted(spark, tmp_dir):
    _files(tmp_dir, *[f"x{i}\n" * 10 for i in range(8)])
    assert lines.first_lines(spark, tmp_dir, 15).select(lines.FILE).distinct().count() == 2
    assert len(lines.first_lines(spark, tmp_dir, 15).inputFiles()) == 3


@pytest.mark.parametrize("n", [0, 1, 333, 999, 1000, 1001])
def test_row_cap_is_exact_and_stays_in_partitions(spark, tmp_dir, n):
    path = os.path.join(tmp_dir, "t.parquet")
    spark.range(1000).repartition(7).write.parquet(path)
    was = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        got = lines.row_cap(spark.read.parquet(path), n)
        ids = sorted(r["id"] for r in got.collect())
        assert len(ids) == len(set(ids)) == min(n, 1000)
        assert ids == sorted(r["id"] for r in lines.row_cap(spark.read.parquet(path), n).collect())
        assert n < 333 or got.rdd.getNumPartitions() > 1
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", was)


GOOD = '{"_id": "%d", "product_name": "p", "nutriments": {"energy_100g": %d}}'


def test_first_lines_and_caps_of_the_readers(spark, tmp_dir):
    _files(tmp_dir, GOOD % (1, 1) + "\n\nbroken{\n" + GOOD % (2, 2) + "\n", GOOD % (3, 3) + "\n")
    read = lambda **part: readers.load_products(spark, tmp_dir, fmt="json", measures=("energy_100g",), descriptive=("_id",), **part)
    assert sorted(r["_id"] for r in read().collect()) == ["1", "2", "3"]
    assert sorted(r["_id"] for r in read(first_lines=4).collect()) == ["1", "2"]
    assert read(first_lines=3, keep_corrupt=True).count() == 2
    assert read(max_rows=3, keep_corrupt=True).count() == 3
    with pytest.raises(ValueError):
        readers.load_products(spark, tmp_dir, fmt="delimited", first_lines=3)


def test_caps_of_delimited_files_and_ingest(spark, tmp_dir):
    src = os.path.join(tmp_dir, "p.tsv")
    with open(src, "w") as fh:
        fh.write("code\tenergy_100g\tproteins_100g\tfat_100g\tsalt_100g\tsodium_100g\n")
        fh.writelines(f"{i}\t1\t2\t3\t4\t5\n" for i in range(50))
    sink = os.path.join(tmp_dir, "clean.parquet")
    clean, counts = ingest(spark, src, sink, CleanConfig(), max_rows=20)
    assert clean.count() == 20 == counts["rows_in"]
    # another part of the source is another table
    assert ingest(spark, src, sink, CleanConfig())[1]["rows_in"] == 50
    assert ingest(spark, src, sink, CleanConfig())[1]["rows_in"] is None


def test_quarantine_keeps_file_line_and_text(spark, tmp_dir):
    src, sink = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "split")
    os.mkdir(src)
    _files(src, "\n" + GOOD % (1, 1) + "\nbad one\n" + GOOD % (2, 2) + "\n{\"_id\": \n", GOOD % (3, 3) + "\n\n\nbad two")
    with gzip.open(os.path.join(src, "part-9.txt.gz"), "wt") as fh:
        fh.write("bad three\n")
    schema = readers.nested_schema(("_id", "product_name"), "nutriments", ("energy_100g",))
    good, bad = readers.quarantine_json(spark, src, schema, sink)
    assert sorted(r["_id"] for r in good.collect()) == ["1", "2", "3"] and good.columns == schema.names
    got = sorted((os.path.basename(r["file"]), r["line"], r["number"], r["text"]) for r in bad.collect())
    assert got == [
        ("part-0.txt", 3, 3, "bad one"), ("part-0.txt", 5, 5, '{"_id": '), ("part-1.txt", 4, 9, "bad two"),
        ("part-9.txt.gz", 1, 10, "bad three"),
    ]
    assert good.where("nutriments.energy_100g = '2'").count() == 1
    empty = os.path.join(tmp_dir, "none.txt")
    open(empty, "w").close()
    good, bad = readers.quarantine_json(spark, empty, schema, sink)
    assert good.count() == bad.count() == 0


def test_quarantine_neither_sorts_nor_moves_rows(spark, tmp_dir, monkeypatch):
    from pyspark.sql import DataFrameWriter

    src, sink, plans = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "split"), []
    os.mkdir(src)
    _files(src, *[(GOOD % (i, i) + "\nbad %d\n" % i) * 20 for i in range(3)])
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *a: pytest.fail("rows sorted by a partition column"))
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: plans.append(self._df._jdf.queryExecution().executedPlan().toString()) or write(self, *a, **b))
    schema = readers.nested_schema(("_id", "product_name"), "nutriments", ("energy_100g",))
    good, bad = readers.quarantine_json(spark, src, schema, sink)
    assert plans and "Sort" not in plans[0] and "Exchange" not in plans[0]
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert good.count() == 60 and sorted(r["number"] for r in bad.collect()) == list(range(2, 121, 2))
    assert not [f for f in os.listdir(sink) if os.path.isdir(os.path.join(sink, f))]


def test_headers_come_from_tasks(spark, tmp_dir):
    for i in range(12):
        with open(os.path.join(tmp_dir, f"a {i}.csv"), "w") as fh:
            fh.write(("﻿" if i == 3 else "") + "code,m1\n" + f"{i},{i}\n" * 2000)
    assert readers.header_lines(spark, tmp_dir) == ["code,m1"]
    df = readers.read_delimited(spark, tmp_dir, ("m1",), {"code": "_id"})
    assert len(df.collect()) == 24_000 and df.columns == ["_id", "m1"]
    with open(os.path.join(tmp_dir, "z.csv"), "w") as fh:
        fh.write("m1\tm2\tcode\n7\t8\tz\n")
    assert {h: len(f) for h, f in readers.files_by_header(spark, tmp_dir).items()} == {"code,m1": 12, "m1\tm2\tcode": 1}
    rows = readers.read_delimited(spark, tmp_dir, ("m1", "m2"), {"code": "_id"}).where("_id = 'z'").collect()
    assert [r.asDict() for r in rows] == [{"_id": "z", "m1": "7", "m2": "8"}]


@pytest.fixture()
def small_files(spark, monkeypatch):
    """Files of 500 rows; the numbers of rows in each file a query wrote."""
    from conftest import SF_SMALL

    from tessera.plans import catalog

    paths, scratch = [], catalog.scratch_path
    monkeypatch.setattr(catalog, "FILE_ROWS", 500, raising=False)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: paths.append(scratch(spark, name)) or paths[-1])
    return catalog.QUERIES, SF_SMALL, lambda read: [r["count"] for r in read(paths[0]).groupBy("_metadata.file_path").count().collect()]


def test_sorted_export_has_more_files_for_more_rows(spark, small_files):
    queries, sf, sizes = small_files
    got = queries["first_lines"](spark, sf)
    rows = sizes(spark.read.text)
    assert got.count() == sum(rows) == spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert len(rows) > 8 and max(rows) < 1500


def test_quarantine_numbers_go_on_over_more_files(spark, small_files):
    queries, sf, sizes = small_files
    got = sorted(queries["json_quarantine"](spark, sf).collect())
    li = spark.read.parquet(f"{sf}/lineitem.parquet").orderBy("l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber")
    wanted = [(i, "{broken %d-%d" % tuple(r)) for i, r in enumerate(li.collect(), 1) if r["l_orderkey"] % 17 == 0]
    assert [(r["number"], r["text"]) for r in got] == wanted and len(sizes(spark.read.text)) > 8


def test_row_cap_counts_no_more_rows_than_it_took(spark, small_files, monkeypatch):
    from tessera.plans import catalog

    queries, sf, sizes = small_files
    monkeypatch.setattr(catalog, "ROWS_WANTED", 70)
    got = queries["row_cap"](spark, sf)
    assert tuple(got.first()) == (70, 70) and len(sizes(spark.read.parquet)) > 8
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()

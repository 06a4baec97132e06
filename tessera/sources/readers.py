"""Readers: nested JSON lines, delimited text, Parquet, and format dispatch.

Schemas are always declared. Identifiers and measures are read as strings
(leading zeros survive; malformed numbers become null through ``try_cast``
later), so no inference pass scans the data first. Nothing is capped unless the
caller asks for it (``first_lines``, ``max_rows``).
"""

from __future__ import annotations

import csv
import itertools
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.config import (
    PRODUCT_DELIMITED_RENAMES,
    PRODUCT_DESCRIPTIVE_COLUMNS,
    PRODUCT_MEASURE_COLUMNS,
    PRODUCT_MEASURE_STRUCT,
)
from tessera.operators.quality import flatten_struct
from tessera.sources import lines, sinks

CORRUPT_COL = "_corrupt_record"
DELIMITERS = ("\t", ",")
BOM = "\ufeff"


def nested_schema(
    descriptive: Sequence[str] = PRODUCT_DESCRIPTIVE_COLUMNS,
    struct_name: str = PRODUCT_MEASURE_STRUCT,
    measures: Sequence[str] = PRODUCT_MEASURE_COLUMNS,
) -> StructType:
    """Flat string descriptors + one struct of string measures."""
    fields = [StructField(c, StringType()) for c in descriptive]
    fields.append(StructField(struct_name, StructType([StructField(m, StringType()) for m in measures])))
    return StructType(fields)


def read_json(
    spark: SparkSession, path: str, schema: StructType, keep_corrupt: bool = False, first_lines: int | None = None
) -> DataFrame:
    """JSON lines with a declared schema, PERMISSIVE mode.

    Blank lines are skipped by the reader; a malformed line becomes one row
    with the raw text in ``_corrupt_record``. Those rows are dropped unless
    ``keep_corrupt``; the job counts them on its one pass. With ``first_lines`` only
    that many lines of the files are read, blank and malformed ones counted.
    """
    if first_lines is not None:
        df = parse_json_lines(lines.first_lines(spark, path, first_lines), schema).drop(lines.FILE, lines.BLOCK, lines.PLACE)
        return df if keep_corrupt else drop_corrupt(df)
    full = StructType(list(schema.fields) + [StructField(CORRUPT_COL, StringType())])
    df = (
        spark.read.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .json(path)
    )
    return df if keep_corrupt else drop_corrupt(df)


def parse_json_lines(text: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` and ``_corrupt_record`` from lines with their places; blank ones are skipped."""
    full = StructType(list(schema.fields) + [StructField(CORRUPT_COL, StringType())])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    some = text.where(F.trim("value") != "")
    return some.select(parsed.alias("_row"), lines.FILE, lines.BLOCK, lines.PLACE).select(
        "_row.*", lines.FILE, lines.BLOCK, lines.PLACE
    )


def quarantine_json(spark: SparkSession, path: str, schema: StructType, sink: str) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows and malformed lines of JSON files, from one pass that writes both at ``sink``, as they come:
    one table, parted when it is read, so that no task sorts the rows of its split.

    The first frame has the columns of ``schema``; the second ``file``, ``line`` (in the file), ``number``
    (over all files in the order of their names) and ``text`` of every malformed line.
    """
    text = lines.text_lines(spark, path)
    marked = parse_json_lines(text, schema)
    sinks.write_parquet(marked, sink)
    both = spark.read.schema(marked.schema).parquet(sink)
    whole = F.col(CORRUPT_COL).isNull()
    good = both.where(whole).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    bad = both.where(~whole).select(lines.FILE, lines.BLOCK, lines.PLACE, F.col(CORRUPT_COL).alias("text"))
    numbered = lines.with_line_numbers(bad, text).withColumnRenamed(lines.FILE, "file")
    return good, numbered.select("file", "line", "number", "text")


def drop_corrupt(df: DataFrame) -> DataFrame:
    """Without the rows a reader marked as malformed, and without the mark."""
    return df.filter(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)


def header_lines(spark: SparkSession, path: str) -> list[str]:
    """The distinct first lines of the files of ``path``. Tasks read them, one line of each
    file; what reaches the driver is one line for each layout."""
    whole = {"mapreduce.input.fileinputformat.split.minsize": str((1 << 63) - 1), "mapreduce.input.fileinputformat.input.dir.recursive": "true"}
    firsts = spark.sparkContext.newAPIHadoopFile(
        path,
        "org.apache.hadoop.mapreduce.lib.input.TextInputFormat",
        "org.apache.hadoop.io.LongWritable",
        "org.apache.hadoop.io.Text",
        conf=whole,
    ).mapPartitions(lambda rows: (line for _, line in itertools.islice(rows, 1)))
    found = sorted({h for h in (line.removeprefix(BOM) for line in firsts.distinct().collect()) if h})
    if not found:
        raise ValueError(f"no header line in {path}")
    return found


def files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Names of the files of each layout, for folders that hold several."""
    text = lines.text_lines(spark, path).where(F.col(lines.BLOCK) == 0)
    firsts = text.groupBy(lines.FILE).agg(F.min_by("value", lines.PLACE).alias("header"))
    jvm = spark.sparkContext._jvm
    groups: dict[str, list[str]] = {}
    for r in firsts.collect():
        if header := r["header"].removeprefix(BOM):
            groups.setdefault(header, []).append(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r[lines.FILE])).toString())
    return groups


def split_header(header: str, sep: str) -> list[str]:
    """Column names of a header line, quoted ones included."""
    return [name.strip() for name in next(csv.reader([header], delimiter=sep))]


def choose_delimiter(header: str, expected: Sequence[str], candidates: Sequence[str] = DELIMITERS) -> str:
    """The candidate whose split of the header yields the most expected names.

    A wrong separator raises nothing in Spark (the whole line becomes one
    column), so the choice is made from the header rather than from errors.
    Where no candidate yields an expected name, this raises.
    """
    wanted = set(expected)
    found = {sep: len(wanted.intersection(split_header(header, sep))) for sep in candidates}
    best = max(candidates, key=lambda sep: found[sep])
    if wanted and not found[best]:
        raise ValueError(f"no separator of {list(candidates)} yields an expected column name: {header[:200]!r}")
    return best


def read_delimited(
    spark: SparkSession,
    path: str,
    expected: Sequence[str] = (),
    renames: Mapping[str, str] | None = None,
    sep: str | None = None,
    keep_corrupt: bool = False,
    max_rows: int | None = None,
) -> DataFrame:
    """Header-first delimited text, every column as string, then renamed.

    The header of each file picks its separator when ``sep`` is None and names
    its string schema, so no inference pass is needed and files of one folder
    may order their columns differently; they are united by name. Tasks read the headers; a
    folder of one layout is scanned as a folder, without a list of its files. Rows with too
    many or too few fields are dropped, or marked in ``_corrupt_record`` with
    ``keep_corrupt``. ``max_rows``: exactly so many rows, malformed ones counted.
    """
    renames = dict(renames or {})
    headers = header_lines(spark, path)
    places = {headers[0]: path} if len(headers) == 1 else files_by_header(spark, path)
    frames = []
    for header in headers:
        chosen = sep or choose_delimiter(header, list(expected) + list(renames))
        names = split_header(header, chosen)
        schema = StructType([StructField(n, StringType()) for n in [*names, CORRUPT_COL]])
        df = (
            spark.read.schema(schema)
            .option("header", True)
            .option("sep", chosen)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL)
            .csv(places[header])
        )
        live = {o: n for o, n in renames.items() if o in names and o != n}
        frames.append(df.withColumnsRenamed(live) if live else df)
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    out = out.select(*[F.col(f"`{c}`") for c in out.columns if c != CORRUPT_COL], CORRUPT_COL)
    if max_rows is not None:
        out = lines.row_cap(out, max_rows)
    return out if keep_corrupt else drop_corrupt(out)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


COMPRESSION_SUFFIXES = (".gz", ".bz2", ".zst", ".zstd", ".snappy", ".deflate", ".lz4", ".xz")


def detect_format(path: str) -> str:
    """Format from the extension; a compression suffix Spark decodes on read
    (``products.json.gz``) is looked through."""
    name = path.rstrip("/").lower()
    for suffix in COMPRESSION_SUFFIXES:
        if name.endswith(suffix):
            name = name[: -len(suffix)]
            break
    for ext, fmt in (
        (".jsonl", "json"), (".ndjson", "json"), (".json", "json"),
        (".csv", "delimited"), (".tsv", "delimited"), (".txt", "delimited"),
        (".parquet", "parquet"),
    ):
        if name.endswith(ext):
            return fmt
    raise ValueError(f"Unsupported file format: {path}")


def load_products(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    measures: Sequence[str] = PRODUCT_MEASURE_COLUMNS,
    descriptive: Sequence[str] = PRODUCT_DESCRIPTIVE_COLUMNS,
    struct_name: str = PRODUCT_MEASURE_STRUCT,
    renames: Mapping[str, str] = PRODUCT_DELIMITED_RENAMES,
    keep_corrupt: bool = False,
    first_lines: int | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Flat raw catalogue from any format: descriptors + measures (strings).
    With ``keep_corrupt`` malformed rows stay, marked in ``_corrupt_record``
    (null for all rows of a Parquet table). Two ways to take part of a source, off
    unless asked for: ``first_lines`` (JSON lines only) and ``max_rows`` (exactly so many
    rows as they lie in the files' splits; malformed rows count)."""
    fmt = fmt or detect_format(path)
    if first_lines is not None and fmt != "json":
        raise ValueError("first_lines is for JSON lines; use max_rows")
    if fmt == "json":
        raw = read_json(spark, path, nested_schema(descriptive, struct_name, measures), True, first_lines)
        raw = raw if max_rows is None else lines.row_cap(raw, max_rows)
        raw = raw if keep_corrupt else drop_corrupt(raw)
        extra = [CORRUPT_COL] if keep_corrupt else []
        return flatten_struct(raw, struct_name, measures, keep=[*descriptive, *extra])
    if fmt in ("delimited", "csv", "tsv"):
        return read_delimited(spark, path, list(descriptive) + list(measures), renames, keep_corrupt=keep_corrupt, max_rows=max_rows)
    if fmt == "parquet":
        table = spark.read.parquet(path)
        table = table if max_rows is None else lines.row_cap(table, max_rows)
        return table.withColumn(CORRUPT_COL, F.lit(None).cast("string")) if keep_corrupt else table
    raise ValueError(f"Unsupported file format: {fmt}")

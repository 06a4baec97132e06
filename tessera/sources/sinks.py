"""Sinks: Parquet, materialise-once, model and report writers.

Paths may be any Hadoop URI; existence checks go through the Hadoop
FileSystem of the session, never the local disk.
"""

from __future__ import annotations

import contextlib
import itertools
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession


#: Bytes of one row group: only whole ones go to a task, so that with small ones a table that few tasks wrote is
#: read by all cores again.
ROW_GROUP_BYTES = 4 << 20


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return bool(files.exists(place))


def modified(spark: SparkSession, path: str) -> int:
    """When a file was written, in milliseconds."""
    place, files = _place(spark, path)
    return files.getFileStatus(place).getModificationTime()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, replacing any at ``path``: written beside and renamed, so a
    reader sees the old text or the new one."""
    place, files = _place(spark, path)
    beside, _ = _place(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(beside, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    options = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
    _rename(spark, beside, place, options.OVERWRITE)


def _rename(spark: SparkSession, source, target, *options) -> None:
    """Rename that fails where ``target`` exists, unless told to overwrite (a file)."""
    sc = spark.sparkContext
    jvm = sc._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        source.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(source).toUri(), sc._jsc.hadoopConfiguration()
    )
    given = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, len(options))
    for i, option in enumerate(options):
        given[i] = option
    context.rename(source, target, given)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, None where there is none."""
    place, files = _place(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


#: Renames a commit tries while other writers commit to the same place.
RENAME_ATTEMPTS = 50
#: The commit mark of a materialised table: its name begins with "_", so readers of the folder skip it.
COMMIT_MARK = "_tessera_commit"


def committed_key(spark: SparkSession, path: str) -> str | None:
    """The key of the completed table at ``path``, None where there is none."""
    return read_text(spark, f"{path.rstrip('/')}/{COMMIT_MARK}")


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], key: str = "", rebuild: bool = False
) -> DataFrame:
    """Read the table at ``path`` if a completed write of the same ``key`` exists,
    else build, write and read it back.

    The table is written beside ``path``; the commit mark with ``key`` (the parameters of the table) lies
    inside it, and one rename puts both in place. So there is never a new table with an old key, a
    half-written one is never read, and of two writers each commits a whole table of its own
    (the later one stays; files never mix). An older table is moved aside first and then deleted.
    """
    path = path.rstrip("/")
    if rebuild or committed_key(spark, path) != key:
        commit_table(build(), path, key)
    return spark.read.parquet(path)


def commit_table(df: DataFrame, path: str, key: str) -> None:
    """Write ``df`` beside ``path`` with its commit mark and rename it into place."""
    spark = df.sparkSession
    run = uuid.uuid4().hex
    staged, files = _place(spark, f"{path}.{run}.new")
    target, _ = _place(spark, path)
    write_parquet(df, staged.toString(), mode="error")
    write_text(spark, f"{staged.toString()}/{COMMIT_MARK}", key)
    for attempt in itertools.count(1):
        try:
            _rename(spark, staged, target)
            return
        except Py4JJavaError:
            # the target may have been moved aside by another writer since: try again, not for ever
            if attempt == RENAME_ATTEMPTS or not files.exists(staged):
                raise
        aside, _ = _place(spark, f"{path}.{uuid.uuid4().hex}.old")
        # another writer may move it first: then there is nothing to move, and the next rename tells
        with contextlib.suppress(Py4JJavaError):
            _rename(spark, target, aside)
            files.delete(aside, True)


def save_model(model: KMeansModel, path: str) -> None:
    """Save, replacing any model already at ``path``."""
    model.write().overwrite().save(path)


def load_kmeans(path: str) -> KMeansModel:
    return KMeansModel.load(path)


def write_report(report: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a (small) report frame; one file since it has one row per cluster."""
    report.coalesce(1).write.mode("overwrite").format(fmt).save(path)

"""Session helpers: the shared folder, scratch tables, cut lineage.

Intermediate tables and checkpoints lie under the folder the cluster names in
``spark.checkpoint.dir``. Nothing here invents another place: without that
setting a job that needs the folder raises. Entry points for tests and local
runs set it themselves (:func:`use_checkpoint_dir`), and only where it is unset.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of this application; raises where none is named."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get(CHECKPOINT_CONF, None)
        if not configured:
            raise RuntimeError(f"{CHECKPOINT_CONF} is unset; it must name a folder all executors share")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def use_checkpoint_dir(spark: SparkSession, folder: str) -> None:
    """Name the shared folder of a session that has none yet."""
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get(CHECKPOINT_CONF, None):
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the shared folder."""
    return f"{checkpoint_dir(spark)}/scratch/{uuid.uuid4().hex}/{name}"


def write_shared(spark: SparkSession, data: bytes, name: str) -> str:
    """Write bytes to a new file of the shared scratch folder through Spark's file
    systems; returns its address. The file name is unique."""
    folder, _, _ = scratch_path(spark, name).rpartition("/")
    target = f"{folder}/{folder.rsplit('/', 1)[-1]}-{name}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place)
    try:
        out.write(data)
    finally:
        out.close()
    return place.toUri().toString()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once an application, so
    that they need no installation of it."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent).as_posix())
    spark.sparkContext.addPyFile(write_shared(spark, data.getvalue(), "package.zip"))
    _shipped.add(application)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables, once nothing reads them any more."""
    remove_path(spark, f"{checkpoint_dir(spark)}/scratch")


def remove_path(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its source has fewer splits than there are cores (a small or
    unsplittable file); a larger source is left as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def persist_frame(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, eager: bool = True
) -> DataFrame:
    """Persist (eagerly unless told otherwise). For frames whose lineage back to
    a written table is a short chain of narrow steps: a lost block is
    recomputed from that table."""
    out = df.persist(level)
    if eager:
        out.count()
    return out


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the shared folder, so later passes neither recompute
    nor depend on what came before."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(
    advisory_partition_bytes: str = "256m", max_partition_bytes: str = "256m", shuffle_partitions: int = 4000
) -> dict[str, str]:
    """Settings this library is designed for on a large cluster (apply them to
    the session builder or ``spark-submit``); AQE coalesces the initial
    partition count where a shuffle is small."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": advisory_partition_bytes,
        "spark.sql.files.maxPartitionBytes": max_partition_bytes,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.python.worker.reuse": "true",
    }


def local_session(cpus: int | str, checkpoint_folder: str, app: str = "tessera", **conf: str) -> SparkSession:
    """A local session for tests, bench and scripts."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_checkpoint_dir(spark, checkpoint_folder)
    return spark

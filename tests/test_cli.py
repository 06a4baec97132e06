import json
import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tessera import cli
from tessera.config import PRODUCT_MEASURE_COLUMNS, JobConfig


def test_cli_runs_the_whole_job_on_a_json_catalogue(spark, tmp_dir):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    measures = [F.col(c).cast("string") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    extra = [F.lit(None).cast("string")] * (len(PRODUCT_MEASURE_COLUMNS) - 4)
    nested = li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("_id"),
        F.col("l_returnflag").alias("product_name"),
        F.struct(*[m.alias(n) for m, n in zip(measures + extra, PRODUCT_MEASURE_COLUMNS)]).alias("nutriments"),
    )
    # Five measures present in each row: four from lineitem plus a constant one.
    nested = nested.withColumn("nutriments", F.col("nutriments").withField("fiber_100g", F.lit("1.5")))
    src = os.path.join(tmp_dir, "products.json")
    nested.write.json(src)
    work = os.path.join(tmp_dir, "run")
    summary = cli.main(["--source", src, "--format", "json", "--work-dir", work], spark, JobConfig(partitions=4))
    assert summary["rows"]["rows_clean"] > 0 and summary["k"] >= 4
    assert os.path.exists(os.path.join(work, "model", "metadata"))
    report = spark.read.json(os.path.join(work, "report.json"))
    assert report.agg(F.sum("size")).first()[0] == summary["rows"]["rows_prepared"]
    assert spark.read.json(os.path.join(work, "sweep.json")).count() == 14
    assert spark.read.parquet(os.path.join(work, "pca_points.parquet")).count() == summary["rows"]["rows_prepared"]
    predictions = spark.read.parquet(os.path.join(work, "predictions.parquet"))
    assert predictions.where("_id IS NOT NULL").count() == summary["rows"]["rows_prepared"]
    assert {*PRODUCT_MEASURE_COLUMNS, "features", "scaled_features", "prediction"} <= set(predictions.columns)
    assert spark.read.json(os.path.join(work, "summary.json")).count() == len(PRODUCT_MEASURE_COLUMNS)
    assert spark.read.json(os.path.join(work, "preview.json")).count() == 20
    json.dumps(summary)

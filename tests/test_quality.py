import math

from pyspark.sql import functions as F

from tessera.config import CleanConfig
from tessera.operators import quality

COLS = ("a", "b", "c", "d", "e", "f", "g", "h", "i")


def _frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLS))


def test_threshold_edge_four_dropped_five_kept(spark):
    nan, none = float("nan"), None
    four = (1.0, 2.0, 3.0, 4.0, none, none, nan, nan, none)
    five = (1.0, 2.0, 3.0, 4.0, 5.0, none, nan, nan, none)
    df = _frame(spark, [four, five])
    kept = quality.filter_min_valid(df, COLS, 5).collect()
    assert len(kept) == 1 and kept[0]["e"] == 5.0


def test_nan_and_null_both_invalid_and_imputed(spark):
    df = _frame(spark, [(float("nan"), None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)])
    assert quality.with_valid_count(df, COLS).first()["n_valid"] == 7
    row = quality.impute_columns(df, COLS).first()
    assert row["a"] == 0.0 and row["b"] == 0.0


def test_infinity_and_negative_are_valid(spark):
    df = _frame(spark, [(float("inf"), -1.0, None, None, None, None, None, None, None)])
    assert quality.with_valid_count(df, COLS).first()["n_valid"] == 2
    out = quality.impute_columns(df, COLS).first()
    assert math.isinf(out["a"]) and out["b"] == -1.0


def test_clean_table_output_has_no_gaps_and_fixed_order(spark):
    df = spark.createDataFrame([("x", "1", "2", "3", "4", "5", "junk", None, "NaN", "9")],
                               "name string, " + ", ".join(f"{c} string" for c in COLS))
    out = quality.clean_table(df, CleanConfig(measure_cols=COLS, descriptive_cols=("_id", "name"), min_valid=5))
    assert out.columns == ["_id", "name", *COLS]
    row = out.first()
    assert row["_id"] is None and row["f"] == 0.0 and row["h"] == 0.0 and row["i"] == 9.0
    assert all(t == "double" for c, t in out.dtypes if c in COLS)


def test_rename_ignores_absent_and_add_missing_is_typed(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = quality.add_missing_columns(quality.rename_columns(df, {"a": "x", "zz": "y"}), ["x", "w"], "double")
    assert out.dtypes == [("x", "int"), ("w", "double")]


def test_flatten_struct_skips_missing_fields(spark):
    df = spark.createDataFrame([("1", (2.0, 3.0))], "id string, s struct<p:double, `q-r`:double>")
    out = quality.flatten_struct(df, "s", ["p", "q-r", "absent"], keep=["id"])
    assert out.columns == ["id", "p", "q-r"]
    assert out.select(F.col("`q-r`")).first()[0] == 3.0

import importlib

import duckdb
import pytest

from conftest import SF_SMALL

from tessera.plans.catalog import QUERIES
from tessera.plans.oracle import ORACLE

entry = importlib.import_module("__spark_entry__")

TABLES = "lineitem embeddings documents events".split()
FAST_KEYS = [
    "parquet_scan", "impute_zero", "validity_count", "json_nested_scan", "csv_tab_scan", "csv_comma_scan",
    "outlier_trim", "summary_stats", "word_count", "assign_nearest", "silhouette", "choose_k", "cov_matrix",
    "format_stats", "cast_clean", "preview", "plain_format", "cluster_filter", "kmeans_fit", "model_roundtrip",
    "pca_points", "stage_counts", "first_lines", "row_cap", "json_quarantine", "wssse", "cluster_minmax",
]


def test_oracle_keys_are_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _rows(rows):
    def norm(v):
        return round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(norm(v) for v in r) for r in rows), key=str)


@pytest.mark.parametrize("key", FAST_KEYS)
def test_query_matches_oracle_small(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    order = [df.columns.index(c) for c in ocols]
    got = [tuple(r[i] for i in order) for r in df.collect()]
    assert _rows(got) == _rows(orows)

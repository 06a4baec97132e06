"""Documents to packed training sequences, in five stages.

Each stage reads what the one before it kept and returns the columns of
``documents``; the last returns the packed pieces. ``run`` writes every stage to
the shared scratch folder as Parquet and reads it again, so a lost executor
costs at most one stage's tasks.

Defined results, for every stage: a null text counts as an empty one, which is not
toxic unless most labels are, groups with other texts without words, holds no item and no secret, and is
packed as the end id alone; a null id is a document like others, but never stands for its group while
another does; rows that repeat are documents of their own until near-duplicates go, of which one
row stays; texts are read whole, however long; of equal ids in a group one row stays;
other columns are passed on as they are, whatever their names, up to the last
stage; an empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, nnls_packing, secret_scan, simhash_dedup, toxicity
from tessera.llm.common import stored, table
from tessera.llm.queries import packed_rows, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group stays."""
    return simhash_dedup.one_of_each_group(docs, shingle=3, distance=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; every document stays."""
    return secret_scan.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 1024 tokens: each piece with its ids
    (little-endian unsigned 32-bit), its sequence and its place there."""
    return packed_rows(nnls_packing.tokenize(docs, tokenizer_path()), with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack),
]

#: SQL has no simhash, learned lexicon or tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs

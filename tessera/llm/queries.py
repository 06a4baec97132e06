"""Registered queries of the operators and the pipeline, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    ann_collision,
    chat_trees,
    curriculum_mix,
    decontaminate,
    jump_shard,
    language_id,
    merkle_manifest,
    nnls_packing,
    secret_scan,
    simhash_dedup,
    spelling_variants,
    toxicity,
    url_filter,
)
from tessera.llm.common import table

# The probe conversation and the rules of the contract.
PROBE_ID = -7
PROBE_TEXT = r"\### Assistant: </turn> ok"
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    messages = chat_trees.chain_messages(turns.unionByName(probe), "conv_id", "turn", "role", "text")
    chats = chat_trees.format_branches(messages)
    return chats.select(F.col("tree").alias("conv_id"), chat_trees.conversation_digest(F.col("formatted"), F.col("loss_spans")).alias("d")).select("conv_id", "d.*")


def op3_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_collision.nearest_neighbours(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select(F.col("page.page_id").alias("page_id"), "host", "path", "rule", "verdict")


def op5_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = nnls_packing.tokenize(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed_rows(pieces)


def packed_rows(pieces: DataFrame, with_ids: bool = False) -> DataFrame:
    ids = ["ids"] if with_ids else []
    narrow = pieces.select("doc_id", "piece", "start", "length", nnls_packing.ids_crc32(F.col("ids")).alias("ids_crc32"), *ids, "part", "number")
    return nnls_packing.place(narrow).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *ids)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_scan.secret_digest(F.col("text")).alias("d"))
    return found.select("doc_id", "d.*")


def op8_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = jump_shard.assign_shards(table(spark, sf_dir, "documents"), shards=8)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op11_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum_mix.mix(table(spark, sf_dir, "documents"))
    # a projection, so the range-sorted order stays
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.size("copies").alias("copies"), F.round("position", 6).alias("position"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # The contract's columns and tampering.
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = merkle_manifest.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text"))
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, tampered)
    checked = merkle_manifest.verify(merkle_manifest.merkle_manifest(docs, claimed=claimed))
    return checked.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_chat_formatting,
        op3_collision_neighbours,
        op4_url_filter,
        op5_pattern_packing,
        op6_benchmark_decontamination,
        op7_secret_scan,
        op8_jump_sharding,
        op9_toxicity,
        op10_language_id,
        op11_curriculum_mix,
        op12_spelling_variants,
        op13_merkle_manifest,
    )
}

ORACLE = {
    "op2_chat_formatting": rf"""
        WITH turns AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -7, 0, 'user', '{PROBE_TEXT}'
          UNION ALL SELECT -7, 1, 'assistant', '{PROBE_TEXT}')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
               CAST(sum(length(regexp_replace(role, '[\\#<:]', 'xx', 'g'))
                        + length(regexp_replace(text, '[\\#<]', 'xx', 'g')) + 14) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op4_url_filter": """
        WITH parts AS (
          SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        split AS (
          SELECT page_id,
                 translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
        ruled AS (
          SELECT *, CASE
            WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM split)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled""",
    "op11_curriculum_mix": r"""
        WITH d AS (
          SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                 md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                     (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS plan FROM d GROUP BY source),
        w AS (SELECT *, CASE plan WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
        r AS (SELECT *, 2.0::DOUBLE * source_size / weight AS full_at FROM w),
        l AS (SELECT full_at, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * (sum(source_size) OVER up - source_size))
                     / (sum(weight) OVER () - sum(weight) OVER up + weight) AS level
              FROM r WINDOW up AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        level AS (SELECT coalesce(arg_min(level, full_at), 0.0) AS level FROM l WHERE level <= full_at),
        t AS (SELECT source, source_size, plan, least(weight * (SELECT level FROM level), 2.0::DOUBLE * source_size) AS target FROM w),
        o AS (SELECT d.*, t.source_size, t.plan, t.target, CAST(floor(t.target) AS BIGINT) AS whole,
                     CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS BIGINT) AS start
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        c AS (SELECT *, greatest(0, least(size, whole - start)) AS first, greatest(0, least(size, whole - start - source_size)) AS second,
                     start / target AS share FROM o)
        SELECT doc_id, size, source_size, target, CAST(first + second AS BIGINT) AS taken,
               CAST((first > 0)::INT + (second > 0)::INT AS INTEGER) AS copies,
               CASE WHEN first = 0 THEN NULL
                    WHEN plan = 0 THEN round(2 * 3 * share / (4 + sqrt(16 - 4 * 3 * share)), 6)
                    WHEN plan = 1 THEN round(2 * share / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2 * share)), 6)
                    ELSE round(2 * 2 * share / (2 + sqrt(4::DOUBLE)), 6) END AS position FROM c""",
}

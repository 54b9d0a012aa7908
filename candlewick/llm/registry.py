"""The named queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cover_tree, decontamination, lines, minhash, packing, quality, sharding, token_files, toxicity, url_filter
from .shared import read


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    net = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    out = toxicity.score_documents(docs, net)
    held = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out")
    return out.select("doc_id", held, "score", "predicted")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), size=3, percent=85)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("lines_before").cast("long").alias("lines_before"), F.col("lines_dropped").cast("long").alias("lines_dropped"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, shards = token_files.write_tokens(read(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)
    return token_files.read_tokens(spark, path, shards)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(read(spark, sf_dir, "embeddings"), similarity=0.9)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"), weights=[1.0] * 16)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs))


#: The contract's rules (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), RULES)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_embeddings, op3_minhash, op4_line_dedup, op5_token_ids, op6_sharding, op7_decontamination, op8_packing, op9_quality, op10_url_filter)}

SQL: dict[str, str] = {
    "op2_embeddings": cover_tree.ORACLE_SQL,
    "op3_minhash": minhash.ORACLE_SQL,
    "op4_line_dedup": lines.ORACLE_SQL,
    "op6_sharding": sharding.oracle_sql(16),
    "op10_url_filter": url_filter.oracle_sql(RULES),
}

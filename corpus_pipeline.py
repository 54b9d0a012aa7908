"""Cleans ``documents`` stage by stage and packs what is left into training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import decontamination, lines, minhash, packing, quality, registry
from candlewick.llm.shared import new_path, read, scratch, written


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for each row, ``__row``, in the order of doc_id, rows without one last.

    Where doc_ids are all there and differ, they serve; else the numbered rows are written,
    so that the numbers stay the same.
    """
    own = F.col("doc_id").cast("long")
    if docs.groupBy(own.alias("id")).count().where("id is null or count > 1").isEmpty():
        return docs.withColumn("__row", own)
    return written(docs.orderBy(own.asc_nulls_last(), F.xxhash64("text")).withColumn("__row", F.monotonically_increasing_id()), "rows")


def _by_row(rows: DataFrame) -> DataFrame:
    """For operators that go by doc_id: the row's number stands for it, as doc_ids may be null or repeat."""
    return rows.withColumn("doc_id", F.col("__row"))


def _keep(rows: DataFrame, judged: DataFrame, kept: str) -> DataFrame:
    """The rows whose own verdict in ``judged``, of ``_by_row(rows)``, is to be kept."""
    good = judged.where(kept).select(F.col("doc_id").alias("__kept_row"))
    return rows.join(good, F.col("__row") == F.col("__kept_row"), "left_semi").drop("__row")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows whose text scores below 0.5; a null or wordless text scores 0. Ties and repeats are judged each."""
    score = quality.scoring(spark, quality.fit(docs))
    return docs.where(score(F.col("text")) >= 0.5)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines, and a document that loses its last words with them.

    The earliest line is that of the least doc_id; rows without one come last, in the order of
    their texts' hashes, and so do rows that repeat a doc_id. A null text has no lines and stays,
    as does an empty or blank text that lost none. n_chars is counted anew where lines went.
    """
    rows = _keyed(docs)
    out = lines.dedup_lines(_by_row(rows.withColumn("__id", F.col("doc_id")))).withColumn("doc_id", F.col("__id"))
    emptied = (F.col("lines_dropped") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    return out.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.when(F.col("lines_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, that of the least doc_id, of each group of near duplicates; one without doc_id only where no other is.

    Of rows with one doc_id, that of the least text hash. A null or wordless text is no duplicate and stays.
    """
    rows = _keyed(docs)
    return _keep(rows, minhash.near_duplicates(_by_row(rows), size=5, percent=80), "kept")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows whose text holds a benchmark item, each by its own text. A null or empty text holds none; nor does any without items."""
    rows = _keyed(docs)
    return _keep(rows, decontamination.contamination(_by_row(rows), read(spark, sf_dir, "benchmark")), "not contaminated")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each row, as ``packing.pack_documents`` tells; a null or empty text is the end id alone, repeats are packed each."""
    return packing.pack_documents(docs, registry.tokenizer_path(), end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: No SQL: quality scores, signatures, edit matching and tokens have none. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each but the last is written, and what it wrote on the way is removed.

    An empty table goes through as one, and gives no pieces.
    """
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"stage-{name}")
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Rendezvous hashing of stable record keys over weighted shards.

Each shard draws for each key a number from the key and the shard alone, and the key
goes to the shard of the least ``-ln(u) / weight``. So a key moves only to a shard that is
added, or from one that goes, in proportion to the weights. DataFrame functions only.

A slot is a row's place in its shard. Rows are counted by shard and hash bucket, of
which there are 4,096, the counts summed up, and each bucket numbers its own rows; no task
sees a whole shard. The text's checksum is in the bucket's hash, so rows that share a doc_id spread too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _draw(key: Column, shard: Column) -> Column:
    """In (0, 1): 52 bits of MD5 of the key and the shard's number."""
    digits = F.substring(F.md5(F.concat_ws("/", key, shard.cast("string")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def _best(key: Column, weights: list[float], first: int = 0) -> Column:
    """struct(score, shard) of the least score among shards numbered from ``first`` (key: text; null is a key of its own)."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    text = F.coalesce(key.cast("string"), F.lit("null"))
    scored = [F.struct((-F.log(_draw(text, F.lit(i))) / F.lit(float(w))).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights, first)]
    return scored[0] if len(scored) == 1 else F.least(*scored)


def shard_of(key: Column, weights: list[float]) -> Column:
    """The shard number for a key."""
    return _best(key, weights)["shard"]


def assign(docs: DataFrame, weights: list[float], added: float = 1.0) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1, of a null text 1; text_crc32 that of those
    bytes, 0 of none. grown_shard is the shard if one of weight ``added`` joins. Rows that
    repeat a doc_id share its shard and have slots of their own; a null doc_id is a key.
    Within a shard, slots run by bucket, doc_id and checksum. Only doc_id and text are read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    key = F.col("doc_id").cast("string")
    docs = docs.select("doc_id", "text", _best(key, weights).alias("__own"), F.crc32(text).alias("__crc"))
    place = F.substring(F.md5(F.concat_ws("/", F.coalesce(key, F.lit("null")), F.col("__crc").cast("string")).cast("binary")), 1, 3)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.col("__crc").alias("text_crc32"),
        F.col("__own.shard").alias("shard"),
        F.least("__own", _best(key, [added], len(weights)))["shard"].alias("grown_shard"),
        F.conv(place, 16, 10).cast("int").alias("bucket"),
    )
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 4,096 rows
    base = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    out = rows.withColumn("at", F.row_number().over(own)).join(base, ["shard", "bucket"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("base") + F.col("at") - 1).alias("slot"), "grown_shard")


def oracle_sql(shards: int) -> str:
    """The same over ``documents`` with equal weights."""
    draw = lambda k: f"list_transform(range({k}), lambda i: -ln((('0x' || substr(md5(key || '/' || i), 1, 13))::BIGINT::DOUBLE + 0.5) / {1 << 52}))"
    return f"""
WITH crcs AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
 points AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, list_transform(regexp_extract_all(coalesce(text, ''), '(?s).'), lambda x: unicode(x)) AS u FROM documents),
 bytes AS (SELECT doc_id, key, flatten(list_transform(u, lambda x: CASE WHEN x < 128 THEN [x] WHEN x < 2048 THEN [192 + (x >> 6), 128 + x % 64]
    WHEN x < 65536 THEN [224 + (x >> 12), 128 + (x >> 6) % 64, 128 + x % 64] ELSE [240 + (x >> 18), 128 + (x >> 12) % 64, 128 + (x >> 6) % 64, 128 + x % 64] END)) AS b FROM points),
 sums AS (SELECT doc_id, key, len(b) + 1 AS size, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[xor(c % 256, x) + 1])), 4294967295) AS crc, {draw(shards)} AS one, {draw(shards + 1)} AS more FROM bytes, crcs),
 rows AS (SELECT *, list_position(one, list_min(one)) - 1 AS shard, list_position(more, list_min(more)) - 1 AS grown, ('0x' || substr(md5(key || '/' || crc), 1, 3))::INT AS bucket FROM sums)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, crc, size) - 1 AS slot, grown::INT AS grown_shard
FROM rows
"""

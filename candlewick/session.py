"""The session settings that stored candles rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC instants; timestamps that other Parquet readers see as microseconds
#: in UTC; rewriting only the months that a write touches; month directories kept as text.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark


def get_session(app: str = "candlewick", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in (SETTINGS | settings).items():
        builder = builder.config(k, v)
    return configure(builder.getOrCreate())

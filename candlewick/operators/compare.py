"""Comparison of two candle feeds: one full outer join, its totals and bounded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import beyond, relative_difference
from ..schema import PRICES
from .rows import keep_last

SAMPLE = 20
FIELDS = (*PRICES, "volume")


def paired(left: DataFrame, right: DataFrame, order: list[str] | None = None, keys: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """One row for each key of either side: l and r, structs of prices and volume, null where a side lacks it.

    Each side first keeps its last row of a key, which also bounds what a key brings to
    the join. One shuffle of each side serves every figure of a comparison.
    """
    cols = F.struct(*FIELDS)
    side = lambda df, name: keep_last(df.select(*keys, *FIELDS, *(order or [])), order or ["open"], keys).select(*keys, cols.alias(name))
    return side(left, "l").join(side(right, "r"), list(keys), "full")


def with_verdict(pairs: DataFrame, price_tolerance: str, volume_tolerance: str) -> DataFrame:
    """Adds whether a compared candle is off in price or volume, and by how much at most."""
    off = lambda c, tol: beyond(F.col(f"l.{c}"), F.col(f"r.{c}"), tol)
    gap = lambda c: F.abs(F.col(f"l.{c}") - F.col(f"r.{c}"))
    price_off = off("open", price_tolerance)
    for c in PRICES[1:]:
        price_off = price_off | off(c, price_tolerance)
    return pairs.select(
        "*",
        F.col("l").isNull().alias("no_left"),
        F.col("r").isNull().alias("no_right"),
        price_off.alias("price_off"),
        off("volume", volume_tolerance).alias("volume_off"),
        F.greatest(*[gap(c) for c in PRICES]).alias("price_gap"),
        F.greatest(*[relative_difference(F.col(f"l.{c}"), F.col(f"r.{c}")) for c in PRICES]).alias("price_relative"),
        gap("volume").alias("volume_gap"),
    )


def _earliest_max(gap: str) -> F.Column:
    """The greatest value and the earliest stamp that attains it; null where nothing differs."""
    return F.max(F.when(F.col(gap) > 0, F.struct(F.col(gap).alias("gap"), (-F.unix_micros("timestamp")).alias("at"))))


def tally(judged: DataFrame) -> DataFrame:
    """One row of all exact counts and extremes."""
    both = "not no_left and not no_right"
    t = judged.agg(
        F.count_if(F.expr(both)).alias("candles_compared"),
        F.count_if(F.expr(f"{both} and not price_off and not volume_off")).alias("matching_candles"),
        F.count_if("no_left").alias("missing_from_left"),
        F.count_if("no_right").alias("missing_from_right"),
        F.count_if(F.expr(f"{both} and price_off")).alias("price_mismatches"),
        F.count_if(F.expr(f"{both} and volume_off")).alias("volume_mismatches"),
        F.coalesce(F.bool_or(F.expr(f"{both} and (l.volume <> 0 or r.volume <> 0)")), F.lit(False)).alias("volume_available"),
        _earliest_max("price_gap").alias("p"),
        F.max("price_relative").alias("max_price_relative_difference"),
        _earliest_max("volume_gap").alias("v"),
        F.min(F.when(~F.col("no_left"), F.col("timestamp"))).alias("left_start"),
        F.max(F.when(~F.col("no_left"), F.col("timestamp"))).alias("left_end"),
        F.min(F.when(~F.col("no_right"), F.col("timestamp"))).alias("right_start"),
        F.max(F.when(~F.col("no_right"), F.col("timestamp"))).alias("right_end"),
        F.count_distinct(F.date_trunc("month", "timestamp")).alias("partitions_compared"),
    )
    at = lambda c: F.timestamp_micros(-F.col(f"{c}.at"))
    return t.select("*", F.coalesce("p.gap", F.lit(0)).alias("max_price_difference"), at("p").alias("max_price_difference_at"), F.coalesce("v.gap", F.lit(0)).alias("max_volume_difference"), at("v").alias("max_volume_difference_at")).drop("p", "v")


def field_differences(judged: DataFrame, price_tolerance: str, volume_tolerance: str, keys: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """(keys, position, field, left, right, difference, relative_difference) of each field beyond its tolerance."""
    one = lambda i, c, tol: F.when(beyond(F.col(f"l.{c}"), F.col(f"r.{c}"), tol), F.struct(F.lit(i).alias("position"), F.lit(c).alias("field"), F.col(f"l.{c}").cast("decimal(28,8)").alias("left"), F.col(f"r.{c}").cast("decimal(28,8)").alias("right")))
    parts = [one(i, c, volume_tolerance if c == "volume" else price_tolerance) for i, c in enumerate(FIELDS)]
    rows = judged.where("price_off or volume_off").select(*keys, F.explode(F.array_compact(F.array(*parts))).alias("d")).select(*keys, "d.*")
    return rows.withColumn("difference", (F.col("left") - F.col("right")).cast("decimal(28,8)")).withColumn("relative_difference", relative_difference(F.col("left"), F.col("right")))


def first_differences(differences: DataFrame, limit: int = SAMPLE, keys: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """A report's sample: the first by keys, open to volume within a candle."""
    return differences.orderBy(*keys, "position").limit(limit)


def missing(judged: DataFrame, side: str, limit: int = SAMPLE) -> DataFrame:
    """A report's sample of stamps that ``side`` lacks."""
    return judged.where(f"no_{side}").select("timestamp").orderBy("timestamp").limit(limit)

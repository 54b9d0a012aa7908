"""Row-level operators: classify, deduplicate, merge."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import first_violation, in_range


class CandleValidationError(ValueError):
    """A row breaks an OHLC rule."""


def classify(df: DataFrame, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Adds ``in_range`` and ``reason``, the first broken rule of a row in range."""
    return df.withColumn("in_range", in_range(start, end)).withColumn("reason", F.when(F.col("in_range"), first_violation()))


def valid(df: DataFrame) -> DataFrame:
    """Of classified rows those to keep."""
    return df.where("in_range and reason is null").drop("in_range", "reason")


def rejected(df: DataFrame) -> DataFrame:
    """Of classified rows those in range that break a rule."""
    return df.where("in_range and reason is not null").select("timestamp", "symbol", "reason")


def require_valid(df: DataFrame) -> DataFrame:
    bad = df.withColumn("reason", first_violation()).where("reason is not null").orderBy("timestamp").first()
    if bad is not None:
        raise CandleValidationError(f"{bad.symbol} at {bad.timestamp}: {bad.reason}")
    return df


def keep_last(df: DataFrame, order: list[str | Column], keys: tuple[str, ...] = ("symbol", "timestamp")) -> DataFrame:
    """The last row of each key in the given order; of rows equal in it, the greatest by their other columns.

    An aggregate rather than a window: partial results are merged before the shuffle, so
    a key with many repeats never fills a task.
    """
    rest = [c for c in df.columns if c not in keys]
    place = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order], *[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), place).alias("__row"))
    return out.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def merge(stored: DataFrame, incoming: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Both, one row for each symbol and timestamp; an incoming row wins, the later of two incoming ones by ``order``."""
    order = order or []
    a = stored.withColumn("__new", F.lit(0)).select("*", *[F.lit(None).cast(incoming.schema[o].dataType).alias(o) for o in order if o not in stored.columns])
    both = a.unionByName(incoming.withColumn("__new", F.lit(1)))
    return keep_last(both, ["__new", *order]).drop("__new", *order)


def duplicates(df: DataFrame, keys: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """(keys, extra): how often a key repeats beyond once."""
    return df.groupBy(*keys).agg((F.count("*") - 1).alias("extra")).where("extra > 0")


def late(df: DataFrame, group: str, stamp: str = "us") -> DataFrame:
    """Adds ``late``: whether an earlier group (in order, each sorted within) holds a later stamp.

    Per-group maxima and their running maximum are a row for each month, so no window
    spans the rows themselves.
    """
    tops = df.groupBy(group).agg(F.max(stamp).alias("__top"))
    before = Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(group, F.max("__top").over(before).alias("__before"))
    return df.join(tops, group).withColumn("late", F.coalesce(F.col(stamp) < F.col("__before"), F.lit(False))).drop("__before")


def seams(df: DataFrame, group: str, stamp: str = "us") -> DataFrame:
    """(group, unordered): 1 where a group begins before the one before it ends."""
    ends = df.groupBy(group).agg(F.min(stamp).alias("lo"), F.max(stamp).alias("hi"))
    prev = F.lag("hi").over(Window.orderBy(group))  # a row for each group
    return ends.select(group, F.when(F.col("lo") < prev, 1).otherwise(0).alias("unordered"))


def misfiled(df: DataFrame) -> DataFrame:
    """Rows (timestamp, claimed) whose file claims another month than theirs, and whether their own month holds the stamp too.

    Files that name no month (claimed 0) claim nothing.
    """
    own = F.year("timestamp") * 100 + F.month("timestamp")
    away = df.where((F.col("claimed") != 0) & (F.col("claimed") != own))
    home = df.where(F.col("claimed") == own).select("timestamp").distinct().withColumn("also_home", F.lit(True))
    return away.join(home, "timestamp", "left").withColumn("also_home", F.coalesce("also_home", F.lit(False)))

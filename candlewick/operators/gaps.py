"""Missing candles: gaps of a whole feed, and of each trading session.

All stamps are microseconds from the epoch (``us``) and ``k`` is the series. A window is
partitioned by series, session and ``SPAN``; the last stamp of each span, a row a month, is
carried to the next. So a series of any length spreads over tasks. Stamps find their
interval by an equi-join on spans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GAP = "k", "gap_start", "gap_end", "missing"


def _out(df: DataFrame, start: str, end: str, missing: str, where: str = "missing > 0") -> DataFrame:
    return df.select("k", F.expr(start).alias("gap_start"), F.expr(end).alias("gap_end"), F.expr(missing).cast("long").alias("missing")).where(where)


SPAN = 30 * 86_400_000_000


def within(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """rows (us) beside each of the windows (s, e) that they are in, half-open."""
    spans = windows.where("s < e").withColumn("__span", F.explode(F.sequence(F.floor(F.col("s") / SPAN), F.floor((F.col("e") - 1) / SPAN))))
    return rows.withColumn("__span", F.floor(F.col("us") / SPAN)).join(spans, "__span").where("us >= s and us < e").drop("__span")


def previous(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``prev``, the stamp before (an equal one, if stamps repeat); null for a key's first."""
    rows = rows.withColumn("__span", F.floor(F.col("us") / SPAN))
    tops = rows.groupBy(*keys, "__span").agg(F.max("us").alias("__top"))
    carried = tops.select(*keys, "__span", F.lag("__top").over(Window.partitionBy(*keys).orderBy("__span")).alias("__carried"))
    own = F.lag("us").over(Window.partitionBy(*keys, "__span").orderBy("us"))
    return rows.withColumn("__own", own).join(carried, [*keys, "__span"]).withColumn("prev", F.coalesce("__own", "__carried")).drop("__span", "__own", "__carried")


def plain_gaps(stamps: DataFrame, cadence: int, start: int | None = None, end: int | None = None, series: DataFrame | None = None) -> DataFrame:
    """(k, gap_start, gap_end, missing) between the distinct stamps of a series; with start and end also at the edges.

    With ``series`` (k) and both ends, a series without a stamp is one gap, from start to end.
    """
    c = cadence
    rows = stamps.select("k", "us")
    out = _out(previous(rows, ["k"]), f"prev + {c}", "us", f"(us - prev) div {c} - 1")
    if start is not None or end is not None:
        ends = rows.groupBy("k").agg(F.min("us").alias("lo"), F.max("us").alias("hi"))
        if start is not None:
            out = out.unionByName(_out(ends, f"{start}L", "lo", f"(lo - {start}) div {c}"))
        if end is not None:
            out = out.unionByName(_out(ends, f"hi + {c}", f"{end}L", f"({end} - hi - {c}) div {c}"))
        if series is not None and start is not None and end is not None and start < end:
            out = out.unionByName(_out(series.select("k").distinct().join(ends, "k", "left_anti"), f"{start}L", f"{end}L", f"({end} - {start}) div {c}", "true"))
    return out


def session_gaps(stamps: DataFrame, sessions: DataFrame, series: DataFrame, cadence: int) -> DataFrame:
    """(k, sid, gap_start, gap_end, missing) within each session (sid, s, e) of each series (k).

    At a session's start, between stamps, at its end; a session without a stamp is one gap,
    even where no candle fits. Stamps outside sessions count for nothing. Sessions are a
    calendar's, about one a week, and each series has each of them.
    """
    c = cadence
    x = previous(within(stamps.select("k", "us"), sessions), ["k", "sid", "s", "e"])
    m = x.groupBy("k", "sid", "s", "e").agg(F.max("us").alias("mx"))
    pick = lambda df, a, b, n, keep="missing > 0": df.select("k", "sid", F.expr(a).alias("gap_start"), F.expr(b).alias("gap_end"), F.expr(n).cast("long").alias("missing")).where(keep)
    every = series.select("k").distinct().withColumn("sid", F.explode(F.array(*[F.lit(r.sid) for r in sessions.select("sid").collect()]).cast("array<int>"))).join(sessions, "sid")
    return (
        pick(x.where("prev is null and us > s"), "s", "us", f"(us - s) div {c}")
        .unionByName(pick(x.where(f"us - prev > {c}"), f"prev + {c}", "us", f"(us - prev) div {c} - 1"))
        .unionByName(pick(m.where(f"mx + {c} < e"), f"mx + {c}", "e", f"(e - mx - {c}) div {c}"))
        .unionByName(pick(every.join(m.select("k", "sid"), ["k", "sid"], "left_anti"), "s", "e", f"(e - s) div {c}", "true"))
    )


def totals(gaps: DataFrame) -> DataFrame:
    """(k, gaps, missing) exactly, whatever is sampled."""
    return gaps.groupBy("k").agg(F.count("*").alias("gaps"), F.sum("missing").alias("missing"))


def samples(gaps: DataFrame, limit: int = 20) -> DataFrame:
    """The first gaps, of a report's feature: a bounded list beside exact counts."""
    return gaps.orderBy("gap_start", "k").limit(limit)


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Gaps that only one side has, by exact start and end: (side, k, gap_start, gap_end, missing)."""
    keys = ["k", "gap_start", "gap_end"]
    both = left.select(*keys, F.col("missing").alias("l")).join(right.select(*keys, F.col("missing").alias("r")), keys, "full")
    one = both.where("l is null or r is null")
    return one.select(F.when(F.col("r").isNull(), "left").otherwise("right").alias("side"), *keys, F.coalesce("l", "r").alias("missing"))

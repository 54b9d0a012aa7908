"""Column expressions over candles."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import PARSED, PRICE, VOLUME

#: A row's first failing rule, in this order.
RULES = (
    ("high", "low", "high cannot be below low"),
    ("high", "open", "high cannot be below open"),
    ("high", "close", "high cannot be below close"),
)
LOW_RULES = (
    ("low", "open", "low cannot be above open"),
    ("low", "close", "low cannot be above close"),
)
NAIVE = "timestamp must be timezone-aware"
NEGATIVE = "volume cannot be negative"


def micros(moment: datetime) -> int:
    """Microseconds from the epoch; a moment without offset is refused."""
    if moment.tzinfo is None:
        raise ValueError(NAIVE)
    d = moment.astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)
    return (d.days * 86_400 + d.seconds) * 1_000_000 + d.microseconds


def at_micros(us: int) -> Column:
    return F.timestamp_micros(F.lit(us))


def symbol_of(c: Column) -> Column:
    return F.upper(F.trim(c))


def first_violation() -> Column:
    """The reason of the first OHLC rule that a row breaks, or null."""
    out = F.when(F.col("timestamp").isNull(), F.lit(NAIVE))
    for a, b, reason in RULES:
        out = out.when(F.col(a) < F.col(b), reason)
    for a, b, reason in LOW_RULES:
        out = out.when(F.col(a) > F.col(b), reason)
    return out.when(F.col("volume") < 0, NEGATIVE)


def in_range(start: datetime | None, end: datetime | None, stamp: str = "timestamp") -> Column:
    """Half-open; either end may be open."""
    out = F.lit(True)
    if start is not None:
        out = out & (F.col(stamp) >= at_micros(micros(start)))
    if end is not None:
        out = out & (F.col(stamp) < at_micros(micros(end)))
    return out


def stored(name: str) -> Column:
    """A price or volume as stored: eight places, half to even."""
    return F.bround(F.col(name).cast(PARSED), 8).cast(VOLUME if name == "volume" else PRICE)


def relative_difference(a: Column, b: Column) -> Column:
    """abs(a - b) / max(abs(a), abs(b)); equal values, zeros among them, differ by 0. Null if a side is."""
    scale = F.greatest(F.abs(a), F.abs(b))
    return F.when(a.isNull() | b.isNull(), None).when(a == b, F.lit(0.0)).otherwise((F.abs(a - b).cast("double") / scale.cast("double")))


def beyond(a: Column, b: Column, tolerance: str) -> Column:
    """Whether the relative difference exceeds the tolerance, in exact decimals and without a division."""
    return F.abs(a - b) > F.lit(tolerance).cast("decimal(12,10)") * F.greatest(F.abs(a), F.abs(b))

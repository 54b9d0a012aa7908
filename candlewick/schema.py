"""The candle relation, its timeframes, and how schemas differ from it."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import types as T

PRICE, VOLUME, PARSED = T.DecimalType(18, 8), T.DecimalType(28, 8), T.DecimalType(38, 18)
PRICES = ("open", "high", "low", "close")

CANDLE = T.StructType([T.StructField("timestamp", T.TimestampType()), T.StructField("symbol", T.StringType()), *(T.StructField(c, PRICE) for c in PRICES), T.StructField("volume", VOLUME)])

#: Timeframes with a constant spacing. Any other, such as 1day_eet, has none.
CADENCES = {
    "10sec": timedelta(seconds=10),
    "1min": timedelta(minutes=1),
    "10m": timedelta(minutes=10),
    "1hour": timedelta(hours=1),
    "1day": timedelta(days=1),
}


def cadence_micros(timeframe: str) -> int | None:
    """Spacing in microseconds; None where it isn't constant, and gaps can't be told."""
    c = CADENCES.get(timeframe)
    return None if c is None else c // timedelta(microseconds=1)


def symbol_dir(symbol: str) -> str:
    return symbol.strip().upper().replace("/", "_")


def type_name(t: T.DataType) -> str:
    """The name under which Arrow knows a type."""
    if isinstance(t, T.DecimalType):
        return f"decimal128({t.precision}, {t.scale})"
    names = {T.TimestampType: "timestamp[us, tz=UTC]", T.TimestampNTZType: "timestamp[us]", T.StringType: "string", T.DoubleType: "double", T.FloatType: "float", T.LongType: "int64", T.IntegerType: "int32", T.DateType: "date32[day]", T.BooleanType: "bool", T.BinaryType: "binary"}
    return names.get(type(t), t.simpleString())


def schema_differences(found: T.StructType) -> list[str]:
    """How a stored schema departs from the candle schema; empty if it doesn't."""
    have = {f.name: f.dataType for f in found.fields}
    out = []
    for f in CANDLE.fields:
        if f.name not in have:
            out.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            out.append(f"{f.name} is {type_name(have[f.name])}, expected {type_name(f.dataType)}")
    known = set(CANDLE.names)
    return out + [f"unexpected column {c}" for c in have if c not in known]

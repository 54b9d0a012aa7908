"""CSV candles, read strictly: what isn't a candle is an error that names its place.

All columns are read as text, so nothing is guessed; a parse is then a projection, and
one aggregate finds the first bad field. A file is read in one split where its quotes
may hold line feeds, so record numbers are exact.
"""

from __future__ import annotations

import csv
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import in_range, symbol_of
from ..schema import CADENCES, PARSED, PRICES, symbol_dir
from .base import CandleSource, CsvProviderError

REQUIRED = ("timestamp", *PRICES)
OPTIONAL = ("volume", "symbol")

_OFFSET = r"[T ]\d{2}.*(Z|z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)$"


def header_of(path: str) -> list[str]:
    with open(path, newline="", encoding="utf-8-sig") as f:
        head = next(csv.reader(f), None)
    if not head:
        raise CsvProviderError(f"{path}: no header")
    return head


def columns_of(header: list[str], path: str) -> dict[str, int]:
    """Known columns and their places; case and blanks around don't matter."""
    at = {h.strip().lower(): i for i, h in enumerate(header)}
    lacking = [c for c in REQUIRED if c not in at]
    if lacking:
        raise CsvProviderError(f"{path}: missing columns {', '.join(lacking)}")
    return {c: at[c] for c in (*REQUIRED, *OPTIONAL) if c in at}


def timestamp_of(raw: Column) -> Column:
    """An ISO-8601 stamp with an offset, as an instant; null for all else."""
    t = F.trim(raw)
    basic = F.regexp_replace(t, r"^(\d{4})(\d{2})(\d{2})([T ])(\d{2})(\d{2})?(\d{2})?(?=[Zz+.-])", "$1-$2-$3T$5:$6:$7")
    t = F.when(t.rlike(r"^\d{8}[T ]"), F.regexp_replace(basic, r":(?=[Zz+-])", "")).otherwise(t)
    t = F.regexp_replace(F.regexp_replace(t, "z$", "Z"), r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.when(t.rlike(_OFFSET), F.try_to_timestamp(t))


def decimal_of(raw: Column) -> Column:
    return F.regexp_replace(F.trim(raw), r"(?<=\d)_(?=\d)", "").try_cast(PARSED)


class CsvSource(CandleSource):
    """A CSV file, or a directory of ``<SYMBOL>_<timeframe>.csv`` and ``<SYMBOL>.csv``."""

    def __init__(self, spark: SparkSession, source: str, *, name: str = "csv"):
        self.spark, self.source, self._name = spark, Path(source), name

    @property
    def name(self) -> str:
        return self._name

    def configuration(self) -> dict[str, str]:
        return {"source": str(self.source)}

    def health_check(self) -> bool:
        try:
            if self.source.is_dir():
                return any(self.source.glob("*.csv"))
            columns_of(header_of(str(self.source)), str(self.source))
        except (OSError, CsvProviderError):
            return False
        return True

    def _file(self, symbol: str, timeframe: str) -> str:
        if not self.source.is_dir():
            if not self.source.exists():
                raise CsvProviderError(f"{self.source} does not exist")
            return str(self.source)
        names = [f"{symbol_dir(symbol)}_{timeframe}.csv", f"{symbol_dir(symbol)}.csv"]
        for n in names:
            if (self.source / n).exists():
                return str(self.source / n)
        raise CsvProviderError(f"no file for {symbol} {timeframe} in {self.source}; looked for {', '.join(names)}")

    def _raw(self, path: str) -> tuple[DataFrame, dict[str, int]]:
        header = header_of(path)
        at = columns_of(header, path)
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(header))]
        schema = T.StructType([*fields, T.StructField("__extra", T.StringType()), T.StructField("__bad", T.StringType())])
        df = self.spark.read.csv(path, schema=schema, header=False, columnNameOfCorruptRecord="__bad", multiLine=True, encoding="UTF-8", enforceSchema=True)
        # one split for a file, so the id counts its records; the header is record 1
        return df.withColumn("line", F.monotonically_increasing_id() + 1).where("line > 1"), at

    def get_supported_symbols(self) -> list[str]:
        if self.source.is_dir():
            out = set()
            for p in self.source.glob("*.csv"):
                stem, _, tail = p.stem.rpartition("_")
                out.add((stem if stem and tail in CADENCES else p.stem).replace("_", "/").upper())
            return sorted(out)
        df, at = self._raw(str(self.source))
        if "symbol" not in at:
            return []
        s = symbol_of(F.col(f"c{at['symbol']}"))
        return [r.s for r in df.select(s.alias("s")).where("s <> ''").distinct().orderBy("s").collect()]

    def fetch_candles(self, symbol: str, start: datetime, end: datetime, timeframe: str) -> DataFrame:
        path = self._file(symbol, timeframe)
        df, at = self._raw(path)
        wanted = symbol.strip().upper()
        raw = lambda c: F.col(f"c{at[c]}") if c in at else F.lit(None).cast("string")
        if "symbol" in at:  # rows of other symbols aren't looked at further
            df = df.where(symbol_of(raw("symbol")) == wanted)
        volume = F.coalesce(F.nullif(F.trim(raw("volume")), F.lit("")), F.lit("0"))
        df = df.select("line", F.col("__extra").isNotNull().alias("long"), raw("timestamp").alias("raw_timestamp"), timestamp_of(raw("timestamp")).alias("timestamp"), *[raw(c).alias(f"raw_{c}") for c in PRICES], *[decimal_of(raw(c)).alias(c) for c in PRICES], volume.alias("raw_volume"), decimal_of(volume).alias("volume"))
        bad = F.when(F.col("long"), F.lit("values")).when(F.col("timestamp").isNull(), F.lit("timestamp"))
        for c in PRICES:
            bad = bad.when(F.col(c).isNull(), F.lit(c))
        bad = bad.when(F.col("volume").isNull() | (F.col("volume") < 0), F.lit("volume"))
        first = df.select("line", bad.alias("field"), *[f"raw_{c}" for c in ("timestamp", *PRICES, "volume")]).where("field is not null").orderBy("line").first()
        if first is not None:
            value = "more values than columns" if first.field == "values" else f"{first.field} {first[f'raw_{first.field}']!r} is not valid"
            raise CsvProviderError(f"{path} line {first.line}: {value}")
        out = df.select("timestamp", F.lit(wanted).alias("symbol"), *PRICES, "volume", F.col("line").alias("ord"))
        return out.where(in_range(start, end))

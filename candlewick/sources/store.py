"""Stored candles: ``<root>/<SYMBOL>/timeframe=<tf>/year=YYYY/month=MM/candles.parquet``.

A write reads the months it touches, lets incoming rows win, and replaces each month's
file by one rename, so a reader sees the old month or the new. A read filters by month
directory as well as by stamp, since Spark prunes directories only by their own columns.
The root is a path or a URI; listing, footers and renames go through ``files.Folder``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import in_range, stored
from ..operators.rows import merge
from ..schema import CANDLE, schema_differences, symbol_dir
from .files import Folder

FILE = "candles.parquet"


@dataclass(frozen=True)
class Partition:
    path: str
    year: int | None
    month: int | None
    rows: int = 0
    differences: tuple[str, ...] = ()
    error: str | None = None

    @property
    def key(self) -> tuple[int, int]:
        """Files whose directories name no month sort first."""
        return (self.year or 0, self.month or 0) if self.year and self.month else (0, 0)


def month_of(path: str) -> tuple[int | None, int | None]:
    named = dict(p.split("=", 1) for p in str(path).split("/") if "=" in p)
    try:
        year, month = int(named["year"]), int(named["month"])
    except (KeyError, ValueError):
        return None, None
    return (year, month) if 1 <= month <= 12 else (None, None)


class CandleStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(root)
        self.root = self.folder.root

    def path(self, symbol: str, timeframe: str) -> str:
        return self.folder.join(symbol_dir(symbol), f"timeframe={timeframe}")

    def files(self, symbol: str, timeframe: str, start: datetime | None = None, end: datetime | None = None) -> list[str]:
        """Of the months that overlap the range; a file that names no month always counts."""
        out = []
        for p in self.folder.list(self.path(symbol, timeframe)):
            if not p.endswith(".parquet") or any(x.startswith((".", "_")) for x in self.folder.relative(p).split("/")):
                continue
            y, m = month_of(p)
            if y is not None:
                key = y * 12 + m
                if start is not None and key < start.year * 12 + start.month:
                    continue
                if end is not None and key > end.year * 12 + end.month or end is not None and (end.year * 12 + end.month == key and (end.day, end.hour, end.minute, end.second, end.microsecond) == (1, 0, 0, 0, 0)):
                    continue
            out.append(p)
        return out

    def inspect(self, symbol: str, timeframe: str) -> list[Partition]:
        """Rows and schema of each file from its footer; what can't be opened carries its error."""
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        out = []
        for p in self.files(symbol, timeframe):
            y, m = month_of(p)
            try:
                with pq.ParquetFile(self.folder.at(p), filesystem=self.folder.fs) as f:
                    diff = schema_differences(from_arrow_schema(f.schema_arrow, prefer_timestamp_ntz=True))
                    out.append(Partition(p, y, m, f.metadata.num_rows, tuple(diff)))
            except Exception as e:
                out.append(Partition(p, y, m, 0, (), f"{p}: {type(e).__name__}: {e}"))
        return out

    def scan(self, paths: list[str]) -> DataFrame:
        """Rows of these files with their file and the month that it claims."""
        if not paths:
            empty = self.spark.createDataFrame([], CANDLE)
            return empty.select("*", F.lit("").alias("file"), F.lit(0).alias("claimed"))
        df = self.spark.read.schema(CANDLE).parquet(*paths).select("*", F.col("_metadata.file_path").alias("file"))
        part = lambda k: F.regexp_extract("file", rf"/{k}=(\d+)/", 1).try_cast("int")
        return df.withColumn("claimed", F.coalesce(part("year") * 100 + part("month"), F.lit(0)))

    def read(self, symbol: str, timeframe: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Candles in range, months outside it unread. Unordered: order where it shows."""
        files = self.files(symbol, timeframe, start, end)
        return self.scan(files).select(*CANDLE.names).where(in_range(start, end))

    def month(self, symbol: str, timeframe: str, year: int, month: int) -> DataFrame:
        """Candles of one month's files."""
        return self.scan([p for p in self.files(symbol, timeframe) if month_of(p) == (year, month)]).select(*CANDLE.names)

    def stamps(self, symbol: str, timeframe: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Timestamps in range, in order; of the files only that column is read."""
        return self.read(symbol, timeframe, start, end).select("timestamp").orderBy("timestamp")

    def bounds(self, paths: list[str]) -> tuple[datetime, datetime] | None:
        """The least and the greatest stamp by the files' footers; rows are read only of files without statistics."""
        import pyarrow.parquet as pq

        found, bare = [], []
        for p in paths:
            meta = pq.read_metadata(self.folder.at(p), filesystem=self.folder.fs)
            at = meta.schema.names.index("timestamp")
            stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups) if meta.row_group(i).num_rows]
            if all(s is not None and s.has_min_max for s in stats):
                found += [x for s in stats for x in (s.min, s.max)]
            else:
                bare.append(p)
        if bare:
            r = self.scan(bare).agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
            found += [x.astimezone(UTC) for x in (r.lo, r.hi) if x is not None]
        return (min(found), max(found)) if found else None

    def has_rows(self, symbol: str, timeframe: str, start: datetime, end: datetime) -> bool:
        """Whether a file that can be read, of a month overlapping the range, has a row."""
        import pyarrow.parquet as pq

        for p in self.files(symbol, timeframe, start, end):
            try:
                if pq.read_metadata(self.folder.at(p), filesystem=self.folder.fs).num_rows:
                    return True
            except Exception:
                continue
        return False

    def write(self, candles: DataFrame, symbol: str, timeframe: str, *, replace: bool = False, order: list[str] | None = None) -> list[str]:
        """Upserts into the months of ``candles``, or replaces them. Nothing to write writes nothing. Returns the files."""
        rows = candles.select("timestamp", "symbol", *[stored(c).alias(c) for c in CANDLE.names[2:]], *(order or []))
        months = [r.m for r in rows.select(F.date_format("timestamp", "yyyyMM").alias("m")).distinct().orderBy("m").collect()]
        if not months:
            return []
        base = self.path(symbol, timeframe)
        at = {m: f"{base}/year={m[:4]}/month={m[4:]}" for m in months}
        held = {m: [p for p in self.folder.list(d, recursive=False) if p.endswith(".parquet")] for m, d in at.items()}
        old = [] if replace else [p for ps in held.values() for p in ps]
        if old:
            rows = merge(self.scan(old).select(*CANDLE.names), rows, order)
        stage = f"{base}/_staging-{uuid.uuid4().hex}"
        out = rows.select(*CANDLE.names).withColumn("m", F.date_format("timestamp", "yyyyMM"))
        # a task and a file for each month
        out.repartition("m").sortWithinPartitions("m", "timestamp").write.partitionBy("m").option("maxRecordsPerFile", 0).parquet(stage)
        parts = {month: p for p in self.folder.list(stage) if p.endswith(".parquet") for month in months if f"/m={month}/part-" in p}
        for m, d in at.items():
            self.folder.move(parts[m], f"{d}/{FILE}")
            for stray in held[m]:
                if stray != f"{d}/{FILE}":
                    self.folder.remove(stray)
        self.folder.remove_tree(stage)
        return [f"{d}/{FILE}" for d in at.values()]

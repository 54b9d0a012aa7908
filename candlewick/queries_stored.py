"""Named queries over what is written and read back: store, CSV, pages, streams, reports, downloads.

Orders make the candles: a bar a day, with the symbol ORD/USD, over several years. Files go
to the shared folder; a written dataset serves all queries of a session that read it. The
session gets the settings that stored candles rely on, UTC among them.
"""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from bisect import bisect_right
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import micros
from .operators.calendars import AlwaysOpen, WeeklyCalendar
from .operators.gaps import plain_gaps
from .operators.reports import compare_datasets, quality_report, validate_dataset
from .plans.documents import fingerprint, manifests
from .plans.ingest import DownloadPipeline, slug
from .plans.status import Status, worst
from .plans.verification import check_source
from .queries import DAY, HOLIDAYS, HOUR, RAW, E, END, S, START, _us, _utc, bars_sql, candles, raw, read, stamps
from .queries import query as named
from .schema import CANDLE, symbol_dir
from .session import configure
from .sources.csv import CsvSource, decimal_of, timestamp_of
from .sources.http import PagedHttpSource
from .sources.limits import RetryPolicy
from .sources.store import CandleStore
from .streaming.gap_monitor import monitor, upsert

SYMBOL, TIMEFRAME = "ORD/USD", "1day"
LO, HI = datetime(1995, 3, 10, tzinfo=UTC), datetime(1995, 9, 20, tzinfo=UTC)
_made: dict[tuple, str] = {}


def query(sql: str):
    """As in ``queries``; the session is configured before the query is built."""

    def put(f):
        @functools.wraps(f)
        def run(spark, d):
            return f(configure(spark), d)

        return named(sql)(run)

    return put


def daily(spark: SparkSession, d: str, every: str = "true") -> DataFrame:
    o = read(spark, d, "orders").where(every).select("o_orderkey", F.date_trunc("day", _utc("o_orderdate")).alias("timestamp"), F.col("o_totalprice").cast("decimal(18,8)").alias("p"))
    bars = o.groupBy("timestamp").agg(F.min_by("p", "o_orderkey").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "o_orderkey").alias("close"), F.count("*").cast("decimal(28,8)").alias("volume"))
    return bars.select("timestamp", F.lit(SYMBOL).alias("symbol"), "open", "high", "low", "close", "volume")


def _bars(name: str = "b", where: str = "true") -> str:
    p = "o_totalprice::DECIMAL(18,8)"
    return f"{name} AS (SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS stamp, arg_min({p}, o_orderkey) AS open, max({p}) AS high, min({p}) AS low, arg_max({p}, o_orderkey) AS close, count(*)::DECIMAL(28,8) AS volume FROM orders WHERE {where} GROUP BY 1)"


_ROW = "epoch_us(stamp) AS us, open::VARCHAR AS open, close::VARCHAR AS close, volume::VARCHAR AS volume"


def _row(df: DataFrame) -> DataFrame:
    return df.select(_us().alias("us"), *[F.col(c).cast("string").alias(c) for c in ("open", "close", "volume")])


def folder(spark: SparkSession) -> Path:
    """A new one in the shared folder, where the session names one that is a file system's."""
    at = (spark.conf.get("spark.checkpoint.dir", None) or "").removeprefix("file://")
    base = Path(at) if at.startswith("/") else Path(tempfile.gettempdir())
    out = base / f"candlewick-{uuid.uuid4().hex[:12]}"
    out.mkdir(parents=True)
    return out


def _store(spark: SparkSession, d: str, every: str = "true") -> CandleStore:
    """The daily bars, stored by month; written once for a session."""
    key = (spark.sparkContext.applicationId, d, every)
    if key not in _made:
        root = folder(spark)
        CandleStore(spark, str(root)).write(daily(spark, d, every), SYMBOL, TIMEFRAME)
        _made[key] = str(root)
    return CandleStore(spark, _made[key])


@query(f"WITH {_bars()} SELECT {_ROW} FROM b WHERE epoch_us(stamp) >= {micros(LO)} AND epoch_us(stamp) < {micros(HI)}")
def store_range_scan(spark, d):
    return _row(_store(spark, d).read(SYMBOL, TIMEFRAME, LO, HI))


@query(f"WITH {_bars()} SELECT year(stamp)::INT AS year, month(stamp)::INT AS month, count(*)::INT AS n FROM b GROUP BY ALL")
def store_partitions(spark, d):
    """Each month's file with its rows, from footers."""
    found = _store(spark, d).inspect(SYMBOL, TIMEFRAME)
    return spark.createDataFrame([(p.year, p.month, p.rows) for p in found if not p.differences and not p.error], "year int, month int, n int")


@query(f"WITH {_bars()} SELECT {_ROW} FROM b WHERE year(stamp) = 1995 AND month(stamp) = 5")
def store_single_month(spark, d):
    return _row(_store(spark, d).month(SYMBOL, TIMEFRAME, 1995, 5))


@query(f"WITH {_bars()} SELECT epoch_us(stamp) AS us, lag(epoch_us(stamp)) OVER (ORDER BY stamp) IS NOT NULL AS later FROM b WHERE epoch_us(stamp) >= {micros(LO)} AND epoch_us(stamp) < {micros(HI)}")
def store_ordered_timestamps(spark, d):
    """In order; each but the first comes after the row before it."""
    rows = _store(spark, d).stamps(SYMBOL, TIMEFRAME, LO, HI).select(_us().alias("us")).collect()
    return spark.createDataFrame([(b.us, i > 0 and b.us > rows[i - 1].us) for i, b in enumerate(rows)], "us long, later boolean")


@query(f"WITH {_bars()} SELECT epoch_us(min(stamp)) AS lo, epoch_us(max(stamp)) AS hi FROM b")
def store_footer_bounds(spark, d):
    store = _store(spark, d)
    lo, hi = store.bounds([str(p) for p in store.files(SYMBOL, TIMEFRAME)])
    return spark.createDataFrame([(micros(lo), micros(hi))], "lo long, hi long")


@query(f"WITH {_bars('x', 'o_orderkey % 3 <> 0')}, {_bars('y', 'o_orderkey % 3 <> 1')}, u AS (SELECT *, 0 AS src FROM x UNION ALL SELECT *, 1 FROM y) SELECT {_ROW} FROM u QUALIFY row_number() OVER (PARTITION BY stamp ORDER BY src DESC) = 1")
def store_upsert(spark, d):
    store = CandleStore(spark, str(folder(spark)))
    for every in ("o_orderkey % 3 <> 0", "o_orderkey % 3 <> 1"):
        store.write(daily(spark, d, every), SYMBOL, TIMEFRAME)
    return _row(store.read(SYMBOL, TIMEFRAME))


@query(f"WITH {_bars()}, k AS (SELECT * FROM b WHERE day(stamp) > 10 AND year(stamp) = 1995), m AS (SELECT DISTINCT strftime(stamp, '%Y%m') AS m FROM k) SELECT {_ROW} FROM (SELECT * FROM k UNION ALL SELECT * FROM b WHERE strftime(stamp, '%Y%m') NOT IN (SELECT m FROM m))")
def store_replace(spark, d):
    """A second write replaces the months of one year by their later days."""
    store = CandleStore(spark, str(folder(spark)))
    bars = daily(spark, d)
    store.write(bars, SYMBOL, TIMEFRAME)
    store.write(bars.where("dayofmonth(timestamp) > 10 and year(timestamp) = 1995"), SYMBOL, TIMEFRAME, replace=True)
    return _row(store.read(SYMBOL, TIMEFRAME))


def _csv(spark: SparkSession, d: str) -> Path:
    """Daily bars as one file of candles, with stamps at three hours ahead of UTC; a line a day."""
    key = (spark.sparkContext.applicationId, d, "csv")
    if key not in _made:
        at = folder(spark)
        rows = daily(spark, d).select(F.date_format(F.col("timestamp") + F.expr("interval 3 hours"), "yyyy-MM-dd'T'HH:mm:ss'+03:00'").alias("t"), *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")]).orderBy("t").collect()
        (at / "ORD_USD_1day.csv").write_text("\n".join(["Timestamp, open,high,low,close,volume", *(",".join(r) for r in rows)]) + "\n")
        _made[key] = str(at)
    return Path(_made[key])


@query(f"WITH {_bars()} SELECT {_ROW} FROM b WHERE epoch_us(stamp) >= {micros(LO)} AND epoch_us(stamp) < {micros(HI)}")
def csv_scan(spark, d):
    rows = CsvSource(spark, str(_csv(spark, d))).fetch_candles(SYMBOL, LO, HI, TIMEFRAME)
    return _row(rows.select("timestamp", *[F.col(c).cast("decimal(28,8)").alias(c) for c in ("open", "close", "volume")]))


@query("SELECT upper(trim(n_name)) AS symbol FROM nation")
def csv_symbol_catalog(spark, d):
    """Of a file with a symbol column, in which they are written this way and that."""
    at = folder(spark) / "all.csv"
    names = [r.n_name for r in read(spark, d, "nation").collect()]
    body = [f"2024-01-01T00:00:00Z,1,1,1,1,1, {x.lower() if i % 2 else x} " for i, x in enumerate([*names, *names])]
    at.write_text("\n".join(["timestamp,open,high,low,close,volume,symbol", *body]) + "\n")
    return spark.createDataFrame([(s,) for s in CsvSource(spark, str(at)).get_supported_symbols()], "symbol string")


@query("SELECT event_id, CASE WHEN event_id % 5 = 4 THEN -1 ELSE epoch_us(date_trunc('second', ts)) END AS us FROM events")
def csv_timestamps(spark, d):
    """A stamp in five spellings, of which the one without an offset is none."""
    t = _utc("ts")
    text = lambda hours, form: F.date_format(t + F.expr(f"interval {hours} hours"), form)
    k = F.col("event_id") % 5
    spelt = F.when(k == 0, text(0, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, text(3, "yyyy-MM-dd HH:mm:ss'+03:00'")).when(k == 2, text(-3, "' 'yyyy-MM-dd'T'HH:mm:ss'-0300'")).when(k == 3, text(0, "yyyyMMdd'T'HHmmss'Z'")).otherwise(text(0, "yyyy-MM-dd'T'HH:mm:ss"))
    return read(spark, d, "events").select("event_id", F.coalesce(F.unix_micros(timestamp_of(spelt)), F.lit(-1)).alias("us"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE value::DECIMAL(18,4)::VARCHAR END AS value FROM events")
def csv_decimals(spark, d):
    v = F.col("value").cast("decimal(18,4)").cast("string")
    k = F.col("event_id") % 4
    spelt = F.when(k == 0, v).when(k == 1, F.concat(F.lit("  "), v, F.lit(" "))).when(k == 2, F.concat(v, F.lit("0_0"))).otherwise(F.concat(v, F.lit("x")))
    return read(spark, d, "events").select("event_id", decimal_of(spelt).cast("decimal(18,4)").cast("string").alias("value"))


_DAYS = f"(epoch_us(stamp) - lag(epoch_us(stamp)) OVER (ORDER BY stamp)) // {DAY}"


@query(f"WITH {_bars()}, g AS (SELECT {_DAYS} AS k FROM b) SELECT count(*) AS candles, (epoch_us(max(stamp)) - epoch_us(min(stamp))) // {DAY} + 1 AS expected, (SELECT coalesce(sum(k - 1), 0)::BIGINT FROM g WHERE k > 1) AS missing, (SELECT count(*) FROM g WHERE k > 1) AS gaps, 0::BIGINT AS defects, (SELECT count(DISTINCT strftime(stamp, '%Y%m')) FROM b) AS files, CASE WHEN (SELECT count(*) FROM g WHERE k > 1) > 0 THEN 'incomplete' ELSE 'ok' END AS status FROM b")
def validation_report(spark, d):
    v = validate_dataset(spark, symbol=SYMBOL, timeframe=TIMEFRAME, data_root=str(_store(spark, d).root))
    defects = v.duplicate_candles + v.invalid_rows + v.out_of_range_rows + v.unordered_rows + v.misfiled_rows + len(v.problems[: 0 if v.missing_candles else None])
    return spark.createDataFrame([(v.candles, v.expected_candles, v.missing_candles, v.missing_interval_count, defects, v.files, v.status.value)], "candles long, expected long, missing long, gaps long, defects long, files long, status string")


@query(f"WITH {_bars()}, x AS (SELECT epoch_us(stamp) AS us FROM b WHERE epoch_us(stamp) >= {micros(LO)} AND epoch_us(stamp) < {micros(HI)}) SELECT count(*) AS retained, ({micros(HI)} - {micros(LO)}) // {DAY} AS expected, ({micros(HI)} - {micros(LO)}) // {DAY} - count(*) AS missing, min(us) AS first, max(us) AS last, CASE WHEN ({micros(HI)} - {micros(LO)}) // {DAY} > count(*) THEN 'incomplete' ELSE 'ok' END AS status FROM x")
def quality_report_counts(spark, d):
    store = _store(spark, d)
    rows = store.scan([str(p) for p in store.files(SYMBOL, TIMEFRAME, LO, HI)]).where(F.col("timestamp").between(LO, HI - timedelta(microseconds=1)))
    q = quality_report(rows, provider="csv", symbol=SYMBOL, timeframe=TIMEFRAME, calendar=AlwaysOpen(), start=LO, end=HI)
    return spark.createDataFrame([(q.retained_rows, q.expected_rows, q.missing_candles, micros(q.actual_start), micros(q.actual_end), q.status.value)], "retained long, expected long, missing long, first long, last long, status string")


_ONE, _TWO = "o_orderkey % 7 <> 0", "o_orderkey % 5 <> 0 and o_orderdate >= timestamp_ntz '1994-06-01 00:00:00'"
_OFF = lambda c, tol: f"(abs(l.{c} - r.{c}) > {tol} * greatest(abs(l.{c}), abs(r.{c})))"
_P = "(" + " OR ".join(_OFF(c, "0.0001") for c in ("open", "high", "low", "close")) + ")"


@query(f"WITH {_bars('l', _ONE)}, {_bars('r', _TWO.replace('timestamp_ntz', 'TIMESTAMP'))}, j AS (SELECT l.stamp IS NULL AS nl, r.stamp IS NULL AS nr, {_P} AS p, {_OFF('volume', '0.05')} AS v FROM l FULL JOIN r ON l.stamp = r.stamp) SELECT count(*) FILTER (NOT nl AND NOT nr) AS compared, count(*) FILTER (NOT nl AND NOT nr AND NOT p AND NOT v) AS matching, count(*) FILTER (nl) AS missing_left, count(*) FILTER (nr) AS missing_right, count(*) FILTER (p) AS prices, count(*) FILTER (v) AS volumes, CASE WHEN count(*) FILTER (p) > 0.001 * count(*) FILTER (NOT nl AND NOT nr) OR count(*) FILTER (nl OR nr) > 0.01 * count(*) THEN 'fail' ELSE 'other' END AS status FROM j")
def comparison_report(spark, d):
    left, right = (_store(spark, d, x).root for x in (_ONE, _TWO))
    r = compare_datasets(spark, symbol=SYMBOL, timeframe=TIMEFRAME, left_root=str(left), right_root=str(right))
    return spark.createDataFrame([(r.candles_compared, r.matching_candles, r.missing_from_left, r.missing_from_right, r.price_mismatches, r.volume_mismatches, r.status.value)], "compared long, matching long, missing_left long, missing_right long, prices long, volumes long, status string")


def _downloaded(spark: SparkSession, d: str):
    """A download of the CSV file in chunks of six months; its result and the folders of documents."""
    at = folder(spark)
    roots = {k: str(at / k) for k in ("output_root", "manifest_root", "quality_root", "checkpoint_root")}
    from .plans.chunks import ChunkSize

    pipe = DownloadPipeline(spark, CsvSource(spark, str(_csv(spark, d))), calendar=AlwaysOpen(), chunk_size=ChunkSize(6), **roots)
    return pipe.run(symbol=SYMBOL, start=LO, end=HI, timeframe=TIMEFRAME), roots


@query(f"WITH {_bars()}, x AS (SELECT stamp FROM b WHERE epoch_us(stamp) >= {micros(LO)} AND epoch_us(stamp) < {micros(HI)}) SELECT count(*) AS downloaded, count(*) AS retained, 0::BIGINT AS refused, 2::BIGINT AS chunks, count(DISTINCT strftime(stamp, '%Y%m')) AS files FROM x")
def download_totals(spark, d):
    r, _ = _downloaded(spark, d)
    return spark.createDataFrame([(r.downloaded_count, r.retained_count, r.duplicate_count + r.invalid_count + r.out_of_range_count + r.chunks_failed, r.chunks_completed, len(r.files))], "downloaded long, retained long, refused long, chunks long, files long")


@query(f"WITH {_bars()} SELECT count(*) AS claimed, {micros(LO)} AS s, {micros(HI)} AS e, 'csv' AS provider, true AS agrees FROM b WHERE epoch_us(stamp) >= {micros(LO)} AND epoch_us(stamp) < {micros(HI)}")
def manifest_round_trip(spark, d):
    """The manifest of a download, and whether the audit finds it true."""
    _, roots = _downloaded(spark, d)
    listed = manifests(Path(roots["manifest_root"]), symbol_dir(SYMBOL), TIMEFRAME)
    v = validate_dataset(spark, symbol=SYMBOL, timeframe=TIMEFRAME, data_root=roots["output_root"], manifest_root=roots["manifest_root"])
    return spark.createDataFrame([(m.row_count, micros(m.start), micros(m.end), m.provider, c.agrees) for (_, m), c in zip(listed, v.manifests, strict=True)], "claimed long, s long, e long, provider string, agrees boolean")


@query(f"WITH {_bars()}, n AS (SELECT count(*) AS n FROM b WHERE epoch_us(stamp) >= {micros(LO)} AND epoch_us(stamp) < {micros(HI)}) SELECT * FROM (VALUES (0, 'reachable'), (1, 'symbol_accepted'), (2, 'timeframe_accepted'), (3, 'candles_returned'), (4, 'candles_parsed'), (5, 'timestamps_utc'), (6, 'ohlc_valid'), (7, 'pagination')) AS t(place, name), (SELECT 'pass' AS status, n AS candles FROM n)")
def preflight_checks(spark, d):
    r = check_source(CsvSource(spark, str(_csv(spark, d))), symbol=SYMBOL, timeframe=TIMEFRAME, start=LO, end=HI)
    return spark.createDataFrame([(i, c.name, c.status.value, r.candles) for i, c in enumerate(r.checks)], "place int, name string, status string, candles long")


class _Pages:
    """A service that has these stamps (milliseconds, ascending) and gives the last ``count`` of a range, as pages go."""

    def __init__(self, at: list[int], prices: list[str]):
        self.at, self.prices = at, prices

    def __call__(self, path: str, p: dict):
        if path == "instrumentList":
            return [{"id": 1, "name": SYMBOL, "pipValue": 0.0001, "nameLong": "orders"}]
        hi = bisect_right(self.at, p["end"])
        lo = max(bisect_right(self.at, p["start"] - 1), hi - 100)
        return {"candles": [{"timestamp": self.at[i]} | {f"bid_{c}": self.prices[i] for c in ("open", "high", "low", "close")} for i in range(lo, hi)]}


@query(f"WITH {_bars()} SELECT epoch_us(stamp) AS us, close::VARCHAR AS close, '0.00000000' AS volume FROM b WHERE epoch_us(stamp) >= {micros(LO)} AND epoch_us(stamp) < {micros(HI)}")
def http_backward_pages(spark, d):
    """Pages of 100 candles, from the last to the first."""
    rows = daily(spark, d).select(_us().alias("us"), F.col("close").cast("string").alias("c")).orderBy("us").collect()
    source = PagedHttpSource(spark, _Pages([r.us // 1000 for r in rows], [r.c for r in rows]))
    source.limiter.sleep = lambda _: None  # nothing is asked of a network
    got = source.fetch_candles(SYMBOL, LO, HI, TIMEFRAME)
    return got.select(_us().alias("us"), F.col("close").cast("decimal(18,8)").cast("string").alias("close"), F.col("volume").cast("decimal(28,8)").cast("string").alias("volume"))


@query(f"SELECT event_type AS k, {S} AS gap_start, {E} AS gap_end, ({E} - {S}) // {HOUR} AS missing FROM (SELECT DISTINCT event_type FROM events) WHERE event_type NOT IN (SELECT event_type FROM events WHERE event_type = 'click')")
def empty_series_gap(spark, d):
    """Series that a feed lacks altogether: one gap each, beside those of the series it has, which are left out here."""
    c = stamps(candles(spark, d))
    return plain_gaps(c.where("k = 'click'"), HOUR, S, E, series=c.select("k")).where("k <> 'click'")


_LAG = f"p AS (SELECT symbol AS k, us, lag(us) OVER (PARTITION BY symbol ORDER BY us) AS prev FROM (SELECT symbol, epoch_us(stamp) AS us FROM c))"


@query(f"WITH {bars_sql()}, {_LAG} SELECT k, prev + {HOUR} AS gap_start, us AS gap_end, (us - prev) // {HOUR} - 1 AS missing FROM p WHERE (us - prev) // {HOUR} > 1")
def stream_gaps(spark, d):
    """The hourly bars as a stream in order, three files of it, one a micro-batch."""
    at = folder(spark)
    rows = stamps(candles(spark, d)).cache()
    for i in range(3):
        lo, hi = (S + (E - S) // 3 * k for k in (i, i + 1))
        rows.where(F.col("us") >= lo if i else F.lit(True)).where(F.col("us") < hi if i < 2 else F.lit(True)).coalesce(1).write.parquet(str(at / "in" / f"part={i}"))
        stamp = 1_700_000_000 + i
        for f in (at / "in" / f"part={i}").glob("*.parquet"):
            os.utime(f, (stamp, stamp))  # files are read in the order of their times
    rows.unpersist()
    stream = spark.readStream.schema("k string, us long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(at / "in"))
    q = monitor(stream, HOUR).writeStream.format("parquet").option("path", str(at / "out")).option("checkpointLocation", str(at / "state")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(str(at / "out")).where("kind = 'gap'").select("k", "gap_start", "gap_end", "missing")


@query(f"WITH {_bars()} SELECT {_ROW} FROM b")
def stream_upsert(spark, d):
    """The daily bars as a stream into the store, twice: the second run changes nothing."""
    at = folder(spark)
    rows = daily(spark, d).withColumn("ord", F.lit(1).cast("long"))
    rows.coalesce(1).write.parquet(str(at / "in"))
    store = CandleStore(spark, str(at / "store"))
    for k in ("one", "two"):
        upsert(spark.readStream.schema(rows.schema).parquet(str(at / "in")), store, SYMBOL, TIMEFRAME, str(at / k)).awaitTermination()
    return _row(store.read(SYMBOL, TIMEFRAME))


_H = ", ".join(f"({micros(datetime(h.year, h.month, h.day, tzinfo=UTC))})" for h in HOLIDAYS)


@query(f"WITH w AS (SELECT a, a + {49 * HOUR} AS b, 'weekend' AS r FROM (SELECT unnest(range({micros(datetime(2023, 12, 29, 21, tzinfo=UTC))}, {E}, {7 * DAY})) AS a) UNION ALL SELECT h, h + {DAY}, 'holiday' FROM (VALUES {_H}) AS t(h)), i AS (SELECT *, sum(n) OVER (ORDER BY a, b) AS i FROM (SELECT *, CASE WHEN a <= max(b) OVER (ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM w)) SELECT greatest(min(a), {S}) AS s, least(max(b), {E}) AS e, CASE WHEN min(r) = max(r) THEN min(r) ELSE 'market closure' END AS reason FROM i GROUP BY i HAVING max(b) > {S}")
def holiday_closures(spark, d):
    found = WeeklyCalendar(holidays=HOLIDAYS).closed_intervals(START, END)
    return spark.createDataFrame([(micros(c.start), micros(c.end), c.reason) for c in found], "s long, e long, reason string")


@query("SELECT a || b || c AS found, list_extract(['pass', 'warn', 'blocked', 'fail'], greatest(list_position(['pass', 'warn', 'blocked', 'fail'], a), list_position(['pass', 'warn', 'blocked', 'fail'], b), list_position(['pass', 'warn', 'blocked', 'fail'], c))) AS worst FROM (SELECT unnest(['pass', 'warn', 'blocked', 'fail']) AS a), (SELECT unnest(['pass', 'warn', 'blocked', 'fail']) AS b), (SELECT unnest(['pass', 'warn', 'blocked', 'fail']) AS c)")
def worst_of_three(spark, d):
    every = [(a, b, c) for a in Status for b in Status for c in Status]
    return spark.createDataFrame([(a.value + b.value + c.value, worst((a, b, c)).value) for a, b, c in every], "found string, worst string")


@query("SELECT k::INT AS attempt, least(60.0, 2.0 ** (k - 1)) * 1.0::DOUBLE AS seconds FROM (SELECT unnest(range(1, 11)) AS k)")
def retry_waits(spark, d):
    return spark.createDataFrame([(k, float(RetryPolicy().wait(k))) for k in range(1, 11)], "attempt int, seconds double")


@query("SELECT n_name, substr(sha256('{\"name\":\"' || n_name || '\",\"region\":\"' || n_regionkey || '\"}'), 1, 16) AS mark FROM nation")
def configuration_fingerprint(spark, d):
    rows = read(spark, d, "nation").select("n_name", "n_regionkey").collect()
    return spark.createDataFrame([(r.n_name, fingerprint({"region": str(r.n_regionkey), "name": r.n_name})) for r in rows], "n_name string, mark string")


@query("SELECT DISTINCT p_brand, replace(upper(trim(' ' || lower(p_brand) || '/usd ')), '/', '_') AS directory, '1day_19950310T000000Z_19950920T000000Z' AS slug FROM part")
def path_names(spark, d):
    brands = [r.p_brand for r in read(spark, d, "part").select("p_brand").distinct().collect()]
    return spark.createDataFrame([(b, symbol_dir(f" {b.lower()}/usd "), slug(TIMEFRAME, LO, HI)) for b in brands], "p_brand string, directory string, slug string")


@query(f"WITH {RAW} SELECT event_id, epoch_us(stamp) // 1000 * 1000 AS us, open::VARCHAR AS close FROM raw")
def http_candle_decode(spark, d):
    """Each event's minute and value as a page's item, decoded in the executors; a row an event."""
    rows = raw(spark, d).select("event_id", (_us() / 1000).cast("long").alias("ms"), F.col("open").cast("string").alias("o"))

    def work(batches):
        for x in batches:
            found = [PagedHttpSource.decode({"timestamp": ms} | {f"bid_{c}": o for c in ("open", "high", "low", "close")}, SYMBOL) for ms, o in zip(x["ms"], x["o"], strict=True)]
            yield pd.DataFrame({"event_id": x["event_id"], "us": [micros(c[0]) for c in found], "close": [str(c[5]) for c in found]})

    return rows.mapInPandas(work, "event_id long, us long, close string").select("event_id", "us", F.col("close").cast("decimal(18,8)").cast("string").alias("close"))


@query("SELECT * FROM (VALUES ('timestamp'), ('symbol'), ('open'), ('high'), ('low'), ('close'), ('volume')) AS t(name), (SELECT 0 AS differences)")
def stored_schema(spark, d):
    """The columns of every stored file, and in how many files they differ from a candle's."""
    store = _store(spark, d)
    parts = store.inspect(SYMBOL, TIMEFRAME)
    return spark.createDataFrame([(n, sum(bool(p.differences) for p in parts)) for n in CANDLE.names], "name string, differences int")

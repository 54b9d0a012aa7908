"""Named queries: each operator over the driver's tables, with the same in DuckDB's SQL.

``events`` make the candles: hourly bars for each event type. Stamps are naive there and
stand for UTC; queries return microseconds or text, which both engines write alike.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import at_micros, first_violation, in_range, micros, stored, symbol_of
from .operators import compare as cmp
from .operators.calendars import AlwaysOpen, WeeklyCalendar, complement, merged
from .operators.gaps import differences, plain_gaps, session_gaps, totals, within
from .operators.reports import audit, manifest_counts
from .operators.rows import classify, duplicates, keep_last, late, merge, misfiled, seams, valid
from .plans.chunks import ChunkSize, plan_chunks, stage_of
from .plans.status import ComparisonThresholds, QualityStatus, grade
from .plans.verification import stitch_counts
from .schema import CANDLE, PRICES

START, END = datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 31, tzinfo=UTC)
HOUR, DAY = 3_600_000_000, 86_400_000_000
HOLIDAYS = (date(2024, 1, 1), date(2024, 1, 15), date(2024, 1, 21))
S, E = micros(START), micros(END)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _utc(c: str) -> F.Column:
    """A naive stamp as the instant of that name in UTC, whatever the session's zone."""
    return F.timestamp_micros(F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(c)).cast("timestamp")))


def _us(c: str = "timestamp") -> F.Column:
    return F.unix_micros(c)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event as a candle: its minute, and prices about its value, some of them impossible."""
    e = read(spark, sf_dir, "events").select("event_id", F.date_trunc("minute", _utc("ts")).alias("timestamp"), F.col("event_type").alias("symbol"), F.col("value").cast("decimal(18,8)").alias("v"))
    k = F.col("event_id")
    low = F.when(k % 97 == 0, F.col("v") + 1).otherwise(F.col("v") - F.lit("0.01").cast("decimal(18,8)"))
    high = F.when(k % 89 == 0, F.col("v") - 2).otherwise(F.col("v") + F.lit("0.01").cast("decimal(18,8)"))
    return e.select("event_id", "timestamp", "symbol", F.col("v").alias("open"), high.cast("decimal(18,8)").alias("high"), low.cast("decimal(18,8)").alias("low"), F.col("v").alias("close"), (k % 7).cast("decimal(28,8)").alias("volume"))


RAW = """raw AS (SELECT event_id, date_trunc('minute', ts) AS stamp, event_type AS symbol, value::DECIMAL(18,8) AS open,
 (CASE WHEN event_id % 89 = 0 THEN value::DECIMAL(18,8) - 2 ELSE value::DECIMAL(18,8) + 0.01 END)::DECIMAL(18,8) AS high,
 (CASE WHEN event_id % 97 = 0 THEN value::DECIMAL(18,8) + 1 ELSE value::DECIMAL(18,8) - 0.01 END)::DECIMAL(18,8) AS low,
 value::DECIMAL(18,8) AS close, (event_id % 7)::DECIMAL(28,8) AS volume FROM events)"""
REASON = """CASE WHEN high < low THEN 'high cannot be below low' WHEN high < open THEN 'high cannot be below open' WHEN high < close THEN 'high cannot be below close'
 WHEN low > open THEN 'low cannot be above open' WHEN low > close THEN 'low cannot be above close' WHEN volume < 0 THEN 'volume cannot be negative' END"""


def candles(spark: SparkSession, sf_dir: str, every: str = "true") -> DataFrame:
    """Hourly bars of each event type; ties in time go by event_id."""
    e = read(spark, sf_dir, "events").where(every).select("event_id", _utc("ts").alias("ts"), "event_type", F.col("value").cast("decimal(18,8)").alias("v"))
    order = F.struct("ts", "event_id")
    bars = e.groupBy(F.date_trunc("hour", "ts").alias("timestamp"), F.col("event_type").alias("symbol"))
    return bars.agg(F.min_by("v", order).alias("open"), F.max("v").alias("high"), F.min("v").alias("low"), F.max_by("v", order).alias("close"), F.count("*").cast("decimal(28,8)").alias("volume"))


def bars_sql(name: str = "c", where: str = "true") -> str:
    v = "value::DECIMAL(18,8)"
    return f"{name} AS (SELECT date_trunc('hour', ts) AS stamp, event_type AS symbol, arg_min({v}, (ts, event_id)) AS open, max({v}) AS high, min({v}) AS low, arg_max({v}, (ts, event_id)) AS close, count(*)::DECIMAL(28,8) AS volume FROM events WHERE {where} GROUP BY 1, 2)"


def stamps(df: DataFrame) -> DataFrame:
    return df.select(F.col("symbol").alias("k"), _us().alias("us"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


@query(f"WITH {RAW} SELECT event_id, {REASON} AS reason FROM raw")
def ohlc_rule_first_reason(spark, d):
    return raw(spark, d).select("event_id", first_violation().alias("reason"))


@query(f"WITH {RAW} SELECT symbol, count(*) FILTER ({REASON} IS NULL) AS valid_rows, count(*) FILTER ({REASON} IS NOT NULL) AS rejected_rows FROM raw GROUP BY symbol")
def valid_rejected_counts(spark, d):
    c = classify(raw(spark, d))
    return c.groupBy("symbol").agg(F.count_if(F.col("reason").isNull()).alias("valid_rows"), F.count_if(F.col("reason").isNotNull()).alias("rejected_rows"))


_MID = datetime(2024, 1, 10, 12, tzinfo=UTC), datetime(2024, 1, 20, tzinfo=UTC)


@query(f"WITH {RAW} SELECT symbol, epoch_us(stamp) >= {micros(_MID[0])} AND epoch_us(stamp) < {micros(_MID[1])} AS inside, count(*) AS n FROM raw GROUP BY ALL")
def range_split(spark, d):
    return raw(spark, d).groupBy("symbol", in_range(*_MID).alias("inside")).agg(F.count("*").alias("n"))


@query("SELECT upper(trim('  ' || event_type || ' ', ' ')) AS symbol, count(*) AS n FROM events GROUP BY 1")
def symbol_normalize(spark, d):
    s = F.concat(F.lit("  "), "event_type", F.lit(" "))
    return read(spark, d, "events").groupBy(symbol_of(s).alias("symbol")).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, round_even(l_quantity::DECIMAL(18,10) + 0.000000005::DECIMAL(18,10) * l_linenumber, 8)::DECIMAL(18,8)::VARCHAR AS q FROM lineitem")
def quantize_half_even(spark, d):
    x = F.col("l_quantity").cast("decimal(38,18)") + F.lit("0.000000005").cast("decimal(18,10)") * F.col("l_linenumber")
    return read(spark, d, "lineitem").withColumn("open", x).select("l_orderkey", "l_linenumber", stored("open").cast("string").alias("q"))


def _deduplicated(spark, d):
    return keep_last(valid(classify(raw(spark, d))), ["event_id"])


_DEDUP = f"valid AS (SELECT * FROM raw WHERE {REASON} IS NULL), kept AS (SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY symbol, stamp ORDER BY event_id DESC) = 1)"


@query(f"WITH {RAW}, {_DEDUP} SELECT symbol, epoch_us(stamp) AS us, event_id, close::VARCHAR AS close FROM kept")
def dedup_keep_last(spark, d):
    return _deduplicated(spark, d).select("symbol", _us().alias("us"), "event_id", F.col("close").cast("string").alias("close"))


@query(f"WITH {RAW} SELECT symbol, sum(n - 1)::BIGINT AS duplicates, count(*) AS stamps FROM (SELECT symbol, stamp, count(*) AS n FROM raw GROUP BY ALL HAVING n > 1) GROUP BY symbol")
def dedup_duplicate_counts(spark, d):
    return duplicates(raw(spark, d), ("symbol", "timestamp")).groupBy("symbol").agg(F.sum("extra").alias("duplicates"), F.count("*").alias("stamps"))


@query(f"WITH {bars_sql('a', 'event_id % 3 <> 0')}, {bars_sql('b', 'event_id % 3 <> 1')}, u AS (SELECT *, 0 AS src FROM a UNION ALL SELECT *, 1 FROM b) SELECT symbol, epoch_us(stamp) AS us, close::VARCHAR AS close, volume::VARCHAR AS volume FROM u QUALIFY row_number() OVER (PARTITION BY symbol, stamp ORDER BY src DESC) = 1")
def merge_upsert_incoming_wins(spark, d):
    both = merge(candles(spark, d, "event_id % 3 <> 0"), candles(spark, d, "event_id % 3 <> 1"))
    return both.select("symbol", _us().alias("us"), F.col("close").cast("string").alias("close"), F.col("volume").cast("string").alias("volume"))


@query("SELECT strftime(l_shipdate, '%Y%m') AS month, count(*) AS n FROM lineitem GROUP BY 1")
def month_partition_counts(spark, d):
    return read(spark, d, "lineitem").groupBy(F.date_format("l_shipdate", "yyyyMM").alias("month")).agg(F.count("*").alias("n"))


def _filed(spark, d):
    """Orders filed by month, every 50th a month late."""
    o = read(spark, d, "orders").select("o_orderkey", _utc("o_orderdate").alias("timestamp"), F.col("o_totalprice").cast("decimal(18,8)").alias("p"))
    home = F.when(F.col("o_orderkey") % 50 == 0, F.add_months("timestamp", 1)).otherwise(F.to_date("timestamp"))
    return o.withColumn("claimed", F.year(home) * 100 + F.month(home))


_FILED = "f AS (SELECT o_orderkey, o_orderdate AS stamp, CASE WHEN o_orderkey % 50 = 0 THEN strftime(o_orderdate + INTERVAL 1 MONTH, '%Y%m')::INT ELSE strftime(o_orderdate, '%Y%m')::INT END AS claimed FROM orders)"


@query(f"WITH {_FILED} SELECT o_orderkey, claimed FROM f WHERE claimed <> strftime(stamp, '%Y%m')::INT")
def misfiled_rows(spark, d):
    return misfiled(_filed(spark, d)).select("o_orderkey", "claimed")


@query(f"WITH {_FILED}, m AS (SELECT *, strftime(stamp, '%Y%m')::INT AS own FROM f) SELECT o_orderkey, stamp IN (SELECT stamp FROM m WHERE claimed = own) AS also_home FROM m WHERE claimed <> own")
def misfiled_also_home(spark, d):
    return misfiled(_filed(spark, d)).select("o_orderkey", "also_home")


@query(f"WITH {_FILED}, g AS (SELECT claimed, min(stamp) AS lo, max(stamp) AS hi FROM f GROUP BY 1) SELECT claimed AS \"group\", CASE WHEN lo < lag(hi) OVER (ORDER BY claimed) THEN 1 ELSE 0 END AS unordered FROM g")
def unordered_seams(spark, d):
    return seams(_filed(spark, d).select(F.col("claimed").alias("group"), _us().alias("us")), "group")


@query(f"WITH {_FILED}, g AS (SELECT claimed, max(stamp) AS hi FROM f GROUP BY 1), b AS (SELECT claimed, max(hi) OVER (ORDER BY claimed ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM g) SELECT f.claimed AS \"group\", count(*) FILTER (stamp < top) AS late_rows FROM f JOIN b ON f.claimed = b.claimed GROUP BY 1")
def late_rows(spark, d):
    x = late(_filed(spark, d).select(F.col("claimed").alias("group"), _us().alias("us")), "group")
    return x.groupBy("group").agg(F.count_if("late").alias("late_rows"))


_PLAIN = f"p AS (SELECT symbol AS k, us, lag(us) OVER (PARTITION BY symbol ORDER BY us) AS prev FROM (SELECT DISTINCT symbol, epoch_us(stamp) AS us FROM c)), gaps AS (SELECT k, prev + {HOUR} AS gap_start, us AS gap_end, (us - prev) // {HOUR} - 1 AS missing FROM p WHERE us - prev > {HOUR} AND (us - prev) // {HOUR} > 1)"


@query(f"WITH {bars_sql()}, {_PLAIN} SELECT * FROM gaps")
def plain_gap_list(spark, d):
    return plain_gaps(stamps(candles(spark, d)), HOUR)


_EDGES = f"e AS (SELECT k, min(us) AS lo, max(us) AS hi FROM p GROUP BY k), edges AS (SELECT k, {S - 5 * HOUR} AS gap_start, lo AS gap_end, (lo - {S - 5 * HOUR}) // {HOUR} AS missing FROM e UNION ALL SELECT k, hi + {HOUR}, {E + 3 * HOUR}, ({E + 3 * HOUR} - hi - {HOUR}) // {HOUR} FROM e)"


@query(f"WITH {bars_sql()}, {_PLAIN}, {_EDGES} SELECT * FROM gaps UNION ALL SELECT * FROM edges WHERE missing > 0")
def plain_gaps_edges(spark, d):
    return plain_gaps(stamps(candles(spark, d)), HOUR, S - 5 * HOUR, E + 3 * HOUR)


def _session_sql(sessions: str) -> str:
    c = HOUR
    return f"""s AS ({sessions}), t AS (SELECT symbol AS k, epoch_us(stamp) AS us FROM c), series AS (SELECT DISTINCT k FROM t),
 x AS (SELECT k, sid, s, e, us, lag(us) OVER (PARTITION BY k, sid ORDER BY us) AS prev FROM t JOIN s ON us >= s AND us < e),
 m AS (SELECT k, sid, s, e, max(us) AS mx FROM x GROUP BY ALL),
 found AS (SELECT k, sid, s AS gap_start, us AS gap_end, (us - s) // {c} AS missing FROM x WHERE prev IS NULL AND us > s AND (us - s) // {c} > 0
  UNION ALL SELECT k, sid, prev + {c}, us, (us - prev) // {c} - 1 FROM x WHERE us - prev > {c} AND (us - prev) // {c} > 1
  UNION ALL SELECT k, sid, mx + {c}, e, (e - mx - {c}) // {c} FROM m WHERE mx + {c} < e AND (e - mx - {c}) // {c} > 0
  UNION ALL SELECT series.k, s.sid, s.s, s.e, (s.e - s.s) // {c} FROM series CROSS JOIN s LEFT JOIN m ON m.k = series.k AND m.sid = s.sid WHERE m.k IS NULL)"""


# Fridays at 21:00 UTC to Sundays at 22:00, clipped to the month
_WEEKEND = f"w AS (SELECT greatest(a, {S}) AS a, least(a + {49 * HOUR}, {E}) AS b FROM (SELECT unnest(range({micros(datetime(2023, 12, 29, 21, tzinfo=UTC))}, {E}, {7 * DAY})) AS a) WHERE a + {49 * HOUR} > {S})"
_OPEN = f"edge AS (SELECT b AS lo, lead(a, 1, {E}) OVER (ORDER BY a) AS hi FROM (SELECT {S} AS a, {S} AS b UNION ALL SELECT a, b FROM w)), o AS (SELECT lo AS s, hi AS e FROM edge WHERE lo < hi)"
_SESSIONS = "SELECT (row_number() OVER (ORDER BY s) - 1)::INT AS sid, s, e FROM o"


def _sessions(spark, calendar, end=END):
    return calendar.sessions(spark, START, end)


@query(f"WITH {bars_sql()}, {_session_sql(f'SELECT 0 AS sid, {S} AS s, {E + 3 * HOUR} AS e')} SELECT k, gap_start, gap_end, missing FROM found")
def session_gaps_24x7(spark, d):
    c = stamps(candles(spark, d))
    return session_gaps(c, spark.createDataFrame([(0, S, E + 3 * HOUR)], "sid int, s long, e long"), c, HOUR).drop("sid")


@query(f"WITH {bars_sql()}, {_WEEKEND}, {_OPEN}, {_session_sql(_SESSIONS)} SELECT * FROM found")
def session_gaps_forex(spark, d):
    c = stamps(candles(spark, d))
    return session_gaps(c, _sessions(spark, WeeklyCalendar()), c, HOUR)


_LATER = E + 21 * DAY
_LATE_WEEKEND, _LATE_OPEN = _WEEKEND.replace(str(E), str(_LATER)), _OPEN.replace(str(E), str(_LATER))


@query(f"WITH {bars_sql()}, {_LATE_WEEKEND}, {_LATE_OPEN}, {_session_sql(_SESSIONS)} SELECT k, sid, gap_start, gap_end, missing FROM found WHERE gap_start = (SELECT s FROM s WHERE s.sid = found.sid) AND gap_end = (SELECT e FROM s WHERE s.sid = found.sid)")
def empty_session_gaps(spark, d):
    """Sessions of a calendar that reaches three weeks beyond the bars."""
    c = stamps(candles(spark, d))
    s = _sessions(spark, WeeklyCalendar(), END + timedelta(days=21))
    return session_gaps(c, s, c, HOUR).join(s, "sid").where("gap_start = s and gap_end = e").drop("s", "e")


@query(f"WITH {bars_sql()}, {_PLAIN} SELECT k, count(*) AS gaps, sum(missing)::BIGINT AS missing FROM gaps GROUP BY k")
def gap_totals(spark, d):
    return totals(plain_gaps(stamps(candles(spark, d)), HOUR))


@query(f"WITH {_WEEKEND} SELECT a AS s, b AS e, 'weekend' AS reason FROM w")
def weekly_closures(spark, d):
    rows = [(micros(c.start), micros(c.end), c.reason) for c in WeeklyCalendar().closed_intervals(START, END)]
    return spark.createDataFrame(rows, "s long, e long, reason string")


_HOLIDAYS = ", ".join(f"({micros(datetime(h.year, h.month, h.day, tzinfo=UTC))})" for h in HOLIDAYS)
_ALL = f"every AS (SELECT a AS \"start\", b AS \"end\", 'weekend' AS reason FROM w UNION ALL SELECT h, h + {DAY}, 'holiday' FROM (VALUES {_HOLIDAYS}) AS t(h)), isl AS (SELECT *, sum(new) OVER (ORDER BY \"start\", \"end\") AS i FROM (SELECT *, CASE WHEN \"start\" <= max(\"end\") OVER (ORDER BY \"start\", \"end\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM every)), mrg AS (SELECT min(\"start\") AS \"start\", max(\"end\") AS \"end\", CASE WHEN min(reason) = max(reason) THEN min(reason) ELSE 'market closure' END AS reason FROM isl GROUP BY i)"


def _closures(spark):
    rows = [(micros(c.start), micros(c.end), c.reason) for c in WeeklyCalendar().closed_intervals(START, END)]
    rows += [(s := micros(datetime(h.year, h.month, h.day, tzinfo=UTC)), s + DAY, "holiday") for h in HOLIDAYS]
    return spark.createDataFrame(rows, "start long, end long, reason string")


@query(f"WITH {_WEEKEND}, {_ALL} SELECT * FROM mrg")
def closures_with_holidays_merged(spark, d):
    return merged(_closures(spark))


@query(f"WITH {_WEEKEND}, {_ALL} SELECT b AS \"start\", nxt AS \"end\" FROM (SELECT \"end\" AS b, lead(\"start\", 1, {E}) OVER (ORDER BY \"end\") AS nxt FROM (SELECT \"start\", \"end\" FROM mrg UNION ALL SELECT {S}, {S})) WHERE b < nxt")
def open_sessions(spark, d):
    return complement(merged(_closures(spark)), F.lit(S), F.lit(E))


@query(f"WITH {_WEEKEND}, {_OPEN} SELECT c AS cadence, sum((e + c - 1) // c - (s + c - 1) // c)::BIGINT AS expected FROM (SELECT *, unnest([60000000, 600000000, {HOUR}]) AS c FROM (SELECT s, e FROM o)) GROUP BY c")
def expected_candles(spark, d):
    rows = [(c, WeeklyCalendar().expected_candles(START, END, c)) for c in (60_000_000, 600_000_000, HOUR)]
    return spark.createDataFrame(rows, "cadence long, expected long")


@query(f"WITH {_WEEKEND} SELECT event_type, count(*) FILTER (NOT EXISTS (SELECT 1 FROM w WHERE epoch_us(ts) >= a AND epoch_us(ts) < b)) AS open_rows, count(*) AS n FROM events GROUP BY 1")
def is_open_flag(spark, d):
    e = read(spark, d, "events").select("event_type", _us_of(_utc("ts")).alias("us"))
    hit = within(e, _sessions(spark, WeeklyCalendar())).groupBy("event_type").agg(F.count("*").alias("open_rows"))
    n = e.groupBy("event_type").agg(F.count("*").alias("n")).join(hit, "event_type", "left")
    return n.select("event_type", F.coalesce("open_rows", F.lit(0)).alias("open_rows"), "n")


def _us_of(c):
    return F.unix_micros(c)


@query(f"WITH {bars_sql()} SELECT symbol, count(*) AS n, epoch_us(min(stamp)) AS first, epoch_us(max(stamp)) AS last FROM c GROUP BY 1")
def coverage_summary(spark, d):
    return candles(spark, d).groupBy("symbol").agg(F.count("*").alias("n"), F.min(_us()).alias("first"), F.max(_us()).alias("last"))


@query(f"WITH {bars_sql()}, {_WEEKEND}, {_OPEN}, {_session_sql(_SESSIONS)}, g AS (SELECT k, count(*) AS gaps FROM found GROUP BY k) SELECT symbol, count(*) AS n, CASE WHEN count(*) = 0 THEN 'empty' WHEN coalesce(max(g.gaps), 0) > 0 THEN 'incomplete' ELSE 'ok' END AS status FROM c LEFT JOIN g ON g.k = c.symbol GROUP BY symbol")
def quality_status(spark, d):
    bars = candles(spark, d)
    c = stamps(bars)
    g = totals(session_gaps(c, _sessions(spark, WeeklyCalendar()), c, HOUR)).select(F.col("k").alias("symbol"), "gaps")
    n = bars.groupBy("symbol").agg(F.count("*").alias("n")).join(g, "symbol", "left")
    status = F.when(F.col("n") == 0, QualityStatus.EMPTY.value).when(F.coalesce("gaps", F.lit(0)) > 0, QualityStatus.INCOMPLETE.value).otherwise(QualityStatus.OK.value)
    return n.select("symbol", "n", status.alias("status"))


@query(f"WITH {RAW}, j AS (SELECT *, epoch_us(stamp) >= {micros(_MID[0])} AND epoch_us(stamp) < {micros(_MID[1])} AS inside FROM raw) SELECT count(*) FILTER (inside) AS candles, count(*) FILTER (NOT inside) AS out_of_range, count(*) FILTER (inside AND {REASON} IS NOT NULL) AS invalid, count(*) FILTER (event_id % 50 = 0) AS misfiled, epoch_us(min(stamp) FILTER (inside)) AS actual_start, epoch_us(max(stamp) FILTER (inside)) AS actual_end FROM j")
def audit_summary(spark, d):
    own = F.year("timestamp") * 100 + F.month("timestamp")
    r = raw(spark, d).withColumn("claimed", F.when(F.col("event_id") % 50 == 0, F.lit(209901)).otherwise(own))
    a = audit(r, *_MID)
    return a.withColumn("actual_start", _us("actual_start")).withColumn("actual_end", _us("actual_end"))


_WINDOWS = [(i, S + i * 5 * DAY, S + i * 5 * DAY + 7 * DAY) for i in range(6)]


@query(f"WITH {bars_sql()}, m AS (SELECT * FROM (VALUES {', '.join(str(x) for x in _WINDOWS)}) AS t(id, s, e)) SELECT id, count(stamp) AS stored FROM m LEFT JOIN c ON epoch_us(stamp) >= s AND epoch_us(stamp) < e GROUP BY id")
def manifest_window_counts(spark, d):
    return manifest_counts(stamps(candles(spark, d)), spark.createDataFrame(_WINDOWS, "id int, s long, e long"))


_SIDES = "event_id % 11 <> 0", "event_id % 10 <> 0"
_KEYS = ("symbol", "timestamp")


def _judged(spark, d):
    """Bars without every eleventh event against bars without every tenth, of each event type."""
    left, right = (candles(spark, d, x) for x in _SIDES)
    t = ComparisonThresholds()
    return cmp.with_verdict(cmp.paired(left, right, keys=_KEYS), str(t.price_tolerance), str(t.volume_tolerance))


def _off(c: str, tol: str) -> str:
    return f"(abs(l.{c} - r.{c}) > {tol} * greatest(abs(l.{c}), abs(r.{c})))"


_POFF = "(" + " OR ".join(_off(c, "0.0001") for c in PRICES) + ")"
_VOFF = _off("volume", "0.05")
_PAIR = f"{bars_sql('l', _SIDES[0])}, {bars_sql('r', _SIDES[1])}, pairs AS (SELECT coalesce(l.symbol, r.symbol) AS symbol, coalesce(l.stamp, r.stamp) AS stamp, l.stamp IS NULL AS no_left, r.stamp IS NULL AS no_right, {_POFF} AS price_off, {_VOFF} AS volume_off, greatest({', '.join(f'abs(l.{c} - r.{c})' for c in PRICES)}) AS price_gap, abs(l.volume - r.volume) AS volume_gap, {', '.join(f'l.{c} AS l_{c}, r.{c} AS r_{c}' for c in (*PRICES, 'volume'))} FROM l FULL JOIN r ON l.stamp = r.stamp AND l.symbol = r.symbol)"


@query(f"WITH {_PAIR} SELECT symbol, epoch_us(stamp) AS us, NOT price_off AND NOT volume_off AS matching FROM pairs WHERE NOT no_left AND NOT no_right")
def compare_inner_matched(spark, d):
    return _judged(spark, d).where("not no_left and not no_right").select("symbol", _us().alias("us"), F.expr("not price_off and not volume_off").alias("matching"))


@query(f"WITH {_PAIR} SELECT symbol, epoch_us(stamp) AS us FROM pairs WHERE no_left")
def compare_missing_left(spark, d):
    return _judged(spark, d).where("no_left").select("symbol", _us().alias("us"))


@query(f"WITH {_PAIR} SELECT symbol, epoch_us(stamp) AS us FROM pairs WHERE no_right")
def compare_missing_right(spark, d):
    return _judged(spark, d).where("no_right").select("symbol", _us().alias("us"))


@query(f"WITH {_PAIR} SELECT symbol, epoch_us(stamp) AS us, price_off, volume_off FROM pairs WHERE price_off OR volume_off")
def compare_relative_mismatch(spark, d):
    return _judged(spark, d).where("price_off or volume_off").select("symbol", _us().alias("us"), "price_off", "volume_off")


_FIELDS = " UNION ALL ".join(f"SELECT symbol, stamp, {i} AS position, '{c}' AS field, l_{c}::DECIMAL(28,8) AS l, r_{c}::DECIMAL(28,8) AS r FROM pairs WHERE abs(l_{c} - r_{c}) > {'0.05' if c == 'volume' else '0.0001'} * greatest(abs(l_{c}), abs(r_{c}))" for i, c in enumerate((*PRICES, "volume")))


@query(f"WITH {_PAIR}, f AS ({_FIELDS}) SELECT symbol, epoch_us(stamp) AS us, field, l::VARCHAR AS \"left\", r::VARCHAR AS \"right\", (l - r)::DECIMAL(28,8)::VARCHAR AS difference FROM f ORDER BY symbol, stamp, position LIMIT 20")
def compare_field_differences_top20(spark, d):
    f = cmp.first_differences(cmp.field_differences(_judged(spark, d), "0.0001", "0.05", _KEYS), keys=_KEYS)
    return f.select("symbol", _us().alias("us"), "field", *[F.col(c).cast("string").alias(c) for c in ("left", "right", "difference")])


@query(f"WITH {_PAIR} SELECT max(price_gap)::DECIMAL(28,8)::VARCHAR AS gap, epoch_us(min(stamp) FILTER (price_gap = (SELECT max(price_gap) FROM pairs))) AS us FROM pairs")
def compare_max_diff_argmax(spark, d):
    return cmp.tally(_judged(spark, d)).select(F.col("max_price_difference").cast("decimal(28,8)").cast("string").alias("gap"), _us("max_price_difference_at").alias("us"))


@query(f"WITH {_PAIR} SELECT count(*) FILTER (volume_off) AS mismatches, max(volume_gap)::DECIMAL(28,8)::VARCHAR AS gap, epoch_us(min(stamp) FILTER (volume_gap = (SELECT max(volume_gap) FROM pairs))) AS us FROM pairs")
def compare_volume_mismatch(spark, d):
    t = cmp.tally(_judged(spark, d))
    return t.select(F.col("volume_mismatches").alias("mismatches"), F.col("max_volume_difference").cast("decimal(28,8)").cast("string").alias("gap"), _us("max_volume_difference_at").alias("us"))


_GAPS_OF = lambda t: f"SELECT symbol AS k, prev + {HOUR} AS a, us AS b, (us - prev) // {HOUR} - 1 AS missing FROM (SELECT symbol, us, lag(us) OVER (PARTITION BY symbol ORDER BY us) AS prev FROM (SELECT symbol, epoch_us(stamp) AS us FROM {t})) WHERE us - prev > {HOUR} AND (us - prev) // {HOUR} > 1"


@query(f"WITH {_PAIR}, gl AS ({_GAPS_OF('l')}), gr AS ({_GAPS_OF('r')}) SELECT CASE WHEN gr.a IS NULL THEN 'left' ELSE 'right' END AS side, coalesce(gl.k, gr.k) AS k, coalesce(gl.a, gr.a) AS gap_start, coalesce(gl.b, gr.b) AS gap_end, coalesce(gl.missing, gr.missing) AS missing FROM gl FULL JOIN gr ON gl.k = gr.k AND gl.a = gr.a AND gl.b = gr.b WHERE gl.a IS NULL OR gr.a IS NULL")
def compare_gap_set_difference(spark, d):
    left, right = (plain_gaps(stamps(candles(spark, d, x)), HOUR) for x in _SIDES)
    return differences(left, right)


@query(f"WITH {_PAIR}, n AS (SELECT count(*) FILTER (NOT no_left AND NOT no_right) AS c, count(*) FILTER (no_left OR no_right) AS m, count(*) FILTER (price_off) AS p, count(*) FILTER (volume_off) AS v FROM pairs), g AS (SELECT *, greatest(CASE WHEN m / (c + m) > 0.01 THEN 2 WHEN m > 0 THEN 1 ELSE 0 END, CASE WHEN p / c > 0.001 THEN 2 WHEN p > 0 THEN 1 ELSE 0 END, CASE WHEN v > 0 THEN 1 ELSE 0 END) AS k FROM n) SELECT c AS compared, m AS missing, p AS price_mismatches, v AS volume_mismatches, CASE k WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS status FROM g")
def compare_verdict_ratios(spark, d):
    t = ComparisonThresholds()
    n = cmp.tally(_judged(spark, d)).select("candles_compared", (F.col("missing_from_left") + F.col("missing_from_right")).alias("missing"), "price_mismatches", "volume_mismatches")
    c, m = F.col("candles_compared"), F.col("missing")
    rank = lambda x, warn, fail: F.when(x > fail, 2).when(x > warn, 1).otherwise(0)
    k = F.greatest(rank(m / (c + m), t.missing_warn_ratio, t.missing_fail_ratio), rank(F.col("price_mismatches") / c, t.price_mismatch_warn_ratio, t.price_mismatch_fail_ratio), rank(F.col("volume_mismatches") / c, t.volume_mismatch_warn_ratio, t.volume_mismatch_fail_ratio))
    return n.select(c.alias("compared"), "missing", "price_mismatches", "volume_mismatches", F.when(k == 2, "fail").when(k == 1, "warn").otherwise("pass").alias("status"))


@query(f"WITH {bars_sql()}, h AS (SELECT symbol, stamp FROM c WHERE epoch_us(stamp) < {micros(_MID[0])} UNION ALL SELECT symbol, stamp FROM c WHERE epoch_us(stamp) >= {micros(_MID[0])} - {HOUR}), w AS (SELECT symbol, stamp FROM c) SELECT (SELECT count(*) FROM w) AS stamps, (SELECT count(*) FROM (SELECT * FROM w EXCEPT ALL SELECT * FROM h)) AS lost, (SELECT count(*) FROM (SELECT * FROM h EXCEPT ALL SELECT * FROM w)) AS extra, (SELECT count(*) FROM (SELECT symbol, stamp FROM h GROUP BY ALL HAVING count(*) > 1)) AS repeated")
def pagination_stitch(spark, d):
    """Halves that overlap by an hour, against the whole."""
    w = candles(spark, d).select("symbol", "timestamp")
    h = w.where(in_range(None, _MID[0])).unionByName(w.where(F.col("timestamp") >= at_micros(micros(_MID[0]) - HOUR)))
    return stitch_counts(w, h, ("symbol", "timestamp"))


_CHUNKED = datetime(2019, 11, 15, tzinfo=UTC), datetime(2020, 8, 10, tzinfo=UTC)


def _grid(spark, size):
    return spark.createDataFrame([(c.index, micros(c.start), micros(c.end)) for c in plan_chunks(*_CHUNKED, size)], "i int, s long, e long")


def _grid_sql(bounds: str) -> str:
    a, b = map(micros, _CHUNKED)
    return f"WITH b AS ({bounds}), p AS (SELECT {a} AS x UNION SELECT x FROM b WHERE x > {a} AND x < {b}) SELECT (row_number() OVER (ORDER BY x) - 1)::INT AS i, x AS s, lead(x, 1, {b}) OVER (ORDER BY x) AS e FROM p"


@query(_grid_sql("SELECT epoch_us(unnest(generate_series(TIMESTAMP '2019-01-01', TIMESTAMP '2021-01-01', INTERVAL 3 MONTH))) AS x"))
def chunk_grid_month(spark, d):
    return _grid(spark, ChunkSize(3))


@query(_grid_sql(f"SELECT unnest(range(0, {micros(_CHUNKED[1])}, {14 * DAY})) AS x"))
def chunk_grid_duration(spark, d):
    return _grid(spark, ChunkSize(2, "w"))


_HOURS = (1, 2, 24, 25, 31 * 24, 31 * 24 + 1)


@query(f"SELECT h AS hours, CASE WHEN h <= 1 THEN 'smoke' WHEN h <= 24 THEN 'daily' WHEN TIMESTAMP '2024-01-01' + to_hours(h) <= TIMESTAMP '2024-02-01' THEN 'monthly' ELSE 'historical' END AS stage FROM (SELECT unnest({list(_HOURS)}) AS h)")
def stage_of_range(spark, d):
    return spark.createDataFrame([(h, stage_of(START, START + timedelta(hours=h)).value) for h in _HOURS], "hours int, stage string")


@query("SELECT c AS candidate, CASE WHEN c / 1000.0 > 0.01 THEN 'fail' WHEN c > 0 THEN 'warn' ELSE 'pass' END AS status FROM (SELECT unnest([0, 1, 10, 11]) AS c)")
def missing_grades(spark, d):
    return spark.createDataFrame([(c, grade(c / 1000, 0.0, 0.01).value) for c in (0, 1, 10, 11)], "candidate int, status string")


@query("SELECT strftime(l_shipdate, '%Y%m') AS month, count(*) AS n, min(l_extendedprice)::DECIMAL(18,2)::VARCHAR AS low, max(l_extendedprice)::DECIMAL(18,2)::VARCHAR AS high FROM lineitem GROUP BY 1")
def dataset_identity_counts(spark, d):
    return read(spark, d, "lineitem").groupBy(F.date_format("l_shipdate", "yyyyMM").alias("month")).agg(F.count("*").alias("n"), F.min("l_extendedprice").cast("decimal(18,2)").cast("string").alias("low"), F.max("l_extendedprice").cast("decimal(18,2)").cast("string").alias("high"))


@query("SELECT epoch_us(l_shipdate) AS us, l_returnflag AS symbol, arg_min(p, k)::VARCHAR AS open, max(p)::VARCHAR AS high, min(p)::VARCHAR AS low, arg_max(p, k)::VARCHAR AS close, sum(l_quantity::DECIMAL(18,2))::DECIMAL(28,2)::VARCHAR AS volume FROM (SELECT *, l_extendedprice::DECIMAL(18,2) AS p, (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem) GROUP BY 1, 2")
def lineitem_daily_candles(spark, d):
    li = read(spark, d, "lineitem").select(F.unix_micros(_utc("l_shipdate")).alias("us"), F.col("l_returnflag").alias("symbol"), F.col("l_extendedprice").cast("decimal(18,2)").alias("p"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("k"), F.col("l_quantity").cast("decimal(18,2)").alias("q"))
    text = lambda c, n: c.cast("string").alias(n)
    return li.groupBy("us", "symbol").agg(text(F.min_by("p", "k"), "open"), text(F.max("p"), "high"), text(F.min("p"), "low"), text(F.max_by("p", "k"), "close"), text(F.sum("q").cast("decimal(28,2)"), "volume"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to bars, rules, range, duplicates, session gaps: a line for each symbol."""
    bars = keep_last(valid(classify(candles(spark, sf_dir), START, END)), [F.lit(0)]).select(*CANDLE.names)
    c = stamps(bars)
    g = totals(session_gaps(c, _sessions(spark, AlwaysOpen()), c, HOUR)).withColumnRenamed("k", "symbol")
    n = bars.groupBy("symbol").agg(F.count("*").alias("candles"), F.min(_us()).alias("first"), F.max(_us()).alias("last"))
    return n.join(g, "symbol", "left").na.fill(0, ["gaps", "missing"])


QUERIES["flagship"] = flagship
SQL["flagship"] = f"WITH {bars_sql()}, {_session_sql(f'SELECT 0 AS sid, {S} AS s, {E} AS e')}, g AS (SELECT k, count(*) AS gaps, sum(missing)::BIGINT AS missing FROM found GROUP BY k) SELECT symbol, count(*) AS candles, epoch_us(min(stamp)) AS first, epoch_us(max(stamp)) AS last, coalesce(max(gaps), 0) AS gaps, coalesce(max(missing), 0) AS missing FROM c LEFT JOIN g ON g.k = c.symbol WHERE epoch_us(stamp) >= {S} AND epoch_us(stamp) < {E} GROUP BY symbol"

from . import queries_stored  # noqa: E402, F401  (registers the queries over stored data)

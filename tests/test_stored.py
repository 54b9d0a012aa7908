import json
import os
from datetime import UTC, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import T0, row

from candlewick.cli import main
from candlewick.operators.calendars import AlwaysOpen, WeeklyCalendar
from candlewick.operators.reports import compare_datasets, files_fingerprint, validate_dataset
from candlewick.plans.chunks import ChunkSize, Stage, months_later, parse_chunk_size, plan_chunks, stage_of, window_of
from candlewick.plans.documents import fingerprint, load, plain
from candlewick.plans.ingest import Checkpoint, CheckpointStore, DownloadPipeline, carry_over
from candlewick.plans.status import ComparisonThresholds, QualityStatus, QualityThresholds, Status, worst
from candlewick.plans.verification import ComparisonStore, VerificationRecord, VerificationStore, check_source, permission_for_range, run_stage
from candlewick.sources.base import ProviderDataError, ProviderRateLimitError, status_error
from candlewick.sources.csv import CsvProviderError, CsvSource
from candlewick.sources.http import PagedHttpSource
from candlewick.sources.limits import RateLimit, RateLimiter, Retrier, RetryPolicy
from candlewick.sources.store import CandleStore, month_of

MIN = timedelta(minutes=1)
S = "EUR/USD"


def csv_file(path, rows, header="timestamp,open,high,low,close,volume"):
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


def line(i, o=1.17, v=100, start=T0):
    return f"{(start + i * MIN).isoformat()},{o:.5f},{o + 0.0005:.5f},{o - 0.0005:.5f},{o:.5f},{v}"


@pytest.fixture
def roots(tmp_path):
    return {k: str(tmp_path / k) for k in ("output_root", "manifest_root", "quality_root", "checkpoint_root")}


def test_upsert_by_month(spark, candles, tmp_path):
    store = CandleStore(spark, str(tmp_path))
    late = datetime(2026, 8, 31, 23, 58, tzinfo=UTC)
    files = store.write(candles([row(i, start=late) for i in range(4)]), S, "1min")
    assert [month_of(f) for f in files] == [(2026, 8), (2026, 9)]
    store.write(candles([row(3, "1.5", start=late), row(4, start=late)]), S, "1min")
    got = store.read(S, "1min").orderBy("timestamp").collect()
    assert len(got) == 5 and got[3].open == Decimal("1.5")
    assert store.read(S, "1min", late, late + 2 * MIN).count() == 2
    assert len(store.files(S, "1min", late, datetime(2026, 9, 1, tzinfo=UTC))) == 1
    assert store.write(candles([]), S, "1min") == [] and store.has_rows(S, "1min", late, late + MIN)
    import pyarrow.parquet as pq

    schema = pq.read_schema(files[0])
    assert str(schema.field("timestamp").type) == "timestamp[us, tz=UTC]" and str(schema.field("volume").type) == "decimal128(28, 8)"
    store.write(candles([row(0, start=late)]), S, "1min", replace=True)
    assert store.read(S, "1min").count() == 4


def test_root_as_uri(spark, candles, tmp_path):
    uri = tmp_path.as_uri()
    store = CandleStore(spark, uri)
    files = store.write(candles([row(i, start=datetime(2026, 8, 31, 23, 58, tzinfo=UTC)) for i in range(4)]), S, "1min")
    assert files == store.files(S, "1min") and all(f.startswith(uri + "/") for f in files)
    stray = Path(tmp_path, store.folder.relative(files[0])).with_name("other.parquet")
    stray.write_bytes(Path(tmp_path, store.folder.relative(files[0])).read_bytes())
    store.write(candles([row(0, "1.5", start=datetime(2026, 8, 31, 23, 58, tzinfo=UTC))]), S, "1min")
    assert store.read(S, "1min").count() == 4 and not stray.exists() and [p.rows for p in store.inspect(S, "1min")] == [2, 2]
    assert store.bounds(files)[0] == datetime(2026, 8, 31, 23, 58, tzinfo=UTC) and store.has_rows(S, "1min", *store.bounds(files))
    other = CandleStore(spark, str(tmp_path))
    assert other.files(S, "1min") == [f.removeprefix("file://") for f in files]
    assert files_fingerprint(files, store.folder) == files_fingerprint(other.files(S, "1min"), other.folder)
    v = validate_dataset(spark, symbol=S, timeframe="1min", data_root=uri)
    assert (v.candles, v.missing_candles) == (4, 0)


def test_months_outside_a_range_are_not_read(spark, candles, tmp_path):
    store = CandleStore(spark, str(tmp_path))
    store.write(candles([row(i, step=timedelta(days=20)) for i in range(6)]), S, "1min")
    df = store.read(S, "1min", T0, T0 + timedelta(days=1))
    assert len(df.inputFiles()) == 1 and "GreaterThanOrEqual(timestamp" in df._jdf.queryExecution().executedPlan().toString()


def test_csv_is_strict(spark, tmp_path):
    end = T0 + timedelta(hours=1)
    get = lambda p: CsvSource(spark, p).fetch_candles(S, T0, end, "1min")
    good = csv_file(tmp_path / "a.csv", [line(1), line(0), line(99)])
    assert [r.ord for r in get(good).orderBy("ord").collect()] == [2, 3]
    zones = csv_file(tmp_path / "z.csv", ["2026-08-10T03:00:00+03:00,1,1,1,1,1", "20260810T000100Z,1,1,1,1,", "2026-08-09T21:02:00-03:00,1,1,1,1,1", "2026-08-10 00:03:00+00,1,1,1,1,1"])
    assert sorted(r.timestamp.astimezone(UTC).minute for r in get(zones).collect()) == [0, 1, 2, 3]
    for name, rows, header, text in [
        ("n", [line(0), line(1).replace("1.17050", "not-a-price")], None, "line 3: high 'not-a-price'"),
        ("t", [line(0), "10/08/2026 00:01,1,1,1,1,1"], None, "line 3: timestamp"),
        ("u", ["2026-08-10T00:00:00,1,1,1,1,1"], None, "line 2: timestamp"),
        ("r", [line(0) + ",7"], None, "more values than columns"),
        ("b", [line(0).replace(",1.17000,100", ",,100")], None, "line 2: close"),
        ("v", [line(0, v=-1)], None, "line 2: volume"),
        ("m", ["x"], "timestamp,open,close", "missing columns high, low"),
    ]:
        p = csv_file(tmp_path / f"{name}.csv", rows, *([header] if header else []))
        with pytest.raises(CsvProviderError, match=text):
            get(p)
    many = csv_file(tmp_path / "s.csv", [line(0) + ",eur/usd", "bad,x,x,x,x,x,GBP/USD", line(1) + ", EUR_USD "], "Timestamp, Open,high,low,close,volume,SYMBOL")
    assert get(many).count() == 1 and CsvSource(spark, many).get_supported_symbols() == ["EUR/USD", "EUR_USD", "GBP/USD"]
    short = csv_file(tmp_path / "q.csv", [line(0).rsplit(",", 1)[0]])
    assert [r.volume for r in get(short).collect()] == [0]
    d = tmp_path / "dir"
    d.mkdir()
    csv_file(d / "EUR_USD_1min.csv", [line(0)])
    csv_file(d / "GBP_USD.csv", [])
    src = CsvSource(spark, str(d))
    assert src.get_supported_symbols() == ["EUR/USD", "GBP/USD"] and src.health_check() and src.fetch_candles("gbp/usd", T0, end, "1min").count() == 0
    with pytest.raises(CsvProviderError):
        src.fetch_candles("JPY/USD", T0, end, "1min")


def test_download_adds_up_and_resumes(spark, tmp_path, roots):
    bad = line(3).split(",")
    bad[2] = "1.0"
    src = CsvSource(spark, csv_file(tmp_path / "EUR_USD_1min.csv", [line(2), line(0), line(1, 1.2), line(1, 1.3), ",".join(bad), line(-5)]))
    pipe = DownloadPipeline(spark, src, calendar=AlwaysOpen(), **roots)
    r = pipe.run(symbol=S, start=T0, end=T0 + timedelta(minutes=10))
    assert (r.downloaded_count, r.out_of_range_count, r.invalid_count, r.duplicate_count, r.retained_count) == (5, 0, 1, 1, 3)
    assert r.quality.status is QualityStatus.INVALID and r.quality.missing_candles == 7 and r.chunks_failed == 0
    again = pipe.run(symbol=S, start=T0, end=T0 + timedelta(minutes=10))
    assert again.chunks_skipped == 1 and again.downloaded_count == 0 and again.retained_count == 3
    for f in r.files:
        (tmp_path / f).unlink()
    repaired = pipe.run(symbol=S, start=T0, end=T0 + timedelta(minutes=10))
    assert repaired.chunks_repaired == [0] and repaired.retained_count == 3
    v = validate_dataset(spark, symbol=S, timeframe="1min", data_root=roots["output_root"], manifest_root=roots["manifest_root"])
    assert v.range_source == "manifest" and v.manifests[0].agrees and v.candles == 3 and v.status is QualityStatus.INCOMPLETE
    json.dumps(plain(v))


def test_a_failed_chunk_leaves_the_others(spark, tmp_path, roots):
    src = CsvSource(spark, csv_file(tmp_path / "EUR_USD_1min.csv", [line(0), line(0, start=datetime(2026, 9, 2, tzinfo=UTC)) + ",9"]))
    r = DownloadPipeline(spark, src, chunk_size=ChunkSize(), **roots).run(symbol=S, start=T0, end=datetime(2026, 9, 10, tzinfo=UTC))
    assert r.chunks_failed == 2 and "CsvProviderError" in r.failures[0] and r.quality.status is QualityStatus.FAILED


def test_audit_finds_defects(spark, candles, tmp_path):
    store = CandleStore(spark, str(tmp_path))
    store.write(candles([row(i) for i in range(10) if i not in (4, 5)] + [row(0, start=datetime(2026, 9, 1, tzinfo=UTC))]), S, "1min")
    aug = next(p for p in store.files(S, "1min") if "month=08" in p)
    sep = Path(aug).parent.parent / "month=09" / "candles.parquet"
    spark.read.parquet(str(sep)).unionByName(candles([row(2), row(3, h="1.0")])).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "x"))
    next((tmp_path / "x").glob("part-*")).replace(sep)
    v = validate_dataset(spark, symbol=S, timeframe="1min", data_root=str(tmp_path), start=T0, end=T0 + timedelta(minutes=10))
    assert (v.candles, v.duplicate_candles, v.misfiled_rows, v.unordered_rows, v.invalid_rows, v.out_of_range_rows) == (10, 2, 2, 1, 1, 1)
    assert v.missing_candles == 2 and v.status is QualityStatus.INVALID and len(v.problems) == 6
    sep.write_bytes(b"no parquet")
    broken = validate_dataset(spark, symbol=S, timeframe="1min", data_root=str(tmp_path))
    assert not broken.readable and "candles.parquet" in broken.read_error and broken.candles == 8
    assert validate_dataset(spark, symbol="ABC", timeframe="1min", data_root=str(tmp_path)).status is QualityStatus.EMPTY


def test_weekend_is_no_gap(spark, candles, tmp_path):
    fri, sun = datetime(2026, 7, 31, 20, tzinfo=UTC), datetime(2026, 8, 2, 22, tzinfo=UTC)
    CandleStore(spark, str(tmp_path)).write(candles([row(i, start=s) for s in (fri, sun) for i in range(60)]), S, "1min")
    v = validate_dataset(spark, symbol=S, timeframe="1min", data_root=str(tmp_path), calendar=WeeklyCalendar(), start=fri, end=sun + timedelta(hours=1))
    assert v.ok and v.expected_candles == 120


def pair(spark, candles, tmp_path, left, right, **more):
    for side, rows in (("l", left), ("r", right)):
        CandleStore(spark, str(tmp_path / side)).write(candles(rows), S, "1min")
    return compare_datasets(spark, symbol=S, timeframe="1min", left_root=str(tmp_path / "l"), right_root=str(tmp_path / "r"), **more)


def test_two_feeds(spark, candles, tmp_path):
    r = pair(spark, candles, tmp_path, [row(i) for i in range(120)], [row(i, "1.17002", v="101") for i in range(120) if i != 60])
    assert (r.candles_compared, r.price_mismatches, r.missing_from_right, r.gaps_only_right, r.status) == (119, 0, 1, 1, Status.WARN)
    assert r.max_price_difference == Decimal("0.00002") and r.max_price_difference_at == T0 and r.missing_from_right_samples == [T0 + 60 * MIN]
    store = ComparisonStore(str(tmp_path / "rec"))
    t = ComparisonThresholds()
    path = store.save(r, t)
    mark = json.loads(path.read_text())["fingerprint"]
    assert store.valid("unknown", "unknown", S, "1min", mark).report.candles_compared == 119 and store.valid("unknown", "unknown", S, "1min", "x") is None


def test_comparison_verdicts(spark, candles, tmp_path):
    r = pair(spark, candles, tmp_path / "a", [row(i) for i in range(10)], [row(i, "1.3" if i == 3 else "1.17") for i in range(10)])
    assert r.status is Status.FAIL and r.price_mismatches == 1 and [d.field for d in r.differences] == ["open", "high", "low", "close"] and r.max_price_difference_at == T0 + 3 * MIN
    empty = compare_datasets(spark, symbol=S, timeframe="1min", left_root=str(tmp_path / "n"), right_root=str(tmp_path / "m"))
    assert empty.blocked and len(empty.problems) == 2
    off = pair(spark, candles, tmp_path / "b", [row(i) for i in range(10)], [row(i) for i in range(10)], start=T0 + timedelta(days=9))
    assert off.status is Status.BLOCKED


def test_thresholds_and_order():
    with pytest.raises(TypeError):
        ComparisonThresholds(price_tolerance=0.1)
    with pytest.raises(ValueError):
        QualityThresholds(0.2, 0.1)
    q = QualityThresholds()
    assert [q.grade_missing(*x) for x in ((0, None), (1, None), (1, 1000), (11, 1000))] == [Status.PASS, Status.FAIL, Status.WARN, Status.FAIL]
    assert worst([]) is Status.PASS and worst([Status.BLOCKED, Status.WARN]) is Status.BLOCKED and worst([Status.FAIL, Status.BLOCKED]) is Status.FAIL


def test_chunks_and_stages():
    d = lambda *a: datetime(*a, tzinfo=UTC)
    got = plan_chunks(d(2019, 11, 15), d(2020, 2, 10), ChunkSize())
    assert [c.start for c in got] == [d(2019, 11, 15), d(2019, 12, 1), d(2020, 1, 1), d(2020, 2, 1)] and got[-1].end == d(2020, 2, 10)
    assert [c.start.month for c in plan_chunks(d(2019, 2, 15), d(2019, 11, 1), ChunkSize(3))] == [2, 4, 7, 10]
    assert len(plan_chunks(d(2020, 1, 1, 5), d(2020, 1, 3, 5), ChunkSize(1, "d"))) == 3
    assert plan_chunks(d(2020, 1, 1), d(2020, 1, 20), parse_chunk_size("2w"))[0].end.weekday() == 3
    assert months_later(d(2020, 1, 31), 1) == d(2020, 2, 29) and stage_of(d(2020, 1, 1), d(2020, 2, 1)) is Stage.MONTHLY and stage_of(d(2020, 1, 1), d(2020, 2, 1, 1)) is Stage.HISTORICAL
    for size in ("1month", "3months", "7d", "12h", "30min", "2w"):
        assert parse_chunk_size(size).label == size
    assert parse_chunk_size(" 6 MONTHS ") == ChunkSize(6) and parse_chunk_size("30min") == ChunkSize(30, "min")
    assert [c.start.month for c in plan_chunks(d(2019, 12, 15), d(2020, 11, 1), ChunkSize(5))] == [12, 4, 9]
    assert len(plan_chunks(d(2020, 1, 1), d(2020, 1, 1, 2), ChunkSize(30, "min"))) == 4
    with pytest.raises(ValueError, match="timezone-aware"):
        plan_chunks(datetime(2019, 1, 1), d(2019, 2, 1), ChunkSize())  # noqa: DTZ001
    for bad in ("", "0d", "5y", "-1d", "month", "7", "1.5d", "d7", "0months"):
        with pytest.raises(ValueError):
            parse_chunk_size(bad)
    with pytest.raises(ValueError):
        window_of(Stage.HISTORICAL, d(2020, 1, 1))
    with pytest.raises(ValueError):
        plan_chunks(d(2020, 1, 1), d(2020, 1, 1), ChunkSize())


def test_checkpoints_match_by_bounds(tmp_path):
    chunks = plan_chunks(T0, T0 + timedelta(days=3), ChunkSize(1, "d"))
    store = CheckpointStore(str(tmp_path))
    c = store.open(provider="csv", symbol=S, timeframe="1min", start=T0, end=chunks[-1].end, chunks=chunks, chunk_size="1d")
    from candlewick.plans.ingest import ChunkStatus

    c.chunks[1].status, c.chunks[1].row_count, c.chunks[2].attempts = ChunkStatus.COMPLETED, 7, 2
    path = store.save(c)
    back = load(Checkpoint, path)
    assert back.chunks[1].complete and len(back.pending()) == 2
    again = carry_over(back, plan_chunks(T0 + timedelta(days=1), T0 + timedelta(days=3), ChunkSize(1, "d")))
    assert [(x.index, x.complete, x.attempts) for x in again] == [(0, True, 0), (1, False, 2)]
    path.write_text("{")
    assert store.load(S, "1min", T0, chunks[-1].end) is None


class Pages:
    def __init__(self, n, fail=0):
        self.n, self.fail, self.calls = n, fail, []

    def __call__(self, path, p):
        self.calls.append((path, p))
        if self.fail:
            self.fail -= 1
            raise status_error(429, path, 5.0)
        if path == "instrumentList":
            return [{"id": 7, "name": S}]
        base = int(T0.timestamp() * 1000)
        all_ = [base + i * 60_000 for i in range(self.n)]
        got = [t for t in all_ if p["start"] <= t <= p["end"]][-p["count"] :]
        return {"candles": [{"timestamp": t, "bid_open": 1.17, "bid_high": 1.18, "bid_low": 1.16, "bid_close": 1.17} for t in got]}


def http(spark, pages, **more):
    waits = []
    lim = RateLimiter(RateLimit(2), clock=lambda: 0.0, sleep=waits.append)
    return PagedHttpSource(spark, pages, limiter=lim, retrier=Retrier(RetryPolicy(), sleep=waits.append), **more), waits


def test_http_pages_backwards(spark):
    src, _ = http(spark, Pages(12_000))
    df = src.fetch_candles(S, T0, T0 + timedelta(minutes=11_000), "1min")
    assert df.count() == 11_000 and len([c for c in src.client.calls if c[0] == "historicalPrices"]) == 3
    with pytest.raises(ProviderDataError):
        src.fetch_candles("ABC", T0, T0 + MIN, "1min")


def test_retries_and_rate(spark):
    src, waits = http(spark, Pages(3, fail=2))
    assert src.get_supported_symbols() == [S] and src.retrier.retries == 2 and waits.count(5.0) == 2
    assert src.limiter.requests == 3
    with pytest.raises(ProviderRateLimitError):
        http(spark, Pages(3, fail=9))[0].get_supported_symbols()
    assert RetryPolicy().wait(3) == 4.0 and RetryPolicy().wait(9) == 60.0 and RetryPolicy().wait(1, 500) == 60.0
    assert status_error(404, "x").retryable is False and status_error(503, "x").retryable


def test_preflight(spark):
    r = check_source(http(spark, Pages(60))[0], symbol=S, start=T0, end=T0 + timedelta(hours=1))
    assert [c.name for c in r.checks] == ["reachable", "symbol_accepted", "timeframe_accepted", "candles_returned", "candles_parsed", "timestamps_utc", "ohlc_valid", "pagination"]
    assert r.status is Status.PASS and r.candles == 60
    assert check_source(http(spark, Pages(60, fail=99))[0], symbol=S, start=T0, end=T0 + MIN).status is Status.BLOCKED
    assert check_source(http(spark, Pages(60))[0], symbol="X", start=T0, end=T0 + MIN).status is Status.FAIL


def test_stages_need_their_evidence(spark, roots, tmp_path):
    src, _ = http(spark, Pages(60 * 24))
    more = dict(symbol=S, start=T0, calendar=AlwaysOpen(), verification_root=str(tmp_path / "v"), data_root=roots["output_root"], manifest_root=roots["manifest_root"], quality_root=roots["quality_root"], checkpoint_root=roots["checkpoint_root"])
    assert run_stage(spark, src, stage=Stage.DAILY, **more).status is Status.BLOCKED
    smoke = run_stage(spark, src, stage=Stage.SMOKE, **more)
    assert smoke.status is Status.PASS and load(VerificationRecord, smoke.record_path).rows == 60
    assert run_stage(spark, src, stage=Stage.DAILY, **more).status is Status.PASS
    store = VerificationStore(str(tmp_path / "v"))
    who = dict(provider="http", configuration=src.configuration(), symbol=S, timeframe="1min")
    long = permission_for_range(store, T0, T0 + timedelta(days=400), **who)
    assert not long.granted and [s.value for s in long.unproven] == ["monthly"] and "monthly: no valid record" in long.explain()
    assert permission_for_range(store, T0, T0 + timedelta(days=400), forced=True, **who).unverified
    assert permission_for_range(store, T0, T0 + timedelta(days=3), **who).granted
    assert len(permission_for_range(store, T0, T0 + timedelta(days=400), **who | {"configuration": {"base_url": "other"}}).unproven) == 3
    assert fingerprint({"a": "1", "b": "2"}) == fingerprint({"b": "2", "a": "1"})


def test_commands(spark, tmp_path, roots, capsys):
    src = csv_file(tmp_path / "EUR_USD_1min.csv", [line(i) for i in range(60)])
    dirs = [x for k, v in roots.items() for x in ("--" + k.replace("_", "-"), v)]
    window = ["--start", "2026-08-10", "--end", "2026-08-10T01:00:00"]
    who = ["--symbol", S]
    assert main(["download", *who, *window, "--source", src, *dirs, "--calendar", "24x7"], spark=spark) == 0
    capsys.readouterr()
    assert main(["validate", *who, "--data-root", roots["output_root"], "--manifest-root", roots["manifest_root"], "--json"], spark=spark) == 0
    assert json.loads(capsys.readouterr().out)["candles"] == 60
    assert main(["compare", *who, "--left-root", roots["output_root"], "--right-root", roots["output_root"], "--record-root", str(tmp_path / "c")], spark=spark) == 0
    assert main(["compare", *who, "--left-root", roots["output_root"], "--right-root", str(tmp_path / "none")], spark=spark) == 1
    assert main(["provider-check", *who, *window, "--source", src], spark=spark) == 0
    assert main(["download", *who, "--start", "2020-01-01", "--end", "2026-01-01", "--source", src, *dirs], spark=spark) == 2
    assert main(["verify-stage", *who, "--stage", "smoke", "--start", "2026-08-10", "--source", src, *dirs, "--verification-root", str(tmp_path / "v")], spark=spark) == 0
    assert main(["validate", *who, "--data-root", str(tmp_path / "none"), "--no-manifests"], spark=spark) == 1
    assert main(["download", *who, *window, *dirs], spark=spark) == 1
    with pytest.raises(SystemExit) as e:
        main(["nonsense"])
    assert e.value.code == 2


def test_stream_finds_what_a_batch_finds(spark, candles, tmp_path):
    from pyspark.sql import functions as F

    from candlewick.operators.gaps import plain_gaps
    from candlewick.streaming.gap_monitor import monitor, upsert

    us = [0, 60, 300, 360, 1000, 1060, 2000]
    for i, part in enumerate((us[:2], us[2:5], us[5:])):
        spark.createDataFrame([("a", u) for u in part], "k string, us long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(i)))
    stream = spark.readStream.schema("k string, us long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    q = monitor(stream, 60).writeStream.format("memory").queryName("gaps").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.gap_start, r.gap_end, r.missing) for r in spark.table("gaps").where("kind = 'gap'").collect())
    batch = plain_gaps(spark.createDataFrame([("a", u) for u in us], "k string, us long"), 60)
    assert got == sorted((r.gap_start, r.gap_end, r.missing) for r in batch.collect())
    assert spark.table("gaps").where("kind = 'total'").agg(F.max("candles")).first()[0] == len(us)
    rows = candles([row(i) for i in range(5)]).withColumn("ord", F.lit(1))
    rows.coalesce(1).write.parquet(str(tmp_path / "c"))
    store = CandleStore(spark, str(tmp_path / "store"))
    for k in ("one", "two"):  # the second run repeats the batch
        upsert(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "c")), store, S, "1min", str(tmp_path / k)).awaitTermination()
    assert store.read(S, "1min").count() == 5


def test_stream_of_sessions(spark, tmp_path):
    import random

    from pyspark.sql import functions as F

    from candlewick.operators.gaps import session_gaps
    from candlewick.streaming.gap_monitor import monitor

    sessions = [(0, 600), (900, 1500), (1800, 1830), (2000, 2600), (3000, 3600), (4000, 4500)]
    rng = random.Random(5)
    series = {k: sorted(rng.sample(range(0, 5000, 20), n)) for k, n in (("a", 60), ("b", 12), ("c", 3), ("d", 1))} | {"none": []}
    cuts = {k: sorted(rng.choices(range(len(us) + 1), k=3)) for k, us in series.items()}
    for i in range(5):
        part = [(k, u) for k, us in series.items() for u in us[([0, *cuts[k]])[i] : [*cuts[k], len(us)][i]]] if i < 4 else [(k, None) for k in series]
        spark.createDataFrame(part, "k string, us long").coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
        for f in (tmp_path / "in" / str(i)).glob("*.parquet"):
            os.utime(f, (1_700_000_000 + i,) * 2)  # files are read in the order of their times
    read = lambda: spark.readStream.schema("k string, us long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    run = lambda: monitor(read(), 60, sessions).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    run()
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = session_gaps(
        spark.createDataFrame([(k, u) for k, us in series.items() for u in us], "k string, us long"),
        spark.createDataFrame([(i, *x) for i, x in enumerate(sessions)], "sid int, s long, e long"),
        spark.createDataFrame([(k,) for k in series], "k string"),
        60,
    )
    want = sorted((r.k, r.gap_start, r.gap_end, r.missing) for r in batch.collect())
    assert sorted((r.k, r.gap_start, r.gap_end, r.missing) for r in got.where("kind = 'gap'").collect()) == want
    assert ("none", 1800, 1830, 0) in want  # a session too short for a candle
    totals = {r.k: (r.c, r.g) for r in got.where("kind = 'total'").groupBy("k").agg(F.max("candles").alias("c"), F.max("gaps").alias("g")).collect()}
    assert totals == {k: (len(us), sum(w[0] == k for w in want)) for k, us in series.items()}
    spark.createDataFrame([("a", 9000)], "k string, us long").write.parquet(str(tmp_path / "in" / "9"))
    with pytest.raises(Exception, match="has ended"):
        run()

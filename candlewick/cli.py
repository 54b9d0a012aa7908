"""Commands: download, validate, compare, provider-check, verify-stage.

Exit codes: 0 done or verified, 1 a failure or a verdict that isn't a pass, 2 refused by
the guard, or an unknown command.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import SparkSession

from .operators.calendars import CALENDARS, get_calendar
from .operators.reports import compare_datasets, stamp, validate_dataset
from .plans.chunks import Stage, parse_chunk_size
from .plans.documents import plain
from .plans.ingest import DownloadPipeline
from .plans.status import ComparisonThresholds, QualityStatus, QualityThresholds
from .plans.verification import ComparisonStore, VerificationStore, check_source, permission_for_range, run_stage
from .session import get_session
from .sources.base import CandleSource, ProviderError
from .sources.csv import CsvSource
from .sources.http import PagedHttpSource, url_client
from .sources.limits import RateLimit, RetryPolicy

LISTED = 10


def moment(text: str) -> datetime:
    """ISO-8601; without an offset it is UTC."""
    try:
        x = datetime.fromisoformat(text)
    except ValueError as e:
        raise argparse.ArgumentTypeError(str(e)) from None
    return (x if x.tzinfo else x.replace(tzinfo=UTC)).astimezone(UTC)


def decimal(text: str) -> Decimal:
    try:
        x = Decimal(text)
    except InvalidOperation:
        raise argparse.ArgumentTypeError(f"{text!r} is no number") from None
    if not x.is_finite() or x < 0:
        raise argparse.ArgumentTypeError(f"{text!r} is no tolerance")
    return x


def chunk(text: str):
    try:
        return parse_chunk_size(text)
    except ValueError as e:
        raise argparse.ArgumentTypeError(str(e)) from None


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="candlewick")
    sub = p.add_subparsers(dest="command", required=True)
    roots = {"--output-root": "data/processed", "--manifest-root": "data/manifests", "--quality-root": "data/quality", "--checkpoint-root": "data/checkpoints", "--verification-root": "data/verification"}

    def command(name: str, *, source: bool = False, stored: bool = False, ranged: bool | None = True) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.add_argument("--symbol", required=True)
        c.add_argument("--timeframe", default="1min")
        c.add_argument("--json", action="store_true")
        if ranged is not None:
            c.add_argument("--start", type=moment, required=ranged)
            c.add_argument("--end", type=moment, required=ranged)
        if source:
            c.add_argument("--provider", choices=["csv", "http"], default="csv")
            c.add_argument("--source", help="a CSV file or directory, or a base URL")
            c.add_argument("--api-key")
            c.add_argument("--requests-per-second", type=float, default=2.0)
            c.add_argument("--max-attempts", type=int, default=4)
            c.add_argument("--retry-initial", type=float, default=1.0)
            c.add_argument("--retry-max", type=float, default=60.0)
        if stored:
            for k, v in roots.items():
                c.add_argument(k, default=v)
            c.add_argument("--calendar", choices=sorted(CALENDARS), default="forex")
            c.add_argument("--chunk-size", type=chunk, default=parse_chunk_size("1month"))
            c.add_argument("--force-unverified", action="store_true")
        return c

    c = command("download", source=True, stored=True)
    c.add_argument("--no-resume", action="store_true")
    c.add_argument("--strict", action="store_true")
    c = command("validate", ranged=False)
    c.add_argument("--data-root", default=roots["--output-root"])
    c.add_argument("--manifest-root", default=roots["--manifest-root"])
    c.add_argument("--no-manifests", action="store_true")
    c.add_argument("--allow-incomplete", action="store_true")
    c.add_argument("--calendar", choices=sorted(CALENDARS), default="forex")
    c = command("compare", ranged=False)
    for side in ("left", "right"):
        c.add_argument(f"--{side}-root", required=True)
        c.add_argument(f"--{side}-manifest-root")
    c.add_argument("--record-root")
    d = ComparisonThresholds()
    for k, v in vars(d).items():
        c.add_argument("--" + k.replace("_", "-"), type=decimal if isinstance(v, Decimal) else float, default=v)
    command("provider-check", source=True, ranged=False)
    c = command("verify-stage", source=True, stored=True, ranged=None)
    c.add_argument("--stage", choices=[s.value for s in Stage], required=True)
    c.add_argument("--start", type=moment, required=True)
    c.add_argument("--end", type=moment)
    t = QualityThresholds()
    c.add_argument("--missing-warn-ratio", type=float, default=t.missing_warn_ratio)
    c.add_argument("--missing-fail-ratio", type=float, default=t.missing_fail_ratio)
    return p


def source_of(spark: SparkSession, a: argparse.Namespace) -> CandleSource:
    if not a.source:
        raise ValueError("--source is needed: a CSV file or directory, or a base URL")
    if a.provider == "csv":
        return CsvSource(spark, a.source)
    retry = RetryPolicy(a.max_attempts, a.retry_initial, 2.0, max(a.retry_max, a.retry_initial))
    return PagedHttpSource(spark, url_client(a.source, a.api_key), base_url=a.source, key_set=bool(a.api_key), retry=retry, rate=RateLimit(a.requests_per_second))


def show(a: argparse.Namespace, x: Any, lines: list[str]) -> None:
    print(json.dumps(plain(x), indent=2) if a.json else "\n".join(lines))


def listing(title: str, items: list[str], total: int | None = None) -> list[str]:
    total = len(items) if total is None else total
    return ([f"{title}: {total}"] + [f"  - {x}" for x in items[:LISTED]] + [f"  ... {total - LISTED} more"] * (total > LISTED)) if total else []


def _download(spark: SparkSession, a: argparse.Namespace, source: CandleSource) -> int:
    guard = permission_for_range(VerificationStore(a.verification_root), a.start, a.end, provider=source.name, configuration=source.configuration(), symbol=a.symbol, timeframe=a.timeframe, forced=a.force_unverified)
    if not guard.granted:
        print(f"refused: {guard.explain()}", file=sys.stderr)
        return 2
    pipe = DownloadPipeline(spark, source, output_root=a.output_root, manifest_root=a.manifest_root, quality_root=a.quality_root, checkpoint_root=a.checkpoint_root, calendar=get_calendar(a.calendar), chunk_size=a.chunk_size, strict=a.strict, verification=guard.explain() if guard.proofs else None, unverified_override=guard.unverified)
    r = pipe.run(symbol=a.symbol, start=a.start, end=a.end, timeframe=a.timeframe, resume=not a.no_resume)
    show(a, r, [f"{r.symbol} {r.timeframe} from {r.provider}: {r.quality.status.value}", f"downloaded {r.downloaded_count}, out of range {r.out_of_range_count}, invalid {r.invalid_count}, duplicates {r.duplicate_count}, stored {r.retained_count}", f"chunks {r.chunks_completed} of {r.chunks_total} completed, {r.chunks_skipped} skipped, {r.chunks_failed} failed", f"{stamp(r.actual_start)} -> {stamp(r.actual_end)}", *listing("missing intervals", [f"{stamp(g.start)} -> {stamp(g.end)} ({g.missing_candles})" for g in r.quality.missing_intervals], r.quality.missing_interval_count), *listing("failures", r.failures), f"manifest {r.manifest}"])
    return 1 if r.chunks_failed else 0


def _validate(spark: SparkSession, a: argparse.Namespace) -> int:
    v = validate_dataset(spark, symbol=a.symbol, timeframe=a.timeframe, data_root=a.data_root, manifest_root=None if a.no_manifests else a.manifest_root, calendar=get_calendar(a.calendar), start=a.start, end=a.end)
    show(a, v, [f"{v.symbol} {v.timeframe}: {v.status.value}", f"range {stamp(v.range_start)} -> {stamp(v.range_end)} ({v.range_source})", f"candles {v.candles} of {v.expected_candles if v.expected_candles is not None else 'unknown'}, missing {v.missing_candles}, duplicates {v.duplicate_candles}, invalid {v.invalid_rows}", *listing("gaps", [f"{stamp(g.start)} -> {stamp(g.end)} ({g.missing_candles})" for g in v.missing_intervals], v.missing_interval_count), *listing("problems", v.problems)])
    return 0 if v.ok or (a.allow_incomplete and v.status is QualityStatus.INCOMPLETE) else 1


def _compare(spark: SparkSession, a: argparse.Namespace) -> int:
    t = ComparisonThresholds(**{k: getattr(a, k) for k in vars(ComparisonThresholds())})
    r = compare_datasets(spark, symbol=a.symbol, timeframe=a.timeframe, left_root=a.left_root, right_root=a.right_root, left_manifest_root=a.left_manifest_root, right_manifest_root=a.right_manifest_root, start=a.start, end=a.end, thresholds=t)
    if a.record_root:
        ComparisonStore(a.record_root).save(r, t)
    show(a, r, [f"{r.symbol} {r.timeframe}: {r.status.value}", f"compared {r.candles_compared}, matching {r.matching_candles}; missing left {r.missing_from_left}, right {r.missing_from_right}", f"price mismatches {r.price_mismatches} (largest {r.max_price_difference} at {stamp(r.max_price_difference_at)}), volume {r.volume_mismatches}", *listing("differences", [f"{stamp(d.timestamp)} {d.field}: {d.left} / {d.right}" for d in r.differences]), *listing("gaps of one side", [f"{g.side} {stamp(g.start)} -> {stamp(g.end)}" for g in r.gap_differences], r.gaps_only_left + r.gaps_only_right), *listing("problems", r.problems)])
    return 0 if r.verified else 1


def _check(a: argparse.Namespace, source: CandleSource) -> int:
    r = check_source(source, symbol=a.symbol, timeframe=a.timeframe, start=a.start, end=a.end)
    show(a, r, [f"{r.provider} {r.symbol} {r.timeframe}: {r.status.value}", *(f"  {c.name}: {c.status.value} - {c.detail}" for c in r.checks)])
    return 0 if r.status.verified else 1


def _stage(spark: SparkSession, a: argparse.Namespace, source: CandleSource, live: bool) -> int:
    r = run_stage(spark, source, stage=Stage(a.stage), symbol=a.symbol, start=a.start, end=a.end, timeframe=a.timeframe, data_root=a.output_root, manifest_root=a.manifest_root, quality_root=a.quality_root, checkpoint_root=a.checkpoint_root, verification_root=a.verification_root, calendar=get_calendar(a.calendar), chunk_size=a.chunk_size, thresholds=QualityThresholds(a.missing_warn_ratio, a.missing_fail_ratio), live=live, override=a.force_unverified)
    show(a, r, [f"{r.stage.value}: {r.status.value}", r.guard.explain(), *listing("problems", r.problems), *([f"record {r.record_path}"] if r.record_path else [])])
    return 0 if r.status.verified else 1


def main(argv: list[str] | None = None, *, spark: SparkSession | None = None, source: CandleSource | None = None) -> int:
    """``source`` stands in for the one that the arguments name."""
    a = build_parser().parse_args(argv)
    try:
        spark = spark or get_session()
        live = source is None
        if a.command in ("download", "provider-check", "verify-stage"):
            source = source or source_of(spark, a)
        if a.command == "download":
            return _download(spark, a, source)
        if a.command == "validate":
            return _validate(spark, a)
        if a.command == "compare":
            return _compare(spark, a)
        return _check(a, source) if a.command == "provider-check" else _stage(spark, a, source, live)
    except (ProviderError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())

"""Verdicts and the thresholds behind them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass
from decimal import Decimal
from enum import StrEnum

from .documents import fingerprint


class Status(StrEnum):
    """In order of severity. Blocked: nothing could be learned, which is no failure."""

    PASS = "pass"
    WARN = "warn"
    BLOCKED = "blocked"
    FAIL = "fail"

    @property
    def verified(self) -> bool:
        return self in (Status.PASS, Status.WARN)


def worst(found: Iterable[Status]) -> Status:
    order = list(Status)
    return max(found, key=order.index, default=Status.PASS)


class QualityStatus(StrEnum):
    OK = "ok"
    INCOMPLETE = "incomplete"
    INVALID = "invalid"
    EMPTY = "empty"
    FAILED = "failed"


def _check_ratios(x, pairs: Iterable[tuple[str, str]]) -> None:
    for warn, fail in pairs:
        a, b = getattr(x, warn), getattr(x, fail)
        if not (0 <= a <= 1 and 0 <= b <= 1):
            raise ValueError(f"{warn} and {fail} must be between 0 and 1")
        if a > b:
            raise ValueError(f"{warn} cannot exceed {fail}")


def grade(ratio: float, warn: float, fail: float) -> Status:
    return Status.FAIL if ratio > fail else Status.WARN if ratio > warn else Status.PASS


@dataclass(frozen=True)
class QualityThresholds:
    """How many candles may be missing; no other defect is tolerated. The defaults."""

    missing_warn_ratio: float = 0.0
    missing_fail_ratio: float = 0.01

    def __post_init__(self):
        _check_ratios(self, [("missing_warn_ratio", "missing_fail_ratio")])

    def grade_missing(self, missing: int, expected: int | None) -> Status:
        """A shortfall that nothing sets in proportion fails."""
        if missing <= 0:
            return Status.PASS
        return grade(missing / expected, self.missing_warn_ratio, self.missing_fail_ratio) if expected else Status.FAIL

    def describe(self) -> str:
        return f"up to {self.missing_warn_ratio:.2%} of candles missing passes, up to {self.missing_fail_ratio:.2%} warns; any other defect fails"


@dataclass(frozen=True)
class ComparisonThresholds:
    """How far two feeds may differ, relative to a value's size. The defaults."""

    price_tolerance: Decimal = Decimal("0.0001")
    volume_tolerance: Decimal = Decimal("0.05")
    price_mismatch_warn_ratio: float = 0.0
    price_mismatch_fail_ratio: float = 0.001
    volume_mismatch_warn_ratio: float = 0.0
    volume_mismatch_fail_ratio: float = 1.0
    missing_warn_ratio: float = 0.0
    missing_fail_ratio: float = 0.01

    def __post_init__(self):
        for k in ("price_tolerance", "volume_tolerance"):
            v = getattr(self, k)
            if not isinstance(v, Decimal):
                raise TypeError(f"{k} must be a Decimal")
            if v < 0:
                raise ValueError(f"{k} cannot be negative")
        _check_ratios(self, [(f"{k}_warn_ratio", f"{k}_fail_ratio") for k in ("price_mismatch", "volume_mismatch", "missing")])

    def configuration(self) -> dict[str, str]:
        return {k: str(v) for k, v in asdict(self).items()}

    def fingerprint(self) -> str:
        return fingerprint(self.configuration())

    def describe(self) -> str:
        up_to = lambda k: f"{getattr(self, k + '_warn_ratio'):.2%} passes, {getattr(self, k + '_fail_ratio'):.2%} warns"
        return f"prices off by over {self.price_tolerance} of their size: {up_to('price_mismatch')}; volumes off by over {self.volume_tolerance}: {up_to('volume_mismatch')}; candles on one side only: {up_to('missing')}; repeated stamps and files that can't be read fail"

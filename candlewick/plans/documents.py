"""JSON side documents: dataclasses that are written at once or not at all, and read back checked."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import os
import types
import typing
import uuid
from datetime import UTC, datetime
from decimal import Decimal
from enum import Enum
from pathlib import Path
from typing import Any, TypeVar

X = TypeVar("X")
VERSION = "0.1.0"


def now() -> datetime:
    return datetime.now(UTC)


def plain(x: Any) -> Any:
    """As JSON has it; stamps in UTC, decimals as text."""
    if dataclasses.is_dataclass(x) and not isinstance(x, type):
        return {f.name: plain(getattr(x, f.name)) for f in dataclasses.fields(x)}
    if isinstance(x, datetime):
        return x.astimezone(UTC).isoformat().replace("+00:00", "Z")
    if isinstance(x, Enum):
        return x.value
    if isinstance(x, Decimal):
        return str(x)
    if isinstance(x, dict):
        return {str(k): plain(v) for k, v in x.items()}
    if isinstance(x, list | tuple):
        return [plain(v) for v in x]
    return str(x) if isinstance(x, Path) else x


def typed(kind: Any, x: Any) -> Any:
    """The inverse of ``plain``; ValueError or TypeError where x doesn't fit."""
    origin, args = typing.get_origin(kind), typing.get_args(kind)
    if origin in (typing.Union, types.UnionType):
        return None if x is None else typed(next(a for a in args if a is not type(None)), x)
    if origin is list:
        return [typed(args[0], v) for v in x]
    if origin is dict:
        return {k: typed(args[1], v) for k, v in x.items()}
    if dataclasses.is_dataclass(kind):
        hints = typing.get_type_hints(kind)
        known = {f.name for f in dataclasses.fields(kind)}
        return kind(**{k: typed(hints[k], v) for k, v in x.items() if k in known})
    if kind is datetime:
        return datetime.fromisoformat(x)
    if kind is Decimal or isinstance(kind, type) and issubclass(kind, Enum):
        return kind(x)
    if kind in (int, str, bool) and not isinstance(x, kind):
        raise TypeError(f"{x!r} is no {kind.__name__}")
    return x


def dumps(x: Any) -> str:
    return json.dumps(plain(x), indent=2)


def save(x: Any, path: Path) -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    tmp = path.with_name(f"{path.name}.{uuid.uuid4().hex}.tmp")
    tmp.write_text(dumps(x))
    os.replace(tmp, path)
    return path


def load(kind: type[X], path: Path) -> X | None:
    """None if there is no such file, or none that can be read as it: that proves nothing."""
    try:
        return typed(kind, json.loads(path.read_text()))
    except (OSError, ValueError, TypeError, KeyError, AttributeError):
        return None


def fingerprint(configuration: dict[str, str]) -> str:
    return hashlib.sha256(json.dumps(configuration, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


@dataclasses.dataclass
class Provenance:
    provider: str
    provider_configuration: dict[str, str]
    symbol: str
    timeframe: str
    requested_start: datetime
    requested_end: datetime
    actual_start: datetime | None
    actual_end: datetime | None
    rows: int
    quality_status: str
    calendar: str
    chunk_size: str
    rate_limit: str | None
    retry: str | None
    acquired_at: datetime
    application_version: str = VERSION
    verification: str | None = None
    unverified_override: bool = False


@dataclasses.dataclass
class Manifest:
    """What a download stored, with files relative to the dataset's root."""

    symbol: str
    timeframe: str
    start: datetime
    end: datetime
    row_count: int
    provider: str
    created_at: datetime
    files: list[str]
    actual_start: datetime | None = None
    actual_end: datetime | None = None
    dataset_version: str = "1.0.0"
    quality_report: str | None = None
    quality_status: str | None = None
    checkpoint: str | None = None
    provenance: Provenance | None = None


def manifests(root: Path, directory: str, timeframe: str) -> list[tuple[str, Manifest]]:
    """Readable manifests of a symbol and timeframe; others are passed over."""
    found = [(str(p), load(Manifest, p)) for p in sorted((root / directory).glob("*.json"))]
    return [(p, m) for p, m in found if m is not None and m.timeframe == timeframe]

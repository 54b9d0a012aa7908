"""Streaming: gaps of each series as candles arrive, whole or by sessions, and a streamed upsert into the store.

State is one row for each series: the latest stamp, how many sessions are closed, the last
stamp in the open one and exact counts. Rows before the latest stamp are late, counted and
passed over; so how a stream is cut into micro-batches doesn't change what is found, as
long as order between batches holds.

A row with a null stamp ends its series: all sessions left are closed, and a later row of
the series is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.rows import keep_last
from ..sources.store import CandleStore

OUT = "k string, kind string, gap_start long, gap_end long, missing long, candles long, gaps long, missing_total long, late long"
STATE = "latest long, closed long, inside long, ended boolean, candles long, gaps long, missing long, late long"


def _between(us: np.ndarray, cadence: int) -> list[np.ndarray]:
    """(start, end, missing) between stamps in order."""
    n = np.diff(us) // cadence - 1
    return [us[:-1][n > 0] + cadence, us[1:][n > 0], n[n > 0]]


def _in_sessions(us: np.ndarray, at: np.ndarray, closed: int, till: int, starts: np.ndarray, ends: np.ndarray, cadence: int) -> list[np.ndarray]:
    """(start, end, missing) of stamps ``us`` in sessions ``at``; those numbered from ``closed`` and below ``till`` close."""
    first = np.diff(at, prepend=-1) != 0
    last = np.diff(at, append=len(starts)) != 0
    same = ~first[1:]
    n = np.where(same, np.diff(us) // cadence - 1, 0)
    parts = [[us[:-1][n > 0] + cadence, us[1:][n > 0], n[n > 0]]]
    s, x = starts[at[first]], us[first]
    parts.append([s, x, (x - s) // cadence])
    done = last & (at < till)
    x, e = us[done] + cadence, ends[at[done]]
    parts.append([x, e, (e - x) // cadence])
    parts = [[c[p[2] > 0] for c in p] for p in parts]
    empty = np.setdiff1d(np.arange(closed, till), at)
    parts.append([starts[empty], ends[empty], (ends[empty] - starts[empty]) // cadence])
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def monitor(stamps: DataFrame, cadence: int, sessions: list[tuple[int, int]] | None = None) -> DataFrame:
    """From a stream of (k, us): a row for each gap, and one of totals for each series and micro-batch.

    With ``sessions``, (start, end) in microseconds in order, about one a week, gaps are those
    within each session: at its start, between stamps and, once a stamp or the series' end is
    past it, at its end; one without a stamp is a gap even where no candle fits. Stamps
    outside sessions are counted as candles and nothing else.
    """
    if cadence <= 0:
        raise ValueError("cadence must be positive")
    starts, ends = (np.array([x[i] for x in sessions or []], dtype=np.int64) for i in (0, 1))

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState):
        latest, closed, inside, ended, candles, gaps, missing, late = state.get if state.exists else (None, 0, None, False, 0, 0, 0, 0)
        # beside a null stamps arrive as floats, which hold microseconds exactly up to the year 2255
        cols = [b["us"].astype("Int64") for b in batches]
        if ended and any(len(c) for c in cols):
            raise ValueError(f"series {key[0]!r} has ended and takes no more stamps")
        end = any(c.isna().any() for c in cols)
        us = np.sort(np.concatenate([np.empty(0, np.int64), *[c.dropna().to_numpy(np.int64) for c in cols]]))
        if latest is not None:
            old = int(np.searchsorted(us, latest))
            late, us = late + old, us[old:]
        candles += len(us)
        if sessions is None:
            found = _between(us if latest is None else np.concatenate([[latest], us]), cadence)
        else:
            at = np.searchsorted(ends, us, "right")
            open_ = np.append(starts, np.iinfo(np.int64).max)[at] <= us
            till = len(starts) if end else int(at[-1]) if len(at) else closed
            x, i = us[open_], at[open_]
            fresh = inside is None
            if not fresh:
                x, i = np.concatenate([[inside], x]), np.concatenate([[closed], i])
            found = _in_sessions(x, i, closed, till, starts, ends, cadence)
            if not fresh:  # the start of the session that was open is told already
                told = found[0] != starts[closed]
                found = [c[told] for c in found]
            inside = int(x[-1]) if len(x) and i[-1] >= till else None
            closed = till
        gaps, missing = gaps + len(found[0]), missing + int(found[2].sum())
        latest = int(us[-1]) if len(us) else latest
        state.update((latest, closed, inside, end, candles, gaps, missing, late))
        rows = [(key[0], "gap", int(a), int(b), int(n), None, None, None, None) for a, b, n in sorted(zip(*found, strict=True))]
        rows.append((key[0], "total", None, None, None, candles, gaps, missing, late))
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in OUT.split(", ")]).astype({c: "Int64" for c in ("gap_start", "gap_end", "missing", "candles", "gaps", "missing_total", "late")})

    return stamps.groupBy("k").applyInPandasWithState(step, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def upsert(candles: DataFrame, store: CandleStore, symbol: str, timeframe: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch into the store; one that is run again changes nothing, as the last row of a stamp stays."""

    def write(batch: DataFrame, _: int) -> None:
        store.write(keep_last(batch, ["ord"]).drop("ord"), symbol, timeframe)

    return candles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

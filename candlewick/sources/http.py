"""Candles over HTTP in pages that go back in time.

A page ends where the one after it began; a client is any callable from a path and
parameters to a decoded JSON value, which raises ``ProviderError``. The rate is one for
all requests, so pages are fetched by one process and only then become a DataFrame.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from datetime import UTC, datetime, timedelta
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import micros
from ..schema import CANDLE, PARSED, PRICES
from .base import CandleSource, ProviderConnectionError, ProviderDataError, ProviderTimeoutError, status_error
from .limits import RateLimit, RateLimiter, Retrier, RetryPolicy

PAGE = 5000
#: What the service offers.
TIMEFRAMES = ("10sec", "1min", "10m", "1hour", "1day", "1day_eet")
Client = Callable[[str, dict[str, Any]], Any]


def url_client(base_url: str, key: str | None = None, timeout: float = 30.0) -> Client:
    def get(path: str, params: dict[str, Any]) -> Any:
        query = urllib.parse.urlencode({"path": f"api/{path}"} | params | ({"key": key} if key else {}))
        try:
            with urllib.request.urlopen(f"{base_url.rstrip('/')}/?{query}", timeout=timeout) as r:
                return json.loads(r.read(), parse_float=Decimal)
        except urllib.error.HTTPError as e:
            after = e.headers.get("Retry-After", "")
            raise status_error(e.code, path, float(after) if after.isdigit() else None) from None
        except TimeoutError as e:
            raise ProviderTimeoutError(f"{path} timed out") from e
        except urllib.error.URLError as e:
            raise ProviderConnectionError(f"{path}: {e.reason}") from e
        except ValueError as e:
            raise ProviderDataError(f"{path}: not JSON") from e

    return get


class PagedHttpSource(CandleSource):
    def __init__(self, spark: SparkSession, client: Client, *, name: str = "http", base_url: str = "", key_set: bool = False, retry: RetryPolicy | None = None, rate: RateLimit | None = None, limiter: RateLimiter | None = None, retrier: Retrier | None = None):
        self.spark, self.client, self._name, self.base_url, self.key_set = spark, client, name, base_url, key_set
        self.limiter = limiter or RateLimiter(rate)
        self.retrier = retrier or Retrier(retry or RetryPolicy())
        self._ids: dict[str, int] | None = None

    @property
    def name(self) -> str:
        return self._name

    @property
    def rate_limit(self) -> RateLimit:
        return self.limiter.limit

    @property
    def retry_policy(self) -> RetryPolicy:
        return self.retrier.policy

    def configuration(self) -> dict[str, str]:
        return {"base_url": self.base_url, "credential": "set" if self.key_set else "unset", "page": str(PAGE)}

    def _get(self, path: str, params: dict[str, Any]) -> Any:
        def once():
            self.limiter.acquire()
            return self.client(path, params)

        return self.retrier(once)

    def _instruments(self) -> dict[str, int]:
        if self._ids is None:
            found = self._get("instrumentList", {"fields": "id,name,pipValue,nameLong"})
            if not isinstance(found, list):
                raise ProviderDataError("the instrument list is no list")
            known = (x for x in found if isinstance(x, dict) and isinstance(x.get("name"), str) and isinstance(x.get("id"), int))
            self._ids = {x["name"].strip().upper(): x["id"] for x in known if x["name"].strip()}
        return self._ids

    def get_supported_symbols(self) -> list[str]:
        return sorted(self._instruments())

    def health_check(self) -> bool:
        from .base import ProviderError

        try:
            self._ids = None
            return bool(self._instruments())
        except ProviderError:
            return False

    @staticmethod
    def decode(item: dict[str, Any], symbol: str) -> tuple:
        """A candle of the bid side; the stamp is in milliseconds and volume may be absent."""
        try:
            stamp = datetime.fromtimestamp(0, UTC) + timedelta(milliseconds=int(item["timestamp"]))
            return (stamp, symbol, *(Decimal(str(item[f"bid_{c}"])) for c in PRICES), Decimal(str(item.get("volume", 0))))
        except (KeyError, TypeError, ValueError, InvalidOperation) as e:
            raise ProviderDataError(f"unreadable candle {item!r}") from e

    def fetch_candles(self, symbol: str, start: datetime, end: datetime, timeframe: str) -> DataFrame:
        if micros(start) >= micros(end):
            raise ValueError("start must be before end")
        if timeframe not in TIMEFRAMES:
            raise ValueError(f"unsupported timeframe {timeframe!r}; supported: {', '.join(TIMEFRAMES)}")
        wanted = symbol.strip().upper()
        ids = self._instruments()
        if wanted not in ids:
            raise ProviderDataError(f"{wanted} is not among {len(ids)} instruments")
        lo, hi = micros(start) // 1000, micros(end) // 1000
        rows: dict[int, tuple] = {}
        while hi > lo:
            page = self._get("historicalPrices", {"instrument": ids[wanted], "timeFrame": timeframe, "count": PAGE, "start": lo, "end": hi, "dayStartTime": "UTC", "offerSide": "B"})
            if not isinstance(page, dict):
                raise ProviderDataError("a page without candles")
            items = [x for x in page.get("candles") or [] if isinstance(x, dict)]
            if not items:
                break
            for x in items:
                c = self.decode(x, wanted)
                rows[micros(c[0])] = c
            oldest = min(int(x["timestamp"]) for x in items)
            if oldest <= lo:
                break
            if oldest - 1 >= hi:
                raise ProviderDataError("paging makes no progress")
            hi = oldest - 1
        kept = [(*rows[k], i) for i, k in enumerate(sorted(rows)) if micros(start) <= k < micros(end)]
        from pyspark.sql import types as T

        wide = [T.StructField(f.name, PARSED if isinstance(f.dataType, T.DecimalType) else f.dataType) for f in CANDLE.fields]
        return self.spark.createDataFrame(kept, T.StructType([*wide, T.StructField("ord", T.LongType())]))

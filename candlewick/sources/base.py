"""What a source of candles offers, and how sources fail."""

from __future__ import annotations

from abc import ABC, abstractmethod
from datetime import datetime

from pyspark.sql import DataFrame


class ProviderError(Exception):
    retryable = False


class TransientProviderError(ProviderError):
    """May pass; ``retry_after`` seconds if the source said so."""

    retryable = True

    def __init__(self, message: str, *, retry_after: float | None = None):
        super().__init__(message)
        self.retry_after = retry_after


class ProviderTimeoutError(TransientProviderError):
    pass


class ProviderConnectionError(TransientProviderError):
    pass


class ProviderRateLimitError(TransientProviderError):
    pass


class ProviderServerError(TransientProviderError):
    pass


class PermanentProviderError(ProviderError):
    pass


class ProviderAuthError(PermanentProviderError):
    pass


class ProviderClientError(PermanentProviderError):
    pass


class ProviderDataError(PermanentProviderError):
    pass


class CsvProviderError(PermanentProviderError, ValueError):
    """A CSV source that can't be read as candles; names the file, record and field."""


def status_error(code: int, detail: str, retry_after: float | None = None) -> ProviderError:
    """The error for an HTTP status."""
    if code == 429:
        return ProviderRateLimitError(f"rate limited: {detail}", retry_after=retry_after)
    if code in (401, 403):
        return ProviderAuthError(f"not authorised ({code}): {detail}")
    if code in (408, 425):
        return ProviderTimeoutError(f"timed out ({code}): {detail}", retry_after=retry_after)
    if code >= 500:
        return ProviderServerError(f"server error ({code}): {detail}", retry_after=retry_after)
    return ProviderClientError(f"refused ({code}): {detail}")


class CandleSource(ABC):
    """``fetch_candles`` gives a DataFrame of candles in any order, with a column ``ord`` that numbers them as they came."""

    @property
    @abstractmethod
    def name(self) -> str: ...

    @abstractmethod
    def get_supported_symbols(self) -> list[str]: ...

    @abstractmethod
    def fetch_candles(self, symbol: str, start: datetime, end: datetime, timeframe: str) -> DataFrame: ...

    @abstractmethod
    def health_check(self) -> bool: ...

    def configuration(self) -> dict[str, str]:
        """Flat settings without a credential's value."""
        return {}

"""Retries and a request rate for sources over a network."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import TypeVar

from .base import ProviderError

X = TypeVar("X")


@dataclass(frozen=True)
class RetryPolicy:
    """The defaults."""

    attempts: int = 4
    initial: float = 1.0
    factor: float = 2.0
    cap: float = 60.0

    def __post_init__(self):
        if self.attempts < 1 or self.initial < 0 or self.factor < 1 or self.cap < self.initial:
            raise ValueError("a retry policy needs an attempt, and waits that grow up to the cap")

    @property
    def enabled(self) -> bool:
        return self.attempts > 1

    def describe(self) -> str:
        return f"{self.attempts} attempts, {self.initial:g}s x{self.factor:g} up to {self.cap:g}s" if self.enabled else "none"

    def wait(self, attempt: int, retry_after: float | None = None) -> float:
        """Seconds after the attempt of that number (from 1); longer if the source asks for it, up to the cap."""
        own = self.cap if attempt > 64 else self.initial * self.factor ** (attempt - 1)
        return min(max(own, retry_after or 0.0), self.cap)


@dataclass
class Retrier:
    policy: RetryPolicy = field(default_factory=RetryPolicy)
    sleep: Callable[[float], None] = time.sleep
    retries: int = 0

    def __call__(self, operation: Callable[[], X]) -> X:
        for attempt in range(1, self.policy.attempts + 1):
            try:
                return operation()
            except ProviderError as e:
                if not e.retryable or attempt == self.policy.attempts:
                    raise
                self.retries += 1
                self.sleep(self.policy.wait(attempt, getattr(e, "retry_after", None)))
        raise AssertionError


@dataclass(frozen=True)
class RateLimit:
    requests_per_second: float = 2.0

    def __post_init__(self):
        if self.requests_per_second <= 0:
            raise ValueError("a rate must be above 0")

    def describe(self) -> str:
        return f"{self.requests_per_second:g} requests/s"


class RateLimiter:
    """Spaces requests evenly within a process; callers in several threads queue up."""

    def __init__(self, limit: RateLimit | None = None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.limit = limit or RateLimit()
        self.clock, self.sleep = clock, sleep
        self.waited, self.requests = 0.0, 0
        self._next, self._lock = float("-inf"), threading.Lock()

    def acquire(self) -> float:
        with self._lock:
            now = self.clock()
            at = max(now, self._next)
            self._next = at + 1 / self.limit.requests_per_second
            self.requests += 1
            self.waited += at - now
        if at > now:
            self.sleep(at - now)
        return at - now

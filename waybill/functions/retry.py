"""Retry decisions and backoff delays as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RetryPolicy:
    max_retries: int = 3
    initial_ms: int = 1000
    max_ms: int = 30000
    multiplier: float = 2.0
    jitter: float = 0.0

    def __post_init__(self) -> None:
        if self.max_retries < 0 or self.initial_ms <= 0 or self.max_ms < self.initial_ms:
            raise ValueError("max_retries must be >= 0 and 0 < initial_ms <= max_ms")
        if self.multiplier < 1.0 or not 0.0 <= self.jitter <= 1.0:
            raise ValueError("multiplier must be >= 1 and jitter between 0 and 1")

    def should_retry(self, attempt: Column, is_transient: Column) -> Column:
        return is_transient & (attempt <= self.max_retries)

    def delay_ms(self, attempt: Column) -> Column:
        """Delay before ``attempt`` (from 1). The power is cut to a whole number before multiplying."""
        steps = F.least(F.floor(F.pow(F.lit(self.multiplier), attempt - 1)), F.lit(self.max_ms).cast("bigint"))
        return F.least(steps * self.initial_ms, F.lit(self.max_ms).cast("bigint"))

    def backoff_ms(self, attempt: Column) -> Column:
        """Poll backoff for ``attempt`` (from 0), cut to whole milliseconds after multiplying."""
        grown = F.pow(F.lit(self.multiplier), attempt) * self.initial_ms
        return F.floor(F.least(grown, F.lit(float(self.max_ms))))

    def jittered_ms(self, attempt: Column, key: Column) -> Column:
        """``delay_ms`` shifted by up to ``jitter`` of itself, at least 1 ms.

        The shift comes from a digest of ``key`` and ``attempt``: spread like a random draw, yet a
        recomputed task gives the same delay.
        """
        delay = self.delay_ms(attempt)
        if self.jitter == 0.0:
            return delay
        spread = F.floor(delay * self.jitter)
        digest = F.md5(F.concat(key.cast("string"), F.lit("/"), attempt.cast("string")).cast("binary"))
        unit = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / 2147483647.5 - 1
        return F.greatest(F.lit(1).cast("bigint"), delay + (unit * spread).cast("bigint"))

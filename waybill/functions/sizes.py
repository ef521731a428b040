"""Size limits for payloads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MB = 1024 * 1024


@dataclass(frozen=True)
class SizeProfile:
    """Byte limits: above ``max_bytes`` reject, above ``offload_bytes`` offload, above ``warn_bytes`` warn."""

    max_bytes: int = 100 * MB
    warn_bytes: int = 10 * MB
    offload: bool = False
    offload_bytes: int = 50 * MB

    def problems(self) -> list[str]:
        checks = [
            (self.max_bytes <= 0, "maxPayloadSizeBytes must be positive"),
            (self.warn_bytes <= 0, "warnThresholdBytes must be positive"),
            (self.warn_bytes > self.max_bytes, "warnThresholdBytes should not exceed maxPayloadSizeBytes"),
        ]
        return [text for failed, text in checks if failed]


DEFAULT = SizeProfile()
CONSERVATIVE = SizeProfile(10 * MB, 1 * MB)
PERMISSIVE = SizeProfile(500 * MB, 50 * MB)


def _too_big(size: Column, profile: SizeProfile) -> Column:
    return F.concat(
        F.lit("Payload size ("), size, F.lit(f" bytes) exceeds maximum allowed ({profile.max_bytes} bytes)")
    )


def size_check(size: Column, profile: SizeProfile = DEFAULT) -> Column:
    """struct(isValid, sizeBytes, shouldWarn, rejection)."""
    valid = size <= profile.max_bytes
    return F.struct(
        valid.alias("isValid"),
        size.alias("sizeBytes"),
        (valid & (size > profile.warn_bytes)).alias("shouldWarn"),
        F.when(~valid, _too_big(size, profile)).alias("rejection"),
    )


def should_offload(size: Column, profile: SizeProfile) -> Column:
    return (size > profile.offload_bytes) if profile.offload else F.lit(False)


def payload_decision(
    size: Column,
    profile: SizeProfile = DEFAULT,
    reference: Column | None = None,
    offload_error: Column | None = None,
) -> Column:
    """struct(action, reason, sizeBytes): Reject, Offloaded, ProcessWithWarning or Process.

    ``reference`` is where an offloaded payload went; a non-null ``offload_error`` rejects it. With
    neither, an offload candidate is handled in place like any other payload.
    """
    error = F.lit(None).cast("string") if offload_error is None else offload_error
    target = F.lit(None).cast("string") if reference is None else reference
    offload = should_offload(size, profile)
    reject, failed = size > profile.max_bytes, offload & error.isNotNull()
    moved, warn = offload & target.isNotNull(), size > profile.warn_bytes
    action = (
        F.when(reject | failed, "Reject").when(moved, "Offloaded").when(warn, "ProcessWithWarning").otherwise("Process")
    )
    reason = (
        F.when(reject, _too_big(size, profile))
        .when(failed, F.concat(F.lit("Offload failed: "), error))
        .when(moved, F.concat(F.lit("Offloaded to: "), target))
        .when(warn, F.concat(F.lit("Large payload: "), size, F.lit(" bytes")))
    )
    return F.struct(action.alias("action"), reason.alias("reason"), size.alias("sizeBytes"))

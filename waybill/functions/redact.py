"""Hiding secrets in maps and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REDACTED = "[REDACTED]"

# A key is sensitive when its lower-case form contains one of these.
SENSITIVE_KEYS = (
    "password",
    "sslkeystorepassword",
    "ssltruststorepassword",
    "secret",
    "token",
    "apikey",
    "credential",
)
CONFIG_KEYS = (*SENSITIVE_KEYS, "api_key")

TEXT_PATTERN = r"(?i)((?:password|secret|token|api_?key|credential)\w*)\s*[=:]\s*\S+"


def redact_map(details: Column, keys: tuple[str, ...] = SENSITIVE_KEYS) -> Column:
    pattern = "|".join(keys)
    return F.transform_values(
        details, lambda k, v: F.when(F.lower(k).rlike(pattern), F.lit(REDACTED)).otherwise(v)
    )


def redact_text(text: Column) -> Column:
    """Replace the value in every ``name=value`` / ``name: value`` whose name looks like a secret."""
    return F.regexp_replace(text, TEXT_PATTERN, f"$1={REDACTED}")

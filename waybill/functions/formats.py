"""Payload format detection and the per-parser acceptance tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waybill.functions.charset import trimmed, utf8

# Message formats that carry JSON besides any whose name contains JSON.
JSON_FORMATS = ("", "MQSTR")
RAW_JSON_FORMATS = ("", "JSON", "MQSTR")

# ASCII white space: tab to CR, the four separators, blank.
_BLANK = r"[\t-\r\x1c-\x20]*"


def detect_format(payload: Column) -> Column:
    """UNKNOWN, JSON, XML, TEXT or BINARY from the bytes alone."""
    text = F.decode(payload, "ISO-8859-1")  # one character per byte
    return (
        F.when(payload.isNull() | (F.octet_length(payload) == 0), "UNKNOWN")
        .when(text.rlike(rf"\A{_BLANK}\z"), "TEXT")
        .when(text.rlike(rf"\A{_BLANK}[\{{\[]"), "JSON")
        .when(text.rlike(rf"\A{_BLANK}<"), "XML")
        .when(~text.rlike(r"[^\x20-\x7e\t\n\r]"), "TEXT")
        .otherwise("BINARY")
    )


def can_parse_json(fmt: Column, payload: Column) -> Column:
    name = F.upper(F.coalesce(fmt, F.lit("")))
    body = trimmed(utf8(payload))
    braces = body.startswith("{") & body.endswith("}")
    brackets = body.startswith("[") & body.endswith("]")
    return name.isin(*JSON_FORMATS) | name.contains("JSON") | braces | brackets


def can_parse_xml(fmt: Column, payload: Column) -> Column:
    name = F.upper(F.coalesce(fmt, F.lit("")))
    body = trimmed(utf8(payload))
    return name.contains("XML") | body.startswith("<?xml") | (body.startswith("<") & body.endswith(">"))


def can_parse_text(fmt: Column, payload: Column) -> Column:
    return F.lit(True)


def supports_raw_json(fmt: Column) -> Column:
    """Whether the raw JSON wrapper takes messages of this format."""
    return F.upper(F.coalesce(fmt, F.lit(""))).isin(*RAW_JSON_FORMATS)


def raw_wrap(payload: Column) -> Column:
    return F.create_map(F.lit("_raw"), utf8(payload))

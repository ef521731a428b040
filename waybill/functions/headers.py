"""Scalar columns over message headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hex_id(identifier: Column) -> Column:
    """Lower-case hex of a binary id; empty for a missing one."""
    return F.lower(F.hex(F.coalesce(identifier, F.lit(bytearray()))))


def payload_size(payload: Column) -> Column:
    return F.octet_length(payload).cast("bigint")


def stored_size(messages: DataFrame) -> Column:
    """Payload bytes from the ``payloadSize`` column of message tables, so that counting bytes reads no
    payload; computed where a table has no such column."""
    return F.col("payloadSize") if "payloadSize" in messages.columns else payload_size(F.col("payload"))


def is_redelivered(backout_count: Column) -> Column:
    return backout_count > 0


def latency_ms(received_at: Column, put_at: Column) -> Column:
    return F.unix_millis(received_at) - F.unix_millis(put_at)


def envelope(source_id: str, partition_id: Column, offset: Column, headers: dict[str, Column]) -> dict[str, Column]:
    """Envelope columns for ``DataFrame.withColumns``; ``headers`` become one string map."""
    pairs = [part for name, value in headers.items() for part in (F.lit(name), value.cast("string"))]
    empty = F.create_map().cast("map<string,string>")
    return {
        "partitionId": partition_id.cast("int"),
        "offset": offset.cast("bigint"),
        "sourceId": F.lit(source_id),
        "headers": F.create_map(*pairs) if pairs else empty,
    }

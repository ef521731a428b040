"""Progress markers per batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.operators.ordered import first_n, running_total

KEPT_IDS = 10
_FIELDS = ("batchId", "processedCount", "lastBatchCount", "lastBatchTimestamp", "lastMessageIds")
_SCHEMA = (
    "batchId bigint, processedCount bigint, lastBatchCount bigint, lastBatchTimestamp bigint, "
    "lastMessageIds array<string>"
)


def batch_progress(batches: DataFrame, range_width: int = 4096) -> DataFrame:
    """One marker per ``batchId``: running and own count, last put time, first ten ids in queue order."""
    order = ["timestamp", "messageIdHex"]
    counts = batches.groupBy("batchId").agg(
        F.count("*").alias("lastBatchCount"), F.max(F.unix_millis("timestamp")).alias("lastBatchTimestamp")
    )
    heads = first_n(batches.select("batchId", *order), ["batchId"], order, KEPT_IDS)
    ids = heads.groupBy("batchId").agg(
        F.array_sort(F.collect_list(F.struct("position", "messageIdHex")))["messageIdHex"].alias("lastMessageIds")
    )
    totals = running_total(counts, "lastBatchCount", "batchId", range_width, "processedCount")
    return totals.join(ids, "batchId").select(*_FIELDS)


def next_marker(last: DataFrame, count: int, timestamp_ms: int, ids: list[str]) -> DataFrame:
    """The marker that follows ``last`` after a batch of ``count`` messages."""
    return last.select(
        (F.col("batchId") + 1).alias("batchId"),
        (F.col("processedCount") + count).alias("processedCount"),
        F.lit(count).cast("bigint").alias("lastBatchCount"),
        F.lit(timestamp_ms).cast("bigint").alias("lastBatchTimestamp"),
        F.array(*[F.lit(i) for i in ids[:KEPT_IDS]]).cast("array<string>").alias("lastMessageIds"),
    )


def marker_json() -> Column:
    return F.to_json(F.struct(*_FIELDS))


def marker_from_json(text: Column) -> Column:
    """Read a marker; fields an older writer did not know are 0 or empty."""
    read = F.from_json(text, _SCHEMA)
    zero = F.lit(0).cast("bigint")
    empty = F.array().cast("array<string>")
    return F.struct(
        *[F.coalesce(read[f], empty if f == "lastMessageIds" else zero).alias(f) for f in _FIELDS]
    )

"""Checkpoint tables: the last processed position per (queue, partition)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.headers import stored_size

KEY = ["queueName", "partitionId"]
FIELDS = (
    "queueName",
    "queueManager",
    "lastMessageId",
    "lastCorrelationId",
    "lastProcessedTimestamp",
    "messagesProcessed",
    "bytesProcessed",
    "partitionId",
    "createdAt",
)
_JSON_SCHEMA = (
    "queueName string, queueManager string, lastMessageId string, lastCorrelationId string, "
    "lastProcessedTimestamp bigint, messagesProcessed bigint, bytesProcessed bigint, partitionId int, "
    "createdAt bigint"
)


def build_checkpoints(batch: DataFrame, queue_manager: str, created_at: Column, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """One checkpoint per (queue, partition) of a processed batch; times in milliseconds.

    The last correlation id is the last one that is not empty. Everything is an aggregate, so a hot
    queue is reduced in its own tasks before the shuffle.
    """
    order = F.struct("timestamp", "messageIdHex")
    has_correlation = F.col("correlationIdHex") != ""
    return (
        batch.groupBy(*KEY, *extra_keys)
        .agg(
            F.max_by("messageIdHex", order).alias("lastMessageId"),
            F.max_by("correlationIdHex", F.when(has_correlation, order)).alias("lastCorrelationId"),
            F.max(F.unix_millis("timestamp")).alias("lastProcessedTimestamp"),
            F.count("*").alias("messagesProcessed"),
            F.sum(stored_size(batch)).alias("bytesProcessed"),
        )
        .withColumns({"queueManager": F.lit(queue_manager), "createdAt": created_at})
        .select(*FIELDS, *extra_keys)
    )


def latest(saves: DataFrame) -> DataFrame:
    """Current checkpoints of an append-only save log (``seq``, ``deleted`` plus the fields).

    The last save of a key wins; a key whose last row is a tombstone is gone.
    """
    newest = saves.groupBy(*KEY).agg(F.max_by(F.struct("deleted", *[f for f in FIELDS if f not in KEY]), "seq").alias("_c"))
    return newest.filter(~F.col("_c.deleted")).select(*[F.col(f if f in KEY else f"_c.{f}").alias(f) for f in FIELDS])


def load(saves: DataFrame, queue: str, partition: int) -> DataFrame:
    """The checkpoint of one key, or no row."""
    return latest(saves.filter((F.col("queueName") == queue) & (F.col("partitionId") == partition)))


def tombstones(keys: DataFrame, seq: Column) -> DataFrame:
    """Save-log rows that delete ``keys``."""
    missing = {f: F.lit(None) for f in FIELDS if f not in KEY}
    return keys.select(*KEY).withColumns({**missing, "seq": seq, "deleted": F.lit(True)})


def compact(saves: DataFrame, path: str) -> None:
    """Write the current checkpoints as a new save log at ``path`` (a new version, never in place)."""
    latest(saves).withColumns({"seq": F.lit(0).cast("bigint"), "deleted": F.lit(False)}).write.parquet(path)


def merge(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union of two checkpoint tables; on a shared key the strictly later position wins, a tie keeps ``left``."""
    l, r = left.alias("l"), right.alias("r")
    joined = l.join(r, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in KEY], "full_outer")
    later = F.col("r.lastProcessedTimestamp") > F.col("l.lastProcessedTimestamp")
    take_right = F.col("l.queueName").isNull() | F.coalesce(later, F.lit(False))
    return joined.select(
        *[F.when(take_right, F.col(f"r.{f}")).otherwise(F.col(f"l.{f}")).alias(f) for f in FIELDS]
    )


def to_json() -> Column:
    """JSON of a checkpoint row; absent ids are written as null."""
    return F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"})


def from_json(text: Column) -> Column:
    """Read a checkpoint; missing text is empty, missing numbers are 0, missing ids stay null."""
    read = F.from_json(text, _JSON_SCHEMA)
    defaults = {
        "queueName": F.lit(""),
        "queueManager": F.lit(""),
        "lastProcessedTimestamp": F.lit(0),
        "messagesProcessed": F.lit(0),
        "bytesProcessed": F.lit(0),
        "partitionId": F.lit(0),
        "createdAt": F.lit(0),
    }
    return F.struct(
        *[(F.coalesce(read[f], defaults[f]) if f in defaults else read[f]).alias(f) for f in FIELDS]
    )

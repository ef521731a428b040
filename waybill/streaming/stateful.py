"""Stateful streams whose state is a small table per micro-batch."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill.functions.headers import stored_size
from waybill.operators.throttle import SECOND, bucket_windows, open_windows, throttle
from waybill.session import materialize

_CARRY = "queueName string, windowStart bigint, used bigint"


def throttle_stream(
    messages: DataFrame, limits: DataFrame, path: str, checkpoint: str, window_ms: int = SECOND
) -> StreamingQuery:
    """Token buckets over a stream: rows with ``granted`` go to ``path``/granted, open windows to
    ``path``/state, both under the batch id.

    A batch starts from the state its predecessor wrote, so a replay gives the same grants. Within the
    batch the buckets are worked out as in the batch operator; no task holds a whole queue. Files must
    land in time order.
    """
    state_path = f"{path}/state"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read by the buckets and by the grants
        try:
            grant(kept, batch_id)
        finally:
            kept.unpersist()

    def grant(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id:
            previous = session.read.schema(_CARRY).parquet(f"{state_path}/batch={batch_id - 1}")
        else:
            previous = session.createDataFrame([], _CARRY)
        buckets = materialize(bucket_windows(batch, limits, window_ms, carry=previous), "buckets")
        granted = throttle(batch, limits, window_ms, buckets=buckets)
        granted.write.mode("overwrite").parquet(f"{path}/granted/batch={batch_id}")
        carry = open_windows(buckets, previous)
        carry.write.mode("overwrite").parquet(f"{state_path}/batch={batch_id}")

    return (
        messages.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def counter_stream(messages: DataFrame, window: str, delay: str) -> DataFrame:
    """Received messages and bytes per queue and time window; state is kept for ``delay`` of event time."""
    return (
        messages.withWatermark("timestamp", delay)
        .groupBy(F.window("timestamp", window), "queueName")
        .agg(
            F.count("*").alias("messagesReceived"),
            F.sum(stored_size(messages)).alias("bytesReceived"),
        )
        .select(
            "queueName",
            F.unix_millis("window.start").alias("windowStart"),
            "messagesReceived",
            "bytesReceived",
        )
    )


_COUNTERS = "queueName string, windowStart bigint, messagesReceived bigint, bytesReceived bigint, batch bigint"


def write_counters(counters: DataFrame, path: str) -> StreamingQuery:
    """Write the windows each micro-batch changed, under its id."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changed/batch={batch_id}")

    return (
        counters.writeStream.outputMode("update")
        .foreachBatch(on_batch)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """The newest value of every window."""
    changed = spark.read.schema(_COUNTERS).parquet(f"{path}/changed")
    newest = changed.groupBy("queueName", "windowStart").agg(
        F.max_by(F.struct("messagesReceived", "bytesReceived"), "batch").alias("c")
    )
    return newest.select("queueName", "windowStart", "c.*")

"""Message streams: ingest, duplicate removal, commit and rollback per micro-batch."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill.operators import checkpoints, delivery
from waybill.session import materialize


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an available-now query and raise what it failed with."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def ingest(messages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a message stream to a table, exactly once, and stop when the landed files are read."""
    return (
        messages.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def deduplicate_stream(messages: DataFrame, delay: str, keys: tuple[str, ...] = ("messageIdHex",)) -> DataFrame:
    """Drop copies of a message that arrive within ``delay`` of event time.

    ``delay`` must exceed the disorder of ``timestamp`` in the landing files, or late rows are lost;
    it also bounds the state, to the ids of that span.
    """
    return messages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(keys))


def commit_each_batch(
    messages: DataFrame,
    handle: Callable[[DataFrame, int], None],
    log_path: str,
    checkpoint: str,
    saves_path: str | None = None,
    queue_manager: str = "",
    consumer: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Hand each micro-batch to ``handle`` and log its messages as committed, or, if it raises, as
    rolled back before the query fails.

    Spark replays a failed or unfinished batch under the same id. ``handle`` must overwrite what it
    wrote for that id; the log does so itself. Rollbacks of earlier tries of the batch are read back,
    so each try is logged as its own attempt. With ``saves_path`` every committed batch also saves its
    checkpoints (see ``operators.checkpoints``), after the commit.

    Streams may share a log and a save folder: what a stream writes stands under ``consumer``, by default a name
    made of its checkpoint folder, which no two streams share. The micro-batch is computed once. Without
    ``available_now`` the query goes on until it is stopped; see ``sources.landed.caught_up``.
    """
    delivery.init_log(messages.sparkSession, log_path)
    consumer = consumer or f"stream-{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        log = delivery.read_log(batch.sparkSession, log_path)
        log = log.filter((F.col("batchId") == batch_id) & (F.col("consumer") == consumer))
        batch_try = delivery.next_try(log, batch_id, consumer)
        tried = batch
        if batch_try > 1:
            # A copy: Spark computes cached plans anew when a folder that they read is written to, as the log is below.
            tried = delivery.with_redelivery_count(batch, materialize(log, "rollbacks"))
        tried = tried.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            settle_batch(tried, batch_id, batch_try)
        finally:
            tried.unpersist()

    def settle_batch(tried: DataFrame, batch_id: int, batch_try: int) -> None:
        def settle(outcome: str) -> None:
            rows = delivery.settle(tried, batch_id, outcome, F.current_timestamp(), batch_try, consumer)
            delivery.append_log(rows, log_path)

        try:
            handle(tried, batch_id)
        except Exception:
            settle("ROLLBACK")
            raise
        settle("COMMIT")
        if saves_path is not None:
            placed = tried if "partitionId" in tried.columns else tried.withColumn("partitionId", F.lit(0))
            now = F.unix_millis(F.current_timestamp())
            saves = checkpoints.build_checkpoints(placed, queue_manager, now)
            saves = saves.withColumns({"seq": F.lit(batch_id).cast("bigint"), "deleted": F.lit(False)})
            saves.write.mode("overwrite").parquet(f"{saves_path}/consumer={consumer}/batch={batch_id}")

    writer = messages.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def write_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Handler that stores a micro-batch under its id, replacing what an earlier try left there."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return handle

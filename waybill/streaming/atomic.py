"""Micro-batches that become visible as a whole: output, delivery log and checkpoints under one entry.

Every try of a batch writes into folders of its own. Then one entry, named by consumer and batch, says which try counts.
Readers join the entries with the folders (Spark prunes the folders by it), so they see a batch wholly or not at all: a
writer killed anywhere leaves folders that nobody reads, and of two writers of one batch one wins.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from waybill.operators import checkpoints, delivery
from waybill.operators.claim import KEY
from waybill.session import materialize
from waybill.sources.manifest import put_if_absent

BATCHES, OUTPUT, LOG, SAVES = "_batches", "output", "log", "checkpoints"
_ENTRY = "consumer string, batchId bigint, batchTry int, write string, outcome string"
_PLACE = "consumer string, batchId bigint, write string"


def published(spark: SparkSession, root: str) -> DataFrame:
    """``consumer, batchId, batchTry, write, outcome``: a COMMIT for every published batch, a ROLLBACK for every failed try."""
    try:
        return spark.read.schema(_ENTRY).json(f"{root}/{BATCHES}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)


def read_published(spark: SparkSession, root: str, part: str, schema: StructType | str) -> DataFrame:
    """The rows of ``part`` (``output``, ``log``, ``checkpoints``) that published tries wrote, with their batch."""
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    entries = published(spark, root)
    columns = [f.name for f in schema.fields if f.name not in ("consumer", "batchId", "write", "batchTry", "outcome")]
    whole = StructType([schema[c] for c in columns])
    for field in spark.createDataFrame([], _PLACE).schema.fields:
        whole.add(field)
    try:
        rows = spark.read.schema(whole).parquet(f"{root}/{part}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], whole)
    # A rolled back try publishes its log rows only.
    if part != LOG:
        entries = entries.where(F.col("outcome") == "COMMIT")
    return rows.join(entries, ["consumer", "batchId", "write"]).drop("write")


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """The delivery log of all published tries, for claims, redelivery counts and metrics."""
    log = read_published(spark, root, LOG, delivery.LOG_SCHEMA)
    return log.select([f.name for f in spark.createDataFrame([], delivery.LOG_SCHEMA).schema.fields])


def read_checkpoints(spark: SparkSession, root: str) -> DataFrame:
    """The save log of all published batches; see ``operators.checkpoints``."""
    kinds = dict.fromkeys(checkpoints.FIELDS, "string") | {
        "lastProcessedTimestamp": "bigint",
        "messagesProcessed": "bigint",
        "bytesProcessed": "bigint",
        "partitionId": "int",
        "createdAt": "bigint",
    }
    saves = read_published(spark, root, SAVES, ", ".join(f"{c} {k}" for c, k in kinds.items()))
    return saves.select(*checkpoints.FIELDS, F.col("batchId").alias("seq"), F.lit(False).alias("deleted"))


def publish_batch(
    batch: DataFrame, batch_id: int, make: Callable[[DataFrame], DataFrame], root: str, consumer: str, queue_manager: str = ""
) -> bool:
    """Write ``make(batch)``, the log rows and the checkpoints of a batch, and publish them at once.

    False, and nothing done, if the batch is published already. If ``make`` or its result fails, the try is published as
    a rollback and the error raised. ``make`` sees redelivery counts that include the batch's failed tries.
    """
    spark = batch.sparkSession
    mine = published(spark, root).where((F.col("consumer") == consumer) & (F.col("batchId") == batch_id)).collect()
    if any(r["outcome"] == "COMMIT" for r in mine):
        return False
    batch_try = 1 + len(mine)
    write = uuid.uuid4().hex
    place = f"consumer={consumer}/batchId={batch_id}/write={write}"
    tried = batch
    if mine:
        log = read_log(spark, root).where((F.col("consumer") == consumer) & (F.col("batchId") == batch_id))
        tried = delivery.with_redelivery_count(batch, materialize(log.select(*KEY, "outcome"), "rollbacks"))
    tried = tried.persist(StorageLevel.MEMORY_AND_DISK)

    def publish(outcome: str) -> bool:
        rows = delivery.settle(tried, batch_id, outcome, F.current_timestamp(), batch_try, consumer)
        rows.select(*KEY, "attempt", "ts").write.parquet(f"{root}/{LOG}/{place}")
        name = f"{batch_id:020d}" if outcome == "COMMIT" else f"{batch_id:020d}-rollback-{batch_try}"
        entry = {"consumer": consumer, "batchId": batch_id, "batchTry": batch_try, "write": write, "outcome": outcome}
        return put_if_absent(spark, f"{root}/{BATCHES}/{consumer}-{name}.json", json.dumps(entry))

    try:
        try:
            make(tried).write.parquet(f"{root}/{OUTPUT}/{place}")
            placed = tried if "partitionId" in tried.columns else tried.withColumn("partitionId", F.lit(0))
            saves = checkpoints.build_checkpoints(placed, queue_manager, F.unix_millis(F.current_timestamp()))
            saves.write.parquet(f"{root}/{SAVES}/{place}")
        except Exception:
            publish("ROLLBACK")
            raise
        return publish("COMMIT")
    finally:
        tried.unpersist()


def publish_each_batch(
    messages: DataFrame,
    make: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
    queue_manager: str = "",
    consumer: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Publish every micro-batch of a stream below ``root``; ``make`` turns its messages into output rows.

    A batch that was published before the driver died is not written again when Spark replays it. Streams may share
    ``root``; each has a ``consumer`` name of its own, by default made of its checkpoint folder.
    """
    consumer = consumer or f"stream-{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        publish_batch(batch, batch_id, make, root, consumer, queue_manager)

    writer = messages.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def leftovers(spark: SparkSession, root: str, part: str) -> DataFrame:
    """``consumer, batchId, write`` of the tries below ``part`` that were never published: what a clean-up may delete
    once no writer of that age can be alive."""
    written = spark.read.schema(_PLACE).parquet(f"{root}/{part}").select("consumer", "batchId", "write").distinct()
    return written.join(published(spark, root), ["consumer", "batchId", "write"], "left_anti")

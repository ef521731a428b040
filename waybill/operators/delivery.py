"""The delivery log: commit, rollback and redelivery counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.operators.claim import BROADCAST_ROWS, KEY

LOG_SCHEMA = (
    "queueName string, messageIdHex string, attempt int, ts timestamp, outcome string, consumer string, batchId bigint, "
    "batchTry int"
)
_PARTITIONS = ["outcome", "consumer", "batchId", "batchTry"]
#: Who settles batches that are claimed by hand; streams have names of their own.
CONSUMER = "claims"


def settle(
    batch: DataFrame, batch_id: int, outcome: str, at: Column, batch_try: int = 1, consumer: str = CONSUMER
) -> DataFrame:
    """One log row per message of ``batch``; ``outcome`` is COMMIT or ROLLBACK for the whole batch.

    ``batch_try`` counts how often the batch was tried; see ``next_try``. Batch ids are numbers of their
    ``consumer``: two consumers may use the same ones in one log.
    """
    return batch.select(
        *KEY,
        (F.col("backoutCount") + 1).alias("attempt"),
        F.lit(outcome).alias("outcome"),
        at.alias("ts"),
        F.lit(consumer).alias("consumer"),
        F.lit(batch_id).cast("bigint").alias("batchId"),
        F.lit(batch_try).alias("batchTry"),
    )


def next_try(log: DataFrame, batch_id: int, consumer: str = CONSUMER) -> int:
    """1 plus the rollbacks of the consumer's batch so far. Reads only the folders of that batch."""
    mine = (F.col("batchId") == batch_id) & (F.col("consumer") == consumer)
    failed = log.filter(mine & (F.col("outcome") == "ROLLBACK"))
    return 1 + (failed.agg(F.max("batchTry")).first()[0] or 0)


def append_log(entries: DataFrame, path: str) -> None:
    """Write log rows under their outcome, consumer, batch and try.

    Writing the same try of a batch again replaces it, so a replay adds nothing, while earlier tries
    stay on record. Readers of one outcome skip the files of the other.
    """
    (
        entries.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*_PARTITIONS)
        .parquet(path)
    )


def init_log(spark: SparkSession, path: str) -> None:
    """Create an empty log where there is none.

    One file without rows stands in a full set of partition folders, so readers see the partition columns as such
    from the first moment on.
    """
    none = spark.createDataFrame([], LOG_SCHEMA).drop(*_PARTITIONS)
    none.coalesce(1).write.mode("ignore").parquet(f"{path}/outcome=NONE/consumer=NONE/batchId=-1/batchTry=0")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def with_redelivery_count(messages: DataFrame, log: DataFrame) -> DataFrame:
    """``backoutCount`` raised by the rollbacks logged for the message.

    The log is counted per message before the join, so repeated rollbacks of one message travel as
    one row. While they are few (they are counted first), only their ids are sent to the messages and no
    payload is shuffled; beyond that both sides are.
    """
    rollbacks = log.filter(F.col("outcome") == "ROLLBACK").groupBy(*KEY).agg(F.count("*").alias("_rollbacks"))
    if rollbacks.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rollbacks = F.broadcast(rollbacks)
    count = F.col("backoutCount") + F.coalesce(F.col("_rollbacks"), F.lit(0))
    return messages.join(rollbacks, KEY, "left").withColumn("backoutCount", count.cast("int")).drop("_rollbacks")

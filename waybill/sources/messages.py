"""Message tables and file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from waybill.schema import CANONICAL

TABLE_SCHEMA = StructType(
    [
        *CANONICAL.fields,
        StructField("messageIdHex", StringType(), False),
        StructField("correlationIdHex", StringType(), True),
        StructField("receivedAt", TimestampType(), True),
        StructField("payloadSize", LongType(), True),
    ]
)


def write_messages(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Store messages partitioned by queue, so reading one queue skips the others.

    Rebalancing gives every queue few, well-sized files; a hot queue is split over many tasks.
    """
    messages.hint("rebalance", "queueName").write.mode(mode).partitionBy("queueName").parquet(path)


def read_messages(spark: SparkSession, path: str, queues: list[str] | None = None) -> DataFrame:
    table = spark.read.schema(TABLE_SCHEMA).parquet(path)
    return table if queues is None else table.filter(F.col("queueName").isin(*queues))


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Parquet files landing under ``path`` as a stream, admitted at most ``max_files`` / ``max_bytes``
    per micro-batch. Offsets and replay are the file source's own."""
    reader = spark.readStream.schema(schema)
    options = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes, "pathGlobFilter": glob}
    for name, value in options.items():
        if value is not None:
            reader = reader.option(name, value)
    return reader.parquet(path)


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int, mode: str = "append") -> None:
    """Store messages or a delivery log as an external table bucketed by (queueName, messageIdHex).

    Two such tables with the same ``buckets`` join on that key without a shuffle: the unread and
    redelivery joins then read their inputs in place.
    """
    writer = df.write.mode(mode).option("path", path).bucketBy(buckets, "queueName", "messageIdHex")
    writer.sortBy("queueName", "messageIdHex").saveAsTable(table)

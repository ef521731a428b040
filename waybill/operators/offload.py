"""Moving large payloads out of the message rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.headers import stored_size
from waybill.functions.sizes import SizeProfile, payload_decision, should_offload
from waybill.operators.delivery import CONSUMER


def plan_offload(messages: DataFrame, profile: SizeProfile, location: str) -> DataFrame:
    """Add ``decision`` and ``payloadRef``, the content-addressed name by which ``restore`` finds an offloaded payload."""
    size = stored_size(messages)
    planned = messages.withColumn(
        "payloadRef",
        F.when(
            should_offload(size, profile) & (size <= profile.max_bytes),
            F.concat(F.lit(location.rstrip("/") + "/"), F.sha2("payload", 256)),
        ),
    )
    return planned.withColumn("decision", payload_decision(size, profile, reference=F.col("payloadRef")))


STORE_SCHEMA = "queueName string, messageIdHex string, payloadRef string, payload binary, consumer string, batchId bigint"


def write_offloaded(planned: DataFrame, path: str, batch_id: int, consumer: str = CONSUMER) -> None:
    """Store the large payloads of a batch under its consumer and id; a rerun rewrites that batch alone."""
    large = planned.filter(F.col("payloadRef").isNotNull())
    (
        large.select("queueName", "messageIdHex", "payloadRef", "payload")
        .withColumns({"consumer": F.lit(consumer), "batchId": F.lit(batch_id).cast("bigint")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("consumer", "batchId")
        .parquet(path)
    )


def read_offloaded(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).parquet(path)


def restore(slimmed: DataFrame, store: DataFrame) -> DataFrame:
    """``slimmed`` with the payloads its ``payloadRef`` names, from the rows of ``read_offloaded``.

    Only the payloads that are asked for are read into the join; equal ones stored more than once count once.
    A reference that the store doesn't have leaves the payload null. Rows without a reference keep their payload and
    stay where they are: in the join all of them would meet in the task of the null key.
    """
    kept, moved = slimmed.filter(F.col("payloadRef").isNull()), slimmed.filter(F.col("payloadRef").isNotNull())
    asked = moved.select("payloadRef").distinct()
    stored = store.select("payloadRef", F.col("payload").alias("_stored")).join(asked, "payloadRef", "left_semi")
    once = stored.groupBy("payloadRef").agg(F.first("_stored").alias("_stored"))
    joined = moved.join(once, "payloadRef", "left")
    filled = joined.withColumn("payload", F.coalesce("payload", "_stored")).drop("_stored")
    return kept.unionByName(filled.select(*slimmed.columns))


def slim(planned: DataFrame) -> DataFrame:
    """Messages with offloaded payloads taken out; ``payloadRef`` points to them."""
    return planned.withColumn("payload", F.when(F.col("payloadRef").isNull(), F.col("payload")))

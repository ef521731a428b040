"""The queue configuration table: defaults, replacement, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONFIG_SCHEMA = (
    "queueName string, batchSize int, pollTimeoutMs bigint, parserType string, "
    "throttleMessagesPerSecond int, maxRetries int, backoutThreshold int, priority int, enabled boolean"
)

# Settings of a queue that gives none.
CONFIG_DEFAULTS = {
    "batchSize": 1000,
    "pollTimeoutMs": 5000,
    "parserType": "AUTO",
    "throttleMessagesPerSecond": None,
    "maxRetries": 3,
    "backoutThreshold": 5,
    "priority": 0,
    "enabled": True,
}


def queue_config(spark: SparkSession, *queues: dict) -> DataFrame:
    """Configuration table of the given queues; each dict names its queue and any other setting."""
    names = ["queueName", *CONFIG_DEFAULTS]
    rows = [tuple({**CONFIG_DEFAULTS, **q}[n] for n in names) for q in queues]
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


def from_names(spark: SparkSession, *names: str) -> DataFrame:
    return queue_config(spark, *[{"queueName": n} for n in names])


def with_queues(config: DataFrame, replacements: DataFrame) -> DataFrame:
    """``config`` with the queues of ``replacements`` put in place of those of the same name."""
    return config.join(replacements, "queueName", "left_anti").unionByName(replacements)


def config_violations(config: DataFrame) -> DataFrame:
    """One row (queueName, violation) per problem: duplicate names, then each queue's own settings."""
    repeated = (
        config.groupBy("queueName")
        .count()
        .filter("count > 1")
        .select("queueName", F.concat(F.lit("duplicate queue names found: "), "queueName").alias("violation"))
    )
    limit = F.col("throttleMessagesPerSecond")
    checks = [
        (F.col("queueName") == "", "queueName is required"),
        (F.col("batchSize") <= 0, "batchSize must be positive"),
        (F.col("pollTimeoutMs") <= 0, "pollTimeoutMs must be positive"),
        (limit.isNotNull() & (limit <= 0), "throttleMessagesPerSecond must be positive"),
    ]
    return repeated.unionByName(_explode_checks(config, checks, ["queueName"]))


def checkpoint_violations(checkpoints: DataFrame) -> DataFrame:
    """One row per checkpoint that lacks its queue or queue manager name."""
    checks = [
        (F.col("queueName") == "", "queueName is required"),
        (F.col("queueManager") == "", "queueManager is required"),
    ]
    return _explode_checks(checkpoints, checks, ["queueName", "partitionId"])


def _explode_checks(df: DataFrame, checks: list, keys: list[str]) -> DataFrame:
    texts = [F.when(failed, F.concat("queueName", F.lit(f": {text}"))) for failed, text in checks]
    return df.select(*keys, F.explode(F.array_compact(F.array(*texts))).alias("violation"))

"""Processing times as mergeable quantile sketches: stored per queue and minute, merged for any span.

The sketches are native KLL aggregates: partial ones are made before the shuffle, so a hot queue is no burden, and merging
stored ones reads a few kilobytes for each minute instead of its messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill.functions.headers import latency_ms
from waybill.operators.joins import join_dimension

MINUTE_MS = 60_000
#: Size of a sketch. At 1,000 the rank of a quantile is off by about a third of a per cent.
K = 1_000
QUANTILES = (0.5, 0.9, 0.99)
_STORED = "queueName string, windowStart bigint, processed bigint, totalMs bigint, shortestMs bigint, longestMs bigint, sketch binary"


def time_sketches(messages: DataFrame, width_ms: int = MINUTE_MS, k: int = K) -> DataFrame:
    """``queueName, windowStart, processed, totalMs, shortestMs, longestMs, sketch`` of the times between put and receipt.

    A window is ``width_ms`` of put time. Messages without a time of receipt were not processed and don't count.
    """
    took = latency_ms(F.col("receivedAt"), F.col("timestamp"))
    put = F.unix_millis("timestamp")
    timed = messages.select("queueName", (put - F.pmod(put, F.lit(width_ms))).alias("windowStart"), took.alias("_ms"))
    return timed.where(F.col("_ms").isNotNull()).groupBy("queueName", "windowStart").agg(
        F.count("*").alias("processed"),
        F.sum("_ms").alias("totalMs"),
        F.min("_ms").alias("shortestMs"),
        F.max("_ms").alias("longestMs"),
        F.kll_sketch_agg_bigint("_ms", k).alias("sketch"),
    )


def merge_sketches(stored: DataFrame, *keys: Column | str) -> DataFrame:
    """Sketches merged by ``keys`` (by default the queue), with ``averageMs``. A window may be stored in several rows."""
    merged = stored.groupBy(*(keys or ("queueName",))).agg(
        F.sum("processed").alias("processed"),
        F.sum("totalMs").alias("totalMs"),
        F.min("shortestMs").alias("shortestMs"),
        F.max("longestMs").alias("longestMs"),
        F.kll_merge_agg_bigint("sketch").alias("sketch"),
    )
    return merged.withColumn("averageMs", F.col("totalMs") / F.col("processed"))


def with_quantiles(merged: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """A column ``p50``, ``p90``, .. for every quantile in place of the sketch; the ends are exact."""
    columns = {}
    for q in quantiles:
        if not 0 <= q <= 1:
            raise ValueError(f"{q} is no quantile")
        guess = F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q)))
        columns[column_of(q)] = {0.0: F.col("shortestMs"), 1.0: F.col("longestMs")}.get(q, guess)
    return merged.withColumns(columns).drop("sketch")


def column_of(quantile: float) -> str:
    return f"p{100 * quantile:g}".replace(".", "_")


def rank_errors(messages: DataFrame, found: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """How far the ranks of a queue's quantiles are off, from its messages: ``queueName`` and ``p50Error``, .. as shares.

    A value that many messages share has all their ranks; 0 if the quantile is among them.
    """
    took = latency_ms(F.col("receivedAt"), F.col("timestamp"))
    names = [column_of(q) for q in quantiles]
    rows = messages.select("queueName", "timestamp", took.alias("_ms")).where(F.col("_ms").isNotNull())
    rows = join_dimension(rows, found.select("queueName", *names), ["queueName"])
    counts = rows.groupBy("queueName").agg(
        F.count("*").alias("_n"),
        *[F.count_if(F.col("_ms") < F.col(n)).alias(f"{n}_below") for n in names],
        *[F.count_if(F.col("_ms") <= F.col(n)).alias(f"{n}_upto") for n in names],
    )
    errors = []
    for q, n in zip(quantiles, names, strict=True):
        low, high = F.col(f"{n}_below") / F.col("_n"), F.col(f"{n}_upto") / F.col("_n")
        errors.append(F.greatest(F.lit(0.0), low - q, F.lit(q) - high).alias(f"{n}Error"))
    return counts.select("queueName", *errors)


def sketch_each_batch(messages: DataFrame, path: str, checkpoint: str, width_ms: int = MINUTE_MS, k: int = K) -> StreamingQuery:
    """Store the sketches of every micro-batch under its id; a replay replaces them. Read them with ``read_sketches``."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        time_sketches(batch, width_ms, k).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = messages.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(f"{path}/*")

"""Streams whose rows are worked out in order of time, once a watermark has passed them, a micro-batch at a time.

What the watermark has not passed yet and what a step carries on are tables of the micro-batch, below the checkpoint. A
micro-batch starts from the tables of its predecessor, so a replay gives the same rows, and no task holds a key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Writes a frame below the micro-batch and reads it back: ``keep(df, name)``.
Keep = Callable[[DataFrame, str], DataFrame]
#: ``step(ready, carried, watermark, keep)`` gives the results and the tables to carry on.
Step = Callable[[DataFrame, dict[str, DataFrame], int, Keep], tuple[DataFrame, dict[str, DataFrame]]]


@dataclass(frozen=True)
class Passed:
    """``rows`` (a stream with ``ts`` and ``ms``), handed to ``step`` when they are ``delay_ms`` behind the youngest.

    Each row is handed over once. One that lands behind the watermark of earlier micro-batches is dropped, as its place in
    the order is gone; one without a time has none. ``carry`` names the tables of the step with their schemas.
    """

    rows: DataFrame
    delay_ms: int
    step: Step
    carry: dict[str, str]


def delay_ms(spark: SparkSession, delay: str) -> int:
    """Milliseconds of an interval as ``withWatermark`` takes it."""
    ms = spark.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {delay}"))).first()[0]
    if ms < 0:
        raise ValueError(f"delay must not be negative: {delay}")
    return ms


def write_passed(passed: Passed, path: str, checkpoint: str) -> StreamingQuery:
    """Write the results of every micro-batch under its id, until what has landed is read."""
    root = f"{checkpoint.rstrip('/')}/passed"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        here, before = f"{root}/batch={batch_id}", f"{root}/batch={batch_id - 1}"

        def keep(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{here}/{name}")
            return spark.read.schema(df.schema).parquet(f"{here}/{name}")

        def kept(name: str, schema) -> DataFrame:
            return spark.read.schema(schema).parquet(f"{before}/{name}") if batch_id else spark.createDataFrame([], schema)

        schema = batch.drop("ts").schema
        first = kept("watermark", "watermark bigint").first() if batch_id else None
        passed_before = first[0] if first else 0
        late = F.unix_micros("ts") <= F.lit(passed_before) * 1000
        landed = keep(batch.where(F.col("ts").isNotNull() & ~late).drop("ts"), "landed")
        youngest = landed.agg(F.max("ms")).first()[0]
        watermark = passed_before if youngest is None else max(passed_before, youngest - passed.delay_ms)
        rows = landed.unionByName(kept("early", schema))
        carried = {name: kept(name, kind) for name, kind in passed.carry.items()}
        results, carry = passed.step(rows.where(F.col("ms") <= watermark), carried, watermark, keep)
        results.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        for name, table in carry.items():
            keep(table, name)
        keep(rows.where(F.col("ms") > watermark), "early")
        keep(spark.range(1).select(F.lit(watermark).cast("bigint").alias("watermark")), "watermark")
        # A replay of this batch needs its predecessor's tables and no older ones.
        _delete(spark, f"{root}/batch={batch_id - 2}")

    writer = passed.rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

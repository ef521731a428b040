"""Quantiles from stored sketches."""

import random

import pytest
from pyspark.sql import functions as F

from waybill.operators import latencies
from waybill.session import shared_dir
from waybill.sources import messages as tables
from waybill.streaming import ingest

BASE = 1_700_000_000_000


@pytest.fixture(scope="module")
def timed(spark):
    """A hot queue with a long tail, one of equal times, one of three messages, one without a receipt."""
    hot = spark.range(60_000).select(
        F.lit("HOT").alias("queueName"),
        F.timestamp_millis(F.lit(BASE) + F.col("id") * 10).alias("timestamp"),
        F.pow(F.pmod(F.xxhash64("id"), F.lit(1000)), 2).cast("bigint").alias("took"),
    )
    rows = [("FLAT", BASE + i, 7) for i in range(500)] + [("FEW", BASE + 90_000 * i, 10 * i) for i in range(3)] + [("OPEN", BASE, None)]
    few = spark.createDataFrame(rows, "queueName string, ms bigint, took bigint")
    few = few.select("queueName", F.timestamp_millis("ms").alias("timestamp"), "took")
    whole = hot.unionByName(few)
    received = F.timestamp_millis(F.unix_millis("timestamp") + F.col("took")).alias("receivedAt")
    return whole.select("queueName", "timestamp", received, "took").cache()


def test_quantiles_of_merged_minutes_are_near(spark, timed):
    stored = latencies.time_sketches(timed)
    assert stored.count() == 11 + 1 + 3
    found = latencies.with_quantiles(latencies.merge_sketches(stored), (0, 0.01, *latencies.QUANTILES, 0.999, 1))
    rows = {r["queueName"]: r for r in found.collect()}
    assert set(rows) == {"HOT", "FLAT", "FEW"}
    assert (rows["FLAT"]["p1"], rows["FLAT"]["p99_9"], rows["FLAT"]["averageMs"]) == (7, 7, 7.0)
    assert (rows["FEW"]["p0"], rows["FEW"]["p50"], rows["FEW"]["p100"]) == (0, 10, 20)
    exact = timed.where("queueName = 'HOT'").agg(F.avg("took"), F.max("took")).first()
    assert rows["HOT"]["averageMs"] == pytest.approx(exact[0]) and rows["HOT"]["p100"] == exact[1]
    errors = latencies.rank_errors(timed, found).collect()
    assert len(errors) == 3 and all(0 <= e[1:][k] < 0.01 for e in errors for k in range(3))


def test_any_span_can_be_merged(spark, timed):
    stored = latencies.time_sketches(timed, 1000, k=50)
    path = shared_dir(spark, "sketches")
    stored.write.parquet(path)
    stored = spark.read.parquet(path)
    half = latencies.merge_sketches(stored.where(F.col("windowStart") < BASE + 300_000))
    assert half.where("queueName = 'HOT'").first()["processed"] == 30_000
    by_minute = latencies.merge_sketches(stored, "queueName", F.floor(F.col("windowStart") / 60_000).alias("minute"))
    assert by_minute.agg(F.sum("processed")).first()[0] == 60_503
    with pytest.raises(ValueError, match="no quantile"):
        latencies.with_quantiles(half, (1.5,))


def test_a_stream_of_sketches_equals_the_batch(spark, messages):
    path, out, draw = shared_dir(spark, "in"), shared_dir(spark, "out"), random.Random(1)
    for part in range(2):
        rows = messages(*[{"id": part * 100 + i + 1, "queue": "AB"[i % 2], "ms": BASE + draw.randrange(100_000)} for i in range(100)])
        received = F.timestamp_millis(F.unix_millis("timestamp") + F.pmod(F.xxhash64("messageIdHex"), F.lit(999)))
        rows.withColumn("receivedAt", received).coalesce(1).write.mode("append").parquet(path)
    fed = tables.stream_files(spark, path, tables.TABLE_SCHEMA, max_files=1)
    ingest.run_to_end(latencies.sketch_each_batch(fed, out, f"{out}-c"))
    columns = ["queueName", "processed", "totalMs", "p50", "p90", "p99"]
    shown = lambda stored: sorted(latencies.with_quantiles(latencies.merge_sketches(stored)).select(columns).collect())
    assert shown(latencies.read_sketches(spark, out)) == shown(latencies.time_sketches(spark.read.parquet(path)))

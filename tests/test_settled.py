"""Claims by bitmaps of settled rows equal claims by the log, and read only what is unread."""

import random

import pytest
from pyspark.sql import functions as F

from waybill.operators import claim, settled
from waybill.session import shared_dir
from waybill.sources import landed

BASE = 1_700_000_000_000


@pytest.fixture
def table(spark, messages):
    path = shared_dir(spark, "landed")
    draw = random.Random(6)
    for load in range(3):
        rows = [{"id": load * 100 + i + 1, "queue": "ABC"[i % 3], "ms": BASE + draw.randrange(1000)} for i in range(100)]
        landed.land(messages(*rows), path)
    return path


def test_claims_equal_claims_by_the_log(spark, table):
    root, draw = shared_dir(spark, "settled"), random.Random(7)
    everything = landed.read_landed(spark, table).cache()
    done: set[str] = set()
    ids = [r["messageIdHex"] for r in everything.select("messageIdHex").collect()]
    for turn in range(4):
        log = spark.createDataFrame([(i, "COMMIT") for i in sorted(done)], "messageIdHex string, outcome string")
        log = log.join(everything.select("queueName", "messageIdHex"), "messageIdHex")
        expected = claim.claim_batch(everything.drop("landedFile", "landedRow"), log, ["A", "B"], 9)
        got = settled.claim_landed(spark, table, root, ["A", "B"], 9)
        key = lambda df: sorted((r["queueName"], r["position"], r["messageIdHex"]) for r in df.collect())
        assert key(got) == key(expected) and got.count() == 18
        settled.settle(got, root)
        done |= {r["messageIdHex"] for r in got.collect()}
        some = draw.sample(ids, 20)
        settled.settle(everything.where(F.col("messageIdHex").isin(some)), root)
        done |= set(some)
        if turn % 2:
            settled.compact(spark, root)
            assert len(settled.live_marks(spark, root)) == 1
    assert {r["messageIdHex"] for r in settled.unsettled(spark, table, root).collect()} == set(ids) - done
    assert settled.progress(spark, table, root).agg(F.sum("settled")).first()[0] == len(done)


def test_full_files_are_not_read(spark, table):
    root = shared_dir(spark, "settled")
    rows = landed.read_landed(spark, table)
    first = [r["file"] for r in landed.loads(spark, table).where("version = 1").select(F.explode("files").alias("f")).select("f.file").collect()]
    settled.settle(rows.where(F.col("landedFile").isin(first)), root)
    settled.settle(rows.where(F.col("landedFile").isin(first)), root)
    left = settled.unsettled(spark, table, root)
    assert left.count() == 200 and not set(left.inputFiles()) & {f for f in rows.inputFiles() if any(f.endswith(x) for x in first)}
    settled.settle(rows, root)
    settled.compact(spark, root)
    assert settled.unsettled(spark, table, root).count() == 0
    assert settled.claim_landed(spark, table, root, ["A"], 5).count() == 0


def test_bits_of_many_buckets(spark, table):
    """Places at the edges of bytes and buckets."""
    root = shared_dir(spark, "settled")
    places = [0, 1, 7, 8, 255, 32_767, 32_768, 65_535, 65_536, 1_000_000]
    settled.settle(spark.createDataFrame([("f", p) for p in places], "landedFile string, landedRow bigint"), root)
    found = settled.settled(spark, root)
    assert found.agg(F.sum("n")).first()[0] == len(places)
    assert {r["bucket"]: r["n"] for r in found.collect()} == {1: 6, 2: 2, 3: 1, 31: 1}


def test_nothing_settled_and_bad_sizes(spark, table):
    root = shared_dir(spark, "settled")
    assert settled.settled(spark, root).count() == 0 and settled.live_marks(spark, root) == []
    assert settled.unsettled(spark, table, root).count() == 300
    settled.compact(spark, root)
    with pytest.raises(ValueError, match="positive"):
        settled.claim_landed(spark, table, root, ["A"], 0)

"""Copies of any age are found over a stream, and no first copy is lost."""

import random

import pytest
from pyspark.sql import functions as F

from waybill.session import shared_dir
from waybill.sources import messages as tables
from waybill.streaming import ingest
from waybill.streaming import seen as seen_module
from waybill.streaming.seen import Seen, deduplicate_each_batch

DAY = 86_400_000


@pytest.fixture
def feed(spark, messages):
    """Five files, weeks apart; ids return from any earlier file and within their own."""
    path, draw = shared_dir(spark, "feed"), random.Random(8)
    for part in range(5):
        ids = [draw.randrange(1, 60 * (part + 1)) for _ in range(80)]
        rows = [{"id": i, "queue": "AB"[i % 2], "ms": 1_700_000_000_000 + part * 20 * DAY + k, "payload": f"{part}"} for k, i in enumerate(ids)]
        messages(*rows).coalesce(1).write.mode("append").parquet(f"{path}/part={part}")
    return path


def run(spark, path, seen, out, handle=None):
    fed = tables.stream_files(spark, f"{path}/*", tables.TABLE_SCHEMA, max_files=1)
    ingest.run_to_end(deduplicate_each_batch(fed, handle or ingest.write_batch(f"{out}/t"), seen, f"{out}/c"))


@pytest.mark.parametrize("segments, probes", [(16, 4), (1, 1)])
def test_every_id_is_kept_once(spark, feed, segments, probes):
    out = shared_dir(spark, "out")
    run(spark, feed, Seen(f"{out}/seen", 3, segments, probes), out)
    got, fed = spark.read.parquet(f"{out}/t/*"), spark.read.parquet(f"{feed}/*")
    assert fed.count() == 400
    assert got.count() == got.select("messageIdHex").distinct().count() == fed.select("messageIdHex").distinct().count()
    # Of all copies the first that came.
    first = {r["messageIdHex"]: r["t"] for r in fed.groupBy("messageIdHex").agg(F.min("timestamp").alias("t")).collect()}
    assert {r["messageIdHex"]: r["timestamp"] for r in got.collect()} == first


def test_a_failed_batch_does_not_find_itself(spark, feed):
    out, tries = shared_dir(spark, "out"), []
    store, seen = ingest.write_batch(f"{out}/t"), Seen(f"{out}/seen", 3)

    def handle(batch, batch_id):
        store(batch, batch_id)
        tries.append(batch_id)
        if tries.count(2) == 1 and batch_id == 2:
            raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        run(spark, feed, seen, out, handle)
    run(spark, feed, seen, out, handle)
    assert tries == [0, 1, 2, 2, 3, 4]
    got = spark.read.parquet(f"{out}/t/*")
    assert got.count() == spark.read.parquet(f"{feed}/*").select("messageIdHex").distinct().count()
    # A batch that was remembered before its end got lost gives the same rows again.
    part = spark.read.schema(tables.TABLE_SCHEMA).parquet(f"{out}/t/batch=4")
    assert seen.unseen(part, 4).count() == part.count() and seen.unseen(part, 9).count() == 0
    assert not seen.remember(part, 4)


def test_a_full_filter_drops_nothing(spark, messages):
    """Far more ids than bits: every id is suspected, and looked up."""
    root = shared_dir(spark, "seen")
    seen = Seen(root, 1, 1, 2)
    old = spark.range(200_000).select(F.hex(F.xxhash64("id")).alias("messageIdHex"))
    seen.remember(old, 0)
    rows = messages(*[{"id": i + 1} for i in range(50)])
    assert seen.suspects(rows.select(F.col("messageIdHex").alias("id")), 1).count() > 40
    assert seen.unseen(rows, 1).count() == 50
    assert seen.unseen(rows.unionByName(rows).limit(0), 1).count() == 0


def test_rows_without_an_id_stay(spark, messages):
    seen = Seen(shared_dir(spark, "seen"))
    rows = messages({"id": 1}, {"id": 2}).withColumn("messageIdHex", F.lit(None).cast("string"))
    seen.remember(rows, 0)
    assert seen.unseen(rows, 1).count() == 2


@pytest.mark.parametrize("sent", [0, seen_module.SENT_BYTES])
def test_filters_of_either_size_suspect_what_was_seen(spark, messages, monkeypatch, sent):
    monkeypatch.setattr(seen_module, "SENT_BYTES", sent)
    seen = Seen(shared_dir(spark, "seen"), 3, 2)
    seen.remember(messages(*[{"id": i} for i in range(1, 41)]), 0)
    ids = messages(*[{"id": i} for i in range(21, 221)]).select(F.col("messageIdHex").alias("id"))
    old = {r["messageIdHex"] for r in messages(*[{"id": i} for i in range(21, 41)]).collect()}
    got = [r["id"] for r in seen.suspects(ids, 1).collect()]
    assert old <= set(got) and len(got) == len(set(got)) < 40


def test_probes_of_a_batch_are_not_shuffled(spark, messages):
    """Bits are looked up where an id is: neither one row for each bit nor a group by id."""
    seen = Seen(shared_dir(spark, "seen"), 3)
    seen.remember(messages(*[{"id": i} for i in range(1, 41)]), 0)
    rows = messages({"id": 7}, {"id": 70})
    found = seen.unseen(rows, 1)
    assert [r["messageIdHex"] for r in found.collect()] == [rows.collect()[1]["messageIdHex"]]
    # What comes back is written, so that remembering it reads neither the batch nor the filter again.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange" not in plan and "InMemoryTableScan" not in plan
    ids = rows.select(F.col("messageIdHex").alias("id"))
    probing = seen.suspects(ids, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in probing

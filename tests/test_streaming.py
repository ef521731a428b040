"""Streams give what the batch operators give, and survive a restart."""

import pytest
from pyspark.sql import functions as F

from waybill.operators import audit, checkpoints, delivery, throttle
from waybill.session import shared_dir
from waybill.sources import messages as tables
from waybill.streaming import fanout, ingest, stateful

HOUR = 3_600_000


@pytest.fixture
def landing(spark, messages):
    """Three files in time order, two hundred messages each; ids repeat in the next file."""

    def build(overlap=0):
        path = shared_dir(spark, "landing")
        for part in range(3):
            first = part * 200 - (overlap if part else 0)
            rows = [
                {"id": i + 1, "queue": "AB"[i % 2], "ms": 1_700_000_000_000 + i * 700, "payload": '{"i":%d}' % i}
                for i in range(first, (part + 1) * 200)
            ]
            messages(*rows).coalesce(1).write.mode("append").parquet(f"{path}/part={part}")
        return path

    return build


def stream(spark, path, parts="*", max_files=1):
    return tables.stream_files(spark, f"{path}/part={parts}", tables.TABLE_SCHEMA, max_files=max_files)


def test_ingest_restarts_where_it_stopped(spark, landing, messages):
    path, out = landing(), shared_dir(spark, "out")
    read = lambda: tables.stream_files(spark, f"{path}/*", tables.TABLE_SCHEMA, max_files=1)
    ingest.run_to_end(ingest.ingest(read(), f"{out}/t", f"{out}/c"))
    assert spark.read.parquet(f"{out}/t").count() == 600
    messages({"id": 9999}).write.parquet(f"{path}/part=3")
    ingest.run_to_end(ingest.ingest(read(), f"{out}/t", f"{out}/c"))
    table = spark.read.parquet(f"{out}/t")
    assert table.count() == 601 and table.select("messageIdHex").distinct().count() == 601


def test_deduplicate_stream(spark, landing):
    path, out = landing(overlap=50), shared_dir(spark, "out")
    once = ingest.deduplicate_stream(stream(spark, path), "1 hour")
    ingest.run_to_end(ingest.ingest(once, f"{out}/t", f"{out}/c"))
    assert spark.read.parquet(f"{path}/*").count() == 700
    got = spark.read.parquet(f"{out}/t")
    assert got.count() == 600 and got.select("messageIdHex").distinct().count() == 600


def test_failed_batch_is_rolled_back_and_replayed(spark, landing):
    path, out = landing(), shared_dir(spark, "out")
    store, tries = ingest.write_batch(f"{out}/t"), []

    def handle(batch, batch_id):
        tries.append(batch_id)
        store(batch, batch_id)
        if batch_id == 1 and tries.count(1) < 3:
            raise RuntimeError("sink is down")

    def run():
        fed = stream(spark, path)
        ingest.run_to_end(ingest.commit_each_batch(fed, handle, f"{out}/log", f"{out}/c", f"{out}/saves", "QM"))

    for _ in range(2):
        with pytest.raises(Exception, match="sink is down"):
            run()
    # a checkpoint is only saved after a commit
    assert {r["seq"] for r in spark.read.parquet(f"{out}/saves/*").collect()} == {0}
    run()
    assert tries == [0, 1, 1, 1, 2]
    assert spark.read.parquet(f"{out}/t/*").count() == 600
    log = delivery.read_log(spark, f"{out}/log")
    commits = log.filter("outcome = 'COMMIT'")
    assert commits.count() == 600 and commits.select("messageIdHex").distinct().count() == 600
    again = log.filter("outcome = 'ROLLBACK'").groupBy("messageIdHex").count()
    assert again.count() == 200 and {r["count"] for r in again.collect()} == {2}
    assert {r["attempt"] for r in commits.filter("batchId = 1").collect()} == {3}
    saved = checkpoints.latest(spark.read.parquet(f"{out}/saves/*"))
    assert {r["queueName"]: r["messagesProcessed"] for r in saved.collect()} == {"A": 100, "B": 100}


def test_throttle_stream_equals_the_batch(spark, landing):
    path, out = landing(), shared_dir(spark, "out")
    limits = spark.createDataFrame([("A", 1), ("B", 2)], "queueName string, tokens int")
    columns = "queueName", "messageIdHex", "timestamp"
    fed = stream(spark, path).select(*columns)
    ingest.run_to_end(stateful.throttle_stream(fed, limits, out, f"{out}/c", 5000))
    got = spark.read.parquet(f"{out}/granted/*")
    expected = throttle.throttle(spark.read.parquet(f"{path}/*").select(*columns), limits, 5000)
    pairs = lambda df: sorted((r["messageIdHex"], r["granted"]) for r in df.collect())
    assert pairs(got) == pairs(expected)
    assert 0 < got.filter("granted").count() < 600


def test_counter_stream_equals_the_batch(spark, landing):
    path, out = landing(), shared_dir(spark, "out")
    counters = stateful.counter_stream(stream(spark, path), "1 minute", "1 hour")
    ingest.run_to_end(stateful.write_counters(counters, out))
    got = {(r["queueName"], r["windowStart"]): r["messagesReceived"] for r in stateful.read_counters(spark, out).collect()}
    minute = (F.floor(F.unix_millis("timestamp") / 60000) * 60000).alias("w")
    batch = spark.read.parquet(f"{path}/*").groupBy("queueName", minute).count().collect()
    assert got == {(r["queueName"], r["w"]): r["count"] for r in batch}


def test_audit_goes_to_every_sink(spark, landing):
    path, out = landing(), shared_dir(spark, "out")
    events = audit.received(stream(spark, path), "QM", "test")
    sink = fanout.composite_sink(
        fanout.console_sink(f"{out}/console"),
        fanout.errors_only_sink(fanout.json_sink(f"{out}/errors")),
        fanout.table_sink(f"{out}/table"),
        fanout.noop_sink(),
    )
    ingest.run_to_end(fanout.write_audit(events, sink, f"{out}/c"))
    assert spark.read.text(f"{out}/console/*").count() == 600
    assert spark.read.text(f"{out}/errors/*").count() == 0
    assert audit.of_type(spark.read.parquet(f"{out}/table/*"), "MESSAGE_RECEIVED").count() == 600

"""A published batch is seen wholly or not at all."""

import threading

import pytest
from pyspark.sql import functions as F

from waybill.operators import checkpoints, claim
from waybill.session import shared_dir
from waybill.sources import landed
from waybill.streaming import atomic, ingest

OUT = "queueName string, messageIdHex string, backoutCount int"


def plain(batch):
    return batch.select("queueName", "messageIdHex", "backoutCount")


def seen(spark, root):
    """Rows of all three parts."""
    return (
        atomic.read_published(spark, root, atomic.OUTPUT, OUT).count(),
        atomic.read_log(spark, root).where("outcome = 'COMMIT'").count(),
        atomic.read_checkpoints(spark, root).count(),
    )


@pytest.fixture
def root(spark):
    return shared_dir(spark, "published")


@pytest.fixture
def batch(messages):
    return messages(*[{"id": i + 1, "queue": "AB"[i % 2]} for i in range(30)])


def test_a_batch_is_published_once(spark, root, batch):
    assert seen(spark, root) == (0, 0, 0)
    assert atomic.publish_batch(batch, 0, plain, root, "c", "QM")
    assert seen(spark, root) == (30, 30, 2)
    assert not atomic.publish_batch(batch, 0, plain, root, "c", "QM")
    assert atomic.publish_batch(batch, 0, plain, root, "other", "QM")
    assert seen(spark, root) == (60, 60, 4)
    left = claim.unread(batch, atomic.read_log(spark, root))
    assert left.count() == 0
    got = checkpoints.latest(atomic.read_checkpoints(spark, root).where("queueName = 'A'")).first()
    assert (got["queueManager"], got["messagesProcessed"]) == ("QM", 15)


@pytest.mark.parametrize("place", ["output", "checkpoints", "log", "entry"])
def test_a_writer_killed_half_way_changes_nothing_that_is_read(spark, root, batch, monkeypatch, place):
    class Killed(BaseException):
        """Not an error that a writer could answer to."""

    def die(*_):
        raise Killed

    atomic.publish_batch(batch.limit(4), 0, plain, root, "c")
    before = seen(spark, root)
    if place == "output":
        make = lambda b: plain(b).union(b.select(F.raise_error(F.lit("gone")).cast("string"), F.lit(""), F.lit(0)))
        monkeypatch.setattr(atomic, "put_if_absent", die)
    else:
        make = plain
        where = {"checkpoints": (atomic.checkpoints, "build_checkpoints"), "log": (atomic.delivery, "settle"), "entry": (atomic, "put_if_absent")}
        monkeypatch.setattr(*where[place], die)
    with pytest.raises(BaseException):
        atomic.publish_batch(batch, 1, make, root, "c")
    monkeypatch.undo()
    assert seen(spark, root) == before
    if place == "entry":
        assert {r["batchId"] for r in atomic.leftovers(spark, root, atomic.OUTPUT).collect()} == {1}
    assert atomic.publish_batch(batch, 1, plain, root, "c")
    assert seen(spark, root)[:2] == (34, 34)


def test_of_two_writers_of_a_batch_one_counts(spark, root, batch):
    won, gate = [], threading.Barrier(2)

    def make(rows):
        gate.wait()
        return plain(rows)

    workers = [threading.Thread(target=lambda: won.append(atomic.publish_batch(batch, 7, make, root, "c"))) for _ in range(2)]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    assert sorted(won) == [False, True]
    assert seen(spark, root) == (30, 30, 2)


def test_failed_tries_are_rolled_back_and_counted(spark, root, batch):
    out = shared_dir(spark, "out")
    path = f"{out}/landed"
    landed.land(batch, path)
    tries = []

    def make(rows):
        tries.append(1)
        if 2 <= len(tries) <= 3:
            raise RuntimeError("sink is down")
        return plain(rows)

    def run():
        stream = landed.stream_landed(spark, path, 10)
        landed.caught_up(atomic.publish_each_batch(stream, make, root, f"{out}/c", "QM", "me", available_now=False))

    for _ in range(2):
        with pytest.raises(Exception, match="sink is down"):
            run()
        assert seen(spark, root) == (20, 20, 2)
    run()
    assert seen(spark, root) == (30, 30, 4)
    out_rows = atomic.read_published(spark, root, atomic.OUTPUT, OUT).collect()
    assert {(r["batchId"], r["backoutCount"]) for r in out_rows} == {(0, 0), (1, 2)}
    log = atomic.read_log(spark, root)
    assert {(r["batchTry"], r["outcome"], r["attempt"]) for r in log.where("batchId = 1").collect()} == {
        (1, "ROLLBACK", 1),
        (2, "ROLLBACK", 2),
        (3, "COMMIT", 3),
    }


def test_a_replay_after_the_commit_writes_nothing(spark, root, batch, monkeypatch):
    """The driver dies after the entry and before Spark's own record of the batch."""
    out, real = shared_dir(spark, "out"), atomic.publish_batch
    batch.write.parquet(f"{out}/in")

    def run():
        stream = spark.readStream.schema(batch.schema).parquet(f"{out}/in")
        ingest.run_to_end(atomic.publish_each_batch(stream, plain, root, f"{out}/c", consumer="me"))

    def dies(*args):
        real(*args)
        raise RuntimeError("driver died")

    monkeypatch.setattr(atomic, "publish_batch", dies)
    with pytest.raises(Exception, match="driver died"):
        run()
    monkeypatch.undo()
    before = atomic.published(spark, root).collect()
    run()
    assert atomic.published(spark, root).collect() == before and seen(spark, root) == (30, 30, 2)

"""Landed tables: loads appear whole and once, and streams over them are bounded by rows and replay the same rows."""

import json
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from waybill.session import shared_dir
from waybill.sources import landed, manifest
from waybill.streaming import ingest

BASE = 1_700_000_000_000


@pytest.fixture
def load(messages):
    """Messages ``first`` .. ``last`` of the queues, times falling, so that files must be put in order."""

    def build(first, last, queues="AB"):
        rows = [{"id": i + 1, "queue": queues[i % len(queues)], "ms": BASE - i, "payload": f"p{i}"} for i in range(first, last)]
        return messages(*rows)

    return build


def batches(spark, path, out, size, queues=None, fail=None):
    """Run the stream to its end, {batch: [(queue, id)]} of what every batch held at its last try."""
    held = {}

    def on_batch(batch, batch_id):
        held[batch_id] = [(r["queueName"], int(r["messageIdHex"], 16)) for r in batch.collect()]
        if batch_id == fail:
            raise RuntimeError("sink is down")

    stream = landed.stream_landed(spark, path, size, queues)
    query = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{out}/c").start()
    landed.caught_up(query)
    return held


def test_batches_hold_at_most_so_many_rows_of_a_queue_in_order(spark, load):
    path, out = shared_dir(spark, "landed"), shared_dir(spark, "out")
    assert landed.land(load(0, 50), path) == 1
    assert landed.land(load(50, 55, "ABC"), path) == 2
    got = batches(spark, path, out, 10)
    expected = {}
    for queue in "ABC":
        ids = [i + 1 for i in range(49, -1, -1) if "AB"[i % 2] == queue]
        ids += [i + 1 for i in range(54, 49, -1) if "ABC"[i % 3] == queue]
        expected[queue] = ids
    assert all(sum(q == queue for q, _ in rows) <= 10 for rows in got.values() for queue in "ABC")
    for queue in "ABC":
        assert [i for batch in sorted(got) for q, i in got[batch] if q == queue] == expected[queue]
    # The first batches are full.
    assert sorted(got[0]) == sorted((q, i) for q in "AB" for i in expected[q][:10]) + [("C", i) for i in sorted(expected["C"])]


def test_a_restart_goes_on_behind_the_last_batch_and_replays_a_failed_one(spark, load):
    path, out = shared_dir(spark, "landed"), shared_dir(spark, "out")
    landed.land(load(0, 30), path)
    whole = batches(spark, path, shared_dir(spark, "out"), 7)
    tries = {}
    for fail in (1, 1, 2, None):
        try:
            tries.setdefault(fail, []).append(batches(spark, path, out, 7, fail=fail))
        except Exception as error:
            assert "sink is down" in str(error)
    assert tries[None] and {k: sorted(v) for k, v in tries[None][0].items()} == {2: sorted(whole[2])}
    landed.land(load(30, 34), path)
    assert {k: sorted(i for _, i in v) for k, v in batches(spark, path, out, 7).items()} == {3: [31, 32, 33, 34]}
    assert batches(spark, path, out, 7) == {}


def test_queues_can_be_picked_and_columns_survive(spark, load, messages):
    path = shared_dir(spark, "landed")
    rows = messages({"id": 1, "queue": "A/B=ä %1", "payload": "é"}, {"id": 2, "queue": "C"})
    landed.land(rows, path)
    kept, out = shared_dir(spark, "kept"), shared_dir(spark, "out")
    stream = landed.stream_landed(spark, path, 5, ["A/B=ä %1"])
    landed.caught_up(stream.writeStream.format("parquet").option("path", kept).option("checkpointLocation", out).start())
    columns = [c for c in rows.columns if c in stream.columns]
    assert spark.read.parquet(kept).select(columns).collect() == rows.where("queueName <> 'C'").select(columns).collect()


def test_reading_gives_every_row_its_place(spark, load):
    path = shared_dir(spark, "landed")
    assert landed.read_landed(spark, path).count() == 0
    for first in (0, 20):
        landed.land(load(first, first + 20), path)
    got = landed.read_landed(spark, path)
    assert got.count() == 40 and got.select("landedFile", "landedRow").distinct().count() == 40
    known = landed.loads(spark, path).select(F.explode("files").alias("f")).select("f.*").collect()
    assert {(r["file"], r["rows"]) for r in known} == {(r["landedFile"], r["count"]) for r in got.groupBy("landedFile").count().collect()}


def test_a_load_without_an_entry_is_not_there(spark, load, monkeypatch):
    path = shared_dir(spark, "landed")
    landed.land(load(0, 4), path)
    monkeypatch.setattr(landed, "put_entry", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        landed.land(load(4, 8), path)
    monkeypatch.undo()
    assert landed.read_landed(spark, path).count() == 4
    assert landed.land(load(8, 9), path) == 2


def test_of_two_writers_one_gets_the_number(spark):
    folder, won = shared_dir(spark, "entries"), []
    workers = [threading.Thread(target=lambda k=k: won.append(k) if manifest.put_entry(spark, folder, 1, {"by": k}) else None) for k in range(8)]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    assert len(won) == 1
    entries = manifest.read_entries(spark, folder, "by bigint").collect()
    assert [(r["version"], r["by"]) for r in entries] == [(1, won[0])]
    assert not manifest.put_entry(spark, folder, 1, {"by": 99})


def test_commits_over_a_bounded_stream(spark, load):
    path, out = shared_dir(spark, "landed"), shared_dir(spark, "out")
    landed.land(load(0, 40), path)
    stream = landed.stream_landed(spark, path, 8)
    query = ingest.commit_each_batch(stream, ingest.write_batch(f"{out}/t"), f"{out}/log", f"{out}/c", f"{out}/saves", "QM", available_now=False)
    landed.caught_up(query)
    per_batch = spark.read.parquet(f"{out}/log").where("outcome = 'COMMIT'").groupBy("batchId", "queueName").count().collect()
    assert len(per_batch) == 6 and {r["count"] for r in per_batch} == {8, 4}
    assert json.loads(spark.read.parquet(f"{out}/saves/*").agg(F.to_json(F.collect_set("seq"))).first()[0])


def test_bad_sizes_are_refused(spark):
    with pytest.raises(Exception, match="batchSize must be positive"):
        stream = landed.stream_landed(spark, shared_dir(spark, "landed"), 0)
        landed.caught_up(stream.writeStream.format("noop").option("checkpointLocation", shared_dir(spark, "c")).start())


def test_a_batch_reads_no_more_than_its_row_groups(spark, load, monkeypatch):
    """However large a load is, its files and their row groups are bounded, and rows stay in order across them."""
    monkeypatch.setattr(landed, "GROUP_ROWS", 100)
    monkeypatch.setattr(landed, "FILE_ROWS", 300)
    path, out = shared_dir(spark, "landed"), shared_dir(spark, "out")
    landed.land(load(0, 5_000, "A").coalesce(1), path)
    files = landed.loads(spark, path).select(F.explode("files").alias("f")).select("f.*").collect()
    assert sum(r["rows"] for r in files) == 5_000 and max(r["rows"] for r in files) <= 300
    for r in files:
        meta = pq.ParquetFile(f"{path}/{r['file']}".removeprefix("file:")).metadata
        assert max(meta.row_group(k).num_rows for k in range(meta.num_row_groups)) <= 100
    got = batches(spark, path, out, 1_250)
    assert [i for batch in sorted(got) for _, i in got[batch]] == list(range(5_000, 0, -1))
    names = [f"load=a/queueName=A/part-{t:05d}-u.c{c:03d}.snappy.parquet" for t in (0, 1) for c in (0, 999, 1000)]
    assert sorted(reversed(names), key=landed._numbers) == names

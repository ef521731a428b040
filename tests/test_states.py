"""Connector states of a stream equal those of the whole log, across restarts and late files."""

import random

import pytest
from pyspark.sql import functions as F

from waybill.operators import control
from waybill.session import shared_dir
from waybill.streaming import drain, ingest, states

SCHEMA = "connectorId bigint, seq bigint, command string, ms bigint"
COMMANDS = ["PAUSE", "RESUME", "DRAIN", "COMPLETE_DRAIN", "REQUEST_STOP", "GRACEFUL_STOP", "UNKNOWN"]
COLUMNS = ["connectorId", "seq", "command", "stateBefore", "state", "changed", "stopRequested"]


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_equals_the_batch(spark, parts):
    draw = random.Random(parts)
    rows = [
        (draw.randrange(12), seq, draw.choices(COMMANDS, [20, 20, 2, 1, 1, 0.3, 5])[0], 1_000_000 + seq * 3 + draw.randrange(20))
        for seq in range(300)
    ]
    root, delay = shared_dir(spark, "states"), 100
    frames = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "timestamp_millis(ms) AS ts").drop("ms")
    # The last file moves the watermark past all commands.
    end = spark.createDataFrame([(99, 999, "PAUSE", 2_000_000)], SCHEMA).selectExpr("*", "timestamp_millis(ms) AS ts").drop("ms")
    for part in range(parts + 1):
        mine = frames.where(f"seq * {parts} div 300 = {part}") if part < parts else end
        mine.coalesce(1).write.mode("append").parquet(f"{root}/in")
        fed = spark.readStream.schema(frames.schema).parquet(f"{root}/in")
        ingest.run_to_end(drain.write_drains(states.state_stream(fed, f"{delay} milliseconds"), f"{root}/out", f"{root}/c"))
    got = spark.read.parquet(f"{root}/out").where("connectorId < 99").select(COLUMNS).collect()
    expected = control.state_timeline(frames).select(COLUMNS).collect()
    assert len(got) == 300 and sorted(map(str, got)) == sorted(map(str, expected))
    assert {r["state"] for r in got} == {"Running", "Paused", "Draining", "Stopped"}


def test_a_hot_connector_is_spread_over_tasks_and_equals_a_fold(spark):
    """Repeated commands, a connector without a number and states carried over micro-batches included."""

    def after(state, command):
        if state == "Stopped" or command == "GRACEFUL_STOP":
            return "Stopped"
        if state == "Draining":
            return "Stopped" if command == "COMPLETE_DRAIN" else state
        return {"DRAIN": "Draining", "PAUSE": "Paused", "RESUME": "Running"}.get(command, state)

    draw, rows = random.Random(9), []
    for seq in range(400):
        command = draw.choices(COMMANDS, [20, 20, 0.3, 1, 0.3, 0, 5])[0]
        rows += [(draw.choice([1, 1, 1, 2, None]), seq, command, 1_000_000 + seq * 3)] * draw.choice([1, 1, 2])
    expected, now = [], {}
    for connector, seq, command, _ in rows:
        before, asked = now.get(connector, ("Running", False))
        state, asked = after(before, command), asked or command in ("REQUEST_STOP", "GRACEFUL_STOP")
        now[connector] = state, asked
        expected.append((connector, seq, command, before, state, state != before, asked))
    root = shared_dir(spark, "states")
    # As for tables that are not small.
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for part in range(2):
            mine = rows[part * len(rows) // 2 : (part + 1) * len(rows) // 2]
            df = spark.createDataFrame(mine, SCHEMA).selectExpr("*", "timestamp_millis(ms) AS ts").drop("ms")
            df.coalesce(1).write.mode("append").parquet(f"{root}/in")
            fed = spark.readStream.schema(df.schema).parquet(f"{root}/in")
            ingest.run_to_end(drain.write_drains(states.state_stream(fed, "0 seconds"), f"{root}/out", f"{root}/c"))
    finally:
        for name in settings:
            spark.conf.unset(name)
    got = [tuple(r) for r in spark.read.parquet(f"{root}/out").select(COLUMNS).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    line = spark.read.parquet(f"{root}/c/passed/batch=1/line").where("connectorId = 1")
    assert line.select(F.input_file_name()).distinct().count() > 2

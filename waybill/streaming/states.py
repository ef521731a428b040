"""Connector states over a stream: what ``operators.control.state_timeline`` gives for a whole log.

A connector's state is a word and a flag, so its history is never read again: a micro-batch starts from the states that its
predecessor left. Commands that the watermark has not passed wait, and are applied in (time, seq) order once it has: files
may land out of order within the watermark's delay. No task folds a whole connector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.operators.control import timeline
from waybill.streaming.passed import Keep, Passed, delay_ms

OUTPUT = (
    "connectorId bigint, seq bigint, command string, ms bigint, stateBefore string, state string, changed boolean, "
    "stopRequested boolean"
)
_CARRY = {"states": "connectorId bigint, state string, stopRequested boolean"}
_PLACE = ["ms", "seq", "command", "copy"]


def _step(ready: DataFrame, carried: dict[str, DataFrame], watermark: int, keep: Keep) -> tuple[DataFrame, dict[str, DataFrame]]:
    # Copies of a command follow each other, so only the first may change the state.
    fresh = ready.groupBy("connectorId", "ms", "seq", "command").agg(F.count("*").cast("int").alias("_n"))
    fresh = fresh.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n")
    # A state is led to by these commands, ahead of all others.
    paths = {"Running": ["RESUME"], "Paused": ["PAUSE"], "Draining": ["DRAIN"], "Stopped": ["DRAIN", "COMPLETE_DRAIN"]}
    path = F.create_map(*[x for k, v in paths.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    flag = F.when(F.col("stopRequested"), F.array(F.lit("REQUEST_STOP"))).otherwise(F.array().cast("array<string>"))
    old = carried["states"].select("connectorId", F.posexplode(F.concat(path[F.col("state")], flag)).alias("seq", "command"))
    old = old.withColumns({"seq": F.col("seq").cast("bigint"), "ms": F.lit(-1).cast("bigint"), "copy": F.lit(0)})
    rows = fresh.unionByName(old).withColumn("_key", F.coalesce(F.col("connectorId").cast("string"), F.lit("")))
    line = keep(timeline(rows, "_key", _PLACE), "line")
    names = [f.split()[0] for f in OUTPUT.split(", ")]
    last = line.groupBy("connectorId").agg(F.max_by(F.struct("state", "stopRequested"), F.struct(*_PLACE)).alias("_last"))
    return line.where("ms >= 0").select(names), {"states": last.select("connectorId", "_last.*")}


def state_stream(commands: DataFrame, delay: str) -> Passed:
    """State before and after every command of a stream (connectorId, seq, ts, command) that the watermark has passed, to
    be written by ``passed.write_passed``.

    A command that lands later than ``delay`` after a younger one is dropped, as its place in the order is gone. The
    states of all connectors are written anew with every micro-batch.
    """
    rows = commands.select("connectorId", "seq", "command", "ts", F.unix_millis("ts").alias("ms"))
    return Passed(rows, delay_ms(commands.sparkSession, delay), _step, _CARRY)

"""Operational logs: connector states, pauses, messages in flight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.operators.joins import salted_join
from waybill.operators.ordered import previous_value


def state_timeline(commands: DataFrame) -> DataFrame:
    """State before and after every command of a log (connectorId, seq, ts, command).

    Commands: PAUSE, RESUME, DRAIN, COMPLETE_DRAIN, REQUEST_STOP, GRACEFUL_STOP. A connector starts
    Running; one that does not apply changes nothing. Draining and Stopped are never left the other
    way, so their begin is an aggregate; before that only the last PAUSE or RESUME counts. No task
    ever folds a whole connector.
    """
    timed = commands.withColumn("_ms", F.unix_millis("ts"))
    return timeline(timed, "connectorId", ["_ms", "seq"]).drop("_ms")


def timeline(commands: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``state_timeline`` of the connectors named by ``key``, which is never null, with the commands in ``order``."""
    here = F.struct(*order)
    command = F.col("command")
    begins = commands.groupBy(key).agg(
        F.min(F.when(command == "DRAIN", here)).alias("_drain"),
        F.min(F.when(command == "GRACEFUL_STOP", here)).alias("_graceful"),
        F.min(F.when(command.isin("REQUEST_STOP", "GRACEFUL_STOP"), here)).alias("_asked"),
    )
    completions = commands.filter(command == "COMPLETE_DRAIN").select(key, *order)
    completed = (
        salted_join(completions, begins.select(key, "_drain"), [key])
        .filter(here > F.col("_drain"))
        .groupBy(key)
        .agg(F.min(here).alias("_complete"))
    )
    bounds = (
        begins.join(completed, key, "left")
        .withColumn("_stop", F.least("_graceful", "_complete"))
        .select(key, "_drain", "_stop", "_asked")
    )
    switch = F.when(command.isin("PAUSE", "RESUME"), command)
    rows = previous_value(commands, key, order, switch, "_switch", per_key=bounds)
    before = (
        F.when(here > F.col("_stop"), "Stopped")
        .when(here > F.col("_drain"), "Draining")
        .when(F.col("_switch") == "PAUSE", "Paused")
        .otherwise("Running")
    )
    after = (
        F.when(here >= F.col("_stop"), "Stopped")
        .when(here >= F.col("_drain"), "Draining")
        .when(command == "PAUSE", "Paused")
        .when(command == "RESUME", "Running")
        .otherwise(F.col("stateBefore"))
    )
    return (
        rows.withColumn("stateBefore", before)
        .withColumn("state", after)
        .withColumn("changed", F.col("state") != F.col("stateBefore"))
        .withColumn("stopRequested", F.coalesce(here >= F.col("_asked"), F.lit(False)))
        .drop("_switch", "_drain", "_stop", "_asked")
    )


def pause_durations(timeline: DataFrame) -> DataFrame:
    """Paused time per connector, counted when a pause is resumed.

    Effective pauses and resumes alternate, so the total is a difference of sums; a pause that was
    never resumed is taken out again.
    """
    ms = F.unix_millis("ts").cast("decimal(20,0)")
    paused = F.col("changed") & (F.col("state") == "Paused")
    resumed = F.col("changed") & (F.col("stateBefore") == "Paused") & (F.col("state") == "Running")
    sums = timeline.groupBy("connectorId").agg(
        F.coalesce(F.sum(F.when(paused, ms)), F.lit(0)).alias("_from"),
        F.coalesce(F.sum(F.when(resumed, ms)), F.lit(0)).alias("_to"),
        F.count_if(paused).alias("_pauses"),
        F.count_if(resumed).alias("resumes"),
        F.max(F.when(paused, ms)).alias("_open"),
    )
    dangling = F.when(F.col("_pauses") > F.col("resumes"), F.col("_open")).otherwise(F.lit(0))
    total = (F.col("_to") - (F.col("_from") - dangling)).cast("bigint")
    return sums.select("connectorId", "resumes", total.alias("totalPauseDurationMs"))


def in_flight(tracking: DataFrame) -> DataFrame:
    """Messages still in flight per queue, from a log (queueName, messageIdHex, action, ts, seq).

    A message is in flight when the last thing said about it is TRACK; tracking it twice counts once.
    """
    last = tracking.groupBy("queueName", "messageIdHex").agg(F.max_by("action", F.struct("ts", "seq")).alias("_last"))
    return (
        last.groupBy("queueName")
        .agg(F.count_if(F.col("_last") == "TRACK").alias("inFlight"))
        .withColumn("drained", F.col("inFlight") == 0)
    )

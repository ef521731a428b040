"""Waiting for a queue to drain, with a timeout, over a stream.

What a micro-batch carries on are the messages in flight and the drain requests that wait. Rows count in (time, seq) order
once the watermark has passed them, so files may land out of order within the watermark's delay. A queue is laid out in
even slices of its order and only the slices' totals are chained, so one that holds most rows stays parallel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill.operators.ordered import previous_value
from waybill.streaming.passed import Keep, Passed, delay_ms, write_passed

OUTPUT = "queueName string, seq bigint, requestedMs bigint, timeoutMs bigint, outcome string, decidedMs bigint, inFlight bigint"
#: Messages in flight and waiting requests; ``queue`` is the name behind a "=", or empty for null.
_CARRY = {"flying": "queue string, message string", "open": "queue string, seq bigint, asked bigint, timeout bigint"}
#: Place of a row within its queue: what is carried on comes first, a request's end behind all rows of its time.
_PLACE = ["turn", "ms", "ends", "seq", "action"]


def _step(ready: DataFrame, carried: dict[str, DataFrame], watermark: int, keep: Keep) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Requests decided up to ``watermark``, and what is in flight and waiting after it."""
    rows = ready.select(
        F.coalesce(F.concat(F.lit("="), "queueName"), F.lit("")).alias("queue"),
        F.coalesce("messageIdHex", F.lit("")).alias("message"), "action", F.lit(1).alias("turn"), "ms", "seq",
        F.greatest(F.coalesce("timeoutMs", F.lit(0)), F.lit(0)).cast("bigint").alias("timeout"),
    )
    none = F.lit(None).cast("bigint")
    key = F.struct("queue", "message").alias("key")
    place = ["turn", "ms", "seq", "action"]
    fresh = rows.where(F.col("action").isin("TRACK", "COMPLETE")).select(key, *place)
    flying = carried["flying"].select(key, F.lit(0).alias("turn"), F.lit(-1).alias("ms"), none.alias("seq"), F.lit("TRACK").alias("action"))
    moves = fresh.unionByName(flying)
    told = previous_value(moves, "key", place, F.col("action"), "before")
    was_there = F.coalesce(F.col("before") == "TRACK", F.lit(False))
    delta = F.when((F.col("action") == "TRACK") & ~was_there, 1).when((F.col("action") == "COMPLETE") & was_there, -1).otherwise(0)

    asked = rows.where("action = 'DRAIN'").select("queue", "turn", "seq", F.col("ms").alias("asked"), "timeout")
    asked = asked.unionByName(carried["open"].withColumn("turn", F.lit(0)))
    deadline = F.col("asked") + F.col("timeout")
    request = ["queue", "from", "seq", "asked", "timeout"]

    def laid(df: DataFrame, turn: Column, ms: Column, action: str) -> DataFrame:
        return df.select(
            "queue", turn.alias("turn"), ms.alias("ms"), F.lit(int(action == "END")).alias("ends"), "seq",
            F.lit(action).alias("action"), F.lit(0).alias("delta"), F.col("turn").alias("from"), "asked", "timeout",
        )

    counted = told.select(
        "key.queue", "turn", "ms", F.lit(0).alias("ends"), "seq", "action", delta.alias("delta"),
        F.lit(None).cast("int").alias("from"), none.alias("asked"), none.alias("timeout"),
    )
    ends = laid(asked.where(deadline < watermark), F.lit(1), deadline, "END")
    log = counted.unionByName(laid(asked, F.col("turn"), F.col("asked"), "DRAIN")).unionByName(ends)
    sliced = keep(log.repartitionByRange("queue", *_PLACE).withColumn("slice", F.spark_partition_id()), "slices")
    judged = keep(_judge(sliced, request, keep), "judged")

    outcome = F.when(F.col("empty") <= deadline, "DRAINED").when(deadline < watermark, "TIMED_OUT")
    judged = judged.withColumn("outcome", outcome)
    each = judged.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("n"))))
    drained = F.col("outcome") == "DRAINED"
    results = each.where("outcome IS NOT NULL").select(
        F.when(F.col("queue") != "", F.expr("substring(queue, 2)")).alias("queueName"), "seq",
        F.col("asked").alias("requestedMs"), F.col("timeout").alias("timeoutMs"), "outcome",
        F.when(drained, F.col("empty")).otherwise(deadline).alias("decidedMs"),
        F.when(drained, F.lit(0)).otherwise(F.col("inFlight")).cast("bigint").alias("inFlight"),
    )
    last = moves.groupBy("key").agg(F.max_by("action", F.struct(*place)).alias("last"))
    return results, {
        "flying": last.where("last = 'TRACK'").select("key.*"),
        "open": each.where("outcome IS NULL").select("queue", "seq", "asked", "timeout"),
    }


def _judge(sliced: DataFrame, request: list[str], keep: Keep) -> DataFrame:
    """Per request ``n`` (how often it is made), ``empty`` (the first time from it on with nothing in flight) and
    ``inFlight`` (what is in flight at its end)."""
    by_slice = Window.partitionBy("queue").orderBy("slice")
    totals = sliced.groupBy("queue", "slice").agg(F.sum("delta").alias("total"))
    start = F.coalesce(F.sum("total").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = Window.partitionBy("queue", "slice").orderBy(*_PLACE)
    counted = sliced.join(totals.select("queue", "slice", start.alias("start")), ["queue", "slice"]).withColumn(
        "flying", F.col("start") + F.sum("delta").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    # From a row to the end of its slice; the same window turned round keeps the frame a running one.
    turned = Window.partitionBy("queue", "slice").orderBy(*[F.desc(c) for c in _PLACE])
    is_empty = (F.col("flying") == 0) & (F.col("ends") == 0)
    counted = counted.withColumn("first", F.row_number().over(inside) == 1).withColumn(
        "empty", F.min(F.when(is_empty, F.col("ms"))).over(turned.rangeBetween(Window.unboundedPreceding, 0))
    )
    told = keep(counted.where("first OR action IN ('DRAIN', 'END')"), "told")
    firsts = told.where("first").select("queue", "slice", "empty")
    following = Window.partitionBy("queue").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    nexts = firsts.select("queue", "slice", F.last("empty", ignorenulls=True).over(following).alias("next"))
    made = F.col("action") == "DRAIN"
    return (
        told.where("action IN ('DRAIN', 'END')")
        .join(nexts, ["queue", "slice"])
        .groupBy(*request)
        .agg(
            F.count_if(made).alias("n"),
            F.min(F.when(made, F.coalesce("empty", "next"))).alias("empty"),
            F.max(F.when(~made, F.col("flying"))).alias("inFlight"),
        )
    )


def drain_results(tracking: DataFrame, delay: str) -> Passed:
    """``queueName, seq, requestedMs, timeoutMs, outcome, decidedMs, inFlight``: a row for every decided drain request,
    to be written by ``write_drains``.

    ``tracking`` is a stream (queueName, messageIdHex, action, ts, seq, timeoutMs) of TRACK, COMPLETE and DRAIN rows.
    A request is DRAINED at the first moment, from its own on, when nothing is in flight; TIMED_OUT if that is not so
    within ``timeoutMs``, the last millisecond included. Tracking a message twice counts once, completing one that is
    not in flight changes nothing. Messages in flight are written anew with every micro-batch, so batches should not
    be much smaller than what is in flight.
    """
    rows = tracking.select(
        "queueName", "messageIdHex", "action", "ts", F.unix_millis("ts").alias("ms"), "seq",
        F.col("timeoutMs").cast("bigint").alias("timeoutMs"),
    )
    return Passed(rows, delay_ms(tracking.sparkSession, delay), _step, _CARRY)


def write_drains(results: Passed, path: str, checkpoint: str) -> StreamingQuery:
    """Write the rows of each micro-batch under its id."""
    return write_passed(results, path, checkpoint)

"""Drain requests over a stream equal a loop over the log, also across restarts."""

import random

import pytest

from waybill.session import shared_dir
from waybill.streaming import drain, ingest

SCHEMA = "queueName string, messageIdHex string, action string, ms bigint, seq bigint, timeoutMs bigint"


def loop(rows, end):
    """Decisions up to ``end``, row by row, millisecond by millisecond."""
    decided = []
    for queue in {r[0] for r in rows}:
        flying, waiting = set(), []
        for _, message, action, ms, seq, timeout in sorted((r for r in rows if r[0] == queue), key=lambda r: (r[3], r[4])):
            for w in sorted(w for w in waiting if w[1] + w[2] < ms):
                decided.append((queue, w[0], "TIMED_OUT", w[1] + w[2], len(flying)))
                waiting.remove(w)
            if action == "TRACK":
                flying.add(message)
            elif action == "COMPLETE":
                flying.discard(message)
            else:
                waiting.append((seq, ms, timeout or 0))
            if not flying:
                decided += [(queue, w[0], "DRAINED", ms, 0) for w in waiting]
                waiting = []
        decided += [(queue, w[0], "TIMED_OUT", w[1] + w[2], len(flying)) for w in waiting if w[1] + w[2] < end]
    return sorted(decided)


@pytest.mark.parametrize("parts", [1, 4])
def test_stream_equals_loop_across_restarts(spark, parts):
    draw, rows = random.Random(parts), []
    for seq in range(400):
        action = draw.choices(["TRACK", "COMPLETE", "DRAIN"], [5, 6, 1])[0]
        timeout = draw.choice([0, 3, 20, 200, None]) if action == "DRAIN" else None
        message = f"m{draw.randrange(3)}" if action != "DRAIN" else None
        rows.append((draw.choice("AB"), message, action, 1_000_000 + seq * 2 + draw.randrange(2), seq, timeout))
    rows.append(("END", "m", "TRACK", 1_100_000, 999, None))
    root = shared_dir(spark, "drain")
    # Neighbours may land in the other order within a part.
    for part in range(parts):
        mine = rows[part * len(rows) // parts : (part + 1) * len(rows) // parts]
        draw.shuffle(mine)
        df = spark.createDataFrame(mine, SCHEMA).selectExpr("*", "timestamp_millis(ms) AS ts").drop("ms")
        df.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
        ingest.run_to_end(drain.write_drains(drain.drain_results(stream, "0 seconds"), f"{root}/out", f"{root}/c"))
    got = spark.read.parquet(f"{root}/out").collect()
    assert sorted((r["queueName"], r["seq"], r["outcome"], r["decidedMs"], r["inFlight"]) for r in got) == loop(rows, 1_100_000)
    assert {r["outcome"] for r in got} == {"DRAINED", "TIMED_OUT"} and len(got) > 20


def test_a_hot_queue_is_laid_out_in_slices_and_equals_the_loop(spark):
    """Rows that are repeated, and a queue without a name, included."""
    draw, rows = random.Random(7), []
    for seq in range(600):
        action = draw.choices(["TRACK", "COMPLETE", "DRAIN"], [5, 6, 1])[0]
        timeout = draw.choice([0, 5, 40, 400]) if action == "DRAIN" else None
        message = f"m{draw.randrange(3)}" if action != "DRAIN" else None
        row = (draw.choice(["HOT", "HOT", None]), message, action, 1_000_000 + seq * 2, seq, timeout)
        rows += [row] * draw.choice([1, 1, 2])
    rows.append(("END", "m", "TRACK", 1_100_000, 999, None))
    root = shared_dir(spark, "drain")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for part in range(2):
            mine = rows[part * len(rows) // 2 : (part + 1) * len(rows) // 2]
            df = spark.createDataFrame(mine, SCHEMA).selectExpr("*", "timestamp_millis(ms) AS ts").drop("ms")
            df.coalesce(1).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
            ingest.run_to_end(drain.write_drains(drain.drain_results(stream, "0 seconds"), f"{root}/out", f"{root}/c"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = spark.read.parquet(f"{root}/out").collect()
    named = [("" if r[0] is None else r[0], *r[1:]) for r in rows]
    found = sorted((r["queueName"] or "", r["seq"], r["outcome"], r["decidedMs"], r["inFlight"]) for r in got)
    assert found == loop(named, 1_100_000) and len(found) > 40
    slices = spark.read.parquet(f"{root}/c/passed/batch=1/slices").where("queue = '=HOT'")
    assert slices.select("slice").distinct().count() > 2

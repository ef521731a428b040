"""Operators against exact cases and plain Python folds."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from waybill import schema
from waybill.functions import sizes
from waybill.operators import checkpoints, chunks, claim, control, delivery, metrics, offload, ordered, progress, recovery
from waybill.operators import queue_config as config
from waybill.operators import throttle as buckets
from waybill.operators.joins import salted_join
from waybill.session import shared_dir
from waybill.sources import messages as tables

NO_LOG = "queueName string, messageIdHex string, outcome string"


def ids(df, column="messageIdHex"):
    return sorted(int(r[column], 16) for r in df.select(column).collect())


# Claims and the delivery log


def test_claim_takes_the_oldest(spark, messages):
    df = messages(*[{"ms": 1000 - i} for i in range(5)])
    batch = claim.claim_batch(df, spark.createDataFrame([], NO_LOG), ["TEST.QUEUE"], 3)
    assert ids(batch) == [3, 4, 5]
    assert [r["position"] for r in batch.orderBy("timestamp").collect()] == [1, 2, 3]


def test_claim_of_an_empty_queue(spark, messages):
    assert claim.claim_batch(messages({}), spark.createDataFrame([], NO_LOG), ["OTHER"], 3).count() == 0


def test_claim_skips_committed_but_not_rolled_back(spark, messages):
    df = messages({}, {}, {})
    key = [r["messageIdHex"] for r in df.orderBy("messageIdHex").collect()]
    log = spark.createDataFrame([("TEST.QUEUE", key[0], "COMMIT"), ("TEST.QUEUE", key[1], "ROLLBACK")], NO_LOG)
    assert ids(claim.claim_batch(df, log, ["TEST.QUEUE"])) == [2, 3]


def test_claim_of_what_landed_since_is_the_same(spark, messages):
    """Late and undated messages are claimed, whatever the put times and the log's clock say."""
    df = messages(*[{"ms": 1000 + i // 2} for i in range(9)], {"ms": 1}, {})
    number = F.conv(F.right("messageIdHex", F.lit(2)), 16, 10).cast("int")
    df = df.withColumn("load", F.when(number <= 6, 0).otherwise(1))
    df = df.withColumn("timestamp", F.when(number < 11, F.col("timestamp")))
    log = delivery.settle(df.filter("load = 0"), 1, "COMMIT", F.timestamp_millis(F.lit(0)))
    until = claim.settled_until(df, log, "load")
    assert until == 1
    args = df, log, ["TEST.QUEUE"], 9
    assert ids(claim.claim_batch(*args, landed=F.col("load") >= until)) == ids(claim.claim_batch(*args)) == [7, 8, 9, 10, 11]
    assert claim.settled_until(df, delivery.settle(df, 1, "COMMIT", F.col("timestamp")), "load") is None


def test_consumers_share_a_log(spark, messages):
    df, path = messages({}, {}), shared_dir(spark, "test-log")
    for consumer in ("a", "b", "b"):
        delivery.append_log(delivery.settle(df, 0, "COMMIT", F.current_timestamp(), consumer=consumer), path)
    log = delivery.read_log(spark, path)
    assert {r["consumer"]: r["count"] for r in log.groupBy("consumer").count().collect()} == {"a": 2, "b": 2}
    assert delivery.next_try(log, 0, "a") == 1


def test_claim_size_must_be_positive(spark, messages):
    with pytest.raises(ValueError):
        claim.claim_batch(messages({}), spark.createDataFrame([], NO_LOG), ["A"], 0)


def test_claim_commit_claim_walks_the_queue(spark, messages):
    df, path = messages(*[{} for _ in range(5)]), shared_dir(spark, "test-log")
    delivery.init_log(spark, path)
    seen = []
    for batch_id in range(4):
        batch = claim.claim_batch(df, delivery.read_log(spark, path), ["TEST.QUEUE"], 2)
        for _ in range(2):  # a replayed commit must neither repeat rows nor take the next batch
            delivery.append_log(delivery.settle(batch, batch_id, "COMMIT", F.current_timestamp()), path)
        seen.append(ids(batch))
    assert seen == [[1, 2], [3, 4], [5], []]
    assert delivery.read_log(spark, path).count() == 5


def test_rollback_raises_the_redelivery_count(spark, messages):
    df, path = messages({"backout": 1}, {}), shared_dir(spark, "test-log")
    delivery.init_log(spark, path)
    for expected in ([1, 0], [2, 1], [3, 2]):
        tried = delivery.with_redelivery_count(df, delivery.read_log(spark, path))
        assert [r["backoutCount"] for r in tried.orderBy("messageIdHex").collect()] == expected
        again = delivery.next_try(delivery.read_log(spark, path), 9)
        delivery.append_log(delivery.settle(tried, 9, "ROLLBACK", F.current_timestamp(), again), path)


def test_browse_counts_and_leaves_unread(spark, messages):
    df, log = messages({}, {}, {}), spark.createDataFrame([], NO_LOG)
    counter = Observation("browse")
    assert claim.browse_batch(df, log, ["TEST.QUEUE"], 2, counter).count() == 2
    assert counter.get == {"totalBrowsed": 2}
    assert ids(claim.browse_batch(df, log, ["TEST.QUEUE"], 2)) == [1, 2]


def test_configured_claim(spark, messages):
    df = messages(*[{"queue": q} for q in "AAABBBCCC"])
    settings = config.queue_config(
        spark,
        {"queueName": "A", "batchSize": 1},
        {"queueName": "B", "batchSize": 2},
        {"queueName": "C", "enabled": False},
    )
    batch = claim.claim_configured(df, spark.createDataFrame([], NO_LOG), settings)
    assert ids(batch) == [1, 4, 5]
    off = settings.withColumn("enabled", F.lit(False))
    assert claim.claim_configured(df, spark.createDataFrame([], NO_LOG), off).count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark, messages):
    df = messages(*[{} for _ in range(50)])
    log = delivery.settle(df.filter("ccsid = 1208"), 1, "COMMIT", F.col("receivedAt"))
    for table, data in (("bucketed_messages", df), ("bucketed_log", log)):
        tables.save_bucketed(data, table, shared_dir(spark, table), 4, mode="overwrite")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = claim.unread(spark.table("bucketed_messages"), spark.table("bucketed_log"))
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
        assert plan.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_messages")
        spark.sql("DROP TABLE bucketed_log")


def test_message_table_prunes_queues_and_columns(spark, messages):
    path = shared_dir(spark, "test-table")
    tables.write_messages(messages(*[{"queue": q} for q in "ABC"]), path)
    one = tables.read_messages(spark, path, ["B"])
    assert ids(one) == [2]
    plan = one.select("messageIdHex", "priority")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [queueName" in plan.replace("isnotnull(", "") or "queueName" in plan.split("PartitionFilters")[1]
    assert "payload" not in plan.split("ReadSchema")[1]
    counted = metrics.queue_metrics(messages=tables.read_messages(spark, path))
    schema_read = counted._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert "payloadSize" in schema_read and "payload:" not in schema_read


# Schema


def test_projection_fills_defaults_and_nulls(spark):
    df = spark.createDataFrame([(b"\x01", b"hi", "  ", " MQSTR ")], "messageId binary, payload binary, replyToQueue string, format string")
    row = schema.project(df).first()
    assert (row["payloadString"], row["replyToQueue"], row["format"]) == ("hi", None, "MQSTR")
    assert (row["ccsid"], row["expiry"], row["messageType"], row["messageSequenceNumber"]) == (1208, -1, 8, 1)
    assert row["timestamp"] is None and row["groupId"] is None
    assert schema.project(df).columns == schema.CANONICAL.fieldNames() and len(schema.CANONICAL) == 21


# Queue configuration


def test_config_replacement_and_violations(spark):
    base = config.from_names(spark, "A", "B")
    changed = config.with_queues(base, config.queue_config(spark, {"queueName": "B", "batchSize": 7}, {"queueName": "C"}))
    assert {r["queueName"]: r["batchSize"] for r in changed.collect()} == {"A": 1000, "B": 7, "C": 1000}
    bad = config.queue_config(
        spark,
        {"queueName": "A"},
        {"queueName": "A", "batchSize": 0},
        {"queueName": "", "pollTimeoutMs": 0, "throttleMessagesPerSecond": 0},
    )
    assert sorted(r["violation"] for r in config.config_violations(bad).collect()) == [
        ": pollTimeoutMs must be positive",
        ": queueName is required",
        ": throttleMessagesPerSecond must be positive",
        "A: batchSize must be positive",
        "duplicate queue names found: A",
    ]
    assert config.config_violations(base).count() == 0


# Progress


def test_next_marker_and_json(spark):
    start = spark.createDataFrame(
        [(5, 500, 100, 0, ["x"])],
        "batchId bigint, processedCount bigint, lastBatchCount bigint, lastBatchTimestamp bigint, lastMessageIds array<string>",
    )
    after = progress.next_marker(start, 50, 7, [str(i) for i in range(20)])
    row = after.first()
    assert (row["batchId"], row["processedCount"], row["lastBatchCount"]) == (6, 550, 50)
    assert row["lastMessageIds"] == [str(i) for i in range(10)]
    back = after.select(progress.marker_from_json(progress.marker_json()).alias("m")).select("m.*").first()
    assert back == row
    old = spark.range(1).select(progress.marker_from_json(F.lit('{"batchId":3}')).alias("m")).first()["m"]
    assert (old["batchId"], old["processedCount"], old["lastMessageIds"]) == (3, 0, [])


def test_running_total_over_many_ranges(spark):
    values = [random.Random(1).randrange(100) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "pos bigint, v bigint").repartition(7)
    got = [r["t"] for r in ordered.running_total(df, "v", "pos", 16, "t").orderBy("pos").collect()]
    assert got == [sum(values[: i + 1]) for i in range(500)]


# Hot keys


def test_first_n_of_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        F.xxhash64("id").alias("o"),
    )
    df = df.repartition(40)
    got = ordered.first_n(df, ["k"], ["o"], 5)
    expected = df.toPandas().sort_values("o").groupby("k").head(5)
    assert sorted((r["k"], r["o"]) for r in got.collect()) == sorted(map(tuple, expected.to_numpy().tolist()))
    assert {r["position"] for r in got.filter("k = 'hot'").collect()} == {1, 2, 3, 4, 5}


def test_salted_join_of_a_hot_key(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 7).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k bigint, v string")
    for how in ("inner", "left"):
        plain, salted = left.join(right, ["k"], how), salted_join(left, right, ["k"], how)
        assert sorted(map(str, plain.collect())) == sorted(map(str, salted.select(*plain.columns).collect()))


def test_deduplicate_keeps_the_first_of_a_hot_id(spark):
    df = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("messageIdHex"), F.col("id").alias("o")
    )
    once = recovery.deduplicate(df.repartition(20), ["o"])
    assert once.count() == df.select("messageIdHex").distinct().count()
    assert once.filter("messageIdHex = 'hot'").first()["o"] == 0


# Poison messages and routing


def test_poison_and_quarantine(spark, messages):
    df = messages(*[{"backout": b} for b in (0, 2, 3, 5)])
    count = F.col("backoutCount")
    assert [r[0] for r in df.select(recovery.is_poison(count, 3)).collect()] == [False, False, True, True]
    assert [r[0] for r in df.select(recovery.remaining_retries(count, 5)).collect()] == [5, 3, 2, 0]
    told = df.filter("backoutCount = 5").select(recovery.quarantine_decision(3, custom_queue="MY.Q").alias("d")).first()["d"]
    assert (told["action"], told["description"]) == ("CustomQueue", "Move to custom queue: MY.Q")
    assert told["reason"] == "Message exceeded backout threshold: 5 >= 3"
    assert int(told["messageId"], 16) == 4


def test_route(spark, messages):
    df = messages(*[{"backout": 9} for _ in range(4)], {"backout": 0})
    picks = {1: "MoveToDeadLetter", 2: "MoveToBackout", 3: "Discard", 4: "MY.Q", 5: "Discard"}
    action = F.element_at(
        F.create_map(*[F.lit(x) for e in picks.items() for x in e]), F.conv("messageIdHex", 16, 10).cast("int")
    )
    routed = recovery.route(df, 3, action).orderBy("messageIdHex")
    assert [r["targetQueue"] for r in routed.collect()] == ["DEAD.LETTER", "BACKOUT", None, "MY.Q", "TEST.QUEUE"]


# Chunks and offload


def test_chunk_sizes(messages):
    df = messages({"payload": b"a" * 250}, {"payload": b""}, {"payload": b"b" * 100})
    rows = chunks.chunk_payloads(df, 100).orderBy("messageIdHex", "chunkIndex").collect()
    assert [(int(r["messageIdHex"], 16), r["chunkIndex"], len(r["chunk"])) for r in rows] == [
        (1, 0, 100), (1, 1, 100), (1, 2, 50), (3, 0, 100),
    ]


def test_chunk_reduction(messages):
    df = messages({"payload": b"a" * 250}, {"payload": b""})
    size = lambda c: F.octet_length(c)
    total = chunks.reduce_payload(F.col("payload"), size, lambda a, b: a + b, 100)
    widest = chunks.reduce_payload(F.col("payload"), size, F.greatest, 100)
    assert [tuple(r) for r in df.orderBy("messageIdHex").select(total, widest).collect()] == [(250, 100), (None, None)]


def test_offload_is_lossless(spark, messages):
    df, path = messages({"payload": b"a" * 50}, {"payload": b"b" * 500}, {"payload": b"c" * 5000}), shared_dir(spark, "test-off")
    planned = offload.plan_offload(df, sizes.SizeProfile(1000, 100, True, 200), path)
    offload.write_offloaded(planned, path, 0)
    assert [r["decision"]["action"] for r in planned.orderBy("messageIdHex").collect()] == ["Process", "Offloaded", "Reject"]
    stored = spark.read.parquet(path)
    assert [bytes(r["payload"]) for r in stored.collect()] == [b"b" * 500]
    kept = offload.slim(planned).orderBy("messageIdHex").collect()
    assert [r["payload"] is None for r in kept] == [False, True, False]
    assert kept[1]["payloadRef"] == stored.first()["payloadRef"]
    more = offload.plan_offload(messages({"payload": b"d" * 600}), sizes.SizeProfile(1000, 100, True, 200), path)
    offload.write_offloaded(more, path, 1)
    offload.write_offloaded(more, path, 1)
    store = offload.read_offloaded(spark, path)
    for part in (planned, more):
        back = offload.restore(offload.slim(part), store)
        assert sorted(bytes(r["payload"]) for r in back.collect()) == sorted(bytes(r["payload"]) for r in part.collect())


def test_rows_without_a_reference_do_not_meet_in_one_task(spark, messages):
    path = shared_dir(spark, "test-off")
    df = messages(*[{"payload": b"a" * (500 if i % 10 == 0 else 50)} for i in range(80)])
    planned = offload.plan_offload(df, sizes.SizeProfile(1000, 100, True, 200), path)
    offload.write_offloaded(planned, path, 0)
    # As for tables that are not small.
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        back = offload.restore(offload.slim(planned), offload.read_offloaded(spark, path))
        tasks = back.where("payloadRef IS NULL").groupBy(F.spark_partition_id()).count().collect()
        assert sorted(bytes(r["payload"]) for r in back.collect()) == sorted(bytes(r["payload"]) for r in df.collect())
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert sum(r["count"] for r in tasks) == 72 and max(r["count"] for r in tasks) < 40


def test_routed_batches_stay(spark, messages):
    path = shared_dir(spark, "test-routed")
    for batch_id, text in ((0, "first"), (1, "second"), (1, "second")):
        df = messages({"payload": text, "backout": 9})
        recovery.write_routed(recovery.route(df, 3, F.lit("MoveToDeadLetter")), path, batch_id)
    rows = spark.read.parquet(path).filter("targetQueue = 'DEAD.LETTER'").collect()
    assert sorted(bytes(r["payload"]) for r in rows) == [b"first", b"second"]


# Checkpoints


def _checkpoint(spark, *rows):
    full = [(q, "QM", i, None, ts, 1, 2, p, 3) for q, p, i, ts in rows]
    return spark.createDataFrame(full, checkpoints._JSON_SCHEMA)


def test_checkpoint_build_skips_empty_correlation(spark, messages):
    df = messages({}, {}, {}).withColumn("partitionId", F.lit(0))
    df = df.withColumn("correlationIdHex", F.when(F.col("messageIdHex").endswith("3"), "").otherwise(F.col("messageIdHex")))
    row = checkpoints.build_checkpoints(df, "QM", F.lit(5)).first()
    assert int(row["lastMessageId"], 16) == 3 and int(row["lastCorrelationId"], 16) == 2
    assert (row["messagesProcessed"], row["bytesProcessed"]) == (3, 3)


def test_checkpoint_save_load_delete(spark):
    a, b = _checkpoint(spark, ("Q", 0, "m1", 1), ("Q", 1, "m2", 1)), _checkpoint(spark, ("Q", 0, "m3", 0))
    saves = a.withColumns({"seq": F.lit(1), "deleted": F.lit(False)}).unionByName(
        b.withColumns({"seq": F.lit(2), "deleted": F.lit(False)})
    )
    assert checkpoints.load(saves, "Q", 0).first()["lastMessageId"] == "m3"  # last save wins, not latest time
    gone = saves.unionByName(checkpoints.tombstones(b, F.lit(3)).select(*saves.columns))
    assert [r["partitionId"] for r in checkpoints.latest(gone).collect()] == [1]
    assert checkpoints.load(gone, "Q", 0).count() == 0
    path = shared_dir(spark, "test-ckpt")
    checkpoints.compact(gone, path)
    assert [r["lastMessageId"] for r in checkpoints.latest(spark.read.parquet(path)).collect()] == ["m2"]


def test_checkpoint_merge(spark):
    left = _checkpoint(spark, ("A", 0, "l", 1000), ("B", 0, "l", 5), ("C", 0, "l", 1))
    right = _checkpoint(spark, ("A", 0, "r", 2000), ("B", 0, "r", 5), ("D", 0, "r", 1))
    got = {r["queueName"]: r["lastMessageId"] for r in checkpoints.merge(left, right).collect()}
    assert got == {"A": "r", "B": "l", "C": "l", "D": "r"}


def test_checkpoint_json_defaults(spark):
    row = spark.range(1).select(checkpoints.from_json(F.lit('{"queueName":"Q","lastMessageId":null}')).alias("c")).first()["c"]
    assert (row["queueName"], row["queueManager"], row["lastMessageId"], row["partitionId"]) == ("Q", "", None, 0)


# Token buckets


def fold_bucket(times, tokens, window_ms, start=None, used=0):
    """The bucket, one message at a time."""
    granted = []
    for t in times:
        if start is None or t - start >= window_ms:
            start, used = t, 0
        granted.append(used < tokens)
        used += used < tokens
    return granted, start, used


def bucket_rows(spark, queues):
    rows = [(q, f"{i:08d}", t) for q, times in queues.items() for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "queueName string, messageIdHex string, ms bigint").repartition(6)
    return df.withColumn("timestamp", F.timestamp_millis("ms"))


def grants(df):
    return {(r["queueName"], r["messageIdHex"]): r["granted"] for r in df.collect()}


@pytest.mark.parametrize("seed, gap", [(1, 30), (2, 400), (3, 3_000_000)])
def test_throttle_equals_the_fold(spark, seed, gap):
    rng = random.Random(seed)
    queues = {}
    for q in "ABC":
        t, times = 1_700_000_000_000 + rng.randrange(5_000_000), []
        for _ in range(1500):
            t += rng.choice([0, 0, 1, rng.randrange(gap)])
            times.append(t)
        queues[q] = times
    limits = spark.createDataFrame([("A", 1), ("B", 5)], "queueName string, tokens int")
    got = grants(buckets.throttle(bucket_rows(spark, queues), limits))
    expected = {
        (q, f"{i:08d}"): g
        for q, n in (("A", 1), ("B", 5), ("C", 10**9))
        for i, g in enumerate(fold_bucket(queues[q], n, 1000)[0])
    }
    assert got == expected


def test_throttle_of_one_hot_millisecond(spark):
    limits = spark.createDataFrame([("A", 7)], "queueName string, tokens int")
    got = grants(buckets.throttle(bucket_rows(spark, {"A": [5000] * 3000 + [6000] * 10}), limits))
    assert [k[1] for k, g in sorted(got.items()) if g] == [f"{i:08d}" for i in [*range(7), *range(3000, 3007)]]


def test_throttle_continues_an_open_window(spark):
    rng = random.Random(4)
    times = sorted(rng.randrange(20_000) for _ in range(800))
    limits = spark.createDataFrame([("A", 3)], "queueName string, tokens int")
    expected, start, used = [], None, 0
    carry, got = None, {}
    for part in (times[:300], times[300:310], times[310:]):
        granted, start, used = fold_bucket(part, 3, 1000, start, used)
        expected += granted
        df = bucket_rows(spark, {"A": part})
        windows = buckets.bucket_windows(df, limits, carry=carry)
        got = {**got, **{(k[0], len(got) + int(k[1])): g for k, g in grants(buckets.throttle(df, limits, carry=carry)).items()}}
        carry = spark.createDataFrame(
            buckets.open_windows(windows, carry).collect(), "queueName string, windowStart bigint, used bigint"
        )
        assert tuple(carry.first()) == ("A", start, used)
    assert [g for _, g in sorted(got.items())] == expected


def test_bucket_of_one_per_second_and_limits(spark):
    limits = spark.createDataFrame([("A", 1)], "queueName string, tokens int")
    df = bucket_rows(spark, {"A": [0, 1, 999, 1000]})
    assert [g for _, g in sorted(grants(buckets.throttle(df, limits)).items())] == [True, False, False, True]
    assert all(grants(buckets.throttle(df, buckets.remove_limit(limits, "A"))).values())
    raised = buckets.set_limit(limits, "A", 3)
    assert sum(grants(buckets.throttle(df, raised)).values()) == 4
    rate = buckets.granted_rates(buckets.throttle(df, limits), limits).first()
    assert (rate["granted"], rate["rate"]) == (2, 2.0)
    still = bucket_rows(spark, {"A": [5]})
    assert buckets.granted_rates(buckets.throttle(still, limits), limits).first()["rate"] == 0.0


# Operational logs


def fold_states(commands):
    """The connector, one command at a time."""
    state, asked, paused_at, total, rows = "Running", False, None, 0, []
    for ms, command in commands:
        before = state
        if command == "PAUSE" and state == "Running":
            state, paused_at = "Paused", ms
        elif command == "RESUME" and state == "Paused":
            state, total = "Running", total + ms - paused_at
        elif command == "DRAIN" and state in ("Running", "Paused"):
            state = "Draining"
        elif command == "COMPLETE_DRAIN" and state == "Draining":
            state = "Stopped"
        elif command == "GRACEFUL_STOP":
            state, asked = "Stopped", True
        elif command == "REQUEST_STOP":
            asked = True
        rows.append((before, state, asked))
    return rows, total


def test_state_timeline_equals_the_fold(spark):
    rng = random.Random(5)
    logs = {}
    for c in range(40):
        t, log = rng.randrange(10_000_000), []
        for _ in range(rng.randrange(1, 120)):
            t += rng.choice([0, rng.randrange(600_000)])
            weights = (40, 40, 1, 4, 1, rng.choice([0, 1]))
            log.append((t, rng.choices(["PAUSE", "RESUME", "DRAIN", "COMPLETE_DRAIN", "REQUEST_STOP", "GRACEFUL_STOP"], weights)[0]))
        logs[c] = log
    rows = [(c, i, ms, cmd) for c, log in logs.items() for i, (ms, cmd) in enumerate(log)]
    df = spark.createDataFrame(rows, "connectorId int, seq int, ms bigint, command string").repartition(5)
    line = control.state_timeline(df.withColumn("ts", F.timestamp_millis("ms")))
    got = {(r["connectorId"], r["seq"]): (r["stateBefore"], r["state"], r["stopRequested"]) for r in line.collect()}
    folded = {c: fold_states(log) for c, log in logs.items()}
    assert got == {(c, i): row for c, (states, _) in folded.items() for i, row in enumerate(states)}
    pauses = {r["connectorId"]: r["totalPauseDurationMs"] for r in control.pause_durations(line).collect()}
    assert pauses == {c: total for c, (_, total) in folded.items()}
    assert any(pauses.values()) and {s[1] for s in got.values()} == {"Running", "Paused", "Draining", "Stopped"}


def test_state_timeline_of_one_hot_connector_at_one_time(spark):
    rng = random.Random(6)
    log = [(5, rng.choice(["PAUSE", "RESUME", "REQUEST_STOP", "REQUEST_STOP"])) for _ in range(20_000)]
    rows = [(7, i, ms, cmd) for i, (ms, cmd) in enumerate(log)] + [(c, 0, 1, "PAUSE") for c in range(3)]
    df = spark.createDataFrame(rows, "connectorId int, seq int, ms bigint, command string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        line = control.state_timeline(df.withColumn("ts", F.timestamp_millis("ms")))
        got = {r["seq"]: (r["stateBefore"], r["state"]) for r in line.filter("connectorId = 7").collect()}
        sliced = ordered.materialize(df.repartitionByRange("connectorId", "ms", "seq").withColumn("s", F.spark_partition_id()), "t")
        assert sliced.filter("connectorId = 7").select("s").distinct().count() > 4  # no task had it all
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {i: s[:2] for i, s in enumerate(fold_states(log)[0])}


def test_in_flight(spark):
    log = [("Q", "a", "TRACK"), ("Q", "a", "TRACK"), ("Q", "b", "TRACK"), ("Q", "b", "COMPLETE"), ("R", "c", "COMPLETE")]
    rows = [(q, m, a, i) for i, (q, m, a) in enumerate(log)]
    df = spark.createDataFrame(rows, "queueName string, messageIdHex string, action string, seq int").withColumn("ts", F.lit(0))
    got = {r["queueName"]: (r["inFlight"], r["drained"]) for r in control.in_flight(df).collect()}
    assert got == {"Q": (1, False), "R": (0, True)}

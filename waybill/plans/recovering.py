"""Queries of failures, retries, poison messages and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.functions import failures as failing
from waybill.functions.retry import RetryPolicy
from waybill.operators import recovery
from waybill.plans import views
from waybill.plans.registry import query
from waybill.session import shared_dir


@query(
    "reason_kind",
    views.FAILURES
    + """, kinds AS (SELECT *, CASE WHEN reason IN (2035, 2063) THEN 'AUTHENTICATION'
      WHEN reason IN (2059, 2009, 2538, 2537) THEN 'CONNECTION' WHEN reason IN (2085, 2058) THEN 'CONFIGURATION'
      WHEN reason = 2003 THEN 'ROLLED_BACK' ELSE 'TRANSPORT' END AS reason_kind FROM typed)
  SELECT id AS "messageIdHex", reason_kind AS kind,
    CASE reason_kind WHEN 'AUTHENTICATION' THEN 'Authentication failed: ' WHEN 'CONNECTION' THEN 'Connection failed: '
      WHEN 'CONFIGURATION' THEN 'Configuration error: ' WHEN 'ROLLED_BACK' THEN 'Transaction rolled back: '
      ELSE 'Transport error: ' END || text ||
    CASE WHEN reason IS NULL THEN '' WHEN completion IS NULL THEN ' [reasonCode=' || reason || ']'
      ELSE ' [reasonCode=' || reason || ', completionCode=' || completion || ']' END AS error FROM kinds""",
)
def reason_kind(spark, folder):
    log = views.failures(views.events(spark, folder)).withColumn("kind", failing.reason_kind(F.col("reasonCode")))
    message = F.coalesce("message", F.element_at(F.split("errorClass", r"\."), -1))
    error = failing.error_text(F.col("kind"), message, F.col("reasonCode"), F.col("completionCode"))
    return log.select("messageIdHex", "kind", error.alias("error"))


@query("failure_class", views.FAILURES + """SELECT id AS "messageIdHex", kind AS "failureType", why AS reason FROM typed""")
def failure_class(spark, folder):
    judged = failing.classify(F.col("errorClass"), F.col("message"))
    return views.failures(views.events(spark, folder)).select("messageIdHex", judged.alias("f")).select("messageIdHex", "f.*")


@query(
    "retry_decision",
    views.FAILURES + """SELECT id AS "messageIdHex", attempt, kind AS "failureType", retry AS "shouldRetry" FROM planned""",
)
def retry_decision(spark, folder):
    planned = recovery.retry_plan(views.failures(views.events(spark, folder)))
    return views.flat(planned, "messageIdHex", "attempt", "failureType", "shouldRetry")


@query(
    "backoff_schedule",
    views.FAILURES
    + """SELECT id AS "messageIdHex", attempt, delay AS "doubledMs",
    least(1000 * floor(pow(1.5, attempt - 1))::BIGINT, 5000) AS "cutMs",
    least(floor(1000 * pow(2.0, attempt))::BIGINT, 10000) AS "pollMs" FROM planned""",
)
def backoff_schedule(spark, folder):
    attempt = F.col("attempt")
    return views.failures(views.events(spark, folder)).select(
        "messageIdHex",
        attempt.cast("bigint").alias("attempt"),
        RetryPolicy().delay_ms(attempt).alias("doubledMs"),
        RetryPolicy(max_ms=5000, multiplier=1.5).delay_ms(attempt).alias("cutMs"),
        RetryPolicy(max_ms=10000).backoff_ms(attempt).alias("pollMs"),
    )


@query(
    "backoff_jitter",
    views.FAILURES
    + """SELECT id AS "messageIdHex", attempt, delay AS "delayMs", greatest(1, delay + trunc(
    (('0x' || substr(md5(id || '/' || attempt), 1, 8))::BIGINT / 2147483647.5 - 1) * floor(delay * 0.1))::BIGINT)
    AS "jitteredMs" FROM planned""",
)
def backoff_jitter(spark, folder):
    policy = RetryPolicy(jitter=0.1)
    attempt = F.col("attempt")
    return views.failures(views.events(spark, folder)).select(
        "messageIdHex",
        attempt.cast("bigint").alias("attempt"),
        policy.delay_ms(attempt).alias("delayMs"),
        policy.jittered_ms(attempt, F.col("messageIdHex")).alias("jitteredMs"),
    )


@query(
    "retry_plan",
    views.FAILURES
    + """SELECT id AS "messageIdHex", retry AS "shouldRetry", CASE WHEN retry THEN delay ELSE -1 END AS "delayMs",
    CASE WHEN retry THEN recv_ms + delay ELSE -1 END AS "nextRetryAtMs" FROM planned""",
)
def retry_plan(spark, folder):
    planned = recovery.retry_plan(views.failures(views.events(spark, folder)))
    shown = views.flat(planned, "messageIdHex", "shouldRetry", "delayMs", "nextRetryAt")
    return shown.fillna(-1, ["delayMs", "nextRetryAtMs"])


@query(
    "poison_split",
    views.E
    + """SELECT id AS "messageIdHex", backout >= 5 AS "isPoison", greatest(0, 5 - backout) AS "remainingRetries" FROM e""",
)
def poison_split(spark, folder):
    count = F.col("backoutCount")
    return views.events(spark, folder).select(
        "messageIdHex",
        recovery.is_poison(count, 5).alias("isPoison"),
        recovery.remaining_retries(count, 5).cast("bigint").alias("remainingRetries"),
    )


@query(
    "quarantine_decision",
    views.E
    + """SELECT id AS "messageId", 'MoveToDeadLetter' AS action, 'Move to dead letter queue' AS description,
    'Message exceeded backout threshold: ' || backout || ' >= 5' AS reason FROM e WHERE backout >= 5""",
)
def quarantine_decision(spark, folder):
    poison = views.events(spark, folder).filter(recovery.is_poison(F.col("backoutCount"), 5))
    return poison.select(recovery.quarantine_decision(5).alias("d")).select("d.*")


_ACTIONS = ["MoveToDeadLetter", "MoveToBackout", "Discard", "REVIEW.QUEUE"]
_ROUTED = views.E + """, routed AS (SELECT id, q, size, body, CASE WHEN backout < 4 THEN q
    ELSE CASE event_id % 4 WHEN 0 THEN 'DEAD.LETTER' WHEN 1 THEN 'BACKOUT' WHEN 3 THEN 'REVIEW.QUEUE' END END AS target
  FROM e)"""


def routed(spark, folder):
    action = views.pick(_ACTIONS, F.col("event_id") % 4)
    return recovery.route(views.events(spark, folder), 4, action)


@query(
    "route_messages",
    _ROUTED
    + """SELECT id AS "messageIdHex", q AS "queueName", target AS "targetQueue", body AS "payloadString"
  FROM routed WHERE target IS NOT NULL""",
)
def route_messages(spark, folder):
    """Route every message in two batches, one of them replayed, and read the targets back with payloads."""
    path = shared_dir(spark, "routed")
    everything = routed(spark, folder)
    for batch_id in (0, 1, 1):
        recovery.write_routed(everything.filter(F.col("event_id") % 2 == batch_id), path, batch_id)
    columns = "messageIdHex", "queueName", "targetQueue", "payload"
    written = spark.read.schema(", ".join(f"{c} {'binary' if c == 'payload' else 'string'}" for c in columns)).parquet(path)
    return written.select(*columns[:3], F.col("payload").cast("string").alias("payloadString"))


@query(
    "dedup_messages",
    views.LINES
    + """SELECT id AS "messageIdHex", body AS "payloadString" FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY l_partkey, l_suppkey, body) AS rn FROM l) WHERE rn = 1""",
)
def dedup_messages(spark, folder):
    first = recovery.deduplicate(views.lines(spark, folder), ["l_partkey", "l_suppkey", "payloadString"])
    return first.select("messageIdHex", "payloadString")

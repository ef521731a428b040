"""Queries of metrics, audit and health."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.operators import audit, checkpoints, latencies, metrics, parse, recovery
from waybill.plans import views
from waybill.plans.recovering import _ROUTED, routed
from waybill.plans.registry import query
from waybill.session import materialize

# Counters: `m` has one row per label, null where nothing was recorded.
_METRICS = views.LOG_FAILURES_POLLS + f""", conn AS ({views.CONNECTIONS}), m AS (
  SELECT label, sum(received)::BIGINT AS received, sum(bytes)::BIGINT AS bytes, sum(committed)::BIGINT AS committed,
    sum(rolledback)::BIGINT AS rolledback, sum(ok)::BIGINT AS ok, sum(bad)::BIGINT AS bad, sum(retried)::BIGINT AS retried,
    sum(conn_ok)::BIGINT AS conn_ok, sum(conn_bad)::BIGINT AS conn_bad, sum(polls)::BIGINT AS polls,
    sum(poll_ms)::BIGINT AS poll_ms
  FROM (SELECT q AS label, count(*) AS received, sum(size) AS bytes, NULL AS committed, NULL AS rolledback, count(*) AS ok,
      NULL AS bad, NULL AS retried, NULL AS conn_ok, NULL AS conn_bad, NULL AS polls, NULL AS poll_ms FROM e GROUP BY q
    UNION ALL BY NAME SELECT q AS label, count(*) FILTER (WHERE outcome = 'COMMIT') AS committed,
      count(*) FILTER (WHERE outcome = 'ROLLBACK') AS rolledback FROM log GROUP BY q
    UNION ALL BY NAME SELECT q AS label, count(*) AS retried FROM planned WHERE retry GROUP BY q
    UNION ALL BY NAME SELECT q AS label, count(*) AS polls, sum(dur) AS poll_ms FROM polls GROUP BY q
    UNION ALL BY NAME SELECT qm AS label, nullif(count(*) FILTER (WHERE ok), 0) AS conn_ok,
      nullif(count(*) FILTER (WHERE NOT ok), 0) AS conn_bad FROM conn GROUP BY qm)
  GROUP BY label)"""


def _metrics(spark, folder):
    messages = views.events(spark, folder)
    return metrics.queue_metrics(
        messages=messages,
        log=views.delivery_log(messages),
        parsed=parse.parse_payloads(messages, (parse.JSON, parse.TEXT)),
        retries=recovery.retry_plan(views.failures(messages)),
        connections=views.connections(spark, folder),
        polls=views.polls(messages),
    )


_COLUMNS = {
    "messagesReceived": "received",
    "bytesReceived": "bytes",
    "messagesCommitted": "committed",
    "messagesRolledBack": "rolledback",
    "parseSuccess": "ok",
    "parseFailure": "bad",
    "retries": "retried",
    "connectionSuccess": "conn_ok",
    "connectionFailure": "conn_bad",
    "pollCount": "polls",
    "pollDurationMs": "poll_ms",
}


@query(
    "queue_metrics",
    _METRICS
    + "SELECT label, "
    + ", ".join(f'coalesce({short}, 0) AS "{name}"' for name, short in _COLUMNS.items())
    + " FROM m",
)
def queue_metrics(spark, folder):
    return metrics.with_zeros(_metrics(spark, folder))


@query(
    "throughput",
    views.E
    + """SELECT q AS "queueName", count(*) AS "messagesReceived", (max(ms) - min(ms)) / 1000.0 AS "elapsedSeconds",
    round(count(*) / ((max(ms) - min(ms)) / 1000.0), 9) AS throughput FROM e GROUP BY q""",
)
def throughput(spark, folder):
    return metrics.throughput(views.events(spark, folder)).withColumn("throughput", F.round("throughput", 9))


@query(
    "prometheus_lines",
    _METRICS
    + ", long AS ("
    + " UNION ALL ".join(
        f"SELECT {no} AS no, '{name}' AS name, label, {short} AS v FROM m WHERE {short} IS NOT NULL"
        for no, ((_, name, _), short) in enumerate(zip(metrics.METRICS, _COLUMNS.values()))
    )
    + """)
  SELECT no::BIGINT AS "metricNo", 2::BIGINT AS part, label, name || '{queue="' || label || '"} ' || v AS line FROM long """
    + " ".join(
        f"UNION ALL SELECT {no}, 0, '', '# HELP {name} {text}' UNION ALL SELECT {no}, 1, '', '# TYPE {name} counter'"
        for no, (_, name, text) in enumerate(metrics.METRICS)
    ),
)
def prometheus_lines(spark, folder):
    return views.flat(metrics.prometheus_lines(_metrics(spark, folder)))


@query(
    "poll_stats",
    views.POLLS
    + """SELECT q AS "queueName", sum(n)::BIGINT AS "messagesPolled", count(*) AS "pollCount", max(ms) AS "lastPollTimeMs",
    sum(dur)::BIGINT AS "totalPollDuration", count(*) FILTER (WHERE n = 0) AS "emptyPollCount" FROM polls GROUP BY q""",
)
def poll_stats(spark, folder):
    return views.flat(metrics.poll_statistics(views.polls(views.events(spark, folder))))


@query(
    "error_counts",
    views.FAILURES + """SELECT q AS "queueName", class AS "errorType", count(*) AS errors FROM typed GROUP BY ALL""",
)
def error_counts(spark, folder):
    return metrics.error_counts(views.failures(views.events(spark, folder)))


@query(
    "processing_times",
    views.E
    + """SELECT q AS "queueName", count(*) AS processed, sum(recv_ms - ms)::BIGINT AS "totalMs",
    max(recv_ms - ms) AS "longestMs" FROM e GROUP BY q""",
)
def processing_times(spark, folder):
    return metrics.processing_times(views.events(spark, folder))


@query(
    "processing_percentiles",
    views.E
    + """, t AS (SELECT q, recv_ms - ms AS took FROM e)
  SELECT q AS "queueName", count(*) AS processed, round(avg(took), 6) AS "averageMs", min(took) AS "shortestMs",
    max(took) AS "longestMs", true AS "p50Near", true AS "p90Near", true AS "p99Near" FROM t GROUP BY q""",
)
def processing_percentiles(spark, folder):
    """Quantiles from sketches of a minute, and whether their rank among all messages is off by less than 1 per cent."""
    events = views.events(spark, folder)
    stored = materialize(latencies.time_sketches(events), "sketches")
    found = materialize(latencies.with_quantiles(latencies.merge_sketches(stored)), "quantiles")
    errors = latencies.rank_errors(events, found)
    near = [(F.col(f"{n}Error") < 0.01).alias(f"{n}Near") for n in ("p50", "p90", "p99")]
    shown = found.select("queueName", "processed", F.round("averageMs", 6).alias("averageMs"), "shortestMs", "longestMs")
    return shown.join(errors.select("queueName", *near), "queueName")


@query(
    "sent_counts",
    _ROUTED
    + """SELECT target AS "targetQueue", count(*) AS "messagesSent", sum(size)::BIGINT AS "bytesSent"
    FROM routed WHERE target IS NOT NULL GROUP BY target""",
)
def sent_counts(spark, folder):
    return metrics.sent_counts(routed(spark, folder))


@query(
    "queue_health",
    _METRICS
    + """, z AS (SELECT label, coalesce(received, 0) AS r, coalesce(committed, 0) AS c,
      coalesce(rolledback, 0) AS b, coalesce(bad, 0) AS p, b + p AS f FROM m), h AS (
  SELECT *, CASE WHEN r = 0 THEN 'UNKNOWN' WHEN c = 0 THEN 'DOWN' WHEN f > r * 0.1 THEN 'DEGRADED' ELSE 'UP' END AS status
  FROM z)
  SELECT label, status, status = 'UP' AS "isHealthy",
    r || ' received, ' || c || ' committed, ' || f || ' failed' AS message,
    '{"messagesReceived":"' || r || '","messagesCommitted":"' || c || '","messagesRolledBack":"' || b ||
    '","parseFailure":"' || p || '"}' AS details, 1700000000000::BIGINT AS "timestampMs" FROM h""",
)
def queue_health(spark, folder):
    health = metrics.queue_health(_metrics(spark, folder), at=F.timestamp_millis(F.lit(1_700_000_000_000)))
    return views.flat(health.withColumn("details", F.to_json("details")))


# Audit: `a` has one row per event, details as one JSON text.

AUDIT = views.LOG + ", " + views._FAILURES + f""", conn AS ({views.CONNECTIONS}), ck AS (
  SELECT q, arg_max(id, event_id) AS id, max(ms) + 1 AS ms, count(*) AS n FROM e GROUP BY q), a AS (
  SELECT 'MESSAGE_RECEIVED' AS kind, recv_ms AS ms, q, 'QM1' AS qm, id, corr,
    '{{"bytes":"' || size || '","userId":"user' || user_id || '"}}' AS details FROM e
  UNION ALL SELECT CASE outcome WHEN 'COMMIT' THEN 'MESSAGE_COMMITTED' ELSE 'MESSAGE_ROLLED_BACK' END, recv_ms, q, 'QM1', id,
    NULL, '{{"batchId":"' || batch || '","attempt":"' || attempt || '"}}' FROM log
  UNION ALL SELECT 'MESSAGE_QUARANTINED', recv_ms, q, 'QM1', id, NULL,
    '{{"action":"MoveToDeadLetter","reason":"Message exceeded backout threshold: ' || backout || ' >= 5"}}'
    FROM e WHERE backout >= 5
  UNION ALL SELECT 'ERROR', recv_ms, q, 'QM1', id, NULL,
    '{{"errorMessage":' || coalesce('"' || message || '"', 'null') || ',"errorType":"' || class || '"}}' FROM planned
  UNION ALL SELECT 'RETRY_ATTEMPT', recv_ms + delay, q, 'QM1', id, NULL,
    '{{"attempt":"' || attempt || '","delayMs":"' || delay || '"}}' FROM planned WHERE retry
  UNION ALL SELECT 'PARSE_ERROR', recv_ms, q, 'QM1', id, NULL,
    '{{"format":"XML","errorMessage":"XML parse error: document is not well-formed"}}' FROM e
  UNION ALL SELECT CASE WHEN ok THEN 'CONNECTION_ESTABLISHED' ELSE 'CONNECTION_LOST' END, ms, '', qm, NULL, NULL, '{{}}'
    FROM conn
  UNION ALL SELECT kind, ms, q, 'QM1', id, NULL, '{{"partitionId":"0","messagesProcessed":"' || n || '"}}'
    FROM ck, (VALUES ('CHECKPOINT_SAVED'), ('CHECKPOINT_LOADED')) t(kind))"""


def audit_log(spark, folder):
    """All eleven event types from the messages and logs of one run."""
    messages = views.events(spark, folder)
    failures = views.failures(messages)
    planned = recovery.retry_plan(failures)
    poison = messages.filter(recovery.is_poison(F.col("backoutCount"), 5))
    saved = checkpoints.build_checkpoints(
        messages.withColumn("partitionId", F.lit(0)), "QM1", F.lit(0).cast("bigint")
    ).withColumn("createdAt", F.col("lastProcessedTimestamp") + 1)
    return audit.union(
        audit.received(messages, "QM1", "events"),
        audit.settled(views.delivery_log(messages), "QM1", "events"),
        audit.quarantined(poison, recovery.quarantine_decision(5), "QM1", "events"),
        audit.errors(failures, "QM1", "events"),
        audit.retry_attempts(planned, "QM1", "events"),
        audit.parse_errors(parse.parse_payloads(messages, (parse.XML,)), "QM1", "events"),
        audit.connections(views.connections(spark, folder), "events"),
        audit.checkpoint_events(saved, "CHECKPOINT_SAVED", "events"),
        audit.checkpoint_events(saved, "CHECKPOINT_LOADED", "events"),
    )


_EVENT = """SELECT kind AS "eventType", ms AS "timestamp", q AS "queueName", qm AS "queueManager", id AS "messageId",
  corr AS "correlationId", 'events' AS "sourceId", details FROM a"""


def _shown(events):
    return events.withColumn("details", F.to_json("details", {"ignoreNullFields": "false"}))


@query("audit_events", AUDIT + _EVENT)
def audit_events(spark, folder):
    return _shown(audit_log(spark, folder))


@query("audit_by_type", AUDIT + _EVENT + " WHERE kind = 'MESSAGE_RECEIVED'")
def audit_by_type(spark, folder):
    return _shown(audit.of_type(audit_log(spark, folder), "MESSAGE_RECEIVED"))


@query("audit_errors_only", AUDIT + _EVENT + " WHERE kind IN ('ERROR', 'PARSE_ERROR')")
def audit_errors_only(spark, folder):
    return _shown(audit.errors_only(audit_log(spark, folder)))


CONSOLE_SQL = """SELECT '[' || regexp_replace(strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S.%g'), '0{1,2}$', '') || '] ' ||
  list_aggregate(list_transform(string_split(lower(kind), '_'), lambda x: upper(x[1]) || x[2:]), 'string_agg', '') ||
  ' queue=' || q || ' qm=' || qm || ' msgId=' || coalesce(id, '-') AS line FROM a"""


@query("audit_console_lines", AUDIT + CONSOLE_SQL)
def audit_console_lines(spark, folder):
    return audit_log(spark, folder).select(audit.console_line().alias("line"))


@query(
    "audit_json",
    AUDIT
    + """SELECT '{"eventType":"' || kind || '","timestamp":' || ms || ',"queueName":"' || q || '","queueManager":"' || qm ||
    '","messageId":' || coalesce('"' || id || '"', 'null') || ',"correlationId":' || coalesce('"' || corr || '"', 'null') ||
    ',"sourceId":"events","details":' || details || '}' AS line FROM a""",
)
def audit_json(spark, folder):
    return audit_log(spark, folder).select(audit.json_line().alias("line"))

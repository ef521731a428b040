"""Queries of throttling and operational logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from waybill.operators import control, throttle
from waybill.plans import views
from waybill.plans.registry import query

TOKENS = 2
# Events of one queue are minutes apart, so buckets are filled by the hour here.
_EVENTS = views.E + ", " + views.limits_sql(TOKENS)
_ALIGNED = _EVENTS + """, ranked AS (
  SELECT q, id, ms, row_number() OVER (PARTITION BY q, ms // 3600000 ORDER BY ms, id) AS rn FROM e), asked AS (
  SELECT q, id, ms, tokens, coalesce(rn <= tokens, true) AS granted FROM ranked LEFT JOIN limits USING (q))"""
REFILLED = _EVENTS.replace("WITH ", "WITH RECURSIVE ", 1) + """, times AS (
  SELECT DISTINCT q, ms FROM e JOIN limits USING (q)), following AS (
  SELECT q, ms, first_value(ms) OVER (PARTITION BY q ORDER BY ms
    RANGE BETWEEN 3600000 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ms FROM times), windows AS (
  SELECT q, min(ms) AS start FROM times GROUP BY q
  UNION ALL
  SELECT w.q, f.next_ms FROM windows w JOIN following f ON f.q = w.q AND f.ms = w.start WHERE f.next_ms IS NOT NULL), spans AS (
  SELECT q, start, lead(start) OVER (PARTITION BY q ORDER BY start) AS stop FROM windows), ranked AS (
  SELECT e.q, id, row_number() OVER (PARTITION BY e.q, start ORDER BY ms, id) AS rn
  FROM e JOIN spans s ON e.q = s.q AND e.ms >= s.start AND (s.stop IS NULL OR e.ms < s.stop)), asked AS (
  SELECT e.q, e.id, coalesce(rn <= tokens, true) AS granted
  FROM e LEFT JOIN ranked r ON r.q = e.q AND r.id = e.id LEFT JOIN limits l ON l.q = e.q)"""
_SHOWN = """SELECT q AS "queueName", id AS "messageIdHex", granted FROM asked"""


@query("throttle_bucket", REFILLED + _SHOWN)
def throttle_bucket(spark, folder):
    asked = throttle.throttle(views.events(spark, folder), views.limits(spark, TOKENS), views.HOUR_MS)
    return asked.select("queueName", "messageIdHex", "granted")


@query("throttle_aligned", _ALIGNED + _SHOWN)
def throttle_aligned(spark, folder):
    limits = views.limits(spark, TOKENS)
    asked = throttle.throttle(views.events(spark, folder), limits, views.HOUR_MS, aligned=True)
    return asked.select("queueName", "messageIdHex", "granted")


@query(
    "throttle_rate",
    _ALIGNED
    + """SELECT q AS "queueName", tokens::BIGINT AS tokens, count(*) FILTER (WHERE granted) AS granted, count(*) AS asked,
    round(count(*) FILTER (WHERE granted) / ((max(ms) - min(ms)) / 1000.0), 9) AS rate
  FROM asked WHERE tokens IS NOT NULL GROUP BY q, tokens""",
)
def throttle_rate(spark, folder):
    limits = views.limits(spark, TOKENS)
    asked = throttle.throttle(views.events(spark, folder), limits, views.HOUR_MS, aligned=True)
    rates = throttle.granted_rates(asked, limits).withColumn("rate", F.round("rate", 9))
    return views.flat(rates, "queueName", "tokens", "granted", "asked", "rate")


_COMMANDS = """WITH c AS (SELECT user_id AS conn, event_id AS seq, epoch_us(ts) // 1000 AS ms,
    CASE WHEN value >= 250 THEN 'GRACEFUL_STOP' WHEN value >= 200 THEN 'COMPLETE_DRAIN' WHEN value >= 150 THEN 'DRAIN'
      WHEN event_type IN ('signup', 'purchase') THEN 'PAUSE' WHEN event_type IN ('view', 'click') THEN 'RESUME'
      ELSE 'REQUEST_STOP' END AS cmd FROM events), o AS (
  SELECT *, row_number() OVER (PARTITION BY conn ORDER BY ms, seq) AS pos FROM c), d AS (
  SELECT conn, min(pos) FILTER (WHERE cmd = 'DRAIN') AS drain, min(pos) FILTER (WHERE cmd = 'GRACEFUL_STOP') AS graceful,
    min(pos) FILTER (WHERE cmd IN ('REQUEST_STOP', 'GRACEFUL_STOP')) AS flag FROM o GROUP BY conn), s AS (
  SELECT d.conn, drain, flag, least(graceful, min(pos) FILTER (WHERE cmd = 'COMPLETE_DRAIN' AND pos > drain)) AS stop
  FROM d JOIN o USING (conn) GROUP BY d.conn, drain, flag, graceful), t AS (
  SELECT o.*, drain, stop, flag, last_value(CASE WHEN cmd IN ('PAUSE', 'RESUME') THEN cmd END IGNORE NULLS)
    OVER (PARTITION BY conn ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sw
  FROM o JOIN s USING (conn)), line AS (
  SELECT *, CASE WHEN pos >= stop THEN 'Stopped' WHEN pos >= drain THEN 'Draining' WHEN sw = 'PAUSE' THEN 'Paused'
    ELSE 'Running' END AS state FROM t), timeline AS (
  SELECT *, lag(state, 1, 'Running') OVER (PARTITION BY conn ORDER BY pos) AS before FROM line)"""


STATES = _COMMANDS + """SELECT conn AS "connectorId", seq, cmd AS command, before AS "stateBefore", state,
    state <> before AS changed, coalesce(pos >= flag, false) AS "stopRequested" FROM timeline"""


@query("state_timeline", STATES)
def state_timeline(spark, folder):
    return control.state_timeline(views.commands(spark, folder)).drop("ts")


@query(
    "pause_duration",
    _COMMANDS
    + """, changes AS (SELECT *, lead(ms) OVER w AS next_ms, lead(state) OVER w AS next_state FROM timeline
    WHERE state <> before WINDOW w AS (PARTITION BY conn ORDER BY pos))
  SELECT conn AS "connectorId", count(c.ms) AS resumes, coalesce(sum(next_ms - c.ms), 0)::BIGINT AS "totalPauseDurationMs"
  FROM (SELECT DISTINCT conn FROM c) LEFT JOIN (SELECT * FROM changes WHERE state = 'Paused' AND next_state = 'Running') c
    USING (conn) GROUP BY conn""",
)
def pause_duration(spark, folder):
    return control.pause_durations(control.state_timeline(views.commands(spark, folder)))


@query(
    "in_flight",
    views.E
    + """, log AS (SELECT q, id, 1 AS delta, ms, event_id * 2 AS seq FROM e
    UNION ALL SELECT q, id, 0, recv_ms, event_id * 2 + 1 FROM e WHERE value >= 10), last AS (
  SELECT q, id, delta, row_number() OVER (PARTITION BY q, id ORDER BY ms DESC, seq DESC) AS rn FROM log)
  SELECT q AS "queueName", sum(delta)::BIGINT AS "inFlight", sum(delta) = 0 AS drained FROM last WHERE rn = 1 GROUP BY q""",
)
def in_flight(spark, folder):
    return control.in_flight(views.tracking(views.events(spark, folder)))

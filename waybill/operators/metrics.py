"""Counters per queue and the reports made of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.headers import latency_ms, stored_size

# Counter column, exported metric name, help text; in export order.
METRICS = (
    ("messagesReceived", "mq_messages_received", "Total messages received"),
    ("bytesReceived", "mq_bytes_received", "Total bytes received"),
    ("messagesCommitted", "mq_messages_committed", "Total messages committed"),
    ("messagesRolledBack", "mq_messages_rolledback", "Total messages rolled back"),
    ("parseSuccess", "mq_parse_success", "Total successful parses"),
    ("parseFailure", "mq_parse_failure", "Total parse failures"),
    ("retries", "mq_retries", "Total retry attempts"),
    ("connectionSuccess", "mq_connection_success", "Total successful connections"),
    ("connectionFailure", "mq_connection_failure", "Total failed connections"),
    ("pollCount", "mq_poll_count", "Total poll operations"),
    ("pollDurationMs", "mq_poll_duration_ms", "Total poll duration in milliseconds"),
)
COUNTERS = [name for name, _, _ in METRICS]


def _nonzero(df: DataFrame, key: str, **counts) -> DataFrame:
    """Counts per key; a counter nothing was recorded for stays null."""
    counted = df.groupBy(F.col(key).alias("label")).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    return counted.select("label", *[F.nullif(F.col(n), F.lit(0)).alias(n) for n in counts])


def queue_metrics(
    messages: DataFrame | None = None,
    log: DataFrame | None = None,
    parsed: DataFrame | None = None,
    retries: DataFrame | None = None,
    connections: DataFrame | None = None,
    polls: DataFrame | None = None,
) -> DataFrame:
    """The eleven counters per label (queue, or queue manager for connections); null = never recorded.

    Each source is aggregated on its own and only these small results are combined.
    """
    parts = []
    if messages is not None:
        parts.append(
            messages.groupBy(F.col("queueName").alias("label")).agg(
                F.count("*").alias("messagesReceived"), F.sum(stored_size(messages)).alias("bytesReceived")
            )
        )
    if log is not None:
        outcome = F.col("outcome")
        parts.append(
            _nonzero(log, "queueName", messagesCommitted=outcome == "COMMIT", messagesRolledBack=outcome == "ROLLBACK")
        )
    if parsed is not None:
        ok = F.col("parsed.isSuccess")
        parts.append(_nonzero(parsed, "queueName", parseSuccess=ok, parseFailure=~ok))
    if retries is not None:
        parts.append(_nonzero(retries, "queueName", retries=F.col("shouldRetry")))
    if connections is not None:
        ok = F.col("success")
        parts.append(_nonzero(connections, "queueManager", connectionSuccess=ok, connectionFailure=~ok))
    if polls is not None:
        parts.append(
            polls.groupBy(F.col("queueName").alias("label")).agg(
                F.count("*").alias("pollCount"), F.sum("durationMs").alias("pollDurationMs")
            )
        )
    if not parts:
        raise ValueError("queue_metrics needs at least one source")
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    have = [c for c in COUNTERS if c in union.columns]
    summed = union.groupBy("label").agg(*[F.sum(c).alias(c) for c in have])
    return summed.select(
        "label", *[(F.col(c) if c in have else F.lit(None)).cast("bigint").alias(c) for c in COUNTERS]
    )


def with_zeros(metrics: DataFrame) -> DataFrame:
    """Counters as read by callers: 0 where nothing was recorded."""
    return metrics.fillna(0, COUNTERS)


def throughput(messages: DataFrame) -> DataFrame:
    """Messages per second between the first and the last put of each queue; 0 when no time passed."""
    put = F.unix_millis("timestamp")
    counts = messages.groupBy("queueName").agg(
        F.count("*").alias("messagesReceived"), ((F.max(put) - F.min(put)) / 1000).alias("elapsedSeconds")
    )
    rate = F.when(F.col("elapsedSeconds") > 0, F.col("messagesReceived") / F.col("elapsedSeconds"))
    return counts.withColumn("throughput", F.coalesce(rate, F.lit(0.0)))


def prometheus_lines(metrics: DataFrame) -> DataFrame:
    """Exposition text as rows (metricNo, part, label, line), to be written in that order.

    Part 0 is the help line, 1 the type line, 2 a sample.
    """
    headers = metrics.sparkSession.createDataFrame(
        [
            row
            for no, (_, name, text) in enumerate(METRICS)
            for row in ((no, 0, "", f"# HELP {name} {text}"), (no, 1, "", f"# TYPE {name} counter"))
        ],
        "metricNo int, part int, label string, line string",
    )
    samples = metrics.select(
        "label",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(no).alias("metricNo"), F.lit(name).alias("name"), F.col(column).alias("value"))
                    for no, (column, name, _) in enumerate(METRICS)
                ]
            )
        ).alias("m"),
    ).filter("m.value IS NOT NULL")
    line = F.concat("m.name", F.lit('{queue="'), "label", F.lit('"} '), "m.value")
    return headers.unionByName(samples.select("m.metricNo", F.lit(2).alias("part"), "label", line.alias("line")))


def poll_statistics(polls: DataFrame) -> DataFrame:
    return polls.groupBy("queueName").agg(
        F.sum("messageCount").alias("messagesPolled"),
        F.count("*").alias("pollCount"),
        F.max("ts").alias("lastPollTime"),
        F.sum("durationMs").alias("totalPollDuration"),
        F.count_if(F.col("messageCount") == 0).alias("emptyPollCount"),
    )


def error_counts(failures: DataFrame) -> DataFrame:
    return failures.groupBy("queueName", F.col("errorClass").alias("errorType")).agg(F.count("*").alias("errors"))


def processing_times(messages: DataFrame) -> DataFrame:
    took = latency_ms(F.col("receivedAt"), F.col("timestamp"))
    return messages.groupBy("queueName").agg(
        F.count("*").alias("processed"),
        F.sum(took).alias("totalMs"),
        F.max(took).alias("longestMs"),
    )


def sent_counts(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("targetQueue").isNotNull()).groupBy("targetQueue").agg(
        F.count("*").alias("messagesSent"), F.sum(stored_size(routed)).alias("bytesSent")
    )


def queue_health(metrics: DataFrame, degraded_share: float = 0.1, at: Column | None = None) -> DataFrame:
    """Health (label, status, isHealthy, message, details, timestamp) from the counters, as of ``at`` (else now).

    UNKNOWN: nothing received. DOWN: nothing committed. DEGRADED: rollbacks and parse failures above
    ``degraded_share`` of the messages. UP otherwise; only UP is healthy.
    """
    m = with_zeros(metrics)
    bad = F.col("messagesRolledBack") + F.col("parseFailure")
    status = (
        F.when(F.col("messagesReceived") == 0, "UNKNOWN")
        .when(F.col("messagesCommitted") == 0, "DOWN")
        .when(bad > F.col("messagesReceived") * degraded_share, "DEGRADED")
        .otherwise("UP")
    )
    text = F.concat(
        "messagesReceived", F.lit(" received, "), "messagesCommitted", F.lit(" committed, "), bad, F.lit(" failed")
    )
    shown = ("messagesReceived", "messagesCommitted", "messagesRolledBack", "parseFailure")
    details = F.create_map(*[x for c in shown for x in (F.lit(c), F.col(c).cast("string"))])
    return m.select(
        "label",
        status.alias("status"),
        (status == "UP").alias("isHealthy"),
        text.alias("message"),
        details.alias("details"),
        (F.current_timestamp() if at is None else at).alias("timestamp"),
    )

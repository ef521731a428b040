"""Metrics, audit text and health."""

import json

import pytest
from pyspark.sql import functions as F

from waybill.operators import audit, metrics

POLLS = "queueName string, messageCount bigint, durationMs bigint, ts timestamp"


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        ("MESSAGE_RECEIVED", 1700000000120, "Q", "QM", "aa", "bb", "s", {"k": 'say "hi"\n\\'}),
        ("ERROR", 1700000000000, "Q", "QM", None, None, "s", {"password": "x", "user": "u"}),
        ("MESSAGE_ROLLED_BACK", 1700000000007, "Q", "QM", "cc", None, "s", {}),
        ("PARSE_ERROR", 1700000000007, "Q", "QM", "cc", None, "s", {}),
    ]
    schema = (
        "eventType string, timestamp bigint, queueName string, queueManager string, messageId string, "
        "correlationId string, sourceId string, details map<string,string>"
    )
    return spark.createDataFrame(rows, schema)


def test_console_lines(events):
    lines = [r[0] for r in events.select(audit.console_line()).collect()]
    assert lines[0] == "[2023-11-14 22:13:20.12] MessageReceived queue=Q qm=QM msgId=aa"
    assert lines[1] == "[2023-11-14 22:13:20.0] Error queue=Q qm=QM msgId=-"
    assert lines[2].startswith("[2023-11-14 22:13:20.007] MessageRolledBack ")


def test_json_lines_are_valid_json(events):
    first, second = [json.loads(r[0]) for r in events.select(audit.json_line()).limit(2).collect()]
    assert list(first) == list(audit.FIELDS)
    assert first["details"] == {"k": 'say "hi"\n\\'}
    assert second["messageId"] is None and second["correlationId"] is None


def test_redaction_and_filters(events):
    hidden = audit.of_type(audit.redacted(events), "ERROR").first()["details"]
    assert hidden == {"password": "[REDACTED]", "user": "u"}
    assert sorted(r["eventType"] for r in audit.errors_only(events).collect()) == ["ERROR", "PARSE_ERROR"]


def test_console_names_follow_the_rule_for_all_types(spark):
    df = spark.createDataFrame([(t, 0, "", "", None, None, "", {}) for t in audit.EVENT_TYPES],
                               "eventType string, timestamp bigint, queueName string, queueManager string, messageId string, "
                               "correlationId string, sourceId string, details map<string,string>")
    names = [r[0].split("] ")[1].split(" ")[0] for r in df.select(audit.console_line()).collect()]
    assert names[3:7] == ["MessageQuarantined", "ParseError", "ConnectionEstablished", "ConnectionLost"]


def test_counters_and_polls(spark, messages):
    polls = spark.createDataFrame([("Q", 0, 100), ("Q", 3, 200)], "queueName string, messageCount bigint, durationMs bigint")
    polls = polls.withColumn("ts", F.timestamp_millis("durationMs"))
    row = metrics.poll_statistics(polls).first()
    assert (row["messagesPolled"], row["pollCount"], row["totalPollDuration"], row["emptyPollCount"]) == (3, 2, 300, 1)
    counted = metrics.queue_metrics(messages=messages({"queue": "Q", "payload": "abc"}, {"queue": "R"}), polls=polls)
    rows = {r["label"]: r for r in metrics.with_zeros(counted).collect()}
    assert (rows["Q"]["messagesReceived"], rows["Q"]["bytesReceived"], rows["Q"]["pollDurationMs"]) == (1, 3, 300)
    assert (rows["R"]["pollCount"], rows["R"]["messagesCommitted"]) == (0, 0)


def test_prometheus_text(spark, messages):
    counted = metrics.queue_metrics(messages=messages({"queue": "Q", "payload": "abc"}))
    lines = [r["line"] for r in metrics.prometheus_lines(counted).orderBy("metricNo", "part", "label").collect()]
    assert lines[:5] == [
        "# HELP mq_messages_received Total messages received",
        "# TYPE mq_messages_received counter",
        'mq_messages_received{queue="Q"} 1',
        "# HELP mq_bytes_received Total bytes received",
        "# TYPE mq_bytes_received counter",
    ]
    assert len(lines) == 24  # two headers for each of eleven metrics, samples for the two recorded


def test_throughput_needs_elapsed_time(messages):
    rows = {r["queueName"]: r["throughput"] for r in metrics.throughput(
        messages({"queue": "A", "ms": 0}, {"queue": "A", "ms": 2000}, {"queue": "B", "ms": 5})).collect()}
    assert rows == {"A": 1.0, "B": 0.0}


def test_health(spark):
    columns = ["label", *metrics.COUNTERS]
    def row(label, received=0, committed=0, rolled=0):
        return tuple({"label": label, "messagesReceived": received, "messagesCommitted": committed,
                      "messagesRolledBack": rolled}.get(c) for c in columns)
    df = spark.createDataFrame([row("none"), row("down", 5), row("weak", 10, 5, 2), row("fine", 10, 10, 1)],
                               "label string, " + ", ".join(f"{c} bigint" for c in metrics.COUNTERS))
    got = {r["label"]: (r["status"], r["isHealthy"]) for r in metrics.queue_health(df).collect()}
    assert got == {"none": ("UNKNOWN", False), "down": ("DOWN", False), "weak": ("DEGRADED", False), "fine": ("UP", True)}


def test_metrics_need_a_source():
    with pytest.raises(ValueError):
        metrics.queue_metrics()

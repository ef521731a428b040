"""Audit events: building, formatting, filtering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.headers import stored_size
from waybill.functions.redact import redact_map

FIELDS = (
    "eventType",
    "timestamp",
    "queueName",
    "queueManager",
    "messageId",
    "correlationId",
    "sourceId",
    "details",
)

# Event types.
EVENT_TYPES = (
    "MESSAGE_RECEIVED",
    "MESSAGE_COMMITTED",
    "MESSAGE_ROLLED_BACK",
    "MESSAGE_QUARANTINED",
    "PARSE_ERROR",
    "CONNECTION_ESTABLISHED",
    "CONNECTION_LOST",
    "CHECKPOINT_SAVED",
    "CHECKPOINT_LOADED",
    "ERROR",
    "RETRY_ATTEMPT",
)


def events(
    df: DataFrame,
    event_type: str | Column,
    at_ms: Column,
    queue_manager: str | Column,
    source_id: str,
    queue: str | Column = "queueName",
    message_id: Column | None = None,
    correlation_id: Column | None = None,
    details: dict[str, Column] | None = None,
) -> DataFrame:
    """Audit events, one per row of ``df``; times in milliseconds."""
    absent = F.lit(None).cast("string")
    pairs = [x for k, v in (details or {}).items() for x in (F.lit(k), v.cast("string"))]
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    manager = F.lit(queue_manager) if isinstance(queue_manager, str) else queue_manager
    return df.select(
        kind.alias("eventType"),
        at_ms.alias("timestamp"),
        (F.col(queue) if isinstance(queue, str) else queue).alias("queueName"),
        manager.alias("queueManager"),
        (absent if message_id is None else message_id).alias("messageId"),
        (absent if correlation_id is None else correlation_id).alias("correlationId"),
        F.lit(source_id).alias("sourceId"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("details"),
    )


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def received(messages: DataFrame, qm: str, source: str) -> DataFrame:
    return events(
        messages,
        "MESSAGE_RECEIVED",
        F.unix_millis("receivedAt"),
        qm,
        source,
        message_id=F.col("messageIdHex"),
        correlation_id=F.col("correlationIdHex"),
        details={"bytes": stored_size(messages), "userId": F.col("userId")},
    )


def settled(log: DataFrame, qm: str, source: str) -> DataFrame:
    kind = F.when(F.col("outcome") == "COMMIT", "MESSAGE_COMMITTED").otherwise("MESSAGE_ROLLED_BACK")
    return events(
        log,
        kind,
        F.unix_millis("ts"),
        qm,
        source,
        message_id=F.col("messageIdHex"),
        details={"batchId": F.col("batchId"), "attempt": F.col("attempt")},
    )


def errors(failures: DataFrame, qm: str, source: str) -> DataFrame:
    return events(
        failures,
        "ERROR",
        F.unix_millis("ts"),
        qm,
        source,
        message_id=F.col("messageIdHex"),
        details={"errorMessage": F.col("message"), "errorType": F.col("errorClass")},
    )


def retry_attempts(planned: DataFrame, qm: str, source: str) -> DataFrame:
    return events(
        planned.filter("shouldRetry"),
        "RETRY_ATTEMPT",
        F.unix_millis("nextRetryAt"),
        qm,
        source,
        message_id=F.col("messageIdHex"),
        details={"attempt": F.col("attempt"), "delayMs": F.col("delayMs")},
    )


def parse_errors(parsed: DataFrame, qm: str, source: str) -> DataFrame:
    return events(
        parsed.filter(~F.col("parsed.isSuccess")),
        "PARSE_ERROR",
        F.unix_millis("receivedAt"),
        qm,
        source,
        message_id=F.col("messageIdHex"),
        details={"format": F.col("parsed.format"), "errorMessage": F.col("parsed.error")},
    )


def quarantined(poison: DataFrame, decision: Column, qm: str, source: str) -> DataFrame:
    return events(
        poison,
        "MESSAGE_QUARANTINED",
        F.unix_millis("receivedAt"),
        qm,
        source,
        message_id=F.col("messageIdHex"),
        details={"action": decision["action"], "reason": decision["reason"]},
    )


def connections(attempts: DataFrame, source: str) -> DataFrame:
    kind = F.when(F.col("success"), "CONNECTION_ESTABLISHED").otherwise("CONNECTION_LOST")
    return events(attempts, kind, F.unix_millis("ts"), F.col("queueManager"), source, queue=F.lit(""))


def checkpoint_events(checkpoints: DataFrame, event_type: str, source: str) -> DataFrame:
    """CHECKPOINT_SAVED or CHECKPOINT_LOADED, one per checkpoint."""
    return events(
        checkpoints,
        event_type,
        F.col("createdAt"),
        F.col("queueManager"),
        source,
        message_id=F.col("lastMessageId"),
        details={"partitionId": F.col("partitionId"), "messagesProcessed": F.col("messagesProcessed")},
    )


def redacted(audit: DataFrame) -> DataFrame:
    return audit.withColumn("details", redact_map(F.col("details")))


def console_line() -> Column:
    """``[time] EventType queue=.. qm=.. msgId=..``; the time keeps at least one fractional digit."""
    time = F.date_format(F.timestamp_millis("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS")
    name = F.replace(F.initcap(F.replace(F.lower("eventType"), F.lit("_"), F.lit(" "))), F.lit(" "), F.lit(""))
    return F.concat(
        F.lit("["),
        F.regexp_replace(time, "0{1,2}$", ""),
        F.lit("] "),
        name,
        F.lit(" queue="),
        "queueName",
        F.lit(" qm="),
        "queueManager",
        F.lit(" msgId="),
        F.coalesce("messageId", F.lit("-")),
    )


def json_line() -> Column:
    """One JSON object per event, absent ids as null."""
    return F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"})


def of_type(audit: DataFrame, event_type: str) -> DataFrame:
    return audit.filter(F.col("eventType") == event_type)


def errors_only(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("eventType").rlike("(?i)error|failure"))

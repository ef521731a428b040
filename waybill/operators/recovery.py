"""Retry plans, poison messages, routing and duplicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.failures import classify
from waybill.functions.headers import hex_id
from waybill.functions.retry import RetryPolicy
from waybill.operators.delivery import CONSUMER
from waybill.operators.ordered import first_per_key

# Quarantine actions and their descriptions.
ACTIONS = {
    "MoveToDeadLetter": "Move to dead letter queue",
    "MoveToBackout": "Move to backout queue",
    "Discard": "discard message",
}


def retry_plan(
    failures: DataFrame,
    policy: RetryPolicy = RetryPolicy(),
    classifier: Callable[[Column, Column], Column] = classify,
) -> DataFrame:
    """Add failureType, reason, shouldRetry, delayMs and nextRetryAt to failures (errorClass, message,
    attempt, ts). Delay and time are null where there is no retry. ``classifier`` takes the class and
    the message and gives struct(failureType, reason)."""
    judged = failures.withColumn("_kind", classifier(F.col("errorClass"), F.col("message")))
    retry = policy.should_retry(F.col("attempt"), F.col("_kind.failureType") == "TRANSIENT")
    delayed = judged.withColumns(
        {
            "failureType": F.col("_kind.failureType"),
            "reason": F.col("_kind.reason"),
            "shouldRetry": retry,
            "delayMs": F.when(retry, policy.delay_ms(F.col("attempt"))),
        }
    )
    at = F.timestamp_millis(F.unix_millis("ts") + F.col("delayMs"))
    return delayed.withColumn("nextRetryAt", at).drop("_kind")


def is_poison(backout_count: Column, threshold: Column | int) -> Column:
    return backout_count >= threshold


def remaining_retries(backout_count: Column, threshold: int) -> Column:
    return F.greatest(F.lit(0), F.lit(threshold) - backout_count)


def quarantine_decision(threshold: int, action: str = "MoveToDeadLetter", custom_queue: str | None = None) -> Column:
    """struct(action, description, reason, messageId) for a message taken as poison.

    The threshold is reported, not tested again: filter with ``is_poison`` first.
    """
    text = f"Move to custom queue: {custom_queue}" if custom_queue else ACTIONS[action]
    reason = F.concat(F.lit("Message exceeded backout threshold: "), "backoutCount", F.lit(f" >= {threshold}"))
    return F.struct(
        F.lit("CustomQueue" if custom_queue else action).alias("action"),
        F.lit(text).alias("description"),
        reason.alias("reason"),
        hex_id(F.col("messageId")).alias("messageId"),
    )


def route(
    messages: DataFrame,
    threshold: int,
    action: Column,
    dead_letter: str = "DEAD.LETTER",
    backout: str = "BACKOUT",
) -> DataFrame:
    """Add ``targetQueue``: where each message goes. Healthy messages keep their queue, discarded ones
    get null, and an ``action`` that is none of the fixed ones is itself the name of the target."""
    target = (
        F.when(~is_poison(F.col("backoutCount"), threshold), F.col("queueName"))
        .when(action == "MoveToDeadLetter", F.lit(dead_letter))
        .when(action == "MoveToBackout", F.lit(backout))
        .when(action != "Discard", action)
    )
    return messages.withColumn("targetQueue", target)


def write_routed(routed: DataFrame, path: str, batch_id: int, consumer: str = CONSUMER) -> None:
    """Write every kept message of a batch under its consumer, batch and target queue.

    Writing a batch again replaces it alone, so this can be the handler of a stream (``foreachBatch``).
    """
    (
        routed.filter(F.col("targetQueue").isNotNull())
        .withColumns({"consumer": F.lit(consumer), "batchId": F.lit(batch_id).cast("bigint")})
        .hint("rebalance", "targetQueue")  # well-sized files; a hot target is split over many tasks
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("consumer", "batchId", "targetQueue")
        .parquet(path)
    )


def deduplicate(messages: DataFrame, order: list[Column | str], keys: tuple[str, ...] = ("messageIdHex",)) -> DataFrame:
    """The first copy of every message id in ``order``."""
    return first_per_key(messages, list(keys), order)

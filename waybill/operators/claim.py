"""Bounded reads of unread messages: claim and browse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from waybill.operators.joins import join_dimension
from waybill.operators.ordered import first_n
from waybill.session import materialize

KEY = ["queueName", "messageIdHex"]
QUEUE_ORDER = ["timestamp", "messageIdHex"]

# A claim of at most this many ids (about 100 bytes each) is shipped to every task.
BROADCAST_ROWS = 200_000


def unread(messages: DataFrame, log: DataFrame) -> DataFrame:
    """Messages without a committed delivery."""
    committed = log.filter(F.col("outcome") == "COMMIT").select(*KEY)
    return messages.join(committed, KEY, "left_anti")


def _with_payload(messages: DataFrame, picked: DataFrame, bound: int) -> DataFrame:
    """Full rows of the picked ids.

    The pick is written down first. It stays the same whatever is committed later, and its put times
    bound the second scan: files and row groups outside them are skipped.
    """
    return with_payload(messages, materialize(picked.select(*KEY, "timestamp", "position"), "claim"), bound)


def with_payload(messages: DataFrame, ids: DataFrame, bound: int) -> DataFrame:
    """Full rows of written ``ids`` (key, ``timestamp`` and what else they carry); there are at most ``bound``."""
    micros = F.unix_micros("timestamp")
    first, last = ids.agg(F.min(micros), F.max(micros)).first()
    near = messages
    if first is not None:
        bounds = F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last))
        near = messages.filter(F.col("timestamp").isNull() | F.col("timestamp").between(*bounds))
    ids = ids.drop("timestamp")
    return near.join(F.broadcast(ids) if bound <= BROADCAST_ROWS else ids, KEY)


def settled_until(messages: DataFrame, log: DataFrame, landing: str):
    """The first value of the ``landing`` column that has an unread message, null if there is none.

    ``landing`` says when or in which load a message came into the table (an ingest batch, a file partition).
    It never goes back, unlike put times, so the next claims may be bound to ``F.col(landing) >= value``.
    """
    return unread(messages.select(*KEY, landing), log).agg(F.min(landing)).first()[0]


def claim_batch(
    messages: DataFrame, log: DataFrame, queues: list[str], batch_size: int = 1000, landed: Column | None = None
) -> DataFrame:
    """The first ``batch_size`` unread messages of each named queue, with their ``position``.

    Only ids and put times are shuffled to find the claim; the payload is read afterwards, for the
    claimed ids. ``landed`` is a condition on how messages landed (see ``settled_until``): the rest is known to be
    settled and not read. Put times and the log's clock play no part. Claiming changes nothing: see
    ``delivery.settle``.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    wanted = messages.filter(F.col("queueName").isin(*queues))
    log = log.filter(F.col("queueName").isin(*queues))
    if landed is not None:
        wanted = wanted.filter(landed)
    heads = unread(wanted.select(*KEY, "timestamp"), log)
    picked = first_n(heads, ["queueName"], QUEUE_ORDER, batch_size)
    return _with_payload(wanted, picked, batch_size * len(queues))


def claim_configured(
    messages: DataFrame, log: DataFrame, queue_config: DataFrame, landed: Column | None = None
) -> DataFrame:
    """Like ``claim_batch`` for every enabled queue of ``queue_config``, each with its own batch size."""
    if landed is not None:
        messages = messages.filter(landed)
    enabled = queue_config.filter("enabled").select("queueName", "batchSize")
    size = enabled.agg(F.sum("batchSize").alias("total"), F.max("batchSize").alias("largest")).first()
    heads = unread(join_dimension(messages.select(*KEY, "timestamp"), enabled, ["queueName"]), log)
    picked = first_n(heads, ["queueName"], QUEUE_ORDER, size["largest"] or 1, limit=F.col("batchSize"))
    return _with_payload(messages, picked, size["total"] or 0)


def browse_batch(
    messages: DataFrame,
    log: DataFrame,
    queues: list[str],
    batch_size: int = 1000,
    counter: Observation | None = None,
) -> DataFrame:
    """The rows a claim would return, left unread. ``counter`` receives ``totalBrowsed`` after an action."""
    batch = claim_batch(messages, log, queues, batch_size)
    return batch if counter is None else batch.observe(counter, F.count("*").alias("totalBrowsed"))

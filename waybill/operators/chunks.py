"""Fixed-size payload chunks and reductions over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 64 * 1024


def _starts(payload: Column, chunk_bytes: int) -> Column:
    """Start offsets (from 1) of the chunks; none for an empty payload."""
    size = F.octet_length(payload)
    return F.when(size > 0, F.sequence(F.lit(1), size, F.lit(chunk_bytes))).otherwise(F.array().cast("array<int>"))


def chunk_payloads(messages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row (queueName, messageIdHex, chunkIndex, chunk) per piece of every non-empty payload."""
    pieces = messages.select(
        "queueName", "messageIdHex", "payload", F.posexplode(_starts(F.col("payload"), chunk_bytes)).alias("chunkIndex", "_from")
    )
    chunk = F.substring(F.col("payload"), F.col("_from"), F.lit(chunk_bytes))
    return pieces.select("queueName", "messageIdHex", "chunkIndex", chunk.alias("chunk"))


def reduce_payload(
    payload: Column,
    handler: Callable[[Column], Column],
    combiner: Callable[[Column, Column], Column],
    chunk_bytes: int = CHUNK_BYTES,
) -> Column:
    """``combiner`` over ``handler`` of each chunk, inside the row: no chunk leaves its task.

    Null for an empty payload, which has nothing to combine.
    """
    starts = _starts(payload, chunk_bytes)
    values = F.transform(starts, lambda s: handler(F.substring(payload, s, F.lit(chunk_bytes))))
    rest = F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0)))
    return F.when(F.size(starts) > 0, F.aggregate(rest, F.get(values, F.lit(0)), lambda a, b: combiner(a, b)))


def reduce_chunks(chunks: DataFrame, handled: Column, combine: Callable[[Column], Column], out: str) -> DataFrame:
    """The same over a stored chunk table: ``combine`` is an aggregate, partly applied before the shuffle."""
    return chunks.groupBy("queueName", "messageIdHex").agg(combine(handled).alias(out))

"""Sharding by a two-pass external shuffle.

Pass 1 scatters records uniformly into buckets small enough for a task's memory, by a seeded hash of the key
and the text, shuffles each bucket with a Fisher-Yates shuffle and writes it. Pass 2 lays the buckets end to end:
only their totals are summed up, so every record knows its place in the shuffled whole, and with it its shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from waybill.llm.common import free_name
from waybill.session import materialize

#: Bytes of records a bucket is meant to hold: a task has one in memory.
BUCKET_BYTES = 32_000_000
#: Records of a bucket that are sent on together.
SENT_ROWS = 1_000
#: Totals of so many buckets (about 100 bytes each) are sent to every task.
BROADCAST_BUCKETS = 100_000
#: Buckets at least, so that small tables use the cluster too.
LEAST_BUCKETS = 32


def fisher_yates(count: int, seed: int) -> np.ndarray:
    """A uniform permutation of ``count`` places: each draws its partner among those not yet settled."""
    random = np.random.default_rng(seed)
    partner = random.integers(np.arange(count), count).tolist()
    order = list(range(count))
    for at, other in enumerate(partner):
        order[at], order[other] = order[other], order[at]
    return np.array(order, np.int64)


def _bytes(docs: DataFrame) -> Column:
    """About the bytes a row takes in memory."""
    parts = [F.lit(64)]
    for name, kind in docs.dtypes:
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(name), F.lit(0)))
        elif kind.startswith(("array", "map", "struct")):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)))
    return sum(parts[1:], parts[0]).cast("long")


def shuffled(docs: DataFrame, seed: int = 0, key: str = "doc_id", text: str = "text", part: Column | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, part, bucket, record, at, in_size, in_part``: every row, written bucket by bucket.

    ``record`` is the whole row, text included; ``at`` is its place in its shuffled bucket, ``in_size`` the bytes and
    ``in_part`` the rows of its ``part`` before it there. ``size`` is the text's UTF-8 bytes plus 1, a null text being
    the empty one. A row number of the scan's task is mixed into the hash of key and text, so repeated rows spread
    over the buckets too. The files are written once, in shuffled order, and all that follows reads them.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    total = docs.agg(F.coalesce(F.sum(_bytes(docs)), F.lit(0)).alias("bytes")).first()["bytes"]
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    record = F.struct(*[F.col(c) for c in docs.columns])
    source = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(plain) + 1).cast("long").alias("size"),
        F.crc32(plain.cast("binary")).alias("text_crc32"),
        (F.lit(0) if part is None else part).cast("int").alias("part"),
        record.alias("record"),
    )
    number = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size", F.monotonically_increasing_id()), F.lit(buckets))
    dealt = source.select("doc_id", "size", "text_crc32", "part", number.alias("bucket"), "record")
    # Tasks follow the buckets, so that a task has two of them however large the table is.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-buckets // 2))
    dealt = dealt.repartition(tasks, "bucket").sortWithinPartitions("bucket", "doc_id", "text_crc32", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            number = batch.column(4).to_numpy()
            cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                if end == begin:
                    continue
                piece = batch.slice(begin, end - begin)
                if held and held[0].column(4)[0] != piece.column(4)[0]:
                    yield from settle(held)
                    held = []
                held.append(piece)
        if held:
            yield from settle(held)

    def settle(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        order = fisher_yates(len(whole), seed * 1_000_003 + whole.column(4)[0].as_py())
        sizes, parts = whole.column(1).to_numpy()[order], whole.column(3).to_numpy()[order]
        at = np.arange(len(order))
        in_size, in_part = np.cumsum(sizes) - sizes, np.empty(len(order), np.int64)
        for one in np.unique(parts):
            mine = parts == one
            in_part[mine] = np.arange(mine.sum())
        # Piece by piece, so that the bucket is in memory once and not twice.
        for begin in range(0, len(order), SENT_ROWS):
            piece = slice(begin, begin + SENT_ROWS)
            moved = whole.take(pa.array(order[piece]))
            for name, values in (("at", at), ("in_size", in_size), ("in_part", in_part)):
                moved = moved.append_column(name, pa.array(values[piece], pa.int64()))
            yield from moved.combine_chunks().to_batches()

    schema = StructType([*dealt.schema.fields, *[StructField(c, LongType()) for c in ("at", "in_size", "in_part")]])
    return materialize(dealt.mapInArrow(run, schema), "buckets")


def _before(totals: DataFrame, columns: list[str]) -> DataFrame:
    """Running totals before each bucket: summed per 1,024 buckets first, so that one task adds a few numbers only."""
    grouped = totals.withColumn("part", F.floor(F.col("bucket") / 1024))
    within = Window.partitionBy("part").orderBy("bucket")
    parts = grouped.groupBy("part").agg(*[F.sum(c).alias(f"p_{c}") for c in columns])
    over = Window.orderBy("part")
    parts = parts.select(F.col("part").alias("_part"), *[(F.sum(f"p_{c}").over(over) - F.col(f"p_{c}")).alias(f"p_{c}") for c in columns])
    joined = grouped.join(parts, F.col("part") == F.col("_part"))
    return joined.select("bucket", *[(F.sum(c).over(within) - F.col(c) + F.col(f"p_{c}")).alias(f"before_{c}") for c in columns])


def _placed(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` with ``before_rows``, ``before_size`` and ``before_part``: what lies before the row in the shuffled whole.

    Only the totals of the buckets are summed up and, up to ``BROADCAST_BUCKETS`` of them, sent to all tasks, so the
    records stay where they are. More are joined by a shuffle of the records; buckets are of one size, so none is hot.
    """
    names = [f"part{k}" for k in range(parts)]
    counts = [F.sum((F.col("part") == k).cast("long")).alias(n) for k, n in enumerate(names)]
    totals = rows.groupBy("bucket").agg(F.count("*").alias("rows"), F.sum("size").alias("size"), *counts)
    before = _before(totals, ["rows", "size", *names])
    few = totals.limit(BROADCAST_BUCKETS + 1).count() <= BROADCAST_BUCKETS
    joined = rows.join(F.broadcast(before) if few else before, "bucket")
    return joined.withColumns(
        {
            "before_rows": F.col("before_rows") + F.col("at"),
            "before_size": F.col("before_size") + F.col("in_size"),
            "before_part": F.get(F.array(*[F.col(f"before_{n}") for n in names]), F.col("part")) + F.col("in_part"),
        }
    ).drop(*[f"before_{n}" for n in names])


def jump_hash(key: Column, shards: int) -> Column:
    """Shard of a key so that one more shard takes keys from all others and moves no other key.

    Each shard in turn takes over a key with probability 1 / (its number + 1), by a hash of key and number;
    the last to take it has it.
    """
    shard = F.lit(0)
    for number in range(1, shards):
        shard = F.when(F.pmod(F.xxhash64(key, F.lit(number)), F.lit(number + 1)) == 0, number).otherwise(shard)
    return shard


def assign(docs: DataFrame, shards: int = 8, law: str = "bytes", seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every row into a shard: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, record``.

    ``bytes``: the shuffled whole is cut where its bytes reach each shard's share, so shards differ by at most about one
    record. ``rows``: the place modulo the shards, so counts differ by at most one. ``key``: key and shard count alone
    decide. ``grown_shard`` is the shard among one more under the law ``key``, otherwise null. ``slot`` numbers the
    rows of a shard from 0 without gaps, in shuffled order. Null texts count as empty, null keys as one key.
    ``record`` is the whole row, read from the shuffled buckets.
    """
    if law not in ("bytes", "rows", "key"):
        raise ValueError(f"law {law!r} is none of bytes, rows, key")
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rows = shuffled(docs, seed, key, text, jump_hash(name, shards) if law == "key" else None)
    placed = _placed(rows, shards if law == "key" else 1)
    grown = F.lit(None).cast("int")
    if law == "key":
        grown = jump_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), shards + 1)
        out = placed.withColumn("shard", F.col("part")).withColumn("slot", F.col("before_part"))
    elif law == "rows":
        out = placed.withColumn("shard", F.pmod(F.col("before_rows"), F.lit(shards))).withColumn("slot", F.floor(F.col("before_rows") / shards))
    else:
        total = rows.agg(F.coalesce(F.sum("size"), F.lit(1)).alias("bytes")).first()["bytes"]
        # A record belongs to the shard in whose share its middle byte lies.
        middle = 2 * F.col("before_size") + F.col("size")
        shard = F.least(F.floor(middle * shards / (2 * total)), F.lit(shards - 1))
        out = placed.withColumn("shard", shard.cast("int"))
        first = out.groupBy("shard").agg(F.min("before_rows").alias("first"))
        out = out.join(F.broadcast(first), "shard").withColumn("slot", F.col("before_rows") - F.col("first"))
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(law).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        grown.cast("int").alias("grown_shard"),
        "record",
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, key: str = "doc_id") -> tuple[str, str]:
    """Write the records of ``assigned``, made from ``docs``, in shard folders, every file in slot order.

    The records come from the shuffled buckets, so null and repeated keys are kept as they are. Gives the names of the
    columns of shard and slot: ``shard`` and ``slot``, with underscores in front where the table has such columns
    itself. An empty table leaves an empty folder, which ``read_shards`` reads as no rows.
    """
    shard, slot = (free_name(docs.columns, c) for c in ("shard", "slot"))
    records = assigned.select(*[F.col("record")[c].alias(c) for c in docs.columns], F.col("shard").alias(shard), F.col("slot").alias(slot))
    records.sortWithinPartitions(shard, slot).write.partitionBy(shard).mode("overwrite").parquet(path)
    return shard, slot


def read_shards(docs: DataFrame, path: str, names: tuple[str, str]) -> DataFrame:
    """What ``write_shards`` wrote of ``docs``: its columns and the two named ones."""
    shard, slot = names
    schema = StructType([*docs.schema.fields, StructField(slot, LongType()), StructField(shard, IntegerType())])
    return docs.sparkSession.read.schema(schema).parquet(path)

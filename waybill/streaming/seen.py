"""Duplicates of any age over a stream: a filter of ids in front of an exact table of them.

Every micro-batch leaves its new ids in a table dealt into buckets, and the bits that they set in a Bloom filter per bucket,
as bitmaps of 32,768 bits. An id whose bits aren't all set was never seen. Only the others are looked up, in the buckets
that they fall into, so a filter that is full costs time and never a message. Nothing is kept in the stream's state, and
no watermark bounds how old a copy may be.

Ids and bits of a batch count from one entry on (``sources.manifest``), so a batch that is replayed does not find itself.
"""

from __future__ import annotations

import json
import operator
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill.operators.ordered import first_per_key
from waybill.session import materialize
from waybill.sources.manifest import put_if_absent, read_entries

ENTRIES, IDS, BITS = "_seen", "ids", "bits"
SEGMENT_BITS = 32_768
#: Filters up to this size are sent to every task whole; the probes of larger ones are dealt out to their segments.
SENT_BYTES = 64 * 1024 * 1024
_ENTRY = "batch bigint, mark string"
_IDS = "id string, bucket int, mark string"
_BITS = "bucket int, segment int, bits binary, mark string"


@dataclass(frozen=True)
class Seen:
    """Where seen ids are kept. ``buckets`` and ``segments`` stay as they are for a ``root``.

    A bucket's filter has ``segments`` times 32,768 bits and works well up to a tenth of as many ids.
    """

    root: str
    buckets: int = 64
    segments: int = 16
    probes: int = 4

    def bucket(self, name: Column) -> Column:
        return F.pmod(F.xxhash64(name, F.lit(0)), F.lit(self.buckets)).cast("int")

    def marks(self, spark: SparkSession, batch_id: int) -> list[str]:
        """Folders of all batches but this one."""
        entries = read_entries(spark, f"{self.root}/{ENTRIES}", _ENTRY)
        return [r["mark"] for r in entries.where(F.col("batch") != batch_id).select("mark").collect()]

    def _places(self, name: Column) -> list[Column]:
        """The bits of an id in the filter of its bucket."""
        size = self.segments * SEGMENT_BITS
        first, step = F.xxhash64(name, F.lit(1)), F.xxhash64(name, F.lit(2))
        return [F.pmod(F.xxhash64(first, step, F.lit(k)), F.lit(size)) for k in range(self.probes)]

    def _bits_of(self, ids: DataFrame) -> DataFrame:
        """``id, bucket, segment, place`` of every bit of an id."""
        places = F.array_distinct(F.array(*self._places(F.col("id"))))
        bits = ids.select("id", self.bucket(F.col("id")).alias("bucket"), F.explode(places).alias("_bit"))
        segment, place = F.floor(F.col("_bit") / SEGMENT_BITS), F.col("_bit") % SEGMENT_BITS
        return bits.select("id", "bucket", segment.cast("int").alias("segment"), place.alias("place"))

    def suspects(self, ids: DataFrame, batch_id: int) -> DataFrame:
        """Those of ``ids (id)`` that may have been seen: all that were, and a few others."""
        marks = self.marks(ids.sparkSession, batch_id)
        return self._suspected(ids, "id", marks).where("_suspect").select("id").distinct() if marks else ids.limit(0)

    def _suspected(self, rows: DataFrame, key: str, marks: list[str]) -> DataFrame:
        """``rows``, none without an id, and ``_suspect``: whether all bits of a row's id are set."""
        stored = rows.sparkSession.read.schema(_BITS).parquet(f"{self.root}/{BITS}").where(F.col("mark").isin(marks))
        merged = stored.groupBy("bucket", "segment").agg(F.bitmap_or_agg("bits").alias("bits"))
        if self.buckets * self.segments * SEGMENT_BITS // 8 > SENT_BYTES:
            probes = self._bits_of(rows.select(F.col(key).alias("id")).distinct()).join(merged, ["bucket", "segment"], "left")
            full = probes.groupBy("id").agg(F.bool_and(_is_set(F.col("bits"), F.col("place"))).alias("_suspect"))
            return rows.join(full.where("_suspect").withColumnRenamed("id", key), key, "left").select(
                *rows.columns, F.coalesce("_suspect", F.lit(False)).alias("_suspect")
            )
        by_segment = F.map_from_entries(F.collect_list(F.struct("segment", "bits")))
        filters = merged.groupBy(F.col("bucket").alias("_bucket")).agg(by_segment.alias("_map"))
        whole = F.transform(F.sequence(F.lit(0), F.lit(self.segments - 1)), lambda s: F.try_element_at("_map", s))
        filters = F.broadcast(filters.select("_bucket", whole.alias("_filter")))
        set_bits = [
            _is_set(F.get("_filter", F.floor(p / SEGMENT_BITS).cast("int")), p % SEGMENT_BITS) for p in self._places(F.col(key))
        ]
        probed = rows.join(filters, self.bucket(F.col(key)) == F.col("_bucket"), "left")
        return probed.select(*rows.columns, reduce(operator.and_, set_bits).alias("_suspect"))

    def unseen(self, batch: DataFrame, batch_id: int, key: str = "messageIdHex") -> DataFrame:
        """The first message of every id of ``batch`` that no earlier batch had; rows without an id are all kept.

        They are written before they are returned: Spark computes cached plans anew when a folder that they read is written to.
        """
        spark = batch.sparkSession
        marks = self.marks(spark, batch_id)
        named, nameless = batch.where(F.col(key).isNotNull()), batch.where(F.col(key).isNull())
        once = first_per_key(named, [key], ["timestamp", F.xxhash64(*_plain(batch))])
        if not marks:
            return materialize(once.unionByName(nameless), "unseen")
        marked = self._suspected(once, key, marks).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            suspects, fresh = marked.where("_suspect").drop("_suspect"), marked.where("NOT _suspect").drop("_suspect")
            places = [r["bucket"] for r in suspects.select(self.bucket(F.col(key)).alias("bucket")).distinct().collect()]
            if places:
                stored = spark.read.schema(_IDS).parquet(f"{self.root}/{IDS}")
                stored = stored.where(F.col("bucket").isin(places) & F.col("mark").isin(marks))
                found = suspects.join(stored.select(F.col("id").alias(key)), key, "left_anti").select(batch.columns)
                fresh = fresh.unionByName(found)
            return materialize(fresh.unionByName(nameless), "unseen")
        finally:
            marked.unpersist()

    def remember(self, rows: DataFrame, batch_id: int, key: str = "messageIdHex") -> bool:
        """Keep the ids of a batch's rows. False, and nothing kept, if the batch has been remembered before."""
        mark = uuid.uuid4().hex
        ids = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("id"))
        dealt = ids.withColumn("bucket", self.bucket(F.col("id"))).repartition("bucket").distinct().withColumn("mark", F.lit(mark))
        dealt.write.mode("append").partitionBy("bucket", "mark").parquet(f"{self.root}/{IDS}")
        bits = self._bits_of(ids).groupBy("bucket", "segment").agg(F.bitmap_construct_agg("place").alias("bits"))
        bits.withColumn("mark", F.lit(mark)).write.mode("append").partitionBy("mark").parquet(f"{self.root}/{BITS}")
        name = f"{self.root}/{ENTRIES}/{batch_id:012d}.json"
        return put_if_absent(rows.sparkSession, name, json.dumps({"batch": batch_id, "mark": mark}))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    return F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))


def _plain(df: DataFrame) -> list[Column]:
    """Columns that can be hashed, to choose among copies of one time."""
    return [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]


def deduplicate_each_batch(
    messages: DataFrame,
    handle: Callable[[DataFrame, int], None],
    seen: Seen,
    checkpoint: str,
    key: str = "messageIdHex",
    available_now: bool = True,
) -> StreamingQuery:
    """Hand the messages of each micro-batch that no earlier one had to ``handle``, then remember their ids.

    A batch that fails in between is replayed with the same messages, so ``handle`` must overwrite what it wrote for
    its id. One stream at a time may use a ``root``.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        fresh = seen.unseen(batch, batch_id, key)
        handle(fresh, batch_id)
        seen.remember(fresh, batch_id, key)

    writer = messages.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()

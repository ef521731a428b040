"""What of a landed table is settled, as bitmaps of row places, so a claim never joins the delivery log.

A settled row is one bit: its file, the bucket of 32,768 rows it lies in, its place there. Every batch adds a folder of
bitmaps and a numbered entry that names it; a compaction merges the folders that are live into one and names those it
replaces. Entries are only ever added, and merging twice changes nothing, so settling and compaction need no lock.

A claim reads files that have unread rows, and of those only keys: it costs what is unread, however long the log is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waybill.operators.claim import KEY, QUEUE_ORDER, with_payload
from waybill.operators.ordered import first_n
from waybill.session import materialize
from waybill.sources.landed import loads, read_landed
from waybill.sources.manifest import latest_version, put_entry, read_entries
from waybill.sources.messages import TABLE_SCHEMA

ADDRESS = ["landedFile", "landedRow"]
ENTRIES, MARKS = "_settled", "marks"
_ENTRY = "mark string, replaces array<string>"
_BITMAPS = "landedFile string, bucket bigint, bits binary, n bigint, mark string"


def _bucket() -> Column:
    return F.bitmap_bucket_number(F.col("landedRow") + 1)


def _add(spark: SparkSession, root: str, bitmaps: DataFrame, replaces: list[str]) -> str:
    mark = uuid.uuid4().hex
    bitmaps.select("landedFile", "bucket", "bits", F.bitmap_count("bits").alias("n")).write.parquet(f"{root}/{MARKS}/mark={mark}")
    while True:
        version = latest_version(read_entries(spark, f"{root}/{ENTRIES}", _ENTRY)) + 1
        if put_entry(spark, f"{root}/{ENTRIES}", version, {"mark": mark, "replaces": replaces}):
            return mark


def settle(rows: DataFrame, root: str) -> None:
    """Mark rows (``landedFile``, ``landedRow``) as done with. Marking a row again changes nothing."""
    position = F.bitmap_bit_position(F.col("landedRow") + 1)
    bitmaps = rows.groupBy("landedFile", _bucket().alias("bucket")).agg(F.bitmap_construct_agg(position).alias("bits"))
    _add(rows.sparkSession, root, bitmaps, [])


def live_marks(spark: SparkSession, root: str) -> list[str]:
    """Folders whose bitmaps count: one from the last compaction and one for each batch since."""
    entries = read_entries(spark, f"{root}/{ENTRIES}", _ENTRY)
    gone = entries.select(F.explode("replaces").alias("mark"))
    return sorted(r["mark"] for r in entries.select("mark").join(gone, "mark", "left_anti").collect())


def settled(spark: SparkSession, root: str) -> DataFrame:
    """``landedFile, bucket, bits, n``: the bitmaps of all live folders, merged."""
    return _merged(spark, root, live_marks(spark, root))


def _merged(spark: SparkSession, root: str, marks: list[str]) -> DataFrame:
    if not marks:
        return spark.createDataFrame([], _BITMAPS).drop("mark")
    found = spark.read.schema(_BITMAPS).option("basePath", f"{root}/{MARKS}").parquet(*[f"{root}/{MARKS}/mark={m}" for m in marks])
    merged = found.groupBy("landedFile", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.withColumn("n", F.bitmap_count("bits"))


def compact(spark: SparkSession, root: str) -> None:
    """Merge the live folders into one. Batches settled meanwhile stay live beside it."""
    marks = live_marks(spark, root)
    if len(marks) > 1:
        _add(spark, root, _merged(spark, root, marks), marks)


def progress(spark: SparkSession, path: str, root: str) -> DataFrame:
    """``version, queueName, landedFile, rows, settled`` of every landed file."""
    files = loads(spark, path).select("version", F.explode("files").alias("f"))
    files = files.select("version", F.col("f.queue").alias("queueName"), F.col("f.file").alias("landedFile"), "f.rows")
    done = settled(spark, root).groupBy("landedFile").agg(F.sum("n").alias("settled"))
    return files.join(done, "landedFile", "left").withColumn("settled", F.coalesce("settled", F.lit(0)))


def unsettled(spark: SparkSession, path: str, root: str, queues: list[str] | None = None, schema: StructType = TABLE_SCHEMA) -> DataFrame:
    """Landed rows that are not settled, with their address. Files that are settled as a whole are not read.

    What is collected is one name for each file with unread rows, as a reader of files lists them anyway.
    """
    state = materialize(progress(spark, path, root), "settled-files")
    if queues is not None:
        state = state.where(F.col("queueName").isin(*queues))
    partly = state.where(F.col("settled") < F.col("rows"))
    files = [r["landedFile"] for r in partly.select("landedFile").collect()]
    rows = read_landed(spark, path, schema, files)
    bitmaps = settled(spark, root).join(partly.where("settled > 0").select("landedFile"), "landedFile", "left_semi")
    marked = rows.withColumn("bucket", _bucket()).join(bitmaps.select("landedFile", "bucket", "bits"), ["landedFile", "bucket"], "left")
    place = F.bitmap_bit_position(F.col("landedRow") + 1)
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    is_set = F.getbit(byte, (place % 8).cast("int")) == 1
    return marked.where(~F.coalesce(is_set, F.lit(False))).select(*rows.columns)


def claim_landed(
    spark: SparkSession, path: str, root: str, queues: list[str], batch_size: int = 1000, schema: StructType = TABLE_SCHEMA
) -> DataFrame:
    """The first ``batch_size`` unsettled messages of each queue, as ``claim.claim_batch`` gives them, with their address.

    Hand the result, or its keys, to ``settle`` once it is done with.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    keys = StructType([schema[c] for c in dict.fromkeys([*KEY, *QUEUE_ORDER])])
    heads = unsettled(spark, path, root, queues, keys)
    picked = materialize(first_n(heads, ["queueName"], QUEUE_ORDER, batch_size), "claim")
    files = [r["landedFile"] for r in picked.select("landedFile").distinct().collect()]
    messages = read_landed(spark, path, schema, files)
    return with_payload(messages.drop(*ADDRESS), picked, batch_size * len(queues))

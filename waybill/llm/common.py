"""What the text operators share: reading a table and passing text columns through Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waybill.session import materialize

TOKENIZER_FOLDER = "public_tokenizers"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the installed package of public tokenizer files keeps ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def keyed_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text, a null text as the empty one; other columns can't clash with results."""
    return df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def free_name(columns: list[str], name: str) -> str:
    """``name``, with as many underscores in front as it takes to be none of ``columns`` (in either case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The texts of a batch one after another, without holding all of them as Python strings."""
    return (value.as_py() for value in batch.column(batch.schema.get_field_index(name)))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of the texts of a batch."""
    column = batch.column(batch.schema.get_field_index(name))
    return (value.as_py() for value in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``name`` 1, 2, 3 .. in ``order``, which must tell all rows apart to keep ranges even.

    Rows are laid out in ranges of the order and written, numbered inside each range, and moved on by the rows of the
    ranges before: of those only the counts, one row for each range, are summed up in one place.
    """
    ranged = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    laid = materialize(ranged, "ranges")
    counts = laid.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    # One row for each range: as many as a shuffle has partitions.
    joined = laid.join(F.broadcast(starts), "_range")
    return joined.withColumn(name, (F.col("_start") + place).cast("long")).drop("_range", "_start")

"""Ordered work that stays parallel when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.session import materialize

SALTS = 256


def first_n(
    df: DataFrame,
    keys: list[str],
    order: list[Column | str],
    n: int,
    limit: Column | None = None,
    rank: str = "position",
) -> DataFrame:
    """The first ``n`` rows of every key group in ``order``, numbered from 1 in column ``rank``.

    ``limit`` may lower the bound per row group. Rows are cut three times: each task keeps n per key
    before any shuffle, each (key, salt) group keeps n, and the last window sees at most n x SALTS rows
    per key, however large the key is. The salt only decides where a row is cut, never the result.
    """
    bound = F.lit(n) if limit is None else F.least(F.lit(n), limit)
    salted = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    cut = (
        df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        .withColumn("_rank", F.row_number().over(salted))
        .filter((F.col("_rank") <= n) & (F.col("_rank") <= bound))
        .drop("_salt", "_rank")
    )
    ranked = cut.withColumn(rank, F.row_number().over(whole)).filter(F.col(rank) <= n)
    return ranked if limit is None else ranked.filter(F.col(rank) <= bound)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``. Each task keeps one row per key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def running_total(df: DataFrame, value: str, position: str, width: int, out: str) -> DataFrame:
    """Running sum of ``value`` in order of the whole number ``position``.

    Positions are cut into ranges of ``width``: the ranges are summed in parallel, only their totals
    (rows / width of them) are accumulated in one place, and each range then runs on from its start.
    """
    ranged = df.withColumn("_range", F.floor(F.col(position) / width))
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(starts, "_range")
        .withColumn(out, F.col("_start") + F.sum(value).over(inside))
        .drop("_range", "_start")
    )


def previous_value(
    df: DataFrame,
    key: str,
    order: list[str],
    value: Column,
    out: str,
    per_key: DataFrame | None = None,
) -> DataFrame:
    """The last non-null ``value`` strictly before each row of its key in ``order``.

    Rows are laid out by ranges of (key, order), so slices are of even size even where one key, or one
    time of one key, holds much of the data. A slice's last value per key is a plain aggregate, slices
    are chained per key, and rows are only sorted within their slice. The layout is written down, as
    both steps must see the same slices. Columns of ``per_key`` (one row per key) come along with the
    slices, so they need no join of all rows on the key.
    """
    ranged = df.withColumn("_value", value).repartitionByRange(key, *order)
    sliced = materialize(ranged.withColumn("_slice", F.spark_partition_id()), "slices")
    position = F.when(F.col("_value").isNotNull(), F.struct(*order))
    last = sliced.groupBy(key, "_slice").agg(F.max_by("_value", position).alias("_last"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(key, "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    if per_key is not None:
        carried = carried.join(per_key, key)
    inside = Window.partitionBy(key, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.join(carried, [key, "_slice"])
        .withColumn(out, F.coalesce(F.last("_value", ignorenulls=True).over(inside), F.col("_carried")))
        .drop("_slice", "_value", "_carried")
    )

"""Joins against tables with one row per key, when one key may hold much of the other side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampType

BROADCAST_ROWS = 100_000
SALTS = 32


def join_dimension(df: DataFrame, dimension: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join a settings table. It is counted first: small ones are broadcast, others joined with salt."""
    if dimension.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(dimension), keys, how)
    return salted_join(df, dimension, keys, how)


def salt_columns(df: DataFrame) -> list[Column]:
    """What spreads rows: the message id where there is one, else the numbers, times and texts of a row.

    Maps and variants cannot be hashed, and payloads are not worth reading for it; equal rows of different
    tasks are told apart by the task.
    """
    if "messageIdHex" in df.columns:
        return [F.col("messageIdHex")]
    plain = (NumericType, StringType, TimestampType, DateType, BooleanType)
    return [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, plain)]


def salted_join(df: DataFrame, dimension: DataFrame, keys: list[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join with every key of ``df`` spread over ``salts`` tasks; the dimension is repeated for each."""
    left = df.withColumn("_salt", F.pmod(F.xxhash64(F.spark_partition_id(), *salt_columns(df)), F.lit(salts)).cast("int"))
    right = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")

"""Message schemas and the projections onto them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DataType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from waybill.functions.charset import decode_payload

# The canonical message columns, in order.
CANONICAL = StructType(
    [
        StructField("messageId", BinaryType(), False),
        StructField("correlationId", BinaryType(), True),
        StructField("payload", BinaryType(), False),
        StructField("payloadString", StringType(), True),
        StructField("timestamp", TimestampType(), False),
        StructField("queueName", StringType(), False),
        StructField("ccsid", IntegerType(), False),
        StructField("encoding", IntegerType(), False),
        StructField("priority", IntegerType(), False),
        StructField("expiry", IntegerType(), False),
        StructField("backoutCount", IntegerType(), False),
        StructField("replyToQueue", StringType(), True),
        StructField("replyToQueueManager", StringType(), True),
        StructField("format", StringType(), True),
        StructField("persistence", IntegerType(), False),
        StructField("messageType", IntegerType(), False),
        StructField("userId", StringType(), True),
        StructField("applicationName", StringType(), True),
        StructField("putApplicationType", IntegerType(), False),
        StructField("groupId", BinaryType(), True),
        StructField("messageSequenceNumber", IntegerType(), False),
    ]
)

# Header values a producer may leave out.
DEFAULTS = {
    "ccsid": 1208,
    "encoding": 546,
    "priority": 4,
    "expiry": -1,
    "backoutCount": 0,
    "persistence": 0,
    "messageType": 8,
    "putApplicationType": 0,
    "messageSequenceNumber": 1,
}

# Text headers where blank means absent.
BLANK_IS_NULL = ("replyToQueue", "replyToQueueManager", "userId", "applicationName")


def subset(*names: str) -> StructType:
    """The canonical fields with these names, in the given order."""
    return StructType([CANONICAL[name] for name in names])


MINIMAL = subset("messageId", "payload", "timestamp")
METADATA = subset("ccsid", "encoding", "priority", "expiry", "backoutCount", "format")
REPLY_TO = subset("replyToQueue", "replyToQueueManager")


def with_field(schema: StructType, name: str, data_type: DataType, nullable: bool = True) -> StructType:
    """``schema`` plus one caller-defined column; messages have no value for it, so it reads as null."""
    return StructType([*schema.fields, StructField(name, data_type, nullable)])


def _value(df: DataFrame, field: StructField) -> Column:
    have = set(df.columns)
    known = field.name in CANONICAL.fieldNames()
    if field.name == "payloadString" and "payload" in have:
        ccsid = F.col("ccsid") if "ccsid" in have else F.lit(DEFAULTS["ccsid"])
        return decode_payload(F.col("payload"), ccsid)
    if not known or field.name not in have:
        return F.lit(DEFAULTS.get(field.name) if known else None)
    value = F.col(field.name)
    if field.name in BLANK_IS_NULL:
        return F.when(F.trim(value) != "", value)
    if field.name == "format":
        return F.trim(F.coalesce(value, F.lit("")))
    if field.name == "groupId":
        return F.when(F.hex(value).rlike("[1-9A-F]"), value)
    if field.name in DEFAULTS:
        return F.coalesce(value, F.lit(DEFAULTS[field.name]))
    return value


def project(df: DataFrame, schema: StructType = CANONICAL) -> DataFrame:
    """Project raw messages onto ``schema`` by column name; a column messages do not have is null."""
    return df.select(*[_value(df, f).cast(f.dataType).alias(f.name) for f in schema.fields])

"""Envelope views: tables of other shapes read as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.charset import decode_payload
from waybill.functions.headers import payload_size

EPOCH = "1970-01-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def key_hex(key: Column) -> Column:
    """24-byte message id of a whole-number key, as hex."""
    return F.lpad(F.lower(F.hex(key)), 48, "0")


def as_messages(
    df: DataFrame,
    key: Column,
    queue: Column,
    payload: Column,
    put_at: Column | None = None,
    extra: tuple[str, ...] = (),
    **headers: Column,
) -> DataFrame:
    """Message table rows built from any table; headers not given take their defaults.

    ``extra`` names columns of ``df`` to keep beside the message columns.
    """
    # millisecond input, like every put time
    put = F.timestamp_millis(F.unix_millis((put_at if put_at is not None else F.lit(EPOCH)).cast("timestamp")))
    none = F.lit(None)
    ints = {"ccsid": 1208, "encoding": 546, "priority": 4, "expiry": -1, "backoutCount": 0}
    tail = {"persistence": 0, "messageType": 8}
    texts = ("replyToQueue", "replyToQueueManager")
    correlation = headers.get("correlationIdHex", F.lit(""))
    body = payload.cast("binary")
    ccsid = headers.get("ccsid", F.lit(1208))
    columns = {
        "messageId": F.unhex(key_hex(key)),
        "correlationId": F.unhex(correlation),
        "payload": body,
        "payloadString": decode_payload(body, ccsid),
        "timestamp": put,
        "queueName": queue,
        **{n: headers.get(n, F.lit(v)).cast("int") for n, v in ints.items()},
        **{n: headers.get(n, none).cast("string") for n in texts},
        "format": headers.get("format", F.lit("MQSTR")),
        **{n: headers.get(n, F.lit(v)).cast("int") for n, v in tail.items()},
        "userId": headers.get("userId", none).cast("string"),
        "applicationName": headers.get("applicationName", none).cast("string"),
        "putApplicationType": F.lit(0),
        "groupId": F.unhex(headers["groupIdHex"]) if "groupIdHex" in headers else none.cast("binary"),
        "messageSequenceNumber": headers.get("messageSequenceNumber", F.lit(1)).cast("int"),
        "messageIdHex": key_hex(key),
        "correlationIdHex": correlation,
        "receivedAt": headers.get("receivedAt", put),
        "payloadSize": payload_size(body),
    }
    return df.select(*[c.alias(n) for n, c in columns.items()], *extra)


def event_messages(events: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """``events`` rows as messages, one queue per event type; ``extra`` keeps source columns."""
    key = F.col("event_id")
    put_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    formats = F.array(*[F.lit(f) for f in ("MQSTR", "JSON", "", "XML")])
    return as_messages(
        events,
        key,
        F.concat(F.lit("QUEUE."), F.upper("event_type")),
        F.col("props"),
        F.col("ts"),
        extra,
        correlationIdHex=key_hex(F.col("user_id")),
        priority=key % 10,
        backoutCount=key % 7,
        format=F.get(formats, (key % 4).cast("int")),
        persistence=key % 2,
        userId=F.concat(F.lit("user"), F.col("user_id")),
        receivedAt=F.timestamp_millis(put_ms + key % 5000),
    )


def document_messages(documents: DataFrame) -> DataFrame:
    return as_messages(documents, F.col("doc_id"), F.concat(F.lit("DOC."), F.upper("lang")), F.col("text"))


def page_messages(pages: DataFrame) -> DataFrame:
    return as_messages(pages, F.col("page_id"), F.lit("PAGE"), F.col("html"), format=F.lit("XML"))


def conversation_messages(conversations: DataFrame) -> DataFrame:
    return as_messages(
        conversations,
        F.col("conv_id") * 1000 + F.col("turn"),
        F.concat(F.lit("CHAT."), F.upper("role")),
        F.col("text"),
        F.timestamp_millis(F.col("turn")),
        groupIdHex=key_hex(F.col("conv_id")),
        messageSequenceNumber=F.col("turn") + 1,
    )


def order_messages(orders: DataFrame) -> DataFrame:
    xml = F.concat(
        F.lit('<order id="'), "o_orderkey", F.lit('"><cust>'), "o_custkey", F.lit("</cust></order>")
    )
    return as_messages(orders, F.col("o_orderkey"), F.lit("ORDER"), xml, F.col("o_orderdate"), format=F.lit("XML"))


def line_messages(lineitem: DataFrame) -> DataFrame:
    """Order lines; the key repeats with different payloads, like redelivered messages."""
    json = F.concat(
        F.lit('{"o":'), "l_orderkey", F.lit(',"l":'), "l_linenumber", F.lit(',"p":'), "l_partkey", F.lit("}")
    )
    return as_messages(
        lineitem,
        F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        F.lit("LINE"),
        json,
        F.col("l_shipdate"),
        ("l_partkey", "l_suppkey"),
        format=F.lit("JSON"),
    )

"""Queries over headers and payloads: projections, formats, parsing, sizes, chunks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from waybill import schema
from waybill.functions import charset, formats, headers, parsing, redact, sizes
from waybill.operators import chunks, offload, parse
from waybill.plans import views
from waybill.plans.registry import query
from waybill.session import shared_dir
from waybill.sources import envelopes
from waybill.sources.envelopes import table


@query(
    "canonical_projection",
    views.CHATS
    + """SELECT id AS "messageIdHex", '' AS "correlationIdHex", body AS "payloadString", turn AS "timestampMs",
    q AS "queueName", 1208::BIGINT AS ccsid, 546::BIGINT AS encoding, 4::BIGINT AS priority, (-1)::BIGINT AS expiry, 0::BIGINT AS "backoutCount",
    NULL::VARCHAR AS "replyToQueue", NULL::VARCHAR AS "replyToQueueManager", 'MQSTR' AS format, 0::BIGINT AS persistence,
    8::BIGINT AS "messageType", NULL::VARCHAR AS "userId", NULL::VARCHAR AS "applicationName", 0::BIGINT AS "putApplicationType",
    CASE WHEN conv_id > 0 THEN grp END AS "groupIdHex", turn + 1 AS "messageSequenceNumber",
    lower(hex(encode(body))) AS "payloadHex" FROM c""",
)
def canonical_projection(spark, folder):
    rows = schema.project(views.conversations(spark, folder))
    return views.flat(rows)


@query(
    "minimal_projection",
    views.E
    + """SELECT id AS "messageIdHex", lower(hex(encode(body))) AS "payloadHex", ms AS "timestampMs",
    NULL::VARCHAR AS tenant FROM e""",
)
def minimal_projection(spark, folder):
    wanted = schema.with_field(schema.MINIMAL, "tenant", StringType())
    return views.flat(schema.project(views.events(spark, folder), wanted))


# Charset ids in turn; the last one is unknown and read as UTF-8.
_CCSIDS = [1208, 819, 1252, 437, 500, 37, 9999]


@query(
    "ccsid_decode",
    views.CHATS
    + r"""SELECT id AS "messageIdHex", [1208, 819, 1252, 437, 500, 37, 9999][(conv_id + turn) % 7 + 1]::BIGINT AS ccsid,
    CASE WHEN (conv_id + turn) % 7 IN (0, 6) THEN body
      WHEN (conv_id + turn) % 7 <= 2 THEN regexp_replace(body, '[^\x00-\x7e\xa0-\xff]', '?', 'g')
      ELSE regexp_replace(body, '[^\x00-\x7e]', '?', 'g') END AS text FROM c""",
)
def ccsid_decode(spark, folder):
    """Chats sent in each charset in turn, decoded by their charset id. A charset that lacks a
    character is sent a question mark."""
    latin = F.regexp_replace("text", r"[^\x00-\x7e\xa0-\xff]", "?")
    ascii_only = F.regexp_replace("text", r"[^\x00-\x7e]", "?")
    kind = (F.col("conv_id") + F.col("turn")) % len(_CCSIDS)
    body = F.when(kind.isin(0, 6), F.encode("text", "UTF-8"))
    for i, ccsid in enumerate(_CCSIDS[1:-1], start=1):
        body = body.when(kind == i, F.encode(latin if i <= 2 else ascii_only, charset.CCSID_CHARSETS[ccsid]))
    sent = table(spark, folder, "conversations").select(
        envelopes.key_hex(F.col("conv_id") * 1000 + F.col("turn")).alias("messageIdHex"),
        views.pick(_CCSIDS, kind).alias("ccsid"),
        body.alias("payload"),
    )
    text = charset.decode_payload(F.col("payload"), F.col("ccsid"))
    return sent.select("messageIdHex", F.col("ccsid").cast("bigint").alias("ccsid"), text.alias("text"))


@query("hex_ids", views.E + """SELECT id AS "messageIdHex", corr AS "correlationIdHex", '' AS "groupIdHex" FROM e""")
def hex_ids(spark, folder):
    ids = {f"{n}Hex": headers.hex_id(F.col(n)) for n in ("messageId", "correlationId", "groupId")}
    return views.events(spark, folder).select(*[c.alias(n) for n, c in ids.items()])


@query(
    "payload_size",
    views.DOCS + """SELECT q AS "queueName", id AS "messageIdHex", size AS "payloadSize", false AS "isRedelivered" FROM d""",
)
def payload_size(spark, folder):
    return views.documents(spark, folder).select(
        "queueName",
        "messageIdHex",
        headers.payload_size(F.col("payload")).alias("payloadSize"),
        headers.is_redelivered(F.col("backoutCount")).alias("isRedelivered"),
    )


@query(
    "latency",
    views.E
    + """SELECT id AS "messageIdHex", recv_ms - ms AS "processingLatencyMs", event_id % 8 AS "partitionId",
    event_id // 8 AS "offset", 'events' AS "sourceId", 'fmt=' || fmt || ';user=user' || user_id AS headers FROM e""",
)
def latency(spark, folder):
    key = F.col("event_id")
    wrapped = views.events(spark, folder).withColumns(
        headers.envelope("events", key % 8, F.floor(key / 8), {"fmt": F.col("format"), "user": F.col("userId")})
    )
    shown = F.array_join(F.transform(F.map_entries("headers"), lambda e: F.concat(e.key, F.lit("="), e.value)), ";")
    return wrapped.select(
        "messageIdHex",
        headers.latency_ms(F.col("receivedAt"), F.col("timestamp")).alias("processingLatencyMs"),
        F.col("partitionId").cast("bigint").alias("partitionId"),
        "offset",
        "sourceId",
        shown.alias("headers"),
    )


@query(
    "redact_details",
    views.E
    + """SELECT id AS "messageIdHex", CASE event_id % 4 WHEN 0 THEN 'sslKeyStorePassword' WHEN 1 THEN 'userId'
      WHEN 2 THEN 'authToken' ELSE 'host' END AS name,
    CASE WHEN event_id % 2 = 0 THEN '[REDACTED]' ELSE body END AS shown FROM e""",
)
def redact_details(spark, folder):
    name = views.pick(["sslKeyStorePassword", "userId", "authToken", "host"], F.col("event_id") % 4)
    details = F.create_map(name, F.col("payloadString"))
    return views.events(spark, folder).select(
        "messageIdHex", name.alias("name"), F.element_at(redact.redact_map(details), name).alias("shown")
    )


@query(
    "redact_text",
    views.DOCS
    + r"""SELECT id AS "messageIdHex", regexp_replace(body,
    '(?i)((?:password|secret|token|api_?key|credential)\w*)\s*[=:]\s*\S+', '\1=[REDACTED]', 'g') AS text FROM d""",
)
def redact_text(spark, folder):
    return views.documents(spark, folder).select("messageIdHex", redact.redact_text(F.col("payloadString")).alias("text"))


# Formats and parsing. Text of the payload in SQL is its UTF-8 form; the byte classes are the same there.

_DETECT = r"""CASE WHEN body IS NULL OR body = '' THEN 'UNKNOWN'
    WHEN regexp_matches(body, '\A[\t-\r\x1c-\x20]*\z') THEN 'TEXT'
    WHEN regexp_matches(body, '\A[\t-\r\x1c-\x20]*[\{\[]') THEN 'JSON'
    WHEN regexp_matches(body, '\A[\t-\r\x1c-\x20]*<') THEN 'XML'
    WHEN NOT regexp_matches(body, '[^\x20-\x7e\t\n\r]') THEN 'TEXT' ELSE 'BINARY' END"""


@query(
    "detect_format",
    views.DOCS
    + ", "
    + views.PAGES.removeprefix("WITH ")
    + f"""SELECT q AS "queueName", id AS "messageIdHex", {_DETECT} AS detected
    FROM (SELECT q, id, body FROM d UNION ALL SELECT q, id, body FROM p)""",
)
def detect_format(spark, folder):
    both = views.documents(spark, folder).unionByName(views.pages(spark, folder))
    return both.select("queueName", "messageIdHex", formats.detect_format(F.col("payload")).alias("detected"))


@query(
    "can_parse",
    views.E
    + """SELECT id AS "messageIdHex", fmt IN ('', 'MQSTR', 'JSON') OR (starts_with(body, '{') AND ends_with(body, '}'))
    OR (starts_with(body, '[') AND ends_with(body, ']')) AS json,
    fmt = 'XML' OR (starts_with(body, '<') AND ends_with(body, '>')) AS xml, true AS text FROM e""",
)
def can_parse(spark, folder):
    args = F.col("format"), F.col("payload")
    return views.events(spark, folder).select(
        "messageIdHex",
        formats.can_parse_json(*args).alias("json"),
        formats.can_parse_xml(*args).alias("xml"),
        formats.can_parse_text(*args).alias("text"),
    )


@query(
    "json_parse",
    views.LINES
    + """SELECT l_partkey AS p, (body->>'$.o')::BIGINT AS o, (body->>'$.l')::BIGINT AS l, json_valid(body) AS ok FROM l""",
)
def json_parse(spark, folder):
    value = parsing.json_variant(charset.utf8(F.col("payload")))
    parsed = views.lines(spark, folder).select(value.alias("v"))
    return parsed.select(
        *[F.variant_get("v", f"$.{n}", "bigint").alias(n) for n in ("o", "l", "p")], F.col("v").isNotNull().alias("ok")
    )


@query(
    "xml_parse",
    views.ORDERS
    + """SELECT id AS "messageIdHex", o_orderkey AS "orderId", o_custkey AS customer,
    '{"order":{"@id":"' || o_orderkey || '","cust":"' || o_custkey || '"}}' AS document FROM o""",
)
def xml_parse(spark, folder):
    """Typed fields on the JVM, and the whole document in its general shape."""
    text = charset.utf8(F.col("payload"))
    fields = parsing.xml_fields(text, "struct<_id:bigint,cust:bigint>")
    rows = views.orders(spark, folder).select(
        "messageIdHex", fields.alias("f"), F.try_parse_json(parsing.xml_json(text)).alias("d")
    )
    return rows.select(
        "messageIdHex", F.col("f._id").alias("orderId"), F.col("f.cust").alias("customer"), F.to_json("d").alias("document")
    )


_PARSED = """SELECT id AS "messageIdHex", q AS "queueName", fmt AS format, true AS "isSuccess", size AS "originalSize",
    shown AS data"""


def _shown(parsed):
    data = F.col("parsed.data")
    text = F.when(F.col("parsed.format") == "TEXT", F.try_variant_get(data, "$", "string")).otherwise(F.to_json(data))
    return parsed.select(
        "messageIdHex",
        "queueName",
        "parsed.format",
        "parsed.isSuccess",
        F.col("parsed.originalSize").cast("bigint").alias("originalSize"),
        text.alias("data"),
    )


@query(
    "composite_parse",
    views.E
    + ", "
    + views.ORDERS.removeprefix("WITH ")
    + ", "
    + views.CHATS.removeprefix("WITH ")
    + ", "
    + views.PAGES.removeprefix("WITH ")
    + ", m AS (SELECT id, q, 'JSON' AS fmt, size, replace(body, ' ', '') AS shown FROM e UNION ALL "
    + """SELECT id, 'ORDER', 'XML', 34 + length(o_orderkey::VARCHAR) + length(o_custkey::VARCHAR),
      '{"order":{"@id":"' || o_orderkey || '","cust":"' || o_custkey || '"}}' FROM o UNION ALL """
    + "SELECT id, q, 'TEXT', size, body FROM c UNION ALL SELECT id, q, 'TEXT', size, body FROM p)"
    + _PARSED
    + " FROM m",
)
def composite_parse(spark, folder):
    """JSON, XML and text messages through the default parser chain; broken pages fall back to text."""
    kinds = views.events, views.orders, views.conversations, views.pages
    columns = "messageIdHex", "queueName", "format", "payload", "ccsid"
    every = [kind(spark, folder).select(*columns) for kind in kinds]
    union = every[0].unionByName(every[1]).unionByName(every[2]).unionByName(every[3])
    return _shown(parse.parse_payloads(union))


@query(
    "parse_by_queue",
    views.E
    + """, c AS (SELECT *, CASE q WHEN 'QUEUE.ERROR' THEN 'TEXT' WHEN 'QUEUE.PURCHASE' THEN 'XML' ELSE 'JSON' END AS f FROM e)
  SELECT id AS "messageIdHex", q AS "queueName", f AS format, f <> 'XML' AS "isSuccess", size AS "originalSize",
    CASE f WHEN 'JSON' THEN replace(body, ' ', '') WHEN 'TEXT' THEN body END AS data FROM c""",
)
def parse_by_queue(spark, folder):
    return _shown(parse.parse_by_queue(views.events(spark, folder), views.event_queue_config(spark)))


@query(
    "raw_wrap",
    views.E + """SELECT id AS "messageIdHex", body AS raw, fmt IN ('', 'MQSTR', 'JSON') AS supported FROM e""",
)
def raw_wrap(spark, folder):
    return views.events(spark, folder).select(
        "messageIdHex",
        F.element_at(formats.raw_wrap(F.col("payload")), "_raw").alias("raw"),
        formats.supports_raw_json(F.col("format")).alias("supported"),
    )


@query(
    "parse_failures",
    views.PAGES
    + """SELECT q AS "queueName", id AS "messageIdHex", 'XML' AS format,
    'XML parse error: document is not well-formed' AS error, body AS "originalPayload", size AS "originalSize" FROM p""",
)
def parse_failures(spark, folder):
    """Pages with JSON and XML as the only parsers: no page is well-formed."""
    parsed = parse.parse_payloads(views.pages(spark, folder), (parse.JSON, parse.XML))
    return views.flat(parse.parse_failures(parsed))


@query(
    "parse_counts",
    views.PAGES
    + ", "
    + views.ORDERS.removeprefix("WITH ")
    + """SELECT q AS "queueName", 0 AS "parseSuccess", count(*) AS "parseFailure" FROM p GROUP BY q
    UNION ALL SELECT 'ORDER', count(*), 0 FROM o""",
)
def parse_counts(spark, folder):
    columns = "queueName", "format", "payload", "ccsid"
    both = views.pages(spark, folder).select(*columns).unionByName(views.orders(spark, folder).select(*columns))
    return parse.parse_counts(parse.parse_payloads(both, (parse.JSON, parse.XML)))


# Sizes and chunks. Limits are scaled to the documents.

PROFILE = sizes.SizeProfile(max_bytes=20_000, warn_bytes=2_000, offload=True, offload_bytes=8_000)
_TOO_BIG = "'Payload size (' || size || ' bytes) exceeds maximum allowed (20000 bytes)'"


@query(
    "size_check",
    views.DOCS
    + f"""SELECT id AS "messageIdHex", size AS "sizeBytes", size <= 20000 AS "isValid",
    size > 2000 AND size <= 20000 AS "shouldWarn", CASE WHEN size > 20000 THEN {_TOO_BIG} END AS rejection FROM d""",
)
def size_check(spark, folder):
    docs = views.documents(spark, folder)
    check = sizes.size_check(headers.stored_size(docs), PROFILE)
    return docs.select("messageIdHex", check.alias("c")).select("messageIdHex", "c.*")


@query(
    "payload_decision",
    views.DOCS
    + f"""SELECT id AS "messageIdHex", size AS "sizeBytes",
    CASE WHEN size > 20000 THEN 'Reject' WHEN size > 8000 THEN 'Offloaded' WHEN size > 2000 THEN 'ProcessWithWarning'
      ELSE 'Process' END AS action,
    CASE WHEN size > 20000 THEN {_TOO_BIG} WHEN size > 8000 THEN 'Offloaded to: store/' || sha256(body)
      WHEN size > 2000 THEN 'Large payload: ' || size || ' bytes' END AS reason FROM d""",
)
def payload_decision(spark, folder):
    planned = offload.plan_offload(views.documents(spark, folder), PROFILE, "store")
    return planned.select("messageIdHex", "decision.*")


@query(
    "offload_large",
    views.DOCS
    + """SELECT id AS "messageIdHex", q AS "queueName", size AS "payloadSize",
    CASE WHEN size > 8000 AND size <= 20000 THEN 'EXTERNAL' ELSE 'LOCAL' END AS storage,
    sha256(body) AS digest FROM d""",
)
def offload_large(spark, folder):
    """Write the large documents out in two batches, one of them replayed, and restore them in the slim rows."""
    path = shared_dir(spark, "offload")
    planned = offload.plan_offload(views.documents(spark, folder), PROFILE, path)
    half = F.pmod(F.crc32("messageIdHex"), F.lit(2))
    for batch_id in (0, 1, 1):
        offload.write_offloaded(planned.filter(half == batch_id), path, batch_id)
    storage = F.when(F.col("payloadRef").isNull(), "LOCAL").otherwise("EXTERNAL").alias("storage")
    both = offload.restore(offload.slim(planned), offload.read_offloaded(spark, path)).select("*", storage)
    return both.select(
        "messageIdHex",
        "queueName",
        headers.payload_size(F.col("payload")).alias("payloadSize"),
        "storage",
        F.sha2("payload", 256).alias("digest"),
    )


@query(
    "chunk_payload",
    views.DOCS
    + """, pieces AS (SELECT q, id, lower(hex(encode(body))) AS raw, unnest(range(0, (size + 999) // 1000)) AS i FROM d)
  SELECT q AS "queueName", id AS "messageIdHex", i AS "chunkIndex", length(piece) // 2 AS "chunkBytes", md5(piece) AS digest
  FROM (SELECT q, id, i, substr(raw, i * 2000 + 1, 2000) AS piece FROM pieces)""",
)
def chunk_payload(spark, folder):
    cut = chunks.chunk_payloads(views.documents(spark, folder), 1000)
    return cut.select(
        "queueName",
        "messageIdHex",
        F.col("chunkIndex").cast("bigint").alias("chunkIndex"),
        F.octet_length("chunk").cast("bigint").alias("chunkBytes"),
        F.md5(F.lower(F.hex("chunk")).cast("binary")).alias("digest"),
    )


def _newlines(chunk):
    text = F.decode(chunk, "ISO-8859-1")
    return (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).cast("bigint")


@query(
    "chunk_reduce",
    views.DOCS
    + """SELECT q AS "queueName", id AS "messageIdHex", length(body) - length(replace(body, chr(10), '')) AS newlines,
    length(body) - length(replace(body, chr(10), '')) AS "newlinesOfTable" FROM d WHERE size > 0""",
)
def chunk_reduce(spark, folder):
    """Line ends counted chunk by chunk: inside the message row, and over a chunk table."""
    docs = views.documents(spark, folder).filter(F.octet_length("payload") > 0)
    inline = docs.select(
        "queueName",
        "messageIdHex",
        chunks.reduce_payload(F.col("payload"), _newlines, lambda a, b: a + b, 1000).alias("newlines"),
    )
    stored = chunks.reduce_chunks(
        chunks.chunk_payloads(docs, 1000), _newlines(F.col("chunk")), F.sum, "newlinesOfTable"
    )
    return inline.join(stored, ["queueName", "messageIdHex"])

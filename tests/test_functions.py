"""Exact values of the column functions."""

import json

import pytest
from pyspark.sql import functions as F

from waybill.functions import charset, failures, formats, headers, parsing, redact, sizes
from waybill.functions.retry import RetryPolicy
from waybill.operators import parse


def one(spark, column, **values):
    """Value of ``column`` over a single row of ``values``."""
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("c")).first()["c"]


@pytest.mark.parametrize(
    "payload, expected",
    [
        (b'{"key":"value"}', "JSON"),
        (b"[1,2,3]", "JSON"),
        (b'  \n{"a":1}', "JSON"),
        (b'<?xml version="1.0"?><r/>', "XML"),
        (b"<root>data</root>", "XML"),
        (b"plain text", "TEXT"),
        (b" \t\n\x0b", "TEXT"),
        (bytes([0, 1, 2]), "BINARY"),
        ("café".encode(), "BINARY"),
        (b"bell\x07", "BINARY"),
        (b"line one\nline two\n", "TEXT"),
        (b"", "UNKNOWN"),
        (None, "UNKNOWN"),
    ],
)
def test_detect_format(spark, payload, expected):
    df = spark.createDataFrame([(payload,)], "payload binary")
    assert df.select(formats.detect_format(F.col("payload"))).first()[0] == expected


@pytest.mark.parametrize(
    "raw, ccsid, expected",
    [
        ("grüße".encode(), 1208, "grüße"),
        (b"\xe9t\xe9", 819, "été"),
        ("Héllo".encode("cp437"), 437, "Héllo"),
        ("Hello".encode("cp500"), 500, "Hello"),
        ("Hello".encode("cp037"), 37, "Hello"),
        ("€uro".encode("cp1252"), 1252, "€uro"),
        (b"other", 9999, "other"),
        (b"bad \xff byte", 1208, "bad � byte"),
    ],
)
def test_decode_payload(spark, raw, ccsid, expected):
    df = spark.createDataFrame([(raw, ccsid)], "payload binary, ccsid int")
    assert df.select(charset.decode_payload(F.col("payload"), F.col("ccsid"))).first()[0] == expected


def test_hex_id_and_size(spark):
    df = spark.createDataFrame([(b"\xaa\xbb\x01",), (None,), (b"",)], "id binary")
    assert [r[0] for r in df.select(headers.hex_id(F.col("id"))).collect()] == ["aabb01", "", ""]
    assert df.select(headers.payload_size(F.col("id"))).first()[0] == 3


JSON_CASES = [
    ('{"name": "test", "value": 123}', {"name": "test", "value": 123}),
    ("[1, 2, 3]", [1, 2, 3]),
    ("", {}),
    ("  \n ", {}),
    ("01", 1),
    ("1.", 1.0),
    ("123abc", 123),
    ("-7", -7),
    ("1.5e3", 1500.0),
    ("trueish", True),
    ("false", False),
    ("nullable", None),
    ('"text" tail', "text"),
    ('{"a":1,"a":2}', {"a": 2}),
    ('{"a":1} trailing', {"a": 1}),
    ('{"a":"x\ny"}', {"a": "x\ny"}),
    ('{"a":{"b":[true,null]}}', {"a": {"b": [True, None]}}),
]
BAD_JSON = ['{"invalid": }', "not json", "{'a':1}", "[1,2", '{"a":1', "NaN", "-", "99999999999999999999", "{,}"]


def test_json_variant(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(JSON_CASES)], "i int, t string")
    value = parsing.json_variant(F.col("t"))
    rows = df.select("i", F.to_json(value).alias("j"), value.isNull().alias("failed")).orderBy("i").collect()
    for row, (text, expected) in zip(rows, JSON_CASES):
        assert not row["failed"], text
        assert json.loads(row["j"] or "null") == expected, text


def test_json_variant_failures(spark):
    df = spark.createDataFrame([(t,) for t in BAD_JSON], "t string")
    failed = df.filter(parsing.json_variant(F.col("t")).isNull())
    assert failed.count() == len(BAD_JSON)


XML_CASES = [
    ('<root><item id="1">value</item></root>', {"root": {"item": {"id": "1", "_text": "value"}}}),
    ('<order id="123"><product>Widget</product></order>', {"order": {"product": "Widget", "@id": "123"}}),
    ("<a>007</a>", {"a": "007"}),
    ("<l><i>1</i><i>2</i><k/></l>", {"l": {"i": ["1", "2"], "k": ""}}),
    ('<?xml version="1.0"?><r/>', {"r": ""}),
    ("<n:a xmlns:n='u'> x </n:a>", {"a": "x"}),
    ("<invalid><unclosed>", None),
    ("<a>1</a><b>2</b>", None),
    ("plain", None),
    ("", None),
]


def test_xml_json(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(XML_CASES)], "i int, t string")
    rows = df.select("i", parsing.xml_json("t").alias("j")).orderBy("i").collect()
    for row, (text, expected) in zip(rows, XML_CASES):
        assert (None if row["j"] is None else json.loads(row["j"])) == expected, text


def test_xml_fields_are_null_for_broken_documents(spark):
    df = spark.createDataFrame([("<o _x='1'><c>5</c></o>",), ("<o><c>5</c>",), (None,)], "t string")
    got = [r[0] for r in df.select(parsing.xml_fields(F.col("t"), "struct<c:int>")["c"]).collect()]
    assert got == [5, None, None]


def test_can_parse(spark, messages):
    df = messages(
        {"payload": "x", "format": "MQSTR"},
        {"payload": "x", "format": "my-json"},
        {"payload": " [1] ", "format": "BIN"},
        {"payload": "<?xml", "format": "BIN"},
        {"payload": "x", "format": "BIN"},
    )
    args = F.col("format"), F.col("payload")
    got = df.select(formats.can_parse_json(*args), formats.can_parse_xml(*args)).collect()
    assert [tuple(r) for r in got] == [(True, False), (True, False), (True, False), (False, True), (False, False)]


def test_composite_falls_back_to_text(messages):
    row = parse.parse_payloads(messages({"payload": "not json"}), (parse.JSON, parse.TEXT)).first()["parsed"]
    assert (row["format"], row["isSuccess"], row["error"]) == ("TEXT", True, None)


def test_composite_reports_last_failure(messages):
    df = messages({"payload": "not json or xml"}, {"payload": "<a>", "format": "XML"}, {"payload": "x", "format": "BIN"})
    rows = [r["parsed"] for r in parse.parse_payloads(df, (parse.JSON, parse.XML)).orderBy("messageIdHex").collect()]
    assert [r["isSuccess"] for r in rows] == [False, False, False]
    # a message no parser accepts is tried with all, so the last one reports
    assert [r["format"] for r in rows] == ["JSON", "XML", "XML"]
    assert rows[0]["originalPayload"] == "not json or xml" and rows[0]["originalSize"] == 15
    assert rows[0]["error"]


def test_composite_prefers_json_then_xml(messages):
    df = messages({"payload": '{"a":1}', "format": "XML"}, {"payload": "<a>1</a>", "format": "XML"}, {"payload": ""})
    rows = [r["parsed"] for r in parse.parse_payloads(df).orderBy("messageIdHex").collect()]
    assert [r["format"] for r in rows] == ["JSON", "XML", "JSON"]
    assert [str(r["data"].toPython()) for r in rows] == ["{'a': 1}", "{'a': '1'}", "{}"]


def test_text_uses_the_charset_and_json_does_not(messages):
    df = messages({"payload": "Hello".encode("cp037"), "ccsid": 37, "format": "BIN"})
    row = parse.parse_payloads(df).first()["parsed"]
    assert (row["format"], row["data"].toPython()) == ("TEXT", "Hello")


def test_parser_of_queue(spark, messages):
    from waybill.operators.queue_config import queue_config

    df = messages({"queue": "A", "payload": "{}"}, {"queue": "B", "payload": "{}"}, {"queue": "C", "payload": "no"})
    config = queue_config(spark, {"queueName": "A", "parserType": "TEXT"}, {"queueName": "B", "parserType": "xml"})
    rows = {r["queueName"]: r["parsed"] for r in parse.parse_by_queue(df, config).collect()}
    assert (rows["A"]["format"], rows["A"]["isSuccess"]) == ("TEXT", True)
    assert (rows["B"]["format"], rows["B"]["isSuccess"]) == ("XML", False)
    assert (rows["C"]["format"], rows["C"]["isSuccess"]) == ("TEXT", True)


def test_parse_needs_a_parser(messages):
    with pytest.raises(ValueError):
        parse.parse_payloads(messages({}), ())


def test_binary_result(spark, messages):
    row = messages({"payload": b"\x00\x01"}).select(parse.binary_result(F.col("payload")).alias("r")).first()["r"]
    assert (row["format"], row["isSuccess"], row["originalSize"]) == ("BINARY", True, 2)


def test_retry_delays(spark):
    attempts = spark.createDataFrame([(i,) for i in range(1, 6)], "a int")
    delays = lambda c: [r[0] for r in attempts.orderBy("a").select(c).collect()]
    a = F.col("a")
    assert delays(RetryPolicy(initial_ms=100).delay_ms(a))[:4] == [100, 200, 400, 800]
    assert delays(RetryPolicy(max_ms=5000).delay_ms(a))[4] == 5000
    assert delays(RetryPolicy(multiplier=1.5).delay_ms(a)) == [1000, 1000, 2000, 3000, 5000]
    assert delays(RetryPolicy(max_ms=10000).backoff_ms(a - 1)) == [1000, 2000, 4000, 8000, 10000]
    assert one(spark, RetryPolicy().delay_ms(F.lit(5000))) == 30000
    retry = RetryPolicy().should_retry
    assert delays(retry(a, F.lit(True))) == [True, True, True, False, False]
    assert not any(delays(retry(a, F.lit(False))))


def test_jitter_varies_within_bounds_and_repeats(spark):
    policy = RetryPolicy(jitter=0.1)
    df = spark.range(1000).select(policy.jittered_ms(F.lit(1), F.col("id")).alias("d"))
    first, second = [r[0] for r in df.collect()], [r[0] for r in df.collect()]
    assert first == second
    assert min(first) >= 900 and max(first) <= 1100 and len(set(first)) > 50
    assert one(spark, RetryPolicy().jittered_ms(F.lit(1), F.lit(1))) == 1000


@pytest.mark.parametrize("bad", [{"max_retries": -1}, {"initial_ms": 0}, {"max_ms": 1}, {"multiplier": 0.5}, {"jitter": 2.0}])
def test_retry_policy_is_checked(bad):
    with pytest.raises(ValueError):
        RetryPolicy(**bad)


@pytest.mark.parametrize(
    "error_class, message, kind, reason",
    [
        ("x.ConnectorException", "Authentication failed", "PERMANENT", "Authentication error: Authentication failed"),
        ("x.ConnectorException", "Configuration error", "PERMANENT", "Configuration error: Configuration error"),
        ("x.ConnectorException", "Parse failed", "PERMANENT", "Parse error: Parse failed"),
        ("x.ConnectorException", "Invalid format", "PERMANENT", "Parse error: Invalid format"),
        ("x.ConnectorException", "Connection failed: down", "TRANSIENT", "Connection failed: down"),
        ("x.ConnectorException", "Transaction rolled back", "TRANSIENT", "Transaction rolled back"),
        ("java.lang.IllegalArgumentException", "auth", "PERMANENT", "auth"),
        ("java.lang.NumberFormatException", None, "PERMANENT", "NumberFormatException"),
        ("java.io.IOException", "parse", "TRANSIENT", "parse"),
        ("some.Unknown", "?", "TRANSIENT", "?"),
    ],
)
def test_classify(spark, error_class, message, kind, reason):
    df = spark.createDataFrame([(error_class, message)], "c string, m string")
    assert tuple(df.select(failures.classify(F.col("c"), F.col("m")).alias("f")).first()["f"]) == (kind, reason)


def test_error_text(spark):
    df = spark.createDataFrame([(2035, 2), (2009, None), (None, None), (1, 1)], "r int, c int")
    kind = failures.reason_kind(F.col("r"))
    rows = df.select(failures.error_text(kind, F.lit("x"), F.col("r"), F.col("c"))).collect()
    assert [r[0] for r in rows] == [
        "Authentication failed: x [reasonCode=2035, completionCode=2]",
        "Connection failed: x [reasonCode=2009]",
        "Transport error: x",
        "Transport error: x [reasonCode=1, completionCode=1]",
    ]


def test_size_check_and_decision(spark):
    profile = sizes.SizeProfile(max_bytes=1000, warn_bytes=500)
    df = spark.createDataFrame([(100,), (700,), (2000,)], "s bigint")
    size = F.col("s")
    got = [r[0]["action"] for r in df.select(sizes.payload_decision(size, profile)).collect()]
    assert got == ["Process", "ProcessWithWarning", "Reject"]
    checks = [tuple(r[0]) for r in df.select(sizes.size_check(size, profile)).collect()]
    assert checks[1][:3] == (True, 700, True)
    assert checks[2] == (False, 2000, False, "Payload size (2000 bytes) exceeds maximum allowed (1000 bytes)")
    offload = sizes.SizeProfile(1000, 500, True, 600)
    moved = sizes.payload_decision(size, offload, reference=F.lit("ref"))
    failed = sizes.payload_decision(size, offload, reference=F.lit("ref"), offload_error=F.lit("disk"))
    assert tuple(df.filter("s = 700").select(moved).first()[0]) == ("Offloaded", "Offloaded to: ref", 700)
    assert tuple(df.filter("s = 700").select(failed).first()[0]) == ("Reject", "Offload failed: disk", 700)


def test_size_profiles():
    assert sizes.DEFAULT.max_bytes == 100 * sizes.MB and sizes.DEFAULT.problems() == []
    assert (sizes.CONSERVATIVE.max_bytes, sizes.CONSERVATIVE.warn_bytes) == (10 * sizes.MB, sizes.MB)
    assert (sizes.PERMISSIVE.max_bytes, sizes.PERMISSIVE.warn_bytes) == (500 * sizes.MB, 50 * sizes.MB)
    assert len(sizes.SizeProfile(0, 5).problems()) == 2


def test_redaction(spark):
    secrets = {"password": "a", "sslKeyStorePassword": "b", "user": "c", "authToken": "d", "API_KEY": "e"}
    df = spark.createDataFrame([(secrets,)], "m map<string,string>")
    audit = df.select(redact.redact_map(F.col("m"))).first()[0]
    assert audit == {**dict.fromkeys(secrets, "[REDACTED]"), "user": "c", "API_KEY": "e"}
    config = df.select(redact.redact_map(F.col("m"), redact.CONFIG_KEYS)).first()[0]
    assert config == {**dict.fromkeys(secrets, "[REDACTED]"), "user": "c"}
    text = one(spark, redact.redact_text(F.lit("connecting with password=secret123 to host, API_KEY: zzz")))
    assert text == "connecting with password=[REDACTED] to host, API_KEY=[REDACTED]"


def test_own_parser_and_classifier(spark, messages):
    from waybill.operators import recovery

    pairs = parse.Parser(
        "PAIRS",
        lambda fmt, payload: fmt == "PAIRS",
        lambda text, payload, ccsid: F.when(text.contains("="), F.to_variant_object(F.str_to_map(text, F.lit(";"), F.lit("=")))),
        "no pairs",
    )
    df = messages({"payload": "a=1;b=2", "format": "PAIRS"}, {"payload": "none", "format": "PAIRS"})
    rows = [r["parsed"] for r in parse.parse_payloads(df, (pairs, parse.JSON)).orderBy("messageIdHex").collect()]
    assert (rows[0]["format"], rows[0]["data"].toPython()) == ("PAIRS", {"a": "1", "b": "2"})
    assert (rows[1]["isSuccess"], rows[1]["error"]) == (False, "no pairs")

    log = spark.createDataFrame([("X", "m", 1)], "errorClass string, message string, attempt int")
    never = lambda cls, message: F.struct(F.lit("PERMANENT").alias("failureType"), message.alias("reason"))
    planned = recovery.retry_plan(log.withColumn("ts", F.current_timestamp()), classifier=never).first()
    assert (planned["shouldRetry"], planned["delayMs"], planned["nextRetryAt"]) == (False, None, None)

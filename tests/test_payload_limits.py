"""Payloads beyond the readers' own limits: read rightly, or a failed row of their format that says why."""

import pytest
from pyspark.sql import functions as F

from waybill.functions import failures
from waybill.operators.joins import salted_join
from waybill.operators.parse import JSON, XML, parse_failures, parse_payloads


def parsed(df):
    return parse_payloads(df).select("parsed.format", "parsed.isSuccess", "parsed.error", "parsed.originalSize").first()


def test_long_json_string(messages):
    df = messages({"payload": '{"a": "' + "x" * 60_000_000 + '"}'})
    assert parsed(df)[:2] == ("JSON", True)


@pytest.mark.parametrize("levels, right", [(1_400, True), (5_000, False), (100_000, False)])
def test_deep_documents(messages, levels, right):
    nested = '{"a":' * levels + '"}"' + "}" * levels
    row = parsed(messages({"payload": nested}))
    assert row[:2] == ("JSON", right) and (right or "levels" in row["error"])
    row = parsed(messages({"payload": "<a>" * levels + "x" + "</a>" * levels}))
    assert row[:2] == ("XML", right) and (right or "levels" in row["error"])


def test_broken_documents_are_still_text(messages):
    assert parsed(messages({"payload": "{" * 10 + " not json"}))[:2] == ("TEXT", True)


def test_long_text(messages):
    row = parsed(messages({"payload": "some text " * 13_500_000}))
    assert row[:2] == ("TEXT", False) and "bytes" in row["error"] and row["originalSize"] == 135_000_000


def test_parsers_one_by_one(messages):
    df = messages({"payload": "<a><b>1</b></a>"}, {"payload": '{"b": 1}'})
    for parser in (JSON, XML):
        assert {r["parsed"]["format"] for r in parse_payloads(df, (parser,)).select("parsed").collect()} == {parser.name}


@pytest.mark.parametrize(
    "name",
    [
        "java.util.MissingFormatArgumentException",
        "java.util.UnknownFormatConversionException",
        "java.nio.file.InvalidPathException",
        "java.security.InvalidParameterException",
        "org.apache.spark.SparkIllegalArgumentException",
        "org.apache.spark.SparkNumberFormatException",
        "java.lang.NumberFormatException",
    ],
)
def test_subclasses_of_permanent_failures(spark, name):
    kind = failures.classify(F.lit(name), F.lit("x"))
    assert spark.range(1).select(kind.alias("k")).first()["k"]["failureType"] == "PERMANENT"


def test_own_classes_and_names_that_only_end_alike(spark):
    own = failures.classify(F.lit("my.Odd"), F.lit("x"), failures.SUPERCLASSES | {"my.Odd": "my.Base", "my.Base": "java.lang.SecurityException"})
    foreign = failures.classify(F.lit("my.OtherConnectorException"), F.lit("auth"))
    row = spark.range(1).select(own.alias("a"), foreign.alias("b")).first()
    assert row["a"]["failureType"] == "PERMANENT" and row["b"]["failureType"] == "TRANSIENT"


def test_salted_join_with_maps_and_variants(spark):
    left = spark.range(200).select(
        F.lit(1).alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"), F.parse_json(F.lit("1")).alias("v"), F.lit(b"x").alias("payload")
    )
    right = spark.createDataFrame([(1, "one")], "k int, name string")
    assert salted_join(left, right, ["k"]).filter("name = 'one'").count() == 200


def test_failures_are_found_without_a_second_reading(spark, messages):
    df = messages({"payload": "<a>é</a>", "format": "XML"}, {"payload": "<a>", "format": "XML"}, {"payload": "", "format": "XML"})
    failed = parse_failures(parse_payloads(df, (JSON, XML)))
    nodes = [n for n in failed._jdf.queryExecution().executedPlan().toString().splitlines() if "ArrowEvalPython" in n.split("[")[0]]
    assert len(nodes) == 1
    assert sorted(r["originalPayload"] for r in failed.collect()) == ["", "<a>"]

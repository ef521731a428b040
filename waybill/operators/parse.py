"""Parsing the payload column with one or more parsers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions import formats
from waybill.functions.charset import decode_payload, utf8
from waybill.functions.parsing import MOST_LEVELS, json_variant, too_deep, variant_of_json, xml_json
from waybill.operators.joins import join_dimension

@dataclass(frozen=True)
class Parser:
    """One payload parser: ``accepts(format, payload)`` says which messages are meant for it, ``read`` gives
    the VARIANT of the payload, null where it cannot be read. Values are only read from rows the parser
    is tried on: ``read`` gets their text, bytes and charset id, and nulls elsewhere. ``beyond`` says of such a text
    that could not be read that it is of this format all the same, so that no later parser may take it. With ``form``
    both get what that makes of the text, which is worked out once."""

    name: str
    accepts: Callable[[Column, Column], Column]
    read: Callable[[Column, Column, Column], Column]
    error: str
    beyond: Callable[[Column], Column] | None = None
    form: Callable[[Column], Column] | None = None


# What a VARIANT holds, less its own header.
VARIANT_BYTES = 128 * 1024 * 1024 - 64


def _text_variant(text: Column) -> Column:
    return F.when(F.octet_length(text) <= VARIANT_BYTES, text).cast("variant")


JSON = Parser(
    "JSON",
    formats.can_parse_json,
    lambda text, payload, ccsid: json_variant(text),
    "JSON parse error: no valid JSON value",
    too_deep,
)
XML = Parser(
    "XML",
    formats.can_parse_xml,
    lambda json, payload, ccsid: variant_of_json(json),
    "XML parse error: document is not well-formed",
    lambda json: json.isNotNull(),
    xml_json,
)
TEXT = Parser(
    "TEXT",
    formats.can_parse_text,
    lambda text, payload, ccsid: _text_variant(decode_payload(payload, ccsid)),
    f"Text parse error: text of more than {VARIANT_BYTES} bytes does not fit a VARIANT, see originalPayload",
)

# Parsers of the default composite, in order of preference.
DEFAULT_PARSERS = (JSON, XML, TEXT)


def parse_payloads(
    messages: DataFrame, parsers: tuple[Parser, ...] = DEFAULT_PARSERS, parser_type: Column | None = None
) -> DataFrame:
    """Add ``parsed``: struct(format, isSuccess, data, error, originalPayload, originalSize).

    Parsers that accept a message are tried in order, or all of them when none does; the first success
    wins, otherwise the last failure is reported. ``parser_type`` names the one parser of a row and
    leaves the choice open where it is AUTO. JSON and XML are always read as UTF-8, text by ``ccsid``.
    A later parser only sees rows the earlier ones left over.
    """
    if not parsers:
        raise ValueError("at least one parser is required")
    accepts = {}
    for p in parsers:
        accepts[p.name] = p.accepts(F.col("format"), F.col("payload"))
        if parser_type is not None:
            accepts[p.name] = F.when(parser_type == "AUTO", accepts[p.name]).otherwise(parser_type == p.name)
    names = list(accepts)
    df = messages.withColumns({f"_try_{n}": a for n, a in accepts.items()})
    nobody = ~reduce(lambda a, b: a | b, [F.col(f"_try_{n}") for n in names])
    if parser_type is not None:
        nobody = nobody & (parser_type == "AUTO")
    df = df.withColumns({"_text": utf8(F.col("payload")), "_nobody": nobody})

    done: Column = F.lit(False)
    for p in parsers:
        tried = (F.col(f"_try_{p.name}") | F.col("_nobody")) & ~done
        text, payload = F.when(tried, F.col("_text")), F.when(tried, F.col("payload"))
        if p.form is not None:
            df = df.withColumn(f"_form_{p.name}", p.form(text))
            text = F.col(f"_form_{p.name}")
        df = df.withColumn(f"_value_{p.name}", F.when(tried, p.read(text, payload, F.col("ccsid"))))
        read = F.col(f"_value_{p.name}").isNotNull()
        if p.beyond is not None:
            unread = F.when(tried & ~read, text)
            df = df.withColumn(f"_beyond_{p.name}", F.coalesce(p.beyond(unread), F.lit(False)))
            read = read | F.col(f"_beyond_{p.name}")
        done = done | read

    winner = F.coalesce(*[F.when(F.col(f"_value_{n}").isNotNull(), n) for n in names])
    beyond = [F.when(F.col(f"_beyond_{p.name}"), p.name) for p in parsers if p.beyond is not None]
    loser = F.coalesce(*beyond, *[F.when(F.col(f"_try_{n}") | F.col("_nobody"), n) for n in reversed(names)], F.lit("UNKNOWN"))
    error = reduce(lambda case, p: case.when(loser == p.name, p.error), parsers, F.when(F.lit(False), ""))
    too_much = reduce(
        lambda case, p: case.when(F.col(f"_beyond_{p.name}"), f"{p.name} parse error: more than {MOST_LEVELS} levels"),
        [p for p in parsers if p.beyond is not None],
        F.when(F.lit(False), ""),
    )
    failed = winner.isNull()
    result = F.struct(
        F.coalesce(winner, loser).alias("format"),
        winner.isNotNull().alias("isSuccess"),
        F.coalesce(*[F.col(f"_value_{n}") for n in names]).alias("data"),
        F.when(failed, F.coalesce(too_much, error.otherwise("No parser could handle the message"))).alias("error"),
        F.when(failed, F.col("_text")).alias("originalPayload"),
        F.octet_length("payload").alias("originalSize"),
    )
    helpers = ["_text", "_nobody", *[f"_try_{n}" for n in names], *[f"_value_{n}" for n in names]]
    helpers += [f"_beyond_{p.name}" for p in parsers if p.beyond is not None]
    helpers += [f"_form_{p.name}" for p in parsers if p.form is not None]
    return df.withColumn("parsed", result).drop(*helpers)


def parse_by_queue(messages: DataFrame, queue_config: DataFrame) -> DataFrame:
    """``parse_payloads`` with each queue's ``parserType``; a queue without configuration is AUTO."""
    choice = queue_config.select("queueName", F.upper("parserType").alias("_parser"))
    joined = join_dimension(messages, choice, ["queueName"], "left")
    return parse_payloads(joined, parser_type=F.coalesce("_parser", F.lit("AUTO"))).drop("_parser")


def binary_result(payload: Column) -> Column:
    """Result of a payload that is kept as bytes."""
    return F.struct(
        F.lit("BINARY").alias("format"),
        F.lit(True).alias("isSuccess"),
        payload.alias("data"),
        F.octet_length(payload).alias("originalSize"),
    )


def parse_failures(parsed: DataFrame) -> DataFrame:
    """Dead letters: failed rows with their original payload."""
    return parsed.filter(~F.col("parsed.isSuccess")).select(
        "queueName", "messageIdHex", "parsed.format", "parsed.error", "parsed.originalPayload", "parsed.originalSize"
    )


def parse_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("queueName").agg(
        F.count_if("parsed.isSuccess").alias("parseSuccess"), F.count_if(~F.col("parsed.isSuccess")).alias("parseFailure")
    )

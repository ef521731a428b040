"""JSON and XML values of a text column."""

from __future__ import annotations

import json
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from waybill.functions.charset import CONTROL, trimmed

# Leading zeros and raw control characters are let through; quotes and NaN are not relaxed. The reader's own
# limits on strings and numbers are lifted, its limit on levels is what a task's stack of 1 MB holds while a VARIANT is built.
MOST_LEVELS = 1_500
_JSON_OPTIONS = {
    "maxStringLen": "2147483647",
    "maxNumLen": "2147483647",
    "maxNestingDepth": str(MOST_LEVELS),
    "allowNumericLeadingZeros": "true",
    "allowUnquotedControlChars": "true",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def json_variant(text: Column) -> Column:
    """VARIANT of the first JSON value in ``text``; null when there is none.

    Blank text is an empty object, a later duplicate key wins, anything after the first value is ignored.
    """
    body = trimmed(text)
    number = F.regexp_extract(body, r"\A-?[0-9.eE+\-]*", 0)
    return (
        F.when(text.rlike(r'\A[ \t\r\n]*[{\["]'), F.from_json(text, "variant", _JSON_OPTIONS))  # nearly all
        .when(body == "", F.parse_json(F.lit("{}")))
        .when(body.rlike(r"\A[-0-9]") & number.rlike("[.eE]"), number.try_cast("double").cast("variant"))
        .when(body.rlike(r"\A[-0-9]"), number.try_cast("bigint").cast("variant"))
        .when(body.startswith("true"), F.lit(True).cast("variant"))
        .when(body.startswith("false"), F.lit(False).cast("variant"))
        .when(body.startswith("null"), F.parse_json(F.lit("null")))
        .otherwise(F.from_json(body, "variant", _JSON_OPTIONS))
    )


def xml_fields(text: Column, schema: DataType | str) -> Column:
    """Typed fields of an XML document, JVM-side. Malformed text gives null."""
    guard = F.from_xml(text, "struct<_corrupt_record:string>")
    well_formed = text.isNotNull() & guard["_corrupt_record"].isNull()
    return F.from_xml(F.when(well_formed, text), schema)


class _Document:
    """Collects one XML document into nested dicts: repeated children become lists, attributes of a
    parent are ``@name``, a leaf with attributes keeps its text under ``_text``."""

    def __init__(self) -> None:
        self.stack: list[list] = [["", {}, [], {}]]  # label, attributes, text, children

    def start(self, name: str, attributes: dict) -> None:
        kept = {k: v for k, v in attributes.items() if k != "xmlns" and not k.startswith("xmlns:")}
        self.stack.append([name.rpartition(":")[2], kept, [], {}])

    def text(self, data: str) -> None:
        self.stack[-1][2].append(data)

    def end(self, _name: str) -> None:
        label, attributes, text, children = self.stack.pop()
        if children:
            value = {k: v[0] if len(v) == 1 else v for k, v in children.items()}
            value.update({f"@{k}": v for k, v in attributes.items()})
        elif attributes:
            value = {**attributes, "_text": "".join(text).strip(CONTROL)}
        else:
            value = "".join(text).strip(CONTROL)
        self.stack[-1][3].setdefault(label, []).append(value)

    def root(self) -> dict:
        return {k: v[0] for k, v in self.stack[0][3].items()}


def _xml_to_json(text: str | None) -> str | None:
    if text is None:
        return None
    document, parser = _Document(), expat.ParserCreate()
    parser.StartElementHandler = document.start
    parser.EndElementHandler = document.end
    parser.CharacterDataHandler = document.text
    try:
        parser.Parse(text, True)
    except (expat.ExpatError, ValueError):
        return None
    return _dumps(document.root())


def _dumps(value: dict) -> str:
    """JSON text of nested dicts, lists and strings of any depth."""
    out: list[str] = []
    # What is still to be written: values, and pieces of text in tuples.
    left: list = [value]
    while left:
        at = left.pop()
        if isinstance(at, tuple):
            out.append(at[0])
        elif isinstance(at, str):
            out.append(json.dumps(at, ensure_ascii=False))
        elif isinstance(at, list):
            parts = [x for v in at for x in ((", ",), v)][1:]
            left += [("]",), *reversed(parts), ("[",)]
        else:
            parts = [x for k, v in at.items() for x in ((", ",), (json.dumps(k, ensure_ascii=False) + ": ",), v)][1:]
            left += [("}",), *reversed(parts), ("{",)]
    return "".join(out)


def _levels(text: Column) -> Column:
    """How deep the brackets outside of strings nest."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), '"[^"]*"', "")
    brackets = F.split(F.regexp_replace(bare, r"[^\[\]{}]+", ""), "")

    def step(state: Column, bracket: Column) -> Column:
        now = state["now"] + F.when(bracket.isin("{", "["), 1).when(bracket.isin("}", "]"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    return F.aggregate(brackets, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step)["most"]


def too_deep(text: Column) -> Column:
    """Whether JSON text nests deeper than a VARIANT may. Only text with so many brackets is looked through."""
    many = F.length(text) - F.length(F.translate(text, "{[", "")) > MOST_LEVELS
    return F.coalesce(F.when(many, _levels(text) > MOST_LEVELS), F.lit(False))


def variant_of_json(text: Column) -> Column:
    """VARIANT of JSON text that is known to be right, without the reader's own limits."""
    return F.from_json(text, "variant", _JSON_OPTIONS)


@F.arrow_udf(StringType())
def xml_json(text: pa.Array) -> pa.Array:
    """``{root: value}`` of each XML document as JSON text; null for malformed or missing text.

    Built-in ``from_xml`` types the leaves and drops the root label, so the full document shape needs
    an Arrow-batched function. Pass null for rows that are not XML: they cost nothing here. Only one document of a
    batch is held as Python text at a time.
    """
    return pa.array((None if t is None else _xml_to_json(t) for t in (v.as_py() for v in text)), pa.string())


# Or a filter on what was parsed is worked out below the parser too, in a second Python worker of every task that reads
# every document once more. Filters on headers belong in front of the parser.
xml_json = xml_json.asNondeterministic()

"""Payload decoding by coded character set id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coded character set id -> charset. Any other id is read as UTF-8.
CCSID_CHARSETS = {
    1208: "UTF-8",
    819: "ISO-8859-1",
    437: "Cp437",
    500: "Cp500",
    37: "Cp037",
    1252: "windows-1252",
}

# Everything Java's String.trim strips: U+0000 to U+0020.
CONTROL = "".join(chr(c) for c in range(0x21))


def decode_payload(payload: Column, ccsid: Column) -> Column:
    """Text of ``payload`` in its own charset; malformed bytes become U+FFFD (see ``session.prepare``)."""
    others = [(cid, name) for cid, name in CCSID_CHARSETS.items() if name != "UTF-8"]
    return reduce(
        lambda case, entry: case.when(ccsid == entry[0], F.decode(payload, entry[1])),
        others[1:],
        F.when(ccsid == others[0][0], F.decode(payload, others[0][1])),
    ).otherwise(utf8(payload))


def utf8(payload: Column) -> Column:
    return F.decode(payload, "UTF-8")


def trimmed(text: Column) -> Column:
    """``text`` without leading and trailing control characters and blanks."""
    return F.btrim(text, F.lit(CONTROL))

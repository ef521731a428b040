import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from waybill.session import build_session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return build_session("tests", cores="8", memory="6g")


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def messages(spark):
    """Build a message table from dicts; what a dict leaves out takes the defaults."""
    from pyspark.sql import functions as F

    from waybill.sources.envelopes import as_messages

    def build(*rows: dict):
        full = [
            (
                r.get("id", i + 1),
                r.get("queue", "TEST.QUEUE"),
                r.get("payload", "x") if isinstance(r.get("payload", "x"), bytes) else r.get("payload", "x").encode(),
                r.get("ms", 1_700_000_000_000 + i),
                r.get("ccsid", 1208),
                r.get("format", ""),
                r.get("backout", 0),
            )
            for i, r in enumerate(rows)
        ]
        schema = "id bigint, queue string, body binary, ms bigint, ccsid int, fmt string, backout int"
        df = spark.createDataFrame(full, schema)
        return as_messages(
            df,
            F.col("id"),
            F.col("queue"),
            F.col("body"),
            F.timestamp_millis("ms"),
            ccsid=F.col("ccsid"),
            format=F.col("fmt"),
            backoutCount=F.col("backout"),
        )

    return build

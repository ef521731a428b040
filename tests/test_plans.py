"""Plans that must hold at scale."""

import re

import pytest

import __spark_entry__ as contract
from waybill.plans import views


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as for inputs far too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_no_pairs_and_no_row_functions(spark, folder, name, no_broadcast):
    text = plan(contract.queries()[name](spark, folder))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas", "collect_set"):
        assert bad not in text


@pytest.mark.parametrize("name", ["claim_batch", "browse_batch", "multi_queue_claim"])
def test_claims_read_the_payload_for_picked_ids_only(spark, folder, name, no_broadcast):
    text = plan(contract.queries()[name](spark, folder))
    assert text.count("FileScan") == 2 and "BroadcastHashJoin" in text  # the written pick, and one payload scan


def test_deduplication_is_cut_before_the_shuffle(spark, folder, no_broadcast):
    text = plan(contract.queries()["dedup_messages"](spark, folder))
    final, exchange, partial = (text.index(s) for s in ("Final", "Exchange", "Partial"))
    assert final < exchange < partial and text.count("Exchange") == 1


@pytest.mark.parametrize("name", ["processing_times", "throughput", "error_counts", "in_flight", "poll_stats"])
def test_header_queries_do_not_read_payloads(spark, folder, name, no_broadcast):
    text = plan(contract.queries()[name](spark, folder))
    assert "props" not in text and "partial_" in text


@pytest.mark.parametrize("name", ["detect_format", "json_parse", "chunk_payload", "retry_plan", "redact_text", "size_check"])
def test_row_wise_queries_do_not_shuffle(spark, folder, name, no_broadcast):
    text = plan(contract.queries()[name](spark, folder))
    assert "Exchange" not in text and not re.search(r"Python|Pandas", text)


def test_inline_chunk_reduction_does_not_shuffle(spark, folder):
    from pyspark.sql import functions as F

    from waybill.operators import chunks

    total = chunks.reduce_payload(F.col("payload"), lambda c: F.octet_length(c), lambda a, b: a + b, 100)
    assert "Exchange" not in plan(views.documents(spark, folder).select(total))

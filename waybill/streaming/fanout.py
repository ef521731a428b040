"""Writing one audit stream to several sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybill.operators import audit

Sink = Callable[[DataFrame, int], None]


def text_sink(path: str, line) -> Sink:
    """Lines of text, one folder per micro-batch; ``line`` gives the column."""
    return lambda batch, batch_id: (
        batch.select(line().alias("value")).write.mode("overwrite").text(f"{path}/batch={batch_id}")
    )


def console_sink(path: str) -> Sink:
    return text_sink(path, audit.console_line)


def json_sink(path: str) -> Sink:
    return text_sink(path, audit.json_line)


def table_sink(path: str) -> Sink:
    return lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def noop_sink() -> Sink:
    return lambda batch, batch_id: batch.write.format("noop").mode("overwrite").save()


def filtering_sink(sink: Sink, keep: Callable[[DataFrame], DataFrame]) -> Sink:
    return lambda batch, batch_id: sink(keep(batch), batch_id)


def errors_only_sink(sink: Sink) -> Sink:
    return filtering_sink(sink, audit.errors_only)


def composite_sink(*sinks: Sink) -> Sink:
    """Every sink in order, over a batch that is computed once."""

    def emit(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(kept, batch_id)
        finally:
            kept.unpersist()

    return emit


def write_audit(events: DataFrame, sink: Sink, checkpoint: str) -> StreamingQuery:
    return (
        events.select(*[F.col(f) for f in audit.FIELDS])
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

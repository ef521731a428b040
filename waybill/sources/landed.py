"""Landed message tables: loads that appear whole, in order, and a stream that takes a bounded number of rows of them.

A load is a folder of Parquet files in queue order and an entry that names them with their rows. The entry decides: a load
without one isn't there. Loads are numbered, so all rows of a queue have one place each, and a stream's offset is a place
per queue. Nothing depends on the clocks or names of files.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from waybill.sources.manifest import DIGITS, latest_version, put_entry, read_entries
from waybill.sources.messages import TABLE_SCHEMA

ORDER = ["queueName", "timestamp", "messageIdHex"]
LOADS = "_loads"
FORMAT = "waybill_landed"
_ENTRY = "load string, files array<struct<queue: string, file: string, rows: bigint>>"
#: Rows that one task of a micro-batch reads at most.
TASK_ROWS = 50_000
#: Rows of a row group and of a file. A micro-batch decodes its first row group from the beginning and reads the footer
#: of its file, so both are bounded whatever the size of a load.
GROUP_ROWS, FILE_ROWS = 10_000, 200_000


def land(messages: DataFrame, path: str) -> int:
    """Append a load and return its number. Inside a load the rows of a queue stand in (time, id) order.

    Queues are cut into ranges by size, so a hot one is written by many tasks. A writer that dies leaves files that
    no reader sees; two writers at once get numbers of their own.
    """
    spark = messages.sparkSession
    load = f"load={uuid.uuid4().hex}"
    laid = messages.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    writer = laid.write.partitionBy("queueName").option("maxRecordsPerFile", FILE_ROWS)
    writer.option("parquet.block.row.count.limit", GROUP_ROWS).parquet(f"{path}/{load}")
    schema = StructType([f for f in messages.schema.fields if f.name != "queueName"])
    # Reads footers only. The file name's first number is the task's, and with it the range's, its last one the file's.
    counted = (
        spark.read.schema(schema)
        .parquet(f"{path}/{load}/*")
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count("*").alias("rows"))
    )
    files = []
    for row in counted.collect():
        folder, name = unquote(urlparse(row["file"]).path).rsplit("/", 2)[1:]
        # A Hive folder name is escaped once more.
        files.append({"queue": unquote(folder.split("=", 1)[1]), "file": f"{load}/{folder}/{name}", "rows": row["rows"]})
    files.sort(key=lambda f: (f["queue"], *_numbers(f["file"])))
    while True:
        version = latest_version(loads(spark, path)) + 1
        if put_entry(spark, f"{path}/{LOADS}", version, {"load": load, "files": files}):
            return version


def _numbers(file: str) -> tuple[int, int, str]:
    """Task and number of a file among those that the task wrote for the queue."""
    name = file.rsplit("/", 1)[1]
    task, count = re.match(r"part-(\d+)", name), re.search(r"\.c(\d+)\.", name)
    return int(task[1]) if task else 0, int(count[1]) if count else 0, name


def loads(spark: SparkSession, path: str) -> DataFrame:
    """``version, load, files`` of every load."""
    return read_entries(spark, f"{path}/{LOADS}", _ENTRY)


def read_landed(spark: SparkSession, path: str, schema: StructType = TABLE_SCHEMA, files: list[str] | None = None) -> DataFrame:
    """All landed messages with the place of each: ``landedFile`` (below ``path``) and ``landedRow``.

    ``files`` names the files to read, by default those of all loads.
    """
    if files is None:
        files = [r["file"] for r in loads(spark, path).select(F.explode("files").alias("f")).select("f.file").collect()]
    shown = [f.name for f in schema.fields]
    if not files:
        none = spark.createDataFrame([], schema)
        return none.withColumns({"landedFile": F.lit("").cast("string"), "landedRow": F.lit(0).cast("bigint")})
    table = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in files])
    name = F.regexp_extract(F.url_decode(F.col("_metadata.file_path")), r"(load=[0-9a-f]{32}/[^/]+/[^/]+)$", 1)
    return table.select(*shown, name.alias("landedFile"), F.col("_metadata.row_index").alias("landedRow"))


class LandedMessages(DataSource):
    """``spark.readStream.format("waybill_landed")``; see ``stream_landed``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return TABLE_SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        size = int(self.options.get("batchsize", "1000"))
        if size <= 0:
            raise ValueError("batchSize must be positive")
        queues = self.options.get("queues")
        return LandedReader(self.options["path"], schema, size, None if queues is None else json.loads(queues))


class Rows(InputPartition):
    """Rows [first, last) of one file."""

    def __init__(self, queue: str, file: str, first: int, last: int) -> None:
        self.queue, self.file, self.first, self.last = queue, file, first, last


class LandedReader(DataSourceStreamReader):
    """Offsets are ``{"seen": n, "left": {queue: [version, row]}}``: all loads up to n are taken, but for the queues in
    ``left``, which go on at that row of that load."""

    def __init__(self, path: str, schema: StructType, size: int, queues: list[str] | None) -> None:
        self.path, self.kind, self.size, self.queues = path.rstrip("/"), schema, size, queues
        self.at: dict | None = None
        self.known: dict[int, dict[str, list]] = {}

    def initialOffset(self) -> dict:
        return {"seen": 0, "left": {}}

    def latestOffset(self) -> dict:
        """The offset a batch further on: up to ``batchSize`` more rows of each queue."""
        if self.at is None:
            self.at = self.initialOffset()
        latest = self._read_loads(self.at)
        left, taken = {}, 0
        for queue in self._queues(self.at, latest):
            open_ = self.size
            begin = self._place(self.at, queue)
            for version in range(begin[0], latest + 1):
                first = begin[1] if version == begin[0] else 0
                there = sum(rows for _, rows in self._files(version, queue)) - first
                step = min(open_, there)
                open_, taken = open_ - step, taken + step
                if step < there:
                    left[queue] = [version, first + step]
                    break
        if taken:
            self.at = {"seen": latest, "left": left}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # A restarted query asks for its last batch first.
        if self.at is None:
            self.at = end
        self._read_loads(start)
        found = []
        for queue in self._queues(start, end["seen"]):
            begin, stop = self._place(start, queue), self._place(end, queue)
            for version in range(begin[0], min(stop[0], end["seen"]) + 1):
                low = begin[1] if version == begin[0] else 0
                high = stop[1] if version == stop[0] else None
                before = 0
                for file, rows in self._files(version, queue):
                    first = max(low - before, 0)
                    last = rows if high is None else min(high - before, rows)
                    found += [Rows(queue, file, k, min(k + TASK_ROWS, last)) for k in range(first, last, TASK_ROWS)]
                    before += rows
        return found

    def commit(self, end: dict) -> None:
        if self.at is None:
            self.at = end
        needed = min([v for v, _ in end["left"].values()], default=end["seen"] + 1)
        self.known = {v: files for v, files in self.known.items() if v >= needed}

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.kind)
        files, path = self._store()
        with files.open_input_file(f"{path}/{partition.file}") as source:
            file = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
            names = [f.name for f in target if f.name in file.schema_arrow.names]
            before = 0
            for group in range(file.metadata.num_row_groups):
                rows = file.metadata.row_group(group).num_rows
                begin, before = before, before + rows
                if before <= partition.first or begin >= partition.last:
                    continue
                for batch in file.iter_batches(10_000, row_groups=[group], columns=names):
                    first, begin = begin, begin + len(batch)
                    low, high = max(partition.first - first, 0), min(partition.last - first, len(batch))
                    if low >= high:
                        continue
                    part = batch.slice(low, high - low)
                    columns = []
                    for field in target:
                        if field.name == "queueName":
                            value = pa.array([partition.queue] * len(part), field.type)
                        elif field.name in names:
                            value = part.column(field.name)
                            if pa.types.is_timestamp(value.type) and value.type.tz is None:
                                value = value.cast(pa.timestamp(value.type.unit, "UTC"))
                            value = value.cast(field.type)
                        else:
                            value = pa.nulls(len(part), field.type)
                        columns.append(value)
                    yield pa.RecordBatch.from_arrays(columns, schema=target)

    def _store(self):
        from pyarrow import fs

        if urlparse(self.path).scheme:
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def _read_loads(self, start: dict) -> int:
        """Learn the loads that ``start`` has not taken yet; the number of the last one there is."""
        files, path = self._store()
        first = min([v for v, _ in start["left"].values()], default=start["seen"] + 1)
        version = first
        while True:
            if version not in self.known:
                name = f"{path}/{LOADS}/{version:0{DIGITS}d}.json"
                try:
                    with files.open_input_stream(name) as source:
                        entry = json.loads(source.read())
                except FileNotFoundError:
                    return max(version - 1, start["seen"])
                by_queue: dict[str, list] = {}
                for f in entry["files"]:
                    by_queue.setdefault(f["queue"], []).append((f["file"], f["rows"]))
                self.known[version] = by_queue
            version += 1

    def _files(self, version: int, queue: str) -> list:
        return self.known[version].get(queue, []) if version in self.known else []

    def _queues(self, start: dict, latest: int) -> list[str]:
        names = set(start["left"]).union(*[self.known[v] for v in self.known if start["seen"] < v <= latest])
        return sorted(q for q in names if self.queues is None or q in self.queues)

    def _place(self, offset: dict, queue: str) -> list[int]:
        return offset["left"].get(queue, [offset["seen"] + 1, 0])


def stream_landed(spark: SparkSession, path: str, batch_size: int = 1000, queues: list[str] | None = None, schema: StructType = TABLE_SCHEMA) -> DataFrame:
    """The landed messages as a stream that takes at most ``batch_size`` of each queue in a micro-batch, in order.

    Offsets are planned from the row counts of the loads and kept by the query's checkpoint, so a restart reads the
    same rows again. Tasks read only their rows' row groups, through Arrow; the store must be one that pyarrow reaches
    (local, HDFS, S3, GCS). Use ``caught_up`` to run to the end, an available-now trigger would take one batch only.
    """
    spark.dataSource.register(LandedMessages)
    reader = spark.readStream.format(FORMAT).schema(schema).option("batchSize", batch_size)
    if queues is not None:
        reader = reader.option("queues", json.dumps(queues))
    return reader.load(path)


def caught_up(query: StreamingQuery) -> None:
    """Let a running query take all that has landed, and stop it. What it fails with is raised."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()

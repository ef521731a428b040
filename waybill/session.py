"""Session settings every operator relies on, and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import waybill

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # EBCDIC / code page charsets in decode(), and U+FFFD instead of an error on malformed bytes.
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
    # A repeated JSON key keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Keep the per-task top-n pruning for every batch size and limit.
    "spark.sql.optimizer.windowGroupLimitThreshold": "2147483647",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Ids of a whole deduplication span do not fit on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

#: How streams write the files of their checkpoints. Spark's default renames them through FileContext, which asks for links
#: on the way: on a local disk without Hadoop's native library each of these is a process, eight for one file.
CHECKPOINT_FILES = "spark.sql.streaming.checkpointFileManagerClass"
_BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    # Executors need not have this package installed: its functions travel with the tasks.
    cloudpickle.register_pickle_by_value(waybill)
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    # Both ways look for the name and then rename on a local disk. Other stores keep the default, which is stricter there.
    if spark.conf.get(CHECKPOINT_FILES, None) is None and _on_local_disk(spark) and _has_class(spark, _BY_FILE_SYSTEM):
        spark.conf.set(CHECKPOINT_FILES, _BY_FILE_SYSTEM)
    return spark


def _on_local_disk(spark: SparkSession) -> bool:
    """Whether working folders, and with them the checkpoints of the queries, are on a local disk."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    files = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getUri().getScheme() == "file"


def _has_class(spark: SparkSession, name: str) -> bool:
    return bool(spark._jvm.org.apache.spark.util.Utils.classIsLoadable(name))


def build_session(app: str = "waybill", cores: str = "*", memory: str = "8g") -> SparkSession:
    """Local session for tests and benchmarks; on a cluster use spark-submit and ``prepare``."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="waybill-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors can reach, below ``spark.checkpoint.dir``.

    Only where driver and executors are one process (local, local[n]) is a temporary folder set in its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="waybill-")
    return f"{base.rstrip('/')}/waybill/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from executor loss."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def expire(spark: SparkSession, older_than_hours: float) -> int:
    """Delete the working folders below ``spark.checkpoint.dir`` that were last written to so long ago; how many.

    Results that are still read from them (a claim, a materialized step) must be younger.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        return 0
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/waybill")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return 0
    oldest = time.time() * 1000 - older_than_hours * 3_600_000
    old = [s.getPath() for s in files.listStatus(root) if s.getModificationTime() < oldest]
    for path in old:
        files.delete(path, True)
    return len(old)

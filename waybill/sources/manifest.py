"""Numbered entries that appear whole and only once: what loads, leases and batch commits are decided by.

An entry is a small JSON file. It is written under another name first and then given its own, which fails if the name is
taken. So of two writers that ask for one number exactly one gets it, and readers never see half an entry.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 12


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path`` with ``text``, at once and whole. False, and nothing changed, if it is there already."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    target = files.makeQualified(target)
    files.mkdirs(target.getParent())
    # Hidden from Spark's readers by its dot; a crash leaves nothing but that.
    written = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = files.create(written, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if target.toUri().getScheme() == "file":
            # A local rename replaces what is there; a link never does.
            local = [jvm.java.nio.file.Paths.get(p.toUri()) for p in (target, written)]
            return _unless_taken(lambda: jvm.java.nio.file.Files.createLink(*local))
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
        return _unless_taken(lambda: context.rename(written, target, options))
    finally:
        files.delete(written, False)


def _unless_taken(create) -> bool:
    from py4j.protocol import Py4JJavaError

    try:
        create()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def put_entry(spark: SparkSession, folder: str, version: int, entry: dict[str, Any]) -> bool:
    """Make ``entry`` number ``version`` of a folder, unless that number is taken."""
    return put_if_absent(spark, f"{folder}/{version:0{DIGITS}d}.json", json.dumps(entry))


def read_entries(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All entries with their ``version``; none where the folder is missing."""
    try:
        found = spark.read.schema(schema).json(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"version bigint, {schema}")
    version = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1).cast("bigint")
    return found.select(version.alias("version"), "*")


def latest_version(entries: DataFrame) -> int:
    return entries.agg(F.max("version")).first()[0] or 0

"""Working folders."""

import os
from urllib.parse import urlparse

import pytest

from waybill import session
from waybill.sources import landed


def test_only_old_folders_expire(spark):
    old, young = (session.materialize(spark.range(3), name) for name in ("old", "young"))
    folder = os.path.dirname(urlparse(old.inputFiles()[0]).path)
    os.utime(folder, (0, 0))
    assert session.expire(spark, 24 * 365) == 1
    assert not os.path.exists(folder) and young.count() == 3
    assert session.expire(spark, 24 * 365) == 0
    with pytest.raises(Exception, match="FILE_NOT_EXIST|FileNotFound|PATH_NOT_FOUND"):
        old.count()


def test_checkpoints_on_a_local_disk_are_written_without_file_context(spark, monkeypatch):
    key, before = session.CHECKPOINT_FILES, spark.conf.get(session.CHECKPOINT_FILES, None)
    try:
        spark.conf.unset(key)
        session.prepare(spark)
        assert spark.conf.get(key).endswith(".FileSystemBasedCheckpointFileManager")
        spark.conf.set(key, "one.of.the.users")
        session.prepare(spark)
        assert spark.conf.get(key) == "one.of.the.users"
        spark.conf.unset(key)
        monkeypatch.setattr(session, "_on_local_disk", lambda s: False)
        session.prepare(spark)
        assert spark.conf.get(key, None) is None
    finally:
        if before is not None:
            spark.conf.set(key, before)


@pytest.mark.parametrize("first", ["default", "prepared"])
def test_a_checkpoint_goes_on_with_the_other_way_of_writing_it(spark, messages, first):
    """Checkpoints written before and after the setting are read by each other."""
    path, out, seen = session.shared_dir(spark, "landed"), session.shared_dir(spark, "out"), []

    def run():
        stream = landed.stream_landed(spark, path, 2)
        writer = stream.writeStream.foreachBatch(lambda batch, n: seen.append((n, batch.count())))
        landed.caught_up(writer.option("checkpointLocation", out).start())

    def default():
        spark.conf.unset(session.CHECKPOINT_FILES)

    steps = [default, lambda: session.prepare(spark)]
    try:
        for step in steps if first == "default" else steps[::-1]:
            landed.land(messages(*[{"id": i} for i in range(3)]), path)
            step()
            run()
    finally:
        session.prepare(spark)
    assert seen == [(0, 2), (1, 1), (2, 2), (3, 1)]

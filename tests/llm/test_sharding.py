import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import ODD
from waybill.llm import sharding


@pytest.mark.parametrize("law", ["rows", "bytes", "key"])
def test_laws(spark, folder, law):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.assign(docs, 8, law).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), law)
    for shard in range(8):
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))
    counts, sizes = Counter(r.shard for r in rows), Counter()
    for r in rows:
        sizes[r.shard] += r.size
    if law == "rows":
        assert max(counts.values()) - min(counts.values()) <= 1
    if law == "bytes":
        assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)
    if law == "key":
        assert all(r.grown_shard in (r.shard, 8) for r in rows) and any(r.grown_shard == 8 for r in rows)
    else:
        assert all(r.grown_shard is None for r in rows)


def test_same_seed_same_shards(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    a, b, c = ({r.doc_id: (r.shard, r.slot) for r in sharding.assign(docs, 8, "rows", seed).collect()} for seed in (1, 1, 2))
    assert a == b and a != c


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(sharding.fisher_yates(3, seed).tolist()) for seed in range(6000))
    assert len(seen) == 6 and all(abs(n - 1000) < 150 for n in seen.values())
    assert np.array_equal(np.sort(sharding.fisher_yates(1000, 1)), np.arange(1000))


@pytest.mark.parametrize("law", ["rows", "bytes", "key"])
def test_odd_rows(odd, none, law):
    rows = sharding.assign(odd, 3, law).collect()
    assert len(rows) == len(ODD)
    assert sorted(r.size for r in rows) == sorted(len((t or "").encode()) + 1 for _, t, *_ in ODD)
    assert sharding.assign(none, 3, law).collect() == []
    with pytest.raises(ValueError):
        sharding.assign(odd, 3, "other")


def test_written_shards(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assigned = sharding.assign(docs, 4)
    sharding.write_shards(docs, assigned, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.text) for r in back.collect()} == {(r.doc_id, r.text) for r in docs.collect()}


def test_shards_hold_every_record_in_shuffled_order(spark, tmp_path):
    rows = [(k if k % 3 else None, f"text {k}", k) for k in range(200)] + [(7, "again", 200), (7, "again", 201), (1, None, 202)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, own bigint")
    sharding.write_shards(docs, sharding.assign(docs, 4, "rows"), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(back) == len(rows)
    assert {r.own: (r.doc_id, r.text) for r in back} == {o: (k, t) for k, t, o in rows}
    for shard in range(4):
        assert sorted(r.slot for r in back if r.shard == shard) == list(range(sum(r.shard == shard for r in back)))


def test_buckets_hold_records_and_are_sized_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LEAST_BUCKETS", 1)
    monkeypatch.setattr(sharding, "BUCKET_BYTES", 100_000)
    docs = spark.createDataFrame([(k, "x" * 50_000) for k in range(40)], "doc_id bigint, text string")
    rows = sharding.shuffled(docs).collect()
    assert all(r.record.text == "x" * 50_000 for r in rows) and len(rows) == 40
    assert max(Counter(r.bucket for r in rows).values()) <= 8


def test_query_reads_what_was_written(spark, folder):
    from waybill.llm.queries import op6_external_shuffle

    found = op6_external_shuffle(spark, folder)
    assert all("shards" in f for f in found.inputFiles())
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_tables_with_columns_of_the_same_names(odd, none, tmp_path):
    docs = odd.withColumnRenamed("n_chars", "Slot") if "slot" not in odd.columns else odd
    docs = docs.withColumnRenamed("lang", "_shard")
    names = sharding.write_shards(docs, sharding.assign(docs, 3, "rows"), str(tmp_path / "out"))
    assert names == ("__shard", "_slot")
    back = sharding.read_shards(docs, str(tmp_path / "out"), names)
    assert sorted(map(str, back.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert sorted(r["_slot"] for r in back.where("__shard = 0").collect()) == [0, 1, 2, 3]
    names = sharding.write_shards(none, sharding.assign(none, 3, "bytes"), str(tmp_path / "none"))
    assert sharding.read_shards(none, str(tmp_path / "none"), names).count() == 0


def test_totals_of_many_buckets_are_joined_without_a_broadcast(spark, monkeypatch):
    docs = spark.range(500).selectExpr("id AS doc_id", "repeat('x', cast(id AS int)) AS text")
    places = lambda: sorted((r.doc_id, r.shard, r.slot) for r in sharding.assign(docs, 4, "bytes").collect())
    few = places()
    monkeypatch.setattr(sharding, "BROADCAST_BUCKETS", 3)
    assert places() == few

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from waybill.llm import near_dups, outliers, secret_scan, toxicity
from waybill.llm.queries import learned_toxicity


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == ["quality rules", "toxicity", "near-duplicates", "secrets", "packing"]
    verdict = {r.doc_id: r.kept for r in outliers.judge(docs).collect()}
    first = pipeline.quality_rules(spark, docs, folder)
    assert {r.doc_id for r in first.collect()} == {k for k, v in verdict.items() if v}
    model = learned_toxicity(spark, folder)
    clean = {r.doc_id for r in toxicity.score(first, model).collect() if not r.predicted}
    second = pipeline.toxicity_filter(spark, first, folder)
    assert {r.doc_id for r in second.collect()} == clean
    third = pipeline.near_duplicate_filter(spark, second, folder)
    kept = {r.doc_id for r in near_dups.near_duplicates(second).collect() if r.kept}
    assert {r.doc_id for r in third.collect()} == kept
    fourth = pipeline.secret_mask(spark, third, folder)
    assert not any(r.spans for r in secret_scan.scan_documents(fourth).collect())
    assert all(x.columns == docs.columns for x in (first, second, third, fourth))
    pieces = Counter()
    for r in pipeline.curve_packing(spark, fourth, folder).collect():
        pieces[r.doc_id] += r.length
    assert set(pieces) == kept


def test_repeated_keys_are_judged_by_their_texts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("mark", F.lit(1))
    kept = {r.doc_id for r in pipeline.quality_rules(spark, docs, folder).collect()}
    again = docs.withColumn("text", F.lit("far too short"))
    keyless = docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(None).cast("string"))
    found = pipeline.quality_rules(spark, docs.unionByName(again).unionByName(keyless), folder)
    assert found.columns == docs.columns
    assert sorted(r.doc_id for r in found.collect()) == sorted(kept)
    assert found.where("text = 'far too short'").count() == 0


def test_whole_run(spark, folder):
    assert pipeline.run(spark, folder).count() > 0 and pipeline.ORACLE_SQL is None


def test_no_documents_and_odd_ones(spark, folder, make, odd):
    for docs in (make([]), odd):
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, folder)
        docs.collect()

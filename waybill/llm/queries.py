"""One query for each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import (
    bpe,
    fingerprints,
    html_extract,
    importance,
    lm,
    mixing,
    near_dups,
    outliers,
    packing,
    secret_scan,
    sharding,
    toxicity,
    variants,
)
from waybill.llm import sql as checks
from waybill.llm.common import table
from waybill.llm.registry import query
from waybill.session import shared_dir


def learned_toxicity(spark: SparkSession, folder: str) -> toxicity.Model:
    """The model of a folder's labels, without those of the held-out rows."""
    labels = table(spark, folder, "labels").where(~held_out(4, 2))
    return toxicity.fit(table(spark, folder, "documents"), labels)


def held_out(parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == part, F.lit(False))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    model = learned_toxicity(spark, folder)
    scored = toxicity.score(table(spark, folder, "documents"), model)
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


@query("op10_bpe")
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(table(spark, folder, "documents")))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op2_curve_packing")
def op2_curve_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op3_minhash_dedup")
def op3_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, folder, "documents"), words=4)


@query("op4_wrapper_text")
def op4_wrapper_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_extract.extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op5_robust_outliers")
def op5_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.judge(table(spark, folder, "documents"))


@query("op7_log_bilinear")
def op7_log_bilinear(spark: SparkSession, folder: str) -> DataFrame:
    scored = lm.score(table(spark, folder, "documents"), ~held_out(5, 1))
    return scored.withColumn("held_out", held_out(5, 1))


@query("op8_bottom_k")
def op8_bottom_k(spark: SparkSession, folder: str) -> DataFrame:
    found = fingerprints.edited(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.text_of(F.col("sketch")).alias("fingerprint"),
        fingerprints.text_of(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


@query("op6_external_shuffle")
def op6_external_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    docs, path = table(spark, folder, "documents"), shared_dir(spark, "shards")
    names = sharding.write_shards(docs, sharding.assign(docs, shards=8, law="rows"), path)
    text = F.coalesce("text", F.lit(""))
    return sharding.read_shards(docs, path, names).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col(names[0]).alias("shard"),
        F.col(names[1]).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_nested_secrets")
def op9_nested_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_documents(table(spark, folder, "documents"))
    plain = F.filter("spans", lambda s: s["depth"] == 0)
    count = lambda kind: F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in secret_scan.KINDS],
        F.sha2(secret_scan.listing(plain).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listing(F.col("spans")).alias("spans"),
        "cut",
    )


@query("op11_cube_mixing")
def op11_cube_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op12_importance", checks.IMPORTANCE)
def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_variants", checks.VARIANTS)
def op13_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.group_variants(table(spark, folder, "documents"))

"""The corpus pipeline: quality rules, toxicity, near-duplicates, secrets, packing.

Every stage takes what its predecessor kept; all but the last return the columns of the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import near_dups, outliers, packing, secret_scan, toxicity
from waybill.llm.common import free_name, table
from waybill.llm.queries import learned_toxicity
from waybill.llm.registry import query
from waybill.session import materialize, prepare

#: Score from which a document counts as toxic and goes.
TOXIC = 0.3


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or lie far from their language and source go.

    Told row by row: rows that repeat a key are judged by their own texts, also under a null key. Null and empty texts
    fail the base rules; a null language or source is one of its own; equal rows go or stay together; a very long text
    counts as a whole. An empty table stays empty. Further columns are carried along, whatever their names.
    """
    prepare(spark)
    mark = free_name(docs.columns, "mark")
    names = F.to_json(F.array(*[F.col(c).cast("string") for c in ("doc_id", "lang", "source")]), {"ignoreNullFields": "false"})
    marked = docs.withColumn(mark, F.concat(F.md5(F.coalesce("text", F.lit("")).cast("binary")), names))
    lost = outliers.judge(marked, key=mark).where(~F.col("kept")).select(F.col("doc_id").alias(mark)).distinct()
    return marked.join(materialize(lost, "lost"), mark, "left_anti").select(docs.columns)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxic score go; the model is learned from the labels of the whole table.

    Null and empty texts have a score too; repeated rows go or stay together; a very long text is scored as a whole.
    An empty table stays empty. Further columns are carried along, whatever their names.
    """
    model = learned_toxicity(prepare(spark), sf_dir)
    score = free_name(docs.columns, "toxic")
    return toxicity.with_score(docs, model, column=score).where(F.col(score) < TOXIC).drop(score)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more) one document stays.

    It is the one with the smallest key, a null key last, any one of rows that repeat it. A repeated key alone links
    nothing; documents without words all stay. An empty table stays empty. Further columns are carried along.
    """
    prepare(spark)
    return near_dups.one_of_each(docs)


def secret_mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, also where they are encoded; what could not be decoded to its end is masked as a whole.

    Every row stays and is masked by itself, repeated ones alike; null and empty texts stay as they are. An empty table
    stays empty. Further columns are carried along.
    """
    prepare(spark)
    return secret_scan.mask_documents(docs)


def curve_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4,096 tokens of neighbouring documents.

    Null and empty texts are their end mark alone; a very long text is cut into pieces; every repeated row is packed.
    An empty table gives no pieces. Further columns are left out.
    """
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near-duplicates", near_duplicate_filter),
    ("secrets", secret_mask),
    ("packing", curve_packing),
]

#: Robust estimates, learned weights and Hilbert order are not SQL.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

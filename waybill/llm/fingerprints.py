"""Bottom-k fingerprints of documents: the k smallest hashes of a text's word shingles.

They merge across parts of a text or table, and estimate resemblance, containment and the number of distinct
shingles; under k shingles all three are exact. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.llm.common import keyed_text
from waybill.llm.outliers import _once, shingles, word_hashes

#: Hashes kept and words of a shingle.
K, WORDS = 128, 5
#: Ranges of keys for each shuffle partition, so that none holds much more than another.
RANGES = 4
_LONG = (1 << 63) - 1


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    """Sorted ``array<long>`` of the k smallest shingle hashes (0 to 2^63 - 1); fewer words count as one shingle.

    A text without words, or null, has the empty sketch.
    """

    def low(h: Column) -> Column:
        whole = F.array(F.aggregate(h, F.lit(42).cast("long"), lambda a, b: F.xxhash64(a, b)))
        runs = F.when(F.size(h) >= words, shingles(h, words)).when(F.size(h) > 0, whole).otherwise(F.array().cast("array<long>"))
        kept = F.transform(runs, lambda x: x.bitwiseAND(F.lit(_LONG)))
        return F.slice(F.sort_array(F.array_distinct(kept)), 1, k)

    return _once(word_hashes(F.coalesce(text, F.lit(""))), low)


def merge(sketches: DataFrame, group: str, column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of parts: what the sketch of all their shingles together would be.

    Every hash is a row, cut to the k smallest of a group before the shuffle, so no group is gathered whole.
    Groups whose parts are all empty or null have the empty sketch.
    """
    each = sketches.select(group, F.explode(column).alias("hash")).distinct()
    order = Window.partitionBy(group).orderBy("hash")
    low = each.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    merged = low.groupBy(group).agg(F.sort_array(F.collect_list("hash")).alias(column))
    groups = sketches.select(F.col(group).alias("_group")).distinct()
    joined = groups.join(merged, F.col("_group").eqNullSafe(F.col(group)), "left")
    return joined.select(F.col("_group").alias(group), F.coalesce(column, F.array().cast("array<long>")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets; 1 for two empty ones."""
    shared = lambda u: F.size(F.array_intersect(F.array_intersect(a, b), u)) / F.size(u)
    low = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(_once(low, shared))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / (F.get(a, F.lit(k - 1)) / float(_LONG)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    union = distinct_count(F.slice(F.sort_array(F.array_union(a, b)), 1, k), k)
    share = resemblance(a, b, k) * union / distinct_count(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), share))


def text_of(a: Column) -> Column:
    """A sketch as a string: hexadecimal hashes joined by commas."""
    return F.array_join(F.transform(a, lambda x: F.lower(F.hex(x))), ",")


def _range_number(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``key``, found in two steps of the bounds' square root."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    rows = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    row = F.size(F.filter(longs([r[0] for r in rows]), lambda x: x <= key))
    inside = F.size(F.filter(F.get(F.array(*[longs(r) for r in rows]), row - 1), lambda x: x <= key))
    return F.when(row > 0, (row - 1) * step + inside).otherwise(0)


def beside_next(docs: DataFrame, extra: dict[str, Column] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text``, the columns of ``extra`` (made of the text), and of the next row ``next_<name>`` for each.

    The order is that of the integer keys, null first, repeated keys by a hash of their texts; after the last row
    comes the first one with a key. Rows are dealt out by ranges between approximate quantiles of the key, each of
    which is a key that exists, so the rows of a bound also go to the range before it, as what comes next there.
    """
    spark, extra = docs.sparkSession, extra or {}
    source = keyed_text(docs, key, text).withColumn("doc_id", F.col("doc_id").cast("long"))
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [i / ranges for i in range(1, ranges)]
    found = source.agg(F.percentile_approx("doc_id", at, 10 * ranges).alias("bounds"), F.min("doc_id").alias("first")).first()
    bounds = sorted(set(found["bounds"] or []))
    is_bound = _range_number(F.col("doc_id"), bounds) > _range_number(F.col("doc_id") - 1, bounds)
    place = lambda number, ghost: F.struct(number.alias("range"), F.lit(ghost).alias("ghost"))
    number = _range_number(F.col("doc_id"), bounds)
    places = F.array(
        place(number, 0),
        F.when(is_bound, place(number - 1, 1)),
        F.when(F.col("doc_id") == F.lit(found["first"]), place(F.lit(len(bounds)), 2)),
    )
    dealt = source.withColumn("place", F.explode(F.filter(places, lambda p: p.isNotNull()))).select("place.range", "place.ghost", "doc_id", "text")
    made = dealt.repartition("range").select("*", *[c.alias(n) for n, c in extra.items()])
    order = Window.partitionBy("range").orderBy("ghost", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    after = [F.lead(c).over(order).alias(f"next_{c}") for c in ["text", *extra]]
    return made.select("*", *after).where("ghost = 0").drop("range", "ghost")


def edited(docs: DataFrame, k: int = K, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's sketch, the next row's, and that of the text whose last quarter is the head of the next one.

    ``doc_id, text, edited, sketch, edited_sketch, next_sketch``. In a table of one row the next row is itself.
    """
    both = beside_next(docs, {"sketch": sketch(F.col("text"), k, words)}, key, text)
    cut = F.floor(F.length("text") / 4).cast("int")
    changed = F.concat(F.substring("text", F.lit(1), F.length("text") - cut), F.substring("next_text", F.lit(1), cut))
    return both.withColumn("edited", changed).withColumn("edited_sketch", sketch(F.col("edited"), k, words)).drop("next_text")

"""Quality rules: documents whose statistics lie far from those of their language and source.

Location and scatter of every (language, source) are minimum-covariance-determinant estimates: from medians
and quartile ranges, concentration steps take the closest share of the rows, by Mahalanobis distance, and
estimate again. Each step is one aggregation into distance bins, combined before the shuffle, so a source with
a third of all rows costs no more than another. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.session import materialize

#: Transformed statistics, with the standard deviation that is added to each in any case: what counts as
#: equal enough where a statistic hardly varies (most documents have no symbol at all).
FLOORS = {"log_words": 0.3, "log_word_chars": 0.08, "log_symbols": 0.25, "log_distinct": 0.15, "dup_lines": 0.12, "repeats": 0.12}
#: Share of rows an estimate rests on, concentration steps, and rows below which groups are taken together.
SHARE, STEPS, LEAST_ROWS = 0.75, 3, 60
#: Probability that a row of a normal distribution is rejected.
REJECT = 1e-8
_BLANK = "[\\x20\\x09-\\x0D]+"
_NAMES = list(FLOORS)
_P = len(_NAMES)
_LOWER = [(i, j) for i in range(_P) for j in range(i + 1)]


def chi_square(tail: float, freedom: int = _P) -> float:
    """The value an even number of squared standard normals exceeds with probability ``tail``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        above = math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))
        low, high = (x, high) if above > tail else (low, x)
    return low


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it stands in there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(text, _BLANK), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingles(hashes: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in text order; ``hashes`` must be a bound value."""
    starts = F.when(F.size(hashes) >= width, F.sequence(F.lit(0), F.size(hashes) - width)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))


def repeated_words(hashes: Column, width: int = 8) -> Column:
    """Words in runs of ``width`` words that the text has more than once."""

    def covered(runs: Column) -> Column:
        pairs = F.sort_array(F.transform(runs, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, k: (F.get(s, k)["x"] == x["x"])
            found = F.transform(s, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
            return F.sort_array(F.filter(found, lambda i: i.isNotNull()))

        def span(p: Column) -> Column:
            lengths = F.transform(p, lambda i, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - i, F.lit(width))))
            return F.aggregate(lengths, F.lit(0), lambda a, b: a + b)

        return _once(_once(pairs, places), span)

    def of(runs: Column) -> Column:
        # Most texts repeat nothing, and a hash set shows it.
        return F.when(F.size(F.array_distinct(runs)) < F.size(runs), covered(runs)).otherwise(F.lit(0))

    return _once(shingles(hashes, width), of)


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts of every row's whole text; a null text has no words, a null language or source is a value of its own."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    base = docs.select(
        F.col(key).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), body.alias("text")
    )
    counts = lambda h: F.struct(
        F.size(h).alias("n_words"), F.size(F.array_distinct(h)).alias("n_distinct"), repeated_words(h).alias("n_repeat_words")
    )
    bare = F.regexp_replace("text", _BLANK, "")
    counted = base.select(
        "doc_id",
        "lang",
        "source",
        _once(word_hashes(F.col("text")), counts).alias("of_words"),
        F.length(bare).alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]+", ""))).alias("n_symbols"),
        _once(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))).alias("of_lines"),
    )
    whole = ["of_words.n_words", "word_chars", "n_symbols", "of_lines.n_dup_lines", "of_words.n_repeat_words", "of_words.n_distinct", "of_lines.n_lines"]
    return counted.select("doc_id", "lang", "source", *[F.col(c).cast("long").alias(c.split(".")[-1]) for c in whole])


def vectors(stats: DataFrame) -> DataFrame:
    """The transformed statistics of rows with words."""
    n, chars = F.col("n_words"), F.greatest("word_chars", F.lit(1))
    return stats.withColumns(
        {
            "log_words": F.log1p(n),
            "log_word_chars": F.log(chars / F.greatest(n, F.lit(1))),
            "log_symbols": F.log1p(100 * F.col("n_symbols") / chars),
            "log_distinct": F.log(F.greatest("n_distinct", F.lit(1)) / F.greatest(n, F.lit(1))),
            "dup_lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
            "repeats": F.col("n_repeat_words") / F.greatest(n, F.lit(1)),
        }
    )


def _grouped(rows: DataFrame, least: int) -> DataFrame:
    """``rows`` with ``g``: the (language, source), or small ones of a language together, or small languages together."""
    key = lambda *c: F.to_json(F.array(*c))
    full = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    fine = full.withColumn("small", F.col("n") < least)
    pooled = fine.where("small").groupBy(F.col("lang").alias("pool")).agg(F.sum("n").alias("m"))
    group = F.when(~F.col("small"), key("lang", "source")).when(F.col("m") >= least, key("lang")).otherwise("[]")
    names = fine.join(pooled, F.col("lang").eqNullSafe(F.col("pool")), "left").select(
        F.col("lang").alias("l"), F.col("source").alias("s"), group.alias("g")
    )
    return rows.join(names, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s"))).drop("l", "s")


def _quartiles(rows: DataFrame) -> DataFrame:
    """Start of the estimates: medians, and quartile ranges for an inverse scatter without correlation."""
    step = 1 / 256
    marks = F.array(*[F.round(F.col(c) / step).cast("int") for c in _NAMES])
    counted = rows.select("g", F.posexplode(marks).alias("i", "mark")).groupBy("g", "i", "mark").agg(F.count("*").alias("n"))
    part = Window.partitionBy("g", "i")
    upto = counted.withColumn("upto", F.sum("n").over(part.orderBy("mark"))).withColumn("total", F.sum("n").over(part))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("mark"))) * step
    each = upto.groupBy("g", "i").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))
    floor = F.get(F.array(*[F.lit(f) for f in FLOORS.values()]), F.col("i"))
    wide = F.struct(F.col("q2"), (1 / F.sqrt(F.pow((F.col("q3") - F.col("q1")) / 1.349, 2) + floor * floor)).alias("w"))
    one = each.groupBy("g").agg(*[F.max(F.when(F.col("i") == k, wide)).alias(f"s{k}") for k in range(_P)])
    means = [F.col(f"s{k}.q2").alias(f"m{k}") for k in range(_P)]
    inverse = [(F.col(f"s{i}.w") if i == j else F.lit(0.0)).alias(f"w{i}_{j}") for i, j in _LOWER]
    return one.select("g", *means, *inverse)


def _distance() -> Column:
    """Squared Mahalanobis distance by the inverse of the scatter's Cholesky factor (w)."""
    gap = [F.col(c) - F.col(f"m{k}") for k, c in enumerate(_NAMES)]
    parts = [sum((F.col(f"w{i}_{j}") * gap[j] for j in range(1, i + 1)), F.col(f"w{i}_0") * gap[0]) for i in range(_P)]
    return sum((p * p for p in parts[1:]), parts[0] * parts[0])


def _inverse_factor(moments: DataFrame) -> DataFrame:
    """Means m and inverse Cholesky factor w from sums of values and products, one column after another."""
    n = F.col("n")
    out = moments.withColumns({f"m{k}": F.col(f"t{k}") / n for k in range(_P)})
    floor = list(FLOORS.values())
    cov = lambda i, j: F.col(f"t{i}_{j}") / n - F.col(f"m{i}") * F.col(f"m{j}") + (floor[i] ** 2 if i == j else 0.0)
    out = out.withColumns({f"c{i}_{j}": cov(i, j) for i, j in _LOWER})
    for i, j in _LOWER:
        rest = F.col(f"c{i}_{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
        # The added floor keeps the exact value above its square; rounding must not take it below.
        value = F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j else rest / F.col(f"l{j}_{j}")
        out = out.withColumn(f"l{i}_{j}", value)
    for j in range(_P):
        out = out.withColumn(f"w{j}_{j}", 1 / F.col(f"l{j}_{j}"))
        for i in range(j + 1, _P):
            total = sum((F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j + 1, i)), F.col(f"l{i}_{j}") * F.col(f"w{j}_{j}"))
            out = out.withColumn(f"w{i}_{j}", -total / F.col(f"l{i}_{i}"))
    return out.select("g", *[f"m{k}" for k in range(_P)], *[f"w{i}_{j}" for i, j in _LOWER])


def _by_distance(rows: DataFrame, estimates: DataFrame, sums: list[Column]) -> DataFrame:
    """Sums per group and distance bin, with the rows up to and including each bin."""
    bins = F.floor(16 * F.log2(1 + _distance())).cast("int").alias("bin")
    near = rows.join(estimates, "g").select("g", *_NAMES, bins)
    binned = near.groupBy("g", "bin").agg(F.count("*").alias("n"), *sums)
    part = Window.partitionBy("g")
    before = F.sum("n").over(part.orderBy("bin")) - F.col("n")
    return binned.withColumn("before", before).withColumn("total", F.sum("n").over(part))


def _concentrated(rows: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """One step: estimates from the bins that hold the closest ``share`` of each group."""
    sums = [F.sum(c).alias(f"t{k}") for k, c in enumerate(_NAMES)]
    sums += [F.sum(F.col(_NAMES[i]) * F.col(_NAMES[j])).alias(f"t{i}_{j}") for i, j in _LOWER]
    binned = _by_distance(rows, estimates, sums).where(F.col("before") < share * F.col("total"))
    kept = ["n", *[f"t{k}" for k in range(_P)], *[f"t{i}_{j}" for i, j in _LOWER]]
    return _inverse_factor(binned.groupBy("g").agg(*[F.sum(c).alias(c) for c in kept]))


def judge(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    share: float = SHARE,
    steps: int = STEPS,
    reject: float = REJECT,
    least_rows: int = LEAST_ROWS,
) -> DataFrame:
    """Every row's counts, ``base_failed``, squared ``distance`` and ``kept``.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated 8-word runs. Of the others, a row is
    kept if its distance is at most the chi-square value exceeded with probability ``reject``. Estimates are
    made from the rows that pass the base rules; a (language, source) with fewer than ``least_rows`` of them is
    taken together with others, so every row has an estimate. ``distance`` is null for rows without words and in
    a table where no row passes the base rules.
    """
    stats = materialize(statistics(docs, key, text, lang, source), "statistics")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = materialize(_grouped(vectors(stats.where(~failed)), least_rows), "vectors")
    estimates = materialize(_quartiles(rows), "estimates")
    for _ in range(steps):
        estimates = materialize(_concentrated(rows, estimates, share), "estimates")
    # The closest part is too narrow an estimate: scale it so that the median distance is what it should be.
    middle = _by_distance(rows, estimates, []).where("before < 0.5 * total").groupBy("g").agg(F.max("bin").alias("bin"))
    factor = F.greatest((F.pow(2.0, (F.col("bin") + 1) / 16) - 1) / chi_square(0.5), F.lit(1.0))
    scaled = materialize(estimates.join(middle.select("g", factor.alias("factor")), "g"), "estimates")
    distance = (_distance() / F.col("factor")).alias("distance")
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    passed = rows.join(scaled, "g").select(*counts, F.lit(False).alias("base_failed"), distance)
    lost = stats.where(failed).select(*counts, F.lit(True).alias("base_failed"), F.lit(None).cast("double").alias("distance"))
    kept = ~F.col("base_failed") & (F.col("distance") <= chi_square(reject))
    return passed.unionByName(lost).withColumn("kept", kept)

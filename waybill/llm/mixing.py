"""Mixing sources to target weights by cube-method balanced sampling.

A source with target t and size s takes every document t / s times on average: the whole part of that for certain, the
rest as an inclusion probability. The cube method turns the probabilities into 0 and 1 so that both the words and the
documents of every source stay what they were in sum:

- flight: three undecided documents of a source are moved along the null-space of the two constraints, up or down by a
  seeded draw that keeps expectations, until one is decided. Tasks do so side by side, each with a few undecided
  documents a source at the end; these meet in later rounds with fewer groups.
- landing: what is left in the last round, at most ``LANDING`` documents a source, is decided at once: of all choices
  the one whose words, then documents, come nearest to what is still owed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import numbered
from waybill.operators.joins import join_dimension
from waybill.session import materialize

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: A source, and with it each document, is taken at most so often.
MOST = 3
#: Undecided documents of a source that are decided together at the end.
LANDING = 12
#: Documents a task of the first round moves, and groups of it whose rests meet in one group of the next.
TASK_ROWS = 200_000
FAN = 1_000
#: Characters that part words.
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size, mark``: words of each text, and a number that deals rows out whatever their order."""
    plain = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.regexp_count(plain, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.col(key), F.col(source), F.crc32(plain.cast("binary"))).alias("mark"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` of ``sizes (source, size)``: one row a source.

    Sources in code-point order, null last, share all words by their weights. A target above ``most`` times its source
    stops there, and what is over is shared by weight among the others until none is above. Sums are whole numbers, so
    reruns give the same doubles. The sharing itself only sees sums; each round stops at least one source for good.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ordered = numbered(sources, [F.asc_nulls_last("source")], "_place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    ordered = materialize(ordered.withColumn("_weight", weight), "sources")
    cap = most * F.col("source_size")
    total = ordered.agg(F.sum("source_size")).first()[0] or 0
    stopped, free = 0, None
    while True:
        # Below the level every source with less than that much for its weight is full.
        level = 0.0 if free is None else (total - stopped) / free
        full = F.lit(False) if free is None else cap < level * F.col("_weight")
        row = ordered.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0)).alias("free"),
        ).first()
        if free is not None and (row["stopped"], row["free"]) == (stopped, free) or not row["free"]:
            break
        stopped, free = row["stopped"], row["free"]
    target = F.when(full, cap.cast("double")).otherwise(F.least(level * F.col("_weight"), cap.cast("double")))
    return ordered.select("source", "source_size", target.alias("target"))


def move(p: list[float], x: list[int], draw: float) -> tuple[list[float], int]:
    """Three probabilities moved so that their sum and their sum times ``x`` stay; one becomes 0 or 1, whose place
    comes second. ``draw`` in [0, 1) picks the way, with chances that leave every probability as it is on average."""
    u = [x[1] - x[2], x[2] - x[0], x[0] - x[1]]
    if not any(u):
        u = [1, -1, 0]
    up = [((1 - q) / v if v > 0 else -q / v, k) for k, (q, v) in enumerate(zip(p, u, strict=True)) if v]
    down = [(q / v if v > 0 else (q - 1) / v, k) for k, (q, v) in enumerate(zip(p, u, strict=True)) if v]
    (most_up, at_up), (most_down, at_down) = min(up), min(down)
    rise = draw * (most_up + most_down) < most_down
    step, at = (most_up, at_up) if rise else (-most_down, at_down)
    moved = [min(1.0, max(0.0, q + step * v)) for q, v in zip(p, u, strict=True)]
    moved[at] = 1.0 if (u[at] > 0) == rise else 0.0
    return moved, at


def land(p: list[float], x: list[int]) -> list[int]:
    """0 or 1 for each of a few documents: the words, then the count, nearest to what the probabilities owe."""
    if not p:
        return []
    choice = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
    words = np.abs(choice @ np.array(x, float) - np.dot(p, x))
    count = np.abs(choice.sum(axis=1) - sum(p))
    return choice[np.lexsort([count, np.round(words, 6)])[0]].tolist()


class Flight:
    """The undecided documents of one source in one task: (row, probability, size)."""

    def __init__(self, seed: int) -> None:
        self.open: list[tuple[int, float, int]] = []
        self.random = np.random.default_rng(seed)
        self.draws: list[float] = []

    def add(self, row: int, p: float, x: int) -> Iterator[tuple[int, float]]:
        """Take a document in; give those (row, 0.0 or 1.0) that are decided by it."""
        self.open.append((row, p, x))
        while len(self.open) > LANDING:
            if not self.draws:
                self.draws = self.random.random(1024).tolist()
            rows, p3, x3 = zip(*self.open[:3], strict=True)
            moved, _ = move(list(p3), list(x3), self.draws.pop())
            still = []
            for r, q, v in zip(rows, moved, x3, strict=True):
                if q in (0.0, 1.0):
                    yield r, q
                else:
                    still.append((r, q, v))
            self.open = self.open[3:] + still


def _round(rows: DataFrame, seed: int, last: bool) -> DataFrame:
    """``rows`` with ``p`` moved, and 0 or 1 in it where ``open`` is false. All rows of a (source, group) are in one task,
    in an order of their own."""
    names = rows.columns
    at_source, at_size, at_group, at_p, at_open = (names.index(n) for n in ("source", "size", "group", "p", "open"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only undecided rows outlive their batch: a few for each source.
        flights: dict = {}
        waiting: dict[int, pa.RecordBatch] = {}
        number = 0
        for batch in batches:
            first, number = number, number + len(batch)
            columns = [batch.column(c).to_pylist() for c in (at_source, at_group, at_size, at_p)]
            result: dict[int, float] = {}
            for k, (name, group, x, p) in enumerate(zip(*columns, strict=True)):
                if p in (0.0, 1.0):
                    result[first + k] = p
                    continue
                if (name, group) not in flights:
                    flights[name, group] = Flight(zlib.crc32(f"{seed}:{group}:{name}".encode()))
                result.update(flights[name, group].add(first + k, p, x))
            here = [r for r in range(first, number) if r not in result]
            kept = batch.take(pa.array([r - first for r in here], pa.int64()))
            waiting.update((r, kept.slice(k, 1)) for k, r in enumerate(here))
            early = [r for r in result if r < first]
            own = sorted(r for r in result if r >= first)
            if own:
                picked = pa.Table.from_batches([batch]).take(pa.array([r - first for r in own])).combine_chunks()
                yield from settled(picked, [result[r] for r in own], False)
            if early:
                picked = pa.Table.from_batches([waiting.pop(r) for r in early]).combine_chunks()
                yield from settled(picked, [result[r] for r in early], False)
        for flight in flights.values():
            rows_, p, x = zip(*flight.open, strict=True) if flight.open else ((), (), ())
            if not rows_:
                continue
            picked = pa.Table.from_batches([waiting.pop(r) for r in rows_]).combine_chunks()
            yield from settled(picked, [float(v) for v in land(list(p), list(x))] if last else list(p), not last)

    def settled(rows_: pa.Table, p: list[float], still: bool) -> list[pa.RecordBatch]:
        out = rows_.set_column(at_p, "p", pa.array(p, pa.float64()))
        return out.set_column(at_open, "open", pa.array([still] * len(p), pa.bool_())).combine_chunks().to_batches()

    return rows.mapInArrow(run, rows.schema)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every row: ``copies`` times the document, ``taken`` words.

    No document is taken more than ``most`` times. The words taken of a source differ from its target only by what its
    landing leaves, mostly a few words. A null text counts as empty, a null source as one more source; rows that repeat
    are rows of their own, an empty table gives no rows, and other columns are not looked at. Tasks and their order
    follow from the rows alone, so reruns agree as long as the table and ``task_rows`` are the same.
    """
    sizes = materialize(sized(docs, key, text, source), "sizes")
    shares = materialize(targets(sizes, weights, most).withColumnRenamed("source", "_source"), "targets")
    keyed = sizes.withColumn("_source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")))
    shares = shares.withColumn("_source", F.coalesce(F.concat(F.lit("s"), "_source"), F.lit("-")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = join_dimension(keyed, shares, ["_source"]).drop("_source").withColumn("_rate", rate)
    rows = rows.withColumn("base", F.floor("_rate")).withColumn("p", F.col("_rate") - F.col("base"))
    rows = rows.drop("_rate").withColumn("open", F.lit(True))
    decided = []
    groups = max(1, -(-sizes.count() // task_rows))
    while True:
        last = groups == 1
        if decided:
            rows = rows.withColumn("group", F.pmod(F.xxhash64("mark"), F.lit(groups)).cast("int"))
            laid = rows.repartition("source", "group")
        else:
            # By the mark alone, so a source with many rows has a part in every task.
            laid = rows.withColumn("group", F.lit(0)).repartition(groups, "mark")
        moved = materialize(_round(laid.sortWithinPartitions("mark", "doc_id", "size"), seed + len(decided), last), "flight")
        decided.append(moved.where(~F.col("open")))
        if last:
            break
        rows, groups = moved.where("open"), -(-groups // FAN)
    whole = decided[0]
    for more in decided[1:]:
        whole = whole.unionByName(more)
    copies: Column = (F.col("base") + F.col("p")).cast("long")
    return whole.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))

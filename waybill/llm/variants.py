"""Spelling variants: words one edit apart, grouped under the word that is written far more often.

1. Words are counted inside the tasks, then by word: the vocabulary is written.
2. One edit leaves one half of a word as it is. Words are dealt by that half: to the shard of its own first half a word
   goes as a query, to those of the first halves that near words may ask with as an entry; the same for last halves. A
   near pair meets in exactly the shard of the half that both share.
3. A shard is one delimited vocabulary with an FM-index (``fm_index``): of the words for last halves, of the words
   turned round for first halves. Each query matches its half exactly and extends across the other with one error.
4. Near words are summed up per query inside its shard; a word's parts are combined by word, and forms are followed to
   their roots by doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import keyed_text, text_bytes
from waybill.llm.fm_index import Index, one_edit_apart
from waybill.operators.joins import join_dimension
from waybill.session import materialize

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: How many times as often a word's form occurs, at least.
FORM_FACTOR = 10
#: One run in so many loses a letter, by a checksum of key and run (0: none).
TYPO_EVERY = 31
#: Entries and queries a shard is meant to hold.
SHARD_WORDS = 20_000
#: Letters of a text that are looked through at a time, and distinct words counted at a time in a task.
BLOCK_CHARS = 1 << 20
HELD_WORDS = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_APART = re.compile("[^A-Za-zÀ-ÿ]")


def _blocks(text: str) -> Iterator[str]:
    """Pieces of a text cut where no run is."""
    begin = 0
    while begin < len(text):
        cut = _APART.search(text, begin + BLOCK_CHARS) if len(text) - begin > BLOCK_CHARS else None
        end = cut.start() if cut else len(text)
        yield text[begin:end]
        begin = end


def words_of(key: str, text: str, every: int = TYPO_EVERY) -> Iterator[list[str]]:
    """The runs of a text whose A-Z are in lower case already, a block at a time; one in ``every`` has lost a letter."""
    start = zlib.crc32(f"{key}:".encode())
    for block in _blocks(text):
        runs = _RUN.findall(block)
        if every and runs:
            sums = np.fromiter(map(zlib.crc32, map(str.encode, runs), repeat(start)), np.uint32)
            for at in np.flatnonzero(sums % every == 0).tolist():
                run = runs[at]
                gone = int(sums[at]) % len(run)
                runs[at] = run[:gone] + run[gone + 1 :]
        yield runs


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = TYPO_EVERY) -> DataFrame:
    """``word, n``: words of at least ``LEAST_LETTERS`` letters and ``LEAST_COUNT`` occurrences, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for name, data in zip(batch.column(0), text_bytes(batch), strict=True):
                for words in words_of(name.as_py(), data.lower().decode(), every):
                    held.update(words)
                    if len(held) > HELD_WORDS:
                        yield table(held)
                        held.clear()
        yield table(held)

    def table(held: Counter) -> pa.RecordBatch:
        some = [(w, n) for w, n in held.items() if len(w) >= LEAST_LETTERS]
        return pa.record_batch([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], ["word", "n"])

    source = keyed_text(docs, key, text).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    counted = source.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counted.where(F.col("n") >= LEAST_COUNT), "vocabulary")


def _dealt(words: DataFrame, shard_words: int) -> DataFrame:
    """``word, n, last, exact, parts, part, holds, asks``: every word in the shards where it is an entry or a query.

    ``exact`` letters at the end (``last``) or the beginning are the unchanged half. Queries of near words are at
    most one letter longer or shorter, so an entry stands under at most two lengths of a half. A half that more than
    ``shard_words`` entries share is split into parts; its queries go to all of them, its entries to one.
    """
    length = F.length("word")
    sides = []
    for last in (False, True):
        half = lambda n, last=last: F.floor((n + int(last)) / 2).cast("int")
        lengths = F.array_distinct(F.array(half(length - 1), half(length), half(length + 1)))
        side = words.withColumn("exact", F.explode(lengths)).withColumn("asks", F.col("exact") == half(length))
        kept = F.right("word", "exact") if last else F.left("word", "exact")
        sides.append(side.withColumn("last", F.lit(last)).withColumn("half", kept))
    entries = sides[0].unionByName(sides[1])
    key = ["last", "exact", "half"]
    crowded = entries.groupBy(*key).agg(F.count("*").alias("parts")).where(F.col("parts") > shard_words)
    crowded = materialize(crowded.withColumn("parts", F.ceil(F.col("parts") / shard_words).cast("int")), "crowded")
    entries = join_dimension(entries, crowded, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = _part(F.col("word"), F.col("parts"))
    asked = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))
    return entries.withColumn("part", F.explode(asked)).withColumn("holds", F.col("part") == own)


def _part(word: Column, parts: Column) -> Column:
    return F.pmod(F.crc32(word.cast("binary")), parts).cast("int")


def _search_shard(words: list[str], n: list[int], flags: dict[str, np.ndarray], last: bool):
    """(word, n, near words, largest n, smallest near word of that n) of every query of one side of a shard."""
    turn = (lambda w: w) if last else (lambda w: w[::-1])
    held = np.flatnonzero(flags["holds"])
    entries = list({words[at]: at for at in held.tolist()}.items())  # one entry, though under two lengths of a half
    asks = np.flatnonzero(flags["asks"]).tolist()
    if not asks:
        return
    queries = [words[at] for at in asks]
    exact = flags["exact"][asks]
    of, found = np.empty(0, np.int64), np.empty(0, np.int64)
    if entries:
        of, found = one_edit_apart(Index([turn(w) for w, _ in entries]), [turn(q) for q in queries], exact)
    best: list = [None] * len(queries)
    near = [0] * len(queries)
    for q, e in zip(of.tolist(), found.tolist(), strict=True):
        word, at = entries[e]
        row = asks[q]
        # The parts of a crowded half must not see each other's entries, and what shares both halves counts once.
        if zlib.crc32(word.encode()) % flags["parts"][row] != flags["part"][row]:
            continue
        if last and word.startswith(queries[q][: len(queries[q]) // 2]):
            continue
        near[q] += 1
        if best[q] is None or (-n[at], word) < best[q]:
            best[q] = (-n[at], word)
    for q, row in enumerate(asks):
        yield queries[q], n[row], near[q], *((-best[q][0], best[q][1]) if best[q] else (None, None))


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n, n_near, top_n, top``: of every word of ``words (word, n)`` how many lie one edit away, and the most
    frequent of them (ties: the smallest in code-point order). Words must be distinct."""
    dealt = _dealt(words, shard_words)
    # An entry stands under four halves, most of them for two lengths each.
    shards = max(1, -(-4 * words.count() // shard_words))
    key = ["last", "exact", "half", "part"]
    columns = ["word", "n", "last", "exact", "parts", "part", "holds", "asks"]
    schema = "word string, n bigint, n_near bigint, top_n bigint, top string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        whole = pa.Table.from_batches(parts)
        for last in (False, True):
            side = whole.filter(pa.compute.equal(whole.column("last"), last))
            flags = {c: side.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns[3:]}
            rows = list(_search_shard(side.column("word").to_pylist(), side.column("n").to_pylist(), flags, last))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            values = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["word", "n", "n_near", "top_n", "top"])

    found = dealt.repartition(shards, *key).select(*columns).mapInArrow(run, schema)
    top = F.min(F.when(F.col("top").isNotNull(), F.struct((-F.col("top_n")).alias("n"), "top"))).alias("_top")
    summed = found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), top)
    return summed.select("word", "n", "n_near", (-F.col("_top.n")).alias("top_n"), F.col("_top.top").alias("top"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms (word, form)``. A form is ten times as frequent, so chains are short and have no ring.

    Every round goes twice as far as the one before.
    """
    roots = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        after = materialize(after, "roots")
        if not after.where("moved").limit(1).count():
            return after.select("word", "root")
        roots = after.select("word", "root")


def group_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = TYPO_EVERY, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of the texts' vocabulary.

    ``form`` is the near word of the largest n, if that is at least ``FORM_FACTOR`` times the word's, else null; ``root``
    is where forms lead to. A null text counts as empty and a null key as an empty one, rows that repeat are counted
    again, an empty table has no words. Texts and words of any length are taken whole. Other columns are not looked at.
    """
    near = near_words(vocabulary(docs, key, text, every), shard_words)
    strong = F.col("top_n") >= FORM_FACTOR * F.col("n")
    formed = near.select(
        "word", "n", "n_near", F.when(strong, F.col("top")).alias("form"), F.when(strong, F.col("top_n")).alias("form_n")
    )
    formed = materialize(formed, "forms")
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))

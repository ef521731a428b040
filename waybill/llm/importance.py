"""Importance resampling towards a target distribution.

Documents are bags of hashed runs of one to three words. A bucket's gain is the log ratio of its share in the target
texts and in the documents; a document's weight is the sum of the gains of its features. With Gumbel noise on top,
the highest scores are a sample without replacement in proportion to the weights.

1. One scan hashes the features of every whole text; their buckets are written, two bytes each.
2. Bucket counts are added up in arrays inside the tasks, and by bucket after that: 10,000 numbers reach the driver.
3. Weights are looked up in the array of gains, and the scores are written.
4. The cutoff is found by bisection: jobs over the written scores count exactly how many lie at or above some numbers.
   Rows that tie at the cutoff are bisected in the same way by ``doc_id``.
5. Only the drawn rows are sorted, in ranges, for their ranks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import keyed_text, numbered, text_bytes
from waybill.session import materialize

BUCKETS = 10_000
#: Longest run of words that is a feature.
LONGEST = 3
#: Documents of fewer words are scored but not drawn.
LEAST_WORDS = 20
#: Per cent of the documents that can be drawn which are drawn.
SHARE = 5
#: Bytes of a text whose words are in memory at a time.
BLOCK_BYTES = 1 << 22
#: Halvings that one counting job does at once.
HALVINGS = 5

#: ASCII other than letters and digits parts words; every byte beyond ASCII belongs to one.
_APART = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))


def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, a block of it at a time; no word is cut."""
    if len(data) <= BLOCK_BYTES:
        yield data.lower().translate(_APART).split()
        return
    rest = b""
    for at in range(0, len(data), BLOCK_BYTES):
        block = data[at : at + BLOCK_BYTES].lower().translate(_APART)
        whole, space, tail = block.rpartition(b" ")
        if not space:
            rest += tail
            continue
        yield (rest + whole).split()
        rest = tail
    yield rest.split()


def features(data: bytes) -> tuple[int, np.ndarray]:
    """Number of words of a UTF-8 text, and the buckets of all its features, repeats included.

    A run's checksum goes on from that of the run without its last word, so every word is read ``LONGEST`` times and no
    run is put together.
    """
    words, found, before = 0, [], []
    for block in _word_blocks(data):
        words += len(block)
        known = len(before)
        row = before + block
        sums = [zlib.crc32(w) for w in row]
        found.append(np.fromiter(sums[known:], np.uint32))
        spaced = [b" " + w for w in row]
        for length in range(2, LONGEST + 1):
            sums = list(map(zlib.crc32, spaced[length - 1 :], sums))
            # Runs that end before this block's first word were counted with the last one.
            found.append(np.fromiter(sums[max(0, known - length + 1) :], np.uint32))
        before = row[-(LONGEST - 1) :]
    return words, (np.concatenate(found) % BUCKETS).astype(np.uint16)


def hashed(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``doc_id, n_words, buckets`` of every row, written: ``buckets`` holds two bytes for each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, words, buckets, held = 0, [], [], 0
            for at, data in enumerate(text_bytes(batch)):
                count, found = features(data)
                words.append(count)
                buckets.append(found.tobytes())
                held += len(buckets[-1])
                if held > BLOCK_BYTES or at + 1 == len(batch):
                    keys = batch.column(0).slice(begin, at + 1 - begin)
                    yield pa.record_batch([keys, pa.array(words, pa.int64()), pa.array(buckets, pa.binary())], names)
                    begin, words, buckets, held = at + 1, [], [], 0

    source = keyed_text(docs, key, text)
    names = ["doc_id", "n_words", "buckets"]
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_words bigint, buckets binary"
    return materialize(source.mapInArrow(run, schema), "features")


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """How many features of ``hashed`` rows fall into each bucket. Tasks add up arrays, the driver gets one sum each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for value in batch.column(0):
                counts += np.bincount(np.frombuffer(value.as_py(), np.uint16), minlength=BUCKETS)
        some = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())], ["bucket", "n"])

    counted = rows.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = np.zeros(BUCKETS, np.int64)
    for row in counted.collect():
        totals[row["bucket"]] = row["n"]
    return totals


def gains(counts: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths of a natural logarithm, rounded down."""
    all_s, all_t = int(counts.sum()), int(target.sum())
    ratio = lambda s, t: (t + 1) * (all_s + BUCKETS) / ((s + 1) * (all_t + BUCKETS))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(counts.tolist(), target.tolist(), strict=True)])


def weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of ``hashed`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, weight = [], []
            for value in batch.column(2):
                found = np.frombuffer(value.as_py(), np.uint16)
                count.append(len(found))
                weight.append(int(gain[found].sum()))
            numbers = [pa.array(v, pa.int64()) for v in (count, weight)]
            yield pa.record_batch([*batch.columns[:2], *numbers], ["doc_id", "n_words", "n_features", "weight"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(key: Column, seed: int) -> Column:
    """Noise in thousandths, by a hash of seed and key alone; a null key counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def least_with(rows: DataFrame, column: str, fits) -> int | None:
    """The least whole number v for which ``fits(rows counted with column <= v)``; None if the rows never fit.

    Bisection: every job counts exactly at the places of several halvings. Nulls are counted nowhere.
    """
    ends = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    low, high, total = ends
    if low is None or not fits(total):
        return None
    while low < high:
        step = max(1, (high - low) >> HALVINGS)
        places = list(range(low, high, step))[: 1 << HALVINGS]
        counts = rows.agg(*[F.count_if(F.col(column) <= v) for v in places]).first()
        for place, count in zip(places, counts, strict=True):
            if fits(count):
                high = place
                break
            low = place + 1
    return low


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: int = SHARE,
    least_words: int = LEAST_WORDS,
    seed: int = 42,
    key: str = "doc_id",
    text: str = "text",
    target_key: str = "item_id",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; ``rank`` is null for rows that are not drawn.

    ``share`` per cent (rounded down) of the rows with at least ``least_words`` words are drawn: the highest scores,
    ties to the smaller key, a null key after all others, rows that repeat a key in any order. Null texts count as
    empty, texts of any length are read whole, an empty table gives no rows and an empty target leaves the bare shares
    of the documents. Other columns are not looked at, whatever their names. Keys must be whole numbers.
    """
    rows = hashed(docs, key, text)
    gain = gains(bucket_counts(rows), bucket_counts(hashed(target, target_key)))
    scored = weighted(rows, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = materialize(scored.withColumn("_tie", F.monotonically_increasing_id()), "scores")
    return _ranked(scored, share, least_words)


def _ranked(scored: DataFrame, share: int, least_words: int) -> DataFrame:
    shown = ["doc_id", "n_features", "weight", "score"]
    able = F.col("n_words") >= least_words
    falling = scored.where(able).select((-F.col("score")).alias("low"), "doc_id")
    wanted = share * falling.count() // 100
    drawn = F.lit(False)
    if wanted:
        cutoff = least_with(falling, "low", lambda n: n >= wanted)
        drawn = -F.col("score") < cutoff
        tied = falling.where(F.col("low") == cutoff)
        missing = wanted - falling.where(F.col("low") < cutoff).count()
        last = least_with(tied, "doc_id", lambda n: n >= missing)
        drawn = drawn | ((-F.col("score") == cutoff) & (F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(False))))
        drawn = able & drawn
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_tie")]
    best = numbered(scored.where(drawn).select(*shown, "_tie"), order, "rank")
    # Rows that repeat the last key are all within the cutoff; only as many as are wanted keep their rank.
    best = best.select(*shown, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    return scored.where(~drawn).select(*shown, F.lit(None).cast("long").alias("rank")).unionByName(best)

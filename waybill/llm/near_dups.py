"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

1. One row per distinct shingle set; banded MinHash values of it, computed in numpy.
2. Sets that share a band, directly or through others, form a coarse cluster. A cluster goes to one place,
   or, if it is too large for that, is cut into blocks by a hash, and every pair of blocks goes to a place.
3. There, pairs that share a band are compared batch by batch of their signatures: a pair is dropped as soon
   as the posterior probability that it is similar enough falls below the miss probability. Survivors are
   confirmed on their full sets, except where other links have already joined the two.
4. Confirmed links of all places are joined to components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.bpe import sliced
from waybill.llm.common import free_name, keyed_text
from waybill.llm.components import components
from waybill.session import materialize

#: At similarity 0.8 a pair shares no band of 4 with probability (1 - 0.8 ** 4) ** 32 = 4.8e-8.
BANDS, ROWS = 32, 4
#: Chosen miss probability of the Bayesian pruning, and hashes compared in a batch.
MISS, BATCH = 1e-7, 32
#: A place takes at most about so many sets and characters of one block.
BLOCK_SETS, BLOCK_CHARS = 768, 4_000_000
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; with fewer words the sequence as one; without any, none.

    Words are runs of anything but ASCII white space, A-Z in lower case.
    """
    import xxhash

    split = text.encode().lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, split), np.uint64, len(split))
    width = min(words, len(split))
    total = np.full(len(split) - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + hashed[k : k + len(total)])
    total.sort()
    return total[np.append(True, total[1:] != total[:-1])]


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(3)
    return tuple(random.integers(0, 1 << 64, count, np.uint64, endpoint=False) | np.uint64(1) for _ in range(2))


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Minimum of each of the hash functions (the upper half of a * x + b modulo 2 ** 64) over the set."""
    low = np.full(len(factors), np.iinfo(np.uint32).max, np.uint32)
    for begin in range(0, len(shingles), 4096):
        part = shingles[begin : begin + 4096, None] * factors + shifts
        np.minimum(low, (part >> np.uint64(32)).astype(np.uint32).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of a signature."""
    bands = low.reshape(-1, rows).astype(np.uint64)
    keys = np.arange(len(bands), dtype=np.uint64)
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, k])
    return keys


def least_matches(threshold: float, miss: float, hashes: int, batch: int) -> list[tuple[int, int]]:
    """For each batch end n, the fewest matches m at which P(similarity >= threshold | m of n) reaches ``miss``.

    The prior is uniform, so the posterior is Beta(m + 1, n - m + 1) and its upper tail a binomial sum.
    """
    ends = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1
        while tail < miss and m < n:
            m += 1
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        ends.append((n, m))
    return ends


def link_group(sets: list[np.ndarray], percent: int, bands: int, rows: int, miss: float, batch: int) -> np.ndarray:
    """Smallest index linked, directly or through others, with each of the sets of one place."""
    count = len(sets)
    label = np.arange(count)
    factors, shifts = permutations(bands * rows)
    low = np.array([signature(s, factors, shifts) for s in sets])
    keys = np.array([band_keys(x, rows) for x in low])
    sizes = np.array([len(s) for s in sets])
    ends = least_matches(percent / 100, miss, bands * rows, batch)
    names, places = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    marked = np.zeros(len(names), bool)
    for a in range(count - 1):
        others = np.arange(a + 1, count)
        others = others[label[others] != label[a]]
        # Sets so different in size that even containment would not be enough can't be similar.
        fits = (np.minimum(sizes[others], sizes[a]) * 100 >= percent * np.maximum(sizes[others], sizes[a]))
        others = others[fits]
        others = others[(keys[others] == keys[a]).any(axis=1)]
        matches, begin = np.zeros(len(others), np.int64), 0
        for end, least in ends:
            matches += (low[others, begin:end] == low[a, begin:end]).sum(axis=1)
            others, matches, begin = others[matches >= least], matches[matches >= least], end
        if not len(others):
            continue
        own = places[starts[a] : starts[a] + sizes[a]]
        marked[own] = True
        for chunk in np.array_split(others, max(1, int(sizes[others].sum()) // 2_000_000)):
            flat = np.concatenate([marked[places[starts[b] : starts[b] + sizes[b]]] for b in chunk])
            shared = np.add.reduceat(flat.astype(np.int64), np.cumsum(sizes[chunk]) - sizes[chunk])
            union = sizes[a] + sizes[chunk] - shared
            for b in chunk[100 * shared >= percent * union]:
                x, y = label[a], label[b]
                if x != y:
                    label[label == max(x, y)] = min(x, y)
        marked[own] = False
    return label


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    miss: float = MISS,
    batch: int = BATCH,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Two documents are linked if 100 * intersection >= percent * union of their sets of ``words``-word shingles;
    the component's id is its smallest key, and that document is kept. Null texts, empty texts and texts of white
    space alone have no shingles and are linked with nothing, not even with each other. Rows that repeat a key
    all stay and count as linked, whatever their texts. Keys are integers; a
    row with a null key has a null component, is linked with nothing and kept.
    """
    source = keyed_text(docs, key, text)
    kind = source.schema["doc_id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = permutations(bands * rows)
        for whole in batches:
            for part, texts in sliced(whole):
                sizes, ids, keys = [], [], []
                for text in texts:
                    own = shingle_set(text, words)
                    sizes.append(len(own))
                    # The set's identity: two independent sums over its members.
                    with np.errstate(over="ignore"):
                        ids.append((mix(own).sum(dtype=np.uint64), mix(own * _MIX2 + _MIX1).sum(dtype=np.uint64)))
                    keys.append(band_keys(signature(own, factors, shifts), rows).view(np.int64) if len(own) else None)
                ends = np.cumsum([0, *[0 if k is None else len(k) for k in keys]], dtype=np.int32)
                flat = np.concatenate([k for k in keys if k is not None] or [np.zeros(0, np.int64)])
                columns = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in zip(*ids, strict=True)]
                chars = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), chars, *columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["doc_id", "n_shingles", "chars", "set1", "set2", "bands"],
                )

    sketches = materialize(
        source.mapInArrow(sketch, f"doc_id {kind}, n_shingles long, chars long, set1 long, set2 long, bands array<long>"), "sketches"
    )
    # One row per distinct set, under the smallest key that has it.
    filled = sketches.where("n_shingles > 0 and doc_id is not null")
    same = filled.groupBy("set1", "set2", "n_shingles")
    classes = materialize(same.agg(F.min("doc_id").alias("node"), F.min("chars").alias("chars"), F.first("bands").alias("bands")), "classes")

    banded = classes.select("node", F.explode("bands").alias("hub"))
    shared = banded.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1").select("hub")
    coarse = components(banded.join(shared, "hub"))

    placed = _placed(coarse, classes)
    links = _links(placed, source, kind, words, percent, bands, rows, miss, batch)
    final = components(links)
    labelled = classes.join(final, "node", "left").select(
        "set1", "set2", "n_shingles", F.coalesce("label", "node").alias("component_id")
    )
    found = filled.select("doc_id", "set1", "set2", "n_shingles").join(labelled, ["set1", "set2", "n_shingles"])
    alone = sketches.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    result = found.select("doc_id", "n_shingles", "component_id").unionByName(alone)
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _placed(coarse: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, place, cluster``: where each set is compared; a large cluster's block meets every block of it."""
    sized = coarse.join(classes.select("node", "chars"), "node")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("chars") / BLOCK_CHARS)).cast("int")
    clusters = sized.groupBy("label").agg(blocks.alias("blocks"), F.count("*").alias("n")).where("n > 1")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pair = sized.join(clusters, "label").select("node", "label", block.alias("block"), other.alias("other"))
    return pair.select("node", F.xxhash64("label", F.least("block", "other"), F.greatest("block", "other")).alias("place"))


def _links(
    placed: DataFrame, source: DataFrame, kind: str, words: int, percent: int, bands: int, rows: int, miss: float, batch: int
) -> DataFrame:
    """``node, hub``: sets that their place has found linked share a hub."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, sets = None, [], []

        def result() -> pa.RecordBatch:
            label = link_group(sets, percent, bands, rows, miss, batch)
            linked = np.flatnonzero(np.bincount(label, minlength=len(label))[label] > 1)
            hub = mix(np.array([group], np.int64).view(np.uint64) + mix(label[linked].astype(np.uint64))).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array([nodes[k] for k in linked], node_type), pa.array(hub)], names=["node", "hub"])

        node_type = pa.int64()
        for whole in batches:
            node_type = whole.schema.field(1).type
            places, own = whole.column(0).to_pylist(), whole.column(1).to_pylist()
            for place, node, text in zip(places, own, whole.column(2), strict=True):
                if place != group:
                    if len(nodes) > 1:
                        yield result()
                    group, nodes, sets = place, [], []
                own_set = shingle_set(text.as_py(), words)
                if len(own_set):
                    nodes.append(node)
                    sets.append(own_set)
        if len(nodes) > 1:
            yield result()

    texts = source.select(F.col("doc_id").alias("node"), "text").where("node is not null")
    sent = placed.join(texts, "node").repartition("place").sortWithinPartitions("place", "node")
    return sent.select("place", "node", "text").mapInArrow(compare, f"node {kind}, hub long")


def representatives(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each component of ``near_duplicates``' result, with all columns; null keys stay.

    Of rows that repeat a kept key, any one stays.
    """
    lost = materialize(found.where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct(), "lost")
    again = found.where("kept").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("n")).where("n > 1").select(key)
    again = materialize(again, "again")
    kept = docs.join(lost, key, "left_anti")
    repeated = kept.join(again, key, "left_semi").dropDuplicates([key])
    return kept.join(again, key, "left_anti").unionByName(repeated)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """``docs`` with one row for each component of near-duplicates, told row by row; ``options`` as in ``near_duplicates``.

    The row with the smallest key stays (null keys come last; of rows that repeat it, one). A repeated key is no link:
    rows that share one but differ in their texts stay, or go, by themselves. Rows without words all stay; an empty
    table stays empty. Rows are numbered and written once, so a task that runs again finds the same numbers.
    """
    name = free_name(docs.columns, "row")
    rows = materialize(docs.withColumn(name, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows, key=name, text=text, **options).select(F.col("doc_id").alias("node"), "component_id")
    keys = rows.select(F.col(name).alias("node"), F.col(key).alias("own"))
    first = F.min(F.struct(F.col("own").isNull().alias("last"), "own", "node"))["node"]
    kept = materialize(found.join(keys, "node").groupBy("component_id").agg(first.alias(name)).select(name), "kept")
    return rows.join(kept, name, "left_semi").select(docs.columns)

"""Language-model scores by a log-bilinear model of word classes.

The commonest tokens are classes of their own, every other word belongs to a class by its ending, and within a
class words share its probability by their counts. The class model predicts the next class from a few before it
by one bilinear form; it is trained in numpy with noise-contrastive estimation, by every task on its own training
documents, and the tasks' parameters are averaged. Scoring normalises over all classes in batched matrix products.
Counts are those of all training documents; only tokens outside a bounded head are joined to them by a shuffle.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import keyed_text
from waybill.session import materialize

#: Classes of single tokens (the end is the first) and classes by word ending.
SINGLE, ENDINGS = 384, 128
CLASSES = SINGLE + ENDINGS
#: Classes before the predicted one, and dimensions.
CONTEXT, SIZE = 4, 24
#: Commonest words whose counts every task knows: a few MB at any size of the corpus.
HEAD = 200_000
#: Training: noise classes for each batch, positions of a batch, passes over all positions, step.
NOISE, BATCH, ROUNDS, STEP = 128, 1024, 1, 0.15
#: Words counted in a task before they are sent on, endings whose classes a task keeps, and bytes of texts taken at once.
COUNTED, CACHE, SLICE = 400_000, 400_000, 4_000_000
#: Scores up to this size go through ``exp`` in single precision as they are.
SAFE = 60.0
END = b""


class Tokens(NamedTuple):
    """Tokens of some texts: words with A-Z in lower case, then the end. Every text has one at least."""

    distinct: list[bytes]
    #: The place in ``distinct`` of every token, text after text, and how many each text has.
    index: np.ndarray
    sizes: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes


def tokens_of(texts: pa.Array) -> Tokens:
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    text = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    words = split.flatten()
    # White space at either end of a text leaves an empty word there.
    filled = pc.greater(pc.binary_length(words), 0)
    found = words.filter(filled).dictionary_encode()
    sizes = np.bincount(text[filled.to_numpy(zero_copy_only=False)], minlength=len(split))
    distinct = [*found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), END]
    index = np.insert(found.indices.to_numpy(zero_copy_only=False), np.cumsum(sizes), len(distinct) - 1)
    return Tokens(distinct, index, sizes + 1)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``SLICE`` bytes of texts."""
    if batch.num_rows:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(ends // SLICE)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(begin, end - begin)


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


class Vocabulary(NamedTuple):
    """What scoring needs of the counts; ``single`` maps tokens to their classes, ``head`` the commonest to counts."""

    single: dict[bytes, int]
    head: dict[bytes, int]
    tokens: int
    distinct: int
    class_counts: np.ndarray
    #: Log10 of the total within each ending class: counts plus one half for each word and for the unknown one.
    ending_totals: np.ndarray

    def unigram(self) -> np.ndarray:
        smooth = self.class_counts + 0.5
        return smooth / smooth.sum()


def count_words(training: DataFrame) -> DataFrame:
    """``word binary, ending, n`` over whole texts; the empty word is the end. Counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def sent() -> pa.RecordBatch:
            words = list(counts)
            columns = [pa.array(words, pa.binary()), pa.array(map(ending, words), pa.int32()), pa.array(counts.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "ending", "n"])

        for whole in batches:
            for part in slices(whole, 0):
                tokens = tokens_of(part.column(0))
                counts.update(dict(zip(tokens.distinct, np.bincount(tokens.index).tolist(), strict=True)))
                if len(counts) >= COUNTED:
                    yield sent()
                    counts.clear()
        yield sent()

    parts = training.select("text").mapInArrow(run, "word binary, ending int, n long")
    return parts.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    common = counts.where("word <> X''").orderBy(F.desc("n"), "word").select("word", "n").limit(head).toPandas()
    known = dict(zip(map(bytes, common["word"]), map(int, common["n"]), strict=True))
    single = {w: k for k, w in enumerate([END, *list(known)[: SINGLE - 1]])}
    whole = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("words")).toPandas()
    ends = int(counts.where("word = X''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    known[END] = ends
    totals, distinct = np.zeros(ENDINGS), np.zeros(ENDINGS)
    totals[whole["ending"]], distinct[whole["ending"]] = whole["n"], whole["words"]
    tokens, words = int(totals.sum()), int(distinct.sum())
    class_counts = np.zeros(CLASSES)
    for word, k in single.items():
        class_counts[k] = known[word]
        if known[word]:
            totals[ending(word)] -= known[word]
            distinct[ending(word)] -= 1
    class_counts[SINGLE:] = totals
    if not ends:
        known.pop(END)
    return Vocabulary(single, known, tokens, words, class_counts, np.log10(totals + 0.5 * (distinct + 1)))


class Endings(dict):
    """Classes by a word's last three bytes."""

    def __missing__(self, tail: bytes) -> int:
        self[tail] = found = SINGLE + ending(tail)
        return found


class Classer:
    """Classes of tokens, with those of seen endings kept: a small table, unlike one of words."""

    def __init__(self, single: dict[bytes, int]):
        self.single, self.ends = single, Endings()

    def __call__(self, words: list[bytes]) -> np.ndarray:
        single, ends = self.single, self.ends
        if len(ends) > CACHE:
            ends.clear()
        return np.array([single[w] if w in single else ends[w[-3:]] for w in words], np.int32)


def contexts(classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each position the classes before it, nearest first; ``CLASSES`` stands for what lies before its text."""
    padded = np.concatenate([np.full(CONTEXT, CLASSES, np.int32), classes])
    found = np.stack([padded[CONTEXT - 1 - k : len(padded) - 1 - k] for k in range(CONTEXT)], axis=1)
    starts = np.cumsum(sizes) - sizes
    for place in range(CONTEXT):
        found[starts[sizes > place] + place, place:] = CLASSES
    return found


class Bilinear:
    """Parameters in one flat array: context vectors, their weights by place, target vectors, target biases."""

    def __init__(self, flat: np.ndarray):
        a, b = (CLASSES + 1) * SIZE, CONTEXT * SIZE
        self.flat = flat
        self.words = flat[:a].reshape(CLASSES + 1, SIZE)
        self.place = flat[a : a + b].reshape(CONTEXT, SIZE)
        self.targets = flat[a + b : a + b + CLASSES * SIZE].reshape(CLASSES, SIZE)
        self.bias = flat[a + b + CLASSES * SIZE :]

    @staticmethod
    def start(unigram: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(7)
        small = random.normal(0, 0.1, (CLASSES + 1) * SIZE + CONTEXT * SIZE + CLASSES * SIZE)
        small[(CLASSES + 1) * SIZE : (CLASSES + 1) * SIZE + CONTEXT * SIZE] += 0.5
        return np.concatenate([small, np.log(unigram)]).astype(np.float32)

    def predicted(self, context: np.ndarray) -> np.ndarray:
        # Vectors are weighted once for each class, not for each position.
        found = np.take(self.words * self.place[0], context[:, 0], axis=0)
        for k in range(1, CONTEXT):
            found += np.take(self.words * self.place[k], context[:, k], axis=0)
        return found

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logs, normalised over all classes."""
        q = self.predicted(context)
        scores = q @ self.targets.T
        own, weights = scores[np.arange(len(target)), target], np.exp(self.bias)
        if _longest(q) * _longest(self.targets) + np.abs(self.bias).max() < SAFE:
            own += self.bias[target]
        else:
            scores += self.bias
            top = scores.max(axis=1)
            own = scores[np.arange(len(target)), target] - top
            scores -= top[:, None]
            weights = np.ones_like(weights)
        np.exp(scores, out=scores)
        return own - np.log(scores @ weights)


def _longest(vectors: np.ndarray) -> float:
    return math.sqrt(np.einsum("ij,ij->i", vectors, vectors).max(initial=0.0))


def summed_rows(index: np.ndarray, rows: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Sums of ``rows`` by ``index``. ``cells`` numbers the cells of the result."""
    sums = np.bincount(np.take(cells, index, axis=0).ravel(), rows.ravel(), cells.size)
    return sums.astype(np.float32).reshape(cells.shape)


class Trainer:
    """Noise-contrastive estimation with one set of noise classes for each batch, and adaptive steps."""

    def __init__(self, flat: np.ndarray, unigram: np.ndarray, seed: int):
        self.model = Bilinear(flat.copy())
        self.squares = np.full_like(flat, 1e-2)
        self.log_noise = np.log(unigram).astype(np.float32)
        self.cumulative = np.cumsum(unigram)
        self.random = np.random.default_rng(seed)
        self.cells = np.arange((CLASSES + 1) * SIZE).reshape(CLASSES + 1, SIZE)

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        m, n = self.model, len(target)
        # Equal draws share a column, which counts as often as it was drawn.
        chosen = np.minimum(np.searchsorted(self.cumulative, self.random.random(NOISE)), CLASSES - 1)
        times = np.bincount(chosen, minlength=CLASSES)
        noise = np.flatnonzero(times)
        times = times[noise].astype(np.float32)
        q = m.predicted(context)
        vectors, drawn = np.take(m.targets, target, axis=0), m.targets[noise]
        shift = math.log(NOISE)
        real = np.einsum("ij,ij->i", q, vectors) + m.bias[target] - self.log_noise[target] - shift
        miss = (1 - 1 / (1 + np.exp(-np.clip(real, -20, 20)))) / n
        # Scores with their signs changed. One beyond single precision's range becomes infinite and its hit nothing.
        hit = q @ -drawn.T
        hit -= m.bias[noise] - self.log_noise[noise] - shift
        with np.errstate(over="ignore"):
            np.exp(hit, out=hit)
        hit += 1
        np.divide(-1 / n, hit, out=hit)
        gradient = np.zeros_like(m.flat)
        g = Bilinear(gradient)
        g.targets += summed_rows(target, miss[:, None] * q, self.cells[:CLASSES])
        g.targets[noise] += times[:, None] * (q.T @ hit).T
        g.bias += np.bincount(target, miss, CLASSES)
        g.bias[noise] += times * (np.ones(n, np.float32) @ hit)
        dq = miss[:, None] * vectors
        dq += hit @ (times[:, None] * drawn)
        # The gradients of vectors and of their weights both follow from the sums by place and class.
        wide = dq.astype(np.float64)
        for k in range(CONTEXT):
            sums = summed_rows(context[:, k], wide, self.cells)
            g.words += sums * m.place[k]
            g.place[k] = np.einsum("cd,cd->d", sums, m.words)
        gradient *= n / 64
        self.squares += gradient * gradient
        m.flat += STEP * gradient / np.sqrt(self.squares)


def train(training: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters after ``rounds`` passes: each task trains on every position of its texts, then all average.

    A task sends its parameters (100 kB) weighted by its positions; they are averaged in about the square root of
    the shuffle partitions' number of tasks, and only those averages reach the driver.
    """
    unigram = vocab.unigram()
    flat, single = Bilinear.start(unigram), vocab.single

    def local(at: int, flat: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            classer, trainer = Classer(single), Trainer(flat, unigram, 1000 * at + TaskContext.get().partitionId())
            held, size, seen = [], 0, 0
            for whole in batches:
                for part in slices(whole, 0):
                    tokens = tokens_of(part.column(0))
                    classes = classer(tokens.distinct)[tokens.index]
                    context = contexts(classes, tokens.sizes)
                    for begin, n in zip(tokens.starts.tolist(), tokens.sizes.tolist(), strict=True):
                        held.append((context[begin : begin + n], classes[begin : begin + n]))
                        size += n
                        if size >= 16 * BATCH:
                            seen += fed(trainer, held)
                            held, size = [], 0
            seen += fed(trainer, held) if held else 0
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([trainer.model.flat.tobytes()])], names=["n", "flat"])

        return run

    def fed(trainer: Trainer, held: list) -> int:
        context, target = (np.concatenate(x) for x in zip(*held, strict=True))
        order = trainer.random.permutation(len(target))
        for begin in range(0, len(order), BATCH):
            trainer.step(context[order[begin : begin + BATCH]], target[order[begin : begin + BATCH]])
        return len(order)

    def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = 0.0, 0
        for batch in batches:
            for n, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total, weight = total + n * np.frombuffer(blob.as_py(), np.float32).astype(np.float64), weight + n
        if weight:
            yield pa.RecordBatch.from_arrays([pa.array([weight], pa.int64()), pa.array([(total / weight).astype(np.float32).tobytes()])], names=["n", "flat"])

    groups = math.isqrt(int(training.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    for at in range(rounds):
        trained = training.select("text").mapInArrow(local(at, flat), "n long, flat binary")
        rows = trained.repartition(groups).mapInArrow(averaged, "n long, flat binary").collect()
        if rows:
            weights = np.array([r["n"] for r in rows], float)
            flat = np.average([np.frombuffer(r["flat"], np.float32) for r in rows], axis=0, weights=weights).astype(np.float32)
    return flat


def score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row's whole text.

    ``training`` says of a row of ``doc_id, text`` whether the model learns from it. ``base_score`` is the log10
    probability by smoothed counts, ``score`` that by the model. Null texts are empty and have the end alone. Without
    training rows all tokens are unknown. Repeated rows each give a row.
    """
    source = keyed_text(docs, key, text)
    learned = source.where(training)
    counts = materialize(count_words(learned), "words")
    vocab = vocabulary(counts)
    flat = train(learned, vocab)
    kind = source.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "word", "times", "n_tokens", "n_known", "base", "model"]

    def sent_rows(rows: np.ndarray, ids: pa.Array, words: list[bytes], *numbers: np.ndarray) -> pa.RecordBatch:
        kinds = [*[pa.int64()] * 3, *[pa.float64()] * 2]
        columns = [pa.array(v.astype(t.to_pandas_dtype()), t) for v, t in zip(numbers, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(rows), ids, pa.array(words, pa.binary()), *columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classer, model = Classer(vocab.single), Bilinear(flat)
        row = TaskContext.get().partitionId() << 33
        logs = {w: math.log10(n + 0.5) for w, n in vocab.head.items()}
        totals = np.concatenate([np.zeros(SINGLE), vocab.ending_totals])
        for whole in batches:
            for part in slices(whole, 1):
                tokens = tokens_of(part.column(1))
                starts, n = tokens.starts, part.num_rows
                rows = np.arange(row, row + n)
                row += n
                own = classer(tokens.distinct)[tokens.index]
                inside = np.array([logs.get(w, math.nan) for w in tokens.distinct])[tokens.index]
                outside = np.isnan(inside)
                inside[outside] = 0
                log = log_sums(model, own, tokens.sizes)
                log += np.add.reduceat(np.where(own >= SINGLE, inside - totals[own], 0), starts)
                known = np.add.reduceat(~outside, starts, dtype=np.int64)
                # The row's own sums have a key no word can have, each for itself, so they meet nowhere.
                keys = [b" %d" % r for r in rows.tolist()]
                yield sent_rows(rows, part.column(0), keys, np.zeros(n, np.int64), tokens.sizes, known, np.add.reduceat(inside, starts), log)
                pairs = np.repeat(np.arange(n), tokens.sizes)[outside] * len(tokens.distinct) + tokens.index[outside]
                pairs, times = np.unique(pairs, return_counts=True)
                at, word = np.divmod(pairs, len(tokens.distinct))
                words, none = [tokens.distinct[w] for w in word.tolist()], np.zeros(len(pairs), np.int64)
                yield sent_rows(rows[at], pa.nulls(len(pairs), part.schema.field(0).type), words, times, none, none, none, none)

    schema = f"row long, doc_id {kind}, word binary, times long, n_tokens long, n_known long, base double, model double"
    sent = source.mapInArrow(run, schema)
    joined = sent.join(counts.select("word", "n"), "word", "left")
    count = F.coalesce("n", F.lit(0))
    tail = F.col("times") * F.log10(count + 0.5)
    summed = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(count > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + tail).alias("base"),
        # A token that is not in the head has an ending class, so its count is its share there.
        F.sum(F.col("model") + tail).alias("score"),
    )
    total = math.log10(vocab.tokens + 0.5 * (vocab.distinct + 1))
    return summed.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * total).alias("base_score"),
        "score",
    )


def log_sums(model: Bilinear, classes: np.ndarray, sizes: np.ndarray, batch: int = 1024) -> np.ndarray:
    """Log10 probability of each text's classes."""
    context = contexts(classes, sizes)
    logs = np.concatenate([model.log_probabilities(context[i : i + batch], classes[i : i + batch]) for i in range(0, len(classes), batch)])
    return np.add.reduceat(logs.astype(np.float64), np.cumsum(sizes) - sizes) / math.log(10)

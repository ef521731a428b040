import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from waybill.llm import lm


def base(rows, trained):
    tokens = [(k, (t or "").encode().lower().split() + [b""]) for k, t, *_ in rows]
    counts = Counter(w for k, words in tokens if trained(k) for w in words)
    total, distinct = sum(counts.values()), len(counts)
    share = {w: math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for _, words in tokens for w in words}
    return total, [(k, len(ws), sum(counts[w] > 0 for w in ws), sum(share[w] for w in ws)) for k, ws in tokens]


def check(df, rows, condition, trained):
    total, want = base(rows, trained)
    got = lm.score(df, condition).collect()
    assert {r.train_tokens for r in got} <= {total}
    key = lambda x: (str(x[0]), x[1], round(x[3], 6))
    found = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in got), key=key)
    for a, b in zip(found, sorted(want, key=key), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-6)
    assert all(np.isfinite(r.score) and r.score <= 1e-9 for r in got)
    return got


def test_base_and_held_out_gain(spark, folder, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 500)  # most words are joined to their counts
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = check(docs, rows, F.col("doc_id") % 5 != 1, lambda k: k % 5 != 1)
    held = [r for r in got if r.doc_id % 5 == 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(odd, none):
    check(odd, ODD, F.coalesce(F.col("doc_id") != 6, F.lit(False)), lambda k: k is not None and k != 6)
    check(odd, ODD, F.lit(False), lambda k: False)
    assert lm.score(none, F.lit(True)).collect() == []


def test_classes_sum_to_one():
    model = lm.Bilinear(lm.Bilinear.start(np.full(lm.CLASSES, 1 / lm.CLASSES)))
    context = np.tile(np.array([[3, 4, lm.CLASSES, lm.CLASSES]], np.int32), (lm.CLASSES, 1))
    logs = model.log_probabilities(context, np.arange(lm.CLASSES))
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)


def test_training_learns_what_follows():
    unigram = np.full(lm.CLASSES, 1 / lm.CLASSES)
    trainer = lm.Trainer(lm.Bilinear.start(unigram), unigram, 1)
    draw = np.random.default_rng(0)
    for _ in range(300):
        before = draw.integers(0, 20, lm.BATCH).astype(np.int32)
        context = np.stack([before, *[np.full_like(before, lm.CLASSES)] * (lm.CONTEXT - 1)], axis=1)
        trainer.step(context, (before + 1) % 20)
    logs = trainer.model.log_probabilities(context, (before + 1) % 20)
    assert logs.mean() > math.log(0.3)


def test_every_position_is_trained_on(make):
    docs = make([(1, "", "en", "s", 0), (2, "one", "en", "s", 3), (3, "one two", "en", "s", 7), (4, "word " * 5000, "en", "s", 25_000)])
    taken = docs.sparkSession.sparkContext.accumulator(0)

    class Counted(lm.Trainer):
        def step(self, context, target):
            taken.add(len(target))
            super().step(context, target)

    vocab = lm.vocabulary(lm.count_words(docs))
    before, lm.Trainer = lm.Trainer, Counted
    try:
        lm.train(docs, vocab, rounds=1)
    finally:
        lm.Trainer = before
    assert taken.value == 1 + 2 + 3 + 5001


def test_tokens_are_split_at_ascii_white_space_alone():
    texts = ["", " a  B\tc\x0b\x0cA\r\n", "\x1cx\x85y  z ÄÖ A", "\n ", "a"]
    found = lm.tokens_of(pa.array(["z", *texts]).slice(1))
    for text, begin, n in zip(texts, found.starts, found.sizes, strict=True):
        assert [found.distinct[i] for i in found.index[begin : begin + n]] == [*text.encode().lower().split(), b""]
    classes = np.arange(len(found.index), dtype=np.int32)
    places = [(begin, at) for begin, n in zip(found.starts, found.sizes, strict=True) for at in range(begin, begin + n)]
    before = [[at - 1 - k if at - 1 - k >= begin else lm.CLASSES for k in range(lm.CONTEXT)] for begin, at in places]
    assert lm.contexts(classes, found.sizes).tolist() == before


def test_words_are_classed_once_for_many_texts(make):
    docs = make([(1, "one two " * 2000, "en", "s", 0), (2, "word " * 5000, "en", "s", 0)]).coalesce(1)
    classed = docs.sparkSession.sparkContext.accumulator(0)

    class Counted(lm.Classer):
        def __call__(self, words):
            classed.add(len(words))
            return super().__call__(words)

    before, lm.Classer = lm.Classer, Counted
    try:
        assert [r.n_tokens for r in lm.score(docs, F.lit(True)).orderBy("doc_id").collect()] == [4001, 5001]
    finally:
        lm.Classer = before
    # Four tokens, for training and for scoring.
    assert classed.value == 8


@pytest.mark.parametrize("scale", [1, 40])
def test_large_scores_are_normalised_too(scale):
    draw = np.random.default_rng(3)
    model = lm.Bilinear(lm.Bilinear.start(draw.random(lm.CLASSES)) * scale)
    context, target = draw.integers(0, lm.CLASSES + 1, (64, lm.CONTEXT)), draw.integers(0, lm.CLASSES, 64)
    scores = model.predicted(context).astype(float) @ model.targets.T + model.bias
    top = scores.max(axis=1)
    want = scores[np.arange(64), target] - top - np.log(np.exp(scores - top[:, None]).sum(axis=1))
    assert model.log_probabilities(context, target) == pytest.approx(want, rel=1e-5, abs=1e-4)


def test_step_follows_the_gradient_of_every_draw():
    draw = np.random.default_rng(5)
    unigram = np.r_[0.9, np.full(lm.CLASSES - 1, 0.1 / (lm.CLASSES - 1))]  # one class is drawn again and again
    trainer = lm.Trainer(lm.Bilinear.start(unigram), unigram, 1)
    flat, twin = trainer.model.flat.astype(float), np.random.default_rng(1)
    noise = np.minimum(np.searchsorted(trainer.cumulative, twin.random(lm.NOISE)), lm.CLASSES - 1)
    context, target = draw.integers(0, lm.CLASSES + 1, (50, lm.CONTEXT)), draw.integers(0, 9, 50)

    def gain(x):
        m = lm.Bilinear(x)
        q = sum(m.words[context[:, k]] * m.place[k] for k in range(lm.CONTEXT))
        own = (q * m.targets[target]).sum(axis=1) + m.bias[target] - np.log(unigram[target] * lm.NOISE)
        false = q @ m.targets[noise].T + m.bias[noise] - np.log(unigram[noise] * lm.NOISE)
        return -np.log1p(np.exp(-own)).sum() - np.log1p(np.exp(false)).sum()

    trainer.step(context, target)
    places = draw.choice(len(flat), 40, replace=False).tolist() + [(lm.CLASSES + 1) * lm.SIZE + 3, len(flat) - lm.CLASSES]
    for at in places:
        near = np.zeros_like(flat)
        near[at] = 1e-4
        slope = (gain(flat + near) - gain(flat - near)) / 2e-4 / 64
        assert trainer.model.flat[at] - flat[at] == pytest.approx(lm.STEP * slope / math.sqrt(1e-2 + slope**2), rel=2e-2, abs=2e-4)

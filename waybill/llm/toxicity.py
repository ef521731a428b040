"""Toxicity by a weighted lexicon.

Texts are folded (case, homoglyphs, digit substitutions), an Aho-Corasick automaton finds the lexicon's words
and word beginnings in one pass, exception phrases are taken out, and the weights, also in proportion to the
length, give a score. The lexicon, the exceptions and the last two coefficients are learned from labelled rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from waybill.llm.bpe import sliced
from waybill.llm.common import keyed_text

#: Labelled rows of each class that are learned from at most; they are chosen by a hash of the key.
CLASS_ROWS = 8_000
#: Toxic training rows a term must be in at least (also as a share), how much likelier it must be there, and the
#: least G statistic of that: 16 is left to chance about once in ten thousand terms.
LEAST_ROWS, LEAST_SHARE, LEAST_RATIO, LEAST_G = 3, 0.002, 8.0, 16.0
#: Beginnings of words count as terms from this length on.
STEM = 4
#: Letters that look like Latin ones, by Latin letter: Greek, Cyrillic, Armenian, Cherokee, Latin variants.
_LOOKS = {
    "a": "αа", "b": "βвьЬᏏ", "c": "сϲᏟ", "d": "ԁժᎠᏧ", "e": "εеєҽᎬ", "f": "ϝքғ", "g": "ɡցᏀ", "h": "һнհᎻᏂ", "i": "ιіıɩᎥ",
    "j": "јϳյᎫ", "k": "κкᏦ", "l": "ӏℓլᏞ", "m": "мᎷ", "n": "νпոռ", "o": "οоօσ", "p": "ρрᏢ", "q": "ԛզգ", "r": "гᎡᏒ",
    "s": "ѕտᏚ", "t": "τтᎢ", "u": "υսцʋ", "v": "ѵᏙ", "w": "ωԝшաᎳ", "x": "χхҳ", "y": "уγүʏᎩ", "z": "ζʐᏃ",
}
#: Digits and letters without a decomposition that stand for letters.
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
_BARRED = {"ł": "l", "ø": "o", "đ": "d", "ħ": "h", "ŧ": "t", "ƀ": "b", "ɨ": "i"}
_HIDDEN = dict.fromkeys("­​‌‍⁠﻿", "")
_FOLD = str.maketrans({x.lower(): k for k, v in _LOOKS.items() for x in v} | _DIGITS | _BARRED | _HIDDEN)
_SIGNS = re.compile(r"(?:[$@|](?=\w)|(?<=[^\W\d_])!(?=[^\W\d_]))")
_SIGN_LETTERS = {"$": "s", "@": "a", "!": "i", "|": "i"}
_MARKS = re.compile("[\u0300-\u036f]+")
_APART = re.compile(r"(?<!\w)[^\W_](?:[.\-_*·][^\W_]){2,}(?!\w)")
_BETWEEN = re.compile(r"[.\-_*·]")
_REPEATS = re.compile(r"([^\W_])\1{2,}")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Lower case without disguise.

    Compatibility forms (mathematical, circled, wide letters) and accents go by decomposition, look-alikes and digits
    by tables; a sign counts as a letter only before another one; three or more single letters with marks between them
    are a word; of three or more equal letters in a row one stays.
    """
    text = text.lower()
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower()
    text = text.translate(_FOLD)
    if any(sign in text for sign in _SIGN_LETTERS):
        text = _SIGNS.sub(lambda m: _SIGN_LETTERS[m[0]], text)
    text = _APART.sub(lambda m: _BETWEEN.sub("", m[0]), text)
    return _REPEATS.sub(r"\1", text)


class Model(NamedTuple):
    """Weights by term (a word, or a beginning followed by ``*``), exception phrases of two words, coefficients."""

    weights: dict[str, float]
    exceptions: frozenset[str]
    coefficients: tuple[float, float, float]


def _word_before(text: str, start: int) -> str:
    end = start
    while end and not text[end - 1].isalnum():
        end -= 1
    begin = end
    while begin and text[begin - 1].isalnum():
        begin -= 1
    return text[begin:end]


class Matcher:
    def __init__(self, weights: dict[str, float], exceptions: frozenset[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        both: dict[str, list[float | None]] = {}
        for term, weight in weights.items():
            both.setdefault(term.rstrip("*"), [None, None])[term.endswith("*")] = weight
        for term, values in both.items():
            self.automaton.add_word(term, (len(term), *values))
        if both:
            self.automaton.make_automaton()
        self.empty, self.exceptions = not both, exceptions

    def hits(self, folded: str) -> Iterator[tuple[float, str, str]]:
        """Weight of each matched word, and its phrases with the word before and after."""
        best: dict[int, float] = {}
        for end, (size, word, beginning) in () if self.empty else self.automaton.iter(folded):
            start = end + 1 - size
            if start and folded[start - 1].isalnum():
                continue
            whole = end + 1 == len(folded) or not folded[end + 1].isalnum()
            weight = word if whole and word is not None else beginning
            if weight is not None:
                best[start] = weight  # longer terms come later
        for start, weight in best.items():
            own = _WORD.match(folded, start)[0]
            before, after = _word_before(folded, start), _WORD.search(folded, start + len(own))
            yield weight, f"{before} {own}" if before else own, f"{own} {after[0]}" if after else own

    def features(self, text: str) -> tuple[float, float]:
        """Log of the summed weights, alone and for each hundred words."""
        folded = fold(text)
        total = sum(w for w, a, b in self.hits(folded) if a not in self.exceptions and b not in self.exceptions)
        return math.log1p(total), math.log1p(100 * total / max(1, folded.count(" ") + 1))


def terms(text: str) -> set[str]:
    """The distinct words of a text, and their beginnings."""
    words = set(_WORD.findall(fold(text)))
    return words | {w[:k] + "*" for w in words for k in range(STEM, min(len(w), 12) + 1)}


def training_rows(docs: DataFrame, labels: DataFrame, class_rows: int, key: str, text: str, label: str) -> DataFrame:
    """``doc_id, text, toxic`` of at most about ``class_rows`` labelled rows of each class.

    The chosen keys are a bounded table, so they are broadcast and the texts stay where they are.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64("_key"), F.lit(1 << 30))
    share = {c: min(1.0, class_rows / max(1, sizes.get(c, 0))) for c in (0, 1)}
    chosen = known.where(place < F.when(F.col("toxic") == 1, share[1] * (1 << 30)).otherwise(share[0] * (1 << 30)))
    chosen = chosen.groupBy("_key").agg(F.max("toxic").alias("toxic"))
    return keyed_text(docs, key, text).join(F.broadcast(chosen), F.col("doc_id") == F.col("_key")).select("doc_id", "text", "toxic")


def _counted(rows: DataFrame, wanted: frozenset[str] | None) -> DataFrame:
    """``term, n``: rows that have a term; counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for whole in batches:
            for _, texts in sliced(whole):
                for text in texts:
                    own = terms(text)
                    counts.update(own if wanted is None else own & wanted)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    return rows.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, ratio: float) -> dict[str, float]:
    """Terms that are at least ``ratio`` times likelier in toxic rows, with the log of that ratio.

    Of a beginning and a longer one that is in nearly as many toxic rows the longer one stays, and a term is left
    out if a shorter beginning already tells as much.
    """
    weights = {}
    share = n_toxic / (n_toxic + n_clean)
    for term, n in toxic.items():
        other = clean.get(term, 0)
        expected = (n + other) * share, (n + other) * (1 - share)
        g = 2 * (n * math.log(n / expected[0]) + (other * math.log(other / expected[1]) if other else 0.0))
        weight = math.log((n + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_clean + 1))
        if weight >= math.log(ratio) and g >= LEAST_G:
            weights[term] = weight
    for term in sorted(weights, key=len, reverse=True):
        # A word that is nearly all there is of its beginnings stands for them.
        body = term.rstrip("*")
        for k in range(len(body) - (1 if term.endswith("*") else 0), STEM - 1, -1):
            shorter = body[:k] + "*"
            if shorter in weights and shorter != term and toxic[term] >= 0.9 * toxic[shorter]:
                weights.pop(shorter)
    kept: dict[str, float] = {}
    for term in sorted(weights, key=lambda t: (len(t.rstrip("*")), t)):
        body = term.rstrip("*")
        shorter = [body[:k] + "*" for k in range(STEM, len(body) + (0 if term.endswith("*") else 1))]
        if not any(s in kept and kept[s] >= weights[term] - 1 for s in shorter):
            kept[term] = weights[term]
    return kept


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05, steps: int = 50) -> tuple[float, ...]:
    """Coefficients (the constant last) by Newton's method with a small quadratic penalty."""
    full = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(full.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ beta, -30, 30)))
        slope = full.T @ (y - p) - penalty * beta
        curve = (full * (p * (1 - p))[:, None]).T @ full + penalty * np.eye(full.shape[1])
        move = np.linalg.solve(curve, slope)
        beta += move
        if np.abs(move).max() < 1e-8:
            break
    return tuple(beta.tolist())


def fit(
    docs: DataFrame, labels: DataFrame, class_rows: int = CLASS_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model:
    """Learn from the rows of ``labels`` (key, label 0 or 1; others are left out) and their texts.

    Without labels of both classes the lexicon is empty and every score is the share of toxic rows.
    """
    rows = training_rows(docs, labels, class_rows, key, text, label)
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_clean:
        share = min(max(n_toxic / max(1, n_toxic + n_clean), 1e-3), 1 - 1e-3)
        return Model({}, frozenset(), (0.0, 0.0, math.log(share / (1 - share))))
    least = max(LEAST_ROWS, math.ceil(LEAST_SHARE * n_toxic))
    # At most (terms of a row) / LEAST_SHARE terms reach that share, however many rows there are.
    toxic = {r["term"]: r["n"] for r in _counted(rows.where("toxic = 1"), None).where(F.col("n") >= least).collect()}
    clean = {r["term"]: r["n"] for r in _counted(rows.where("toxic = 0"), frozenset(toxic)).collect()}
    weights = lexicon(toxic, clean, n_toxic, n_clean, LEAST_RATIO)
    exceptions = _exceptions(rows, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(weights, exceptions)
        for whole in batches:
            found = np.array([matcher.features(t) for _, texts in sliced(whole) for t in texts]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*map(pa.array, found.T), whole.column(1)], names=["a", "b", "toxic"])

    table = rows.select("text", "toxic").mapInArrow(run, "a double, b double, toxic int").toPandas()
    return Model(weights, exceptions, logistic(table[["a", "b"]].to_numpy(), table["toxic"].to_numpy()))


def _exceptions(rows: DataFrame, weights: dict[str, float]) -> frozenset[str]:
    """Phrases around lexicon terms that at least two clean rows have and no toxic one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(weights, frozenset())
        for whole in batches:
            phrases, toxic = [], []
            for text, label in zip((t for _, texts in sliced(whole) for t in texts), whole.column(1).to_pylist(), strict=True):
                own = {p for _, a, b in matcher.hits(fold(text)) for p in (a, b) if " " in p}
                phrases += own
                toxic += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.string()), pa.array(toxic, pa.int32())], names=["phrase", "toxic"])

    found = rows.select("text", "toxic").mapInArrow(run, "phrase string, toxic int")
    counted = found.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    return frozenset(r["phrase"] for r in counted.where("toxic = 0 and n >= 2").select("phrase").collect())


def with_score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with one more column: the score of each row's whole text. Null texts count as empty; there is no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.weights, model.exceptions)
        a, b, constant = model.coefficients
        for whole in batches:
            found = np.array([matcher.features(t.as_py() or "") for t in whole.column(whole.schema.get_field_index(text))]).reshape(-1, 2)
            scores = 1 / (1 + np.exp(-np.clip(found @ np.array([a, b]) + constant, -30, 30)))
            yield whole.append_column(column, pa.array(scores))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, DoubleType())]))


def score(docs: DataFrame, model: Model, threshold: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row's whole text; empty texts have no hits. Repeated rows each give a row."""
    out = with_score(keyed_text(docs, key, text), model).select("doc_id", "score")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

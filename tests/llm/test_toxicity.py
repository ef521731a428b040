import math
import random
import re

import pytest

from tests.llm.conftest import ODD
from waybill.llm import toxicity as tox


def test_folding():
    assert tox.fold("1D10T іdіоt IDI​OT ｉｄｉｏｔ $cum a$$") == "idiot idiot idiot idiot scum a$$"


@pytest.mark.parametrize(
    "disguised",
    ["ídíot", "𝐢𝐝𝐢𝐨𝐭", "ⓘⓓⓘⓞⓣ", "i.d.i.o.t", "I-D-I-O-T", "idiooot", "|diot", "ιԁіοτ", "Ꭵժ1օᎢ", "id\u00adiot", "i\u0301diot"],
)
def test_disguises_are_folded(disguised):
    assert tox.fold(f"an {disguised} indeed") == "an idiot indeed"


def test_folding_leaves_words_alone():
    plain = "a well-known e.g. of the U.S. rule, so cool: a-b and book-keeping | or"
    assert tox.fold(plain) == plain.lower()
    assert tox.fold("straße naïve Привет") == tox.fold(tox.fold("straße naïve Привет"))


def test_neighbours_are_whole_words():
    far = "x" * 200
    ((_, before, after),) = tox.Matcher({"idiot": 1.0}, frozenset()).hits(tox.fold(f"a{far}b idiot  c{far[:1]}y"))
    assert before.endswith(" idiot") and after == "idiot cxy"
    long = "ab" * 100
    ((_, before, after),) = tox.Matcher({"idiot": 1.0}, frozenset()).hits(f"{long} idiot {'-' * 100} {long}")
    assert before == f"{long} idiot" and after == f"idiot {long}"


@pytest.mark.parametrize("seed", range(3))
def test_matches_equal_a_naive_search(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abc") for _ in range(draw.randrange(1, 7)))
    weights = {w + draw.choice(["", "*"]): round(draw.random() * 4, 3) for w in (word() for _ in range(12))}
    texts = [draw.choice([" ", ", ", "-", "  "]).join(word() for _ in range(30)) for _ in range(60)]
    exceptions = frozenset(" ".join(p) for t in texts[:10] for p in zip(t.split(), t.split()[1:]) if all(x.isalpha() for x in p))
    matcher = tox.Matcher(weights, exceptions)
    for text in texts:
        folded, total = tox.fold(text), 0.0
        words = re.findall(r"[^\W_]+", folded)
        for k, own in enumerate(words):
            fits = [t for t in weights if own == t or (t.endswith("*") and own.startswith(t[:-1]))]
            if not fits:
                continue
            longest = max(fits, key=lambda t: (len(t.rstrip("*")), not t.endswith("*")))
            around = {" ".join(words[max(0, k - 1) : k + 1]), " ".join(words[k : k + 2])}
            if not around & exceptions:
                total += weights[longest]
        got = matcher.features(text)
        assert got[0] == pytest.approx(math.log1p(total))
        assert got[1] == pytest.approx(math.log1p(100 * total / (folded.count(" ") + 1)))


def test_matching_and_exceptions():
    matcher = tox.Matcher({"idiot": 3.0, "lowe*": 2.0, "lower": 4.0}, frozenset({"useful idiot"}))
    weights = lambda t: [w for w, *_ in matcher.hits(tox.fold(t))]
    assert weights("1diot, idiots lowei flower lower") == [3.0, 2.0, 4.0]
    assert matcher.features("a useful idiot")[0] == 0 and matcher.features("an idiot")[0] > 0
    assert matcher.features("an idiot")[1] > matcher.features("an idiot " + "word " * 100)[1]


def test_learned_from_labels(make, spark):
    draw = random.Random(2)
    clean = ["".join(draw.choice("abcdefg") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for k in range(600):
        words = [draw.choice(clean) for _ in range(60)]
        if k % 6 == 0:
            words[draw.randrange(60)] = draw.choice(["zwort", "qxstem" + draw.choice(clean), "zw0rt", "ZWORT!"])
        rows.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, int(k % 6 == 0)))
    docs, known = make(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = tox.fit(docs, known.where("doc_id % 4 <> 2"))
    assert "zwort" in model.weights or any(t.startswith("zwor") for t in model.weights)
    right = {r.doc_id: r.predicted == (r.doc_id % 6 == 0) for r in tox.score(docs, model).collect()}
    assert sum(right[k] for k in right if k % 4 == 2) / 150 > 0.95


def test_odd_rows(odd, none, spark):
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = tox.fit(odd, empty)
    rows = tox.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert tox.score(none, model).collect() == []
    odd_labels = spark.createDataFrame([(1, 1), (7, 1), (9, 0), (2, None), (99, 1)], "doc_id bigint, toxic int")
    assert tox.score(odd, tox.fit(odd, odd_labels)).count() == len(ODD)

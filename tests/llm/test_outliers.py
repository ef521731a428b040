import re
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import ODD
from waybill.llm import outliers

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def counts(text):
    words = WORD.findall(text or "")
    where = defaultdict(list)
    for k in range(len(words) - 7):
        where[tuple(words[k : k + 8])].append(k)
    marked = set()
    for places in where.values():
        if len(places) > 1:
            marked.update(p + d for p in places for d in range(8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked)


def test_counts_of_odd_rows(odd):
    rows = outliers.judge(odd).collect()
    assert len(rows) == len(ODD)
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == sorted((str(i), *counts(t)) for i, t, *_ in ODD)
    assert all(r.kept is not None and not (r.base_failed and r.kept) for r in rows)


def test_counts_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in outliers.judge(docs).collect():
        own = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == own
        assert r.base_failed == (own[0] < 20 or 100 * own[4] > 30 * own[0])


def test_no_rows(none):
    assert outliers.judge(none).collect() == []


def test_junk_goes_and_clean_rows_stay(make):
    draw = np.random.default_rng(1)
    words = ["".join(draw.choice(list("abcdefghijk"), 5)) for _ in range(3000)]
    rows = []
    for k in range(400):
        own = [words[i] for i in draw.integers(0, 3000, int(draw.lognormal(5, 0.7)) + 25)]
        junk = k % 5 == 0
        rows.append((k, " ".join(w + "%%%" * junk for w in own), "en", "hot" if k % 3 else f"s{k % 40}", 0))
    verdict = {r.doc_id: r.kept for r in outliers.judge(make(rows)).collect()}
    assert not any(verdict[k] for k in range(0, 400, 5))
    assert all(verdict[k] for k in range(400) if k % 5)


def test_chi_square():
    assert outliers.chi_square(0.5) == pytest.approx(5.348, abs=1e-3)
    assert outliers.chi_square(0.01) == pytest.approx(16.812, abs=1e-3)

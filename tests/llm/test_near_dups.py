import random

import numpy as np
import pytest

from waybill.llm import near_dups
from waybill.llm.components import components


def brute(rows, words, percent=80):
    sets = {}
    for key, text, *_ in rows:
        if key is None:
            continue
        own = (text or "").encode().lower().split()
        width = min(words, len(own))
        sets.setdefault(key, set()).update(tuple(own[i : i + width]) for i in range(len(own) - width + 1) if own)
    label = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return sets, label


@pytest.fixture(scope="module")
def families():
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    rows = []
    for family in range(12):
        base = [word() for _ in range(draw.choice([6, 40, 150]))]
        for _ in range(draw.randrange(1, 14)):
            text = list(base)
            for _ in range(draw.randrange(0, max(1, len(base) // 12))):
                text[draw.randrange(len(text))] = word()
            rows.append((1000 - len(rows), " ".join(text), "en", f"s{family}", 0))
    return rows


def test_components_equal_brute_force(make, families):
    sets, label = brute(families, 5)
    rows = near_dups.near_duplicates(make(families)).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in rows} == {k: (v, len(sets[k]), k == v) for k, v in label.items()}
    assert len(set(label.values())) < len(label)


def test_blocks_give_the_same(make, families, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_SETS", 2)
    _, label = brute(families, 5)
    rows = near_dups.near_duplicates(make(families)).collect()
    assert {r.doc_id: r.component_id for r in rows} == label


def test_odd_rows(odd):
    rows = near_dups.near_duplicates(odd).collect()
    assert len(rows) == 11
    found = {r.doc_id: (r.component_id, r.kept, r.n_shingles) for r in rows}
    assert found[1] == (1, True, 0) and found[2] == (2, True, 0) and found[3] == (3, True, 0)
    assert found[7][:2] == (7, True) and found[8][:2] == (7, False) and found[9][:2] == (7, False)
    assert found[None][:2] == (None, True)
    kept = near_dups.representatives(odd, near_dups.near_duplicates(odd))
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    assert kept.columns == odd.columns


def test_no_rows(none):
    assert near_dups.near_duplicates(none).collect() == []


def test_posterior_bounds():
    ends = near_dups.least_matches(0.8, 1e-7, 128, 32)
    assert [n for n, _ in ends] == [32, 64, 96, 128]
    rates = [m / n for n, m in ends]
    assert rates == sorted(rates) and rates[-1] < 0.8
    random = np.random.default_rng(0)
    matches = random.binomial(128, 0.8, 100_000)
    assert (matches < ends[-1][1]).sum() == 0


def test_long_chain(spark):
    chain = spark.createDataFrame([(k + d, 10_000 + k) for k in range(60) for d in (0, 1)], "node bigint, hub bigint")
    assert {r.label for r in components(chain).collect()} == {0}


def test_one_of_each_row(make, odd, none):
    base = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    third = " ".join(f"u{k}" for k in range(60))
    rows = [
        (5, base, "en", "a", 0),
        (2, f"{base} more", "en", "a", 0),  # near the row before, and its key is smaller
        (2, other, "en", "a", 0),  # repeats a key with a text of its own
        (5, third, "en", "a", 0),
        (7, third, "en", "a", 0),
        (None, f"{third} end", "en", "a", 0),
        (8, other, "en", "a", 0),
        (8, other, "en", "a", 0),
        (9, None, "en", "a", 0),
        (9, "", "en", "a", 0),
        (None, " ".join(f"t{k}" for k in range(30)), "en", "a", 0),
    ]
    docs = make(rows)
    kept = near_dups.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), (r.text or "")[:2]) for r in kept.collect())
    assert got == sorted([("2", "w0"), ("2", "v0"), ("5", "u0"), ("9", ""), ("9", ""), ("None", "t0")])
    # Of the odd rows only the copies of one text go, whatever their keys.
    assert near_dups.one_of_each(odd).count() == odd.count() - 3
    assert near_dups.one_of_each(none).collect() == []

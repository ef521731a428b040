import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from waybill.llm import mixing


def plain_targets(sizes):
    """The sharing rule, in exact numbers."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        goal = {s: Fraction(3 * sizes[s]) if s in full else Fraction(rest * weight[s], free) for s in names}
        above = {s for s in names if goal[s] > 3 * sizes[s]}
        if not above:
            return {s: float(goal[s]) for s in names}
        full |= above


def corpus(draw, sources, count, longest=60):
    rows = []
    for key in range(count):
        source = draw.choices([s for s, _ in sources], [w for _, w in sources])[0]
        rows.append((key, "word " * draw.randint(0, longest), "en", source, 0))
    return rows


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("task_rows", [200_000, 150])
def test_sources_come_to_their_targets(make, task_rows):
    sources = [("a", 40), ("b", 1), ("ä", 3), ("B", 10), ("", 5), (None, 7), ("zz", 30)]
    rows = corpus(random.Random(4), sources, 1500)
    got = mixing.mix(make(rows), task_rows=task_rows).collect()
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += words(text)
    goal = plain_targets(sizes)
    assert sorted((r["doc_id"], r["size"], r["source"] or "") for r in got) == sorted((r[0], words(r[1]), r[3] or "") for r in rows)
    taken, copies, count = defaultdict(int), defaultdict(int), Counter(r[3] for r in rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], goal[r["source"]], rel_tol=1e-12)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        rate = r["target"] / r["source_size"]
        assert math.floor(rate) <= r["copies"] <= math.ceil(rate)
        taken[r["source"]] += r["taken"]
        copies[r["source"]] += r["copies"]
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 2
        # The documents are balanced too, but for those of the landing.
        assert abs(copies[s] - count[s] * goal[s] / sizes[s]) <= mixing.LANDING
    again = mixing.mix(make(rows[::-1]).repartition(7), task_rows=task_rows).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_a_flight_keeps_sums_and_expectations():
    draw = np.random.default_rng(1)
    taken = np.zeros(40)
    x = draw.integers(1, 500, 40).tolist()
    p = [0.3] * 40
    runs = 3000
    for seed in range(runs):
        flight, q = mixing.Flight(seed), np.zeros(40)
        for row in range(40):
            for r, value in flight.add(row, p[row], x[row]):
                q[r] = value
        for r, value, _ in flight.open:
            q[r] = value
        assert abs(q.sum() - 12) < 1e-9 and abs(q @ x - 0.3 * sum(x)) < 1e-6
        assert len(flight.open) <= mixing.LANDING
        taken += q
    assert np.abs(taken / runs - 0.3).max() < 0.05


def test_the_landing_takes_the_nearest_choice():
    assert mixing.land([], []) == []
    assert mixing.land([0.5, 0.5], [10, 30]) in ([0, 1], [1, 0])
    assert mixing.land([0.2, 0.2, 0.2, 0.2, 0.2], [5, 10, 15, 20, 50]) in ([0, 0, 0, 1, 0], [1, 0, 1, 0, 0])


def test_odd_rows(odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == odd.count() and mixing.mix(none).count() == 0
    assert sorted(r["size"] for r in got) == sorted(words(r["text"]) for r in odd.collect())
    assert all(r["taken"] <= 3 * r["size"] for r in got)


def test_tables_without_words_and_repeated_rows(make):
    got = mixing.mix(make([(1, None, "en", None, 0), (2, " ", "en", "a", 0)])).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in got} == {(0, 0.0, 0)}
    got = mixing.mix(make([(1, "one two three", "en", "a", 0)] * 100 + [(2, "word " * 30, "en", "b", 0)]))
    assert got.count() == 101
    taken = {r["source"]: r["sum(taken)"] for r in got.groupBy("source").sum("taken").collect()}
    assert taken == {"a": 240, "b": 90}

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from waybill.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plainly(docs, target, share=5, least=20):
    """The contract, one document after another."""
    known = [(key, *grams(text)) for key, text in docs]
    s = Counter(b for _, _, found in known for b in found)
    t = Counter(b for text in target for b in grams(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in s}
    rows = []
    for key, words, found in known:
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append((key, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    place = {id(r): k + 1 for k, r in enumerate(able[: share * len(able) // 100])}
    return [(r[0], *r[2:], place.get(id(r))) for r in rows]


def spelled(rows):
    return sorted(map(str, rows))


@pytest.fixture(scope="module")
def target(spark):
    rows = [(k, f"target words {k} of some kind again and again") for k in range(5)] + [(9, None)]
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumn("rank", F.lit(1))


def ours(docs, target, **more):
    return spelled(tuple(r) for r in importance.resample(docs, target, **more).collect())


@pytest.mark.parametrize("share", [0, 7, 50, 100])
def test_resample_equals_a_plain_computation(make, target, share):
    draw = random.Random(3)
    words = "target words some kind again é other Word42 x y z".split()
    rows = [(k * 5 - 40, " ".join(draw.choices(words, k=draw.randint(10, 60))), "en", "a", 0) for k in range(300)]
    texts = [r["text"] for r in target.collect()]
    expected = spelled(plainly([r[:2] for r in rows], texts, share))
    assert ours(make(rows), target, share=share) == expected


def test_odd_rows_keep_their_rows(odd, none, target):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    expected = spelled(plainly(docs, [r["text"] for r in target.collect()], least=0, share=0))
    assert ours(odd, target, least_words=0, share=0) == expected
    got = importance.resample(odd, target, least_words=0, share=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5]
    assert importance.resample(none, target).count() == 0
    assert importance.resample(odd, target.limit(0)).count() == odd.count()


def test_ties_go_to_the_smaller_key_and_repeats_share_no_rank(make, target):
    # One text everywhere: equal weights, and one key a hundred times.
    text = "one two three four five six " * 4
    rows = [(k, text, "en", "a", 0) for k in range(100)] + [(7, text, "en", "a", 0)] * 100 + [(None, text, "en", "a", 0)] * 100
    got = importance.resample(make(rows), target, share=40).collect()
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert len(got) == 300 and ranks == list(range(1, 121))
    expected = sorted((-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in got)[:120]
    assert [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == expected


def test_blocks_of_a_long_text_cut_no_word_and_lose_no_run(monkeypatch):
    draw = random.Random(5)
    text = " ".join("".join(draw.choices("abé", k=draw.randint(1, 30))) for _ in range(400)) + "  "
    whole = importance.features(text.encode())
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(importance, "BLOCK_BYTES", size)
        words, found = importance.features(text.encode())
        assert words == whole[0] and sorted(found.tolist()) == sorted(whole[1].tolist())


def test_bisection_finds_the_least_number(spark):
    values = [3, 3, 3, -2_000_000, 17, 900_000_000, None]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    known = sorted(v for v in values if v is not None)
    for wanted in range(1, 7):
        assert importance.least_with(rows, "v", lambda n, wanted=wanted: n >= wanted) == known[wanted - 1]
    assert importance.least_with(rows, "v", lambda n: n >= 7) is None
    assert importance.least_with(rows.limit(0), "v", lambda n: n >= 1) is None

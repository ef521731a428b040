import random
import re
import zlib
from collections import Counter

import pytest

from waybill.llm import fm_index, variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plainly(docs, every=31):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        top = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = top if top and words[top] >= 10 * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(map(str, rows))


def ours(docs, **more):
    found = variants.group_variants(docs, **more).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(str(tuple(r)) for r in found.collect())


@pytest.mark.parametrize("letters", ["ab", "abé", "abcdefghÿ"])
def test_index_finds_every_pair_once(letters):
    draw = random.Random(len(letters))
    for _ in range(40):
        words = list({"".join(draw.choices(letters, k=draw.randint(1, 9))) for _ in range(draw.randint(1, 120))})
        for turned in (False, True):
            rows = [w[::-1] for w in words] if turned else words
            exact = [len(w) // 2 for w in words]
            found = fm_index.one_edit_apart(fm_index.Index(rows), rows, exact)
            got = sorted(zip(*[f.tolist() for f in found], strict=True))
            want = [
                (i, j)
                for i, (w, e) in enumerate(zip(rows, exact, strict=True))
                for j, v in enumerate(rows)
                if v.endswith(w[len(w) - e :]) and one_edit(w[: len(w) - e], v[: len(v) - e])
            ]
            assert got == sorted(want)


@pytest.fixture(scope="module")
def spelled():
    draw = random.Random(2)
    stems = ["".join(draw.choices("abcdeéÿ", k=draw.randint(6, 12))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaab", "abababab"]
    rows = []
    for key in range(400):
        words = draw.choices(stems, [1 / (k + 1) for k in range(len(stems))], k=40)
        for at in range(len(words)):
            if draw.random() < 0.05:
                word, cut = words[at], draw.randrange(len(words[at]))
                words[at] = draw.choice([word[:cut] + word[cut + 1 :], word[:cut] + "a" + word[cut:], word[:cut].upper() + "b" + word[cut + 1 :]])
        rows.append((key, draw.choice(["-", " ", "1", "_ń"]).join(words), "en", "a", 0))
    return rows


@pytest.mark.parametrize("shard_words", [20_000, 30, 3])
def test_groups_equal_a_comparison_of_all_words(make, spelled, shard_words):
    """Also with halves that far more words share than a shard is meant to hold."""
    got = ours(make(spelled), shard_words=shard_words)
    assert got == plainly([r[:2] for r in spelled]) and len(got) > 100


def test_chains_lead_to_the_root(make):
    chain = ["abcdefg", "abcdefh", "abcdekh", "abcdlkh", "abcmlkh", "abnmlkh"]
    rows = [(k, " ".join([w] * (2 * 10**k)), "en", "a", 0) for k, w in enumerate(chain)]
    found = {r["word"]: r for r in variants.group_variants(make(rows), every=0).collect()}
    assert {r["root"] for r in found.values()} == {"abnmlkh"}
    assert [found[w]["form"] for w in chain] == [*chain[1:], None]
    assert [found[w]["n_near"] for w in chain] == [1, 2, 2, 2, 2, 1]


def test_odd_rows(odd, none, make):
    assert ours(none) == []
    assert ours(odd) == plainly([(r["doc_id"], r["text"]) for r in odd.collect()])
    # Very long words, one of a single letter.
    long = ["x" * 5_000, "x" * 5_001, "ab" * 2_500, "ab" * 2_500 + "b"]
    rows = [(k, f"{w} {w}", "en", "a", 0) for k, w in enumerate(long)]
    assert ours(make(rows), every=0) == plainly([r[:2] for r in rows], every=0)


def test_blocks_cut_no_run(monkeypatch):
    text = "ab cde  fghijé klm " * 30
    whole = [w for words in variants.words_of("1", text) for w in words]
    for size in (1, 3, 20):
        monkeypatch.setattr(variants, "BLOCK_CHARS", size)
        assert [w for words in variants.words_of("1", text) for w in words] == whole

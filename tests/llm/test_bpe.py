import random
import time

import numpy as np
import pytest

from tests.llm.conftest import ODD
from waybill.llm import bpe
from waybill.llm.common import tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


@pytest.mark.parametrize("seed", range(3))
def test_codec_agrees_with_the_library(library, seed):
    draw = random.Random(seed)
    texts = ["".join(draw.choice("ab c\n\t'ls,.1é <|\x85 \x1c😀") for _ in range(draw.randrange(80))) for _ in range(400)]
    texts += ["x<|endoftext|>y <|endoftext|>", "aaaaaaaaaaaaaaaaaaa", "  a  b ", " ", "don't we'll", "日本語 123abc½"]
    codec = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    for text, blob in zip(texts, codec.encode_batch(texts), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(blob, np.int32).tolist() == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_odd_rows_round_trip(odd, library):
    rows = bpe.decode(bpe.encode(odd)).collect()
    assert len(rows) == len(ODD)
    got = sorted((str(r.doc_id), r.text, len(r.ids)) for r in rows)
    assert got == sorted((str(i), t or "", len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in ODD)


def test_no_rows(none):
    assert bpe.decode(bpe.encode(none)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_long_words_agree_with_the_library(library, seed):
    draw = random.Random(seed)
    sizes = [bpe.LONG_WORD - 1, bpe.LONG_WORD, bpe.LONG_WORD + 1, 500, 3000]
    words = ["".join(draw.choice(alphabet) for _ in range(n)) for n in sizes for alphabet in ("a", "ab", "etaoinshr", "éüßabc", "日本語")]
    texts = [*words, " ".join(words), "ab" * 400, "aab" * 300, "=" * 777]
    codec = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    for text, blob in zip(texts, codec.encode_batch(texts), strict=True):
        assert np.frombuffer(blob, np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_time_of_a_long_word_follows_its_length(library):
    draw = random.Random(5)
    text = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    codec = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    begin = time.perf_counter()
    (blob,) = codec.encode_batch([text])
    assert time.perf_counter() - begin < 60
    assert np.frombuffer(blob, np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_full_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2_000)
    codec = bpe.Codec(tokenizer_path("byte_bpe_50k.json"))
    for k in range(20):
        text = f"piece{k} of a text number {k} and others"
        (blob,) = codec.encode_batch([text])
        assert np.frombuffer(blob, np.int32).tolist() == library.encode(text, add_special_tokens=False).ids
        assert codec.held <= 2_000 + 20 * (bpe.ENTRY_BYTES + 60)

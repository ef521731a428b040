import base64
import gzip
import re
import time
import urllib.parse
import zlib

import pytest

from tests.llm.conftest import ODD
from waybill.llm import secret_scan as scan

SECRET = 'token = "80caf00312470a19c410a04f46e97e3432b5bdae"'


def brute(text):
    found = []
    assign = r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for kind, pattern, group, least in (("assign", assign, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)):
        found += [(m.start(), scan.KINDS.index(kind), m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [(scan.KINDS[k], a, b) for a, k, b in sorted(found)]


@pytest.mark.parametrize(
    "text",
    ["", "x", SECRET, "Token=abc token=abcdef12 paſſword=abcdefgh PASSWORD:'a.b-c_d'", "AKIA" + "A" * 16 + " AKIA1 " + "0" * 24, "api_key=secret=abcdefgh", "é" * 5 + SECRET * 3],
)
def test_plain_spans(text):
    spans, _ = scan.scan(text)
    assert [(s.kind, s.start, s.end) for s in spans if s.depth == 0] == brute(text)


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


@pytest.mark.parametrize(
    "wrapped, depth",
    [
        (b64(SECRET), 1),
        (b64(b64(SECRET)), 2),
        (b64(gzip.compress(SECRET.encode())), 1),
        (b64(zlib.compress(SECRET.encode())), 1),
        (urllib.parse.quote(b64(b64(SECRET)) + "=", safe=""), 3),
        ("".join(f"\\u{ord(c):04x}" for c in SECRET), 1),
        ("".join(f"%{b:02X}" for b in SECRET.encode()), 1),
    ],
)
def test_nested_secrets_are_mapped_back(wrapped, depth):
    text = f"some words before {wrapped} and after"
    spans, cut = scan.scan(text)
    inner = [s for s in spans if s.kind == "assign"]
    assert len(inner) == 1 and not cut
    assert inner[0].depth >= depth - 1
    begin = text.index(wrapped)
    assert begin <= inner[0].start < inner[0].end <= begin + len(wrapped)
    assert "before [SECRET]" in scan.masked(text) and scan.masked(text).endswith(" and after")


def test_exact_places_in_escapes():
    text = "é password%3Dabcdef12 &#x41;KIATCGM6RMXLBNV4Q6V"
    assert [(s.kind, text[s.start : s.end]) for s in scan.scan(text)[0]] == [("assign", "password%3Dabcdef12"), ("access", "&#x41;KIATCGM6RMXLBNV4Q6V")]


@pytest.mark.parametrize("pack", [b64, lambda x: b64(zlib.compress(x.encode())), lambda x: "".join(f"%{b:02X}" for b in x.encode())])
def test_equal_layers_count_in_every_place(pack):
    token = pack(SECRET)
    text = f"one {token}\ntwo {token} three {b64('a ' + token + ' b')} four {b64('c ' + token + ' d')} end"
    spans, cut = scan.scan(text)
    assert not cut
    for begin, end in [(m.start(), m.end()) for m in re.finditer(r"\S{30,}", text)]:
        assert any(s.kind == "assign" and begin <= s.start < s.end <= end for s in spans)
    masked = scan.masked(text)
    assert masked.count("[SECRET]") == 4
    assert not any(s.kind in ("assign", "hex") for s in scan.scan(masked)[0])


LONG = "".join(f"{k * 7919 % 10007} words of line {k} " for k in range(60))


def zstd(x):
    import zstandard

    return zstandard.ZstdCompressor().compress(x.encode())


def lines(x, width):
    return "\n".join(x[i : i + width] for i in range(0, len(x), width))


@pytest.mark.parametrize(
    "wrapped",
    [
        base64.urlsafe_b64encode(zlib.compress(("ÿþ~?>" * 3 + LONG + SECRET).encode())).decode(),
        base64.urlsafe_b64encode(("a?>ÿ" * 9 + SECRET).encode()).decode(),
        lines(b64(gzip.compress((LONG + SECRET).encode())), 76),
        lines(b64(LONG + SECRET), 64),
        lines(b64(zstd(LONG + SECRET)), 64).replace("\n", "\r\n"),
        "/files/" + b64(SECRET),
        "/files/" + b64(zlib.compress(SECRET.encode())),
        "x-" + b64(SECRET).rstrip("="),
        "word" * 5 + "s" + b64(SECRET),
        b64(gzip.compress(b"first ") + gzip.compress(SECRET.encode())),
        b64(zstd("first ") + zstd(SECRET)),
    ],
)
def test_base64_in_all_its_forms(wrapped):
    text = f"before {wrapped} and after"
    spans, cut = scan.scan(text)
    assert not cut
    assert any(s.kind == "assign" for s in spans) and all(7 <= s.start < s.end <= 7 + len(wrapped) for s in spans)
    masked = scan.masked(text)
    assert masked.endswith(" and after") and not any(s.kind == "assign" for s in scan.scan(masked)[0])


@pytest.mark.parametrize("pack", [lambda x: gzip.compress(x.encode()), lambda x: zlib.compress(x.encode())])
def test_broken_data_is_read_as_far_as_it_goes(pack):
    spans, cut = scan.scan("x " + b64(pack(SECRET + " " + LONG)[:-40]) + " y")
    assert cut and any(s.kind == "assign" for s in spans)


def test_ends_where_data_repeats_or_grows():
    assert scan.scan("%2525252525252525 " + b64("x" * 40))[1] is False
    bomb = b64(gzip.compress(b"a b " * 1_000_000))
    assert scan.scan(bomb, 10_000) == ([], True)


def test_odd_rows(odd, none):
    rows = scan.scan_documents(odd).collect()
    assert len(rows) == len(ODD) and not any(r.spans for r in rows)
    masked = scan.mask_documents(odd).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in masked) == sorted((str(i), str(t)) for i, t, *_ in ODD)
    assert scan.scan_documents(none).collect() == [] and scan.mask_documents(none).collect() == []


def test_masked_rows(make):
    docs = make([(1, f"a {SECRET} b", "en", "s", 99)])
    row = scan.mask_documents(docs).first()
    assert row.text == 'a [SECRET]" b' and row.n_chars == len(row.text)


def _packed(data: bytes) -> str:
    return base64.b64encode(zlib.compress(data, 9)).decode()


def test_what_is_cut_is_masked_whole():
    bomb = _packed(b"x" * 100_000 + b" password=hunter22 ")
    text = f"before {bomb} after password=hunter33 {_packed(b'token: abcdefgh')} end"
    spans, cut = scan.scan(text, most=50_000)
    assert cut and [text[s.start : s.end] for s in spans] == ["password=hunter33"]
    got = scan.masked(text, most=50_000)
    assert got == "before [SECRET] after [SECRET] [SECRET] end"
    # Within the bound all is seen; only what holds a secret goes.
    assert scan.masked(text).count("[SECRET]") == 3 and not scan.scan(text)[1]
    harmless = f"before {_packed(b'x' * 100_000)} after"
    assert scan.masked(harmless) == harmless
    broken = f"before {_packed(bytes(range(32, 120)) * 50 + b'secret')[:-24]} after"
    assert scan.scan(broken)[1] and scan.masked(broken) == "before [SECRET] after"


@pytest.mark.parametrize("seed", [b"x\x9c", b"\x28\xb5\x2f\xfd", b"\x1f\x8b\x08", b"x\x9cab"])
def test_time_follows_the_length_of_what_looks_compressed(seed):
    def took(size):
        text = base64.b64encode(seed * (size // len(seed))).decode() + " password=hunter22"
        begin = time.process_time()
        assert [s.kind for s in scan.scan(text)[0]] == ["assign"]
        return time.process_time() - begin

    took(10_000)
    short, long = took(100_000), took(800_000)
    assert long < 16 * max(short, 0.1)

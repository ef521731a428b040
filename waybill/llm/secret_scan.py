"""Secrets in texts, also inside nested encodings.

A worklist unwraps layers: percent escapes and Unicode escapes of a whole layer, base64 runs, and compressed
data (gzip, zlib, zstandard) behind them. Every new layer is scanned with the same patterns and unwrapped in turn.
A content that lies in several places is unwrapped once, and its spans are mapped up from each of them; only a
layer that repeats one around it is left alone. Spans are mapped back to the original text.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.bpe import sliced
from waybill.llm.common import keyed_text

#: Kinds in the order in which equal starts are listed, with their patterns and least lengths (group, characters).
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_RUN = re.compile(r"[0-9a-f]{24}")
#: Characters decoded from one text at most, against data that grows without end; a row tells if it was reached.
DECODED_CHARS = 64_000_000
#: One character each: a UTF-8 sequence, or a pair of surrogates.
_MORE = "%[89ABab][0-9A-Fa-f]"
_PERCENT = re.compile(rf"%[CDcd][0-9A-Fa-f]{_MORE}|%[Ee][0-9A-Fa-f](?:{_MORE}){{2}}|%[Ff][0-4](?:{_MORE}){{3}}|%[0-9A-Fa-f]{{2}}")
_ESCAPE = re.compile(r"\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[xX][0-9A-Fa-f]{1,6};|&#[0-9]{1,7};")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}+={0,2}")
#: A run that goes on at the beginning of the next lines; all lines but the last end with it.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t]*[A-Za-z0-9+/_-]++)++={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
#: Where compressed data may begin, and UTF-8 text as long as the shortest secret.
_MAGIC = re.compile(rb"\x28\xb5\x2f\xfd|\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]")
_STRETCH = re.compile(
    rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|\xed[\x80-\x9f][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){12,}+"
)
_LONG = 16
#: Bytes of compressed data that are fed first, and at a time at most.
FIRST_BYTES, MOST_BYTES = 8, 4096
#: Bytes after which a stream must have given something; headers and code tables are shorter.
HEADER_BYTES = 2048
Up = Callable[[int, int], tuple[int, int] | None]


#: Kind of a run that was not decoded to its end.
CUT = "cut"


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    depth: int
    path: str


def matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind that are long enough."""
    if "=" in text or ":" in text:
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                yield "access", m.start(), m.end()
    if _long_word(text, 24) and _HEX_RUN.search(text):
        for m in _HEX.finditer(text):
            if m.end() - m.start() >= 24:
                yield "hex", m.start(), m.end()


def _long_word(text: str, size: int) -> bool:
    """Whether a run without white space is that long; cheap, and false for most prose."""
    return max(map(len, text.split()), default=0) >= size


def _replaced(text: str, pattern: re.Pattern, decode: Callable[[str], str]) -> tuple[str, Up] | None:
    """The text with every match decoded, and how spans of it lie in ``text``; spans without a decoded part don't count."""
    parts, marks, at, size = [], [], 0, 0  # marks: begin in the result, begin and end in the text, decoded or not
    for m in pattern.finditer(text):
        new = decode(m[0])
        if new == m[0]:
            continue
        if m.start() > at:
            parts.append(text[at : m.start()])
            marks.append((size, at, m.start(), False))
            size += m.start() - at
        parts.append(new)
        marks.append((size, m.start(), m.end(), True))
        size += len(new)
        at = m.end()
    if not parts:
        return None
    parts.append(text[at:])
    marks.append((size, at, len(text), False))
    begins = [x[0] for x in marks]

    def up(start: int, end: int) -> tuple[int, int] | None:
        first, last = bisect_right(begins, start) - 1, bisect_right(begins, end - 1) - 1
        if not any(x[3] for x in marks[first : last + 1]):
            return None
        low, high = marks[first], marks[last]
        return low[1] if low[3] else low[1] + start - low[0], high[2] if high[3] else high[1] + end - high[0]

    return "".join(parts), up


def _percent(run: str) -> str:
    return bytes.fromhex(run.replace("%", "")).decode("utf-8", "replace")


def _escape(run: str) -> str:
    if run.startswith("&#"):
        code = int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])
    elif run.startswith("\\u") and run[2] != "{":
        units = b"".join(int(x, 16).to_bytes(2, "big") for x in run.split("\\u")[1:])
        return units.decode("utf-16-be", "replace")
    else:
        code = int(run.strip("\\uUx{}"), 16) if run[2] != "{" else int(run[3:-1], 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"


def _reader(zstd: bool):
    if zstd:
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj()
    return zlib.decompressobj(wbits=47)


def _inflate(data: bytes, at: int, most: int) -> tuple[bytes, int, bool] | None:
    """What the gzip members, zlib streams or zstandard frames from place ``at`` on hold, where they end, and if the last
    is broken; at most ``most`` bytes. None if it isn't compressed.

    Nothing is copied but what is fed. Pieces grow, so data that only looks compressed is given up after a few bytes;
    damaged data is read up to its damage by halving the piece that fails.
    """
    view, out, start, broken = memoryview(data), bytearray(), at, False
    while at < len(data) and len(out) < most and not broken:
        zstd = view[at : at + 4] == b"\x28\xb5\x2f\xfd"
        deflated = view[at : at + 2] == b"\x1f\x8b" or (view[at : at + 1] == b"\x78" and len(data) > at + 1 and int.from_bytes(view[at : at + 2], "big") % 31 == 0)
        if not zstd and not deflated:
            break
        reader, before, begin, step, damaged = _reader(zstd), len(out), at, FIRST_BYTES, False
        while at < len(data) and len(out) < most and not reader.eof:
            kept = None if zstd or at == begin else reader.copy()
            piece = view[at : at + step]
            try:
                # Small pieces, since zstandard has no limit of its own.
                found = reader.decompress(piece) if zstd else reader.decompress(piece, most - len(out))
            except Exception:  # noqa: BLE001  damaged data of any kind
                damaged = True
                if step == 1 or at == begin:
                    break
                reader = kept or _reader(zstd)
                if zstd:
                    reader.decompress(view[begin:at])
                step //= 2
                continue
            out += found
            at += len(piece)
            if len(out) == before and at - begin > HEADER_BYTES:
                break
            if not damaged:
                step = min(2 * step, MOST_BYTES)
        if reader.eof:
            at -= len(reader.unused_data)
        broken = not reader.eof and len(out) < most
        if broken and len(out) == before:
            at, broken = begin, begin > start
            break
    return (bytes(out[:most]), at, broken) if out else None


def _readable(data: bytes, tail: bool = False) -> str | None:
    """The text if the bytes are UTF-8 with hardly any control characters; ``tail``: its last character may be cut."""
    try:
        text = data.decode()
    except UnicodeDecodeError as e:
        if not tail or e.reason != "unexpected end of data":
            return None
        text = data[: e.start].decode()
    odd = sum(1 for c in text if c < " " and c not in "\t\n\r" or c == "\x7f")
    return text if text and odd * 20 <= len(text) else None


class _Part(NamedTuple):
    """A text in a base64 run: its place in the decoded bytes, whether it was compressed, its layers, and if it is broken off."""

    text: str
    begin: int
    end: int
    packed: bool
    name: str
    broken: bool


def _unpacked(data: bytes, at: int, most: int) -> _Part | None:
    """The text that the bytes from ``at`` hold, compressed or not."""
    names, packed, broken, end, inner, place = ["base64"], False, False, len(data), data, at
    while (more := _inflate(inner, place, most)) is not None and more[0] != inner:
        if not packed:
            end = more[1]
        inner, place, packed, broken, most = more[0], 0, True, broken or more[2], most - len(more[0])
        names.append("compressed")
        if most <= 0:
            break
    if at and not packed:
        return None
    text = _readable(inner, packed and (broken or most <= 0))
    return None if text is None else _Part(text, at, end, packed, "+".join(names), broken)


def _parts(body: str, most: int) -> tuple[list[tuple[int, _Part]], bool]:
    """Texts in a base64 run with the alignments they have, and whether one of them is the whole run.

    A run that isn't one layer from its first character is decoded in all four alignments, and compressed data and
    readable stretches are looked for inside, so what is glued to it doesn't matter.
    """
    body = body.replace("-", "+").replace("_", "/")
    found: list[tuple[int, _Part]] = []
    for shift in range(4):
        own = body[shift:]
        own = own[:-1] if len(own) % 4 == 1 else own
        data = base64.b64decode(own + "=" * (-len(own) % 4))
        if not shift and (part := _unpacked(data, 0, most)) and not part.broken and part.end == len(data):
            return [(0, part)], True
        taken = 0
        for m in _MAGIC.finditer(data):
            # What breaks off before the shortest secret is chance.
            if m.start() >= taken and (part := _unpacked(data, m.start(), most)) and part.packed and (not part.broken or len(part.text) >= 12):
                found.append((shift, part))
                taken = part.end
        for m in _STRETCH.finditer(data):
            found.append((shift, _Part(m[0].decode(), m.start(), m.end(), False, "base64", False)))
    return found, False


Below = tuple[str, Up, str, bool, tuple[int, int] | None]


def _run_layers(text: str, pieces: list[tuple[int, int]], finish: int, most: int) -> tuple[list[Below], bool]:
    """Layers of the base64 run that lies in ``pieces`` of the text and ends, with its padding, at ``finish``."""
    body = "".join(text[a:b] for a, b in pieces)
    firsts, size = [], 0
    for a, b in pieces:
        firsts.append(size)
        size += b - a
    found, whole = _parts(body, most)

    def place(low: int, high: int) -> tuple[int, int]:
        k, last = bisect_right(firsts, low) - 1, bisect_right(firsts, high - 1) - 1
        return pieces[k][0] + low - firsts[k], finish if high >= size else pieces[last][0] + high - firsts[last]

    def above(shift: int, part: _Part) -> Up:
        def up(start: int, end: int) -> tuple[int, int]:
            low, high = part.begin, part.end
            if not part.packed:
                low, high = low + len(part.text[:start].encode()), low + len(part.text[:end].encode())
            return place(shift + low * 4 // 3, min(size, shift - (-high * 4 // 3)))

        return up

    run = pieces[0][0], finish
    return [(p.text, above(shift, p), p.name, p.broken, run) for shift, p in found], whole


def _layers(text: str, most: int) -> Iterator[Below]:
    """Texts that lie one step below, how their spans lie in ``text``, the step's name, if data was broken off, and the
    base64 run that they lie in."""
    if "%" in text and (found := _replaced(text, _PERCENT, _percent)):
        yield *found, "url", False, None
    if ("\\" in text or "&#" in text) and (found := _replaced(text, _ESCAPE, _escape)):
        yield *found, "unicode", False, None
    if _long_word(text, _LONG):
        done = []  # wrapped runs, and whether each is one layer or has compressed data
        for m in _WRAPPED.finditer(text) if "\n" in text else ():
            layers, whole = _run_layers(text, [x.span() for x in _LINE.finditer(text, *m.span())], m.end(), most)
            yield from layers
            done.append((*m.span(), whole, any("compressed" in x[2] for x in layers)))
        starts = [x[0] for x in done]
        for m in _BASE64.finditer(text):
            k = bisect_right(starts, m.start()) - 1
            inside = k >= 0 and m.start() < done[k][1]
            if inside and done[k][2]:
                continue
            layers, _ = _run_layers(text, [(m.start(), m.start() + len(m[0].rstrip("=")))], m.end(), most)
            # The first lines of wrapped compressed data are not a layer that breaks off.
            yield from (x for x in layers if not (x[3] and inside and done[k][3]))


class _Layer:
    """A layer whose inner layers are being unwrapped; ``found`` has the spans of it and of all below, as they lie in it."""

    __slots__ = ("text", "digest", "up", "name", "inner", "found", "lowest")

    def __init__(self, text: str, most: int, digest: bytes, up: Up | None, name: str, height: int):
        self.text, self.digest, self.up, self.name = text, digest, up, name
        self.inner = _layers(text, most)
        self.found = {(k, a, b): Span(k, a, b, 0, "") for k, a, b in matches(text)}
        #: Height of the lowest ancestor that lies in this layer again; what is found then depends on the way here.
        self.lowest = height

    def lift(self, found: dict[tuple[str, int, int], Span], up: Up, name: str) -> None:
        """Add the spans of a layer that lies in this one; of equal spans the one in fewer layers stays."""
        for s in found.values():
            if place := up(s.start, s.end):
                key = (s.kind, *place)
                if key not in self.found or self.found[key].depth > s.depth + 1:
                    self.found[key] = Span(*key, s.depth + 1, f"{name}/{s.path}".strip("/"))


def _digest(text: str) -> bytes:
    return hashlib.sha1(text.encode("utf-8", "surrogatepass")).digest()


def scan(text: str, most: int = DECODED_CHARS) -> tuple[list[Span], bool]:
    """All spans, sorted by start, kind and end, those of the text itself at depth 0; whether something may be missing.

    That is so if ``most`` decoded characters were reached or compressed data breaks off.
    """
    found, cut = scan_all(text, most)
    return [s for s in found if s.kind != CUT], cut


def scan_all(text: str, most: int = DECODED_CHARS) -> tuple[list[Span], bool]:
    """Like ``scan``, with a span of kind ``CUT`` for every run that was not decoded to its end.

    A content is unwrapped once; its spans are mapped up from every place where it lies. Only a layer that repeats
    an ancestor is left alone.
    """
    root = _Layer(text, most, _digest(text), None, "", 0)
    open_layers, heights = [root], {root.digest: 0}
    known: dict[bytes, dict[tuple[str, int, int], Span]] = {}
    left, cut = most, False
    while True:
        layer = open_layers[-1]
        found = None if left <= 0 else next(layer.inner, None)
        if found is None:
            open_layers.pop()
            if left <= 0:
                # Some of its runs were not reached any more.
                layer.found |= {(CUT, *m.span()): Span(CUT, *m.span(), 0, "") for m in _BASE64.finditer(layer.text)}
            if not open_layers:
                return sorted_spans(root.found), cut or left <= 0
            height = heights.pop(layer.digest)
            if layer.lowest >= height:
                known[layer.digest] = layer.found
            else:
                open_layers[-1].lowest = min(open_layers[-1].lowest, layer.lowest)
            open_layers[-1].lift(layer.found, layer.up, layer.name)
            continue
        new, up, name, broken, run = found
        left -= len(new)
        cut = cut or broken
        if run and (broken or left <= 0):
            layer.found[CUT, *run] = Span(CUT, *run, 0, "")
        digest = _digest(new)
        if digest in known:
            layer.lift(known[digest], up, name)
        elif digest in heights:
            layer.lowest = min(layer.lowest, heights[digest])
        else:
            heights[digest] = len(open_layers)
            open_layers.append(_Layer(new, left, digest, up, name, len(open_layers)))


def sorted_spans(found: dict[tuple[str, int, int], Span]) -> list[Span]:
    return sorted(found.values(), key=lambda s: (s.start, (*KINDS, CUT).index(s.kind), s.end))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("depth", pa.int32()), ("path", pa.string())]))
SPANS = "array<struct<kind string, start long, end long, depth int, path string>>"


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = DECODED_CHARS) -> DataFrame:
    """``doc_id, spans, cut`` of every row; a null or empty text has no spans.

    Positions are code points of the original text, ends exclusive; ``depth`` counts the layers around the secret
    (0: plain) and ``path`` names them, outermost first. ``cut`` tells that ``most`` decoded characters were
    reached, so deeper layers were left alone, or that compressed data breaks off and was read up to there. Repeated rows each give a row; there is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part, texts in sliced(whole):
                found = [scan(t, most) for t in texts]
                spans = pa.array([[s._asdict() for s in x] for x, _ in found], _SPANS)
                yield pa.RecordBatch.from_arrays([part.column(0), spans, pa.array([c for _, c in found], pa.bool_())], names=["doc_id", "spans", "cut"])

    source = keyed_text(docs, key, text)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, spans {SPANS}, cut boolean")


def masked(text: str, mask: str = "[SECRET]", most: int = DECODED_CHARS) -> str:
    """The text with every secret, plain or encoded, replaced; overlapping spans become one mask.

    An encoded run that was not decoded to its end may hold secrets nobody has seen, so it is replaced as a whole.
    """
    parts, at = [], 0
    end = None
    for span in scan_all(text, most)[0]:
        if end is not None and span.start < end:
            end = max(end, span.end)
            continue
        if end is not None:
            at = end
        parts += [text[at : span.start], mask]
        end = span.end
    return text if end is None else "".join(parts) + text[end:]


def mask_documents(docs: DataFrame, text: str = "text", size: str | None = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets masked in ``text`` and ``size``, if there is such a column, set to the new length.

    Null texts stay null; all other columns pass through. Texts of any length are read whole; a run of one that decodes
    to more than ``DECODED_CHARS`` characters, or breaks off, is masked whole, so nothing unseen stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = whole.schema.get_field_index(text)
            column = whole.column(at)
            new = pa.array([None if x.as_py() is None else masked(x.as_py(), mask) for x in column], column.type)
            yield whole.set_column(at, whole.schema.field(at), new)

    out = docs.mapInArrow(run, docs.schema)
    if size and size in docs.columns:
        out = out.withColumn(size, F.length(text).cast(docs.schema[size].dataType))
    return out


def listing(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

"""Byte-level BPE encoding and decoding with batched numpy merge rounds.

A text falls into pieces before each single space; only pieces not seen before in the task are encoded,
all those of a batch together: their symbols lie in one flat array, every round looks the keys of adjacent
pairs up in the sorted merge keys by binary search and applies each word's lowest-ranked pair, until no
word has a pair left. Long words would need about as many rounds as they have symbols; theirs are linked
lists in the same flat array, and a round takes up the places of the lowest rank alone, so that the time
follows their length.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from waybill.llm.common import keyed_text, texts_of, tokenizer_path

#: Bytes of the per-task piece cache, with what Python needs for an entry; a full cache starts anew.
CACHE_BYTES, ENTRY_BYTES = 100_000_000, 220
#: Words of more bytes are merged rank by rank.
LONG_WORD = 128
#: Unicode White_Space, as the tokenizer's pattern understands \s.
_SPACE = r"\t-\r \x85\xa0  -     　"
#: The pre-token pattern of byte-level BPE.
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_UNEVEN = re.compile(rf" [{_SPACE}]")
_MARKS = (".", ",", "!", "?", ";", ":")
_NONE = np.iinfo(np.int32).max


def byte_alphabet() -> dict[str, int]:
    """Character of the vocabulary file -> byte: printable Latin-1 stands for itself, the rest follows from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Vocabulary, merges and added tokens of one tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, at in vocab.items():
            if all(c in alphabet for c in token):
                self.bytes_of[at] = bytes(alphabet[c] for c in token)
        for token, at in added.items():
            self.bytes_of[at] = token.encode()
        self.byte_id = np.zeros(256, np.int64)
        for char, byte in alphabet.items():
            self.byte_id[byte] = vocab[char]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.pattern = regex.compile(_PATTERN)
        self.special = re.compile("|".join(re.escape(x) for x in sorted(added, key=len, reverse=True))) if added else None
        self.marks = {text: np.int32(at).tobytes() for text, at in added.items()}
        #: Ids of pieces that follow a space (without it), and of pieces as they stand.
        self.spaced: dict[str, bytes] = {}
        self.plain: dict[str, bytes] = {}
        self.held = 0

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, the largest number if it has none."""
        pair = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where(self.keys[at] == pair, self.ranks[at], _NONE)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word (not empty) as little-endian 32-bit numbers."""
        long = [k for k, w in enumerate(words) if len(w) > LONG_WORD]
        if not long:
            return self.merge_short(words)
        ids: list[bytes] = [b""] * len(words)
        for k, found in zip(long, self.merge_long([words[k] for k in long]), strict=True):
            ids[k] = found
        short = [k for k, w in enumerate(words) if len(w) <= LONG_WORD]
        if short:
            for k, found in zip(short, self.merge_short([words[k] for k in short]), strict=True):
                ids[k] = found
        return ids

    def merge_long(self, words: list[bytes]) -> list[bytes]:
        """As ``merge_short``: a merge looks up its two new pairs only, and places wait under their ranks."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        symbols = np.append(self.byte_id[np.frombuffer(b"".join(words), np.uint8)], 0)
        n = len(symbols) - 1
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1], before[ends - sizes] = n, n  # the place n stands for a word's border
        before = np.append(before, n)
        rank = np.full(n + 1, _NONE, np.int32)
        waiting: dict[int, array] = {}
        lowest: list[int] = []

        def look_up(places: np.ndarray) -> None:
            right = after[places]
            rank[places] = np.where(right < n, self.pair_ranks(symbols[places], symbols[right]), _NONE)
            places = places[rank[places] != _NONE]
            places = places[np.argsort(rank[places], kind="stable")]
            own = rank[places]
            begins = np.flatnonzero(np.append(len(own) > 0, own[1:] != own[:-1])).tolist()
            for a, b in zip(begins, [*begins[1:], len(own)]):
                r = int(own[a])
                if r not in waiting:
                    waiting[r] = array("q")
                    heapq.heappush(lowest, r)
                waiting[r].frombytes(places[a:b].tobytes())

        look_up(np.arange(n))
        while lowest:
            r = heapq.heappop(lowest)
            spots = np.unique(np.frombuffer(waiting.pop(r), np.int64))
            spots = spots[rank[spots] == r]
            if not len(spots):
                continue
            spots = _every_second(spots, after[spots[:-1]] == spots[1:])
            gone = after[spots]
            symbols[spots], rank[gone] = self.merged[r], _NONE
            after[spots] = after[gone]
            before[after[spots]] = spots
            left = before[spots]
            look_up(np.unique(np.concatenate([spots, left[left < n]])))
            before[n] = n
            before[gone] = -1
        alive = before[:n] >= 0
        flat = symbols[:n][alive].astype(np.int32).tobytes()
        stops = (4 * np.cumsum(alive)[ends - 1]).tolist()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """The ids of words, all merged together; every round applies the lowest-ranked pair of each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        ended_words, ended_symbols = [], []
        while len(symbols):
            first = np.empty(len(word), bool)
            first[0] = True
            np.not_equal(word[1:], word[:-1], out=first[1:])
            starts = np.flatnonzero(first)
            rank = np.full(len(symbols), _NONE, np.int32)
            inner = np.flatnonzero(~first[1:])  # positions with a right neighbour in the word
            rank[inner] = self.pair_ranks(symbols[inner], symbols[inner + 1])
            lowest = np.minimum.reduceat(rank, starts)
            of = np.cumsum(first) - 1
            over = (lowest == _NONE)[of]
            hit = (rank == lowest[of]) & ~over
            spots = np.flatnonzero(hit)
            spots = _every_second(spots, np.diff(spots) == 1)
            symbols[spots] = self.merged[rank[spots]]
            ended_words.append(word[over])
            ended_symbols.append(symbols[over].astype(np.int32))
            over[spots + 1] = True
            symbols, word = symbols[~over], word[~over]
        word = np.concatenate(ended_words)
        flat = np.concatenate(ended_symbols)[np.argsort(word, kind="stable")].tobytes()
        ends = np.cumsum(np.bincount(word, minlength=len(words)) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def words(self, piece: str) -> list[str]:
        """The pre-tokens of a piece; the usual ones, letters and a last mark, without the pattern."""
        head = piece[1:] if piece[0] == " " else piece
        if head.isalpha():
            return [piece]
        if head[-1:] in _MARKS and head[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return self.pattern.findall(piece)

    def learn(self, pieces: set[str], known: dict[str, bytes], before: str) -> None:
        """Encode new pieces, each after ``before``, in one batch and keep their ids."""
        cut = {piece: self.words(before + piece) for piece in pieces.difference(known)}
        words = list(set().union(*cut.values()))
        ids = dict(zip(words, self.merge([w.encode() for w in words]), strict=True)) if words else {}
        for piece, parts in cut.items():
            known[piece] = ids[parts[0]] if len(parts) == 1 else b"".join([ids[w] for w in parts])
            self.held += ENTRY_BYTES + len(piece) + len(known[piece])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        plans, spaced, plain = [], set(), set()
        for text in texts:
            plan, at = [], 0
            for found in self.special.finditer(text) if self.special else ():
                plan += [*self._cut(text[at : found.start()]), (self.marks, [found[0]])]
                at = found.end()
            plan += self._cut(text[at:])
            for known, pieces in plan:
                if known is not self.marks:
                    (spaced if known is self.spaced else plain).update(pieces)
            plans.append(plan)
        if self.held > CACHE_BYTES:
            self.spaced.clear()
            self.plain.clear()
            self.held = 0
        self.learn(spaced, self.spaced, " ")
        self.learn(plain, self.plain, "")
        return [b"".join([x for known, pieces in plan for x in map(known.__getitem__, pieces)]) for plan in plans]

    def _cut(self, text: str) -> list[tuple[dict[str, bytes], list[str]]]:
        """Pieces that are encoded on their own, with the cache they belong to: after a space, or as they stand."""
        if not text:
            return []
        if text[-1] == " " or _UNEVEN.search(text):  # white space in a row: only the full pattern knows where it ends
            return [(self.plain, self.pattern.findall(text))]
        first, *rest = text.split(" ")
        return [(self.plain, [first]), (self.spaced, rest)] if first else [(self.spaced, rest)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _every_second(spots: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Of a run of hits that overlap ("aaaa") every second one, from the left; ``joined``: a hit and the next overlap."""
    if not joined.any():
        return spots
    at = np.arange(len(spots))
    run = np.maximum.accumulate(np.where(np.append(True, ~joined), at, 0))
    return spots[(at - run) % 2 == 0]


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of every row; a null text is the empty one and has no ids.

    ``path`` names a byte-level BPE tokenizer file, read on the executors. Added tokens in a text get their own id.
    Repeated rows each give a row; no shuffle, memory of a task is a batch and the piece cache (``CACHE_BYTES``).
    """
    place = path or tokenizer_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(place)
            for part, texts in sliced(batch):
                blobs = codec.encode_batch(texts)
                offsets = np.zeros(len(blobs) + 1, np.int32)
                np.cumsum([len(b) // 4 for b in blobs], out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(blobs), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    source = keyed_text(docs, key, text)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``text``: the bytes of the ids, malformed UTF-8 as U+FFFD; null ids give null."""
    place = path or tokenizer_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(place)
            ids = batch.column(1)
            ends, flat = ids.offsets.to_numpy().tolist(), ids.values.to_numpy()
            texts = [codec.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:], strict=False)]
            column = pa.array(texts, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, column], names=["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def sliced(batch: pa.RecordBatch, chars: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in slices of about so many characters, with their texts."""
    texts, begin, size = [], 0, 0
    for at, text in enumerate(texts_of(batch)):
        texts.append(text)
        size += len(text)
        if size >= chars:
            yield batch.slice(begin, at + 1 - begin), texts
            texts, begin, size = [], at + 1, 0
    if texts:
        yield batch.slice(begin), texts

"""Packing along a space-filling curve: neighbouring documents share sequences of a fixed length.

Token counts of a document are hashed into features and projected to a few dimensions by a fixed random
matrix; the point's place on a Hilbert curve is the sort key. Documents are dealt out by ranges of that key,
sorted, laid end to end and cut at every full sequence. What is left at the end of a range becomes sequences
of power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.bpe import sliced
from waybill.llm.common import keyed_text, tokenizer_path
from waybill.session import materialize

#: Dimensions and bits of each: 60 bits of curve in a long.
DIMENSIONS, BITS = 4, 15
#: Hashed features of a document vector.
FEATURES = 1024
#: Entries of the per-task cache of encoded words, about 200 bytes each; a full cache starts anew.
CACHE_WORDS = 1_000_000
#: Words that go to the library as one text: it takes longer for each in short ones and in long ones.
JOINED_WORDS = 50
#: Sequences from here on are numbered from range number << SEQUENCE_BITS.
SEQUENCE_BITS = 40


class WordIds:
    """Token ids of texts by the tokenizers library, which sees every distinct word of a task once.

    The tokenizer lowers case, drops white space and splits at it and between letters and marks, so a text's ids are
    those of its words in a row. New words of letters go to the library as one text, in which every word ends with
    a token that ends a word.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[at for token, at in vocabulary.items() if token.endswith("</w>")]] = True
        self.end = np.uint32(end).tobytes()
        self.known: dict[bytes, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end id, as little-endian unsigned 32-bit numbers."""
        split = [self.words(text.encode()) for text in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        self.learn(set().union(*split).difference(self.known))
        return [b"".join(map(self.known.__getitem__, words)) + self.end for words in split]

    @staticmethod
    def words(text: bytes) -> list[bytes]:
        # Added tokens (<|..|>) are told apart by case.
        return (text if b"<|" in text else text.lower()).split()

    def learn(self, new: set[bytes]) -> None:
        known, joined, letters, others = self.known, {}, set(), set()
        for word in new:
            text = word.decode().lower()
            if text.isalpha():
                letters.add(word)
            elif text[-1] in ".,;:!?" and text[:-1].isalpha():
                joined[word] = word[:-1], word[-1:]
            else:
                others.add(word)
        for body, mark in joined.values():
            if body not in known:
                letters.add(body)
            if mark not in known:
                others.add(mark)
        batch = list(letters)
        parts = [batch[begin : begin + JOINED_WORDS] for begin in range(0, len(batch), JOINED_WORDS)]
        coded = self.tokenizer.encode_batch_fast([b" ".join(part).decode() for part in parts], add_special_tokens=False)
        for part, found in zip(parts, coded, strict=True):
            ids = np.array(found.ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):  # a letter whose lower case has marks is more than one word to the tokenizer
                others.update(part)
                continue
            flat, cuts = ids.tobytes(), (4 * cuts).tolist()
            known.update(zip(part, [flat[a:b] for a, b in zip([0, *cuts], cuts)], strict=True))
        alone = list(others)
        for word, found in zip(alone, self.tokenizer.encode_batch_fast([w.decode() for w in alone], add_special_tokens=False), strict=True):
            known[word] = np.array(found.ids, np.uint32).tobytes()
        for word, (body, mark) in joined.items():
            known[word] = known[body] + known[mark]


def projection(features: int = FEATURES, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The fixed random matrix."""
    return np.random.default_rng(20).standard_normal((features, dimensions))


def points(ids: list[np.ndarray], matrix: np.ndarray) -> np.ndarray:
    """Grid points of documents: hashed log counts, scaled to unit length, projected; each axis evened out."""
    rows = np.zeros((len(ids), len(matrix)))
    for row, own in zip(rows, ids, strict=True):
        bucket = (own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 10)
        row[:] = np.bincount((bucket % np.uint64(len(matrix))).astype(np.int64), minlength=len(matrix))
    np.log1p(rows, out=rows)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    flat = rows @ matrix
    # A logistic curve near the normal distribution function: about even use of every axis.
    even = 1 / (1 + np.exp(-1.702 * flat))
    return np.clip((even * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)


def hilbert(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each grid point (rows) on the Hilbert curve, as a long."""
    axes = [grid[:, k].astype(np.int64) for k in range(grid.shape[1])]
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for k in range(len(axes)):
            upper = (axes[k] & level) != 0
            swap = np.where(upper, 0, (axes[0] ^ axes[k]) & low)
            axes[0] = np.where(upper, axes[0] ^ low, axes[0] ^ swap)
            if k:
                axes[k] = axes[k] ^ swap
        level >>= 1
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    turn = np.zeros_like(axes[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where(axes[-1] & level, turn ^ (level - 1), turn)
        level >>= 1
    axes = [a ^ turn for a in axes]
    key = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for a in axes:
            key = (key << 1) | ((a >> bit) & 1)
    return key


def curve_keys(docs: DataFrame, path: str | None = None, end: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, curve long, ids binary`` of every row: its curve place and ids (little-endian 16-bit) with ``end``.

    A null text is the empty one. The vocabulary must have at most 65,536 ids.
    """
    place = path or tokenizer_path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = matrix = None
        for batch in batches:
            if encode is None:
                encode, matrix = WordIds(place, end), projection()
            for part, texts in sliced(batch):
                ids = [np.frombuffer(b, np.uint32) for b in encode(texts)]
                curve = hilbert(points(ids, matrix))
                blobs = pa.array([x.astype("<u2").tobytes() for x in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(curve), blobs], names=["doc_id", "curve", "ids"])

    source = keyed_text(docs, key, text)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, curve long, ids binary")


def lay_out(sizes: list[int], at: int, length: int) -> Iterator[tuple[int, int, int]]:
    """For documents laid end to end from place ``at``: (document, its start, piece length) at every cut."""
    for doc, size in enumerate(sizes):
        start = 0
        while start < size:
            room = min(size - start, length - at % length)
            yield doc, start, room
            start += room
            at += room


def powers(size: int) -> list[int]:
    """``size`` as powers of two, largest first: the lengths at which a short sequence needs no padding."""
    return [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]


def pack(docs: DataFrame, length: int = 4096, path: str | None = None, end: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut all documents into sequences of ``length`` tokens; a row for each piece.

    ``doc_id, start, length, doc_tokens, sequence_id, offset`` (longs) and ``ids binary``, the piece's ids as
    little-endian 32-bit numbers. Every document has at least the end id and so a piece; repeated rows are
    packed as documents of their own. Documents of one curve place (a hot group of copies) are spread by a hash
    of the key. The ids are written to the shared folder once, so dealing them out by range reads the keys only.
    """
    coded = materialize(curve_keys(docs, path, end, key, text), "curve")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("doc_id")
    dealt = (
        coded.withColumn("tie", tie)
        .repartitionByRange(parts, "curve", "tie")
        .sortWithinPartitions("curve", "tie", "doc_id")
    )

    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << SEQUENCE_BITS
        at, rows, kind = 0, [], None
        for batch in batches:
            kind = batch.schema.field(0).type
            docs, blobs = batch.column(0).to_pylist(), [x.as_py() for x in batch.column(1)]
            for doc, start, size in lay_out([len(b) // 2 for b in blobs], at, length):
                ids = blobs[doc][2 * start : 2 * (start + size)]
                rows.append((docs[doc], start, size, len(blobs[doc]) // 2, first + at // length, at % length, ids))
                at += size
                if at % length == 0 and len(rows) >= 2000:
                    yield pieces(rows, kind)
                    rows = []
        tail = [r for r in rows if r[4] == first + at // length]
        if done := rows[: len(rows) - len(tail)]:
            yield pieces(done, kind)
        if tail:
            yield pieces(list(recut(tail)), kind)

    def recut(tail: list[tuple]) -> Iterator[tuple]:
        """The last, short sequence as several ones of power-of-two lengths."""
        number = tail[0][4]
        ends = iter(np.cumsum(powers(sum(r[2] for r in tail))).tolist())
        begin, end_at, at = 0, next(ends), 0
        for doc, start, size, total, _, _, ids in tail:
            done = 0
            while done < size:
                room = min(size - done, end_at - at)
                yield doc, start + done, room, total, number, at - begin, ids[2 * done : 2 * (done + room)]
                done += room
                at += room
                if at == end_at:
                    begin, end_at, number = at, next(ends, at), number + 1

    def pieces(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        docs, *longs, ids = zip(*rows, strict=True)
        wide = pa.array([np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in ids], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(docs, kind), *[pa.array(x, pa.int64()) for x in longs], wide], names=names)

    kind = coded.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return dealt.select("doc_id", "ids").mapInArrow(run, schema)

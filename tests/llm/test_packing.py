import itertools
from collections import defaultdict

import numpy as np

from tests.llm.conftest import ODD
from waybill.llm import packing
from waybill.llm.common import tokenizer_path


def test_hilbert_steps_to_neighbours():
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
        keys = packing.hilbert(grid, bits)
        order = np.argsort(keys)
        assert sorted(keys) == list(range(len(keys)))
        assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()


def test_every_token_in_one_place(odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = packing.pack(odd, length=64).collect()
    want = sorted([*library.encode(t or "", add_special_tokens=False).ids, 2] for _, t, *_ in ODD if t is None or len(t) < 1000)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.doc_tokens].append((r.start, ids))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 64 or at & (at - 1) == 0
    short = []
    for (_, tokens), own in pieces.items():
        copies = sum(len(x) for _, x in own) // tokens
        assert sum(len(x) for _, x in own) == copies * tokens
        if tokens < 1000 and copies == 1:
            short.append([x for _, part in sorted(own) for x in part])
    assert all(x in want for x in short) and len(short) >= 7


def test_neighbours_share_sequences():
    ids = [np.array(x) for x in ([5] * 50, [5] * 49 + [6], [900] * 50, [901, 900] * 25)]
    keys = packing.hilbert(packing.points(ids, packing.projection()))
    assert abs(int(keys[0]) - int(keys[1])) < abs(int(keys[0]) - int(keys[2]))


def test_no_rows(none):
    assert packing.pack(none).collect() == []

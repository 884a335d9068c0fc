"""Ids of texts from remembered chunks: right whatever came before, and memory as counted."""

from __future__ import annotations

import random
import sys

import numpy as np
import public_tokenizers

PATH = "word_bpe_49k.json"


def _texts(n: int) -> list[str]:
    r = random.Random(8)
    parts = ["the", "ión", "ÄU", "sch", "Ñe", "on", "é", "th", "ou", "ß", "Ring"]
    ends = ["", "", ".", ",", "!!", "###", "'s", "-x", "12", "<|endoftext|>", "İ", "Ã©", "日本", "ſ"]
    out = []
    for _ in range(n):
        words = ["".join(r.choice(parts) for _ in range(r.randint(1, 4))) + r.choice(ends) for _ in range(r.randint(0, 40))]
        out.append(r.choice((" ", "  ", "\n")).join(words))
    return [*out, "", " ", "\n\n", "É é Ã© Ã‰ É. é. THE the The the, THE,"]


def test_ids_follow_the_library(monkeypatch):
    from tokenizers import Tokenizer

    from docloom.llm import idfiles

    library = Tokenizer.from_file(public_tokenizers.path(PATH))
    texts = _texts(400)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for bound in (idfiles.CACHE_BYTES, 20_000):  # the smaller one forgets now and then
        monkeypatch.setattr(idfiles, "CACHE_BYTES", bound)
        coder = idfiles.ChunkIds(public_tokenizers.path(PATH))
        for text, ids in zip(texts, want):
            assert [i for piece in coder.ids(text) for i in piece.tolist()] == ids, text


def test_memory_as_counted():
    """What is remembered takes about as much as is counted, so the bound is used and kept."""
    from docloom.llm import idfiles

    coder = idfiles.ChunkIds(public_tokenizers.path(PATH))
    for text in _texts(3000):
        for _ in coder.ids(text):
            pass
    held: dict[int, object] = {}
    for memory in (m for m in vars(coder).values() if isinstance(m, dict)):
        held[id(memory)] = memory
        for pair in memory.items():
            held.update((id(x), x) for x in pair)
    taken = sum(map(sys.getsizeof, held.values()))
    assert 0.7 * taken <= coder.size <= 1.4 * taken


def test_widths():
    from docloom.llm.idfiles import widths_of

    for top in (16, 17, 60, 63):
        ids = [0, 1, 2, 3, 255, 256, (1 << 16) - 1, (1 << top) - 1]
        assert widths_of(np.array(ids, np.uint64)).tolist() == [min(i.bit_length(), 61) for i in ids]
    assert widths_of(np.zeros((0, 4), np.uint64)).shape == (0, 4)

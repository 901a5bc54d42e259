from __future__ import annotations

import array
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickgauge.llm import packing
from clickgauge.llm.tokens import WordTokens

PATH = packing.tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return array.array("I", [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]).tobytes()


def test_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(2)
    bits = ["It's", "DON'T", "héllo", "É", "İstanbul", "ΣΑΣ", "a.b,c!!", "12345", "ß", " ", "\x85", "\x1f", " ", "\n\t", "中文", "é", "<|endoftext|>", "x" * 70,
            "'s't", "_|_", "​", "Ǆ", "“q”", "º", "½"]
    words = WordTokens(PATH)
    for _ in range(400):
        text = "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 12)))
        assert words.ids(text) == array.array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes(), text


def test_every_id_lies_in_one_piece(docs, corpus, tokenizer):
    rows = packing.pack(docs, PATH).collect()
    want = Counter()
    for d, t, *_ in corpus:
        want[(d, len(ids_of(tokenizer, t)) // 4)] += 1
    covered, sequences = Counter(), defaultdict(list)
    texts = defaultdict(set)
    for d, t, *_ in corpus:
        texts[d].add(ids_of(tokenizer, t))
    for r in rows:
        covered[(r["doc_id"], r["doc_tokens"])] += r["length"]
        s, e = 4 * r["start"], 4 * (r["start"] + r["length"])
        assert any(zlib.crc32(x[s:e]) == r["ids_crc32"] for x in texts[r["doc_id"]] if len(x) // 4 == r["doc_tokens"])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert covered == Counter({k: k[1] * n for k, n in want.items()})
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY and (at == packing.CAPACITY or at & (at - 1) == 0)  # no padding


@pytest.mark.parametrize("limits", [(4096, 128, 4096), (4096, 3, 4096), (64, 4, 40), (16, 1, 16)])
def test_limits_hold(limits):
    rng = np.random.default_rng(4)
    sizes = [int(x) for x in rng.integers(1, 900, 150)] + [1] * 60 + [20_000]
    seen = [0] * len(sizes)
    for held in packing.pack_texts(sizes, limits):
        total = sum(p[2] for p in held)
        assert len(held) <= limits[1] and total <= limits[0] and sum(packing.text_loss(p[2]) for p in held) <= limits[2]
        for item, _, length in held:
            seen[item] += length
    assert seen == sizes


def test_whole_examples():
    rng = np.random.default_rng(5)
    demand = np.stack([rng.integers(1, 3000, 200), np.ones(200, int), rng.integers(0, 900, 200)], axis=1)
    out = packing.pack_whole(demand, (4096, 8, 2048))
    assert sorted(i for held in out for i in held) == list(range(200))
    assert all((demand[held].sum(axis=0) <= (4096, 8, 2048)).all() for held in out)
    assert len(out) <= 1.15 * max(demand[:, 0].sum() / 4096, demand[:, 2].sum() / 2048) + 1


def test_empty(empty):
    assert packing.pack(empty, PATH).count() == 0


def test_word_cache_is_bounded(monkeypatch):
    """However many words a text has and however long they are, a worker keeps a bounded number of short ones; ids stay the same."""
    from clickgauge.llm import tokens
    assert tokens.CACHE_ENTRIES <= 200_000
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 50)
    words = tokens.WordTokens(packing.tokenizer_path())
    text = " ".join(f"word{i} naïve{i}, plain{'abcdefghij'[i % 10] * (i % 7)}" for i in range(400)) + " " + "x" * 5000 + " é" * 60
    assert words.ids(text) == words.whole(text)
    assert len(words._pieces) <= 50 and len(words._parts) <= 50
    assert max(map(len, [*words._pieces, *words._parts])) <= 40

"""Unequal texts that a polynomial of any base modulo 2^64 takes for equal (signs of a Thue-Morse kind), and hashes that always agree."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from parchment.llm import suffix_dedup, textbuf, tokens
from parchment.llm.entries import vocabulary
from tests.llm.test_operators import brute_removed

X = "tkuemqwtujqkiwhhrcteqewpnktuotampoduacsoaajxaabibabbbmbabdafaoqaaaaabbvaljbbmbgbqgbbalubbayasaxabaaa"
Y = "tkuemqwtujqkiwhhrcteqewpnktuotampoduacsobbjxbbaiabaaamabadbfboqbbbbbaavbljaamagaqgaabluaabybsbxbabbb"


def test_passages_of_one_fixed_base_hash(spark):
    rows = [(1, X), (2, Y), (3, "head " + X + X[::-1]), (4, "head " + Y + X[::-1]), (5, Y)]
    got = suffix_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_removed(rows)


def test_names_of_spans():
    rng = np.random.default_rng(2)
    buf = rng.integers(0, 3, 2000).astype(np.uint8)
    low = np.sort(rng.integers(0, 1900, 500))
    high = low + rng.integers(1, 8, 500)
    bases = suffix_dedup.drawn_bases()
    one, two = suffix_dedup.span_names(buf, low, high, bases)
    byte = [bytes(buf[a:b]) for a, b in zip(low, high, strict=True)]
    named = {}
    for t, n in zip(byte, zip(one.tolist(), two.tolist(), strict=True), strict=True):
        assert named.setdefault(t, n) == n
    assert len(set(named.values())) == len(named)
    p = int(suffix_dedup.PRIME)
    values = [sum((c + 1) * pow(b, i, p) for i, c in enumerate(byte[7])) % p for b in bases]
    assert (int(one[7]), int(two[7])) == (values[0] << 31 | values[1], values[2] << 31 | values[3])


def test_names_over_many_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    buf, bases = rng.integers(0, 256, 5000).astype(np.uint8), suffix_dedup.drawn_bases()
    low = np.arange(0, 4900, 7)
    want = suffix_dedup.span_names(buf, low, low + 100, bases)
    monkeypatch.setattr(suffix_dedup, "NAMED_BYTES", 300)
    assert np.array_equal(want, suffix_dedup.span_names(buf, low, low + 100, bases))


@pytest.mark.parametrize("blind", [False, True])
def test_ids_of_pieces_of_one_hash(monkeypatch, blind):
    """Pieces are told apart by their bytes, even if every hash agrees."""
    from tokenizers import Tokenizer

    if blind:
        monkeypatch.setattr(tokens, "mix", lambda x: np.zeros_like(x))
    rng = random.Random(4)
    texts = [X, Y, X + " " + Y, "a\0 a a\0\0", "", *("".join(rng.choice("ab\0 \né") for _ in range(rng.randrange(60))) for _ in range(300)), "x" * 15 + " " + "x" * 16 + " " + "x" * 14]
    library, own = Tokenizer.from_file(vocabulary()[0]), tokens.Encoder(*vocabulary())
    for _ in range(2):  # also when pieces are kept already
        for first, buf, off in textbuf.chunks(pa.array(texts), 700):
            ids, ends = own.encode(buf, off)
            want = library.encode_batch(texts[first : first + len(off) - 1], add_special_tokens=False)
            assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [x.ids for x in want]

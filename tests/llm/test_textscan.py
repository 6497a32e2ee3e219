import random

import numpy as np
import pyarrow as pa
import pytest

from celltide.llm import textscan
from celltide.llm.common import pieces_of
from celltide.llm.textscan import mix, range_hash, scan, window_hash, window_hashes

TEXTS = [b"", b" ", b"one", b" one two\n\ntwo\x0bOne\x85x ", "é ß é\tÉ".encode(), b"two two two", b"\n", b"x" * 3000 + b" " + b"y" * 40]


@pytest.mark.parametrize("block", [4 << 20, 16, 1])
def test_words_are_those_of_split(monkeypatch, block):
    monkeypatch.setattr(textscan, "BLOCK", block)
    for values in (pa.array(TEXTS, pa.large_binary()), pa.array([b"skip", *TEXTS, b"end"], pa.large_binary()).slice(1, len(TEXTS))):
        words = scan(values)
        data = b"".join(TEXTS)
        own = [data[a:b] for a, b in zip(words.begin, words.end)]
        assert [own[a:b] for a, b in zip(words.first[:-1], words.first[1:])] == [t.split() for t in TEXTS]
        by = {}
        for w, h in zip(own, words.hashes.tolist()):
            assert by.setdefault(w, h) == h
        assert len(set(by.values())) == len(by)


def test_fold_case():
    hashes = scan(pa.array([b"Word WORD word", "É é".encode()], pa.large_binary()), fold_case=True).hashes
    assert len(set(hashes[:3].tolist())) == 1 and hashes[3] != hashes[4]


def test_windows_stay_within_documents():
    r = random.Random(1)
    texts = [" ".join(r.choice("ab") for _ in range(r.randrange(9))).encode() for _ in range(60)]
    words = scan(pa.array(texts, pa.large_binary()))
    start, hashes = window_hashes(words, 3)
    want = [tuple(t.split()[i:i + 3]) for t in texts for i in range(len(t.split()) - 2)]
    by = {}
    for w, h in zip(want, hashes.tolist()):
        assert by.setdefault(w, h) == h
    assert len(start) == len(want) and len(set(by.values())) == len(by)


def test_range_hash_is_of_the_content():
    values = np.array([5, 6, 7, 5, 6, 7, 0], np.uint64)
    h = range_hash(values, np.array([0, 3, 0, 6, 6]), np.array([3, 6, 2, 7, 6]))
    assert h[0] == h[1] and len(set(h.tolist())) == 4


def test_pieces_cut_no_value():
    batch = pa.record_batch([pa.array([1, 2, 3, 4]), pa.array(["a" * 5, None, "b" * 50, "c"])], names=["i", "text"])
    got = [(rows.column("i").to_pylist(), values.to_pylist()) for rows, values in pieces_of(batch, "text", 10)]
    assert got == [([1, 2], [b"aaaaa", b""]), ([3], [b"b" * 50]), ([4], [b"c"])]


def thue_morse(n, letters):
    return [letters[i.bit_count() & 1] for i in range(n)]


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_thue_morse_words_and_windows_differ(n):
    one, other = "".join(thue_morse(n, "ab")).encode(), "".join(thue_morse(n, "ba")).encode()
    hashes = scan(pa.array([one, other], pa.large_binary())).hashes
    assert hashes[0] != hashes[1]
    values = mix(np.arange(1, 3, dtype=np.uint64))
    one, other = values[thue_morse(n, [0, 1])], values[thue_morse(n, [1, 0])]
    assert window_hash(one, n)[0] != window_hash(other, n)[0]
    at = np.array([0]), np.array([n])
    assert range_hash(one, *at)[0] != range_hash(other, *at)[0]


@pytest.mark.parametrize("k", [1, 2, 3, 7, 9, 20, 31])
def test_window_and_range_hash_are_of_the_content(k):
    r = np.random.default_rng(k)
    content = r.integers(0, 3, 400)
    values = mix(content.astype(np.uint64) + np.uint64(1))
    start = np.arange(len(values) - k + 1)
    for hashes in (window_hash(values, k), range_hash(values, start, start + k)):
        by = {}
        for i, h in enumerate(hashes.tolist()):
            assert by.setdefault(tuple(content[i:i + k]), h) == h
        assert len(hashes) == len(start) and len(set(by.values())) == len(by)
    assert len(window_hash(values, 401)) == 0

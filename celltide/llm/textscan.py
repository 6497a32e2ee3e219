"""Words and hashes of whole texts, vectorised over a run of documents.

A word is a maximal run of bytes other than separators of the UTF-8 text; by default those are space and
``\\t \\n \\v \\f \\r``.  A word's hash takes its bytes eight at a time through a keyed bit mixer, and words over 32 bytes
through keyed BLAKE2b.  A window's hash mixes the hashes of its halves, so neither has the algebra of a polynomial that
lets chosen texts collide.  A word's or window's hash depends on its content only, so tasks and runs agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

U = np.uint64
BLOCK = 4 << 20  # bytes to hash at a time, for the memory of one very long text
SPACES = b" \t\n\x0b\x0c\r"
#: Longest word, in bytes, that is hashed eight bytes at a time.
LANES = 32
_KEY = b"celltide word"
_LENGTH, _LEFT = U(0xD6E8FEB86659FD93), U(0x9E3779B97F4A7C15)
_LANE_KEYS = np.random.default_rng(20240229).integers(1, 1 << 64, LANES // 8, dtype=U)
#: Bits of a lane that hold the first n bytes.
_HELD = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32


def in_words(separators: bytes) -> np.ndarray:
    """For each byte, whether it belongs to a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


_IN_WORD = in_words(SPACES)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _LEFT + right)


def window_hash(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive values, by halves; one for each start that has ``k`` values."""
    out, have, power, width = None, 0, values, 1
    while len(values) >= k:
        if k & width:  # this block stands left of the smaller ones
            out = power if out is None else _join(power[:len(values) - have - width + 1], out[width:])
            have += width
        if have == k:
            return out
        power = _join(power[:-width], power[width:])
        width *= 2
    return np.zeros(0, U)


def range_hash(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[begin:end]`` for each pair; equal sequences hash alike wherever they stand.

    Two windows of the largest power of two that fits cover a range.
    """
    length = end - begin
    out = length.astype(U) * _LENGTH
    power, width = values, 1
    while len(length) and width <= length.max():
        now = np.flatnonzero((length >= width) & (length < 2 * width))
        out[now] = mix(out[now] + _join(power[begin[now]], power[end[now] - width]))
        if len(power) <= width:
            break
        power = _join(power[:-width], power[width:])
        width *= 2
    return out


def _word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``data[begin:end]`` for each word; ``data`` has eight more bytes than the words."""
    eight = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    length = end - begin
    out = mix((eight[begin] & _HELD[np.minimum(length, 8)]) ^ _LANE_KEYS[0])
    rest = np.flatnonzero(length > 8)
    for lane in range(1, LANES // 8):
        if not len(rest):
            break
        at = eight[begin[rest] + 8 * lane] & _HELD[np.minimum(length[rest] - 8 * lane, 8)]
        out[rest] = _join(out[rest], mix(at ^ _LANE_KEYS[lane]))
        rest = rest[length[rest] > 8 * lane + 8]
    out = mix(out + length.astype(U) * _LENGTH)
    for i in rest:
        out[i] = int.from_bytes(hashlib.blake2b(data[begin[i]:end[i]], digest_size=8, key=_KEY).digest(), "little")
    return out


@dataclass
class Words:
    """Words of a run of documents: byte spans, hashes, and ``first[d]:first[d + 1]`` as the words of document d.

    ``bounds[d]`` is where document d begins, in the same bytes as the spans.
    """

    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    bounds: np.ndarray

    @cached_property
    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def scan(values: pa.Array, fold_case: bool = False, inside: np.ndarray = _IN_WORD) -> Words:
    """Words of each element of a null-free large binary array; ``fold_case`` hashes A-Z as a-z.

    ``inside`` tells for each byte whether it belongs to a word (``in_words``).
    """
    n = len(values)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + n + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if n else (0, 0)
    if high == low:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U), np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64))
    data = np.frombuffer(values.buffers()[2], np.uint8)[low:high]
    bounds = offsets - low
    within = inside[data]
    starts = within.copy()
    starts[1:] &= ~within[:-1]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    starts[cuts] = within[cuts]
    ends = within.copy()
    ends[:-1] &= ~within[1:]
    ends[cuts - 1] = within[cuts - 1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    hashes = np.empty(len(begin), U)
    cuts = np.unique(np.append(np.searchsorted(begin, np.arange(0, len(data), BLOCK)), len(begin)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        low = begin[a]
        part = np.zeros(end[b - 1] - low + 8, np.uint8)
        part[:-8] = data[low:end[b - 1]]
        hashes[a:b] = _word_hashes(_FOLD[part] if fold_case else part, begin[a:b] - low, end[a:b] - low)
    first = np.searchsorted(begin, bounds).astype(np.int64)
    return Words(begin, end, hashes, first, bounds)


def window_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every window of ``k`` consecutive words within one document, in order."""
    hashes = window_hash(words.hashes, k)
    last = np.repeat(words.first[1:], np.diff(words.first))[:len(hashes)]
    start = np.flatnonzero(np.arange(len(hashes)) + k <= last)
    return start, hashes[start]


def window_digests(values: pa.Array, words: Words, start: np.ndarray, k: int, split: Callable[[bytes], list[bytes]] = bytes.split) -> np.ndarray:
    """128-bit BLAKE2b of the ``k`` words of each window, joined by a space, as ``S16``; ``start`` ascends.

    ``split`` gives the words of a text in the form that is to be compared; they are as long as the words scanned.
    """
    out, own = [], words.document[start]
    edges = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own))
    for a, b in zip(edges[:-1], edges[1:]):
        low, high = words.first[own[a]], words.first[own[a] + 1]
        text = b" ".join(split(values[int(own[a])].as_py()))
        place = np.zeros(high - low + 1, np.int64)
        np.cumsum(words.end[low:high] - words.begin[low:high] + 1, out=place[1:])
        begin, end = place[start[a:b] - low].tolist(), (place[start[a:b] - low + k] - 1).tolist()
        out += [hashlib.blake2b(text[x:y], digest_size=16).digest() for x, y in zip(begin, end)]
    return np.frombuffer(b"".join(out), "S16")

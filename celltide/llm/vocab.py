"""Encoders of the public vocabulary files, with a bounded memory of what they encoded.

Texts are cut into stretches at places that no pre-token of these vocabularies spans: before white space that follows
another character, between a letter or digit and punctuation other than an apostrophe, and after a lone line break.
So stretches can be encoded one by one.  As they repeat, each different one of a run of texts is looked up or encoded
once, and ids are put together by position.  A text that holds white space or controls outside ASCII's six is not cut.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa

OTHER_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_SPACE, _BREAK, _ALNUM, _PUNCT, _LEAD = 1, 2, 4, 8, 16
_CLASS = np.zeros(256, np.uint8)
_CLASS[32] = _SPACE
_CLASS[[9, 10, 11, 12, 13]] = _BREAK
_CLASS[[c for c in range(33, 127) if chr(c).isalnum()]] = _ALNUM
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and c != ord("'")]] = _PUNCT
_CLASS[[*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = _LEAD  # what OTHER_SPACE begins with
_LATIN_TAIL = np.zeros(256, bool)  # second byte of a two-byte Latin-1 letter after 0xC3
_LATIN_TAIL[0x80:0xC0] = True
_LATIN_TAIL[[0x97, 0xB7]] = False  # the multiplication and division signs
_PLAIN_SPACE = np.arange(256, dtype=np.uint8)
_PLAIN_SPACE[[9, 10, 11, 12, 13]] = 32


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


_holder: list = [None]


def hold_memory(owner) -> None:
    """Let ``owner`` remember; what another encoder or scanner of this worker remembered is forgotten."""
    if _holder[0] is not owner:
        if _holder[0] is not None:
            _holder[0].forget()
        _holder[0] = owner


class StretchEncoder:
    """Runs of texts (UTF-8) to ids, through a memory of at most ``most`` short stretches.

    ``words_only``: the vocabulary drops white space and ignores case, so stretches are folded alike first.
    The memory has two halves: a stretch found in the older one moves to the younger, and when that is full, it becomes
    the older one and what was not used since is forgotten.
    """

    def __init__(self, encode_all: Callable[[list[str]], list[list[int]]], words_only: bool = False, most: int = 800_000, longest: int = 64):
        self.encode_all, self.words_only, self.half, self.longest = encode_all, words_only, most // 2, longest
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def cut(self, values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, places to cut with both ends, first byte of each text) of a null-free array that holds some bytes."""
        offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
        data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        bounds = offsets - offsets[0]
        kind = _CLASS[data]
        white = (kind & (_SPACE | _BREAK)) != 0
        before, now = kind[:-1], kind[1:]
        letter = (before & _ALNUM) != 0
        letter[1:] |= _LATIN_TAIL[data[1:-1]] & (data[:-2] == 0xC3)
        here = white[1:] & ~white[:-1]
        here |= ((now & _PUNCT) != 0) & letter
        here |= ((now & _ALNUM) != 0) & ((before & _PUNCT) != 0)
        if not self.words_only:
            alone = ~white[1:] & ((before & _BREAK) != 0)
            alone[1:] &= ~white[:-2]
            here |= alone
        at = np.zeros(len(data) + 1, bool)
        at[1:-1] = here
        if (kind & _LEAD).any() and OTHER_SPACE.search(data):
            for d, value in enumerate(values):
                if OTHER_SPACE.search(value.as_buffer()):
                    at[bounds[d]:bounds[d + 1]] = False
        at[bounds] = True
        if self.words_only:
            upper = (data >= ord("A")) & (data <= ord("Z"))
            upper[:-1] &= data[1:] < 0x80  # a capital under a combining mark may compose otherwise
            data = _PLAIN_SPACE[data]
            data[upper] += 32
        return data, np.flatnonzero(at), bounds

    def __call__(self, values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text's ids begin and the last end)."""
        if not len(values) or not values.buffers()[2] or not (data_at := self.cut(values))[0].size:
            return np.zeros(0, np.uint32), np.zeros(len(values) + 1, np.int64)
        data, places, bounds = data_at
        stretches = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = stretches.dictionary_encode()
        which, different = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        found = self.look_up(different)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        first = np.concatenate(([0], np.cumsum(lengths)))
        n = lengths[which]
        total = np.concatenate(([0], np.cumsum(n)))
        ids = flat[np.repeat(first[which] - total[:-1], n) + np.arange(total[-1])]
        return ids, total[np.searchsorted(places, bounds)]

    def look_up(self, different: list[bytes]) -> list[bytes]:
        """Ids of different stretches, each as little-endian unsigned 32-bit numbers."""
        hold_memory(self)
        new = [x for x in different if x not in self.known]
        if len(self.known) + len(new) > self.half:
            self.known, self.older = {}, self.known
            new = different
        missing = []
        for x in new:
            if (ids := self.older.get(x)) is not None:
                self.known[x] = ids
            else:
                missing.append(x)
        for at in range(0, len(missing), 4096):
            part = missing[at:at + 4096]
            self.known.update((x, array("I", y).tobytes()) for x, y in zip(part, self.encode_all([x.decode("utf-8") for x in part])))
        out = list(map(self.known.__getitem__, different))
        for x in missing:
            if len(x) > self.longest:
                del self.known[x]
        return out


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = _byte_letters()


def _library(path: str, words_only: bool) -> Callable[[list[str]], list[list[int]]]:
    """Ids of stretches.  One that is a word of Latin letters is a pre-token as it is and goes straight to the library's
    model; the others go through the library's whole pipeline."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True  # their strings in a text are ordinary text
    merge = library.model.tokenize

    def encode(texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            own = text.removeprefix(" ")
            if words_only:
                text = own = own.lower()
            if own.isalpha() and max(own) < "\u0250":
                out[i] = [t.id for t in merge(text.encode().decode("latin-1").translate(_LETTERS))]
            else:
                rest.append(i)
        for i, e in zip(rest, library.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    return encode


@lru_cache(maxsize=4)
def word_encoder(path: str) -> StretchEncoder:
    """For a tokenizers file that drops white space and ignores case."""
    return StretchEncoder(_library(path, True), words_only=True, most=400_000)


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> StretchEncoder:
    """For a byte-level tokenizers file."""
    return StretchEncoder(_library(path, False))


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def rank_encoder(path: str, pattern: str) -> StretchEncoder:
    """For a file of ranks: each match of ``pattern`` is merged separately."""
    import tiktoken

    library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})
    return StretchEncoder(lambda texts: [library.encode_ordinary(t) for t in texts])


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id."""
    known = ranks(path)
    out = [b""] * (max(known.values()) + 1)
    for token, rank in known.items():
        out[rank] = token
    return out

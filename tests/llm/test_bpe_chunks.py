import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_cases import awkward, empty, prose

from celltide.llm.bpe_chunks import decode, encode_documents
from celltide.llm.vocab import ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def strange(seed, n):
    """Texts of runs that meet at chunk borders: spaces, breaks, marks, digits, letters, other white space."""
    r = random.Random(seed)
    parts = [" ", "  ", "   ", "\n", "\n\n", "\t", "\r\n", " ", " ", "\x1c", "'s", "'ll", "'", "!", "?!'", "...", "é", "straße", "word", "Word", "42", "日本", "́", "×", "🙂", "a" * 40, " " * 30]
    return ["".join(r.choice(parts) for _ in range(r.randrange(1, 300))) for _ in range(n)]


@pytest.mark.parametrize("chunk,overlap", [(16_384, 512), (60, 20), (25, 3)])
def test_ids_are_the_librarys(spark, chunk, overlap):
    docs = awkward(spark, [*prose(3, 6, 80), *strange(4, 40), "b" * 500, " " * 300, "'s" * 90])
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = encode_documents(docs, chunk=chunk, overlap=overlap, with_ids=True).collect()
    assert sorted(want, key=str) == sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=str)
    assert {decode(np.frombuffer(r.ids, "<u4")).decode() for r in got} == {r.text or "" for r in docs.collect()}


def test_empty_table(spark):
    assert encode_documents(empty(spark)).collect() == []

import zlib

import numpy as np
import public_tokenizers
from llm_cases import awkward, empty, prose
from test_bpe_chunks import strange
from tokenizers import Tokenizer

from celltide.llm.token_files import Segment, encode_segment, read_ids, segments, write_ids


def test_any_id_is_addressable():
    r = np.random.default_rng(1)
    ids = np.concatenate([r.integers(0, 1 << int(b), 700) for b in r.integers(1, 33, 12)]).astype(np.uint32)
    begins = [0, 0, 5, 8000, len(ids)]
    data = b"xx" + encode_segment(3, 4, [7, None, 8, -1], ids, begins) + b"\n" + encode_segment(3, 5, [9], ids[:0], [0, 0]) + b"\n"
    s = Segment(data, 2)
    assert [s[i] for i in range(0, len(ids), 13)] == ids[::13].tolist()
    for a, b in [(0, len(ids)), (1, 1), (511, 514), (4000, 7001), (len(ids), len(ids))]:
        assert np.array_equal(s.read(a, b), ids[a:b])
    assert s.doc_ids == [7, None, 8, -1] and list(s.begins) == begins and (s.task, s.number) == (3, 4)
    assert [x.number for x in segments(data[2:])] == [4, 5]


def test_files_hold_the_librarys_ids(spark, tmp_dir):
    docs = awkward(spark, [*prose(2, 15), *strange(9, 30)])
    write_ids(docs, f"{tmp_dir}/t", segment_ids=500)
    got = read_ids(spark, f"{tmp_dir}/t", with_ids=True).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    want, start = [], 0
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")):
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(got, key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)


def test_empty_table(spark, tmp_dir):
    write_ids(empty(spark), f"{tmp_dir}/t")
    assert read_ids(spark, f"{tmp_dir}/t").collect() == []

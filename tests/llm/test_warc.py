import base64
import gzip
import hashlib
import os
import random
import zlib

import pytest

from celltide.llm import warc
from celltide.llm.warc import Found, member, read_archives, record, salvage, write_archives

PAGES = "page_id long, url string, html string, payload string, refers_to string"


def test_round_trip(spark, tmp_dir):
    pages = [(5, "http://a/", "<p>é</p>"), (3, "http://b/\r\nX: y", "<p>é</p>"), (9, None, "other"), (1, "u", None), (2, "u", ""), (None, "u", "other"), (5, "http://a/", "<p>é</p>"), (7, "u", "z" * 100_000), (None, None, None)]
    frame = spark.createDataFrame([(*p, "clash", "clash") for p in pages], PAGES)
    write_archives(frame, f"{tmp_dir}/w")
    got = read_archives(spark, f"{tmp_dir}/w", with_payload=True).collect()
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        revisit = i is not None and first[h or ""] < i
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first[h or ""] if revisit else None))
    assert sorted(map(str, want)) == sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    assert all(r.gap is None for r in got)
    assert {r.payload.decode() for r in got if r.record_type == "response"} == {h or "" for _, _, h in pages}
    for name in os.listdir(f"{tmp_dir}/w"):
        if name.startswith("part-"):
            with gzip.open(f"{tmp_dir}/w/{name}") as whole:  # an ordinary gzip reader reads the file
                whole.read()


def test_small_payloads_are_all_responses(spark, tmp_dir):
    frame = spark.createDataFrame([(1, "u", "abc", "", ""), (2, "u", "abc", "", "")], PAGES)
    write_archives(frame, f"{tmp_dir}/w", least_bytes=4)
    assert {r.record_type for r in read_archives(spark, f"{tmp_dir}/w").collect()} == {"response"}


def test_empty_table(spark, tmp_dir):
    write_archives(spark.createDataFrame([], PAGES), f"{tmp_dir}/w")
    assert read_archives(spark, f"{tmp_dir}/w").collect() == []


RECORDS = [record(i, f"http://x/{i}", b"<p>%d WARC/1.1 \x1f\x8b\x08</p>" % i * (i + 1), None) for i in range(6)]


def found(data):
    out = list(salvage(data))
    records = [int(x.headers["warc-record-id"].strip("<>").rpartition(":")[2]) for x in out if isinstance(x, Found)]
    gaps = [x for x in out if isinstance(x, tuple)]
    # records and gaps together leave no byte unaccounted, but for empty members
    return records, gaps


@pytest.fixture(params=[8 << 20, 300, 1], ids=["whole", "window", "tiny"])
def window(request, monkeypatch):
    """How much of a member's content is held."""
    monkeypatch.setattr(warc, "WINDOW", request.param)
    monkeypatch.setattr(warc, "STEP", min(warc.STEP, max(request.param, 20)))


@pytest.mark.parametrize("pack", [member, bytes], ids=["gzip", "plain"])
def test_salvage(pack, window):
    parts = [pack(r) for r in RECORDS]
    at = [sum(map(len, parts[:i])) for i in range(7)]
    whole = b"".join(parts)
    assert found(whole) == ([0, 1, 2, 3, 4, 5], [])
    # a byte changed within the payload of record 2
    spot = at[2] + len(parts[2]) - 30
    broken = whole[:spot] + bytes([whole[spot] ^ 0x55]) + whole[spot + 1:]
    records, gaps = found(broken)
    assert records == [0, 1, 3, 4, 5] and [g[:2] for g in gaps] == [(at[2], at[3])]
    # bytes lost in record 1, so that it runs into record 2
    records, gaps = found(whole[:at[1] + 40] + whole[at[1] + 60:])
    assert records == [0, 2, 3, 4, 5] and gaps[0][0] == at[1] and len(gaps) == 1
    # junk between records, and a cut end
    records, gaps = found(parts[0] + b"junk\x1f\x8b\x08WARC/1.1\r\njunk" + b"".join(parts[1:5]) + parts[5][:-7])
    assert records == [0, 1, 2, 3, 4] and len(gaps) == 2
    assert found(b"")[0] == [] and found(b"junk")[1] == [(0, 4, found(b"junk")[1][0][2])]


def test_salvage_in_a_table(spark, tmp_dir):
    os.mkdir(f"{tmp_dir}/w")
    with open(f"{tmp_dir}/w/a.warc.gz", "wb") as out:
        out.write(member(RECORDS[0]) + b"??" + member(RECORDS[1]))
    rows = read_archives(spark, f"{tmp_dir}/w").collect()
    assert sorted(r.page_id for r in rows if r.gap is None) == [0, 1]
    (gap,) = [r for r in rows if r.gap]
    assert gap.end - gap.offset == 2


def test_salvage_inside_a_member(window):
    """Records around a damaged one in the same member, and those before a break of the stream, are found."""
    spoilt = RECORDS[2].replace(b"<p>2", b"<p>X", 1)
    packed = member(b"".join([*RECORDS[:2], spoilt, *RECORDS[3:]]))
    records, gaps = found(packed + member(RECORDS[0]))
    assert records == [0, 1, 3, 4, 5, 0] and [g[:2] for g in gaps] == [(0, len(packed))]
    many = [record(i, None, os.urandom(3000), None) for i in range(60)]
    for level in (0, 6):
        packed = member(b"".join(many), level)
        spot = len(packed) * 2 // 3
        for cut in (packed[:spot], packed[:spot] + packed[spot + 5000:]):
            records, gaps = found(cut + member(RECORDS[1]))
            kept = [x for x in records if x != 1]
            assert records[-1] == 1 and set(kept) >= {0, *range(2, 38)} and len(kept) == len(set(kept)), (level, records)
            assert gaps[0][0] == 0


def test_long_payloads_and_one_that_very_many_share(spark, tmp_dir):
    long = "".join(chr(97 + i % 26) + str(i) for i in range(400_000))
    pages = [(1, "u", long), (2, "u", long), (3, "u", long[::-1])] + [(10 + i, f"u{i}", "" if i % 3 else f"<p>{i}</p>") for i in range(600)]
    write_archives(spark.createDataFrame([(*p, "", "") for p in pages], PAGES).repartition(7), f"{tmp_dir}/w")
    got = {r.page_id: r for r in read_archives(spark, f"{tmp_dir}/w").collect()}
    assert len(got) == len(pages) and got[2].refers_to == 1 and got[2].payload_bytes == got[1].payload_bytes == len(long) and got[3].record_type == "response"
    empty = [10 + i for i in range(600) if i % 3]
    assert [i for i in empty if got[i].record_type == "response"] == empty[:1] and all(got[i].refers_to == empty[0] for i in empty[1:])


def test_windows_give_what_whole_members_give(monkeypatch):
    """Random damage to archives of large and small members: the same records, gaps and payloads with any window."""
    r = random.Random(12)
    for _ in range(60):
        records = [record(i, f"http://x/{i}", r.choice([os.urandom(r.randrange(900)), b"<p>%d</p>" % i * r.randrange(200), b""]), r.choice([None, None, 3])) for i in range(12)]
        parts, at = [], 0
        while at < len(records):
            n = r.choice([1, 1, 2, 5])
            body = b"".join(records[at:at + n])
            parts.append(member(body, r.choice([0, 6])) if r.random() < 0.8 else body)
            at += n
        data = bytearray(b"".join(parts))
        for _ in range(r.randrange(4)):
            spot = r.randrange(len(data))
            if r.random() < 0.5:
                data[spot] ^= 1 << r.randrange(8)
            else:
                del data[spot:spot + r.randrange(60)]
        outs = []
        for window, step in ((8 << 20, 16_384), (700, 64), (1, 33)):
            monkeypatch.setattr(warc, "WINDOW", window)
            monkeypatch.setattr(warc, "STEP", step)
            outs.append([x if isinstance(x, tuple) else (x.offset, x.end, x.headers, x.payload, x.digest, x.size) for x in salvage(bytes(data))])
        assert outs[0] == outs[1] == outs[2]


def test_a_member_of_many_records_is_read_in_a_window():
    """A member of 400 MB, four of it packed: what is held stays small, damaged or not."""
    import tracemalloc

    packer, parts = zlib.compressobj(1, zlib.DEFLATED, 31), []
    for i in range(100):
        parts.append(packer.compress(record(i, None, b"%d " % i * 1_500_000 if i % 10 else b"x", None)))
    packed = b"".join([*parts, packer.flush()])
    for data, n in ((packed, 100), (packed[:len(packed) // 2], 40)):
        tracemalloc.start()
        found = sum(isinstance(x, Found) for x in salvage(data, with_payload=False))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found >= n and peak < 60 << 20, (found, peak)

"""WARC archives: a writer with revisit records, and a reader that salvages what follows damage.

Files are written by Spark's text writer with raw bytes: one gzip member for each record, each followed by an empty
member, which gzip readers skip (the writer needs a separator).  The commit of the job keeps files whole when executors
are lost.  The reader verifies every member and record; after a failed check it searches for the next valid gzip member
or version line, goes on there, and logs the bytes between as a gap.

A file comes from Spark as one binary value (of at most 2 GB), which is not copied.  What a gzip member holds is not bound
by that: content over ``WINDOW`` bytes is unpacked from front to back, of which a window is held, and blocks are hashed piece
by piece.  Only a payload that is asked for is held whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm.common import staged, workers_import

VERSION, DATE = b"WARC/1.1", "1970-01-01T00:00:00Z"  # pages carry no time of capture
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP, ID = b"\x1f\x8b\x08", "urn:x-page:"
STEP = 16_384  # bytes to decompress at a time
#: Content of a member that is held whole, and length in which a header must end.
WINDOW, HEADER = 8 << 20, 1 << 20
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
PLAIN = re.compile(rb"WARC/1\.[01]\r\n")


def member(content: bytes, level: int = 6) -> bytes:
    packed = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packed.compress(content) + packed.flush()


EMPTY = member(b"")


def _base32(digest) -> str:
    return base64.b32encode(digest.digest()).decode()


def sha1(content: bytes) -> str:
    return _base32(hashlib.sha1(content))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response with the payload, or a revisit of the page ``refers_to`` with the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{ID}{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\r\n]", " ", url)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    fields += [("WARC-Payload-Digest", f"sha1:{sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


@dataclass
class Found:
    """A record that passed its checks."""

    offset: int
    end: int
    headers: dict[str, str] = field(default_factory=dict)
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    digest: str = ""
    size: int = 0  # bytes of the payload, also where it was not kept


class Damage(ValueError):
    pass


def _fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("bad header line")
        out[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
    return out


def _digest_fits(stated: str | None, digest: str) -> bool:
    return stated is None or not stated.startswith("sha1:") or stated[5:] == digest


class Bytes:
    """Bytes in memory, with the methods of ``Unpacked``."""

    def __init__(self, data: memoryview):
        self.data, self.stop, self.pin = data, len(data), 0

    def piece(self, begin: int, end: int) -> bytes:
        return bytes(self.data[begin:end])

    def find(self, pattern: re.Pattern[bytes], at: int) -> int:
        found = pattern.search(self.data, at)
        return found.start() if found else -1


class Unpacked:
    """The content of the gzip member at ``start`` of ``data``, as far as it unpacks, read from front to back.

    What was read is held from ``pin`` on as long as that is within ``WINDOW``; to go back further, unpacking starts again.
    """

    def __init__(self, data: memoryview, start: int):
        self.data, self.start, self.pin = data, start, 0
        self._open()

    def _open(self) -> None:
        self.at, self.unpack = self.start, zlib.decompressobj(31)
        self.held, self.begin, self.broken = bytearray(), 0, ""

    @property
    def stop(self) -> int:
        """Where what was unpacked so far ends."""
        return self.begin + len(self.held)

    def _more(self) -> bool:
        """Unpack some more; False at the end, and where the stream breaks off (``broken``)."""
        if self.unpack.eof or self.broken:
            return False
        saved, part = self.unpack.copy(), self.data[self.at:self.at + STEP]
        try:
            out = self.unpack.decompress(part, 64 * STEP)
        except zlib.error:
            self.broken = "gzip member is damaged"
            try:  # what a failing call unpacked is lost: byte by byte up to the damage
                for i in range(len(part)):
                    self.held += saved.decompress(part[i:i + 1])
            except zlib.error:
                pass
            return True
        self.at += len(part) - len(self.unpack.unconsumed_tail) - len(self.unpack.unused_data)
        if not out and not len(part):
            self.broken = "gzip member does not end"
        self.held += out
        return True

    def _drop(self, before: int) -> None:
        gone = max(0, min(before - self.begin, len(self.held)))
        del self.held[:gone]
        self.begin += gone

    def whole(self) -> int:
        """The size of the content; nothing is held."""
        while self._more():
            self._drop(self.stop)
        return self.stop

    def piece(self, begin: int, end: int) -> bytes:
        """What there is between ``begin`` and ``end``."""
        keep = self.pin if 0 <= begin - self.pin <= WINDOW else begin
        if begin < self.begin:
            self._open()
        while self.stop < end and self._more():
            self._drop(keep)
        self._drop(keep)
        at = begin - self.begin
        return bytes(self.held[at:at + end - begin])

    def find(self, pattern: re.Pattern[bytes], at: int) -> int:
        """Where ``pattern``, of at most 16 bytes, is found from ``at`` on; -1 if nowhere."""
        while True:
            self.pin = at
            window = self.piece(at, at + STEP)
            if found := pattern.search(window):
                return at + found.start()
            if len(window) < STEP:
                return -1
            at += STEP - 16


Source = Bytes | Unpacked


def _head(source: Source, at: int, until: int) -> tuple[list[bytes], int]:
    """(lines, place behind them) of a header, which must end in ``HEADER`` bytes and before ``until``."""
    for size in (4096, HEADER):
        text = source.piece(at, min(at + size, until))
        if (end := text.find(b"\r\n\r\n")) >= 0:
            return text[:end].split(b"\r\n"), at + end + 4
    raise Damage("header does not end")


def parse(source: Source, at: int, with_payload: bool = True) -> Found:
    """The record whose version line is at ``at``; raises ``Damage`` if a check fails."""
    source.pin = at
    if not PLAIN.match(source.piece(at, at + 10)):
        raise Damage("no version line")
    lines, begin = _head(source, at, at + HEADER)
    headers = _fields(lines[1:])
    if not (length := headers.get("content-length", "")).isdigit():
        raise Damage("no content length")
    end = begin + int(length)
    if isinstance(source, Bytes) and source.piece(end, end + 4) != b"\r\n\r\n":
        raise Damage("block does not end where it should")
    out, http_end = Found(at, end + 4, headers), begin
    if headers.get("content-type", "").startswith("application/http"):
        try:
            lines, http_end = _head(source, begin, end)
            out.http = _fields(lines[1:])
        except Damage:
            if end - begin > HEADER:
                raise
            out.http, http_end = _fields(source.piece(begin, end).split(b"\r\n")[1:]), end
    block, payload, parts, place = hashlib.sha1(), hashlib.sha1(), [], begin
    while place < end:
        part = source.piece(place, min(place + (1 << 20), end))
        if not part:
            raise Damage("block does not end where it should")
        block.update(part)
        body = part[max(0, http_end - place):]
        payload.update(body)
        if with_payload:
            parts.append(body)
        place += len(part)
    if source.piece(end, end + 4) != b"\r\n\r\n":
        raise Damage("block does not end where it should")
    if not _digest_fits(headers.get("warc-block-digest"), _base32(block)):
        raise Damage("block digest differs")
    out.size, out.payload, out.digest = end - http_end, b"".join(parts), _base32(payload)
    if headers.get("warc-type") == "revisit":
        out.digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    elif not _digest_fits(headers.get("warc-payload-digest"), out.digest):
        raise Damage("payload digest differs")
    return out


def _packed_end(data: memoryview, at: int, size: int) -> int:
    """Where the first ``size`` bytes of the content of the member at ``at`` end in ``data``."""
    unpack = zlib.decompressobj(31)
    while size and at < len(data):
        saved, part = unpack.copy(), data[at:at + STEP]
        try:
            size -= len(unpack.decompress(part, min(size, 64 * STEP)))
        except zlib.error:  # the damage stands close behind: byte by byte
            for i in range(len(part)):
                try:
                    size -= len(saved.decompress(part[i:i + 1]))
                except zlib.error:
                    return at + i
                if size <= 0:
                    return at + i + 1
        at += len(part) - len(unpack.unconsumed_tail)
    return at


def _next_start(data: memoryview, at: int) -> int:
    found = START.search(data, at)
    return found.start() if found else len(data)


def _records(source: Source, with_payload: bool) -> Iterator[Found | tuple[int, int, str]]:
    """Records and gaps of a member's content, where only version lines begin a record."""
    at, gap, reason = 0, -1, ""
    while source.piece(at, at + 1):
        try:
            found = parse(source, at, with_payload)
        except Damage as e:
            if gap < 0:
                gap, reason = at, str(e)
            if (at := source.find(PLAIN, at + 1)) < 0:
                break
            continue
        if gap >= 0:
            yield gap, at, reason
            gap = -1
        yield found
        at = found.end
    if gap >= 0:
        yield gap, source.stop, reason


def _member(data: memoryview, at: int, with_payload: bool) -> tuple[str, int, Iterator[Found | tuple[int, int, str]]]:
    """(why it breaks off, where to go on, records and gaps) of the gzip member at ``at``."""
    unpacked = Unpacked(data, at)
    content = unpacked.piece(0, WINDOW + 1)
    small = len(content) <= WINDOW
    size = len(content) if small else unpacked.whole()
    source = (lambda: Bytes(memoryview(content))) if small else (lambda: Unpacked(data, at))
    if not unpacked.broken:
        return "", unpacked.at, _records(source(), with_payload)
    n, last = 0, 0
    for x in _records(source(), False):
        if isinstance(x, Found):
            n, last = n + 1, x.end
    if not n or (n == 1 and last == size):  # one record alone stands or falls with the member's own checksum
        return unpacked.broken, _next_start(data, at + 1), iter(())
    # bytes of what was found are not searched again
    rest = max(at + 1, _packed_end(data, at, last))
    return unpacked.broken, _next_start(data, rest), (x for x in _records(source(), with_payload) if isinstance(x, Found))


def salvage(data: bytes | memoryview, with_payload: bool = True) -> Iterator[Found | tuple[int, int, str]]:
    """Records in order, and (begin, end, reason) for stretches of bytes that gave none.

    A member is salvaged like a file: its records have the member's offset, and so have the gaps between them.  Of a
    member that breaks off, the records before the damage are found, and the member is a gap from its offset on;
    only a member of one record alone stands or falls with its own checksum.
    """
    data = memoryview(data).cast("B")
    file, at, gap, reason = Bytes(data), 0, -1, ""
    while at < len(data):
        broken = ""
        if data[at:at + 3] == GZIP:
            broken, end, inner = _member(data, at, with_payload)
        else:
            try:
                record = parse(file, at, with_payload)
                end, inner = record.end, iter([record])
            except Damage as e:
                broken, end, inner = str(e), _next_start(data, at + 1), iter(())
        opened, before = False, None
        for x in inner:
            if isinstance(x, tuple) and not opened:
                before = x
                continue
            if not opened:
                opened = True
                if gap >= 0:
                    yield gap, at, reason
                    gap = -1
                if before:
                    yield at, end, before[2]
            yield (at, end, x[2]) if isinstance(x, tuple) else replace(x, offset=at, end=end)
        if before and not opened and not broken:  # a whole member without a valid record
            broken = before[2]
        if broken and gap < 0:
            gap, reason = at, broken
        at = end  # an empty member says nothing about where records go on
    if gap >= 0:
        yield gap, len(data), reason


def _members(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(x).to_pylist() for x in ("page_id", "url", "html", "refers_to")))
            out, size = [], 0
            for page_id, url, html, refers_to in rows:
                out.append(member(record(page_id, url, html, refers_to), level))
                size += len(out[-1])
                if size > 4 << 20:
                    yield pa.record_batch([pa.array(out, pa.binary())], names=["member"])
                    out, size = [], 0
            yield pa.record_batch([pa.array(out, pa.binary())], names=["member"])

    return run


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, level: int = 6) -> None:
    """Write a record for every row of ``pages`` (``page_id``, ``url``, ``html``); null html is an empty payload.

    Of rows with equal payloads of at least ``least_bytes`` bytes, those with the smallest ``page_id`` are responses and
    the others revisit it.  A row without a ``page_id`` is a response that nothing refers to.  Other columns are ignored.
    """
    workers_import(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    table = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    keys = table.filter((F.length("html") >= least_bytes) & F.col("page_id").isNotNull()).select("page_id", F.sha2("html", 256).alias("payload"))
    firsts = keys.groupBy("payload").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).filter("last > refers_to").drop("last")
    # written first: then the pages of a payload that very many have can be dealt anew
    later = keys.join(staged(firsts, "payloads"), "payload").filter("page_id > refers_to").distinct()
    rows = table.withColumn("payload", F.sha2("html", 256)).join(later, ["page_id", "payload"], "left").select("page_id", "url", "html", "refers_to")
    members = rows.mapInArrow(_members(level), "member binary").select(F.col("member").cast("string"))
    members.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY.decode("latin-1")).text(path)


def _page(uri: str | None) -> int | None:
    text = (uri or "").strip("<>").removeprefix(ID)
    return int(text) if re.fullmatch(r"-?\d+", text) else None


ENTRY = ("file string, offset long, end long, gap string, page_id long, url string, record_type string, refers_to long, "
         "payload_bytes long, payload_digest string, payload binary")


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ENTRY.split(", ")]
        kinds = dict(zip(names, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(v, t) for v, t in zip(zip(*rows), kinds.values())], names=names)

        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                out, size = [], 0
                for x in salvage(memoryview(content.as_buffer()), with_payload):
                    if isinstance(x, tuple):
                        out.append((file, x[0], x[1], x[2], *[None] * 7))
                        continue
                    kind = x.headers.get("warc-type")
                    n = x.size if kind != "revisit" else int(x.http.get("content-length", 0))
                    out.append((file, x.offset, x.end, None, _page(x.headers.get("warc-record-id")), x.headers.get("warc-target-uri"), kind, _page(x.headers.get("warc-refers-to")), n, x.digest, x.payload if with_payload else None))
                    size += len(x.payload) if with_payload else 0
                    if size > 4 << 20 or len(out) >= 10_000:
                        yield batch_of(out)
                        out, size = [], 0
                if out:
                    yield batch_of(out)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row for each record that passed its checks (``gap`` null), and one for each gap (``gap``: why, ``offset`` to ``end``).

    ``payload_bytes`` and ``payload_digest`` are those of the full payload, also for a revisit; of a response they are
    taken from the payload itself.
    """
    workers_import(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_read(with_payload), ENTRY)

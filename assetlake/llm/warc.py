"""WARC archives: writing pages as records, and a salvage reader.

Writing: one gzip member per record, archives rolled at ``ROLL_BYTES``, through
pyarrow's file systems into the shared folder. Every attempt of a task writes
files of its own; only those that a finished task lists are read. Of records with
equal payloads of at least ``min_bytes``, the one with the smallest page_id is a
response, the others are revisits that refer to it.

Reading: every record's length, checksum and block digest are checked. Members are
read in pieces, a record at a time, so a member may be an archive of its own. After
a failed check the reader looks for the next valid gzip member or version line,
inside a member for the next version line of its uncompressed bytes, goes on there,
and reports the bytes between as a quarantined gap. A member that ends in an error
gives the records before it, if there are several; their headers, and blocks without a
digest, are then vouched for by length and end marks alone. A header may have any length; a record of more
than ``RECORD_MAX`` bytes (a binary value can't hold two of them) is a gap. The query
fails if an archive just written gives a gap or other than the records written.

Defined results: NULL html is an empty payload; rows that repeat the smallest
page_id are all responses; where all page_ids of equal payloads are NULL, all
are responses; a NULL page_id revisits like any other. An empty table gives no
archive and no record. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.llm.common import bounded_batches, fresh_path, store, table, unclash

ROLL_BYTES = 64 << 20
WINDOW = 4 << 20
HEADER = 64 << 10  # bytes read at first for a plain record's header
PIECE = 64 << 10  # compressed bytes inflated at once
RECORD_MAX = 1 << 30
DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1\r\n"
NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
LINE = re.compile(rb"WARC/1\.[01]\r\n")
LENGTH = re.compile(rb"(?i)\r\ncontent-length:\s*(\d+)\s*\r\n")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id) -> str:
    return f"<urn:x-page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def record(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record: a response with the page, or a revisit without it. Digest and length are the full payload's."""
    block = b"" if revisit else HTTP + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": page_urn(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": re.sub(r"[\s\x00-\x1f]", lambda m: f"%{ord(m[0]):02X}", url or "") or None,
        "WARC-Payload-Digest": "sha1:" + base32_sha1(payload),
        "X-Payload-Length": len(payload),
        "WARC-Refers-To": page_urn(refers_to) if revisit else None,
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        "WARC-Block-Digest": "sha1:" + base32_sha1(block),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return VERSION + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write one record per row below ``folder`` (a URI all executors reach); returns (path, n_records, n_bytes)."""
    from pyspark import TaskContext

    bounded_batches(pages.sparkSession)
    rows = unclash(pages, ["page_id", "url", "html"]).withColumn("html", F.coalesce(F.col("html"), F.lit("")))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    narrow = store(rows.where(F.octet_length("html") >= min_bytes).select("page_id", "digest"), "warc-digests")
    firsts = store(narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1 and refers_to is not null").drop("n"), "warc-firsts")
    revisits = store(narrow.join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
                     .select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to").distinct(),
                     "warc-revisits")
    # -1 stands for a NULL id in the key alone, so that NULL ids find their revisit too; the digest tells them apart
    key = F.coalesce(F.col("page_id"), F.lit(-1))
    joined = rows.join(revisits, (key == F.coalesce(F.col("r_id"), F.lit(-1))) & (F.col("digest") == F.col("r_digest"))
                       & F.col("page_id").eqNullSafe(F.col("r_id")), "left").select("page_id", "url", "html", "refers_to")
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches):
        fs, top = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(top, recursive=True)
        part, out, done, n, size, path = TaskContext.get().partitionId(), None, [], 0, 0, None
        for b in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    path, n, size = f"part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{top}/{path}", compression=None)
                data = member(record(page_id, url, html.encode(), refers_to, refers_to is not None))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= ROLL_BYTES:
                    out.close()
                    done.append((f"{folder}/{path}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{path}", n, size))
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema=schema)


    return store(joined.mapInArrow(run, "path string, n_records long, n_bytes long"), "warc-archives")


class _Bytes:
    """Random access to a file through one cached window."""

    def __init__(self, file):
        self.file, self.size, self.start, self.data = file, file.size(), 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if at < self.start or at + n > self.start + len(self.data):
            self.start, self.data = at, self.file.read_at(min(max(n, WINDOW), self.size - at), at)
        return self.data[at - self.start:at - self.start + n]


def parse(data) -> tuple[dict, bytes, int]:
    """Headers, block and length of the record at the start of ``data``; ValueError if a check fails."""
    end = data.find(b"\r\n\r\n") if LINE.match(data) else -1
    if end < 0:
        raise ValueError("no record header")
    fields = {}
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    if not fields.get("content-length", "").isdigit():
        raise ValueError("no content length")
    length = int(fields["content-length"])
    with memoryview(data) as view:
        block = bytes(view[end + 4:end + 4 + length])
    if len(block) < length or data[end + 4 + length:end + 8 + length] != b"\r\n\r\n":
        raise ValueError("wrong length")
    if (told := fields.get("warc-block-digest", "")).startswith("sha1:") and told[5:] != base32_sha1(block):
        raise ValueError("wrong block digest")
    return fields, block, end + 8 + length


def _needed(head, end: int) -> int:
    """Bytes of the record whose header ends at ``end``; ValueError without a length that can be read."""
    m = LENGTH.search(head, 0, end + 2)
    if not m:
        raise ValueError("no content length")
    if (n := end + 8 + int(m[1])) > RECORD_MAX:
        raise ValueError("record too long")
    return n


def _plain(src: _Bytes, at: int) -> tuple[dict, bytes, int]:
    """Headers, block and length of the record at an offset of the file itself."""
    need, head = HEADER, src.get(at, HEADER)
    if not LINE.match(head):
        raise ValueError("no record header")
    while (end := head.find(b"\r\n\r\n")) < 0 and len(head) == need and need < RECORD_MAX:
        need *= 2
        head = src.get(at, need)
    if end < 0:
        raise ValueError("no record header")
    return parse(src.get(at, _needed(head, end)))


class _Member:
    """The uncompressed bytes of the gzip member at an offset; ``buf`` starts ``base`` bytes into them.

    ``pos`` is the file offset behind what was inflated. ``error`` says why the member ended early; what was
    inflated before the damaged byte is kept.
    """

    def __init__(self, src: _Bytes, at: int):
        self.src, self.pos, self.z = src, at, zlib.decompressobj(31)
        self.buf, self.base, self.done, self.error = bytearray(), 0, False, None
        self.piece = self.sound = at  # start of the last piece; of the one in which the last valid record ended

    def more(self) -> bool:
        if not self.done:
            if data := self.src.get(self.pos, PIECE):
                self.piece = self.pos
                self._feed(data)
                return True
            self.done, self.error = True, "truncated member"
        return False

    def _feed(self, data: bytes) -> None:
        before = self.z.copy()
        try:
            self.buf += self.z.decompress(data)
        except zlib.error as e:
            if len(data) == 1:
                self.done, self.error = True, f"bad member: {e}"
                return
            self.z, step = before, max(1, len(data) // 16)
            for k in range(0, len(data), step):
                if not self.done:
                    self._feed(data[k:k + step])
            return
        self.pos += len(data) - len(self.z.unused_data)
        self.done = self.z.eof

    def have(self, n: int) -> bool:
        while len(self.buf) < n and self.more():
            pass
        return len(self.buf) >= n

    def damaged(self) -> bool:
        """Whether nothing but an error follows what was read."""
        return not self.have(1) and (self.error or "").startswith("bad")

    def drop(self, n: int) -> None:
        del self.buf[:n]
        self.base += n

    def to_next_line(self) -> None:
        """Forward to the next version line behind the first byte, or to the end."""
        self.drop(1)
        while not (m := LINE.search(self.buf)):
            self.drop(max(0, len(self.buf) - 9))
            if not self.more():
                self.drop(len(self.buf))
                return
        self.drop(m.start())

    def next_record(self) -> tuple[dict, bytes, int]:
        if not self.have(10) or not LINE.match(self.buf):
            raise ValueError("no record header")
        start = 0
        while (end := self.buf.find(b"\r\n\r\n", start)) < 0:
            start = max(0, len(self.buf) - 3)
            if len(self.buf) > RECORD_MAX or not self.more():
                raise ValueError("no record header")
        self.have(_needed(self.buf, end))
        return parse(self.buf)

    def records(self):
        """Yields (offset, length, headers, block, None) per record and (offset, length, None, None, reason) per gap,
        in uncompressed bytes of the member."""
        lost = why = None
        while self.have(1):
            at = self.base
            try:
                fields, block, used = self.next_record()
            except ValueError as e:
                if lost is None:
                    lost, why = at, str(e)
                self.to_next_line()
                continue
            self.drop(used)
            self.sound = self.piece
            if lost is not None:
                yield lost, at - lost, None, None, why
                lost = None
            yield at, used, fields, block, None
        if lost is not None:
            yield lost, self.base - lost, None, None, why


def _search(src: _Bytes, pos: int) -> int:
    """The next offset at which a member or a plain record may start, or the file's end."""
    while pos < src.size:
        window = src.get(pos, WINDOW)
        if m := NEXT.search(window):
            return pos + m.start()
        pos += len(window) if pos + len(window) >= src.size else max(1, len(window) - 9)
    return src.size


def salvage_parts(file):
    """Yields (offset, member_offset, length, headers, block, None) per record, without headers and with a reason per gap.

    ``member_offset`` is NULL where the row covers bytes of the file (a plain record, a member of one record, a gap
    between), else ``length`` counts uncompressed bytes from there in the member at ``offset``. A member without a
    valid record belongs to the gap around it; behind a member that broke off, the gap starts at the byte that failed, or is empty if the next member starts before.
    """
    src, at, lost, why = _Bytes(file), 0, None, None
    while at < src.size:
        if src.get(at, 3) != b"\x1f\x8b\x08":
            try:
                fields, block, used = _plain(src, at)
            except ValueError as e:
                lost, why = (at, str(e)) if lost is None else (lost, why)
                at = _search(src, at + 1)
                continue
            if lost is not None:
                yield lost, None, at - lost, None, None, why
                lost = None
            yield at, None, used, fields, block, None
            at += used
            continue
        z, held, found, several = _Member(src, at), [], False, False
        for part in z.records():
            held.append(part)
            if len(held) == 1 and not several and z.damaged():
                continue  # the only record of a member whose checksum fails: its header may be what is wrong
            if part[2] is not None and not found:
                found = True
                if lost is not None:
                    yield lost, None, at - lost, None, None, why
                    lost = None
            several |= len(held) > 1
            if found and several:
                yield from ((at, *p) for p in held)
                held = []
        if found and held:  # one record, nothing else
            yield (at, None, z.pos - at, *held[0][2:]) if z.error is None else (at, *held[0])
        if not found and (held or z.error) and lost is None:
            lost, why = at, z.error or held[0][4]
        if z.error is None:
            at = z.pos
        elif found:  # damage may let a member run on through the next ones
            at = _search(src, max(z.sound, at + 1))
            lost, why = min(z.pos, at), z.error
        else:
            at = _search(src, at + 1)
    if lost is not None:
        yield lost, None, src.size - lost, None, None, why


def salvage(file):
    """``salvage_parts`` without the offset in the member."""
    for at, _, *rest in salvage_parts(file):
        yield at, *rest


READ = ("path string, offset long, member_offset long, length long, gap string, record_type string, page_id long, refers_to long, "
        "url string, payload_bytes long, payload_digest string, payload binary")


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archives listed in ``archives.path``; one file a time in a task.

    ``gap`` holds the failed check for a gap and is NULL for a record; offsets and length as in ``salvage_parts``.
    """
    fields = dict(x.split(" ") for x in READ.split(", "))
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in fields.items()])

    def number(text):
        m = re.fullmatch(r"<urn:x-page:(-?\d+)>", text or "")
        return int(m[1]) if m else None

    def run(batches):
        def rows(path):
            fs, name = pa.fs.FileSystem.from_uri(path)
            with fs.open_input_file(name) as file:
                for at, inner, n, head, block, gap in salvage_parts(file):
                    if head is None:
                        yield (path, at, inner, n, gap, *[None] * 7)
                        continue
                    body = block.partition(b"\r\n\r\n")[2] if "http" in head.get("content-type", "") else block
                    revisit = head.get("warc-type") == "revisit"
                    size, digest = len(body), None
                    if revisit:
                        size = int(head.get("x-payload-length", 0))
                        digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
                    yield (path, at, inner, n, None, head.get("warc-type"), number(head.get("warc-record-id")),
                           number(head.get("warc-refers-to")), head.get("warc-target-uri"), size,
                           digest or base32_sha1(body), body if payload else None)

        for b in batches:
            for path in b.column(0).to_pylist():
                hold, size = [], 0
                for r in rows(path):
                    hold.append(r)
                    size += len(r[-1] or b"") + 200
                    if size > WINDOW:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hold, strict=True), schema.types, strict=True)], schema=schema)
                        hold, size = [], 0
                if hold:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hold, strict=True), schema.types, strict=True)], schema=schema)

    n = max(1, archives.count())
    return archives.select("path").repartition(n).mapInArrow(run, READ)


def complete(archives: DataFrame, records: DataFrame) -> DataFrame:
    """The records read from archives just written; fails at a gap, or if an archive has other than n_records."""
    records = store(records, "warc-records")
    seen = records.groupBy("path").agg(F.count(F.when(F.col("gap").isNull(), 1)).alias("n_read"), F.count("gap").alias("n_gaps"))
    wrong = (archives.join(seen, "path", "left").withColumn("n_read", F.coalesce("n_read", F.lit(0)))
             .where("n_read != n_records or n_gaps > 0").select("path", "n_records", "n_read", "n_gaps").take(3))
    if wrong:
        raise RuntimeError(f"archives read back otherwise than written: {[r.asDict() for r in wrong]}")
    return records


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), _uri(fresh_path(spark, "warc")))
    return complete(archives, read_archives(archives, payload=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _uri(path: str) -> str:
    """pyarrow wants file:///folder where Hadoop may say file:/folder or give a bare path."""
    return path if "://" in path else "file://" + path.removeprefix("file:")

"""Operator 3, WARC: records inside ZIP packages, read by range without extraction.

Writer: each task packs its records into ZIP files in a shared folder. A package holds `archive/data.warc.gz` (stored, one
gzip member per record) and `indexes/index.cdx` (stored, one line `page_id type offset length` per record), with ZIP64
structures where sizes ask for them or when told to. A package is written under a name of its own by each task attempt; the
manifest of packages that count comes from the attempts that succeeded and is kept in the shared folder, so a lost or
repeated task leaves at most an unread file.

Reader: finds the end record, ZIP64 locator and central directory at a package's end, locates the stored members through
their local headers, reads the index, and range-reads each record from the package, neighbours together in one read.

Of records with equal payloads of at least `least` bytes, the one with the largest page_id is a response and the others
revisit it; shorter ones are all responses. A revisit has no payload of its own: the reader takes length and digest from
the record it refers to. Repeated rows with one page_id are written once each; if their payloads are equal, all of them
are responses, for none can revisit itself. A null payload is empty, a null page_id is written as `-`, never revisits and
is never revisited. Payloads of any length are whole. Empty tables give no packages and no records. Other columns, whatever
their names, aren't read."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import cut, runs, shared_folder, workers_can_import

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
ZIP64_FROM = 0xFFFFFFFF
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
MANIFEST = "package string, n_records long, n_bytes long"
SPANS = "package string, start long, length long, lengths array<int>"
RECORDS = "page_id long, record_type string, refers_to long, digest string, payload binary, url string"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


# ---- records


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit without."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'-' if page_id is None else page_id}>",
        f"WARC-Target-URI: {(url or '').translate({10: '%0A', 13: '%0D'})}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([] if refers_to is None else [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]),
        f"Content-Length: {len(body)}",
    ]
    raw = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def parse_record(member: bytes) -> tuple[int | None, str, int | None, str, bytes | None, str]:
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    named = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(named["content-length"])
    if len(rest) != size + 4:
        raise ValueError("record length differs from its header")
    number = lambda key: None if key not in named or named[key] == "<urn:page:->" else int(named[key][10:-1])
    kind = named["warc-type"]
    return number("warc-record-id"), kind, number("warc-refers-to"), named["warc-payload-digest"][5:], rest[:size] if kind == "response" else None, named["warc-target-uri"]


# ---- packages


class PackageWriter:
    """A ZIP file with the stored archive member, appended to record by record, then the stored index."""

    def __init__(self, folder: str, zip64: bool = False):
        self.uri = f"{folder}/{uuid.uuid4().hex}.wacz"
        self.zip64 = zip64
        store, path = open_store(self.uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.at, self.crc, self.members, self.index, self.n = store.open_output_stream(path), 0, 0, [], [], 0
        self._begin(ARCHIVE)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _begin(self, name: str) -> None:
        # bit 3: sizes and crc follow in a data descriptor; the ZIP64 field makes its sizes 8 bytes long
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self.members.append([name, self.at, 0, 0])
        self._write(struct.pack("<4sHHHHHIIIHH", LOCAL, 45, 8, 0, 0, 33, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra)) + name.encode() + extra)
        self.crc, self.start = 0, self.at

    def _end(self) -> None:
        self.members[-1][2:] = [self.crc, self.at - self.start]
        self._write(struct.pack("<4sIQQ", b"PK\x07\x08", self.crc, self.at - self.start, self.at - self.start))

    def add(self, page_id: int | None, kind: str, member: bytes) -> None:
        self.index.append(f"{'-' if page_id is None else page_id} {kind} {self.at - self.start} {len(member)}\n")
        self.crc = zlib.crc32(member, self.crc)
        self._write(member)
        self.n += 1

    def close(self) -> tuple[str, int, int]:
        self._end()
        self._begin(INDEX)
        for k in range(0, len(self.index), 10_000):
            data = "".join(self.index[k : k + 10_000]).encode()
            self.crc = zlib.crc32(data, self.crc)
            self._write(data)
        self._end()
        start = self.at
        for name, offset, crc, size in self.members:
            big = self.zip64 or max(size, offset) >= ZIP64_FROM
            extra = struct.pack("<HHQQQ", 1, 24, size, size, offset) if big else b""
            sizes = (ZIP64_FROM,) * 3 if big else (size, size, offset)
            self._write(struct.pack("<4sHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 8, 0, 0, 33, crc, *sizes[:2], len(name), len(extra), 0, 0, 0, 0, sizes[2]) + name.encode() + extra)
        n, length, end = len(self.members), self.at - start, self.at
        if big := self.zip64 or end >= ZIP64_FROM:
            self._write(struct.pack("<4sQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, length, start))
            self._write(struct.pack("<4sIQI", LOCATOR64, 0, end, 1))
        self._write(struct.pack("<4sHHHHIIH", END, 0, 0, *((0xFFFF, 0xFFFF, ZIP64_FROM, ZIP64_FROM) if big else (n, n, length, start)), 0))
        self.out.close()
        return self.uri, self.n, self.at


def stored_members(f: pa.NativeFile) -> dict[str, tuple[int, int]]:
    """Name to (offset of the first byte, length) of each stored member, from the central directory."""
    size = f.size()
    tail_at = max(0, size - 65_557)
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    k = tail.rfind(END)
    while k >= 0 and (k + 22 > len(tail) or k + 22 + struct.unpack_from("<H", tail, k + 20)[0] != len(tail)):
        k = tail.rfind(END, 0, k)  # these bytes can also stand in a comment
    if k < 0:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack_from("<HII", tail, k + 10)
    if 0xFFFF == n or ZIP64_FROM in (length, start):
        f.seek(tail_at + k - 20)
        mark, _, at, _ = struct.unpack("<4sIQI", f.read(20))
        if mark != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        f.seek(at)
        end64 = f.read(56)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        n, length, start = struct.unpack_from("<QQQ", end64, 32)
    f.seek(start)
    directory, at, out = f.read(length), 0, {}
    for _ in range(n):
        mark, _, _, flags, method, _, _, _, packed, whole, ln, lx, lc, _, _, _, offset = struct.unpack_from("<4sHHHHHHIIIHHHHHII", directory, at)
        if mark != CENTRAL:
            raise ValueError("broken central directory")
        name = directory[at + 46 : at + 46 + ln].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = directory[at + 46 + ln : at + 46 + ln + lx], 0
        while x + 4 <= len(extra):
            kind, k = struct.unpack_from("<HH", extra, x)
            if kind == 1:  # 8-byte values of just those fields that are full, in this order
                big = iter(struct.unpack_from(f"<{k // 8}Q", extra, x + 4))
                whole, packed, offset = (next(big) if v == ZIP64_FROM else v for v in (whole, packed, offset))
            x += 4 + k
        at += 46 + ln + lx + lc
        if method == 0 and not name.endswith("/"):
            f.seek(offset)
            local = f.read(30)
            if local[:4] != LOCAL:
                raise ValueError("broken local header")
            out[name] = (offset + 30 + sum(struct.unpack_from("<HH", local, 26)), packed)
    return out


# ---- jobs


def mark_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """(page_id, url, payload, digest, refers_to). Copies are counted per digest before any row moves by digest."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    keyed = F.when((F.length("payload") >= least) & F.col("page_id").isNotNull(), F.col("digest"))
    rows = rows.withColumn("key", keyed)
    first = (
        rows.where("key is not null").groupBy("key").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("key", "first")
    )
    # rows without a partner keep a key of their own, so that none of them gather
    joined = rows.withColumn("key", F.coalesce("key", F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.col("digest")))))
    joined = joined.join(first, "key", "left")
    return joined.select("page_id", "url", "payload", "digest", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"))


def write_packages(marked: DataFrame, folder: str, package_bytes: int = 256 << 20, zip64: bool = False) -> DataFrame:
    """Runs the writers; the manifest of packages that count (package, n_records, n_bytes)."""
    workers_can_import(marked.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        done = []
        for batch in runs(batches, "payload", 4 << 20):
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                package = package or PackageWriter(folder, zip64)
                package.add(page_id, "response" if refers_to is None else "revisit", warc_record(page_id, url, payload, digest, refers_to))
                if package.at >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["package", "n_records", "n_bytes"])

    return cut(marked.mapInArrow(run, MANIFEST))


TASK_BYTES = 128 << 20  # of archives that a task reads, once every core has some


def read_packages(packages: DataFrame, span_bytes: int = 4 << 20) -> DataFrame:
    """The records of all packages (RECORDS); payload is null for revisits. Work is dealt out by spans of the archives."""
    workers_can_import(packages.sparkSession)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("package").to_pylist():
                store, path = open_store(uri)
                with store.open_input_file(path) as f:
                    members = stored_members(f)
                    (archive, size), (at, length) = members[ARCHIVE], members[INDEX]
                    f.seek(at)
                    spans, lengths, start, held, left = [], [], 0, 0, b""
                    while length or left:
                        data = left + (got := f.read(min(length, 1 << 20)))
                        length -= len(got)
                        *lines, left = data.split(b"\n")
                        for line in lines:
                            offset, n = map(int, line.split()[2:])
                            if offset != start + held:
                                raise ValueError("the index has a gap")
                            lengths.append(n)
                            held += n
                            if held >= span_bytes:
                                spans.append((uri, archive + start, held, lengths))
                                start, held, lengths = start + held, 0, []
                    if lengths:
                        spans.append((uri, archive + start, held, lengths))
                    if start + held != size:
                        raise ValueError("the index doesn't cover the archive")
                if spans:
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*spans), kinds)], ["package", "start", "length", "lengths"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start, length, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = open_store(uri)
                with store.open_input_file(path) as f:
                    f.seek(start)
                    data, at, rows = f.read(length), 0, []
                for n in lengths:
                    rows.append(parse_record(data[at : at + n]))
                    at += n
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in RECORDS.split(", ")])

    spans = cut(packages.mapInArrow(locate, SPANS))
    n, total = spans.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    # a number given is kept as it is; left to itself, Spark joins these few short rows in one task, which would read every archive
    tasks = max(1, min(n, max(spans.sparkSession.sparkContext.defaultParallelism, total // TASK_BYTES)))
    return spans.repartitionByRange(tasks, "package", "start").mapInArrow(fetch, RECORDS)


def op3_warc_zip(pages: DataFrame, least: int = 1000) -> DataFrame:
    manifest = write_packages(mark_revisits(pages, least), shared_folder(pages.sparkSession, "warc"))
    records = read_packages(manifest)
    # length and digest of what was read, not of what the headers say
    facts = records.select(
        "page_id", "record_type", "refers_to", F.length("payload").cast("long").alias("own_bytes"), F.sha1("payload").alias("own_digest"),
        F.coalesce("refers_to", "page_id").alias("target"), "digest",
    )
    facts = cut(facts)
    targets = facts.where("record_type = 'response'").select(
        F.col("page_id").alias("target"), F.col("own_bytes").alias("their_bytes"), F.col("own_digest").alias("digest")
    ).distinct()
    revisits = facts.where("record_type = 'revisit'").join(targets, ["target", "digest"], "left").select(
        "page_id", F.col("their_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )
    responses = facts.where("record_type = 'response'").select(
        "page_id", F.col("own_bytes").alias("payload_bytes"), F.col("own_digest").alias("payload_digest"), "record_type", "refers_to"
    )
    return responses.unionByName(revisits)


OP3_SQL = """
with p as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), m as (
  select payload_digest, max(page_id) as first from p where payload_bytes >= 1000 group by 1
)
select p.page_id, p.payload_bytes, p.payload_digest,
       case when p.payload_bytes >= 1000 and m.first <> p.page_id then 'revisit' else 'response' end as record_type,
       case when p.payload_bytes >= 1000 and m.first <> p.page_id then m.first end as refers_to
from p left join m using (payload_digest)
"""

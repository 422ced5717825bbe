"""WARC archives of pages, and a normaliser of archives that were compressed as a whole.

Archives are often one gzip stream from end to end, in which no record can be
reached without inflating all before it. The normaliser inflates such a file
once, in pieces, and writes each record as a gzip member of its own, with a
sidecar that has each member's place. Records are then read at their places, by
any number of tasks. Neither step holds a record as a whole.

Pages are archived as they lie in their partitions, all as responses. Equal
payloads are then found by thin rows of digests, and while the records are
rewritten all but one become revisits of that one, so that no payload is
shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import discard, only, prepare, staged, staging_path
from corpusloom.llm.components import small_or_shuffled

#: Bytes of payload from which equal records are revisits; of payloads and records in a file; of compressed bytes read by one task.
LEAST, FILE_BYTES, FILE_RECORDS, READ_BYTES = 1000, 1 << 28, 100_000, 1 << 25
#: Bytes that are inflated or deflated at a time, and bytes of a header that may be looked at.
PIECE, HEADER = 1 << 16, 1 << 24
#: Fixed values of the format.
VERSION, DATE, END = "WARC/1.1", "1970-01-01T00:00:00Z", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


class Damaged(ValueError):
    """An archive that can't be read on; says which file, and where after inflating."""


class Inflated:
    """The bytes of a gzip file of one member or many, inflated piece by piece as they are asked for."""

    def __init__(self, source: BinaryIO, name: str = ""):
        self.source, self.name, self.machine, self.held, self.place = source, name, zlib.decompressobj(31), bytearray(), 0
        self.waiting, self.begun = b"", False

    def damaged(self, why: str) -> Damaged:
        return Damaged(f"{self.name} at {self.place}: {why}")

    def _more(self) -> bool:
        """Inflate a piece more; False at the end of the file."""
        while True:
            if self.machine.eof:
                self.waiting = self.machine.unused_data or self.waiting
                self.machine, self.begun = zlib.decompressobj(31), False
            data = self.machine.unconsumed_tail or self.waiting or self.source.read(PIECE)
            if not self.machine.unconsumed_tail:
                self.waiting = b""
            if not self.begun:
                padded, data = data, data.lstrip(b"\0")  # members may be followed by zeros
                if not padded:
                    return False
                if not data:
                    continue
            ended, self.begun = not data, True
            try:
                out = self.machine.decompress(data, PIECE)  # at the end of the file what is held back still comes
            except zlib.error:
                raise self.damaged("not a gzip stream") from None
            if out:
                self.held += out
                return True
            if ended and not self.machine.eof:
                raise self.damaged("the file ends within a gzip member")

    def until(self, mark: bytes) -> bytes | None:
        """The bytes up to a mark and with it, or None at the end of the file."""
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if seen > HEADER:
                raise self.damaged("a header without end")
            if not self._more():
                if self.held.strip():
                    raise self.damaged("the file ends within a header")
                return None
        out = bytes(self.held[: at + len(mark)])
        del self.held[: at + len(mark)]
        self.place += len(out)
        return out

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces."""
        while size:
            if not self.held and not self._more():
                raise self.damaged("the file ends within a record")
            out = bytes(self.held[:size])
            del self.held[: len(out)]
            size -= len(out)
            self.place += len(out)
            yield out


@dataclass
class Record:
    """A record's header by lower-case names, its block's size and the block, which has to be gone through once."""

    header: dict[str, str]
    raw: bytes
    size: int
    block: Iterator[bytes]


def records(stream: Inflated) -> Iterator[Record]:
    """The records of an archive, one after the other; what isn't read of a block is skipped."""
    while (raw := stream.until(END)) is not None:
        lines = raw.lstrip(b"\r\n").decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise stream.damaged("no WARC record")
        header = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}
        if not re.fullmatch(r"[0-9]+", header.get("content-length", "")):
            raise stream.damaged("a record without length")
        size = int(header["content-length"])
        block = stream.take(size)
        yield Record(header, raw.lstrip(b"\r\n"), size, block)
        for _ in block:
            pass
        if b"".join(stream.take(len(END))) != END:
            raise stream.damaged("a record that doesn't end where it says")


class Member:
    """Writes gzip members to a file and knows where each begins."""

    def __init__(self, sink):
        self.sink, self.at = sink, 0

    def write(self, pieces: Iterator[bytes]) -> tuple[int, int]:
        """(offset, length) of a member of these bytes."""
        begin, machine = self.at, zlib.compressobj(6, zlib.DEFLATED, 31)
        for piece in pieces:
            self._out(machine.compress(piece))
        self._out(machine.flush())
        return begin, self.at - begin

    def _out(self, data: bytes) -> None:
        if data:
            self.sink.write(data)
            self.at += len(data)


def header(fields: list[tuple[str, object]]) -> bytes:
    """A record's header; fields without a value are left out, line ends and controls in values are escaped."""
    lines = [VERSION] + [f"{k}: {_line(str(v))}" for k, v in fields if v is not None]
    return "\r\n".join(lines).encode() + END


def _line(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: " " if m[0] == " " else f"%{ord(m[0]):02X}", value)


def base32(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def http_header(size: int) -> bytes:
    """The head of the response that a payload came in; a revisit keeps it, and with it the payload's size."""
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def response(page_id: int | None, url: str | None, payload: bytes, ident: str, sha1: bytes) -> Iterator[bytes]:
    """The bytes of a response record."""
    head = http_header(len(payload))
    yield header([
        ("WARC-Type", "response"), ("WARC-Record-ID", f"<{ident}>"), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("WARC-Payload-Digest", base32(sha1)),
        ("X-Page-Id", page_id), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(head) + len(payload)),
    ])
    yield head
    for at in range(0, len(payload), PIECE):
        yield payload[at : at + PIECE]
    yield END


def revisit(record: Record, of: str, of_page: int | None) -> Iterator[bytes]:
    """A response record as a revisit of another with the same payload: its block is the HTTP header only."""
    head = bytearray()
    for piece in record.block:
        head += piece
        if (at := head.find(END)) >= 0:
            break
    head = bytes(head[: at + len(END)])
    known = record.header.get
    yield header([
        ("WARC-Type", "revisit"), ("WARC-Record-ID", known("warc-record-id")), ("WARC-Date", known("warc-date")), ("WARC-Target-URI", known("warc-target-uri")), ("WARC-Payload-Digest", known("warc-payload-digest")),
        ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{of}>"), ("X-Refers-To-Page-Id", of_page), ("X-Page-Id", known("x-page-id")),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(head)),
    ])
    yield head
    yield END


def _files(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


def _replace(system: pa.fs.FileSystem, name: str, final: str) -> None:
    """Give a whole file its name; a task that runs again leaves the same file."""
    if not isinstance(system, pa.fs.LocalFileSystem) and system.get_file_info(final).type != pa.fs.FileType.NotFound:
        system.delete_file(final)
    system.move(name, final)


_WRITTEN = "file string, ordinal int, page_id long, bytes long, same binary"


def write_whole(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", file_bytes: int = FILE_BYTES, file_records: int = FILE_RECORDS) -> DataFrame:
    """Archive pages as responses, each file one gzip stream: (file, ordinal, page_id, bytes, same) for each record.

    ``same`` is a digest that equal payloads share. A file has ``file_bytes``
    of payload or ``file_records`` records at most, or one record.
    """
    prepare(pages.sparkSession)
    rows = only(pages, page_id=id_col, url=url_col, html=html_col)
    rows = rows.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, base = _files(folder)
        system.create_dir(base, recursive=True)
        part, attempt = task.partitionId(), task.taskAttemptId()
        number, size, out = 0, 0, None
        listed: list[tuple] = []

        def close() -> pa.RecordBatch:
            nonlocal out, number, size, listed
            sink.write(machine.flush())
            sink.close()
            _replace(system, name, f"{base}/{final}")
            done, listed, out, size = listed, [], None, 0
            number += 1
            columns = list(zip(*done, strict=True))
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["file", "ordinal", "page_id", "bytes", "same"])

        for batch in batches:
            for page_id, url, html in zip(batch.column("page_id"), batch.column("url"), batch.column("html"), strict=True):
                page_id, url, payload = page_id.as_py(), url.as_py(), html.as_py()
                if out is not None and (size + len(payload) > file_bytes or len(listed) == file_records):
                    yield close()
                if out is None:
                    final, name = f"part-{part:06d}-{number:04d}.warc.gz", f"{base}/.attempt-{attempt}-{number:04d}"
                    out = sink = system.open_output_stream(name, compression=None)
                    machine = zlib.compressobj(1, zlib.DEFLATED, 31)
                ordinal = len(listed)
                for piece in response(page_id, url, payload, record_id(final, ordinal), hashlib.sha1(payload).digest()):
                    sink.write(machine.compress(piece))
                listed.append((final, ordinal, page_id, len(payload), hashlib.sha256(payload).digest()))
                size += len(payload)
        if out is not None:
            yield close()

    return rows.mapInArrow(run, _WRITTEN)


def record_id(file: str, ordinal: int) -> str:
    """A record's own name, the same whenever a task writes it again."""
    return f"urn:uuid:{uuid.uuid5(_NAMES, f'{file}#{ordinal}')}"


def repeats(written: DataFrame, least: int = LEAST) -> DataFrame:
    """(file, ordinal, of_page, of_file, of_ordinal) of records whose payload another has as well: of equal ones of ``least`` bytes or more, that with the largest page_id is kept (of several, the last written)."""
    big = written.filter(F.col("bytes") >= least)
    one = F.max(F.struct("page_id", "file", "ordinal")).alias("one")
    shared = big.groupBy(F.col("same").alias("_s"), F.col("bytes").alias("_b")).agg(one, F.count(F.lit(1)).alias("n")).filter("n > 1").select("_s", "_b", "one")
    shared = small_or_shuffled(staged(shared, "shared"))
    found = big.join(shared, (F.col("same") == F.col("_s")) & (F.col("bytes") == F.col("_b")))
    other = (F.col("file") != F.col("one.file")) | (F.col("ordinal") != F.col("one.ordinal"))
    return found.filter(other).select("file", "ordinal", F.col("one.page_id").alias("of_page"), F.col("one.file").alias("of_file"), F.col("one.ordinal").alias("of_ordinal"))


def normalise_file(source: BinaryIO, name: str, sink, again: dict[int, tuple[str, int | None]] | None = None) -> Iterator[tuple[int, int, int, str, str]]:
    """Rewrite an archive record by record: (ordinal, offset, length, type, id) of each member.

    ``again`` has the ordinals of records that become revisits, with id and
    page of the record that each repeats.
    """
    out = Member(sink)
    for ordinal, record in enumerate(records(Inflated(source, name))):
        kind, ident = record.header.get("warc-type", ""), record.header.get("warc-record-id", "").strip("<>")
        if again and ordinal in again and kind == "response":
            kind, pieces = "revisit", revisit(record, *again[ordinal])
        else:
            pieces = _copied(record)
        yield ordinal, *out.write(pieces), kind, ident


def _copied(record: Record) -> Iterator[bytes]:
    yield record.raw
    yield from record.block
    yield END


#: The sidecar of an archive: a JSON object a line, in the order of the records.
SIDECAR = "file string, ordinal int, offset long, length long, type string, id string"


def normalise(archives: DataFrame, source: str, target: str, again: DataFrame | None = None) -> int:
    """Write the archives (file) of one folder to another, each record a member, with a sidecar <file>.index.json beside each; returns the number of records.

    Files may be compressed in any way, as one stream, as members or in
    between. ``again`` (file, ordinal, of_page, of_file, of_ordinal) names the
    records that become revisits; its rows are dealt by file, of which each has
    a bounded number. A file that is broken raises Damaged, which says where.
    """
    spark = archives.sparkSession
    prepare(spark)
    files = archives.select("file").distinct()
    if again is None:
        listed = files.withColumn("again", F.array().cast("array<struct<ordinal:int,of_page:long,of_file:string,of_ordinal:int>>"))
    else:
        grouped = again.groupBy(F.col("file").alias("_f")).agg(F.collect_list(F.struct("ordinal", "of_page", "of_file", "of_ordinal")).alias("again"))
        listed = files.join(grouped, F.col("file") == F.col("_f"), "left").drop("_f")
    listed = staged(listed, "archives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (come, here), (go, there) = _files(source), _files(target)
        go.create_dir(there, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for row in batch.to_pylist():
                told = {a["ordinal"]: (record_id(a["of_file"], a["of_ordinal"]), a["of_page"]) for a in row["again"] or ()}
                file, n = row["file"], 0
                names = [f"{there}/.attempt-{attempt}-{file}", f"{there}/.attempt-{attempt}-{file}.index"]
                with come.open_input_stream(f"{here}/{file}", compression=None) as data, go.open_output_stream(names[0], compression=None) as sink, go.open_output_stream(names[1], compression=None) as side:
                    for ordinal, offset, length, kind, ident in normalise_file(data, file, sink, told):
                        side.write((json.dumps({"file": file, "ordinal": ordinal, "offset": offset, "length": length, "type": kind, "id": ident}) + "\n").encode())
                        n += 1
                _replace(go, names[0], f"{there}/{file}")
                _replace(go, names[1], f"{there}/{file}.index.json")
                yield pa.record_batch({"file": [file], "records": pa.array([n], pa.int64())})

    count = max(1, listed.count())
    done = staged(listed.repartition(count).mapInArrow(run, "file string, records long"), "normalised")
    return done.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]


def index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecars of a folder of archives: (file, ordinal, offset, length, type, id)."""
    return spark.read.schema(SIDECAR).json(folder, pathGlobFilter="*.index.json")


def read(spark: SparkSession, folder: str, wanted: DataFrame | None = None, read_bytes: int = READ_BYTES) -> DataFrame:
    """Response and revisit records at the places that their sidecars give: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Large files are read by several tasks. ``wanted`` takes the place of the
    index, for some records only. A payload that doesn't have the digest that
    its record states raises Damaged.
    """
    prepare(spark)
    places = (index(spark, folder) if wanted is None else wanted).filter(F.col("type").isin("response", "revisit"))
    dealt = places.select("file", "offset", "length", F.floor(F.col("offset") / read_bytes).alias("_range")).repartition("file", "_range").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _files(folder)
        name = source = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    if source is not None:
                        source.close()
                    name, source = row["file"], system.open_input_file(f"{base}/{row['file']}")
                data = source.read_at(row["length"], row["offset"])
                out.append(described(next(records(Inflated(io.BytesIO(data), f"{name}+{row['offset']}")))))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        if source is not None:
            source.close()

    return dealt.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def described(record: Record) -> tuple:
    """(page_id, bytes and SHA-1 of the full payload, type, page that a revisit refers to)."""
    number = lambda name: int(record.header[name]) if name in record.header else None
    kind, stated = record.header["warc-type"], record.header.get("warc-payload-digest", "")
    size, told, sha1, head = 0, None, hashlib.sha1(), bytearray()
    for piece in record.block:
        if told is None:
            head += piece
            at = head.find(END)
            if at < 0:
                continue
            m = re.search(rb"(?i)^content-length:\s*([0-9]+)\s*$", head[:at].replace(b"\r", b""), re.M)
            told, piece = int(m[1]) if m else -1, bytes(head[at + len(END) :])
        size += len(piece)
        sha1.update(piece)
    if kind == "revisit":
        return number("x-page-id"), told, base64.b32decode(stated.removeprefix("sha1:")).hex(), kind, number("x-refers-to-page-id")
    if stated and stated != base32(sha1.digest()):
        raise Damaged(f"{record.header.get('warc-record-id', '')}: another digest")
    return number("x-page-id"), size, sha1.hexdigest(), kind, None


def archive(pages: DataFrame, folder: str | None = None, least: int = LEAST, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write pages to archives, normalise these and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null html counts as empty and gives a response of no bytes; null urls
    leave their field out. Rows with equal or null ids are records of their
    own; of equal payloads of at least ``least`` bytes the record with the
    largest id is the response (of several with that id, the last written), a
    null id being the smallest. A page is archived as a whole, however long;
    an empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or staging_path(spark, "warc")
    whole = staging_path(spark, "whole")
    written = staged(write_whole(pages, whole, id_col, url_col, html_col), "written")
    made = normalise(written, whole, folder, repeats(written, least))
    discard(spark, whole)
    if made != written.count():
        raise Damaged(f"{folder}: {made} records")
    if not made:
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read(spark, folder)

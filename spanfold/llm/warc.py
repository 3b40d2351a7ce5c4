"""WARC archives of pages: written, normalised to one gzip member per record, read back.

``write`` puts one record per page into archives that are each a single gzip stream, as many
crawlers leave them. Such a file can only be read from its beginning. ``normalise`` inflates
each stream once, writes every record as a gzip member of its own, and puts an index beside the
archive: one line per record with its offset and length. ``read`` takes the records by that
index, in blocks of an archive that are tasks of their own.

Of the pages with one payload of ``least_revisit`` bytes or more, the one with the smallest id is
a response; the others are revisits, which hold no payload but name that response. Which page
that is comes from an aggregation over digests; only digests that occur under several ids take
part in the join with the pages.

Lost executors: a file's name has the attempt of the task that wrote it, and what counts is the
written table of finished files. Files of attempts that were lost are never read.

Memory: archives end after ``archive_bytes`` of records; streams are inflated and copied in
pieces, so a task holds one record at most. Files are opened through the file systems of
pyarrow (local, hdfs, s3, gs and others by the address of the folder).

Defined cases: a null html is an empty payload; payloads shorter than ``least_revisit`` are
all responses; a page without an id is a response, and none refers to it; rows that repeat id
and payload are records of their own, both responses if their id is the smallest; ids with
several payloads are told apart by digest; a null url is written as the page's urn; characters
that no URI holds are escaped; an empty table gives no archive and no record. Only id, url and
html are read, so further columns do not matter. A record whose payload is not what its digest
says stops the read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfold.llm.common import text_or_empty
from spanfold.sources.scratch import stored

LEAST_REVISIT = 100
ARCHIVE_BYTES = 256 << 20
BLOCK_BYTES = 16 << 20
MOST_TASKS = 100_000
PIECE = 1 << 20
GZIP = 16 + zlib.MAX_WBITS
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"
URI_CHARACTERS = "!#$%&'()*+,/:;=?@[]~-._"

ARCHIVES = "archive string, n_records long, n_bytes long"
INDEX = "archive string, offset long, length long, record_type string, record_id string"


def _files(folder: str) -> tuple[fs.FileSystem, str]:
    address = re.sub(r"^file:/+", "file:///", folder)
    return fs.FileSystem.from_uri(address)


def _make(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# -- records ------------------------------------------------------------------------


def _record_id(page_id: int | None, digest: str) -> str:
    seed = f"{'' if page_id is None else page_id}\n{digest}".encode()
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(seed).digest()[:16], version=5)}>"


def _record(fields: dict[str, object], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields.items() if v is not None)]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + END + block + END


def info_record(name: str) -> bytes:
    fields = {
        "WARC-Type": "warcinfo", "WARC-Record-ID": _record_id(None, name), "WARC-Date": NO_DATE,
        "WARC-Filename": name, "Content-Type": "application/warc-fields",
    }
    return _record(fields, b"format: WARC File Format 1.1\r\n")


def page_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """A response, or, with ``refers_to``, a revisit of that page's response."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload)
    uri = f"urn:page:{'' if page_id is None else page_id}" if url is None else quote(url, URI_CHARACTERS)
    again = refers_to is not None
    fields = {
        "WARC-Type": "revisit" if again else "response",
        "WARC-Record-ID": _record_id(page_id, digest),
        "WARC-Date": NO_DATE,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Profile": REVISIT_PROFILE if again else None,
        "WARC-Refers-To": _record_id(refers_to, digest) if again else None,
        "Content-Type": "application/http; msgtype=response",
        "Page-Id": page_id,
        "Refers-To-Page-Id": refers_to,
    }
    return _record(fields, head + END + (b"" if again else payload))


def _fields(header: bytes) -> dict[str, str]:
    first, *lines = header.split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError(f"not the begin of a record: {first[:40]!r}")
    pairs = (line.decode().split(":", 1) for line in lines if line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


# -- archives of one stream ---------------------------------------------------------


class _Archive:
    """One gzip stream of records, written piece by piece."""

    def __init__(self, folder: str, name: str) -> None:
        files, base = _files(folder)
        self.name, self.n_records, self.n_bytes = name, 0, 0
        self._out = files.open_output_stream(f"{base}/{name}", compression=None)
        self._deflate = zlib.compressobj(6, zlib.DEFLATED, GZIP)
        self._put(info_record(name))

    def _put(self, data: bytes) -> None:
        self._out.write(self._deflate.compress(data))
        self.n_bytes += len(data)

    def add(self, record: bytes) -> None:
        self._put(record)
        self.n_records += 1

    def close(self) -> tuple[str, int, int]:
        self._out.write(self._deflate.flush())
        self._out.close()
        return self.name, self.n_records, self.n_bytes


def _listed(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(names)})


def write(
    pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, least_revisit: int = LEAST_REVISIT,
    page_id: str = "page_id", url: str = "url", html: str = "html",
) -> tuple[DataFrame, str]:
    """Archives below ``folder``: a written table of them, and the folder they are in."""
    spark = pages.sparkSession
    place = f"{folder}/streams"
    _make(spark, place)
    payload = text_or_empty(html).cast("binary")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("digest"),
    )
    firsts = (
        rows.where(F.octet_length("payload") >= least_revisit).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .where("first < last").select("digest", "first")
    )
    marked = rows.join(stored(firsts, "repeated-payloads"), "digest", "left").select(
        "page_id", "url", "payload", "digest", F.expr("if(first < page_id, first, null)").alias("refers_to")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, archive, number = TaskContext.get(), None, 0
        for batch in batches:
            for row in zip(*(batch.column(n) for n in range(5)), strict=True):
                if archive is not None and archive.n_bytes >= archive_bytes:
                    yield _listed([archive.close()], ["archive", "n_records", "n_bytes"])
                    archive = None
                if archive is None:
                    name = f"{task.partitionId():06d}-{number:04d}-{task.taskAttemptId()}.warc.gz"
                    archive, number = _Archive(place, name), number + 1
                archive.add(page_record(*(cell.as_py() for cell in row)))
        if archive is not None:
            yield _listed([archive.close()], ["archive", "n_records", "n_bytes"])

    return stored(marked.mapInArrow(work, ARCHIVES), "archives"), folder


# -- one member per record ----------------------------------------------------------


class Inflated:
    """What gzip members hold, one after the other, read once from front to back."""

    def __init__(self, source: pa.NativeFile) -> None:
        self._source = source
        self._inflate = zlib.decompressobj(GZIP)
        self._rest = bytearray()
        self._raw = b""

    def _more(self) -> bool:
        while True:
            if self._inflate.eof:  # a member may follow
                self._raw = self._inflate.unused_data or self._source.read(PIECE)
                if not self._raw:
                    return False
                self._inflate = zlib.decompressobj(GZIP)
            elif not self._raw:
                self._raw = self._source.read(PIECE)
                if not self._raw:
                    raise ValueError("the stream ends within a member")
            found = self._inflate.decompress(self._raw, PIECE)
            self._raw = b"" if self._inflate.eof else self._inflate.unconsumed_tail
            if found:
                self._rest += found
                return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before ``mark``, which is passed over; None at the end of the stream."""
        searched = 0
        while (at := self._rest.find(mark, max(0, searched - len(mark)))) < 0:
            searched = len(self._rest)
            if not self._more():
                if self._rest:
                    raise ValueError("the stream ends within a record")
                return None
        found = bytes(self._rest[:at])
        del self._rest[: at + len(mark)]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self._rest and not self._more():
                raise ValueError("the stream ends within a block")
            piece = bytes(self._rest[:size])
            del self._rest[: len(piece)]
            size -= len(piece)
            yield piece


def rewritten(source: pa.NativeFile, out: pa.NativeFile) -> Iterator[tuple[int, int, str, str]]:
    """Copies every record as a member of its own: (offset, length, type, id) of each."""
    stream, offset = Inflated(source), 0
    while (header := stream.until(END)) is not None:
        fields = _fields(header)
        member, length = zlib.compressobj(6, zlib.DEFLATED, GZIP), 0
        length += out.write(member.compress(header + END))
        for piece in stream.take(int(fields["content-length"]) + len(END)):
            length += out.write(member.compress(piece))
        length += out.write(member.flush())
        yield offset, length, fields["warc-type"], fields["warc-record-id"]
        offset += length


def normalise(archives: tuple[DataFrame, str]) -> tuple[DataFrame, str]:
    """Archives with one member per record and an index beside each, in place of the streams,
    which are removed when all are written."""
    listed, folder = archives
    spark = listed.sparkSession
    streams, place = f"{folder}/streams", f"{folder}/records"
    _make(spark, place)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        files, base = _files(place)
        _, old = _files(streams)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                archive = f"{name.removesuffix('.warc.gz')}-{attempt}.warc.gz"
                n_records = 0
                with (
                    files.open_input_stream(f"{old}/{name}", compression=None) as source,
                    files.open_output_stream(f"{base}/{archive}", compression=None) as out,
                    files.open_output_stream(f"{base}/{archive}.idx", compression=None) as index,
                ):
                    for entry in rewritten(source, out):
                        index.write("\t".join(map(str, (archive, *entry))).encode() + b"\n")
                        n_records += 1
                    n_bytes = out.tell()
                yield _listed([(archive, n_records, n_bytes)], ["archive", "n_records", "n_bytes"])

    # an archive is one task's work
    tasks = listed.repartition(min(max(1, listed.count()), MOST_TASKS), "archive")
    written = stored(tasks.mapInArrow(work, ARCHIVES), "normalised")
    _remove(spark, streams)
    return written, folder


# -- reading by index ---------------------------------------------------------------


def index(archives: tuple[DataFrame, str]) -> DataFrame:
    """(archive, offset, length, record_type, record_id), a row per record."""
    listed, folder = archives
    lines = listed.sparkSession.read.schema(INDEX).option("pathGlobFilter", "*.idx")
    return lines.csv(f"{folder}/records", sep="\t").join(listed.select("archive"), "archive", "left_semi")


def parsed(member: bytes) -> tuple[int | None, str, int, str, str, int | None, bytes | None]:
    """Id, address, payload size and digest, type, reference and payload of a page's record."""
    record = zlib.decompress(member, GZIP)
    head, rest = record.split(END, 1)
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, payload = block.split(END, 1)
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    again = fields["warc-type"] == "revisit"
    if not again and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} is not what its digest says")
    page, refers_to = (int(fields[f]) if f in fields else None for f in ("page-id", "refers-to-page-id"))
    return page, fields["warc-target-uri"], size, digest, fields["warc-type"], refers_to, None if again else payload


RECORDS = (
    "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long"
)


def read(archives: tuple[DataFrame, str], payloads: bool = False) -> DataFrame:
    """The pages' records: ``page_id, target_uri, payload_bytes, payload_digest, record_type,
    refers_to``, and with ``payloads`` the payload (null for a revisit)."""
    listed, folder = archives
    place = f"{folder}/records"
    # the index is small for what it stands for, so its size must not choose the tasks
    n_blocks = listed.agg(F.sum(F.ceil(F.col("n_bytes") / F.lit(BLOCK_BYTES)))).first()[0] or 1
    entries = index(archives).where(F.col("record_type").isin("response", "revisit"))
    block = F.floor(F.col("offset") / F.lit(BLOCK_BYTES)).alias("block")
    blocks = entries.groupBy("archive", block).agg(
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("entries")
    ).repartition(min(n_blocks, MOST_TASKS), "archive", "block")
    schema = RECORDS + (", payload binary" if payloads else "")
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    names = [part.split()[0] for part in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], types.get(n, pa.string())) for i, n in enumerate(names)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _files(place)
        for batch in batches:
            for archive, found in zip(batch.column("archive"), batch.column("entries"), strict=True):
                rows, held = [], 0
                with files.open_input_file(f"{base}/{archive.as_py()}") as source:
                    for entry in found.as_py():
                        source.seek(entry["offset"])
                        rows.append(parsed(source.read(entry["length"])))
                        held += rows[-1][2] if payloads else 200
                        if held >= PIECE * 4:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return blocks.mapInArrow(work, schema)

"""WARC archives: written as one gzip stream a file, normalised to one gzip member a record with an offset index.

Tables are read and shuffled by Spark; the archive files are written and read inside tasks, as streams, through
``pyarrow.fs``, which reaches local and shared folders, HDFS and object stores by their URI. A file is written under a
name of its own and then moved to its final one, so a task that is run again replaces what a lost one left."""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import fresh_dir, materialize
from ..sources.task_files import file_system, qualified

#: Payloads of at least this many bytes are stored once.
LEAST_SHARED = 100
#: Uncompressed bytes after which an archive is closed.
ARCHIVE_BYTES = 1 << 30
CHUNK = 1 << 20
#: Levels of compression of the plain archives and of the members.
PLAIN_LEVEL, MEMBER_LEVEL = 1, 6

# Fixed values of the format.
_VERSION = b"WARC/1.1\r\n"
_IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = 16 + zlib.MAX_WBITS

RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
INDEX = "archive string, offset bigint, length bigint, record_type string, record_id string, uri string"


class _Output:
    """A file that appears under its name only when it is complete."""

    def __init__(self, path: str):
        self.system, self.path = file_system(path)
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.stream = self.system.open_output_stream(self.part, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.system.move(self.part, self.path)


def _one_line(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _head(row: dict, date: str) -> bytes:
    """Header block of a record, blank line included."""
    revisit = row["record_type"] == "revisit"
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", _record_id(row["page_id"], row["digest"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if row["url"] is None else _one_line(row["url"])),
        ("WARC-Payload-Digest", f"sha256:{row['digest']}"),
        ("WARC-Profile", _IDENTICAL if revisit else None),
        ("WARC-Refers-To", _record_id(row["refers_to"], row["digest"]) if revisit else None),
        ("X-Refers-To-Page", row["refers_to"] if revisit else None),
        ("X-Page", row["page_id"]),
        ("X-Payload-Length", row["bytes"]),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", 0 if revisit else row["bytes"]),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return _VERSION + lines.encode() + b"\r\n"


def capture_records(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``bytes``, ``digest``, ``record_type``, ``refers_to`` of each page.

    Of pages with equal payloads of at least ``LEAST_SHARED`` bytes, the rows with the smallest id are responses and
    the others, those without id too, revisit it. If none has an id, all are responses. Payloads are reduced to digests
    before anything is grouped, and joined with one row a digest."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    shared = F.col("bytes") >= LEAST_SHARED
    first = rows.where(shared & F.col("page_id").isNotNull()).groupBy("digest").agg(F.min("page_id").alias("_first"))
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))  # small payloads look nothing up, and spread
    keyed = rows.withColumn("_key", F.when(shared, F.col("digest")).otherwise(alone))
    joined = keyed.join(first.withColumnRenamed("digest", "_key"), "_key", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "bytes", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("_first")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", max_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``capture_records`` rows to archives that are one gzip stream each; (archive, n_records) of every file."""

    folder = qualified(records.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, out = TaskContext.get().partitionId(), 0, None
        done = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if out is None:
                    path = f"{folder}/crawl-{task:06d}-{number:04d}.warc.gz"
                    out, stream, size, n = _Output(path), zlib.compressobj(PLAIN_LEVEL, zlib.DEFLATED, _GZIP), 0, 0
                for data in (_head(row, date), row["payload"] or b"", b"\r\n\r\n"):
                    out.write(stream.compress(data))
                    size += len(data)
                n += 1
                if size >= max_bytes:
                    out.write(stream.flush())
                    out.close()
                    done.append((path, n))
                    out, number = None, number + 1
        if out is not None:
            out.write(stream.flush())
            out.close()
            done.append((path, n))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["archive", "n_records"])

    return materialize(records.mapInArrow(run, "archive string, n_records bigint"), "archives")


class _Inflated:
    """The inflated bytes of a gzip file, of one member or many, read as a stream."""

    def __init__(self, path: str):
        system, name = file_system(path)
        self.path, self.stream = path, system.open_input_stream(name, compression=None)
        self.inflate, self.buffer, self.fresh = zlib.decompressobj(_GZIP), b"", True

    def _more(self) -> bool:
        data = self.inflate.unconsumed_tail or self.stream.read(CHUNK)
        if not data:
            if not self.inflate.eof and not self.fresh:
                raise ValueError(f"{self.path} ends inside a gzip stream")
            return False
        if self.inflate.eof:
            data = self.inflate.unused_data + data
            self.inflate = zlib.decompressobj(_GZIP)
        self.buffer += self.inflate.decompress(data, CHUNK)
        self.fresh = False
        while self.inflate.eof and self.inflate.unused_data:
            rest, self.inflate = self.inflate.unused_data, zlib.decompressobj(_GZIP)
            self.buffer += self.inflate.decompress(rest)
        return True

    def head(self) -> bytes | None:
        """The next header block with its blank line; None at the end."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.buffer:
                    raise ValueError(f"{self.path} ends inside a record header")
                return None
        out, self.buffer = self.buffer[: end + 4], self.buffer[end + 4 :]
        if not out.startswith(b"WARC/"):
            raise ValueError(f"{self.path} has something else than a WARC record")
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.buffer and not self._more():
                raise ValueError(f"{self.path} ends inside a record")
            out, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(out)
            if out:
                yield out


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines) if value}


def normalise_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives (``archive``: paths of gzip files, one stream each or many) with one gzip member a record.

    Each file is inflated once, from its beginning to its end, by one task that holds a few megabytes of it at a time.
    Beside each new archive lies its offset index, ``<archive>.idx``, a line of JSON for each record. Returns the same
    index: ``archive``, ``offset``, ``length``, ``record_type``, ``record_id``, ``uri``. Records come out byte for
    byte. A file that ends early or holds something else raises an error that names it."""

    folder = qualified(archives.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                target = f"{folder}/{path.rpartition('/')[2]}"
                out, index, source = _Output(target), _Output(f"{target}.idx"), _Inflated(path)
                rows = []
                while (head := source.head()) is not None:
                    fields = fields_of(head)
                    member, offset = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, _GZIP), out.size
                    out.write(member.compress(head))
                    for data in source.take(int(fields.get("content-length", "0")) + 4):
                        out.write(member.compress(data))
                    out.write(member.flush())
                    row = dict(archive=target, offset=offset, length=out.size - offset, record_type=fields.get("warc-type"),
                               record_id=fields.get("warc-record-id"), uri=fields.get("warc-target-uri"))
                    index.write(json.dumps(row).encode() + b"\n")
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _rows(rows)
                        rows = []
                out.close()
                index.close()
                yield _rows(rows)

    def _rows(rows: list[dict]) -> pa.RecordBatch:
        kinds = {"offset": pa.int64(), "length": pa.int64()}
        names = ("archive", "offset", "length", "record_type", "record_id", "uri")
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in names], names=list(names))

    files = max(1, archives.count())
    return materialize(archives.select("archive").repartition(files).mapInArrow(run, INDEX), "offsets")


def read_records(index: DataFrame) -> DataFrame:
    """Read records back by their offsets: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Only the members asked for are read. Size and digest of a response are those of the payload found, which have to
    be those in its header; a revisit has them in its header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != opened:
                    system, name = file_system(archive)
                    opened, file = archive, system.open_input_file(name)
                file.seek(offset)
                inflate = zlib.decompressobj(_GZIP)
                record = inflate.decompress(file.read(length))
                end = record.index(b"\r\n\r\n") + 4
                fields = fields_of(record[:end])
                size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
                if not inflate.eof or inflate.unused_data or not record.endswith(b"\r\n\r\n"):
                    raise ValueError(f"{archive} at {offset}: not one whole record")
                if fields["warc-type"] == "response":
                    payload = record[end:-4]
                    if (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"{archive} at {offset}: the payload is not the one that was written")
                page, refers = fields.get("x-page"), fields.get("x-refers-to-page")
                rows.append((page and int(page), size, digest, fields["warc-type"], refers and int(refers)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema=pa.schema(list(zip(
                ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), kinds))))

    return index.mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages (``page_id``, ``url``, ``html``) to plain archives, normalise them, and read all records back.

    One row per page, repeated rows included; a null html is an empty payload, a null url is left out of the record,
    a null id stays null. ``folder`` gets ``plain/`` and ``normal/`` with the archives and their indexes."""
    folder = qualified(pages.sparkSession, folder or fresh_dir(pages.sparkSession, "warc"))
    written = write_archives(capture_records(pages), f"{folder}/plain")
    return read_records(normalise_archives(written, f"{folder}/normal"))

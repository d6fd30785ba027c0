"""WARC archives with dictionary-compressed records.

An archive begins with a skippable frame that holds a Zstandard dictionary, built from the archive's own first
records (at most ``TRAIN_RECORDS`` records and ``TRAIN_BYTES`` bytes, and of a record at most ``TRAIN_RECORD`` bytes: a
sample; records themselves are written whole); every record is then a frame of its own,
compressed with that dictionary, so that any record can be read by its offset. Of records with equal payloads of
at least ``REVISIT_BYTES`` bytes, that with the smallest id is the response and the others are revisits, which
name it and keep no payload.

Each task writes archives of up to ``ARCHIVE_BYTES`` of payload to the shared folder under names of their own
attempt, and returns their names; the table of names is committed by Spark, so an attempt that is lost or
repeated leaves at most files that no name leads to. The driver asks Spark's file systems where the folder really is,
mount tables and default schemes resolved, and gives tasks that place in a form that Arrow opens; a
folder in a store that only one of them reaches is refused before anything is written.

Defined results: a null payload is an empty one; payloads under the least size are all responses; rows that
repeat an id and a payload give one response and revisits that name the same id; a null url is left out of its
record; an empty table gives no archives and no rows; further columns are not read. A record as long as the
whole budget is written by itself.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import arrow_uri
from .common import fresh_path, map_arrow, stage, with_row_id

REVISIT_BYTES = 100
TRAIN_RECORDS, TRAIN_BYTES, TRAIN_RECORD, DICT_BYTES = 400, 2 << 20, 1 << 17, 48 << 10
ARCHIVE_BYTES = 256 << 20
LEVEL = 6
#: The magic number of the dictionary's skippable frame, and of dictionaries.
SKIPPABLE, DICT_MAGIC = 0x184D2A5D, 0xEC30A437
_CRLF = b"\r\n"


def roles(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """(key, url, payload, digest, refers_to): refers_to is the response's id for revisits, else null.

    Digests are counted before the shuffle; the join back is an equi-join on digests that adaptive execution can
    split at a hot one. Of equal smallest ids, the first row by row number is the response.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col("url").cast("string").alias("url"), body.alias("payload"))
    # written, since both the counts and the join back read the row numbers, which could differ if they were computed twice
    rows = stage(with_row_id(rows, "row").withColumn("digest", F.sha2("payload", 256)), "warc-rows")
    first = F.min(F.struct(F.col("key").isNull().alias("n"), "key", "row")).alias("first")
    firsts = rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(first, F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    joined = rows.join(firsts.select(F.col("digest").alias("d"), "first"), rows["digest"] == F.col("d"), "left")
    again = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    return joined.select("key", "row", "url", "payload", "digest", again.alias("again"), F.when(again, F.col("first.key")).alias("refers_to"), F.when(again, F.col("first.row")).alias("refers_row"))


def _name(key: int | None, row: int | None) -> bytes:
    return f"<urn:page:{'null' if key is None else key}:{row}>".encode()


def record(key: int | None, row: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_row: int | None, again: bool) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit without; its name has the row beside the key, which may repeat."""
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if again else b"response"), b"WARC-Record-ID: " + _name(key, row), b"WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(b"WARC-Target-URI: " + url.encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A"))
    head += [b"WARC-Payload-Digest: sha256:" + digest.encode(), b"X-Payload-Length: " + str(len(payload)).encode()]
    if again:
        head += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", b"WARC-Refers-To: " + _name(refers_to, refers_row)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http if again else http + payload
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: " + str(len(body)).encode()]
    return _CRLF.join(head) + _CRLF * 2 + body + _CRLF * 2


def parse_record(raw: bytes) -> dict:
    """The parts of a record; the payload is None for a revisit."""
    head, _, rest = raw.partition(_CRLF * 2)
    fields = dict(line.split(b": ", 1) for line in head.split(_CRLF)[1:])
    again = fields[b"WARC-Type"] == b"revisit"
    size = int(fields[b"Content-Length"])
    if len(rest) != size + 4 or rest[size:] != _CRLF * 2:
        raise ValueError("a record's length is wrong")
    name = lambda k: None if k not in fields or fields[k].startswith(b"<urn:page:null:") else int(fields[k][10:].partition(b":")[0])
    url = fields.get(b"WARC-Target-URI")
    return {
        "key": name(b"WARC-Record-ID"), "url": None if url is None else url.decode(), "type": fields[b"WARC-Type"].decode(), "refers_to": name(b"WARC-Refers-To"), "name": fields[b"WARC-Record-ID"].decode(),
        "digest": fields[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode(), "length": int(fields[b"X-Payload-Length"]), "payload": None if again else rest[:size].partition(_CRLF * 2)[2],
    }


class ArchiveWriter:
    """An archive on a file handle: records wait until the dictionary is built from the first of them."""

    def __init__(self, handle, level: int = LEVEL):
        self.handle, self.level, self.waiting, self.bytes, self.records, self.coder = handle, level, [], 0, 0, None

    def add(self, raw: bytes) -> None:
        self.bytes += len(raw)
        self.records += 1
        if self.coder:
            self.handle.write(self.coder.compress(raw))
            return
        self.waiting.append(raw)
        if len(self.waiting) >= TRAIN_RECORDS or self.bytes >= TRAIN_BYTES:
            self._start()

    def _start(self) -> None:
        samples = [r[:TRAIN_RECORD] for r in self.waiting]
        try:
            words = zstandard.train_dictionary(DICT_BYTES, samples, k=256, d=8, level=self.level)
        except zstandard.ZstdError:  # too few or too small records to train on: they are the dictionary, as raw content
            words = zstandard.ZstdCompressionDict(b"".join(samples)[-DICT_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data = words.as_bytes()
        self.handle.write(struct.pack("<II", SKIPPABLE, len(data)) + data)
        self.coder = zstandard.ZstdCompressor(level=self.level, dict_data=words, write_checksum=True, write_content_size=True)
        for raw in self.waiting:
            self.handle.write(self.coder.compress(raw))
        self.waiting = []

    def close(self) -> None:
        if not self.coder:
            self._start()


def read_records(handle) -> Iterator[bytes]:
    """The records of an archive, each of them decompressed by itself."""
    magic, size = struct.unpack("<II", handle.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame leads the archive")
    data = handle.read(size)
    trained = len(data) >= 4 and struct.unpack("<I", data[:4])[0] == DICT_MAGIC
    words = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
    coder, rest = zstandard.ZstdDecompressor(dict_data=words), b""
    while True:
        part = coder.decompressobj()
        out: list[bytes] = []
        while not part.eof:
            if not rest:
                rest = handle.read(1 << 20)
                if not rest:
                    break
            out.append(part.decompress(rest))
            rest = part.unused_data if part.eof else b""
        if not part.eof:
            if out:
                raise ValueError("the archive is cut off")
            return
        yield b"".join(out)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", payload: str = "html") -> DataFrame:
    """Write ``pages`` as archives in ``folder``, which every executor must reach; the committed (path, records, payload_bytes)."""
    folder = arrow_uri(pages.sparkSession, folder, make=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = FileSystem.from_uri(folder)
        handle = writer = None
        path = ""

        def done() -> pa.RecordBatch:
            writer.close()
            handle.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([writer.records], pa.int64()), pa.array([writer.bytes], pa.int64())], ["path", "records", "bytes"])

        for batch in batches:
            for key, row, url, body, digest, again, refers, refers_row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    handle = fs.open_output_stream(f"{base}/{path.rpartition('/')[2]}", compression=None)  # else Arrow goes by the name and compresses the whole
                    writer = ArchiveWriter(handle)
                writer.add(record(key, row, url, body, digest, refers, refers_row, again))
                if writer.bytes >= ARCHIVE_BYTES:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    rows = roles(pages, key, payload).select("key", "row", "url", "payload", "digest", "again", "refers_to", "refers_row")
    return stage(map_arrow(rows, run, "path string, records long, bytes long"), "warc-names")


def read_archives(names: DataFrame, with_payload: bool = True) -> DataFrame:
    """(key, url, type, digest, length, refers_to[, payload]) of each record in the archives that column ``path`` names.

    A response's digest and length are computed from the payload that was read, and must be the header's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"key": pa.int64(), "url": pa.string(), "type": pa.string(), "digest": pa.string(), "length": pa.int64(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if with_payload else {})

        def packed(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], list(kinds))

        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, base = FileSystem.from_uri(path)
                rows: list[dict] = []
                held = 0
                with fs.open_input_stream(base, compression=None) as handle:
                    for raw in read_records(handle):
                        own = parse_record(raw)
                        if own["payload"] is not None and (hashlib.sha256(own["payload"]).hexdigest(), len(own["payload"])) != (own["digest"], own["length"]):
                            raise ValueError(f"a payload in {path} isn't what its record says")
                        rows.append(own)
                        held += len(raw)
                        if held > 8 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    schema = "key long, url string, type string, digest string, length long, refers_to long" + ", payload binary" * with_payload
    parts = max(1, names.count())  # an archive a task
    return map_arrow(names.select("path").repartition(min(parts, 10_000)), run, schema)


def round_trip(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """Archive ``pages`` in the shared folder and read the records back, without their payloads."""
    names = write_archives(pages, fresh_path(pages.sparkSession, "warc"), key, payload)
    return read_archives(names, with_payload=False)

"""WARC archives: a writer, and a sequential reader (operator 10).

Writer: one gzip member per record, one archive a task, straight into the
shared folder; a task's file has a name of its own, and only files of tasks
that succeeded are in the manifest, so a lost executor leaves at most an
unlisted file.  Of rows with equal payloads of at least ``min_bytes`` that with
the largest id is the ``response``; the others are ``revisit`` records that
name it and carry no payload.  Rows that repeat that largest id with the same
payload are all responses.

Reader: archives are streamed - compressed blocks are inflated incrementally
(zlib), members follow each other, headers end at an empty line, the block
is framed by Content-Length - so memory is bounded by one record.  The SHA-1
of every block and payload is compared with the record's digests; a wrong
digest, a short block or a broken member raises :class:`WarcError`.

Cases: a null or empty payload is a record with an empty payload.  An empty
table gives no archive and no rows.  A null id takes part like others: it is
written as an absent id, and is never the largest unless all are null.  Only
``id_col``, ``uri_col`` and ``payload_col`` are read, so other columns may have
any name.  A URI's line breaks are percent-encoded; a null URI is empty.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stage import new_folder, stage

BLOCK = 1 << 18
BATCH = 1000
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class WarcError(ValueError):
    """An archive that breaks its own framing or digests."""


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ------------------------------------------------------------------ records
def record(page_id: int | None, uri: str, payload: bytes, refers_to: int | None, revisit: bool, payload_digest: str) -> bytes:
    """One record, as one gzip member; the extension field X-Payload-Length has the length of the full payload."""
    block = b"" if revisit else HTTP % len(payload) + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{payload_digest}", f"X-Payload-Length: {len(payload)}",
            f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head[4:4] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class _Inflated:
    """The inflated bytes of a file of gzip members, taken piece by piece."""

    def __init__(self, stream):
        self.stream, self.raw, self.data, self.unpacker = stream, b"", bytearray(), None

    def _more(self) -> bool:
        """Inflate another block; False at the end of the file."""
        if not self.raw:
            self.raw = self.stream.read(BLOCK)
            if not self.raw:
                if self.unpacker is not None:
                    raise WarcError("the file ends inside a gzip member")
                return False
        if self.unpacker is None:
            self.unpacker = zlib.decompressobj(31)
        try:
            self.data += self.unpacker.decompress(self.raw, BLOCK)
        except zlib.error as e:
            raise WarcError(f"broken gzip member: {e}") from e
        if self.unpacker.eof:
            self.raw, self.unpacker = self.unpacker.unused_data, None
        else:
            self.raw = self.unpacker.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        """What comes before ``mark``, which is skipped; empty at the end of the file."""
        seen = 0
        while (at := self.data.find(mark, seen)) < 0:
            seen = max(0, len(self.data) - len(mark) + 1)
            if not self._more():
                if self.data:
                    raise WarcError("the file ends inside a header")
                return b""
        out = bytes(self.data[:at])
        del self.data[: at + len(mark)]
        return out

    def exactly(self, n: int) -> bytes:
        while len(self.data) < n:
            if not self._more():
                raise WarcError(f"the file ends {n - len(self.data)} bytes short")
        out = bytes(self.data[:n])
        del self.data[:n]
        return out


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, payload) of each record; digests are verified."""
    source = _Inflated(stream)
    while head := source.until(b"\r\n\r\n"):
        version, *lines = head.decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise WarcError(f"no WARC record: {version[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        block = source.exactly(int(fields["content-length"]))
        if source.exactly(4) != b"\r\n\r\n":
            raise WarcError("a record's block isn't followed by two line ends")
        payload = block
        if block and fields.get("content-type", "").startswith("application/http"):
            http, _, payload = block.partition(b"\r\n\r\n")
        for name, data in (("warc-block-digest", block), ("warc-payload-digest", payload)):
            said = fields.get(name, "")
            if said.startswith("sha1:") and said[5:] != digest(data) and not (fields["warc-type"] == "revisit" and name == "warc-payload-digest"):
                raise WarcError(f"{name} of {fields.get('warc-record-id')} is wrong")
        yield fields, payload


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


# ------------------------------------------------------------------ Spark jobs
def _write(folder: str):
    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        out, path, n = None, f"{uuid.uuid4().hex}.warc.gz", 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{path}", compression=None)
            for page_id, uri, payload, key, first in zip(*(b.column(c).to_pylist() for c in ("id", "uri", "payload", "sha1", "first_id"))):
                code = base64.b32encode(bytes.fromhex(key)).decode()
                revisit = first is not None and first != page_id
                clean = (uri or "").replace("\r", "%0D").replace("\n", "%0A")
                out.write(record(page_id, clean, payload or b"", first, revisit, code))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})

    return run


def _read(folder: str):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, said in zip(b.column("path").to_pylist(), b.column("records").to_pylist()):
                rows: list[tuple] = []
                seen = 0
                with store.open_input_stream(f"{base}/{path}", compression=None) as stream:
                    for head, payload in read_records(stream):
                        kind = head["warc-type"]
                        size = int(head["x-payload-length"]) if kind == "revisit" else len(payload)
                        rows.append((_page(head["warc-record-id"]), size,
                                     head["warc-payload-digest"].removeprefix("sha1:"), kind, _page(head.get("warc-refers-to"))))
                        seen += 1
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows = []
                if seen != said:
                    raise WarcError(f"{path} has {seen} records, not {said}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, id_col: str = "page_id",
                   uri_col: str = "url", payload_col: str = "html") -> tuple[str, DataFrame]:
    """Write a record per row; the folder and its manifest (path, records).

    Payloads travel only if so many of them repeat that the table of repeated
    digests is beyond Spark's broadcast threshold; the digests are counted in
    a narrow pass before, with partial sums, so a payload of a third of all
    rows is one row a task.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    elif folder.startswith("file:/") and not folder.startswith("file://"):
        folder = f"file://{folder[5:]}"
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    repeated = rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(
        F.max("id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha1", "first_id")
    repeated = stage(repeated, "warc-repeated")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    manifest = rows.join(repeated, "sha1", "left").select("id", "uri", "payload", "sha1", "first_id").mapInArrow(
        _write(folder), "path string, records long")
    return folder, stage(manifest, "warc-manifest")


def read_archives(folder: str, manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, an archive a task.

    A revisit carries no payload; its length is that which the record states.
    """
    return manifest.repartition(max(1, manifest.count())).mapInArrow(_read(folder), READ)


def q_op10(spark, sf_dir: str) -> DataFrame:
    """Contract query: all pages written as archives and read back."""
    folder, manifest = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read_archives(folder, manifest)

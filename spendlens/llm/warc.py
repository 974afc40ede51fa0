"""WARC archives from pages, normalised from one gzip stream a file to one member a record.

Three steps, each a map over files or partitions:

1. ``write_archives``: every task writes its pages as ``response`` records into archives that
   are each ONE gzip stream, and reports a row per record.
2. ``normalise_archives``: a task inflates an archive's stream once, from front to back, and
   rewrites every record as a gzip member of its own, with a sidecar index of offsets. Records
   whose payload another page (of a smaller id) also has become ``revisit`` records, without
   the payload.
3. ``read_archives``: a task opens an archive by its sidecar index and reads record by record.

Which page is the original of a payload is decided in Spark between steps 1 and 2, over the
small report rows (digest, id); payloads are never shuffled. The minimum by digest is
aggregated map-side first, so a payload that a third of all pages share costs one row a task.

Files go to the folder executors share, through pyarrow's file systems, under names made for
the attempt; only the rows of tasks that succeeded name them, so a task that is lost or run
twice leaves at most an unreferenced file. An archive holds at most ``ARCHIVE_BYTES`` before
compression (or one larger record) and ``ARCHIVE_RECORDS`` records.

Defined results: a null payload is empty; a null url has no target header; equal payloads of
at least ``MIN_REVISIT_BYTES`` refer to the smallest id, rows of that id itself all stay
responses; a null id is never referred to and its record stays a response; a very long payload
is a record in memory of one task; an empty table writes no archive; columns other than the three
named are not written, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from functools import partial
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import bounded_batches, rows, written

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
ARCHIVE_RECORDS = 20_000
#: archives of a task, where there are many
TASK_ARCHIVES = 16
CHUNK = 1 << 20
GZIP_LEVEL = 5
GZIP_BITS = 31
#: the date of every record (archives are a function of the pages alone)
RECORD_DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(id_) -> str:
    return "<urn:page:" + ("" if id_ is None else str(id_)) + ">"


def _id_of(record_id: str) -> str | None:
    return record_id[len("<urn:page:") : -1] or None


def http_head(payload_bytes: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % payload_bytes


def warc_record(headers: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def response_record(id_, url: str | None, payload: bytes, digest: str) -> bytes:
    headers = {"WARC-Type": "response", "WARC-Record-ID": _record_id(id_), "WARC-Date": RECORD_DATE}
    if url is not None:
        headers["WARC-Target-URI"] = quote(url, safe="%/:=&?~#+!$,;'@()*[]")
    headers["WARC-Payload-Digest"] = f"sha256:{digest}"
    headers["Content-Type"] = "application/http; msgtype=response"
    return warc_record(headers, http_head(len(payload)) + payload)


def revisit_of(record: Record, refers_to: str) -> bytes:
    """The revisit form of a response record: its headers and HTTP head, not its payload."""
    headers = {k: v for k, v in record.headers.items() if k != "Content-Length"}
    headers |= {"WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _record_id(refers_to)}
    return warc_record(headers, record.block[: record.block.index(b"\r\n\r\n") + 4])


class Record:
    """One parsed record: ``headers``, ``block``, and the bytes it was parsed from."""

    def __init__(self, raw: bytes, head_end: int):
        self.raw = raw
        lines = raw[:head_end].decode("utf-8").split("\r\n")
        self.headers = dict(x.split(": ", 1) for x in lines[1:])
        self.block = raw[head_end + 4 : -4]

    @property
    def payload(self) -> bytes:
        return self.block[self.block.index(b"\r\n\r\n") + 4 :]


def _inflated(stream, bits: int = GZIP_BITS):
    """The bytes of a gzip stream in chunks; a file of several members is read member by member."""
    inflate = zlib.decompressobj(bits)
    while data := stream.read(CHUNK):
        while data:
            yield inflate.decompress(data)
            data = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(bits)
    yield inflate.flush()


def parse_records(chunks):
    """Records from the chunks of an inflated archive, holding one record (and a chunk) at a time."""
    buffer, need = bytearray(), 0
    for chunk in chunks:
        buffer += chunk
        while len(buffer) >= need:
            head_end = buffer.find(b"\r\n\r\n")
            if head_end < 0:
                break
            at = buffer.find(b"\r\nContent-Length: ", 0, head_end + 2)
            length = int(buffer[at + 18 : buffer.find(b"\r\n", at + 18)])
            need = head_end + 4 + length + 4
            if len(buffer) < need:
                break
            yield Record(bytes(buffer[:need]), head_end)
            del buffer[:need]
            need = 0
    if buffer:
        raise ValueError(f"archive ends within a record: {len(buffer)} bytes left")


def _place(uri: str):
    """File system and path of a place in the shared folder."""
    return pafs.FileSystem.from_uri(uri)


class _Archive:
    """An archive being written: one gzip stream."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        fs, path = _place(self.uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path, compression=None)
        self.gzip = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, GZIP_BITS)
        self.records = self.bytes = 0

    def add(self, record: bytes) -> int:
        self.out.write(self.gzip.compress(record))
        self.bytes += len(record)
        self.records += 1
        return self.records - 1

    def close(self) -> None:
        self.out.write(self.gzip.flush())
        self.out.close()


def _write(folder, most_bytes, most_records, batches):
    archive = None
    for b in batches:
        id_, url, payload = (b.column(c).to_pylist() for c in ("_id", "_url", "_payload"))
        if not id_:
            continue
        report = []
        for i, u, p in zip(id_, url, payload):
            digest = hashlib.sha256(p).hexdigest()
            record = response_record(i, u, p, digest)
            if archive and (archive.bytes + len(record) > most_bytes or archive.records >= most_records):
                archive.close()
                archive = None
            archive = archive or _Archive(folder)
            seq = archive.add(record)
            report.append((archive.uri, seq, digest, len(p)))
        uri, seq, digest, size = zip(*report)
        yield pa.RecordBatch.from_arrays(
            [pa.array(uri), pa.array(seq, pa.int32()), b.column("_id"), pa.array(digest), pa.array(size, pa.int64())],
            ["archive", "seq", "_id", "digest", "bytes"],
        )
    if archive:
        archive.close()


def write_archives(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
    archive_records: int = ARCHIVE_RECORDS,
) -> DataFrame:
    """Write every page as a response record; one row (archive, seq, _id, digest, bytes) each."""
    bounded_batches(pages.sparkSession)
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    base = pages.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{url_col}`").cast("string").alias("_url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b"")).alias("_payload"),
    )
    id_type = base.schema["_id"].dataType.simpleString()
    schema = f"archive string, seq int, _id {id_type}, digest string, bytes bigint"
    return written(base.mapInArrow(partial(_write, folder, archive_bytes, archive_records), schema), "warc-report")


def revisits(report: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Per archive: which of its records revisit a page, and which (at most one row a record)."""
    large = report.where(F.col("bytes") >= min_bytes)
    owners = (
        large.groupBy("digest")
        .agg(F.min("_id").alias("owner"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "owner")
    )
    found = large.join(owners, "digest").where(F.col("_id") > F.col("owner"))
    return found.groupBy("archive").agg(
        F.collect_list(F.struct("seq", F.col("owner").cast("string").alias("owner"))).alias("revisits")
    )


def _normalise(batches):
    for archive, revisit in rows(batches, "archive", "revisits"):
        out_uri, index_uri, members = [], [], []
        for uri, again in zip(archive, revisit):
            stem = uri.removesuffix(".warc.gz") + "-" + uuid.uuid4().hex
            n = normalise(uri, f"{stem}.warc.gz", f"{stem}.index", {x["seq"]: x["owner"] for x in again or ()})
            out_uri.append(f"{stem}.warc.gz")
            index_uri.append(f"{stem}.index")
            members.append(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_uri), pa.array(index_uri), pa.array(members, pa.int64())], ["archive", "index", "members"]
        )


def normalise(uri: str, out_uri: str, index_uri: str, again: dict[int, str]) -> int:
    """Rewrite an archive with a gzip member for each record, and its offset index.

    The index has one JSON object a line: offset, length, id and type. ``again``: the records
    (by their place) that become revisits, and the id each refers to. Returns the number of records.
    """
    fs, path = _place(uri)
    out_fs, out_path = _place(out_uri)
    index_fs, index_path = _place(index_uri)
    offset = n = 0
    with (
        fs.open_input_stream(path, compression=None) as stream,
        out_fs.open_output_stream(out_path, compression=None) as out,
        index_fs.open_output_stream(index_path, compression=None) as index,
    ):
        for n, record in enumerate(parse_records(_inflated(stream)), 1):
            raw = revisit_of(record, again[n - 1]) if n - 1 in again else record.raw
            gzip = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, GZIP_BITS)
            member = gzip.compress(raw) + gzip.flush()
            out.write(member)
            line = {
                "offset": offset,
                "length": len(member),
                "id": record.headers["WARC-Record-ID"],
                "type": "revisit" if n - 1 in again else "response",
            }
            index.write(json.dumps(line).encode() + b"\n")
            offset += len(member)
    return n


def _per_file(df: DataFrame, files: int) -> DataFrame:
    """A few archives (rows) a task: one each while that keeps the cores busy, then up to ``TASK_ARCHIVES``, so a
    task handles a gigabyte and their number stays that of gigabytes. A task holds one record at a time."""
    busy = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(files, max(busy, -(-files // TASK_ARCHIVES)))))


def normalise_archives(report: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Normalise the archives that ``report`` names: (archive, index, members) of each."""
    archives = report.select("archive").distinct()
    work = written(archives.join(revisits(report, min_bytes), "archive", "left"), "warc-work")
    out = _per_file(work, work.count()).mapInArrow(_normalise, "archive string, index string, members bigint")
    return written(out, "warc-normalised")


def _read(batches):
    for archive, index in rows(batches, "archive", "index"):
        for uri, index_uri in zip(archive, index):
            fs, path = _place(uri)
            index_fs, index_path = _place(index_uri)
            with index_fs.open_input_stream(index_path, compression=None) as f:
                lines = [json.loads(x) for x in f.read().splitlines()]
            out: list[tuple] = []
            with fs.open_input_file(path) as f:
                for at in lines:
                    raw = zlib.decompress(f.read_at(at["length"], at["offset"]), GZIP_BITS)
                    out.append(_describe(Record(raw, raw.index(b"\r\n\r\n"))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )


def _describe(record: Record) -> tuple:
    kind, headers = record.headers["WARC-Type"], record.headers
    id_ = _id_of(headers["WARC-Record-ID"])
    if kind == "response":
        payload = record.payload
        return id_, len(payload), hashlib.sha256(payload).hexdigest(), kind, None
    head = dict(x.split(": ", 1) for x in record.block.decode().split("\r\n")[1:] if x)
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    return id_, int(head["Content-Length"]), digest, kind, _id_of(headers["WARC-Refers-To"])


def read_archives(normalised: DataFrame) -> DataFrame:
    """Every record of the archives, read by their indexes: id, payload_bytes, payload_digest,
    record_type, refers_to (ids as strings). A response's figures come from its payload, a
    revisit's from its headers."""
    schema = "id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"
    return _per_file(normalised, normalised.count()).mapInArrow(_read, schema)

"""WARC archives, with a normaliser for monolithic gzip files.

1. Crawled rows are written as records into monolithic files, each one gzip stream, with all payloads; each record's place
   and digests go to a table.
2. Of records with equal payloads the one with the largest page_id is to stay a response, the others revisit it: decided over
   digests alone, pre-aggregated before the shuffle; no payload moves.
3. The normaliser inflates a monolithic stream once, rewrites every record as a gzip member of its own (revisits without
   their payload, with the response's record id), and writes a sidecar index beside the archive: a JSON line for each record
   with its id, page, URL, digest, offset and length. The monolithic file goes.
4. Archives are read back through their indices, a member at a time.

Files are put in place by a rename, under names that a repeated task repeats, so a lost executor leaves no half file.

Defined results: a null html is an empty payload; a null page_id or url is left out of the headers (control characters in a url
are percent-encoded) and comes back null, and counts below all others; rows alike in page_id and payload are records of their
own, with ids of their own, of which one is the response; a stream that ends early is an error; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from itertools import groupby

import pyarrow as pa
from pyarrow import fs as afs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import materialise, shared_dir, tidy

WRITTEN = "file string, ordinal long, page_id long, payload_bytes long, sha1 string, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, archive string, offset long"
DATE = "2024-01-01T00:00:00Z"


def _headers(pairs) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs if v is not None).encode()


def record_id(file: str, ordinal: int) -> str:
    """The id of the record that is written at this place: another for each, and the same if a task is repeated."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{ordinal}')}>"


def record(kind: str, name: str, page_id, url, payload: bytes, digest: str, size: int, refers_to: tuple[str, int | None] | None = None) -> bytes:
    """A WARC record. A revisit holds the HTTP headers of its payload, and not the payload; refers_to: the response's id and page."""
    http = b"HTTP/1.1 200 OK\r\n" + _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", size)]) + b"\r\n"
    block = http + (payload if kind == "response" else b"")
    safe = None if url is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    other, page = refers_to or (None, None)
    return b"WARC/1.1\r\n" + _headers([
        ("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", safe), ("WARC-Page-ID", page_id),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", other), ("WARC-Refers-To-Page-ID", page),
        ("WARC-Profile", None if kind == "response" else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block)),
    ]) + b"\r\n" + block + b"\r\n\r\n"


def parse_headers(raw: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in raw.decode().split("\r\n") if ": " in line)


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """A record's WARC headers, its HTTP headers and its payload."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    headers = parse_headers(head)
    http, payload = rest[: int(headers["Content-Length"])].split(b"\r\n\r\n", 1)
    return headers, parse_headers(http), payload


def split_stream(chunks):
    """Yields the raw records of an inflated stream, whatever its chunks."""
    held, need = bytearray(), 0
    for chunk in chunks:
        held += chunk
        while True:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(parse_headers(bytes(held[:end]))["Content-Length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError("the stream ends inside a record")


def inflate(source, size: int = 1 << 20):
    """The content of a gzip file, of one member or many, read once, in pieces of ``size`` bytes at most."""
    engine, begun = zlib.decompressobj(31), False
    while chunk := source.read(size):
        while chunk:
            begun = True
            yield engine.decompress(chunk, size)
            chunk = engine.unconsumed_tail
            if engine.eof:
                chunk, engine, begun = engine.unused_data, zlib.decompressobj(31), False
    if begun and (tail := engine.flush()):
        yield tail
    if begun and not engine.eof:
        raise ValueError("the stream ends inside a member")


def member(raw: bytes, level: int = 4) -> bytes:
    engine = zlib.compressobj(level, zlib.DEFLATED, 31)
    return engine.compress(raw) + engine.flush()


def _put(root: str, name: str, write) -> None:
    store, path = afs.FileSystem.from_uri(root)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own, compression=None) as out:
        write(out)
    store.move(own, f"{path}/{name}")


def _write(root: str, most: int):
    """Rows (page_id, url, html) to monolithic files of about ``most`` payload bytes, and a row for each record."""
    from pyspark import TaskContext

    names = ["file", "ordinal", "page_id", "payload_bytes", "sha1", "sha256"]

    @tidy
    def run(batches):
        part, count = TaskContext.get().partitionId(), 0
        store, path = afs.FileSystem.from_uri(root)
        out = engine = own = name = None
        rows, size = [], 0

        def close():
            out.write(engine.flush())
            out.close()
            store.move(own, f"{path}/{name}")
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()], strict=True)], names)

        for batch in batches:
            for page, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if out is None:
                    name = f"part-{part:06d}-{count:06d}.whole.warc.gz"
                    own, count = f"{path}/.{name}.{uuid.uuid4().hex}", count + 1
                    out, engine = store.open_output_stream(own, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31)
                payload = html or b""
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                raw = record("response", record_id(name, len(rows)), page, url, payload, digest, len(payload))
                out.write(engine.compress(raw))
                rows.append((name, len(rows), page, len(payload), digest, hashlib.sha256(payload).hexdigest()))
                size += len(raw)
                if size >= most:
                    yield close()
                    out, rows, size = None, [], 0
        if out is not None:
            yield close()

    return run


def normalise(source, decisions, out):
    """Rewrite a monolithic stream record by record; yields what the index says of each.

    decisions: for the records in order, whether it is a response or a revisit, and the record id and page that it refers to.
    """
    at = 0
    for raw, (kind, refers, refers_page) in zip(split_stream(inflate(source)), decisions, strict=True):
        headers, http, payload = parse(raw)
        name, page, url, digest = (headers.get(f"WARC-{x}") for x in ("Record-ID", "Page-ID", "Target-URI", "Payload-Digest"))
        if kind == "revisit":
            raw = record(kind, name, page, url, b"", digest[5:], int(http["Content-Length"]), (refers, refers_page))
        done = member(raw)
        out.write(done)
        yield {"record": name, "type": kind, "page": None if page is None else int(page), "url": url, "digest": digest, "offset": at, "length": len(done)}
        at += len(done)


def _normalise(root: str):
    """Rows (file, ordinal, record_type, refers_file, refers_ordinal, refers_to) in order of file and ordinal to a row for each archive."""

    @tidy
    def run(batches):
        store, path = afs.FileSystem.from_uri(root)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for name, mine in groupby(rows, key=lambda r: r[0]):
            target, found = name.replace(".whole.warc.gz", ".warc.gz"), []
            decisions = ((kind, None if file is None else record_id(file, ordinal), page) for _, _, kind, file, ordinal, page in mine)
            with store.open_input_stream(f"{path}/{name}", compression=None) as source:
                _put(root, target, lambda out: found.extend(json.dumps(x) for x in normalise(source, decisions, out)))  # noqa: B023
            _put(root, f"{target}.index", lambda out: out.write("".join(x + "\n" for x in found).encode()))  # noqa: B023
            yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([name]), pa.array([len(found)], pa.int64())], ["archive", "whole", "records"])

    return run


def _delete(root: str):
    def run(batches):
        store, path = afs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if store.get_file_info(f"{path}/{name}").type != afs.FileType.NotFound:
                    store.delete_file(f"{path}/{name}")
            yield batch

    return run


def read_index(store, path: str) -> list[dict]:
    with store.open_input_stream(f"{path}.index", compression=None) as f:
        return [json.loads(x) for x in f.read().decode().splitlines()]


def read_member(source, offset: int, length: int):
    source.seek(offset)
    return parse(zlib.decompress(source.read(length), 31))


def _read(root: str):
    """Archive names to the records they hold, found through the sidecar indices."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "archive", "offset"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64()]

    @tidy
    def run(batches):
        store, path = afs.FileSystem.from_uri(root)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                index = read_index(store, f"{path}/{archive}")
                out, size = [], 0
                with store.open_input_file(f"{path}/{archive}") as source:
                    for one in index:
                        headers, http, payload = read_member(source, one["offset"], one["length"])
                        kind, refers, page = headers["WARC-Type"], headers.get("WARC-Refers-To-Page-ID"), headers.get("WARC-Page-ID")
                        digest = headers["WARC-Payload-Digest"][5:]
                        if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"{archive} at {one['offset']}: the payload isn't what its digest says")
                        out.append((None if page is None else int(page), headers.get("WARC-Target-URI"), int(http["Content-Length"]), digest, kind, None if refers is None else int(refers), payload, archive, one["offset"]))
                        size += len(payload) + 500
                        if size > 16_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return run


def archive(pages: DataFrame, at_least: int = 0, file_bytes: int = 64 << 20, root: str | None = None) -> DataFrame:
    """Write pages (page_id, url, html) as normalised WARC archives with sidecar indices, and read them back.

    at_least: payloads of fewer bytes are all responses. root: the folder of the archives, by default a new one in the
    shared folder. Each returned row is a record of an archive.
    """
    spark = pages.sparkSession
    root = root or f"{shared_dir(spark)}/scriptorium/warc-{uuid.uuid4().hex}"
    store, path = afs.FileSystem.from_uri(root)
    store.create_dir(path, recursive=True)
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("binary").alias("html"))
    rows = materialise(source.mapInArrow(_write(root, file_bytes), WRITTEN), "records")
    # The response of equal payloads: the largest page_id, and of rows with the same one, one.
    by = ["sha256", "payload_bytes"]
    top = rows.where(F.col("payload_bytes") >= at_least).groupBy(*by).agg(F.max(F.struct("page_id", "file", "ordinal")).alias("top"))
    alone = F.col("top").isNull() | ((F.col("top.file") == F.col("file")) & (F.col("top.ordinal") == F.col("ordinal")))
    refers = [F.when(~alone, F.col(f"top.{c}")).alias(f"refers_{c}") for c in ("file", "ordinal", "page_id")]
    decided = rows.join(top, by, "left").select("file", "ordinal", F.when(alone, "response").otherwise("revisit").alias("record_type"), *refers)
    # Whole files go to a task, which streams through them beside the sorted rows that tell what becomes of their records.
    files = max(1, rows.select("file").distinct().count())
    archives = decided.repartition(files, "file").sortWithinPartitions("file", "ordinal").mapInArrow(_normalise(root), "archive string, whole string, records long")
    archives = materialise(archives, "archives", instead_of=(rows,))
    archives.select("whole").mapInArrow(_delete(root), "whole string").write.format("noop").mode("overwrite").save()
    n = max(1, min(archives.count(), 10_000))
    return archives.select("archive").repartition(n).mapInArrow(_read(root), RECORDS)

"""WARC (operator 4): a deterministic sharded archive writer and its reader.

Records are range-partitioned and sorted by id, so equal input gives equal
shards.  A task writes its records one gzip member each and rolls to a new file
when the compressed size passes the limit.  Files appear under names of the
attempt that wrote them; the rows that Spark collects from the successful
attempts say which files count, these are renamed, and a manifest with sizes
and SHA-256 sums makes the archive valid.  Headers, record ids and digests are
made anew from the payload.

The folder is a URI that pyarrow's filesystems can open on every executor (the
default lies in the folder ``spark.checkpoint.dir`` names); input comes through Spark.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import new_path, parts_for, skew_join, written

ROLL_BYTES = 64 << 20
MIN_REVISIT = 100                     # payload bytes from which equal payloads are revisits
DATE = "1970-01-01T00:00:00Z"         # pages carry no time; one date keeps archives equal
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str):
    """(filesystem, path) of a URI or absolute path."""
    from pyarrow import fs
    if re.match(r"(file:)?/", uri):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _header(pairs) -> bytes:
    clean = [(k, re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", str(v))) for k, v in pairs if v is not None]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in clean) + "\r\n").encode()


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One record; a revisit holds the HTTP header, whose Content-Length is the payload's, and no payload."""
    digest = hashlib.sha256(payload).hexdigest()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    if not revisit:
        block += payload
    return _header([
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE),
        ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("WARC-Refers-To", record_id(refers_to, digest) if revisit else None), ("WARC-Profile", PROFILE if revisit else None),
        ("X-Page-Id", page_id), ("X-Refers-To-Page-Id", refers_to),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]) + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without time or name."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _info(name: str) -> bytes:
    block = b"software: lakecube\r\nformat: WARC File Format 1.1\r\n"
    return member(_header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
                           ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                           ("Content-Length", len(block))]) + block + b"\r\n\r\n")


MANIFEST = "part int, file string, temporary string, records long, bytes long, sha256 string"


def _write(batches: Iterator[pa.RecordBatch], folder: str, roll: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    ctx = TaskContext.get()
    part, attempt = ctx.partitionId(), ctx.taskAttemptId()
    fs, root = filesystem(folder)
    out, name, temp, records, size, sha, number = None, "", "", 0, 0, None, 0
    rows = []

    def close():
        nonlocal out
        if out is not None:
            out.close()
            rows.append((part, name, temp, records, size, sha.hexdigest()))
            out = None

    notes: dict[bytes, object] = {}             # of the id that comes next: payload digest -> original
    of = None
    for batch in batches:
        for page_id, kind, url, html, refers in zip(*(c.to_pylist() for c in batch.columns)):
            if page_id != of:
                notes, of = {}, page_id
            if kind == 0:                       # sorts before the records it speaks of
                notes[html] = refers
                continue
            to = notes.get(hashlib.sha256(html or b"").digest()) if notes else None
            if out is None:
                name, temp = f"pages-{part:05d}-{number:04d}.warc.gz", f"_attempts/{part:05d}-{attempt}-{number:04d}"
                number, records, size, sha = number + 1, 0, 0, hashlib.sha256()
                fs.create_dir(f"{root}/_attempts", recursive=True)
                out = fs.open_output_stream(f"{root}/{temp}", compression=None)
                first = _info(name)
                out.write(first)
                sha.update(first)
                size += len(first)
            data = member(record(page_id, url, html or b"", to))
            out.write(data)
            sha.update(data)
            size, records = size + len(data), records + 1
            if size >= roll:
                close()
    close()
    cols = list(zip(*rows)) if rows else [[]] * 6
    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                     names=["part", "file", "temporary", "records", "bytes", "sha256"])


def _commit(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileType
    fs, root = filesystem(folder)
    for batch in batches:
        for file, temp in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if fs.get_file_info(f"{root}/{temp}").type == FileType.File:       # else renamed by an earlier attempt
                fs.move(f"{root}/{temp}", f"{root}/{file}")
        yield batch


def duplicates(pages: DataFrame, id_col: str, html: str, least: int = MIN_REVISIT) -> tuple[DataFrame, int]:
    """(id, digest, refers_to) of the records that repeat a payload of a smaller id; the payload bytes of all."""
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    digests = written(pages.select(F.col(id_col).alias("id"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"),
                                   F.octet_length(body).cast("long").alias("size")), "digests")
    stats = digests.agg(F.sum("size"), F.count(F.lit(1))).first()
    long = digests.filter(F.col("size") >= least)
    twice = long.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return (skew_join(long, twice, ["digest"], "n", max(1, stats[1])).filter("id > refers_to")
            .select("id", "digest", "refers_to").distinct()), stats[0] or 0


def write_archive(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  roll: int = ROLL_BYTES, least: int = MIN_REVISIT) -> tuple[str, DataFrame]:
    """Write one record per row of ``pages``; returns the folder and the manifest.

    Of records with equal payloads of ``least`` bytes or more, that with the
    smallest id is a response and the others are revisits of it.

    Defined cases: a null html is an empty payload, a null url writes no target; a row with a null id is a
    response and no other record's original; rows that share an id are records of their own, all
    responses when the id is the smallest; an empty table gives an archive of no files;
    further columns are not written.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    repeats, total = duplicates(pages, id_col, html_col, least)
    kind = pages.schema[id_col].dataType
    rows = pages.select(F.col(id_col).alias("id"), F.lit(1).alias("kind"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").cast("binary").alias("html"), F.lit(None).cast(kind).alias("refers_to"))
    notes = written(repeats, "revisits").select("id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                                                F.col("digest").alias("html"), "refers_to")
    # One shuffle brings a revisit's note and its record together, in the archive's order.
    ordered = (rows.unionByName(notes).repartitionByRange(parts_for(spark, total, 64 << 20), "id")
               .sortWithinPartitions("id", "kind", F.sha2(F.coalesce("html", F.lit(b"")), 256), "url"))
    manifest = written(ordered.mapInArrow(lambda it: _write(it, folder, roll), MANIFEST), "manifest")
    # The successful attempts' files get their names; then the manifest makes the archive valid.
    manifest.repartition(max(1, manifest.count() // 16)).mapInArrow(lambda it: _commit(it, folder), MANIFEST).drop("temporary").write.parquet(f"{folder}/manifest.parquet")
    return folder, spark.read.parquet(f"{folder}/manifest.parquet")


def members(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, one after the other."""
    z, out, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(step)
        rest = b""
        if not data:
            if out:
                raise ValueError("a gzip member is cut off")
            return
        out.append(z.decompress(data))
        if z.eof:
            yield b"".join(out)
            rest, z, out = z.unused_data, zlib.decompressobj(31), []


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    return headers, rest[:int(headers["Content-Length"])]


RECORD = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def _read(batches: Iterator[pa.RecordBatch], folder: str, payload: bool) -> Iterator[pa.RecordBatch]:
    fs, root = filesystem(folder)
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.binary()] * payload]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payload]

    def flush(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for file in batch.column(0).to_pylist():
            rows, held = [], 0
            with fs.open_input_stream(f"{root}/{file}", compression=None) as stream:
                for data in members(stream):
                    headers, block = parse(data)
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                        raise ValueError(f"{file}: a block's digest is not the one in its header")
                    http, _, body = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    if headers["WARC-Type"] == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
                        raise ValueError(f"{file}: a payload is not the one in its header")
                    rows.append((headers.get("X-Page-Id") if headers.get("X-Page-Id") != "None" else None, headers.get("WARC-Target-URI"),
                                 size, digest, headers["WARC-Type"], headers.get("X-Refers-To-Page-Id"), *[body] * payload))
                    held += len(body) * payload + 200
                    if held > 8 << 20:
                        yield flush(rows)
                        rows, held = [], 0
            if rows:
                yield flush(rows)


def read_archive(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """The records of an archive's manifest; every digest is checked against its bytes.  ``payload`` adds a
    response's payload (a revisit's is empty: it is its original's)."""
    files = spark.read.parquet(f"{folder}/manifest.parquet").select("file")
    n = files.count()
    return (files.repartition(max(1, n)).mapInArrow(lambda it: _read(it, folder, payload), RECORD + (", payload binary" if payload else "")))

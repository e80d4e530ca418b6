"""WARC archives as a chunked record table.

Payloads travel as (record, chunk number) rows, to the writer and from the reader, so that neither holds
a whole record. Digests are carried along from chunk to chunk. Each task writes archive files of its own
below the shared folder; only files named in the manifest of successful tasks count.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import map_rows, shuffle_width, written
from statlake.session import work_dir

CHUNK_BYTES = 256 << 10
ROLL_BYTES = 128 << 20
_NEW_LINE = b"\r\n"


def _store(uri: str):
    """File system and path; any store that pyarrow reaches (file, HDFS, object stores)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else os.path.abspath(uri))


def decide(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload, payload_bytes, digest, refers_to).

    Of records with equal payloads of ``least_bytes`` or more the one of largest page_id is kept; the
    others refer to it. Rows without page_id are always kept. Rows that repeat that page_id are each kept.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digests = rows.select(
        "page_id", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("digest")
    )
    large = digests.filter((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
    groups = (
        large.groupBy("digest", "payload_bytes")
        .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
        .filter("least < refers_to")
    )
    revisits = (
        large.join(groups, ["digest", "payload_bytes"])
        .filter("page_id < refers_to")
        .select("page_id", "digest", "payload_bytes", "refers_to")
        .distinct()
    )
    return (
        rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
        .withColumn("digest", F.sha1("payload"))
        .repartition(shuffle_width(rows), "page_id", "digest", "payload_bytes")
        .join(revisits, ["page_id", "digest", "payload_bytes"], "left")
    )


def chunks(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk, chunks of a record in order and together; revisits have one empty chunk."""
    parts = F.when(F.col("refers_to").isNotNull(), F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil(F.col("payload_bytes") / chunk_bytes))
    )
    numbered = records.select("*", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))).alias("chunk_no"))
    body = F.when(F.col("refers_to").isNull(), F.col("payload").substr(F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)))
    return numbered.select(
        "page_id", "url", "payload_bytes", "digest", "refers_to", "chunk_no",
        (F.col("chunk_no") == parts - 1).alias("last"), body.alias("chunk"),
    )


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _header(page_id, url, size: int, digest: str, refers_to) -> bytes:
    """WARC and HTTP headers. A revisit keeps the HTTP header, which names the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", " ".join((url or "urn:none").split())),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
    ]
    if revisit:
        fields.append(("WARC-Refers-To", _urn(refers_to)))
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    fields.append(("Content-Length", str(len(http) + (0 if revisit else size))))
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields), "", ""]
    return "\r\n".join(lines).encode() + http


def write(chunk_rows: DataFrame, folder: str, level: int = 1, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Archives below ``folder``; returns their manifest (file, records, bytes), itself a written table."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        out, name, records, size, member = None, "", 0, 0, None
        for page_id, url, payload_bytes, digest, refers_to, chunk_no, last, chunk in rows:
            if chunk_no == 0:
                if out is not None and size >= roll_bytes:
                    out.close()
                    yield name, records, size
                    out = None
                if out is None:
                    name, records, size = f"{folder}/part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    fs, path = _store(name)
                    fs.create_dir(os.path.dirname(path), recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                member = zlib.compressobj(level, zlib.DEFLATED, 31)
                size += out.write(member.compress(_header(page_id, url, payload_bytes, digest, refers_to)))
            if chunk:
                size += out.write(member.compress(chunk))
            if last:
                size += out.write(member.compress(_NEW_LINE * 2) + member.flush())
                records += 1
        if out is not None:
            out.close()
            yield name, records, size

    return written(map_rows(chunk_rows, run, "file string, records bigint, bytes bigint", 16), "warc-manifest")


def read(manifest: DataFrame, payload: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The archives as chunk rows.

    (page_id, record_type, refers_to, chunk_no, last, chunk, bytes_so_far, digest_so_far). A response's
    digest is computed from its chunks; on the last one it is that of the payload and must equal the one
    in the header. A revisit has one row with the header's length and digest. Without ``payload``
    ``chunk`` is null and only the last row of each record is given.
    """

    def records(raw) -> Iterator[tuple]:
        while line := raw.readline():
            if not line.strip():
                continue
            fields = _fields(raw)
            http = b"".join(iter(raw.readline, b"\r\n"))
            length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length"))
            digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
            page_id, kind = _page(fields["warc-record-id"]), fields["warc-type"]
            if kind == "revisit":
                yield page_id, kind, _page(fields["warc-refers-to"]), 0, True, None, length, digest
                continue
            running, done, chunk_no = hashlib.sha1(), 0, 0
            while True:
                chunk = raw.read(min(chunk_bytes, length - done))
                if len(chunk) < min(chunk_bytes, length - done):
                    raise ValueError(f"record {page_id} is cut off")
                running.update(chunk)
                done += len(chunk)
                last = done == length
                if last and running.hexdigest() != digest:
                    raise ValueError(f"record {page_id} differs from its digest")
                if payload or last:
                    yield page_id, kind, None, chunk_no, last, chunk if payload else None, done, running.hexdigest()
                chunk_no += 1
                if last:
                    break

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for (name,) in rows:
            fs, path = _store(name)
            with fs.open_input_stream(path, compression=None, buffer_size=1 << 20) as stream:
                yield from records(gzip.GzipFile(fileobj=stream))

    schema = "page_id bigint, record_type string, refers_to bigint, chunk_no int, last boolean, chunk binary, bytes_so_far bigint, digest_so_far string"
    files = manifest.select("file").repartition(shuffle_width(manifest))
    return map_rows(files, run, schema, 64 if payload else 4096)


def _fields(raw) -> dict[str, str]:
    found = {}
    while (line := raw.readline().rstrip(_NEW_LINE)):
        name, _, value = line.decode().partition(":")
        found[name.lower()] = value.strip()
    return found


def _page(urn: str) -> int | None:
    value = urn.strip("<>").rpartition(":")[2]
    return None if value == "none" else int(value)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes an archive record per page row, reads the archives back and describes each record.

    page_id, payload_bytes, payload_digest, record_type, refers_to. A null html is an empty payload;
    repeated rows are separate records; an empty table gives no archive and no rows.
    """
    folder = folder or work_dir(pages.sparkSession, "warc")
    manifest = write(chunks(decide(pages)), folder)
    return (
        read(manifest, payload=False)
        .filter("last")
        .select(
            "page_id",
            F.col("bytes_so_far").alias("payload_bytes"),
            F.col("digest_so_far").alias("payload_digest"),
            "record_type",
            "refers_to",
        )
    )

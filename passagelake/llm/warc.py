"""Deduplicated WARC archives: revisit records for payloads seen before.

Headers (page_id, digest, size) are shuffled by payload digest alone; of records with equal
payloads of at least ``least_bytes`` bytes the smallest page_id is the original.  Pages
then meet the originals that more than one page shares by an equi-join on the digest, whose hot
keys Spark splits, and each task writes its rows as archives with fresh headers: one
gzip member per record, so that any record can be read alone.  A revisit record has no
payload and names its original.  Each archive is written under a name of the attempt
and renamed when whole, so a task that runs again leaves one file.

Reading streams the members of each archive and joins revisit records to the
response records they refer to.

Null html is an empty payload.  Rows with a null page_id are never an original of others
unless they are alone, and are written as responses.  Rows that repeat both the page_id and the payload
of an original are written as responses like it.  A null url is written as no target.
Other columns are ignored; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from passagelake.llm.common import file_store, pieces, stored
from passagelake.session import scratch_path

LEAST_BYTES = 100
FILES = "path string, records long"
RECORDS = (
    "page_id long, record_id string, record_type string, refers_to_id string, "
    "payload_bytes long, payload_digest string"
)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def resolve(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``(digest, original)``: the smallest page_id of each payload that repeats."""
    shared = headers.where(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.min("page_id").alias("original"), F.count("*").alias("n")
    )
    return shared.where("n > 1").drop("n")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """One record as a gzip member."""
    revisit = original is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(0 if revisit else len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(original, digest))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    body = b"" if revisit else payload
    return gzip.compress(f"WARC/1.1\r\n{head}\r\n".encode() + body + b"\r\n\r\n", 4, mtime=0)


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_store(folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        path = f"{root}/part-{context.partitionId():06d}.warc.gz"
        attempt = f"{path}.{context.taskAttemptId()}"
        records, out = 0, None
        for batch in batches:
            for part in pieces(batch, "html"):
                for row in part.to_pylist():
                    out = out or store.open_output_stream(attempt, compression=None)
                    payload = (row["html"] or "").encode()
                    out.write(warc_record(row["page_id"], row["url"], payload, row["digest"], row["refers_to"]))
                    records += 1
        if out:
            out.close()
            store.move(attempt, path)
            yield pa.RecordBatch.from_pylist([{"path": path, "records": records}])

    return write


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write ``pages (page_id, url, html)`` to ``folder``; ``(path, records)`` of the files."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    full = pages.select(
        "page_id", "url", "html", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size")
    )
    originals = stored(resolve(full.select("page_id", "digest", "size"), least_bytes), "originals")
    revisits = F.when(F.col("page_id") != F.col("original"), F.col("original"))
    rows = full.join(originals, "digest", "left").select("page_id", "url", "html", "digest", revisits.alias("refers_to"))
    return stored(rows.mapInArrow(_writer(folder), FILES), "archives")


def _members(stream: pa.NativeFile, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one after the other."""
    rest = b""
    while rest or (rest := stream.read(chunk)):
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not rest and not (rest := stream.read(chunk)):
                raise ValueError("an archive ends within a record")
            parts.append(inflate.decompress(rest))
            rest = inflate.unused_data if inflate.eof else b""
        yield b"".join(parts)


def parse_record(data: bytes) -> dict:
    """Header fields of a record, and its payload under ``payload``."""
    head, _, body = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:20]}")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if body[size:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields | {"payload": body[:size]}


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = file_store(folder)
        names = [f.split()[0] for f in RECORDS.split(", ")]
        kinds = pa.schema([(n, pa.int64() if n in ("page_id", "payload_bytes") else pa.string()) for n in names])

        def row(fields: dict) -> dict:
            revisit = fields["WARC-Type"] == "revisit"
            digest = hashlib.sha256(fields["payload"]).hexdigest()
            if not revisit and fields["WARC-Payload-Digest"] != f"sha256:{digest}":
                raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't have its digest")
            return {
                "page_id": int(fields["Page-ID"]) if "Page-ID" in fields else None,
                "record_id": fields["WARC-Record-ID"], "record_type": fields["WARC-Type"],
                "refers_to_id": fields.get("WARC-Refers-To"),
                "payload_bytes": None if revisit else len(fields["payload"]),
                "payload_digest": None if revisit else digest,
            }

        for batch in batches:
            for path in batch["path"].to_pylist():
                with store.open_input_stream(path, compression=None) as stream:
                    rows = []
                    for member in _members(stream):
                        rows.append(row(parse_record(member)))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, kinds)

    return read


def read_archives(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of all records.

    Size and digest of a revisit record are those of the payload it refers to.
    """
    each = max(1, files.count())
    rows = stored(
        files.select("path").repartition(each).mapInArrow(_reader(folder), RECORDS), "records"
    )
    responses = rows.where("record_type = 'response'").dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest"),
    )
    first = rows.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")
    )
    again = rows.where("record_type = 'revisit'").join(responses, "refers_to_id").select(
        "page_id", F.col("full_bytes").alias("payload_bytes"), F.col("full_digest").alias("payload_digest"),
        "record_type", "refers_to",
    )
    return first.unionByName(again)


def warc_roundtrip(pages: DataFrame, least_bytes: int = LEAST_BYTES, folder: str | None = None) -> DataFrame:
    """Write the archives of ``pages`` and read them back."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, write_archives(pages, folder, least_bytes), folder)

"""WARC archives compressed record by record with a Zstandard dictionary of their own.

Of pages with equal payloads of at least ``LEAST`` bytes, the one with the smallest page_id is a response and
the others are revisits of it; smaller payloads are all responses. Each task cuts its pages into archives of
bounded size, named by the task's partition, so that a retried task writes the same files again. An archive starts
with a skippable frame that holds a dictionary trained on its own records (on chunks of ``CHUNK_BYTES``, up to
``SAMPLE_BYTES`` in all, spread evenly over the whole length of all of them); every record follows as a frame of
its own, so one can be read by itself.

Edge cases: null html is an empty payload; a null url becomes ``urn:page:<page_id>``; control characters in a
url are percent-encoded; a null page_id stays null, and is the response only if its payload has no other page;
repeated rows of the smallest page_id are all responses; an empty table writes no archive and gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import fresh_dir, scratch, slices, written
from linkloom.llm.files import contents, put

LEAST = 100
ARCHIVE_BYTES = 24 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
CHUNK_BYTES = 16 << 10
LEVEL = 3
#: The magic numbers of the skippable frame that holds the dictionary and of a Zstandard frame.
SKIPPABLE = (0x184D2A5D).to_bytes(4, "little")
#: Fixed values of the archive format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: No clock is read, so a rerun writes the same bytes.
DATE = "2020-01-01T00:00:00Z"


def payload(html: Column) -> Column:
    return F.coalesce(html.cast("string"), F.lit(""))


def classify(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``pages`` (page_id, url, html) with digest and refers_to (null: a response).

    Only digests, ids and sizes are grouped; payloads that occur once need no partner and meet no other row.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload(F.col("html")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    big = rows.where(F.octet_length("html") >= least)
    first = big.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = written(first.withColumnRenamed("digest", "of"), "copies")
    rows = rows.join(first, rows["digest"] == first["of"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, body: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record. A revisit keeps the HTTP head, and with it the payload's length, but not the payload."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http + (body if refers_to is None else b"")
    head = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Profile: {PROFILE}", f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES, most: int = SAMPLE_BYTES, chunk: int = CHUNK_BYTES) -> bytes:
    """A dictionary from chunks spread evenly over whole records, ``most`` bytes in all; raw bytes if too few to train on."""
    places = [(r, at) for r in records for at in range(0, len(r), chunk)]
    total = sum(map(len, records))
    sample = [r[at : at + chunk] for r, at in places[:: max(1, -(-total // most))]]
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 10)), sample, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[-size:]


def archive(records: list[bytes]) -> bytes:
    data = dictionary(records)
    shared = zstandard.ZstdCompressionDict(data)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
    held = zstandard.ZstdCompressor(level=LEVEL).compress(data)
    return b"".join([SKIPPABLE, len(held).to_bytes(4, "little"), held, *map(packer.compress, records)])


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive."""
    if content[:4] != SKIPPABLE:
        raise ValueError("no dictionary frame")
    size = int.from_bytes(content[4:8], "little")
    data = zstandard.ZstdDecompressor().decompress(content[8 : 8 + size])
    opened = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
    with opened.stream_reader(memoryview(content)[8 + size :], read_across_frames=True) as stream:
        held, at = b"", 0

        def more(size: int = 1 << 20) -> bool:
            """Some more bytes, ahead of which what is done with goes."""
            nonlocal held, at
            got = stream.read(max(size, 1 << 20))
            held, at = held[at:] + got, 0
            return bool(got)

        while True:
            while (end := held.find(b"\r\n\r\n", at)) < 0:
                if not more():
                    if held:
                        raise ValueError("cut off within a record's head")
                    return
            fields = dict(line.split(": ", 1) for line in held[at:end].decode().split("\r\n")[1:])
            size, at = int(fields["Content-Length"]), end + 4
            while len(held) < at + size + 4:
                if not more(at + size + 4 - len(held)):
                    raise ValueError("cut off within a record")
            yield fields, held[at : at + size]
            at += size + 4


def write_archives(pages: DataFrame, directory: str, least: int = LEAST, size: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages to archives in ``directory``; a written table of file, records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, total, number = TaskContext.get().partitionId(), [], 0, 0

        def flush() -> pa.RecordBatch:
            name = put(directory, f"part-{part:06d}-{number:06d}.warc.zst", archive(held))
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)])], ["file", "records"])

        for batch in slices(batches, "html", 4 << 20):
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(record(page_id, url, html, digest, refers_to))
                total += len(held[-1])
                if total >= size:
                    yield flush()
                    held, total, number = [], 0, number + 1
        if held:
            yield flush()

    with scratch(pages.sparkSession) as keep:
        rows = classify(pages, least).sortWithinPartitions("page_id", "digest")  # a retried task cuts as the first did
        rows = rows.select("page_id", "url", F.col("html").cast("binary").alias("html"), "digest", "refers_to")
        return keep(written(rows.mapInArrow(run, "file string, records long"), "archives"))


def read_archives(archives: DataFrame, directory: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of every record.

    A response's length and digest are those of the payload read; a revisit's are what its record says.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "content", 1):
            rows = []
            for fields, block in records(batch.column(0)[0].as_py()):
                http, _, body = block.partition(b"\r\n\r\n")
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
                length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                if kind == "response":
                    length, digest = len(body), hashlib.sha256(body).hexdigest()
                page, refers = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
                rows.append((page and int(page), length, digest, kind, refers and int(refers), fields["WARC-Target-URI"]))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    files = contents(archives.sparkSession, directory, "*.warc.zst").select("content")
    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archived(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    directory = fresh_dir(pages.sparkSession, "archives")
    files = write_archives(pages, directory)
    if not files.head(1):
        return pages.sparkSession.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")
    return read_archives(files, directory)


#: The same in DuckDB, without archives.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first IS NOT NULL AND d.page_id IS DISTINCT FROM f.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

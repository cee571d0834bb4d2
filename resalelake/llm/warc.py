"""WARC archives of pages: writer, normaliser of monolithic gzip files, and reader.

The writer puts each task's records into one archive that is a single gzip stream, as crawlers' tools often leave it. The
normaliser inflates such a file once from start to end, writes every record again as a gzip member of its own, and
writes a sidecar index (offset, length, record id, type per line), so that any record can be read alone. The reader
goes by the index. Files are streams throughout; a task holds one record at a time.

Of records with equal payloads of at least ``REVISIT_BYTES`` that with the largest page_id is a response, the others are
revisits that refer to it; all smaller ones are responses.

Defined cases: null html is an empty payload; a null url has no target header; a null page_id sorts below all others, and such rows
are responses where no other has the payload; rows that repeat the largest page_id are each a response; a file that ends within a record raises
EOFError; an empty table writes nothing; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resalelake.llm import files
from resalelake.llm.common import written
from resalelake.session import shared_folder

REVISIT_BYTES = 1000
#: Compressed bytes inflated at once; a chunk cannot grow beyond about 1,030 times that.
CHUNK = 1 << 16
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, index string, records bigint"
_PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    number = record.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, original: int | None) -> bytes:
    """A response with its payload, or a revisit with the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_PRINTABLE)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(original)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, rest[: int(fields["content-length"])]


def inflated(source) -> Iterator[bytes]:
    """The bytes of a gzip file, of one member or many."""
    inflater, fresh = zlib.decompressobj(31), True
    while data := source.read(CHUNK):
        while data:
            fresh = False
            yield inflater.decompress(data)
            data = b""
            if inflater.eof:
                data, inflater, fresh = inflater.unused_data, zlib.decompressobj(31), True
    if not fresh:
        raise EOFError("gzip stream ends early")


def records(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, with the two line ends that close each."""
    held = bytearray()
    need, scanned = -1, 0
    for part in parts:
        held += part
        while True:
            if need < 0:
                end = held.find(b"\r\n\r\n", scanned)
                if end < 0:
                    scanned = max(0, len(held) - 3)
                    break
                length = next(int(x.split(b":")[1]) for x in bytes(held[:end]).split(b"\r\n") if x.lower().startswith(b"content-length:"))
                need = end + 4 + length + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need, scanned = -1, 0
    if held.strip():
        raise EOFError("archive ends within a record")


def _write(folder: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, count, uri = None, 0, files.own_name(folder, TaskContext.get().partitionId(), ".warc.gz")
        for batch in batches:
            for n in range(batch.num_rows):
                if out is None:
                    out, squeeze = files.writer(uri), zlib.compressobj(6, zlib.DEFLATED, 31)
                page_id, url, html, digest, revisit, original = (batch.column(c)[n].as_py() for c in ("page_id", "url", "html", "digest", "revisit", "original"))
                out.write(squeeze.compress(record(page_id, url, (html or "").encode(), digest, revisit, original)))
                count += 1
        if out is not None:
            out.write(squeeze.flush())
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": uri, "index": "", "records": count}])

    return rows


def _normalise(folder: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column("path").to_pylist():
                uri = files.own_name(folder, TaskContext.get().partitionId(), ".warc.gz")
                at = count = 0
                with files.writer(uri) as out, files.writer(f"{uri}.idx") as index, files.stream(source) as stream:
                    for data in records(inflated(stream)):
                        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = squeeze.compress(data) + squeeze.flush()
                        fields, _ = parsed(data[: data.find(b"\r\n\r\n") + 4])
                        index.write(f"{at}\t{len(member)}\t{fields['warc-record-id']}\t{fields['warc-type']}\n".encode())
                        out.write(member)
                        at += len(member)
                        count += 1
                yield pa.RecordBatch.from_pylist([{"path": uri, "index": f"{uri}.idx", "records": count}])

    return rows


def read_record(archive, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record of an open normalised archive."""
    archive.seek(offset)
    return parsed(zlib.decompress(archive.read(length), 31))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            out: list[dict] = []
            with files.stream(row["index"]) as index, files.reader(row["path"]) as archive:
                for line in index.read().decode().splitlines():
                    offset, length, name, kind = line.split("\t")
                    fields, block = read_record(archive, int(offset), int(length))
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(next(x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")))
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"damaged record {name} in {row['path']}")
                    refers = page_of(fields["warc-refers-to"]) if kind == "revisit" else None
                    out.append({"page_id": page_of(name), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": refers})
                    if len(out) == 5000:
                        yield _rows(out)
                        out = []
            yield _rows(out)


def _rows(rows: list[dict]) -> pa.RecordBatch:
    types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    return pa.RecordBatch.from_pylist(rows, pa.schema(list(types.items())))


def marked(pages: DataFrame) -> DataFrame:
    """page_id, url, html with payload digest, and which record each row becomes.

    Small payloads get a key of their own in the join, so that a hot empty page meets nothing; a hot large payload is one row on
    the other side, so its pages may be split.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("digest"), F.length(payload).alias("size"))
    large = rows.where(F.col("size") >= REVISIT_BYTES)
    last = large.groupBy("digest").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("digest").alias("key"), "original")
    key = F.when(F.col("size") >= REVISIT_BYTES, F.col("digest")).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.col("digest"))))
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return rows.withColumn("key", key).join(last, "key", "left").select("page_id", "url", "html", "digest", revisit.alias("revisit"), "original")


def write_archives(pages: DataFrame) -> DataFrame:
    """Manifest of monolithic archives, one per task."""
    return written(marked(pages).mapInArrow(_write(shared_folder(pages.sparkSession, "warc-whole")), MANIFEST), "warc-manifest")


def normalise(manifest: DataFrame) -> DataFrame:
    """Manifest of archives with one member per record, and their indices; takes any table with a ``path`` column."""
    spark = manifest.sparkSession
    one_each = manifest.select("path").repartition(max(1, manifest.count()), "path")
    return written(one_each.mapInArrow(_normalise(shared_folder(spark, "warc-members")), MANIFEST), "warc-normalised")


def read_archives(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record."""
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return manifest.select("path", "index").repartition(max(1, manifest.count()), "path").mapInArrow(_read, schema)


#: The digest rows on DuckDB.
ORACLE = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM {pages}
), l AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes >= 1000) END AS original FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM l
"""

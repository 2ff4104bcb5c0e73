"""WARC archives by a table of record chunks.

Payloads are cut into chunks before they reach a writer: one row per (record, chunk number), so neither writing nor
reading ever holds a whole record. A writer task streams its rows into archives of its own, one gzip member per
record, and returns the names of the files it finished. That manifest is the commit: files of a lost or repeated
attempt are in no manifest and are never read. The reader streams an archive member by member and gives a chunk table
back, each row with the bytes so far and the SHA-256 of all bytes so far; the last chunk of a record therefore has its
length and digest, and ``resolved`` needs nothing else.

Of records with equal payloads of at least ``least`` bytes, the one with the smallest id holds the payload
(response), the others refer to it (revisit). Equal payloads are found by digest and length in one aggregation that is
combined before its shuffle.

Defined cases: null payloads are empty; a null id is never the smallest and its record is a revisit where a record
with an id has the payload, else a response; rows with the same smallest id are all responses; a null address is
written as an empty one; control characters in an address are percent-encoded; an empty table gives no archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm.work import folder, staged

BLOCK = 1 << 20
END = b"\r\n\r\n"
MANIFEST = "file string, n_records bigint"
CHUNKS = ("file string, record_id string, record_type string, page_id bigint, refers_to_id string, "
          "declared_digest string, chunk_no int, is_last boolean, bytes_so_far bigint, sha256_so_far string, data binary")


def classified(pages: DataFrame, key: str = "page_id", address: str = "url", payload: str = "html",
               least: int = 100) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)."""
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(address).alias("url"),
                        F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload")) \
        .withColumn("payload_bytes", F.octet_length("payload").cast("bigint")) \
        .withColumn("payload_digest", F.sha2("payload", 256))
    groups = (rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
              .agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1 and _first is not null"))
    groups = staged(groups.drop("_n"), "warc-equal")
    first = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return (rows.join(groups, ["payload_digest", "payload_bytes"], "left")
            .withColumn("record_type", F.when(first, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(first, F.col("_first"))).drop("_first"))


def chunked(records: DataFrame, chunk_bytes: int = BLOCK) -> DataFrame:
    """One row per chunk of the payload, in order; a revisit has one empty chunk."""
    def name(page: str):
        digest = F.md5(F.concat(F.coalesce(F.col(page).cast("string"), F.concat(F.lit("null:"), F.coalesce("url", F.lit("")))),
                                F.lit(":"), F.col("payload_digest")))
        return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")

    held = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    n = F.greatest(F.ceil(F.octet_length("_held") / F.lit(chunk_bytes)), F.lit(1)).cast("int")
    return (records.withColumn("record_id", name("page_id"))
            .withColumn("refers_to_id", F.when(F.col("refers_to").isNotNull(), name("refers_to")))
            .withColumn("_held", held).withColumn("block_bytes", F.octet_length("_held").cast("bigint"))
            .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), n - 1)))
            .select("record_id", "record_type", "page_id", "url", "refers_to_id", "payload_digest", "payload_bytes",
                    "block_bytes", "chunk_no",
                    F.expr(f"substring(_held, chunk_no * {chunk_bytes} + 1, {chunk_bytes})").alias("data")))


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _head(row: dict, date: str) -> bytes:
    address = "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in row["url"] or "")
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" \
           f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {row['record_id']}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {address}", f"WARC-Payload-Digest: sha256:{row['payload_digest']}"]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if row["record_type"] == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {row['refers_to_id']}"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http.encode()) + row['block_bytes']}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def _writer(target: str, date: str, file_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(target)
        out = packer = None
        name, records, written = "", 0, 0

        def finished() -> pa.RecordBatch:
            out.write(packer.compress(END) + packer.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"file": [f"{target}/{name}"], "n_records": [records]})

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["chunk_no"] == 0:
                    if out and written >= file_bytes:
                        yield finished()
                        out = None
                    if out is None:
                        name, records, written = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = store.open_output_stream(f"{path}/{name}", compression=None)
                    else:
                        out.write(packer.compress(END) + packer.flush())
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out.write(packer.compress(_head(row, date)))
                    records += 1
                part = packer.compress(row["data"])
                out.write(part)
                written += len(part)
        if out:
            yield finished()
    return write


def write_archives(chunks: DataFrame, target: str, date: str = "1970-01-01T00:00:00Z",
                   file_bytes: int = 1 << 30) -> DataFrame:
    """Writes the chunk rows to archives below ``target``; the manifest (file, n_records) of finished files.

    Chunks of a record stand in order in one partition, as ``chunked`` gives them.
    """
    store, path = _store(target)
    store.create_dir(path, recursive=True)
    return staged(chunks.mapInArrow(_writer(target, date, file_bytes), MANIFEST), "warc-manifest")


class _Members:
    """The bytes of a gzip file of many members, without ever holding more than two blocks."""

    def __init__(self, source):
        self.source, self.unpack, self.held, self.raw = source, zlib.decompressobj(31), b"", b""

    def _more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.source.read(BLOCK)
                if not self.raw:
                    return False
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
            found = self.unpack.decompress(self.raw, BLOCK)
            self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
            if found:
                self.held += found
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the file."""
        while mark not in self.held:
            if not self._more():
                if self.held.strip():
                    raise ValueError("the archive ends within a record")
                return None
        found, _, self.held = self.held.partition(mark)
        return found + mark

    def take(self, n: int) -> bytes:
        """At most n bytes, at least one."""
        if not self.held and not self._more():
            raise ValueError("the archive ends within a record")
        found, self.held = self.held[:n], self.held[n:]
        return found


def _chunk_rows(file: str, with_data: bool) -> Iterator[tuple]:
    store, path = _store(file)
    with store.open_input_stream(path, compression=None) as source:
        stream = _Members(source)
        while (head := stream.until(END)) is not None:
            lines = head.decode("utf-8").strip().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"{file}: not a WARC record: {lines[0][:80]}")
            named = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
            left = int(named["content-length"]) - len(stream.until(END))
            page = named.get("x-page-id")
            fixed = (file, named["warc-record-id"], named["warc-type"], None if page is None else int(page),
                     named.get("warc-refers-to"), named["warc-payload-digest"].removeprefix("sha256:"))
            digest, so_far, number = hashlib.sha256(), 0, 0
            while True:
                data = stream.take(min(left - so_far, BLOCK)) if so_far < left else b""
                digest.update(data)
                so_far += len(data)
                yield (*fixed, number, so_far == left, so_far, digest.copy().hexdigest(), data if with_data else None)
                number += 1
                if so_far == left:
                    break
            if stream.until(END) != END:
                raise ValueError(f"{file}: a record does not end where its length says")


def read_archives(spark: SparkSession, manifest: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunk table of the archives: one task per archive, rows in the order of the file."""
    names = [field.split()[0] for field in CHUNKS.split(", ")]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file in frame["file"]:
                rows, held = [], 0
                for row in _chunk_rows(file, with_data):
                    rows.append(row)
                    held += len(row[-1] or b"")
                    if held >= 4 * BLOCK or len(rows) >= 4096:
                        yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})

    return manifest.select("file").repartition(max(manifest.count(), 1)).mapInPandas(read, CHUNKS)


def resolved(chunks: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, intact) per record read back.

    A revisit takes length and digest from the record it refers to. ``intact``: the bytes read have the digest that
    the record's header declares.
    """
    ends = staged(chunks.where("is_last").select("record_id", "record_type", "page_id", "refers_to_id", "declared_digest",
                                                 "bytes_so_far", "sha256_so_far"), "warc-read")
    held = (ends.where("record_type = 'response'").groupBy(F.col("record_id").alias("_id"))
            .agg(F.max("bytes_so_far").alias("_bytes"), F.max("sha256_so_far").alias("_digest"),
                 F.min("page_id").alias("_page")))
    wanted = staged(held.join(ends.where("refers_to_id is not null").select(F.col("refers_to_id").alias("_id")).distinct(),
                              "_id"), "warc-referred")
    back = F.col("refers_to_id").isNotNull()
    return (ends.join(wanted, F.col("refers_to_id") == F.col("_id"), "left")
            .select("page_id", F.when(back, F.col("_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
                    F.when(back, F.col("_digest")).otherwise(F.col("sha256_so_far")).alias("payload_digest"),
                    "record_type", F.col("_page").alias("refers_to"), "declared_digest")
            .withColumn("intact", F.col("payload_digest").eqNullSafe(F.col("declared_digest"))).drop("declared_digest"))


def round_trip(spark: SparkSession, pages: DataFrame, target: str | None = None) -> DataFrame:
    """Writes all rows to archives and reads them back."""
    target = target or folder(spark, "warc")
    manifest = write_archives(chunked(classified(pages)), target)
    return resolved(read_archives(spark, manifest, with_data=False))

"""Deterministic sharded WARC writer and its reader.

Records are range-sorted by page id into shards.  The shards' bounds come from an
exact histogram of record bytes over equal id ranges (a bounded number of cells),
so equal input gives equal files whatever the cluster does.  A task writes each
of its shards to files with temporary names, one gzip member per record, and
rolls to the next file at a compressed size; headers and digests are made anew
from the payload.  Only what successful tasks report enters the manifest; its
files are then renamed, by a Spark job, and the manifest is written last: a
reader takes the files that the manifest names, and no other.

Files are reached with ``pyarrow.fs`` by the folder's URI, which must be shared
(as ``spark.checkpoint.dir`` is).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.common import materialise

CELLS = 4096
MANIFEST = ("shard bigint, part int, name string, temporary string, bytes bigint, records bigint, "
            "crc32 bigint")
RECORDS = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint, url string, payload binary")
_URL_SAFE = "".join(chr(c) for c in range(33, 127))


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:")
                                    else f"file://{folder}")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind} {page_id} {digest}')}>"


def record(page_id, url, payload: bytes, refers_to, date: str) -> bytes:
    """A response record, or a revisit (headers only) if ``refers_to`` is given."""
    digest = base32_sha1(payload)
    kind = "response" if refers_to is None else "revisit"
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Content-Length: %d\r\n\r\n" % len(payload))
    if kind == "response":
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id, digest, kind)}",
            f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE, errors='replace')}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers_to, digest, 'response')}",
                 f"X-Refers-To-Page: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
             f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Roller:
    """Files of one shard, under temporary names, each of ``roll_bytes`` or a little more."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, level: int):
        self.fs, self.path = _open(folder)
        self.shard, self.roll_bytes, self.level = shard, roll_bytes, level
        self.out, self.done, self.part = None, [], 0

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.temporary = f"temporary/{uuid.uuid4().hex}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
            self.size = self.records = self.crc = 0
        squeeze = zlib.compressobj(self.level, zlib.DEFLATED, 31)  # a member, without a time
        member = squeeze.compress(data) + squeeze.flush()
        self.out.write(member)
        self.size += len(member)
        self.crc = zlib.crc32(member, self.crc)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.part,
                              f"pages-{self.shard:06d}-{self.part:05d}.warc.gz", self.temporary,
                              self.size, self.records, self.crc))
            self.out, self.part = None, self.part + 1


def assign_shards(rows: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """Adds ``shard``: consecutive id ranges of about ``shard_bytes`` of payload each; a
    cell that is larger than that (one id range that holds very much) is dealt over
    several shards by hash.  Rows without an id are a cell of their own."""
    span = rows.agg(F.min("page_id").alias("a"), F.max("page_id").alias("b")).first()
    low, high = span["a"] or 0, span["b"] or 0
    width = max(1, -(-(high - low + 1) // CELLS))
    cell = F.coalesce(F.floor((F.col("page_id") - low) / F.lit(width)) + 1, F.lit(0)).cast("int")
    if high - low > 1 << 52:  # beyond exact division of doubles
        cell = F.coalesce(F.expr(f"page_id div {width} - {low // width}") + 1, F.lit(0)).cast("int")
    sizes = dict(rows.groupBy(cell.alias("c"))
                 .agg(F.sum(F.octet_length("payload") + 1000)).collect())  # CELLS + 2 rows at most
    first, split, shard, filled = [], [], -1, shard_bytes
    for c in range(max(sizes, default=0) + 1):
        n = sizes.get(c, 0)
        if n > shard_bytes:
            shard += 1
            first.append(shard)
            split.append(-(-n // shard_bytes))
            shard += split[-1] - 1
            filled = shard_bytes
            continue
        if filled + n > shard_bytes:
            shard, filled = shard + 1, 0
        filled += n
        first.append(shard)
        split.append(1)
    cells = rows.withColumn("_c", cell + 1)
    at = F.element_at(F.array(*map(F.lit, first)), F.col("_c"))
    n = F.element_at(F.array(*map(F.lit, split)), F.col("_c"))
    return (cells.withColumn("shard", (at + F.pmod(F.xxhash64("page_id", "digest"), n)).cast("bigint"))
            .drop("_c"), shard + 1)


def mark_revisits(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds ``refers_to``: of equal payloads of ``min_bytes`` or more the largest page_id
    is the response (null), the others point to it.  Rows that repeat that page_id
    are responses too; a row without an id points to it like any other."""
    groups = materialise(
        rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("_top"), F.count("*").alias("_n")).where("_n > 1")
        .select(F.col("digest").alias("_d"), "_top"), "warc-groups")
    return (rows.join(groups, F.col("digest") == F.col("_d"), "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("_top")),
                                            F.col("_top")))
            .drop("_d", "_top"))


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, shard_bytes: int = 64 << 20,
               roll_bytes: int = 16 << 20, level: int = 6, date: str = "2024-01-01T00:00:00Z",
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes a record per row into ``folder`` (a new one) and returns the manifest.

    A null html is an empty payload; a null url has no target header; null and
    repeated ids each get a record.  Other columns are not looked at; an empty table
    gives an empty manifest and no file.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                        F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    sharded, n = assign_shards(mark_revisits(rows, min_bytes), shard_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, done = None, []
        for b in batches:
            for row in b.to_pylist():
                if roller is None or roller.shard != row["shard"]:
                    if roller is not None:
                        roller.close()
                        done += roller.done
                    roller = _Roller(folder, row["shard"], roll_bytes, level)
                roller.add(record(row["page_id"], row["url"], row["payload"], row["refers_to"], date))
        if roller is not None:
            roller.close()
            done += roller.done
        if done:
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), *[pa.int64()] * 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)],
                                             names=[c.split()[0] for c in MANIFEST.split(", ")])

    fs, path = _open(folder)
    fs.create_dir(f"{path}/temporary", recursive=True)
    written = materialise(
        sharded.repartitionByRange(max(1, n), "shard")
        .sortWithinPartitions("shard", "page_id", "digest", "url", "refers_to")
        .drop("digest").mapInArrow(write, MANIFEST), "warc-written")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Can run again: what is there under its own name is left alone."""
        fs, path = _open(folder)
        for b in batches:
            for row in b.to_pylist():
                if fs.get_file_info(f"{path}/{row['name']}").type == pafs.FileType.NotFound:
                    fs.move(f"{path}/{row['temporary']}", f"{path}/{row['name']}")
            yield b

    written.mapInArrow(rename, MANIFEST).drop("temporary").write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    schema = ", ".join(c for c in MANIFEST.split(", ") if "temporary" not in c)
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


def _members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    inflate, parts, data = zlib.decompressobj(31), [], b""
    while data or (data := stream.read(chunk)):
        parts.append(inflate.decompress(data))
        data = b""
        if inflate.eof:
            yield b"".join(parts)
            data, inflate, parts = inflate.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("a record is cut short")


def parse_record(member: bytes) -> tuple:
    """(page_id, payload_bytes, digest, type, refers_to, url, payload), digests checked."""
    head, rest = member.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(h["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or "sha1:" + base32_sha1(block) != h["WARC-Block-Digest"]:
        raise ValueError(f"record {h['WARC-Record-ID']} is damaged")
    number = lambda k: int(h[k]) if k in h else None
    payload, size = None, number("X-Payload-Length")
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    if h["WARC-Type"] == "response":
        payload = block.split(b"\r\n\r\n", 1)[1]
        if (len(payload), base32_sha1(payload)) != (size, digest):
            raise ValueError(f"payload of {h['WARC-Record-ID']} is damaged")
    return (number("X-Page-Id"), size, digest, h["WARC-Type"], number("X-Refers-To-Page"),
            h.get("WARC-Target-URI"), payload)


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the files that the manifest names: ``RECORDS``, a null payload for
    revisits (and for all without ``payloads``).  A damaged file raises."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        for b in batches:
            for file in b.to_pylist():
                rows, size, n = [], 0, 0
                with fs.open_input_stream(f"{path}/{file['name']}", compression=None) as stream:
                    for member in _members(stream):
                        rows.append(parse_record(member)[:7 if payloads else 6]
                                    + (() if payloads else (None,)))
                        size, n = size + len(member), n + 1
                        if size > 16 << 20:
                            yield batch(rows)
                            rows, size = [], 0
                if n != file["records"]:
                    raise ValueError(f"{file['name']} has {n} of {file['records']} records")
                if rows:
                    yield batch(rows)

    files = read_manifest(spark, folder)
    tasks = max(1, files.count())
    return files.repartitionByRange(tasks, "shard", "part").mapInArrow(read, RECORDS)

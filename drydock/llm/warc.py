"""Deterministic, sharded WARC archives.

Records are cut into shards of about equal bytes by page id, sorted in them, and written one gzip member
per record. A shard's files roll when their compressed size passes a limit. Names, headers, record ids and
digests follow from the rows alone, so any number of partitions and any repeated task gives the same bytes. A
file is written under a temporary name and then renamed; the manifest, written last, is what readers go by, so
files of a broken run are never read.

Of records with equal payloads (by length and SHA-1) of at least ``least_bytes``, that with the largest page id
is a ``response`` and the others are ``revisit`` records without the payload.

Defined results: a null payload is empty, a null url is an empty target. A null page id is written under a
record id of its own kind and reads back as null; it is a response only if no equal payload has an id. Rows that repeat a
page id with equal payloads are written each, with one type. Extra columns do not matter; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import running
from . import common as c

SHARD_BYTES = 64 << 20
FILE_BYTES = 32 << 20
#: Compressed bytes that one reading task takes at a time.
CHUNK_BYTES = 4 << 20
READ_BYTES = 1 << 14
LEVEL = 4
#: Reading tasks for each shuffle partition of the session, if there are as many chunks.
READERS = 4
DATE = "1970-01-01T00:00:00Z"
_ID, _NO_ID = 0x6D1F0B8A5C7E4D21, 0x6D1F0B8A5C7E4D20
MANIFEST = "file string, shard int, offset long, length long, records long, file_crc32 long"
RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page_id: int | None) -> str:
    number = (_NO_ID << 64) if page_id is None else (_ID << 64) | (page_id & ((1 << 64) - 1))
    return f"<urn:uuid:{uuid.UUID(int=number)}>"


def page_of(record: str) -> int | None:
    number = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    if number >> 64 == _NO_ID:
        return None
    low = number & ((1 << 64) - 1)
    return low - (1 << 64) if low >> 63 else low


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, not compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head.insert(6, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(7, f"WARC-Refers-To: {record_id(refers_to)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member without a time stamp."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse(data: bytes) -> tuple[int | None, str, bytes | None, int, str, str, int | None]:
    """The columns of ``RECORD`` from one record; a digest that does not fit its block is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    http, _, payload = block.partition(b"\r\n\r\n")
    page = page_of(fields["WARC-Record-ID"])
    kind = fields["WARC-Type"]
    if base32_sha1(block) != fields["WARC-Block-Digest"].removeprefix("sha1:") or (kind == "response" and base32_sha1(payload) != digest):
        raise ValueError(f"record of page {page}: the digest does not fit")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    refers = page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return page, fields["WARC-Target-URI"], payload if kind == "response" else None, size, digest, kind, refers


def _cuts(sizes: DataFrame, shard_bytes: int) -> np.ndarray:
    """Page ids at which a new shard begins, from running sums of bytes over blocks of ids.

    One job; the driver sees a number per shard. A shard has ``shard_bytes`` and what its last id has beyond.
    """
    by_id = sizes.filter("page_id is not null").groupBy("page_id").agg(F.sum("size").alias("size"))
    upto = running(by_id, [], ["page_id"], "size", total="upto")
    shards = upto.groupBy(F.floor((F.col("upto") - F.col("size")) / shard_bytes).alias("shard")).agg(F.min("page_id").alias("first"))
    return np.sort(np.array([r["first"] for r in shards.collect()], np.int64))[1:]


def _payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


class _Writer:
    """The open file of a shard."""

    def __init__(self, folder: str, shard: int, number: int):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.name, self.shard = f"part-{shard:06d}-{number:05d}.warc.gz", shard
        self.temp, self.final = f"{base}/.{self.name}.{uuid.uuid4().hex}.tmp", f"{base}/{self.name}"
        self.fs.create_dir(base, recursive=True)
        self.out = self.fs.open_output_stream(self.temp)
        self.size, self.crc, self.chunks = 0, 0, []

    def add(self, data: bytes) -> None:
        if not self.chunks or self.chunks[-1][1] >= CHUNK_BYTES:
            self.chunks.append([self.size, 0, 0])
        self.out.write(data)
        self.size += len(data)
        self.crc = zlib.crc32(data, self.crc)
        self.chunks[-1][1] += len(data)
        self.chunks[-1][2] += 1

    def close(self) -> pa.RecordBatch:
        self.out.close()
        self.fs.move(self.temp, self.final)
        rows = [(self.name, self.shard, *x, self.crc) for x in self.chunks]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = [x.split()[0] for x in MANIFEST.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _write(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, number = None, 0
        place, refers, known = None, None, False
        for batch in batches:
            for row in zip(*(batch.column(x) for x in ("shard", "page_id", "digest", "is_page", "url", "payload", "refers_to")), strict=True):
                shard, page, digest, is_page, url, payload, to = (x.as_py() for x in row)
                if not is_page:  # says that the pages of this id and digest, which come next, are revisits
                    place, refers, known = (page, digest), to, True
                    continue
                revisit = known and place == (page, digest)
                if writer and (writer.shard != shard or writer.size >= file_bytes):
                    number = number + 1 if writer.shard == shard else 0
                    yield writer.close()
                    writer = None
                writer = writer or _Writer(folder, shard, number)
                writer.add(member(record(page, url, payload, refers, revisit)))
        if writer:
            yield writer.close()

    return run


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes the archives below ``folder`` and returns the manifest: a row for each part of a file that is read alone."""
    spark = pages.sparkSession
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), _payload(pages[html_col]).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    small = c.stored(rows.select("page_id", "digest", F.octet_length("payload").cast("long").alias("size")), "payloads")
    keepers = small.filter(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"))
    copies = small.join(keepers, ["digest", "size"]).filter("refers_to is not null and not (page_id <=> refers_to)")
    cuts = spark.sparkContext.broadcast(_cuts(small, shard_bytes))

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts.value, ids.fillna(-(1 << 63)).astype("int64"), "right").astype(np.int32))

    # Sort keys and the flag that a page is a revisit travel as rows of their own, so payloads are shuffled once.
    flags = copies.select("page_id", "digest", "refers_to").distinct()
    flags = flags.select("page_id", "digest", F.lit(False).alias("is_page"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "refers_to")
    every = rows.select("page_id", "digest", F.lit(True).alias("is_page"), "url", "payload", F.lit(None).cast("long").alias("refers_to")).unionByName(flags)
    every = every.withColumn("shard", shard_of("page_id"))
    # One shard to a partition: a sampled range partition may put two together.
    ordered = every.repartitionById(len(cuts.value) + 1, F.col("shard")).sortWithinPartitions("shard", "page_id", "digest", "is_page", "url")
    pages_written = ordered.mapInArrow(_write(f"{folder}/archive", file_bytes), MANIFEST)
    pages_written.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _read(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(f"{folder}/archive")
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [x.split()[0] for x in RECORD.split(", ")]
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_input_file(f"{base}/{r['file']}") as f:
                    f.seek(r["offset"])
                    rest = f.read(r["length"])
                rows, at = [], 0
                stream = memoryview(rest)
                while at < len(stream):
                    unpack, data = zlib.decompressobj(31), []
                    while not unpack.eof:
                        data.append(unpack.decompress(stream[at : at + READ_BYTES]))
                        at = min(at + READ_BYTES, len(stream)) - len(unpack.unused_data)
                    data = b"".join(data)
                    found = parse(data)
                    rows.append(found if with_payload else (*found[:2], None, *found[3:]))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the files in the manifest; digests are checked.

    The manifest is tiny beside what it stands for, so its rows are dealt to tasks by number, which adaptive execution leaves alone.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    tasks = max(1, min(manifest.count(), READERS * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    task = F.pmod(F.xxhash64("file", "offset"), F.lit(tasks)).cast("int")
    return manifest.repartitionById(tasks, task).mapInArrow(_read(folder, with_payload), RECORD)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = c.new_folder(spark, "warc")
    write_archives(c.table(spark, sf_dir, "pages"), folder)
    back = read_archives(spark, folder, with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")

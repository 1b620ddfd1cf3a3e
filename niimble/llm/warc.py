"""A deterministic sharded WARC writer, and a reader.

Records are put in the order of their ids. Running sums of their payload sizes along that order divide
them into shards, so shards depend on the records alone, not on how Spark happened to deal them out.
One task writes a shard, sorted; it starts a new file once the compressed size reaches the roll size.
Each record is a gzip member of its own. Headers and digests are made anew from the payload.

Files get temporary names, different for each attempt of a task. A manifest (a Parquet table) lists
the files of the attempts that counted; only those are renamed, and a marker file is written last.
A lost executor leaves temporary files that no manifest lists; they are deleted at the commit.

Among records with equal payloads of ``REVISIT_FROM`` bytes or more the one with the smallest id is a
``response``; the others are ``revisit`` records that refer to it and hold no payload. A NULL payload is
empty, a NULL url is left out, and a NULL id sorts first, is never referred to and is read back as
NULL. Repeated rows are written as often as they come. An empty table gives no files. Only the named
columns are read.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, LongType, StringType, StructField, StructType,
)

from niimble.llm.frames import arrow_stage, materialize

HEADER_BYTES = 600  # what a record weighs besides its payload
REVISIT_FROM = 100
SHARD_BYTES = 64 << 20
ROLL_BYTES = 16 << 20
LEVEL = 3
DATE = "2026-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: RFC 4122, names that are URLs
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of WARC 1.1

MANIFEST = StructType([
    StructField("name", StringType()), StructField("temporary", StringType()), StructField("shard", LongType()),
    StructField("records", LongType()), StructField("bytes", LongType()), StructField("sha256", StringType()),
])


def plan_shards(ids: DataFrame, shard_bytes: int) -> list:
    """The first id of each shard but the first, from ``id, size`` of all records.

    Ids are summed, dealt out in ranges and written, so that the ranges stay as they are; sums run along
    each range, behind those of the ranges before it. The driver gets one id a shard.
    """
    weights = ids.groupBy("id").agg(F.sum(F.col("size") + HEADER_BYTES).alias("size"))
    parts = materialize(weights.repartitionByRange("id").withColumn("part", F.spark_partition_id()), "warc-plan")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sums = parts.groupBy("part").agg(F.sum("size").alias("part_size"))
    offsets = sums.select("part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("offset"))
    along = Window.partitionBy("part").orderBy(F.col("id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("offset") + F.coalesce(F.sum("size").over(along), F.lit(0))
    shards = parts.join(F.broadcast(offsets), "part").select("id", F.floor(before / shard_bytes).alias("shard"))
    return sorted(r[0] for r in shards.where(F.col("shard") > 0).groupBy("shard").agg(F.min("id")).select("min(id)").collect())


def find_revisits(light: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """``id, digest, refers_to`` of the records that repeat a payload, from ``id, digest, size`` of all.

    Equal payloads are counted before they are shuffled, and the join back to a payload's first id is one
    that Spark can split where a payload is hot.
    """
    large = light.where(F.col("size") >= revisit_from)
    firsts = (
        large.groupBy("digest")
        .agg(F.min("id").alias("refers_to"), F.max("id").alias("last"))
        .where(F.col("refers_to") < F.col("last"))
        .drop("last")
    )
    return large.join(firsts, "digest").where(F.col("id") > F.col("refers_to")).select("id", "digest", "refers_to").distinct()


def _record_id(page: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page}')}>"


def _one_line(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in text)


def build_record(page: object, url: str | None, payload: bytes, refers_to: object, date: str = DATE) -> bytes:
    """The bytes of one record, headers and digests made from the payload."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page is not None:
        headers.append(("X-Page-ID", _one_line(str(page))))
    if url is not None:
        headers.append(("WARC-Target-URI", _one_line(url)))
    if refers_to is not None:
        headers += [
            ("WARC-Profile", IDENTICAL), ("WARC-Refers-To", _record_id(refers_to)),
            ("X-Refers-To-Page-ID", _one_line(str(refers_to))),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _File:
    """An open archive file of a shard under a temporary name."""

    def __init__(self, root: str, shard: int, number: int, attempt: str, level: int):
        self.shard, self.level, self.records, self.bytes = shard, level, 0, 0
        self.name = f"part-{shard:08d}-{number:05d}.warc.gz"
        self.temporary = f"_temporary/{attempt}/{self.name}"
        self.sums = hashlib.sha256()
        fs, base = pafs.FileSystem.from_uri(root)
        fs.create_dir(f"{base}/_temporary/{attempt}", recursive=True)
        self.stream = fs.open_output_stream(f"{base}/{self.temporary}", compression=None)
        info = f"software: niimble\r\nformat: WARC File Format 1.1\r\nfilename: {self.name}\r\n".encode()
        head = (
            f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(NAMESPACE, self.name)}>\r\n"
            f"WARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
        )
        self._write(head.encode() + info + b"\r\n\r\n")

    def _write(self, record: bytes) -> None:
        member = _member(record, self.level)
        self.stream.write(member)
        self.sums.update(member)
        self.bytes += len(member)

    def add(self, record: bytes) -> None:
        self._write(record)
        self.records += 1

    def close(self) -> tuple:
        self.stream.close()
        return self.name, self.temporary, self.shard, self.records, self.bytes, self.sums.hexdigest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of the batches, a few at a time in memory as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*[c.to_pylist() for c in part.columns], strict=True)


def write_archives(
    pages: DataFrame,
    root: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    level: int = LEVEL,
) -> DataFrame:
    """Write the archives of ``pages`` under the new folder ``root`` and return their manifest."""
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    records = pages.select(
        F.col(id_column).alias("id"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"),
        F.col(url_column).cast("string").alias("url"), payload.alias("payload"),
    )
    light = records.select("id", "digest", "size")
    starts = plan_shards(light, shard_bytes)
    nothing = F.lit(None)
    # what a record refers to travels as a row of its own, ahead of the record: payloads move once
    notes = find_revisits(light).select(
        "id", "digest", nothing.cast("string").alias("url"), nothing.cast("binary").alias("payload"), "refers_to"
    )
    full = records.select("id", "digest", "url", "payload", nothing.cast(pages.schema[id_column].dataType).alias("refers_to"))
    rows = full.unionByName(notes)
    names = rows.columns

    def shard(batch: pa.RecordBatch):
        ids = batch.column(0).to_pylist()
        found = [0 if i is None else bisect.bisect_right(starts, i) for i in ids]
        yield {"shard": pa.array(found, pa.int64()), **{n: batch.column(k) for k, n in enumerate(names)}}

    sharded = arrow_stage(rows, shard, StructType([StructField("shard", LongType()), *rows.schema.fields]))
    # a partition for each shard by its number: a hash of so few numbers would put some together
    dealt = sharded.repartitionById(len(starts) + 1, F.col("shard").cast("int")).sortWithinPartitions(
        "shard", F.col("id").asc_nulls_first(), "digest", F.col("refers_to").asc_nulls_last(), "url"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        file, closed, number, noted, target = None, [], 0, None, None
        for shard, page, digest, url, payload, note in _rows(batches):
            if note is not None:
                noted, target = (page, digest), note
                continue
            refers_to = target if noted == (page, digest) else None
            if file is not None and (file.shard != shard or file.bytes >= roll_bytes):
                number = number + 1 if file.shard == shard else 0
                closed.append(file.close())
                file = None
            elif file is None:
                number = 0
            if file is None:
                file = _File(root, shard, number, attempt, level)
            file.add(build_record(page, url, payload, refers_to))
        if file is not None:
            closed.append(file.close())
        columns = list(zip(*closed, strict=True)) or [[]] * len(MANIFEST)
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], MANIFEST.fieldNames())

    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{root}/_manifest")
    return commit(pages.sparkSession, root)


def commit(spark: SparkSession, root: str) -> DataFrame:
    """Give the files of the manifest their names, delete all other temporary files, write the marker.

    May be repeated after a failure: a file that has its name already stays.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{root}/_manifest")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root)
        for name, temporary, size in _rows(batches):
            target = fs.get_file_info(f"{base}/{name}")
            if target.type != pafs.FileType.File or target.size != size:
                fs.move(f"{base}/{temporary}", f"{base}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([True])], ["done"])

    moved = manifest.select("name", "temporary", "bytes").mapInArrow(rename, StructType([StructField("done", BooleanType())]))
    expected = manifest.count()
    if moved.count() != expected:
        raise RuntimeError(f"not all files of {root} were renamed")
    fs, base = pafs.FileSystem.from_uri(root)
    if fs.get_file_info(f"{base}/_temporary").type == pafs.FileType.Directory:
        fs.delete_dir(f"{base}/_temporary")
    with fs.open_output_stream(f"{base}/_SUCCESS") as marker:
        marker.write(f"{expected} files\n".encode())
    return manifest


READ_SCHEMA = StructType([
    StructField("file", StringType()), StructField("page", StringType()), StructField("url", StringType()),
    StructField("record_type", StringType()), StructField("payload_bytes", LongType()),
    StructField("payload_digest", StringType()), StructField("refers_to", StringType()),
    StructField("payload", BinaryType()),
])


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a gzip stream; checks the block's length."""
    source = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 18)
    while line := source.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"a record begins with {line[:40]!r}")
        headers = {}
        while (line := source.readline().rstrip(b"\r\n")):
            key, _, value = line.decode().partition(": ")
            headers[key.lower()] = value
        block = source.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]) or source.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield headers, block


def _parsed(headers: dict[str, str], block: bytes) -> tuple:
    """Fields of a response or revisit; a digest that does not fit the bytes is an error."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    if headers["warc-type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {headers['warc-record-id']} does not fit its digest")
    return (
        headers.get("x-page-id"), headers.get("warc-target-uri"), headers["warc-type"], length, digest,
        headers.get("x-refers-to-page-id"), payload if headers["warc-type"] == "response" else None,
    )


def read_archives(spark: SparkSession, root: str, with_payload: bool = True, batch_bytes: int = 4 << 20) -> DataFrame:
    """The records of all committed files under ``root``. Files are streamed: one record is in memory at a time,
    and up to ``batch_bytes`` of payloads wait to be passed on."""
    files = spark.read.schema(MANIFEST).parquet(f"{root}/_manifest").select("name")
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], READ_SCHEMA.fieldNames())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root)
        waiting, held = [], 0
        for (name,) in _rows(batches):
            with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                for headers, block in read_records(stream):
                    if headers["warc-type"] == "warcinfo":
                        continue
                    row = _parsed(headers, block)
                    waiting.append((name, *row) if with_payload else (name, *row[:-1], None))
                    held += len(block) if with_payload else 256
                    if held >= batch_bytes:
                        yield batch_of(waiting)
                        waiting, held = [], 0
        yield batch_of(waiting)

    # a file is one row: dealt out one by one, as the size of the rows tells nothing of the files'
    # (by range: hashes of as many names as there are partitions would leave a third of these empty)
    return files.repartitionByRange(max(1, files.count()), "name").mapInArrow(read, READ_SCHEMA)

"""Token ids as length-delimited binary records, with an offset index beside each file.

A data file is a row of records, each framed as

    length   unsigned 64 bit, bytes of the payload
    check    unsigned 32 bit, masked crc32 of the eight length bytes
    payload  flag (1 byte: 1 if the doc_id is null), doc_id (signed 64 bit),
             width of an id in bytes (1 byte: 2 or 4), the ids
    check    unsigned 32 bit, masked crc32 of the payload

all little-endian. Its index is one unsigned 64-bit offset per record, so records can be
read in any order. `manifest` (Parquet, one row per data file) names the files that belong
to the set: a task that is run twice writes files under new names, and only those of the
attempt that Spark commits are in the manifest.
"""

from __future__ import annotations

import random
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticemill.session import file_system

HEAD = struct.Struct("<BqB")
FRAME = struct.Struct("<QI")
CHECK = struct.Struct("<I")
# Text of one file, in bytes.
FILE_BYTES = 32 << 20
MANIFEST = "file_no int, data string, offsets string, n_records long, n_ids long"
BATCH_BYTES = 4 << 20


class BrokenRecord(ValueError):
    """A record whose length or payload does not fit its checksum."""


def masked(raw: bytes) -> int:
    """crc32, rotated and shifted so that sums of data that hold sums stay apart."""
    check = zlib.crc32(raw)
    return (((check >> 15) | (check << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def framed(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = HEAD.pack(doc_id is None, doc_id or 0, width) + ids
    length = struct.pack("<Q", len(payload))
    return length + CHECK.pack(masked(length)) + payload + CHECK.pack(masked(payload))


def unframed(stream) -> tuple[int | None, int, bytes] | None:
    """The next record of a stream as (doc_id, width, ids); None at the end."""
    head = stream.read(FRAME.size)
    if not head:
        return None
    if len(head) < FRAME.size:
        raise BrokenRecord("a record's head is cut off")
    length, check = FRAME.unpack(head)
    if masked(bytes(head[:8])) != check:
        raise BrokenRecord("a record's length does not fit its checksum")
    body = stream.read(length + CHECK.size)
    if len(body) < length + CHECK.size:
        raise BrokenRecord("a record is cut off")
    payload = bytes(body[:length])
    if CHECK.unpack(body[length:])[0] != masked(payload):
        raise BrokenRecord("a record's payload does not fit its checksum")
    null, doc_id, width = HEAD.unpack(payload[: HEAD.size])
    return None if null else doc_id, width, payload[HEAD.size :]


def write_records(docs: DataFrame, path: str, tokenizer: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode `text` of each row and write the records in ascending doc_id order.

    Null doc_ids come first; rows with the same doc_id are ordered by a hash of their text
    (equal rows all stay). A null text has the end id alone. Other columns are ignored. The
    files follow each other in the order of `file_no`, with about `file_bytes` of text each.
    Returns the manifest, which is also in `path`/manifest.
    `path` must be a folder that all executors share.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    files = max(spark.sparkContext.defaultParallelism, -(-size // file_bytes))
    # equal rows of one id may be many: they are told apart by where they were read
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"), F.spark_partition_id().alias("_part"))
    order = ["doc_id", "_hash", "_part"]
    rows = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")
    folder, root = file_system(path)
    folder.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from noticemill.llm.tokens import encoder

        encode = encoder(tokenizer)
        number = TaskContext.get().partitionId()
        folder, root = file_system(path)
        name = f"{number:06d}-{uuid.uuid4().hex}"
        data, offsets = f"data-{name}.bin", f"offsets-{name}.idx"
        n_records = n_ids = place = 0
        with folder.open_output_stream(f"{root}/{data}") as out, folder.open_output_stream(f"{root}/{offsets}") as index:
            for doc_id, ids in encode.encode_batches(batches):
                record = framed(doc_id, ids, encode.width)
                out.write(record)
                index.write(struct.pack("<Q", place))
                place += len(record)
                n_records += 1
                n_ids += len(ids) // encode.width
        if n_records:
            columns = [[number], [data], [offsets], [n_records], [n_ids]]
            types = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["file_no", "data", "offsets", "n_records", "n_ids"])

    rows.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file, with `start`: the ids in all files before it."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_records(spark: SparkSession, path: str, shuffle_seed: int | None = None) -> DataFrame:
    """The records: doc_id, start (ids of all records before it), n_tokens, ids.

    `ids` is binary, little-endian unsigned 32-bit integers. A file is read by one task,
    record by record, in a random order through its offset index if `shuffle_seed` is
    given. A record that does not fit its checksums raises BrokenRecord.
    """
    manifest = read_manifest(spark, path).select("file_no", "data", "offsets", "start")
    files = manifest.repartition(max(1, spark.read.schema(MANIFEST).parquet(f"{path}/manifest").count()))
    names = ["doc_id", "start", "n_tokens", "ids"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def in_order(number: int, data, offsets: bytes) -> Iterator[tuple]:
        """(record number, record) in file order, or shuffled by the index."""
        places = struct.unpack(f"<{len(offsets) // 8}Q", offsets)
        wanted = list(range(len(places)))
        if shuffle_seed is not None:
            random.Random(f"{shuffle_seed}-{number}").shuffle(wanted)
        for k in wanted:
            if shuffle_seed is not None:
                data.seek(places[k])
            yield k, unframed(data)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from noticemill.llm.tokens import as_u32

        folder, root = file_system(path)
        for batch in batches:
            for row in batch.to_pylist():
                with folder.open_input_stream(f"{root}/{row['offsets']}") as index:
                    offsets = index.read()
                starts = _starts(folder, root, row, offsets) if shuffle_seed is not None else None
                opened = folder.open_input_file(f"{root}/{row['data']}")
                with pa.BufferedInputStream(opened, 1 << 20) if shuffle_seed is None else opened as data:
                    rows, size, start = [], 0, row["start"]
                    for k, (doc_id, width, ids) in in_order(row["file_no"], data, offsets):
                        n = len(ids) // width
                        wide = as_u32(ids, width)
                        rows.append((doc_id, starts[k] if starts else start, n, wide))
                        start += n
                        size += len(wide)
                        if size >= BATCH_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch_of(rows)

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _starts(folder, root: str, row: dict, offsets: bytes) -> list[int]:
    """Start of each record of a file, from the distances in its index and the id width."""
    places = [*struct.unpack(f"<{len(offsets) // 8}Q", offsets)]
    size = folder.get_file_info(f"{root}/{row['data']}").size
    with folder.open_input_file(f"{root}/{row['data']}") as data:
        width = HEAD.unpack(data.read_at(HEAD.size, FRAME.size))[2] if places else 2
    spare = FRAME.size + HEAD.size + CHECK.size
    starts, start = [], row["start"]
    for a, b in zip(places, [*places[1:], size]):
        starts.append(start)
        start += (b - a - spare) // width
    return starts

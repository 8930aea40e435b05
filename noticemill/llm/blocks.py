"""Documents in blocks, and what blocks have in common.

Operators that compare passages of documents first write the documents in blocks of some
megabytes, compressed, in a table bucketed by block. Whatever is found out elsewhere about
a block's passages is brought to the block by a cogroup, so texts are written once and not
shuffled, and each block meets a hash once however often it occurs inside.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import shared_dir, written
from noticemill.operators.skew import skew_join

# Text and rows of one block; a block has at least one row.
BLOCK_BYTES = 6 << 20
BLOCK_ROWS = 1 << 16
# Number of a row: its task's number, its block's number in the task, its place in the block.
ROW_BITS, LOCAL_BITS = 16, 20
# Text whose hashes one bucket gathers, on average.
BUCKET_BYTES = 3 << 20
LOW_BITS = np.uint64(40)
LOW = np.uint64((1 << 40) - 1)
# Stands for a null doc_id: after all others.
LAST = np.iinfo(np.int64).max

STORED = "block long, n_rows long, n_bytes long, payload binary"
HashesOf = Callable[[list], Iterator[np.ndarray]]


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard
    from pyspark import TaskContext

    press = zstandard.ZstdCompressor(level=3)
    block = TaskContext.get().partitionId() << LOCAL_BITS
    held: list[pa.RecordBatch] = []
    rows = size = 0

    def out() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        columns = ([block], [table.num_rows], [size], [press.compress(sink.getvalue())])
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "n_rows", "n_bytes", "payload"])

    for batch in batches:
        lengths = [len(x) if x else 0 for x in batch.column("_text").to_pylist()]
        start = 0
        for i, n in enumerate(lengths):
            rows += 1
            size += n
            if size >= BLOCK_BYTES or rows >= BLOCK_ROWS:
                held.append(batch.slice(start, i + 1 - start))
                yield out()
                held, rows, size, start = [], 0, 0, i + 1
                block += 1
        if start < len(lengths):
            held.append(batch.slice(start))
    if held:
        yield out()


def store(docs: DataFrame) -> DataFrame:
    """`docs` in blocks: block, n_rows, n_bytes, payload.

    `unpacked` gives back a block's rows: _doc_id, _text, and _row, a struct of all columns.
    The table lies in the shared folder and is bucketed by block.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").alias("_doc_id"), F.col("text").alias("_text"), F.struct(*(c for c in docs.columns if c != "text")).alias("_row"))
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    stored = rows.mapInArrow(_stored, STORED).write.bucketBy(buckets, "block")
    stored.option("path", f"{shared_dir(spark)}/noticemill-llm/{name}").saveAsTable(name)
    return spark.table(name)


def unpacked(payload: bytes) -> pa.Table:
    import zstandard

    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload)).read_all()


def row_number(block: int, place: int) -> int:
    return block << ROW_BITS | place


def n_buckets(stored: DataFrame) -> int:
    size = stored.agg(F.sum("n_bytes").alias("n")).first().n or 0
    return max(1, -(-size // BUCKET_BYTES))


def reduced(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A hash as its bucket (an equal range of the upper half) and its lower 40 bits."""
    bucket = (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    return bucket << LOW_BITS | (hashes & LOW)


def _packed(low: np.ndarray) -> bytes:
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel()


def common_hashes(
    stored: DataFrame, hashes_of: HashesOf, buckets: int, least: int = 2, apart: DataFrame | None = None
) -> DataFrame:
    """For each block those of its hashes that occur `least` times or more in all documents.

    `hashes_of` gives an array per text; an occurrence is an entry of such an array. Rows
    named in `apart` (block, place) are left out. Result: block, hashes (reduced, sorted,
    unsigned 64 bit) and counts (unsigned 32 bit), both binary; a block has one row per
    bucket. Equal reduced hashes of different passages are possible and rare: a hash is a
    hint that needs a closer look.
    """
    names, types = ["bucket", "block", "low", "n"], (pa.int64(), pa.int64(), pa.binary(), pa.binary())

    def emitted_by(block: int, texts: list) -> pa.Table:
        found = [x for x in hashes_of(texts) if len(x)]
        columns: tuple[list, ...] = ([], [], [], [])
        if found:
            values, n = np.unique(reduced(np.concatenate(found), buckets), return_counts=True)
            bucket = (values >> LOW_BITS).astype(np.int64)
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets)).tolist()
            for a, b in zip(edges[:-1], edges[1:]):
                row = (int(bucket[a]), block, _packed(values[a:b] & LOW), n[a:b].astype("<u4").tobytes())
                for column, value in zip(columns, row):
                    column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from emitted_by(block, unpacked(payload).column("_text").to_pylist()).to_batches()

    def emit_others(block: int, rows: pa.Table, found: pa.Table) -> pa.Table:
        left_out = set(found.column("place").to_pylist())
        texts = rows.column("_text").to_pylist()
        return emitted_by(block, [t for i, t in enumerate(texts) if i not in left_out])

    def count(group: pa.Table) -> pa.Table:
        blocks = group.column("block").to_pylist()
        low = [_unpacked(raw) for raw in group.column("low").to_pylist()]
        sizes = [len(x) for x in low]
        low = np.concatenate(low)
        n = np.concatenate([np.frombuffer(raw, "<u4") for raw in group.column("n").to_pylist()])
        order = np.argsort(low, kind="stable")
        starts = np.flatnonzero(np.diff(low[order], prepend=low[order[:1]] ^ np.uint64(1)))
        sums = np.minimum(np.add.reduceat(n[order].astype(np.int64), starts), 0xFFFFFFFF)
        total = np.empty(len(low), np.int64)
        total[order] = np.repeat(sums, np.diff(np.append(starts, len(low))))
        bucket = np.uint64(group.column("bucket")[0].as_py()) << LOW_BITS
        out, start = ([], [], []), 0
        for block, size in zip(blocks, sizes):
            keep = np.flatnonzero(total[start : start + size] >= least) + start
            if len(keep):
                out[0].append(block)
                out[1].append((low[keep] | bucket).astype("<u8").tobytes())
                out[2].append(total[keep].astype("<u4").tobytes())
            start += size
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.binary(), pa.binary()))], names=["block", "hashes", "counts"])

    schema = "bucket long, block long, low binary, n binary"
    if apart is None:
        emitted = stored.select("block", "payload").mapInArrow(emit, schema)
    else:
        emitted = with_blocks(stored, apart, emit_others, schema)
    return emitted.groupBy("bucket").applyInArrow(count, "block long, hashes binary, counts binary")


class Counts:
    """The common hashes of one block and how often each occurs."""

    def __init__(self, rows: pa.Table):
        hashes = [np.frombuffer(x, "<u8") for x in rows.column("hashes").to_pylist() if x is not None]
        counts = [np.frombuffer(x, "<u4") for x in rows.column("counts").to_pylist() if x is not None]
        values = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(values, kind="stable")
        self.values = values[order]
        self.n = (np.concatenate(counts) if counts else np.zeros(0, np.uint32))[order].astype(np.int64)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Occurrences of reduced hashes, 0 for those that are not common."""
        if not len(self.values):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.values, hashes), len(self.values) - 1)
        return np.where(self.values[at] == hashes, self.n[at], 0)


def copies(stored: DataFrame) -> DataFrame:
    """block, place of the rows whose whole text a row with a smaller doc_id (null last) has too."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = unpacked(payload)
                texts = rows.column("_text").to_pylist()
                columns = (
                    [block] * len(texts),
                    range(len(texts)),
                    [LAST if d is None else d for d in rows.column("_doc_id").to_pylist()],
                    [xxhash.xxh3_128_digest(t or "") for t in texts],
                )
                types = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "place", "doc", "digest"])

    rows = stored.select("block", "payload").mapInArrow(digests, "block long, place int, doc long, digest binary")
    rows = written(rows.hint("rebalance"), "digests")  # few short columns: few files
    firsts = rows.groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("_rows"))
    firsts = written(firsts.filter("first < last"), "first-copies")
    # one text may have very many copies: its rows are spread
    sizes = firsts.select("digest", "_rows")
    met = skew_join(rows, firsts.drop("_rows"), ["digest"], "inner", ["block", "place"], sizes)
    return written(met.filter("doc > first").select("block", "place"), "copies")


def with_blocks(stored: DataFrame, found: DataFrame, fn, schema) -> DataFrame:
    """`fn(block, rows of the block, rows of `found` for it)` for every block; it returns a table.

    A block without rows in `found` is called with an empty table.
    """

    def call(left: pa.Table, right: pa.Table) -> pa.Table:
        # rows of `found` without a block of theirs can't be: every block number is a block's
        payloads = left.column("payload").to_pylist()
        return fn(left.column("block")[0].as_py(), unpacked(payloads[0]), right)

    return stored.select("block", "payload").groupBy("block").cogroup(found.groupBy("block")).applyInArrow(call, schema)

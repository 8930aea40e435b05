"""Keyword search on an index: positional trigram postings in place of a scan of all texts.

A batch of texts is cut into portions of about `PORTION_CHARACTERS` characters. A portion's
texts are kept in a folder of their own; its postings are rows of a gram of three characters
with the places where the gram stands. A gram is one number (21 bits for each code point;
past its end a text goes on with zeros, so every character begins a gram). A place counts
from the start of the portion, in which texts stand one after the other, two zeros apart.
Kept are the distances between places, seven bits to a byte.

A term is looked up by its rarest grams: their lists are intersected with the offsets
taken off, portion by portion. The texts left are read and compared with the term, which
decides. Adding a batch writes a folder of its own and touches no other; no text and no
posting is shuffled for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticemill.operators.keywords import clauses_of, lists_satisfied
from noticemill.session import file_system, new_path, stage

PORTION_CHARACTERS = 8_000_000
BUCKETS = 16
# Grams of a term that are looked up, the rarest ones. What they leave is compared with the text.
LOOKED_UP = 3
CODE_BITS = 21
GRAM = 3
# Places in a row of the postings at most; a frequent gram has several rows in a portion.
LIST_PLACES = 16_384
# Places that are handled at a time.
STEP = 1 << 18

TEXT = "portion bigint, start bigint, id bigint, text string, batch string"
POSTING = "portion bigint, gram bigint, n int, places binary, batch string, bucket int"
COVER = "term string, key bigint, length int, offset int"
CANDIDATE = "batch string, portion bigint, term string, places binary"


def grams_of(text: str) -> np.ndarray:
    """The gram that begins at each character."""
    codes = np.frombuffer((text + "\0" * (GRAM - 1)).encode("utf-32-le"), "<u4").astype(np.int64)
    return codes[:-2] << 2 * CODE_BITS | codes[1:-1] << CODE_BITS | codes[2:]


def _packed(places: np.ndarray, begins: np.ndarray) -> pa.Array:
    """The lists of places that begin at `begins`, as bytes: the first place of a list, then the distances."""
    gaps = np.diff(places, prepend=0)
    gaps[begins] = places[begins]
    sizes, limit = np.ones(len(gaps), np.int64), 128
    while (longer := gaps >= limit).any():
        sizes += longer
        limit <<= 7
    ends = np.cumsum(sizes)
    data, at = np.empty(ends[-1], np.uint8), ends - sizes
    while len(at):
        more = gaps >= 128
        data[at] = gaps & 127 | more << 7
        at, gaps = at[more] + 1, gaps[more] >> 7
    offsets = np.r_[0, ends[begins[1:] - 1], ends[-1]].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _unpacked(data: bytes) -> np.ndarray:
    """The places of one list."""
    coded = np.frombuffer(data, np.uint8)
    last = coded < 128
    at = np.r_[0, np.flatnonzero(last)[:-1] + 1]
    gaps, which, bits = (coded[at] & 127).astype(np.int64), np.arange(len(at)), 0
    while len(which := which[~last[at]]):
        at, bits = at[~last[at]] + 1, bits + 7
        gaps[which] |= (coded[at] & 127).astype(np.int64) << bits
    return np.cumsum(gaps)


def _portions(batches: Iterator[pa.RecordBatch], characters: int) -> Iterator[pa.RecordBatch]:
    """(portion, start, id, text): the texts, and where they start inside portions of this task."""
    from pyspark import TaskContext

    portion = TaskContext.get().partitionId() << 32
    start = size = 0
    for batch in batches:
        places = []
        for text in batch.column(1).to_pylist():
            if size >= characters:
                portion, start, size = portion + 1, 0, 0
            places.append((portion, start))
            start, size = start + len(text) + GRAM - 1, size + len(text)
        if places:
            first, second = zip(*places)
            yield pa.record_batch([pa.array(first, pa.int64()), pa.array(second, pa.int64()), *batch.columns], names=["portion", "start", "id", "text"])


def _by_gram(codes: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of real characters in order of their grams, then ascending; and where each gram's begin."""
    alphabet = np.unique(codes)
    bits, letters = len(real).bit_length(), len(alphabet)
    if letters**GRAM << bits >= 1 << 63:  # a gram and a place are too large for one number
        grams = codes[:-2].astype(np.int64) << 2 * CODE_BITS | codes[1:-1].astype(np.int64) << CODE_BITS | codes[2:]
        grams[~real] = np.iinfo(np.int64).max
        order = np.argsort(grams, kind="stable")[: np.count_nonzero(real)]
        heads = grams[order]
    else:
        rank = np.zeros(alphabet[-1] + 1, np.int64)
        rank[alphabet] = np.arange(letters)
        order = np.empty(len(real), np.int64)
        for i in range(0, len(real), STEP):
            ranks = rank[codes[i : i + STEP + 2]]
            gram = (ranks[:-2] * letters + ranks[1:-1]) * letters + ranks[2:]
            order[i : i + STEP] = gram << bits | np.arange(i, i + len(gram))
        order[~real] = np.iinfo(np.int64).max
        order.sort()
        order = order[: np.count_nonzero(real)]
        heads = order >> bits
        order &= (1 << bits) - 1
    return order, np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (portion, gram, n, places); the texts of a portion come one after the other.

    Where Spark reads a portion in two tasks, each makes rows of its own.
    """
    held: list[tuple[int, str]] = []
    current = None

    def flush() -> Iterator[pa.RecordBatch]:
        first = min(start for start, _ in held)
        real = np.zeros(max(start + len(text) for start, text in held) - first, bool)
        codes = np.zeros(len(real) + GRAM - 1, np.uint32)
        for start, text in held:
            own = slice(start - first, start - first + len(text))
            codes[own], real[own] = np.frombuffer(text.encode("utf-32-le"), "<u4"), True
        held.clear()
        order, begins = _by_gram(codes, real)
        # a list of more than LIST_PLACES is cut into several
        parts = -(-np.diff(np.r_[begins, len(order)]) // LIST_PLACES)
        cuts = np.repeat(begins - LIST_PLACES * (np.cumsum(parts) - parts), parts) + LIST_PLACES * np.arange(parts.sum())
        ends = np.r_[cuts[1:], len(order)]
        i = 0
        while i < len(cuts):
            j = min(i + 4096, max(i + 1, int(np.searchsorted(ends, cuts[i] + STEP))))
            at = order[cuts[i:j]]
            yield pa.record_batch(
                [
                    pa.array(np.full(j - i, current)),
                    pa.array(codes[at].astype(np.int64) << 2 * CODE_BITS | codes[at + 1].astype(np.int64) << CODE_BITS | codes[at + 2]),
                    pa.array((ends[i:j] - cuts[i:j]).astype(np.int32)),
                    _packed(order[cuts[i] : ends[j - 1]] + first, cuts[i:j] - cuts[i]),
                ],
                names=["portion", "gram", "n", "places"],
            )
            i = j

    for batch in batches:
        for portion, start, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
            if held and portion != current:
                yield from flush()
            current = portion
            if text:
                held.append((start, text))
    if held:
        yield from flush()


def add_to_index(
    texts: DataFrame, path: str, batch: str, id_col: str = "doc_id", text_col: str = "text", characters: int = PORTION_CHARACTERS
) -> None:
    """Index a batch of texts below `path`, a folder that all executors share.

    Null texts are left out; an id may have any number of texts. A batch that is added
    again replaces itself and nothing else.
    """
    spark = texts.sparkSession
    rows = texts.select(F.col(id_col).cast("bigint").alias("id"), F.lower(text_col).alias("text")).dropna(subset=["text"])
    numbered = rows.mapInArrow(partial(_portions, characters=characters), "portion bigint, start bigint, id bigint, text string")
    own = f"{path}/texts/batch={batch}"
    numbered.write.mode("overwrite").option("compression", "zstd").partitionBy("portion").parquet(own)
    # a portion is one file, which a task reads from end to end; nothing has to be shuffled
    stored = spark.read.schema("portion bigint, start bigint, text string").parquet(own)
    postings = stored.select("portion", "start", "text").mapInArrow(_postings, "portion bigint, gram bigint, n int, places binary")
    bucket = F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)).cast("int")
    (
        postings.withColumn("bucket", bucket)
        .sortWithinPartitions("bucket", "gram")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("bucket")
        .parquet(f"{path}/postings/batch={batch}")
    )


def _covers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams that cover a term, each with its offset; of a shorter term what its grams begin with."""
    for batch in batches:
        rows = []
        for term in batch.column(0).to_pylist():
            n = len(term)
            grams = grams_of(term).tolist()
            if n < GRAM:
                rows.append((term, grams[0] >> CODE_BITS * (GRAM - n), n, 0))
            else:
                offsets = sorted({*range(0, n - GRAM + 1, GRAM), n - GRAM})
                rows += [(term, grams[i], GRAM, i) for i in offsets]
        types = (pa.string(), pa.int64(), pa.int32(), pa.int32())
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["term", "key", "length", "offset"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(batch, portion, term, places): where in a portion a term may stand.

    The rows of a term in a portion come one after the other, with the places of the grams
    looked up; those of one offset are one list, and the lists are intersected.
    """
    current = None
    held: dict[int, list[np.ndarray]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        *key, size = current
        if len(held) == size:
            lists = sorted((np.sort(np.concatenate(parts)) - offset for offset, parts in held.items()), key=len)
            common = reduce(partial(np.intersect1d, assume_unique=True), lists)
            common = common[np.searchsorted(common, 0) :]
            if len(common):
                columns = [pa.array([x], t) for x, t in zip(key, (pa.string(), pa.int64(), pa.string()))]
                yield pa.record_batch([*columns, _packed(common, np.zeros(1, np.int64))], names=["batch", "portion", "term", "places"])
        held.clear()

    for batch in batches:
        for *key, offset, places in zip(*[column.to_pylist() for column in batch.columns]):
            if held and key != current:
                yield from flush()
            current = key
            held.setdefault(offset, []).append(_unpacked(places))
    if held:
        yield from flush()


def _compared(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(id, term) of the texts that contain a term where a candidate below `path` stands.

    The texts of a portion are held and its candidates read term by term; texts are not moved to them.
    """
    import pyarrow.dataset as ds

    folder, root = file_system(path)
    held: list[tuple[int, int, str]] = []
    current = None

    def flush() -> Iterator[pa.RecordBatch]:
        at, *portion = current
        starts, ids, texts = zip(*sorted(held, key=lambda row: row[0]))
        held.clear()
        stored = ds.dataset(f"{root}/at={at}", filesystem=folder, format="parquet")
        for some in stored.to_batches(columns=["batch", "portion", "term", "places"], batch_size=512):
            hits = []
            for *of, term, places in zip(*[column.to_pylist() for column in some.columns]):
                if of == portion:
                    near = np.unique(np.searchsorted(starts, _unpacked(places), "right") - 1)
                    hits += [(ids[i], term) for i in near[near >= 0].tolist() if term in texts[i]]
            if hits:
                found = zip(zip(*hits), (pa.int64(), pa.string()))
                yield pa.record_batch([pa.array(c, t) for c, t in found], names=["id", "term"])

    for batch in batches:
        for *key, start, id_, text in zip(*[column.to_pylist() for column in batch.columns]):
            if held and key != current:
                yield from flush()
            current = key
            held.append((start, id_, text))
    if held:
        yield from flush()


def indexed_terms(spark: SparkSession, path: str, terms: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, term) for each of `terms` (lower case, not empty) that a text of the index contains.

    Read are the grams looked up and the portions with texts that may contain a term.
    """
    cover = stage(terms.select("term").distinct().mapInArrow(_covers, COVER), "cover")
    postings = spark.read.schema(POSTING).parquet(f"{path}/postings")
    long = cover.filter(F.col("length") == GRAM).withColumnRenamed("key", "gram")
    long = long.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(BUCKETS)).cast("int"))

    # how often each gram stands anywhere: only these two columns of the postings are read
    wanted = long.select("bucket", "gram").distinct()
    counts = postings.select("bucket", "gram", "n").join(wanted, ["bucket", "gram"], "left_semi").groupBy("gram").agg(F.sum("n").alias("_n"))
    by_rarity = Window.partitionBy("term").orderBy(F.coalesce("_n", F.lit(0)), "offset")
    looked_up = long.join(counts, "gram", "left").withColumn("_rank", F.row_number().over(by_rarity)).filter(F.col("_rank") <= LOOKED_UP)
    looked_up = stage(looked_up.withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy("term"))), "looked-up")

    # the lists of one portion meet in one task
    lists = postings.join(looked_up.filter("_rank > 0"), ["bucket", "gram"])
    lists = lists.select("batch", "portion", "term", F.col("_size").cast("int").alias("size"), "offset", "places")
    for length in range(1, GRAM):
        short = cover.filter(F.col("length") == length).select("term", "key", F.lit(1).alias("size"), "offset")
        head = F.shiftright("gram", CODE_BITS * (GRAM - length))
        lists = lists.unionByName(postings.withColumn("key", head).join(short, "key").select(lists.columns))
    lists = lists.repartition("batch", "portion").sortWithinPartitions("batch", "portion", "term", "size", "offset")
    candidates = new_path(spark, "candidates")
    met = lists.mapInArrow(_met, CANDIDATE)
    at = F.xxhash64("batch", "portion")
    met.withColumn("at", at).write.partitionBy("at").parquet(candidates)
    portions = stage(spark.read.schema(CANDIDATE).parquet(candidates).select("batch", "portion").distinct(), "portions")

    texts = spark.read.schema(TEXT).parquet(f"{path}/texts")
    # the candidates' portions, a row for each folder, select the folders that are opened; Spark prunes by
    # a join only where the other side is filtered, so the filter, true of every row, has to be there
    opened = texts.join(F.broadcast(portions.filter("portion >= 0")), ["batch", "portion"], "left_semi")
    found = opened.select(at.alias("at"), "batch", "portion", "start", "id", "text").mapInArrow(
        partial(_compared, path=candidates), "id bigint, term string"
    )
    return found.select(F.col("id").alias(id_col), "term").distinct()


def indexed_matches(spark: SparkSession, path: str, lists: DataFrame, policy: str, id_col: str = "doc_id") -> DataFrame:
    """Distinct (list_id, id) of the lists that the indexed texts of an id match: `keyword_matches` on an index."""
    clauses = clauses_of(lists, policy)
    return lists_satisfied(indexed_terms(spark, path, clauses.select("term"), id_col), clauses, id_col)

"""Scoring texts with bigram counts from a log-frequency Bloom filter.

The filter holds no counts, only pairs (bigram, level): a bigram seen c times is stored at
the levels 1 to q(c), where q grows with the logarithm of c. A reader probes level after
level until one is missing and takes the mean count of the bigrams whose last level that is.
The probability of a word interpolates that count with the word's own frequency, weighted
as by Witten and Bell: c / (c + t) for a history seen c times with t different successors.
The t of single histories are not gathered; t is taken as c ** b, with the one b at which
all t add up to the number of different bigrams, which the filter's tasks count. A history
that training does not hold has weight 0, so the word's own frequency is all there is.

Documents are cut into blocks with a vocabulary of their own, so that the exact count of a
word reaches a block once, not once per token; the counts of all blocks meet in one shuffle
of (word, block) rows. The filter's segments are built by the tasks that own a range of
bigram hashes, which write them to the shared folder. The filter grows with the corpus:
tasks load slices of about `max_filter_bytes` from there, one pass after the other, and each
token is scored by the slice that owns its bigram. No part of it passes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticemill.llm.common import work_path, written
from noticemill.llm.hashing import MULTIPLIER, WordHashes, mixed, word_hash
from noticemill.session import file_system

FOLDS, HELD_OUT = 7, 2
# Text of one block, in bytes; a block has at least one document.
BLOCK_BYTES = 6 << 20
# Bigrams that a task gathers before it hands them on, and that one segment is made from.
GATHERED = 2_000_000
SEGMENT_BIGRAMS = 2_000_000
# A bigram is stored at as many levels as there are powers of this base up to its count.
LEVEL_BASE = 2.0
MAX_LEVELS = 64
BITS_PER_ENTRY, PROBES = 12, 6
MAX_FILTER_BYTES = 128 << 20
# Exponents at which the successors of all histories are added up, for the one between.
EXPONENTS = [i / 32 for i in range(33)]
END = b""
LOW_40 = np.uint64((1 << 40) - 1)


def tokens(text: str | None) -> list[bytes]:
    """A-Z in small letters, words between white space, then the end."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


def bigram_hashes(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mixed(before * MULTIPLIER + after)


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """The segment that owns a hash: equal ranges of the upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _seed_and_step(low: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Probe i of (bigram, level) looks at bit seed + i * step; `low` are 40 bits of the hash."""
    seed = mixed(low + np.uint64(level * int(MULTIPLIER) & 0xFFFFFFFFFFFFFFFF))
    return seed & np.uint64(0xFFFFFFFF), (seed >> np.uint64(32)) | np.uint64(1)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """How many levels a count is stored at: one for 1, two from 2 on, three from 4 on; 0 for 0."""
    logs = np.log(np.maximum(counts, 1)) / math.log(LEVEL_BASE)
    return np.where(counts > 0, np.minimum(1 + np.floor(logs + 1e-9), MAX_LEVELS), 0).astype(np.int64)


def filter_segment(low: np.ndarray, counts: np.ndarray) -> tuple[int, bytes]:
    """Bits of a segment for bigrams (40 bits of their hashes) with their counts."""
    levels = levels_of(counts)
    n_bits = max(64, BITS_PER_ENTRY * int(levels.sum()) | 1)
    bits = np.zeros(n_bits, bool)
    size = np.uint64(n_bits)
    for level in range(1, int(levels.max(initial=0)) + 1):
        seed, step = _seed_and_step(low[levels >= level], level)
        for i in range(PROBES):
            bits[((seed + np.uint64(i) * step) % size).astype(np.int64)] = True
    return n_bits, np.packbits(bits, bitorder="little").tobytes()


class CountFilter:
    """Segments [first, first + k) of a filter of `segments` in all, for probing."""

    def __init__(self, segments: int, first: int, parts: list[tuple[int, bytes]]):
        self.segments, self.first = segments, first
        self.n_bits = np.array([max(n, 1) for n, _ in parts], np.uint64)
        sizes = np.array([len(raw) for _, raw in parts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.raw = b"".join(raw for _, raw in parts)

    def levels(self, hashes: np.ndarray, seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes belong to these segments, and the levels found for them (else 0).

        `seen`: how often each is known to be stored at least; those levels are not probed.
        """
        segment = segment_of(hashes, self.segments) - self.first
        mine = (segment >= 0) & (segment < len(self.n_bits))
        waiting = np.flatnonzero(mine)
        levels = np.zeros(len(hashes), np.int64) if seen is None else np.where(mine, levels_of(seen), 0)
        raw = np.frombuffer(self.raw, np.uint8)
        level = 1
        while len(waiting):
            known = levels[waiting] >= level
            places, waiting = waiting[~known], waiting[known]
            own = segment[places]
            n_bits, start = self.n_bits[own], self.starts[own]
            alive = np.arange(len(places))
            seed, step = _seed_and_step(hashes[places] & LOW_40, level)
            for i in range(PROBES):
                bit = ((seed[alive] + np.uint64(i) * step[alive]) % n_bits[alive]).astype(np.int64)
                alive = alive[(raw[start[alive] + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1 == 1]
                if not len(alive):
                    break
            places = places[alive]
            levels[places] = level
            waiting = np.concatenate([waiting, places])
            level += 1
        return mine, levels


@dataclass
class StoredFilter:
    """A filter in the shared folder, a folder for each segment, and what its tasks counted."""

    path: str
    segments: int
    slice_segments: int
    bigrams: int
    # mean count of the bigrams that end at level 0, 1, 2 …
    means: np.ndarray

    def slices(self) -> list[tuple[int, int]]:
        step = self.slice_segments
        return [(a, min(a + step, self.segments)) for a in range(0, self.segments, step)]


# The slice a worker has loaded last: (path, first, last) and its filter.
_loaded: dict[tuple[str, int, int], CountFilter] = {}


def loaded_slice(path: str, segments: int, first: int, last: int) -> CountFilter:
    """Segments first to last - 1 from the shared folder; a segment without bigrams has no folder."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    if (path, first, last) not in _loaded:
        _loaded.clear()
        folder, root = file_system(path)
        parts = []
        for k in range(first, last):
            part = (64, bytes(8))
            if folder.get_file_info(f"{root}/segment={k}").type == fs.FileType.Directory:
                stored = ds.dataset(f"{root}/segment={k}", filesystem=folder, format="parquet").to_table(columns=["n_bits", "bits"])
                part = (stored.column("n_bits")[0].as_py(), stored.column("bits")[0].as_py())
            parts.append(part)
        _loaded[path, first, last] = CountFilter(segments, first, parts)
    return _loaded[path, first, last]


def history_weights(totals: np.ndarray, exponent: float) -> np.ndarray:
    """Weight of the bigram estimate after histories seen so often: c / (c + c ** exponent), 0 for c = 0."""
    c = totals.astype(np.float64)
    return np.where(c > 0, c / np.maximum(c + c**exponent, 1), 0.0)


def interpolated(counts: np.ndarray, totals: np.ndarray, unigram: np.ndarray, exponent: float) -> np.ndarray:
    """Probability of words after histories seen `totals` times, `counts` times with the word next.

    Over all words it adds up to one if the counts do to their history's total.
    """
    weight = history_weights(totals, exponent)
    return weight * counts / np.maximum(totals, 1) + (1 - weight) * unigram


def successor_exponent(sums: list[float], bigrams: int) -> float:
    """Where the sum of c ** b over all histories, given at `EXPONENTS`, is the number of bigrams.

    Taken in a straight line between the logarithms of two neighbouring sums; without
    training tokens, or with one word only, any will do and it is 1.
    """
    if not bigrams or sums[0] <= 0 or sums[-1] <= sums[0]:
        return 1.0
    return float(np.interp(math.log(bigrams), np.log(sums), EXPONENTS))


@dataclass
class Corpus:
    """Documents in blocks, with the counts of each block's words over all training tokens."""

    blocks: DataFrame
    words: DataFrame
    train_tokens: int
    train_words: int
    # sums of c ** b over the words seen c times, for b of EXPONENTS
    power_sums: list[float]


BLOCK_SCHEMA = "block long, row int, doc_id long, held_out boolean, codes binary, word binary, code int, n long"
BLOCK_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int32(), pa.int64())
BLOCK_NAMES = ["block", "row", "doc_id", "held_out", "codes", "word", "code", "n"]


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents as codes of their block's words, and rows of these words."""
    import zstandard
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    press = zstandard.ZstdCompressor(level=1)
    codes_of = Numbers()
    counts: list[np.ndarray] = []
    size = number = 0

    def words() -> pa.RecordBatch:
        n = len(codes_of)
        total = np.zeros(n, np.int64)
        for codes in counts:
            total += np.bincount(codes, minlength=n)
        nothing = [None] * n
        columns = ([block] * n, nothing, nothing, nothing, nothing, list(codes_of), np.arange(n, dtype=np.int32), total)
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, BLOCK_TYPES)], names=BLOCK_NAMES)

    for batch in batches:
        rows = []
        for doc_id, text, held in zip(*(batch.column(i).to_pylist() for i in range(3))):
            found = tokens(text)
            codes = np.fromiter(map(codes_of.__getitem__, found), np.int32, len(found))
            if not held:
                counts.append(codes)
            rows.append((block, number, doc_id, held, press.compress(codes.tobytes()), None, None, None))
            size += len(text or "")
            number += 1
            if size >= BLOCK_BYTES:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), BLOCK_TYPES)], names=BLOCK_NAMES)
                yield words()
                rows, codes_of, counts, size, number = [], Numbers(), [], 0, 0
                block += 1
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), BLOCK_TYPES)], names=BLOCK_NAMES)
    if codes_of:
        yield words()


def with_fold(docs: DataFrame) -> DataFrame:
    """doc_id, text, held_out: crc32 of the id as text leaves HELD_OUT; false for a null id."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT
    return docs.select("doc_id", "text", F.coalesce(fold, F.lit(False)).alias("held_out"))


def read_corpus(docs: DataFrame) -> Corpus:
    """Blocks of `docs` (doc_id, text, held_out) and exact counts of their words."""
    staged = written(docs.select("doc_id", "text", "held_out").mapInArrow(_blocks, BLOCK_SCHEMA), "lm-blocks")
    same_word = Window.partitionBy("word")
    counted = staged.filter(F.col("word").isNotNull()).select(
        "block",
        "code",
        "word",
        F.sum("n").over(same_word).alias("total"),
        (F.col("block") == F.min("block").over(same_word)).alias("first"),
    )
    words = written(counted, "lm-words")
    # how many words training holds so often: few rows
    often = words.filter(F.col("first") & (F.col("total") > 0)).groupBy("total").agg(F.count(F.lit(1)).alias("n"))
    powers = [F.sum(F.pow(F.col("total").cast("double"), F.lit(b)) * F.col("n")) for b in EXPONENTS]
    n_tokens, n_words, *power_sums = often.agg(F.sum(F.col("total") * F.col("n")), F.sum("n"), *powers).first()
    docs_only = staged.filter(F.col("codes").isNotNull()).select("block", "row", "doc_id", "held_out", "codes")
    return Corpus(docs_only, words.select("block", "code", "word", "total"), n_tokens or 0, n_words or 0, [x or 0.0 for x in power_sums])


def count_filter(docs: DataFrame, train_tokens: int, max_filter_bytes: int = MAX_FILTER_BYTES) -> StoredFilter:
    """The filter over training documents, written segment by segment."""
    segments = max(1, -(-train_tokens // SEGMENT_BIGRAMS))
    names = ["segment", "low", "n"]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        held: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            hashes, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            owner = segment_of(hashes, segments)
            edges = np.flatnonzero(np.diff(owner, prepend=-1, append=segments))
            low = (hashes & LOW_40).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            cuts = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
            columns = (
                [int(owner[a]) for a, _ in cuts],
                [low[a:b].tobytes() for a, b in cuts],
                [n[a:b].astype("<u4").tobytes() for a, b in cuts],
            )
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], names=names)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = tokens(text)
                hashes = known.array(found)
                held.append(bigram_hashes(np.concatenate([hashes[-1:], hashes[:-1]]), hashes))
                size += len(found)
                if size >= GATHERED:
                    yield out()
                    size = 0
        if held:
            yield out()

    def build(group: pa.Table) -> pa.Table:
        low, n = [], []
        for raw, counts in zip(group.column("low").to_pylist(), group.column("n").to_pylist()):
            wide = np.zeros((len(counts) // 4, 8), np.uint8)
            wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
            low.append(wide.view("<u8").ravel())
            n.append(np.frombuffer(counts, "<u4"))
        low, n = np.concatenate(low), np.concatenate(n).astype(np.int64)
        order = np.argsort(low, kind="stable")
        low, n = low[order], n[order]
        starts = np.flatnonzero(np.diff(low, prepend=low[:1] ^ np.uint64(1)))
        counts = np.add.reduceat(n, starts)
        n_bits, bits = filter_segment(low[starts], counts)
        levels = levels_of(counts)
        row = (
            group.column("segment")[0].as_py(),
            n_bits,
            bits,
            np.bincount(levels, minlength=MAX_LEVELS + 1).tolist(),
            np.bincount(levels, weights=counts, minlength=MAX_LEVELS + 1).tolist(),
        )
        types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64()))
        return pa.table([pa.array([c], t) for c, t in zip(row, types)], names=["segment", "n_bits", "bits", "n_at", "sum_at"])

    spark = docs.sparkSession
    path, schema = work_path(spark, "lm-filter"), "n_bits long, bits binary, n_at array<long>, sum_at array<double>"
    gathered = docs.filter(~F.col("held_out")).select("text").mapInArrow(gather, "segment long, low binary, n binary")
    built = gathered.groupBy("segment").applyInArrow(build, f"segment long, {schema}")
    built.write.partitionBy("segment").parquet(path)
    levels = range(MAX_LEVELS + 1)
    found = spark.read.schema(f"{schema}, segment long").parquet(path).agg(
        F.max("n_bits").alias("largest"),
        F.array(*(F.sum(F.col("n_at")[i]) for i in levels)).alias("n_at"),
        F.array(*(F.sum(F.col("sum_at")[i]) for i in levels)).alias("sum_at"),
    ).first()
    n_at, sum_at = (np.array([x or 0 for x in column], np.float64) for column in (found.n_at, found.sum_at))
    slice_segments = max(1, max_filter_bytes // ((found.largest or 64) // 8 + 1))
    # a level found by mistake above all stored ones counts as the last of these
    means = np.maximum.accumulate(np.where(n_at > 0, sum_at / np.maximum(n_at, 1), 0.0))
    return StoredFilter(path, segments, slice_segments, int(n_at.sum()), means)


SCORE_SCHEMA = "block long, row int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _score_blocks(corpus: Corpus, stored: StoredFilter, first: int, last: int) -> DataFrame:
    """Per document the sums over those tokens whose bigrams lie in segments first to last - 1."""
    path, segments, means = stored.path, stored.segments, stored.means
    exponent = successor_exponent(corpus.power_sums, stored.bigrams)
    n_all, v_all = corpus.train_tokens, corpus.train_words
    whole = first == 0

    def score(docs: pa.Table, words: pa.Table) -> pa.Table:
        import zstandard

        expand = zstandard.ZstdDecompressor()
        size = words.num_rows
        code = words.column("code").to_numpy()
        total, hashes = np.zeros(size, np.int64), np.zeros(size, np.uint64)
        total[code] = words.column("total").to_numpy()
        hashes[code] = np.fromiter(map(word_hash, words.column("word").to_pylist()), np.uint64, size)
        unigram = (total + 1.0) / (n_all + v_all + 1.0)
        by_code = np.log10(unigram)
        end = int(np.flatnonzero(hashes == np.uint64(word_hash(END)))[0])
        texts = [np.frombuffer(expand.decompress(raw), np.int32) for raw in docs.column("codes").to_pylist()]
        lengths = np.array([len(t) for t in texts])
        all_codes = np.concatenate(texts).astype(np.int64)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        before = np.empty_like(all_codes)
        before[1:] = all_codes[:-1]
        before[starts] = end
        pairs, where = np.unique(before * size + all_codes, return_inverse=True)
        a, b = pairs // size, pairs % size
        learnt = np.repeat(~docs.column("held_out").to_numpy(), lengths)
        seen = np.bincount(where[learnt], minlength=len(pairs))
        mine, levels = loaded_slice(path, segments, first, last).levels(bigram_hashes(hashes[a], hashes[b]), seen)
        # a bigram is never seen more often than its words
        counts = np.minimum(means[levels], np.minimum(total[a], total[b]))
        estimate = interpolated(counts, total[a], unigram[b], exponent)
        logs = np.where(mine, np.log10(estimate), 0.0)
        summed = np.add.reduceat(logs[where], starts)
        base = np.add.reduceat(by_code[all_codes], starts) if whole else np.zeros(len(texts))
        known = np.add.reduceat((total[all_codes] > 0).astype(np.int64), starts)
        return pa.table(
            {
                "block": docs.column("block"),
                "row": docs.column("row"),
                "doc_id": docs.column("doc_id"),
                "held_out": docs.column("held_out"),
                "n_tokens": pa.array(lengths, pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "base": pa.array(base, pa.float64()),
                "score": pa.array(summed, pa.float64()),
            }
        )

    return corpus.blocks.groupBy("block").cogroup(corpus.words.groupBy("block")).applyInArrow(score, SCORE_SCHEMA)


def score(docs: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Scores of all rows of `docs` by a model learnt from those whose fold is not held out.

    doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens,
    train_words, base_score (smoothed unigrams) and score (the bigram model), both sums of
    log10. A null or empty text has the end token alone; a null doc_id is never held out;
    repeated rows are scored, and learnt from, each. Other columns are ignored.
    """
    rows = with_fold(docs)
    corpus = read_corpus(rows)
    stored = count_filter(rows, corpus.train_tokens, max_filter_bytes)
    parts = [_score_blocks(corpus, stored, a, b) for a, b in stored.slices()]
    scored = parts[0]
    if len(parts) > 1:
        scored = reduce(DataFrame.unionByName, parts).groupBy("block", "row").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("held_out").alias("held_out"),
            F.max("n_tokens").alias("n_tokens"),
            F.max("n_known").alias("n_known"),
            F.sum("base").alias("base"),
            F.sum("score").alias("score"),
        )
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(corpus.train_tokens).cast("bigint").alias("train_tokens"),
        F.lit(corpus.train_words).cast("bigint").alias("train_words"),
        F.col("base").alias("base_score"),
        "score",
    )

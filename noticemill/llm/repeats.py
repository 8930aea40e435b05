"""Word windows that occur in more than one place, found through sampled positions.

A window of `length` words is represented by its anchor: the run of `gram` words inside it
with the smallest hash. Equal windows have the same anchor at the same place, and
neighbouring windows mostly share theirs, so a document is sampled at a fraction of its
words. Anchors that occur once in the corpus drop out after one exchange of hashes. For the
others, the stretch of words whose windows have that anchor (a segment) goes to the shard
that owns the anchor; there an engine finds for each window the first place where it
occurs. An anchor met more than `HOT` times would make one shard large; its windows go one
by one to shards chosen by the whole window, and equal ones are merged on the way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticemill.llm import blocks
from noticemill.llm.blocks import LAST
from noticemill.llm.common import written
from noticemill.llm.hashing import WordHashes, leftmost_minima, sequence_hashes

# Occurrences of an anchor beyond which its windows go to shards one by one.
HOT = 4096
# Characters of segments in one shard, on average.
SHARD_BYTES = 400_000

Place = tuple[int, int, int]  # doc_id (LAST for null), row number, word
Run = tuple[int, int, int, int]  # windows, and the place of the first; the others follow word by word
# Words, place of the anchor and first place of each segment, and the words of a window.
Engine = Callable[[list[list[bytes]], list[int], list[Place], int], list[list[Run]]]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


class Sampled:
    """Anchors of one document: place, hash, and the first and last window that have it."""

    def __init__(self, hashes: np.ndarray, length: int, gram: int):
        grams = sequence_hashes(hashes, gram) if len(hashes) >= length else np.zeros(0, np.uint64)
        places = leftmost_minima(grams, length - gram + 1)
        starts = np.flatnonzero(np.diff(places, prepend=-1))
        self.place = places[starts]
        self.hash = grams[self.place] if len(places) else np.zeros(0, np.uint64)
        self.first = starts
        self.last = np.append(starts[1:], len(places))[: len(starts)] - 1


SEGMENTS = "block long, idx int, key binary, shard long, at int, text binary, doc long, row long, word int, occurrences binary"
NAMES = ["block", "idx", "key", "shard", "at", "text", "doc", "row", "word", "occurrences"]
TYPES = (
    pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary(),
)


def doc_key(doc_id: int | None) -> int:
    return LAST if doc_id is None else doc_id


def _segments(length: int, gram: int, buckets: int):
    """Rows of a block's distinct segments, and one row with all its occurrences.

    `key` is set for the single windows of hot anchors only.
    """

    def run(block: int, rows: pa.Table, found: pa.Table) -> pa.Table:
        import xxhash

        counts, known = blocks.Counts(found), WordHashes()
        apart = set(found.column("place").to_pylist())
        number: dict[bytes, int] = {}
        segments: list[tuple] = []
        places: list[Place] = []
        seen: list[tuple[int, int, int, int]] = []  # place in the block, first window, windows, idx

        def add(here: Place, place: int, words: list[bytes], n: int, at: int, shard: int, hot: bool) -> None:
            text = b" ".join(words[here[2] : here[2] + n - 1 + length])
            idx = number.setdefault(text, len(number))
            if idx == len(places):
                places.append(here)
                segments.append((block, idx, xxhash.xxh3_128_digest(text) if hot else None, shard, at, text))
            elif here < places[idx]:
                places[idx] = here
            seen.append((place, here[2], n, idx))

        docs, texts = rows.column("_doc_id").to_pylist(), rows.column("_text").to_pylist()
        for place, (doc_id, text) in enumerate(zip(docs, texts)):
            words = words_of(text)
            if len(words) < length or place in apart:
                continue
            hashes = known.array(words)
            sampled = Sampled(hashes, length, gram)
            n = counts.of(blocks.reduced(sampled.hash, buckets))
            common = np.flatnonzero(n >= 2)
            doc, row = doc_key(doc_id), blocks.row_number(block, place)
            whole = None
            columns = (sampled.place, sampled.first, sampled.last, sampled.hash.view(np.int64), n)
            for at, first, last, shard, met in zip(*(c[common].tolist() for c in columns)):
                if met <= HOT:
                    add((doc, row, first), place, words, last - first + 1, at - first, shard, False)
                    continue
                if whole is None:
                    whole = sequence_hashes(hashes, length).view(np.int64)
                for start in range(first, last + 1):
                    add((doc, row, start), place, words, 1, at - start, int(whole[start]), True)
        segments.append((block, -1, None, None, None, None))
        places.append((None, None, None))
        columns = [*zip(*segments), *zip(*places), [None] * (len(places) - 1) + [np.array(seen, np.int32).tobytes()]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, TYPES)], names=NAMES)

    return run


def runs_of(places: list[Place]) -> list[Run]:
    """Places of successive windows as runs."""
    runs: list[Run] = []
    start, first = 0, None
    for i, (doc, row, word) in enumerate([*places, (None, None, 0)]):
        if first is not None and (doc, row, word) == (first[0], first[1], first[2] + i - start):
            continue
        if first is not None:
            runs.append((i - start, *first))
        start, first = i, (doc, row, word)
    return runs


def first_places(stored: DataFrame, length: int, gram: int, engine: Engine, apart: DataFrame) -> DataFrame:
    """For each block the first places of its common windows: block, idx, runs, occurrences.

    `occurrences` (in the row with idx -1) lists the block's segments as (row, first window,
    windows, idx), 32-bit integers; `runs` has the first places of segment idx. Rows named
    in `apart` (block, place) are passed over; a place must be found elsewhere for them.
    """
    buckets = blocks.n_buckets(stored)

    def hashes_of(texts: list) -> Iterator[np.ndarray]:
        known = WordHashes()
        for text in texts:
            words = words_of(text)
            if len(words) >= length:
                yield Sampled(known.array(words), length, gram).hash

    none = F.lit(None)
    common = blocks.common_hashes(stored, hashes_of, buckets, apart=apart).withColumn("place", none.cast("int"))
    left_out = apart.select("block", none.cast("binary").alias("hashes"), none.cast("binary").alias("counts"), "place")
    found = blocks.with_blocks(stored, common.unionByName(left_out), _segments(length, gram, buckets), SEGMENTS)
    segments = written(found, "segments")
    held = segments.filter("idx >= 0")
    size = held.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    shard = F.pmod("shard", F.lit(max(1, -(-size // SHARD_BYTES)))).alias("shard")
    # an anchor that is not hot has at most HOT segments; windows of hot ones are merged first
    once = held.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.min(F.struct("doc", "row", "word")).alias("place"),
        F.first("shard").alias("shard"),
        F.first("at").alias("at"),
        F.first("text").alias("text"),
    )
    once = once.select(none.cast("long").alias("block"), none.cast("int").alias("idx"), "key", shard, "at", "text", "place.*")
    direct = held.filter(F.col("key").isNull()).select("block", "idx", "key", shard, "at", "text", "doc", "row", "word")

    def solve(group: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        at: list[int] = []
        places: list[Place] = []
        which = []
        columns = (group.column(c).to_pylist() for c in ("text", "at", "doc", "row", "word"))
        for text, anchor, *place in zip(*columns):
            k = number.setdefault(text, len(number))
            which.append(k)
            if k == len(at):
                at.append(anchor)
                places.append(tuple(place))
            elif tuple(place) < places[k]:
                places[k] = tuple(place)
        solved = engine([t.split(b" ") for t in number], at, places, length)
        found = [np.array(runs, "<i8").tobytes() for runs in solved]
        return pa.table(
            {
                "block": group.column("block"),
                "idx": group.column("idx"),
                "key": group.column("key"),
                "runs": pa.array([found[k] for k in which], pa.binary()),
            }
        )

    solved = direct.unionByName(once).groupBy("shard").applyInArrow(solve, "block long, idx int, key binary, runs binary")
    if held.filter(F.col("key").isNotNull()).isEmpty():
        back = solved.select("block", "idx", "runs")
    else:
        solved = written(solved, "solved")
        hot = held.filter(F.col("key").isNotNull()).select("block", "idx", "key")
        joined = hot.join(solved.filter(F.col("key").isNotNull()).select("key", "runs"), "key")
        back = solved.filter(F.col("key").isNull()).select("block", "idx", "runs").unionByName(joined.select("block", "idx", "runs"))
    listed = segments.filter("idx = -1").select("block", "idx", none.cast("binary").alias("runs"), "occurrences")
    return back.withColumn("occurrences", none.cast("binary")).unionByName(listed)


SPAN = "struct<first: int, n: int, of_doc_id: bigint, of_first: int>"


def without_repeats(docs: DataFrame, length: int, gram: int, engine: Engine, within: bool) -> DataFrame:
    """`docs` with the words of repeated windows taken out.

    A window is repeated if it also starts in a document with a smaller doc_id or, if
    `within`, anywhere at an earlier place (doc_id, order of the input, word). Result:
    `row` (a struct of all columns of `docs` but text), `text` as it was, n_words,
    n_removed, kept (the words that stay, joined by one space) and spans: the maximal runs of
    removed words as (first word, words, of_doc_id, of_first), with the first place of the
    window that a run begins with. Unless `within`, whole copies of a text with a smaller
    doc_id are not searched, as all their windows are repeated; they have no spans.
    """
    stored = blocks.store(docs)
    none = F.lit(None)
    apart = stored.select("block", none.cast("int").alias("place")).limit(0) if within else blocks.copies(stored)
    found = first_places(stored, length, gram, engine, apart).withColumn("place", none.cast("int"))
    left_out = apart.select(
        "block",
        F.lit(-2).alias("idx"),
        none.cast("binary").alias("runs"),
        none.cast("binary").alias("occurrences"),
        "place",
    )
    found = found.unionByName(left_out)
    rows = T.StructType([f for f in docs.schema.fields if f.name != "text"])
    schema = T.StructType(
        [
            T.StructField("row", rows),
            T.StructField("text", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
            T.StructField("spans", T.ArrayType(T._parse_datatype_string(SPAN))),
        ]
    )
    span = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32()), ("of_doc_id", pa.int64()), ("of_first", pa.int32())]))

    def cut(block: int, table: pa.Table, found: pa.Table) -> pa.Table:
        runs: dict[int, bytes] = {}
        copied = set()
        listed = np.zeros((0, 4), np.int32)
        columns = (found.column(c).to_pylist() for c in ("idx", "runs", "occurrences", "place"))
        for idx, raw, occurrences, place in zip(*columns):
            if idx >= 0:
                runs[idx] = raw
            elif idx == -1:
                listed = np.frombuffer(occurrences, np.int32).reshape(-1, 4)
            else:
                copied.add(place)
        by_row: dict[int, list] = {}
        for place, first, _, idx in listed.tolist():
            by_row.setdefault(place, []).append((first, idx))
        docs, texts = table.column("_doc_id").to_pylist(), table.column("_text").to_pylist()
        n_words, n_removed, kept, spans = [], [], [], []
        for place, (doc_id, text) in enumerate(zip(docs, texts)):
            words = words_of(text)
            if place not in by_row:
                gone = place in copied and len(words) >= length
                n_words.append(len(words))
                n_removed.append(len(words) if gone else 0)
                kept.append("" if gone else b" ".join(words).decode())
                spans.append([])
                continue
            gone, stretches = np.zeros(len(words) + 1, np.int32), []
            doc, row = doc_key(doc_id), blocks.row_number(block, place)
            for first, idx in sorted(by_row[place]):
                start = first
                for n, of_doc, of_row, of_word in np.frombuffer(runs[idx], "<i8").reshape(-1, 4).tolist():
                    # the windows of a run are as far from their first places as its first window
                    if of_doc < doc or within and (of_doc, of_row, of_word) < (doc, row, start):
                        end = start + n - 1 + length
                        gone[start] += 1
                        gone[end] -= 1
                        if stretches and start <= stretches[-1][1]:
                            stretches[-1][1] = max(end, stretches[-1][1])
                        else:
                            stretches.append([start, end, of_doc, of_word])
                    start += n
            covered = np.cumsum(gone[:-1]) > 0
            n_words.append(len(words))
            n_removed.append(int(covered.sum()))
            if stretches:
                words = [w for w, c in zip(words, covered.tolist()) if not c]
            kept.append(b" ".join(words).decode())
            spans.append(
                [
                    {"first": a, "n": b - a, "of_doc_id": None if of_doc == LAST else of_doc, "of_first": of_word}
                    for a, b, of_doc, of_word in stretches
                ]
            )
        return pa.table(
            {
                "row": table.column("_row"),
                "text": table.column("_text"),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
                "spans": pa.array(spans, span),
            }
        )

    return blocks.with_blocks(stored, found, cut, schema)

"""Packing token ids into windows by minimum bin slack.

Whole windows are cut off the front of a document; what is left of it (its rest) is shorter
than a window. Rests are packed by length: the longest rest opens a window, and a bitset
over the sums of the lengths at hand finds the multiset that fills it closest to capacity;
the counts are traced back through the steps of the bitset. Rests that no multiset
completes are laid end to end and cut at the window, and the last piece of that row is
cut into powers of two, which need no padding.

Each task packs its own rows, `HELD_RESTS` rests at a time, so nothing is shuffled, no task
holds more than that, and a lost task is simply run again.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 1024
HELD_RESTS = 8192
# A sequence's number is that of its task in the high bits, then one by one.
TASK_BITS = 40
COLUMNS = {
    "doc_id": pa.int64(),
    "start": pa.int64(),
    "length": pa.int64(),
    "ids": pa.binary(),
    "ids_crc32": pa.int64(),
    "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(),
    "offset": pa.int64(),
}
SCHEMA = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
BATCH_ROWS = 2048


def fullest(counts: dict[int, int], capacity: int) -> list[int]:
    """Lengths, each at most as often as counted, whose sum is closest to `capacity` from below."""
    reach, steps, full = 1, [], (1 << (capacity + 1)) - 1
    goal = 1 << capacity
    for length in sorted((n for n in counts if n <= capacity), reverse=True):
        for _ in range(min(counts[length], capacity // length)):
            grown = (reach | reach << length) & full
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
        if reach & goal:
            break
    left, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> left & 1:
            left -= length
            chosen.append(length)
    return chosen


def whole_fill(total: int, window: int) -> bool:
    """No padding: the window is full, or its fill is a power of two."""
    return total == window or total & (total - 1) == 0


def patterns(counts: dict[int, int], window: int) -> tuple[list[tuple[list[int], int]], dict[int, int]]:
    """Fillings that leave no padding, each with how often it is used; counts left over."""
    counts, made, rest = dict(counts), [], {}
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        if not counts[longest]:
            del counts[longest]
        chosen = [longest, *fullest(counts, window - longest)]
        if not whole_fill(sum(chosen), window):
            rest[longest] = rest.get(longest, 0) + 1
            continue
        needs = Counter(chosen)
        needs[longest] -= 1
        for n in +needs:
            counts[n] -= needs[n]
        more = min([counts.get(n, 0) // k for n, k in Counter(chosen).items()])
        for n, k in Counter(chosen).items():
            if n in counts:
                counts[n] -= more * k
                if not counts[n]:
                    del counts[n]
        made.append((chosen, 1 + more))
    return made, rest


def packed(rests: list[tuple], window: int = WINDOW) -> Iterator[list[tuple]]:
    """Sequences over rests (key, length): each a list of (key, from, length)."""
    by_length = defaultdict(list)
    for key, length in rests:
        by_length[length].append(key)
    made, left = patterns({n: len(keys) for n, keys in by_length.items()}, window)
    for chosen, times in made:
        for _ in range(times):
            yield [(by_length[n].pop(), 0, n) for n in chosen]
    sequence, room = [], window
    for length in sorted(left, reverse=True):
        for _ in range(left[length]):
            key, done = by_length[length].pop(), 0
            while done < length:
                n = min(room, length - done)
                sequence.append((key, done, n))
                done, room = done + n, room - n
                if not room:
                    yield sequence
                    sequence, room = [], window
    yield from _powers_of_two(sequence)


def _powers_of_two(pieces: list[tuple]) -> Iterator[list[tuple]]:
    """Pieces cut into sequences whose lengths are the powers of two in their sum."""
    total = sum(n for _, _, n in pieces)
    pieces = pieces[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        if not total >> bit & 1:
            continue
        sequence, room = [], 1 << bit
        while room:
            key, start, length = pieces.pop()
            n = min(room, length)
            sequence.append((key, start, n))
            room -= n
            if n < length:
                pieces.append((key, start + n, length - n))
        yield sequence


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, held: int = HELD_RESTS) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most `window` ids.

    Per piece: doc_id, start (the document's ids before it), length, ids (binary,
    little-endian unsigned 32 bit), ids_crc32 (of these bytes), doc_tokens (the document's
    ids, the end id 0 included), sequence_id and offset (the piece's place in its sequence).
    Every id of every row lies in one piece. A null or empty text is its end id alone;
    repeated rows are packed each; a null doc_id stays null; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from noticemill.llm.tokens import as_u32, encoder

        encode = encoder(tokenizer)
        width = encode.width
        number = TaskContext.get().partitionId() << TASK_BITS
        rows: list[tuple] = []

        def piece(doc: tuple, start: int, raw: bytes, sequence: int, offset: int) -> tuple:
            wide = as_u32(raw, width)
            return doc[0], start, len(wide) // 4, wide, zlib.crc32(wide), doc[1], sequence, offset

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, COLUMNS.values())], names=list(COLUMNS))

        rests: list[tuple] = []  # ((doc_id, doc_tokens), start of the rest, its ids)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for sequence in packed([(k, len(rest[2]) // width) for k, rest in enumerate(rests)], window):
                offset = 0
                for key, start, n in sequence:
                    doc, base, raw = rests[key]
                    rows.append(piece(doc, base + start, raw[start * width : (start + n) * width], number, offset))
                    offset += n
                number += 1
                if len(rows) >= BATCH_ROWS:
                    yield out()
            rests.clear()

        for doc_id, raw in encode.encode_batches(batches):
            n_ids = len(raw) // width
            doc, whole = (doc_id, n_ids), n_ids - n_ids % window
            for start in range(0, whole, window):
                rows.append(piece(doc, start, raw[start * width : (start + window) * width], number, 0))
                number += 1
                if len(rows) >= BATCH_ROWS:
                    yield out()
            if whole < n_ids:
                rests.append((doc, whole, raw[whole * width :]))
                if len(rests) >= held:
                    yield from flush()
        yield from flush()
        if rows:
            yield out()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)

"""Repair of conversations: the cheapest edits that give roles `(s?(ua)+)?`.

Edits form a graph. A node is a place between two rows and a state: nothing yet (0), after
the system row (1), after a user row that waits for its answer (2), after a pair (3). Keep,
Rerole and Delete lead over a row, Insert stays at its place; each edit leads from a node
to one other. A cost DP from the end finds what each node still costs. Among the arcs on
cheapest ways the least audit is found by prefix doubling: nodes are ranked by the next 1,
2, 4 … letters of their audit, each time from two ranks of half the length, together with
pointers that jump as far; the path is then read off the doubled pointers, for all
conversations of an Arrow batch at once.

Rows are sorted over all tasks by conversation and turn and written as blocks of at most
`BLOCK_ROWS` rows of one conversation. A conversation within one block is repaired there.
Of others (very long ones, and those on the edge of a task) the blocks are joined through
small rows: keys of rows seen, the cost of a block between each two states, the states in
which it is entered and left. No task holds more than its blocks; only the hash over the
whole repaired text of a conversation is computed by one task, which streams its blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticemill.llm.common import WHITE, work_path, written

BLOCK_ROWS = 1024
BLOCK_BYTES = 1 << 18
LETTERS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5
# Where an added or rerolled row leads, and where a kept row with initial s, u, a or another does.
ADDED = np.array([2, 2, 3, 2])
KEPT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]]).T
ROLE_OF_STATE = {2: "user", 3: "assistant"}
INITIALS = {"s": 0, "u": 1, "a": 2}
LEGAL = {"su", "ua", "au"}
FINE, FAULTY, TRUNCATED = range(3)
NEVER = 1 << 40
ACCEPTED = np.array([0, NEVER, NEVER, 0])

# Rows whose graph is built at once.
GRAPH_ROWS = 1 << 14

COUNTS = "blank long, duplicate long, truncated long, illegal long"
BLOCK = "conv_id long, place long, turns array<long>, roles array<string>, texts array<string>, whole boolean"
RESULT = f"conv_id long, place long, gaps long, {COUNTS}, cost long, audit string, repaired string"
SUMMARY = f"conv_id long, place long, initials binary, kinds binary, ends_of_turns array<long>, ends_of_roles array<string>, {COUNTS}, costs array<long>"
ENDS = "place long, closed boolean, ends array<long>, start_cost long"
EXITS = f"conv_id long, place long, exits array<long>, ends_of_turns array<long>, ends_of_roles array<string>, {COUNTS}, start_cost long"
ENTRIES = f"place long, entry long, last boolean, gaps long, {COUNTS}, cost long"
PIECE = f"conv_id long, place long, audit string, repaired string, last boolean, gaps long, {COUNTS}, cost long"
REPORT = f"conv_id long, gaps long, {COUNTS}, cost long, audit string, repaired_sha256 string"
COUNT_NAMES = ["blank", "duplicate", "truncated", "illegal"]


# The damage


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the damage that crc32 of `conv_id:turn` (a null is one space) gives them.

    Modulo 20: 0 drops a row (it stays here with null role and text, so that its
    conversation does), 1 empties its text, 2 takes `.`, `!` and `?` out of it, 3 repeats
    the row, 4 makes its role user. Null roles and texts are one space.
    """

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    copies = F.when(code == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(code != 0, F.when(code == 4, "user").otherwise(text_of("role"))).alias("role"),
        F.when(code != 0, text).alias("text"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


# One block


class Faults(NamedTuple):
    """What is wrong with the rows of a block, and what the graph needs to know of them."""

    initials: np.ndarray
    kinds: np.ndarray
    blank: int
    duplicate: int
    truncated: int
    illegal: int


def row_key(conv_id: int | None, role: str, text: str) -> bytes:
    key = f"{conv_id} {len(role)} {role}{text}".encode()
    return hashlib.blake2b(key, digest_size=16).digest()


def faults_of(conv_id: int | None, roles: list[str], texts: list[str], seen_before: set[bytes]) -> Faults:
    """Each row's first fault; `seen_before` are keys of rows in earlier blocks."""
    seen: set[tuple[str, str]] = set()
    kinds = np.zeros(len(roles), np.int64)
    blank = duplicate = truncated = 0
    for i, row in enumerate(zip(roles, texts)):
        last = row[1].rstrip(WHITE)[-1:]
        if not last:
            blank += 1
            kinds[i] = FAULTY
        elif row in seen or (seen_before and row_key(conv_id, *row) in seen_before):
            duplicate += 1
            kinds[i] = FAULTY
        elif last not in ".!?":
            truncated += 1
            kinds[i] = TRUNCATED
        seen.add(row)
    initials = np.array([INITIALS.get(role[:1], 3) for role in roles], np.int64)
    illegal = sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:]))
    return Faults(initials, kinds, blank, duplicate, truncated, illegal)


def gaps_of(turns: Iterable[int | None]) -> int:
    known = [t for t in turns if t is not None]
    return max(known) - min(known) + 1 - len(set(known)) if known else 0


# The graph, for many blocks at once


class Graph:
    """The edit graphs of blocks, with the cost from each node to the end.

    `ends` gives, for each block, what its four last nodes cost; `closed` says for which
    blocks rows may be inserted after the last row (else the next block does that).
    """

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray]], ends: np.ndarray, closed: np.ndarray):
        self.sizes = np.array([len(kinds) for _, kinds in blocks], np.int64)
        self.first = 4 * (np.cumsum(self.sizes + 1) - self.sizes - 1)
        self.last = self.first + 4 * self.sizes
        n = int(4 * (self.sizes + 1).sum())
        self.cost = np.full(n, NEVER, np.int64)
        # of each node and edit: the node it leads to (-1: none) and its own cost
        self.to = np.full((n, 4), -1, np.int64)
        self.price = np.full((n, 4), NEVER, np.int64)
        states = np.arange(4)
        if n:
            place_ends = np.repeat(self.last, self.sizes + 1) // 4
            places = np.arange(n // 4)
            rows = places[places != place_ends]
            initials = np.concatenate([i for i, _ in blocks]) if len(rows) else np.zeros(0, np.int64)
            kinds = np.concatenate([k for _, k in blocks]) if len(rows) else np.zeros(0, np.int64)
            nodes = rows[:, None] * 4 + states
            extra = np.where(kinds == TRUNCATED, TRUNCATED_COST, 0)[:, None]
            usable = (kinds != FAULTY)[:, None]
            kept = KEPT[initials]
            self._arcs(nodes, DELETE, rows[:, None] * 4 + 4 + states, DELETE_COST + 0 * nodes, np.ones_like(nodes, bool))
            self._arcs(nodes, KEEP, rows[:, None] * 4 + 4 + kept, extra + 0 * nodes, usable & (kept >= 0))
            self._arcs(nodes, REROLE, rows[:, None] * 4 + 4 + ADDED, extra + REROLE_COST + 0 * nodes, usable & (states >= 0))
            open_end = np.repeat(~closed, self.sizes + 1) & (places == place_ends)
            nodes = places[~open_end][:, None] * 4 + states
            self._arcs(nodes, INSERT, nodes - states + ADDED, INSERT_COST + 0 * nodes, np.ones_like(nodes, bool))
        self._costs(ends, closed)

    def _arcs(self, nodes: np.ndarray, edit: int, to: np.ndarray, price: np.ndarray, where: np.ndarray) -> None:
        self.to[nodes[where], edit] = to[where]
        self.price[nodes[where], edit] = price[where]

    def _inserted(self, costs: np.ndarray) -> np.ndarray:
        """Costs of the four states of a place when rows may be added there."""
        two = np.minimum(costs[:, 2], costs[:, 3] + INSERT_COST)
        three = np.minimum(costs[:, 3], costs[:, 2] + INSERT_COST)
        zero, one = np.minimum(costs[:, 0], two + INSERT_COST), np.minimum(costs[:, 1], two + INSERT_COST)
        return np.minimum(np.stack([zero, one, two, three], 1), NEVER)

    def _costs(self, ends: np.ndarray, closed: np.ndarray) -> None:
        """The cost DP, one place of every block at a time, from the end."""
        states = np.arange(4)
        self.ends = ends
        costs = np.where(closed[:, None], self._inserted(ends), ends)
        self.cost[self.last[:, None] + states] = costs
        for step in range(1, int(self.sizes.max(initial=0)) + 1):
            nodes = (self.last - 4 * step)[self.sizes >= step][:, None] + states
            over = [self.price[nodes, e] + self.cost[self.to[nodes, e]] for e in (DELETE, KEEP, REROLE)]
            self.cost[nodes] = self._inserted(np.minimum(np.minimum.reduce(over), NEVER))

    def start_costs(self) -> np.ndarray:
        return self.cost[self.first[:, None] + np.arange(4)]

    def least_paths(self, states: np.ndarray) -> list[tuple[str, int]]:
        """From the given state of each block: the least audit among the cheapest, and the state at the end."""
        cheapest = (self.to >= 0) & (self.price + self.cost[self.to] == self.cost[:, None]) & (self.cost < NEVER)[:, None]
        # a last node that is an end itself has no way on
        last = self.last[:, None] + np.arange(4)
        ended = self.ends == self.cost[last]
        cheapest[last[ended]] = False
        here = np.arange(len(self.cost))
        going = cheapest.any(1)
        letter = np.where(going, cheapest.argmax(1), -1)
        jump = [np.where(going, self.to[here, letter], here)]
        rank = letter + 1
        longest = int(3 * self.sizes.max(initial=0) + 3)
        while (1 << (len(jump) - 1)) < longest:
            # ranks of twice the length: rank of the first half, then of the half where it leads
            pairs = rank * (rank.max(initial=0) + 1) + rank[jump[-1]]
            rank = np.unique(pairs, return_inverse=True)[1]
            jump.append(jump[-1][jump[-1]])
        # of a node's cheapest arcs the one with the least letter, then the least rank behind it
        order = np.where(cheapest, np.arange(4) * (rank.max(initial=0) + 1) + rank[self.to], np.iinfo(np.int64).max)
        letter = np.where(going, order.argmin(1), -1)
        path = (self.first + states)[:, None]
        for far in jump[:-1]:
            path = np.concatenate([path, far[path]], 1)
        letters = letter[path]
        ends = jump[-1][self.first + states]
        names = np.frombuffer(LETTERS.encode(), np.uint8)
        lengths = (letters >= 0).sum(1)
        return [
            (names[row[:n]].tobytes().decode(), int(end - last))
            for row, n, end, last in zip(letters, lengths, ends, self.last)
        ]


def repaired_rows(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[str]:
    """`role:text` of the rows after the edits of an audit, begun in a state."""
    rows = zip(roles, texts)
    for edit in audit:
        role, text = next(rows) if edit != "I" else ("", "")
        if edit == "D":
            continue
        if edit == "K":
            state = int(KEPT[INITIALS.get(role[:1], 3), state])
        else:
            state = int(ADDED[state])
            role = ROLE_OF_STATE[state]
        yield f"{role}:{text}"


# Batches


def _arrow_type(name: str) -> pa.DataType:
    items = name.removeprefix("array<").removesuffix(">")
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.list_(types[items]) if items != name else types[items]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = [pa.array(c, _arrow_type(t)) for c, (_, t) in zip(zip(*rows), fields)]
    return pa.record_batch(columns, names=[name for name, _ in fields])


def _blocks(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows into blocks. A conversation is `whole` if rows of others surround its one block."""
    from pyspark import TaskContext

    place = TaskContext.get().partitionId() << 32
    out: list[tuple] = []
    held: list[tuple] = []
    size = out_size = 0
    current, first, cut = None, True, False

    def flush(whole: bool) -> None:
        nonlocal place, size, out_size
        out.append((current, place, *map(list, zip(*held)), whole))
        place += 1
        out_size += size
        held.clear()
        size = 0

    for batch in batches:
        for conv_id, *row in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if held and conv_id != current:
                flush(not first and not cut)
                first, cut = False, False
            elif len(held) >= block_rows or size >= BLOCK_BYTES:
                flush(False)
                cut = True
            current = conv_id
            held.append(tuple(row))
            size += len(row[2] or "")
            if out_size >= 4 << 20:
                yield _batch(out, BLOCK)
                out.clear()
                out_size = 0
    if held:
        flush(False)
    if out:
        yield _batch(out, BLOCK)


def _portions(batches: Iterator[pa.RecordBatch], size_of) -> Iterator[list[dict]]:
    """Blocks with about `GRAPH_ROWS` rows in all, one block at least."""
    held, size = [], 0
    for batch in batches:
        for block in batch.to_pylist():
            held.append(block)
            size += size_of(block)
            if size >= GRAPH_ROWS or len(held) >= GRAPH_ROWS // 8:
                yield held
                held, size = [], 0
    if held:
        yield held


def _present(block: dict) -> tuple[list, list[str], list[str]]:
    """Turns, roles and texts of the rows that were not dropped."""
    rows = [r for r in zip(block["turns"], block["roles"], block["texts"]) if r[1] is not None]
    return tuple(map(list, zip(*rows))) if rows else ([], [], [])


def _repair_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for blocks in _portions(batches, lambda b: len(b["roles"])):
        rows = [_present(b) for b in blocks]
        faults = [faults_of(b["conv_id"], r[1], r[2], set()) for b, r in zip(blocks, rows)]
        graph = Graph([f[:2] for f in faults], np.tile(ACCEPTED, (len(blocks), 1)), np.ones(len(blocks), bool))
        paths = graph.least_paths(np.zeros(len(blocks), np.int64))
        out = []
        for b, (turns, roles, texts), f, cost, (audit, _) in zip(blocks, rows, faults, graph.start_costs()[:, 0], paths):
            repaired = "\n".join(repaired_rows(audit, 0, roles, texts))
            out.append((b["conv_id"], b["place"], gaps_of(turns), *f[2:], int(cost), audit, repaired))
        yield _batch(out, RESULT)


# Conversations of several blocks


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, key) of the different rows of each block."""
    for batch in batches:
        for block in batch.to_pylist():
            _, roles, texts = _present(block)
            keys = {row_key(block["conv_id"], *row) for row in zip(roles, texts)}
            if keys:
                yield _batch([(block["place"], k) for k in keys], "place long, key binary")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block its faults, what meets the blocks beside it, and the cost from each state to each."""
    for blocks in _portions(batches, lambda b: 4 * len(b["roles"])):
        rows = [_present(b) for b in blocks]
        faults = [faults_of(b["conv_id"], r[1], r[2], set(b["seen"] or ())) for b, r in zip(blocks, rows)]
        ends = np.tile(np.where(np.eye(4, dtype=bool), 0, NEVER), (len(blocks), 1))
        four = [f[:2] for f in faults for _ in range(4)]
        costs = Graph(four, ends, np.zeros(len(four), bool)).start_costs().reshape(len(blocks), 4, 4)
        out = []
        for b, (turns, roles, _), f, cost in zip(blocks, rows, faults, costs):
            known = [t for t in turns if t is not None]
            turn_ends = [min(known), max(known), len(set(known))] if known else []
            role_ends = [roles[0][:1], roles[-1][:1]] if roles else []
            initials, kinds = (x.astype(np.uint8).tobytes() for x in f[:2])
            # cost[end state][start state]
            out.append((b["conv_id"], b["place"], initials, kinds, turn_ends, role_ends, *f[2:], cost.ravel().tolist()))
        yield _batch(out, SUMMARY)


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a conversation from its last to its first: what their last nodes still cost."""
    current, after = None, None
    started = False
    for batch in batches:
        out = []
        for block in batch.to_pylist():
            closed = not started or block["conv_id"] != current
            ends = ACCEPTED if closed else after
            costs = np.array(block["costs"], np.int64).reshape(4, 4)
            from_ends = np.array([0, 2 * INSERT_COST, INSERT_COST, 0]) if closed else ends
            after = np.minimum((costs + from_ends[:, None]).min(0), NEVER)
            current, started = block["conv_id"], True
            out.append((block["place"], closed, ends.tolist(), int(after[0])))
        if out:
            yield _batch(out, ENDS)


def _graph(blocks: list[dict]) -> Graph:
    rows = [tuple(np.frombuffer(b[n], np.uint8).astype(np.int64) for n in ("initials", "kinds")) for b in blocks]
    return Graph(rows, np.array([b["ends"] for b in blocks], np.int64), np.array([b["closed"] for b in blocks]))


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which the least path leaves a block, for each state that enters it."""
    for blocks in _portions(batches, lambda b: len(b["kinds"])):
        graph = _graph(blocks)
        exits = [[end for _, end in graph.least_paths(np.full(len(blocks), state))] for state in range(4)]
        out = []
        for b, states in zip(blocks, zip(*exits)):
            counts = [b[n] for n in COUNT_NAMES]
            out.append((b["conv_id"], b["place"], list(states), b["ends_of_turns"], b["ends_of_roles"], *counts, b["start_cost"]))
        yield _batch(out, EXITS)


class _Totals:
    """What is known of a conversation after some of its blocks."""

    def __init__(self, conv_id: int | None, cost: int):
        self.conv_id, self.cost, self.state = conv_id, cost, 0
        self.counts, self.turns, self.initial = [0] * len(COUNT_NAMES), None, None

    def add(self, block: dict) -> int:
        """Takes a block in; returns the state that enters it."""
        entry, self.state = self.state, block["exits"][self.state]
        self.counts = [a + block[n] for a, n in zip(self.counts, COUNT_NAMES)]
        if block["ends_of_roles"]:
            first, last = block["ends_of_roles"]
            if self.initial is not None and self.initial + first not in LEGAL:
                self.counts[COUNT_NAMES.index("illegal")] += 1
            self.initial = last
        if block["ends_of_turns"]:
            least, most, known = block["ends_of_turns"]
            if self.turns is None:
                self.turns = [least, most, known]
            else:
                self.turns = [self.turns[0], most, self.turns[2] + known - (least == self.turns[1])]
        return entry

    def row(self, place: int, entry: int, last: bool) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return place, entry, last, gaps, *self.counts, self.cost


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a conversation in order: the state that enters each, and totals at the last."""
    totals, waiting = None, None
    for batch in batches:
        out = []
        for block in batch.to_pylist():
            new = totals is None or block["conv_id"] != totals.conv_id
            if waiting:
                out.append(totals.row(*waiting, new))
            if new:
                totals = _Totals(block["conv_id"], block["start_cost"])
            waiting = block["place"], totals.add(block)
        if out:
            yield _batch(out, ENTRIES)
    if waiting:
        yield _batch([totals.row(*waiting, True)], ENTRIES)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and repaired rows of each block."""
    for blocks in _portions(batches, lambda b: len(b["roles"])):
        paths = _graph(blocks).least_paths(np.array([b["entry"] for b in blocks]))
        out = []
        for b, (audit, _) in zip(blocks, paths):
            _, roles, texts = _present(b)
            rows = list(repaired_rows(audit, b["entry"], roles, texts))
            totals = [b[n] for n in ("last", "gaps", *COUNT_NAMES, "cost")]
            out.append((b["conv_id"], b["place"], audit, "\n".join(rows) if rows else None, *totals))
        yield _batch(out, PIECE)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order: the whole audit and the hash over the whole repaired text."""
    audit, digest, empty = [], hashlib.sha256(), True
    for batch in batches:
        out = []
        for piece in batch.to_pylist():
            audit.append(piece["audit"])
            if piece["repaired"] is not None:
                digest.update((b"" if empty else b"\n") + piece["repaired"].encode())
                empty = False
            if piece["last"]:
                totals = [piece[n] for n in ("gaps", *COUNT_NAMES, "cost")]
                out.append((piece["conv_id"], *totals, "".join(audit), digest.hexdigest()))
                audit, digest, empty = [], hashlib.sha256(), True
        if out:
            yield _batch(out, REPORT)


def _in_order(blocks: DataFrame, place: Column) -> DataFrame:
    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", place)


def _pieces_of_parts(parts: DataFrame) -> DataFrame:
    """Audit, repaired text and totals of blocks whose conversations have others too."""
    keys = written(parts.mapInArrow(_keys, "place long, key binary"), "conversation-keys")
    firsts = keys.groupBy("key").agg(F.min("place").alias("_first"), F.count(F.lit(1)).alias("_blocks")).filter("_blocks > 1")
    again = keys.join(firsts, "key").filter("place > _first").groupBy("place").agg(F.collect_list("key").alias("seen"))
    summaries = parts.join(again, "place", "left").select("conv_id", "place", "turns", "roles", "texts", "seen")
    summaries = written(summaries.mapInArrow(_summaries, SUMMARY), "conversation-summaries")
    ends = _in_order(summaries.select("conv_id", "place", "costs"), F.desc("place")).mapInArrow(_backward, ENDS)
    known = written(summaries.drop("costs").join(ends, "place"), "conversation-ends")
    exits = _in_order(known.mapInArrow(_exits, EXITS), F.asc("place"))
    entries = exits.mapInArrow(_forward, ENTRIES)
    paths = known.select("place", "initials", "kinds", "ends", "closed").join(entries, "place")
    return written(parts.join(paths, "place").mapInArrow(_pieces, PIECE), "conversation-pieces")


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Repair conversations of (conv_id, turn, role, text): a report and the repaired texts.

    The report has per conversation: conv_id, gaps (missing turns), blank, duplicate,
    truncated (rows by their first fault), illegal (neighbouring roles that may not follow
    each other), cost and audit (initials of the cheapest edits in order, the ASCII-least of
    equal cost), repaired_sha256. The texts are (conv_id, place, repaired): rows as
    `role:text`, joined by newlines, in the order of `place`; a very long conversation has
    several of them.

    Rows are taken by turn, null turns first; rows of one turn by a hash of role and text,
    equal ones in any order. A null conv_id is a conversation too. Rows with null role and
    text count as dropped (see `damaged`): a conversation of such rows alone, as one without
    any fault, has zeros and, if no row is left, an empty audit and text. Other columns are
    ignored. No rows give no rows.
    """
    spark = rows.sparkSession
    order = ["conv_id", "turn", "_hash", "_from"]
    placed = rows.select("conv_id", "turn", "role", "text", F.xxhash64("role", "text").alias("_hash"), F.spark_partition_id().alias("_from"))
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash", "_from")
    path = work_path(spark, "conversation-blocks")
    placed.mapInArrow(partial(_blocks, block_rows=block_rows), BLOCK).write.option("compression", "zstd").partitionBy("whole").parquet(path)
    blocks = spark.read.schema(BLOCK).parquet(path)
    whole = blocks.filter("whole").mapInArrow(_repair_whole, RESULT)
    pieces = _pieces_of_parts(blocks.filter("not whole").drop("whole"))

    own = whole.withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("place", "repaired")
    report = own.unionByName(_in_order(pieces, F.asc("place")).mapInArrow(_reports, REPORT))
    texts = whole.unionByName(pieces, allowMissingColumns=True).select("conv_id", "place", "repaired")
    return report, texts.filter("repaired is not null and repaired != ''")

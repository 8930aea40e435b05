"""Byte-level BPE in tasks: recursive DuckDB queries over token-position rows, and back.

A word (a match of the pattern) that is not a token as a whole starts as one row per byte:
place, token. Each step of the recursive query joins neighbouring tokens with the merge
table and contracts each word's leftmost pair of least rank, until no word has a pair left. Decoding joins token rows with the vocabulary and aggregates their bytes in order.

A text is cut before single spaces between other characters, where a match always begins,
and each distinct piece is encoded and decoded once as long as a worker remembers it; what
a worker remembers and what one query holds is bounded in bytes. Nothing is shuffled, and a
lost task is simply run again.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Bytes of the pieces and of the words a worker remembers, with what they cost beside their text.
REMEMBERED_BYTES = 384 << 20
ENTRY_BYTES = 200
# Bytes of the words in one recursive query.
QUERY_BYTES = 1 << 19
# A longer word takes a step for each of its pairs, so one word would be a query of many
# steps over many rows; the same contraction is then done with a heap.
LONGEST_IN_QUERY = 256
# Tokens in one decoding query.
DECODED_TOKENS = 1 << 18
BATCH_BYTES = 4 << 20
SCHEMA = "doc_id long, n_tokens long, ids string, decoded binary"

# `place` is word * 512 + position of the token's first byte, so the next token of the word
# stands at place + size, and the last one of a word is followed by none.
PLACES = 512
CONTRACT = f"""
create or replace temp table tokens as
with recursive steps(place, token, size, done) as (
  select place, token, 1::bigint, false from bytes_of_words
  union all
  select s.place, if(s.place = l.place, l.id, s.token), if(s.place = l.place, l.size, s.size), l.word is null
  from (select * from steps where not done) s
  left join (
    select word, least >> 35 as id, least & {(1 << 35) - 1} as place, (least & {(1 << 35) - 1}) + first_size as following, size
    from (
      select p.place // {PLACES} as word, min(id << 35 | p.place) as least,
        arg_min(p.size, id << 35 | p.place) as first_size, arg_min(m.size, id << 35 | p.place) as size
      from steps p join steps f on f.place = p.place + p.size join merges m on p.token = a and f.token = b
      where not p.done and not f.done
      group by p.place // {PLACES})) l on s.place // {PLACES} = l.word
  where s.place is distinct from l.following)
select place // {PLACES} as word, place % {PLACES} as pos, token from steps where done
"""
READ = """
select word, string_agg(token::varchar, ' ' order by pos), unhex(string_agg(hex, '' order by pos))
from tokens join vocabulary on token = id group by word
"""
DECODE = "select word, unhex(string_agg(hex, '' order by pos)) from tokens join vocabulary on token = id group by word"


def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 bytes and rank, one token a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encodes and decodes words with one vocabulary."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.pattern = regex.compile(pattern)
        self.ranks = ranks_of(path)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.byte_tokens = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})
        self.db.execute("set temp_directory = ''")
        pairs = [
            (left, right, rank, len(token))
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None and (right := self.ranks.get(token[cut:])) is not None
        ]
        self._table("merges", dict(zip(("a", "b", "id", "size"), (pa.array(c, pa.int64()) for c in zip(*pairs)))))
        tokens = [token.hex() for token in self.ranks]
        self._table("vocabulary", {"id": pa.array(self.ranks.values(), pa.int64()), "hex": tokens})
        self.words: dict[str, tuple[str, bytes]] = {}
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}
        self.held = 0

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create or replace temp table {name} as select * from given")
        self.db.unregister("given")

    def contract(self, words: list[bytes]) -> list[tuple[str, bytes]]:
        """Ids and decoded bytes of words, none of them empty, by the recursive query."""
        sizes = np.array([len(w) for w in words])
        starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
        raw = np.frombuffer(b"".join(words), np.uint8)
        places = np.repeat(np.arange(len(words)) * PLACES, sizes) + np.arange(len(raw)) - starts
        self._table("bytes_of_words", {"place": places, "token": self.byte_tokens[raw]})
        self.db.execute(CONTRACT)
        found = {word: (ids, decoded) for word, ids, decoded in self.db.execute(READ).fetchall()}
        return [found[i] for i in range(len(words))]

    def contract_long(self, word: bytes) -> list[int]:
        """Tokens of one word, its leftmost pair of least rank contracted first, with a heap."""
        tokens: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        before, after = list(range(-1, len(word) - 1)), list(range(1, len(word) + 1))
        heap: list[tuple[int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j < len(word) and (rank := self.ranks.get(tokens[i] + tokens[j])) is not None:
                heapq.heappush(heap, (rank, i, len(tokens[i]) + len(tokens[j])))

        for i in range(len(word)):
            push(i)
        while heap:
            rank, i, size = heapq.heappop(heap)
            j = after[i]
            if tokens[i] is None or j >= len(word) or len(tokens[i]) + len(tokens[j]) != size:
                continue  # one of the two has been contracted since
            tokens[i], tokens[j] = tokens[i] + tokens[j], None
            after[i] = after[j]
            if after[i] < len(word):
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [self.ranks[t] for t in tokens if t is not None]

    def decode(self, ids: list[list[int]]) -> list[bytes]:
        """Bytes of lists of ids, by the ordered aggregation. An unknown id raises KeyError."""
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = np.array([i for x in ids for i in x], np.int64)
        for unknown in set(flat.tolist()) - self.bytes_of.keys():
            raise KeyError(unknown)
        starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
        self._table("tokens", {"word": np.repeat(np.arange(len(ids)), sizes), "pos": np.arange(len(flat)) - starts, "token": flat})
        found = dict(self.db.execute(DECODE).fetchall())
        return [found.get(i, b"") for i in range(len(ids))]

    def _learn_words(self, words: Iterable[str]) -> None:
        some: list[tuple[str, bytes]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if some:
                self.words.update(zip([w for w, _ in some], self.contract([raw for _, raw in some])))
            some.clear()
            size = 0

        for word in words:
            raw = word.encode()
            self.held += len(raw) * 4 + ENTRY_BYTES
            if raw in self.ranks:
                rank = self.ranks[raw]
                self.words[word] = str(rank), self.bytes_of[rank]
            elif len(raw) > LONGEST_IN_QUERY:
                ids = self.contract_long(raw)
                self.words[word] = " ".join(map(str, ids)), b"".join([self.bytes_of[i] for i in ids])
            else:
                some.append((word, raw))
                size += len(raw)
                if size >= QUERY_BYTES:
                    flush()
        flush()

    def _of_words(self, words: list[str]) -> tuple[str, bytes]:
        if len(words) == 1:
            return self.words[words[0]]
        found = [self.words[w] for w in words]
        return " ".join([ids for ids, _ in found]), b"".join([raw for _, raw in found])

    def encode(self, texts: list[str | None]) -> Iterator[tuple[str, bytes]]:
        """For each text its ids in decimal, joined by one space, and the bytes they decode to."""
        if self.held > REMEMBERED_BYTES:
            for memory in (self.words, self.ids, self.decoded):
                memory.clear()
            self.held = 0
        split = [(text or "").split(" ") for text in texts]
        new = [p for p in set().union(*[parts[1:] for parts in split]) if p not in self.ids]
        # white space on either side of a space: there a match may begin elsewhere
        unclean = {p for p in new if not p or p != p.strip()}
        heads: list[list[str]] = []  # words before the first cut, of a text that can't be cut all its words
        tails: list[list[str]] = []  # pieces, each without the space before it
        for text, (first, *rest) in zip(texts, split):
            if rest and (not first or first[-1].isspace() or not unclean.isdisjoint(rest)):
                heads.append(self.pattern.findall(text))
                tails.append([])
            else:
                heads.append(self.pattern.findall(first))
                tails.append(rest)
        pieces = {p: self.pattern.findall(" " + p) for p in new if p not in unclean}
        wanted = {w for words in heads for w in words}.union(*pieces.values())
        self._learn_words([w for w in wanted if w not in self.words])
        for piece, words in pieces.items():
            self.ids[piece], self.decoded[piece] = self._of_words(words)
            self.held += len(piece) * 6 + ENTRY_BYTES
        for head, tail in zip(heads, tails):
            ids, raw = self._of_words(head)
            if tail:
                ids = " ".join([ids, *map(self.ids.__getitem__, tail)])
                raw = b"".join([raw, *map(self.decoded.__getitem__, tail)])
            yield ids, raw


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a vocabulary and a pattern."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _batches(rows: Iterable[tuple], columns: dict[str, pa.DataType], size_of) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= BATCH_BYTES:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), columns.values())], names=list(columns))
            held, size = [], 0
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), columns.values())], names=list(columns))


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (decimal, joined by one space), decoded (their bytes).

    `ranks` is the path of a vocabulary file that every worker can read. A null or empty
    text has no ids. Repeated rows are encoded each, a null doc_id stays null, other columns
    are ignored. No rows give no rows.
    """
    columns = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.string(), "decoded": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = codec(ranks, pattern)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for some in _portions(batch):
                    texts = some.column(1).to_pylist()
                    for doc_id, (ids, raw) in zip(some.column(0).to_pylist(), worker.encode(texts)):
                        yield doc_id, ids.count(" ") + 1 if ids else 0, ids, raw

        yield from _batches(rows(), columns, lambda row: len(row[2]) + len(row[3]))

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `BATCH_BYTES` of text, one row at least."""
    start, size = 0, 0
    for i, n in enumerate(pa.compute.binary_length(batch.column(1)).to_pylist()):
        size += n or 0
        if size >= BATCH_BYTES:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row of (doc_id, ids as decimals joined by one space): doc_id and decoded, the bytes.

    Null or empty ids are no bytes; an unknown id fails the job. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = codec(ranks, pattern)

        def decoded(lists: list[list[int]]) -> list[bytes]:
            cuts = [(k, x[i : i + DECODED_TOKENS]) for k, x in enumerate(lists) for i in range(0, len(x), DECODED_TOKENS)]
            out: list[list[bytes]] = [[] for _ in lists]
            some: list[tuple[int, list[int]]] = []
            for n, cut in enumerate(cuts):
                some.append(cut)
                if n + 1 == len(cuts) or sum(len(x) for _, x in some) + len(cuts[n + 1][1]) > DECODED_TOKENS:
                    for (k, _), raw in zip(some, worker.decode([x for _, x in some])):
                        out[k].append(raw)
                    some = []
            return [b"".join(parts) for parts in out]

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for some in _portions(batch):
                    lists = [[int(i) for i in (ids or "").split()] for ids in some.column(1).to_pylist()]
                    yield from zip(some.column(0).to_pylist(), decoded(lists))

        yield from _batches(rows(), {"doc_id": pa.int64(), "decoded": pa.binary()}, lambda row: len(row[1]))

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")

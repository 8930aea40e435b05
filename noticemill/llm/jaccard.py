"""Similarity join of documents on sets of word n-grams, by a prefix-tree join.

Sets are ordered by one global order, rare n-grams first (document counts over the whole
corpus). Two sets that are similar enough share an n-gram in their prefixes, so only
documents that share a prefix n-gram are brought together: the connected pieces of "shares
a prefix n-gram" are joined piece by piece. Equal sets are one class, joined once. Inside a
piece the sets are stored in a tree, frequent n-grams first; a walk over the tree keeps the
overlap of the path with every set, so sets with a common beginning share that work, and a
subtree is left when no set can reach the overlap it needs with what remains.

A piece above `GROUP_NGRAMS` n-grams is cut into parts, and each pair of parts is one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticemill.llm import blocks
from noticemill.llm.blocks import LAST
from noticemill.llm.common import written
from noticemill.llm.graph import components
from noticemill.llm.hashing import WordHashes, sequence_hashes
from noticemill.llm.repeats import doc_key

GROUP_NGRAMS = 262_144


@dataclass(frozen=True)
class Similarity:
    """Words of an n-gram, and the Jaccard similarity (in hundredths) from which sets link."""

    words: int = 5
    percent: int = 80

    def ngrams(self, text: str | None, known: WordHashes) -> np.ndarray:
        """Hashes of the set: n-grams of the words, or all words as one if there are fewer."""
        found = (text or "").encode().lower().split()
        if not found:
            return np.zeros(0, np.uint64)
        return np.unique(sequence_hashes(known.array(found), min(self.words, len(found))))

    def prefix(self, size: int) -> int:
        """Smallest n-grams of a set of which a similar set has at least one."""
        return size - -(-self.percent * size // 100) + 1

    def needed(self, a, b):
        """Overlap that sets of these sizes need."""
        return -(-self.percent * (a + b) // (100 + self.percent))


class PrefixTree:
    """The sets of a piece in a tree; finds for each set all similar ones."""

    def __init__(self, sets: list[np.ndarray], rule: Similarity):
        self.rule, self.n = rule, np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.n)
        values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # frequent n-grams first; those of one set alone add to no overlap
        order = np.lexsort((values, -counts))
        rank = np.empty(len(values), np.int64)
        rank[order] = np.arange(len(values))
        shared = int((counts > 1).sum())
        ranks = rank[inverse]
        keep = ranks < shared
        owner, ranks = owner[keep], ranks[keep]
        by_rank = np.lexsort((owner, ranks))
        self.members = owner[by_rank]
        self.edges = np.concatenate([[0], np.cumsum(np.bincount(ranks, minlength=shared))])
        in_order = ranks[np.lexsort((ranks, owner))]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sets)))])
        paths = [in_order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        coded = [p.astype(">u4").tobytes() for p in paths]
        self.order = sorted(range(len(sets)), key=coded.__getitem__)
        self.paths = [paths[k] for k in self.order]
        self.sizes = self.n[self.order]

    def _having(self, ranks: np.ndarray) -> np.ndarray:
        """How many of these n-grams each set has."""
        if not len(ranks):
            return np.zeros(len(self.n), np.int64)
        parts = [self.members[self.edges[r] : self.edges[r + 1]] for r in ranks.tolist()]
        return np.bincount(np.concatenate(parts), minlength=len(self.n))

    def links(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each set that has any, with all sets similar to it."""
        everyone = np.arange(len(self.n))
        stack = [(0, len(self.paths), 0, np.zeros(len(self.n), np.int64), everyone)]
        while stack:
            low, high, depth, overlap, alive = stack.pop()
            first, last = self.paths[low], self.paths[high - 1]
            same = min(len(first), len(last))
            differs = np.flatnonzero(first[depth:same] != last[depth:same])
            end = depth + int(differs[0]) if len(differs) else same
            overlap = overlap + self._having(first[depth:end])
            if high - low > 1:
                rest = max(len(p) for p in self.paths[low:high]) - end
                reach = overlap[alive] + rest >= self.rule.needed(self.sizes[low:high].min(), self.n[alive])
                alive = alive[reach]
                if not len(alive):
                    continue
            at = low
            while at < high and len(self.paths[at]) == end:
                yield from self._similar(at, overlap, alive)
                at += 1
            while at < high:
                to, step = at + 1, self.paths[at][end]
                while to < high and self.paths[to][end] == step:
                    to += 1
                stack.append((at, to, end, overlap, alive))
                at = to

    def _similar(self, at: int, overlap: np.ndarray, alive: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        own = self.order[at]
        together = overlap[alive]
        found = alive[100 * together >= self.rule.percent * (self.n[own] + self.n[alive] - together)]
        found = found[found != own]
        if len(found):
            yield own, found


ROWS = "doc_id long, doc long, row long, class long, n long, hashes binary, prefix array<long>"
NAMES = ["doc_id", "doc", "row", "class", "n", "hashes", "prefix"]
TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))


def _sets(stored: DataFrame, rule: Similarity) -> DataFrame:
    """A row for each document, and (row null) one for each class of a block that may have links."""
    buckets = blocks.n_buckets(stored)

    def hashes_of(texts: list) -> Iterator[np.ndarray]:
        known = WordHashes()
        for text in texts:
            yield rule.ngrams(text, known)

    def run(block: int, rows: pa.Table, found: pa.Table) -> pa.Table:
        import xxhash

        out: list[list] = [[] for _ in NAMES]
        counts, known, seen = blocks.Counts(found), WordHashes(), set()
        docs, texts = rows.column("_doc_id").to_pylist(), rows.column("_text").to_pylist()
        for place, (doc_id, text) in enumerate(zip(docs, texts)):
            hashes = rule.ngrams(text, known)
            size = len(hashes)
            label = xxhash.xxh3_64_intdigest(hashes.tobytes(), 3) - (1 << 63) if size else None
            made = [(doc_id, doc_key(doc_id), blocks.row_number(block, place), label, size, None, None)]
            if size and label not in seen:
                seen.add(label)
                n = counts.of(blocks.reduced(hashes, buckets))
                rare_first = np.lexsort((hashes, n))[: rule.prefix(size)]
                common = hashes[rare_first][n[rare_first] > 1]
                if len(common):
                    made.append((None, None, None, label, size, hashes.tobytes(), common.view(np.int64).tolist()))
            for row in made:
                for column, value in zip(out, row):
                    column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(out, TYPES)], names=NAMES)

    common = blocks.common_hashes(stored, hashes_of, buckets)
    return written(blocks.with_blocks(stored, common, run, ROWS), "sets")


def _tasks(classes: DataFrame) -> DataFrame:
    """Each class with the tasks it goes to: task, piece, first and second part, its own part."""
    postings = classes.select("class", F.explode("prefix").alias("ngram"))
    shared = postings.groupBy("ngram").agg(F.min("class").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    near = postings.join(shared, "ngram").select(F.col("class").alias("u"), F.col("least").alias("v"))
    pieces = components(near)
    roots = pieces.select(F.col("root").alias("node")).distinct().withColumn("root", F.col("node"))
    pieces = written(pieces.unionByName(roots).select(F.col("node").alias("class"), F.col("root").alias("piece")), "pieces")
    held = classes.select("class", "n", "size").join(pieces, "class")
    totals = held.groupBy("piece").agg(F.sum("n").alias("ngrams"))
    all_ngrams = totals.agg(F.sum("ngrams").alias("n")).first().n or 0
    bins = max(1, -(-all_ngrams // GROUP_NGRAMS))
    totals = totals.select("piece", F.ceil(F.col("ngrams") / GROUP_NGRAMS).cast("int").alias("parts"))
    held = held.join(totals, "piece")
    own = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    held = held.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    a, b = F.least("own", "other"), F.greatest("own", "other")
    # small pieces share tasks; the tasks of a cut piece have one to themselves
    task = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("piece"), F.lit(bins))).otherwise(
        -1 - F.pmod(F.xxhash64("piece", a, b), F.lit(1 << 62))
    )
    return held.select("class", "size", "piece", "own", a.alias("a"), b.alias("b"), task.alias("task"))


def _linked(tasks: DataFrame, classes: DataFrame, rule: Similarity) -> DataFrame:
    """Links between classes: `to` names one class of each that a walk joined, `docs` counts documents.

    Rows (class, to, null) are enough links to connect what is connected; rows (class, null,
    docs) add up to the documents in all linked classes.
    """

    def join(group: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        columns = [group.column(c).to_pylist() for c in ("piece", "a", "b", "own", "class", "size", "hashes")]
        pieces: dict[tuple, list] = {}
        for piece, a, b, own, label, size, raw in zip(*columns):
            pieces.setdefault((piece, a, b), []).append((own, label, size, np.frombuffer(raw, "<u8")))
        for (_, a, b), rows in pieces.items():
            if len(rows) < 2:
                continue
            parts, labels, sizes = (np.array([r[i] for r in rows]) for i in range(3))
            root = list(range(len(rows)))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for own, found in PrefixTree([r[3] for r in rows], rule).links():
                if a != b:
                    found = found[parts[found] != parts[own]]
                    if not len(found):
                        continue
                out[0].append(int(labels[own]))
                out[1].append(None)
                out[2].append(int(sizes[found].sum()))
                for other in found.tolist():
                    x, y = find(own), find(other)
                    if x != y:
                        root[x] = y
                        for column, value in zip(out, (int(labels[own]), int(labels[other]), None)):
                            column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["class", "to", "docs"])

    delivered = tasks.join(classes.select("class", "hashes"), "class")
    return written(delivered.groupBy("task").applyInArrow(join, "class long, to long, docs long"), "links")


def _grouped(stored: DataFrame, rule: Similarity) -> DataFrame:
    """Per document doc_id, row, n, and of its group: n_links, first_doc and first_row."""
    rows = _sets(stored, rule)
    docs = rows.filter(F.col("row").isNotNull()).select("doc_id", "doc", "row", "class", "n")
    sizes = docs.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct("doc", "row")).alias("first")
    )
    sizes = written(sizes, "classes")
    sets = rows.filter(F.col("row").isNull()).groupBy("class").agg(
        F.first("n").alias("n"), F.first("hashes").alias("hashes"), F.first("prefix").alias("prefix")
    )
    classes = written(sets.join(sizes.select("class", "size"), "class"), "sets-once")
    links = _linked(_tasks(classes), classes, rule)
    labels = components(links.filter(F.col("to").isNotNull()).select(F.col("class").alias("u"), F.col("to").alias("v")))
    linked = links.groupBy("class").agg(F.sum("docs").alias("docs"))
    known = sizes.join(labels.select(F.col("node").alias("class"), "root"), "class", "left").join(linked, "class", "left")
    known = known.withColumn("root", F.coalesce("root", "class"))
    firsts = known.groupBy("root").agg(F.min("first").alias("first"))
    n_links = F.col("size") - 1 + F.coalesce("docs", F.lit(0))
    known = known.drop("first").join(firsts, "root").select("class", n_links.alias("n_links"), "first")
    joined = docs.join(known, "class", "left")
    return joined.select(
        "doc_id",
        "row",
        F.col("n").alias("n_ngrams"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("first.doc", "doc").alias("_first_doc"),
        F.coalesce("first.row", "row").alias("first_row"),
    ).select(
        "doc_id", "row", "n_ngrams", "n_links", F.when(F.col("_first_doc") != LAST, F.col("_first_doc")).alias("first_doc"), "first_row"
    )


def linked_documents(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """Per row of `docs` its set's size and its group of linked documents.

    doc_id, row (a number for the row), n_ngrams, n_links (other rows similar to it), and
    first_doc, first_row: the row with the smallest doc_id (null last; then as read) that
    links reach, itself included. Two rows link when the Jaccard similarity of their sets
    reaches `rule.percent` hundredths. Texts are put into small letters (A-Z) and split at
    white space. Null and empty texts have empty sets and link with nothing. Repeated rows
    link like other equal texts. Sets are compared as 64-bit hashes of their n-grams. Other
    columns are ignored.
    """
    return _grouped(blocks.store(docs), rule)


def one_of_each(docs: DataFrame, rule: Similarity = Similarity()) -> DataFrame:
    """The rows of `docs`, all columns, that are the first of their group."""
    stored = blocks.store(docs)
    first = _grouped(stored, rule).filter("row = first_row")
    bits = blocks.ROW_BITS
    places = first.select(
        F.shiftright("row", bits).alias("block"), F.col("row").bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("place")
    )
    others = [f for f in docs.schema.fields if f.name != "text"]
    schema = f"row {docs.select(*(f.name for f in others)).schema.simpleString()}, text string"

    def pick(block: int, rows: pa.Table, found: pa.Table) -> pa.Table:
        chosen = pa.array(sorted(found.column("place").to_pylist()), pa.int64())
        rows = rows.take(chosen)
        return pa.table({"row": rows.column("_row"), "text": rows.column("_text")})

    return blocks.with_blocks(stored, places, pick, schema).select("row.*", "text").select(*docs.columns)

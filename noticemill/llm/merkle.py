"""A Merkle manifest of a document set: digests by language, one root, a proof for each row.

The levels are built from the leaves up, eight nodes to a parent, and stored as
parent-linked node rows. Each row holds its place (tree, level, idx), its digest, the
digests of its siblings left and right of it, and the place of its parent. A recursive
query then climbs from the leaves to the root: each step joins the node rows, appends the
siblings met there and folds them around the digest it carries.

The leaves of one run share every sibling above their own, so they climb together in one
row of at most eight: siblings are appended once and folded around each leaf's digest.
Digests are kept as 32 bytes and hashed as lowercase hex text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticemill.llm.common import small_letters, work_path, written

FAN = 8
# The tree over the subroots. Trees of languages are '' (null) or x and the language, so
# none has this name, and they sort null first and then by their UTF-8 bytes.
TOP = "root"

CLIMB = """
with recursive climb as (
  select tree, level, idx, subroot, above, leaves from {first}
  union all
  select n.parent_tree, n.parent_level, n.parent_idx, coalesce(c.subroot, if(n.parent_tree = :top, n.digest, null)),
    concat(c.above, n.before, n.after),
    transform(c.leaves, x -> named_struct('doc_id', x.doc_id, 'leaf', x.leaf,
      'folded', unhex(sha2(lower(hex(concat(n.before, x.folded, n.after))), 256))))
  from climb c join {nodes} n on c.tree = n.tree and c.level = n.level and c.idx = n.idx)
select * from climb where tree = :tree and level = :level and idx = 0
"""


def digest_of(value: Column) -> Column:
    """sha256 of a binary or string value, as 32 bytes."""
    return F.unhex(F.sha2(value, 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda a, x: F.concat(a, x))


def _part(value: Column, text: Column | None = None) -> Column:
    text = value.cast("string") if text is None else text
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves_of(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, leaf, claimed): the leaf of each row, and of the row as it is claimed to be.

    A claimed row has A-Z of its text in small letters where 3 divides the crc32 of its
    doc_id in decimal; a null doc_id or text stays as it is.
    """
    before = [_part(F.col(name)) for name in ("doc_id", "source", "lang", "n_chars")]
    leaf = digest_of(F.concat(*before, _part(F.col("text"))))
    changed = digest_of(F.concat(*before, _part(F.col("text"), small_letters(F.col("text")))))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tree = F.coalesce(F.concat(F.lit("x"), "lang"), F.lit(""))
    return docs.select(tree.alias("tree"), "doc_id", leaf.alias("leaf"), F.when(tampered, changed).otherwise(leaf).alias("claimed"))


def numbered(rows: DataFrame, group: str, order: list[str], place: str, name: str) -> DataFrame:
    """`rows` with `place` (0-based by `order` inside the group) and `n` (rows of the group).

    Rows are sorted over all tasks and written; each task's part of a group gets its start
    from a running count over the parts, one row per part. Equal rows may be many: they are
    spread by where they were read and numbered one way or the other.
    """
    spread = [*order, "_from"]
    placed = (
        rows.withColumn("_from", F.spark_partition_id())
        .repartitionByRange(group, *spread)
        .sortWithinPartitions(group, *spread)
        .drop("_from")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = written(placed, name).withColumn("_part", F.shiftright("_place", 33))
    parts = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_least"))
    running = Window.partitionBy(group).orderBy("_part")
    starts = parts.select(
        group,
        "_part",
        (F.sum("_rows").over(running) - F.col("_rows") - F.col("_least")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("n"),
    )
    found = placed.join(starts, [group, "_part"])
    return found.withColumn(place, F.col("_place") + F.col("_shift")).drop("_place", "_part", "_shift")


def _run_of(position: str) -> Column:
    return F.floor(F.col(position) / FAN).alias("run")


def _links(nodes: DataFrame) -> DataFrame:
    """Node rows of one level: place, digest, the siblings left and right, the parent.

    `nodes` has place (tree, level, idx), digest, and `to` (tree of the parent), `rank` (its
    place among the `n` nodes that become one tree). Nodes alone have no parent.
    """
    node = F.struct("rank", "tree", "level", "idx", "digest")
    runs = nodes.filter("n > 1").groupBy("to", _run_of("rank")).agg(
        F.first("n").alias("n"), F.max("up").alias("up"), F.array_sort(F.collect_list(node)).alias("nodes")
    )
    runs = runs.withColumn("digests", F.transform("nodes", lambda x: x.digest))
    each = runs.select("*", digest_of(as_hex(_joined(F.col("digests")))).alias("above"), F.posexplode("nodes").alias("pos", "node"))
    return each.select(
        "node.tree",
        "node.level",
        "node.idx",
        "node.digest",
        _joined(F.expr("slice(digests, 1, pos)")).alias("before"),
        _joined(F.expr(f"slice(digests, pos + 2, {FAN})")).alias("after"),
        F.col("to").alias("parent_tree"),
        (F.col("up") + 1).alias("parent_level"),
        F.col("run").alias("parent_idx"),
        F.col("above").alias("parent_digest"),
        F.ceil(F.col("n") / FAN).alias("parent_n"),
        "pos",
    )


def _raise(nodes: DataFrame, path: str) -> DataFrame:
    """Write the node rows of all levels from `nodes` up; returns the last node of each tree."""
    spark, ends, step = nodes.sparkSession, None, 0
    while True:
        last = nodes.filter("n = 1").select("tree", "level", "idx", "digest")
        ends = last if ends is None else ends.unionByName(last)
        folder = f"{path}-{step}"
        _links(nodes).write.parquet(folder)
        rows = spark.read.parquet(folder)
        if rows.isEmpty():
            return ends
        nodes = rows.filter("pos = 0").select(
            F.col("parent_tree").alias("tree"),
            F.col("parent_level").alias("level"),
            F.col("parent_idx").alias("idx"),
            F.col("parent_digest").alias("digest"),
            F.col("parent_tree").alias("to"),
            F.col("parent_idx").alias("rank"),
            F.col("parent_level").alias("up"),
            F.col("parent_n").alias("n"),
        )
        step += 1


def _runs_of_leaves(leaves: DataFrame) -> DataFrame:
    """Leaves eight to a row, with the place and digest of the node they become.

    A language's only leaf stays itself, at level 0.
    """
    node = F.struct("idx", "doc_id", "leaf", "claimed")
    runs = leaves.groupBy("tree", _run_of("idx")).agg(
        F.first("n").alias("leaves_n"), F.array_sort(F.collect_list(node)).alias("nodes")
    )
    alone, own = F.col("leaves_n") == 1, _joined(F.transform("nodes", lambda x: x.leaf))

    def folded(node: Column, i: Column) -> Column:
        around = _joined(F.transform("nodes", lambda x: F.when(x.idx == node.idx, x.claimed).otherwise(x.leaf)))
        return F.struct(
            node.doc_id.alias("doc_id"),
            node.leaf.alias("leaf"),
            F.when(alone, node.claimed).otherwise(digest_of(as_hex(around))).alias("folded"),
        )

    level = F.when(alone, 0).otherwise(1)
    return runs.select(
        "tree",
        level.alias("level"),
        F.col("run").alias("idx"),
        F.when(alone, own).otherwise(digest_of(as_hex(own))).alias("digest"),
        F.col("tree").alias("to"),
        F.col("run").alias("rank"),
        level.alias("up"),
        F.ceil(F.col("leaves_n") / FAN).alias("n"),
        F.transform("nodes", folded).alias("leaves"),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof, folded_root (digests of 32 bytes), verified.

    `docs` has doc_id, source, lang, n_chars, text; other columns are ignored. A leaf is the
    sha256 of these five, each `-` if null, else its UTF-8 byte count, a colon and the value.
    Leaves of a language ascend by doc_id (null first; equal ids by leaf); repeated rows are
    leaves each. Eight at a time become their parent, level by level up to the subroot; the
    subroots, null language first, then by bytes, likewise become the root. `proof` is the
    digests of a leaf's siblings from its own run up to the root, left to right.
    `folded_root` is the root recomputed from the claimed row (see `leaves_of`) and the
    proof. A document alone is leaf, subroot and root with an empty proof; no documents give
    no rows.

    Leaves, runs and node rows are written to the shared folder; only the root goes to the
    driver. The recursive query takes one step per level, log8 of the rows. Its cap on rows
    is lifted for the session: here they are documents, not the sign of an endless query.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    leaves = numbered(written(leaves_of(docs), "merkle-leaves"), "tree", ["doc_id", "leaf"], "idx", "merkle-numbered")
    runs = written(_runs_of_leaves(leaves), "merkle-runs")

    path = work_path(spark, "merkle-nodes")
    subroots = _raise(runs.drop("leaves"), f"{path}/part=tree")
    ranked = numbered(subroots.withColumn("to", F.lit(TOP)), "to", ["tree"], "rank", "merkle-subroots")
    top = _raise(ranked.withColumn("up", F.lit(0)), f"{path}/part=top").first()
    if top is None:
        top = (None, None, None, b"")
    nodes = spark.read.parquet(path)
    first = runs.select("tree", "level", "idx", F.lit(None).cast("binary").alias("subroot"), F.lit(b"").alias("above"), "leaves")
    ended = spark.sql(CLIMB, {"top": TOP, "tree": top[0], "level": top[1]}, first=first, nodes=nodes)

    each = ended.select("subroot", "above", "leaves", F.posexplode("leaves").alias("pos", "row"))
    siblings = F.transform("leaves", lambda x, i: F.when(i == F.col("pos"), F.lit(b"")).otherwise(x.leaf))
    root = F.lit(bytes(top[3]))
    return each.select(
        "row.doc_id",
        "row.leaf",
        F.coalesce("subroot", root).alias("subroot"),
        root.alias("root"),
        F.concat(_joined(siblings), "above").alias("proof"),
        F.col("row.folded").alias("folded_root"),
        (F.col("row.folded") == root).alias("verified"),
    )

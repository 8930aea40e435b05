"""Benchmark decontamination with a positional inverted index.

Each window of an item is looked up by its rarest word (fewest documents). Postings of only
those words are stored, with the place and the neighbouring words; a posting meets an
item's occurrence of the word if the longer half of a window beside it agrees, and the
match is then extended word by word to both sides. What agrees over a whole window is a hit.

Column expressions only. One pass counts documents per benchmark word, one writes the
postings (in the document's row, so that no text is shuffled); after that only postings move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticemill.llm.common import plain_words, written

WINDOW = 13
# Rarest words that one pass over the texts looks for; more of them take more passes.
TERMS_PER_PASS = 20_000
# Benchmark words that may be broadcast to count them; more are joined by a shuffle.
BROADCAST_TERMS = 1_000_000


def _common_prefix(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays agree."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(same, F.lit(False))
    return F.when(differs == 0, F.size(same)).otherwise(differs - 1).cast("int")


def _in_context(words: str, places: Column) -> Column:
    """Structs (pos, word, before, after) for places; `before` runs backwards from the word."""
    side = WINDOW - 1
    return F.transform(
        places,
        lambda p: F.struct(
            p.alias("pos"),
            F.get(F.col(words), p).alias("word"),
            F.reverse(F.slice(F.col(words), F.greatest(p - side, F.lit(0)) + 1, F.least(p, F.lit(side)))).alias("before"),
            F.slice(F.col(words), p + 2, side).alias("after"),
        ),
    )


def _row_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def document_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """word, n_docs: in how many rows of `docs` each word of `vocabulary` occurs (0 left out)."""
    words = docs.select(F.explode(F.array_distinct(plain_words(F.coalesce("text", F.lit(""))))).alias("word"))
    if vocabulary.count() <= BROADCAST_TERMS:
        vocabulary = F.broadcast(vocabulary)
    return words.join(vocabulary, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))


def item_terms(docs: DataFrame, items: DataFrame) -> DataFrame:
    """For each item the places of its windows' rarest words.

    item_id, n_words, window (words in a window: 13, or the whole of a shorter item), pos,
    word, before, after. Items without words are left out.
    """
    rows = items.select("item_id", plain_words(F.coalesce("text", F.lit(""))).alias("_words")).distinct()
    rows = rows.filter(F.size("_words") > 0)
    everywhere = _in_context("_words", F.sequence(F.lit(0), F.size("_words") - 1))
    placed = rows.select(
        "item_id",
        F.xxhash64("_words").alias("_row"),
        F.size("_words").alias("n_words"),
        F.inline(everywhere),
    )
    placed = written(placed, "benchmark-words")
    counts = document_counts(docs, placed.select("word").distinct())
    placed = placed.join(counts, "word", "left").fillna(0, ["n_docs"])
    ahead = Window.partitionBy("item_id", "_row").orderBy("pos").rowsBetween(0, WINDOW - 1)
    rarest = F.min(F.struct("n_docs", "word", "pos")).over(ahead)["pos"]
    window = F.least(F.lit(WINDOW), F.col("n_words"))
    starts = placed.withColumn("window", window).withColumn("_rarest", rarest)
    wanted = starts.filter(F.col("pos") <= F.col("n_words") - F.col("window"))
    wanted = wanted.select("item_id", "_row", F.col("_rarest").alias("pos")).distinct()
    both = starts.drop("_rarest", "n_docs").alias("s").join(
        wanted.alias("w"),
        F.col("s.item_id").eqNullSafe(F.col("w.item_id"))
        & (F.col("s._row") == F.col("w._row"))
        & (F.col("s.pos") == F.col("w.pos")),
        "left_semi",
    )
    return both.drop("_row")


def postings(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, row_hash, n_words and `places`: where the terms stand in each row, in context."""
    df = docs.select("doc_id", _row_hash().alias("row_hash"), plain_words(F.coalesce("text", F.lit(""))).alias("_words"))
    listed = ", ".join(f"'{t}'" for t in terms) or "NULL"  # words hold no quotes and no backslashes
    found = F.expr(f"filter(transform(_words, (w, i) -> if(w in ({listed}), i, null)), i -> i is not null)")
    df = df.select("doc_id", "row_hash", "_words", F.size("_words").cast("bigint").alias("n_words"), found.alias("_found"))
    return df.select("doc_id", "row_hash", "n_words", _in_context("_words", F.col("_found")).alias("places"))


def _keys(window: Column) -> Column:
    """Hashes of the half windows after and before a word that are complete, each with its side."""
    half = F.expr("int(window div 2)")

    def key(side: str) -> Column:
        return F.when(
            F.size(side) >= half, F.xxhash64(F.lit(side), window, F.col("word"), F.slice(F.col(side), F.lit(1), half))
        )

    return F.array_compact(F.array(key("after"), key("before")))


def occurrences(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of `docs` (doc_id, row_hash, n_words) and the places where item windows occur.

    A place: doc_id, row_hash, item_id, first and last word (from 0) of a run of words in
    which every word lies in an occurring window of the item. Equal rows share their places.
    """
    terms = written(item_terms(docs, items), "benchmark-terms")
    words = [row.word for row in terms.select("word").distinct().orderBy("word").toLocalIterator()]
    windows = sorted(row.window for row in terms.select("window").distinct().collect())  # 13 at most
    slices = [words[i : i + TERMS_PER_PASS] for i in range(0, len(words), TERMS_PER_PASS)] or [[]]
    stored = [written(postings(docs, part), "postings") for part in slices]
    places = stored[0]
    for more in stored[1:]:
        places = places.unionByName(more)
    held = places.filter(F.size("places") > 0).select("doc_id", "row_hash", F.inline("places"))
    sizes = F.array(*map(F.lit, windows)).cast("array<int>")
    held = held.select("*", F.explode(sizes).alias("window"))
    held = held.withColumn("_key", F.explode(_keys(F.col("window")))).alias("d")
    sought = terms.withColumn("_key", F.explode(_keys(F.col("window")))).alias("t")
    met = held.join(
        sought,
        (F.col("d._key") == F.col("t._key")) & (F.col("d.window") == F.col("t.window")) & (F.col("d.word") == F.col("t.word")),
    )
    before = _common_prefix(F.col("d.before"), F.col("t.before"))
    after = _common_prefix(F.col("d.after"), F.col("t.after"))
    met = met.select(
        "d.doc_id",
        "d.row_hash",
        "t.item_id",
        (F.col("d.pos") - before).alias("first"),
        (F.col("d.pos") + after).alias("last"),
        F.col("d.window").alias("window"),
    )
    hits = met.filter(F.col("last") - F.col("first") + 1 >= F.col("window")).drop("window").distinct()
    return stored[0].select("doc_id", "row_hash", "n_words"), hits


def contaminated(docs: DataFrame, items: DataFrame, share: int = 20) -> DataFrame:
    """Per row of `docs`: how many of its words lie in occurring windows of benchmark items.

    doc_id, row_hash, n_words, n_hit, n_items (distinct item_ids with an occurring window),
    items (their ids as strings, sorted), contaminated (n_hit > 0 and share * n_hit >=
    n_words). A null or empty text has no words and is clean. An item without words never
    occurs; one with a null id hits words but is not listed. Repeated rows get the same
    result each; other columns are ignored.
    """
    rows, hits = occurrences(docs, items)
    per_row = hits.groupBy("doc_id", "row_hash").agg(
        F.sort_array(F.collect_set(F.struct("first", "last"))).alias("_runs"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).alias("end"))

    def step(acc: Column, run: Column) -> Column:
        new = F.greatest(F.lit(0), run["last"] - F.greatest(acc["end"], run["first"] - 1))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["end"], run["last"]).alias("end"))

    per_row = per_row.select(
        "doc_id", "row_hash", "items", F.aggregate("_runs", start, step, lambda acc: acc["n"]).alias("n_hit")
    )
    same = F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("r.row_hash") == F.col("h.row_hash"))
    joined = rows.alias("r").join(per_row.alias("h"), same, "left")
    n_hit = F.coalesce(F.col("h.n_hit"), F.lit(0).cast("bigint"))
    found = F.coalesce(F.col("h.items"), F.array().cast("array<string>"))
    return joined.select(
        "r.doc_id",
        "r.row_hash",
        "r.n_words",
        n_hit.alias("n_hit"),
        F.size(found).cast("bigint").alias("n_items"),
        found.alias("items"),
        ((n_hit > 0) & (n_hit * share >= F.col("r.n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, share: int = 20) -> DataFrame:
    """The rows of `docs`, all columns, that are not contaminated."""
    found = contaminated(docs, items, share).filter("contaminated").select("doc_id", "row_hash").distinct().alias("f")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", _row_hash().alias("row_hash")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.row_hash") == F.col("f.row_hash"))
    return rows.join(found, same, "left_anti").select("_row.*")


def near_matches(docs: DataFrame, items: DataFrame, terms: int = 3, within: int = 30) -> DataFrame:
    """Rows in which an item's `terms` rarest words stand within `within` words, in any order.

    doc_id, row_hash, item_id, first (where the first such stretch begins). Items with fewer
    distinct words than `terms` need all they have.
    """
    words = written(
        items.select("item_id", F.explode(F.array_distinct(plain_words(F.coalesce("text", F.lit(""))))).alias("word")).distinct(),
        "benchmark-words",
    )
    counted = words.join(document_counts(docs, words.select("word").distinct()), "word", "left").fillna(0, ["n_docs"])
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("n_docs", "word"))
    rarest = counted.withColumn("_rank", rank).filter(F.col("_rank") <= terms)
    needed = F.count(F.lit(1)).over(Window.partitionBy("item_id"))
    rarest = written(rarest.select("item_id", "word", needed.alias("needed")), "benchmark-rarest")
    wanted = [row.word for row in rarest.select("word").distinct().orderBy("word").toLocalIterator()]
    slices = [wanted[i : i + TERMS_PER_PASS] for i in range(0, len(wanted), TERMS_PER_PASS)] or [[]]
    found = None
    for part in slices:
        rows = postings(docs, part).select("doc_id", "row_hash", F.inline("places"))
        rows = rows.select("doc_id", "row_hash", "pos", "word")
        found = rows if found is None else found.unionByName(rows)
    stretch = Window.partitionBy("doc_id", "row_hash", "item_id").orderBy("pos").rangeBetween(0, within - 1)
    met = found.distinct().join(rarest, "word")
    met = met.withColumn("_words", F.size(F.collect_set("word").over(stretch))).filter(F.col("_words") == F.col("needed"))
    return met.groupBy("doc_id", "row_hash", "item_id").agg(F.min("pos").alias("first"))

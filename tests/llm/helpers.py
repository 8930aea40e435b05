"""Small tables with the cases every operator has to bear."""

from __future__ import annotations

import random

LONG = " ".join(f"w{i % 7001}x{i}" for i in range(30_000))
WHITE = " \t\n\x0b\f\r"


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


def edge_texts() -> list[str | None]:
    """Null, empty, white space alone, one word, very long, odd characters, repeated texts."""
    rng = random.Random(4)
    a, b = prose(rng, 120), prose(rng, 90)
    return [
        None,
        "",
        WHITE,
        "one",
        LONG,
        "Ünï cödé İK ß    日本語 \U0001f600 <|endoftext|> it's we'll  two  spaces \n\n end ",
        a,
        a,
        a + " " + b,
        b + "\n" + a,
        a.upper(),
        prose(rng, 60) + " " + a[: len(a) // 2],
        "x " * 300,
        " ".join(["again and again"] * 40),
    ]


def edge_documents(spark, extra: bool = True):
    """Edge texts with ids, one null id, one repeated id and one repeated row.

    The further columns have names that operators might use themselves.
    """
    texts = edge_texts()
    data = [(i, t, i % 3) for i, t in enumerate(texts)]
    data += [(None, texts[6], 1), (None, "fresh words only here", None), (8, texts[9], 2), data[8]]
    schema = "doc_id bigint, text string, n_words int"
    df = spark.createDataFrame(data, schema)
    if not extra:
        return df.select("doc_id", "text")
    for name in ("row", "block", "words", "_text", "_row", "class", "text_"):
        df = df.withColumn(name, df["n_words"])
    return df


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, n_words int")


def white_words(text):
    return [w.decode() for w in (text or "").encode().split()]

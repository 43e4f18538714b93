"""Small tables for the tests: prose of invented words, and rows at the edges."""

import random

from pyspark.sql import types as T

SYLLABLES = {
    "xx": ["ka", "lo", "mi", "ru", "ten", "sa", "po", "vi"],
    "yy": ["sch", "eng", "urt", "ost", "ber", "ach", "lich", "um"],
}


def word(rnd, lang="xx"):
    return "".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3)))


def prose(seed, n, lang="xx"):
    rnd = random.Random(seed)
    return " ".join(word(rnd, lang) for _ in range(n))


LONG = prose(99, 30_000)
#: Columns whose names operators use inside.
CLASHING = ["key", "node", "group", "row", "id", "h", "w", "score", "bpe", "spans", "language", "notices", "text_key",
            "staying", "unrepeated", "bits", "s", "at", "hits", "kept", "TEXT_"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in CLASHING]])


def frame(spark, rows):
    """Rows of (doc_id, text, lang, source), with the clashing columns filled."""
    full = [(*r, *(None,) * (4 - len(r)), *(["?"] * len(CLASHING))) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def edge_rows():
    """Nulls in any column, empty and blank texts, one very long text, ties, repeated rows, odd characters."""
    return [
        (1, None, "xx", "a"), (2, "", "xx", None), (3, " \t\n\r\x0b\x0c ", None, "a"), (4, LONG, "xx", "a"),
        (5, prose(1, 80), "xx", "a"), (5, prose(1, 80), "xx", "a"), (5, prose(2, 80), "xx", "a"),
        (None, prose(1, 80), "xx", "a"), (None, None, None, None), (6, prose(1, 80), None, None),
        (7, prose(3, 60, "yy"), "yy", "b"), (8, "a", "xx", "b"), (9, "é中\U0001f600 ١٢  x\x00y", "yy", "b"),
        (10, prose(1, 80).upper(), "xx", "b"), (11, "...!!!", "xx", "b"),
    ]


def edges(spark):
    return frame(spark, edge_rows())


def empty(spark):
    return frame(spark, []).limit(0)


def by_id(df, *cols):
    out = {}
    for r in df.select("doc_id", *cols).collect():
        out.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    return out

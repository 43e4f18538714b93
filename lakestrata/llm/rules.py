"""Quality rules with adaptive thresholds, in DataFrame operations only.

Each document has a few measures of its text.  Their quartiles are taken
per language and source with mergeable KLL sketches, so a task sends one
sketch a group; a document goes where a measure lies beyond its group's
fence, the quartile plus some spreads.  Groups of few documents take the
fences of their language, languages of few those of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import written

WINDOW = 8  # a power of two: hashes are combined by doubling
#: Fixed part of the rules: fewer words, or a larger percentage of repeated words, fails.
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
#: Items a sketch keeps at its finest level; quartiles of up to this many rows are exact.
SKETCH = 1024
#: Rows that a group needs for fences of its own.
MIN_ROWS = 200
#: Spreads beyond the quartile that still pass.
SPREADS = 4.0
#: Measure -> its least spread (a quartile distance below it counts as this much), and whether low values fail too.
MEASURES = {
    "word_length": (0.35, True),
    "symbols_a_word": (0.03, False),
    "repeated_lines": (0.12, False),
    "repeated_words": (0.075, False),
}


def _combined(hashes: str, by: int) -> str:
    """Each hash with the one ``by`` places on; ``by`` fewer than there were."""
    return (f"zip_with(slice({hashes}, 1, greatest(0, size({hashes}) - {by})), "
            f"slice({hashes}, {by + 1}, size({hashes})), (x, y) -> xxhash64(x, y))")


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` and the counts of every text: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    A null text counts as empty.  n_lines are the lines with a word.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    spaced = t
    for gap in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(gap), F.lit(" "))
    rows = docs.select(*keep, t.alias("t"), spaced.alias("spaced"))
    rows = rows.select(
        *keep, F.split("spaced", " ").alias("parts"), F.length("spaced").alias("n_chars_"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "").alias("lines"))
    rows = rows.select(
        *keep, "n_symbols",
        (F.col("n_chars_") - F.size("parts") + 1).cast("long").alias("word_chars"),
        F.transform(F.array_remove("parts", ""), lambda x: F.xxhash64(x)).alias("h"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    # Hashes of eight words in a row: of two, of two twos, of two fours.
    rows = rows.withColumn("n_words", F.size("h").cast("long"))
    for by in (1, 2, 4):
        rows = rows.withColumn("h", F.expr(_combined("h", by)))
    # Only texts with a repeated window order theirs, and see which have an equal neighbour.
    repeated = F.size(F.array_distinct("h")) < F.size("h")
    rows = rows.withColumn("ordered", F.when(repeated, F.sort_array(F.expr("transform(h, (x, i) -> struct(x as h, i as at))"))))
    starts = """sort_array(transform(filter(ordered, (x, i) ->
        coalesce(get(ordered, i - 1).h = x.h, false) or coalesce(get(ordered, i + 1).h = x.h, false)), x -> x.at))"""
    rows = rows.withColumn("starts", F.when(F.col("ordered").isNotNull(), F.expr(starts)))
    covered = f"""aggregate(transform(starts, (x, i) -> least({WINDOW}, coalesce(get(starts, i + 1) - x, {WINDOW}))),
        0L, (s, x) -> s + x)"""
    return rows.select(*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                       F.coalesce(F.expr(covered), F.lit(0).cast("long")).alias("n_repeat_words"))


def _measures() -> dict[str, Column]:
    a_word = lambda c: F.try_divide(F.col(c), F.col("n_words").cast("double"))  # noqa: E731  (null without words; tried before base_failed is asked)
    return {"word_length": a_word("word_chars"), "symbols_a_word": a_word("n_symbols"),
            "repeated_lines": F.when(F.col("n_lines") > 0, F.col("n_dup_lines") / F.col("n_lines").cast("double")).otherwise(F.lit(0.0)),
            "repeated_words": a_word("n_repeat_words")}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def sketched(rows: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(l, s, rows, a sketch per measure) of each language and source, nulls being values of their own."""
    return (rows.select(F.struct(F.col(lang).alias("v")).alias("l"), F.struct(F.col(source).alias("v")).alias("s"),
                        *[c.alias(k) for k, c in _measures().items()])
            .groupBy("l", "s").agg(F.count("*").alias("rows"),
                                   *[F.kll_sketch_agg_double(k, F.lit(SKETCH)).alias(k) for k in MEASURES]))


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    return sketches.groupBy(*by).agg(F.sum("rows").alias("rows"),
                                     *[F.kll_merge_agg_double(k, F.lit(SKETCH)).alias(k) for k in MEASURES])


def fences(sketches: DataFrame, least_rows: int, *by: str) -> DataFrame:
    """``by`` and <measure>_low, <measure>_high of the groups of at least ``least_rows``."""
    out = []
    for k, (least, both) in MEASURES.items():
        low, high = (F.kll_sketch_get_quantile_double(k, F.lit(q)) for q in (0.25, 0.75))
        spread = F.greatest(high - low, F.lit(least))
        out += [(high + SPREADS * spread).alias(k + "_high")]
        out += [(low - SPREADS * spread).alias(k + "_low")] if both else []
    return sketches.where(F.col("rows") >= least_rows).select(*by, *out)


def judged(rows: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``rows`` (of ``measured``) with base_failed and kept."""
    rows = rows.withColumn("base_failed", base_failed())
    own = written(sketched(rows.where(~F.col("base_failed")), lang, source), "sketches")
    names = [f"{k}_{end}" for k, (_, both) in MEASURES.items() for end in (("high", "low") if both else ("high",))]
    found = lambda n: F.struct(*names).alias(n)
    overall = fences(merged(own), 1)
    keyed = (rows.withColumn("l", F.struct(F.col(lang).alias("v"))).withColumn("s", F.struct(F.col(source).alias("v")))
             .join(fences(own, MIN_ROWS, "l", "s").select("l", "s", found("own")), ["l", "s"], "left")
             .join(fences(merged(own, "l"), MIN_ROWS, "l").select("l", found("of_lang")), "l", "left")
             .withColumn("any", F.struct(*[overall.select(n).scalar().alias(n) for n in names])))
    m = _measures()
    inside = F.lit(True)
    for k, (_, both) in MEASURES.items():
        limit = lambda n: F.coalesce(F.col(f"own.{n}"), F.col(f"of_lang.{n}"), F.col(f"any.{n}"))
        inside = inside & (m[k] <= limit(k + "_high"))
        inside = inside & (m[k] >= limit(k + "_low")) if both else inside
    return (keyed.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
            .drop("l", "s", "own", "of_lang", "any"))


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: its id, language, source, counts, base_failed and kept.

    A null text has no words and fails.  Null languages and sources are groups; repeated rows count each;
    an empty table gives an empty result.  A measure on its fence passes.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    return judged(written(measured(rows), "measures"))

"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

A mask marks which of a few consecutive words are hashed; the others are
ignored, so a hit survives a changed word there.  All masks begin with two
hashed words.  Hashes of test items and documents are joined; around each hit
the two texts are aligned, and the stretch of the alignment with most equal words, at least four to
each other one wherever in it the others lie, must be long enough.  Items too short for a
mask must be there word for word.

Before the join, two bit filters of a fixed size drop nearly all positions of
the documents: one holds the items' word pairs, the other their seed hashes.  A third, of the texts
with hits, keeps all other texts out of the later joins.
A filter drops no true hit; where a large benchmark fills it, more rows reach
the join and the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.common import among, bit_filter, free_name, has_bit, written

#: 1: hashed, 0: ignored.
MASKS = ("1101111", "1111011", "1110111", "11011011")
#: With these, found by trying all places of the changed words, every stretch long enough has a hit.
MORE_MASKS = ("111111", "111000111", "110101011")
#: As those, for items of ``SHORTEST`` words only: what a change in their second or last but one word leaves.
SHORT_MASK = "11111"
#: Equal words that make a leak, or this share of a shorter item.
MIN_WORDS, MIN_SHARE = 13, 0.8
#: What an unequal word costs: stretches have four equal words to each at least (``MIN_SHARE``).
PENALTY = 4
#: Bits of the filters of word pairs and of seeds: 32 and 256 KiB.
PAIR_BITS, SEED_BITS = 1 << 18, 1 << 21


#: What parts words: ASCII and Latin-1 signs, general and CJK punctuation.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\xBF\x{2000}-\x{206F}\x{3000}-\x{303F}]+"
#: Words of the shortest items; words of the shortest and the longest seed.
SHORTEST, FEWEST, LONGEST = min(map(len, MASKS)), len(SHORT_MASK), max(map(len, MASKS + MORE_MASKS))


def words(text: Column) -> Column:
    """Lower-case words; null for null."""
    return F.array_remove(F.split(F.lower(text), GAP), "")


def _positions(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep``, at, h0, h1, ...: each position of the word hashes ``h`` with the next ones, null past the end."""
    ahead = [F.col("h")] + [F.slice("h", k + 1, F.size("h")) for k in range(1, LONGEST)]
    zipped = F.arrays_zip(F.transform("h", lambda x, i: i), *ahead)
    return rows.select(*keep, F.inline(zipped).alias("at", *[f"h{k}" for k in range(LONGEST)]))


def _pair() -> Column:
    return F.xxhash64("h0", "h1")


def _seeds(short: Column) -> Column:
    """The seed hashes at a position, a null for each mask that doesn't fit; ``SHORT_MASK`` where ``short``."""
    out = []
    for number, m in enumerate((*MASKS, *MORE_MASKS, SHORT_MASK)):
        used = [f"h{k}" for k, c in enumerate(m) if c == "1"]
        fits = F.col(f"h{len(m) - 1}").isNotNull()
        out.append(F.when(fits & short if m == SHORT_MASK else fits, F.xxhash64(F.lit(number), *used)))
    return F.array(*out)


def worded(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, iw, words): the items with their words, and a digest of the words; items too short left out."""
    return (items.select(F.col(item).alias("item"), words(F.col(text)).alias("iw"))
            .where(F.size("iw") >= SHORTEST).distinct().withColumn("words", F.sha2(F.array_join("iw", " "), 256)))


def seeds(items: DataFrame) -> DataFrame:
    """(words, at, pair, seed): every masked hash of every text of the items (of ``worded``)."""
    rows = (items.select("words", "iw").dropDuplicates(["words"])
            .select("words", F.transform("iw", lambda x: F.xxhash64(x)).alias("h"), (F.size("iw") == SHORTEST).alias("short")))
    return (_positions(rows, "words", "short").where(F.col(f"h{FEWEST - 1}").isNotNull())
            .select("words", "at", _pair().alias("pair"), F.explode(_seeds(F.col("short"))).alias("seed")).where("seed is not null"))


def _key(text: str) -> Column:
    return F.sha2(F.col(text), 256)


def candidates(docs: DataFrame, text: str, found: DataFrame) -> DataFrame:
    """(key, pos, seed): the positions of all texts that pass both filters."""
    pairs, full = bit_filter(found, "pair", PAIR_BITS), bit_filter(found, "seed", SEED_BITS)
    rows = (docs.select(F.col(text).alias("text")).where("text is not null")
            .select(_key("text").alias("key"), F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("h")))
    return (_positions(rows, "key").where(F.col(f"h{FEWEST - 1}").isNotNull() & has_bit(pairs, _pair()))
            .select("key", F.col("at").alias("pos"), F.explode(_seeds(F.lit(True))).alias("seed"))
            .where(F.col("seed").isNotNull() & has_bit(full, F.col("seed"))))


def _scan(values: str, step: str, join: str) -> str:
    """SQL of the running result over an int array: of 64 values at a time, then over what came before them.

    ``step`` reduces the slice ``c``, ``join`` combines the result before, ``s``, with it, ``x``.
    """
    # Each array is bound by a lambda: what a lambda refers to by name may be computed anew for every element.
    parts = "transform(sequence(0, shiftright(size(v) - 1, 6)), j -> slice(v, 64 * j + 1, 64))"
    before = f"""aggregate(transform(parts, c -> {step}), cast(array() as array<int>),
        (a, x) -> array_append(a, if(size(a) = 0, x, transform(array(element_at(a, -1)), s -> {join})[0])))"""
    inside = f"""transform(parts, (p, j) -> transform(sequence(1, size(p)), m -> transform(array(slice(p, 1, m)), c ->
        transform(array({step}), x -> if(j = 0, x, transform(array(get(before, j - 1)), s -> {join})[0]))[0])[0]))"""
    return (f"transform(array({values}), v -> transform(array({parts}), parts -> "
            f"transform(array({before}), before -> flatten({inside}))[0])[0])[0]")


def leaks(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """(key, item_id, item_words, first_word, overlap, matched): each distinct text that holds a test item.

    ``key`` is the SHA-256 of the text, so equal texts share their rows and
    ids may be null or repeated.  Of several places the one with most equal words counts,
    then the first.  Null and empty texts and empty tables have no rows; repeated items count once.  An item of fewer
    than seven words must be there word for word; one without words is nowhere.  Texts of any length are read whole.
    """
    tests = written(worded(items, item, item_text), "items")
    found = written(seeds(tests), "seeds")
    hits = written(candidates(docs, text, found).distinct().join(found.select("words", "at", "seed"), "seed")
                   .select("key", "words", (F.col("pos") - F.col("at")).alias("shift")).distinct(), "leak-hits")
    texts = (docs.select(_key(text).alias("key"), F.col(text).alias("t"))
             .where(F.col("key").isNotNull() & among(hits, F.col("key"))).join(hits.select("key").distinct(), "key", "left_semi")
             .groupBy("key").agg(words(F.first("t")).alias("w")))
    enough = F.least(F.lit(MIN_WORDS), F.ceil(F.size("iw") * F.lit(MIN_SHARE)))
    equal = """transform(sequence(0, size(iw) - 1), k -> coalesce(get(iw, k) = if(k + shift >= 0, get(w, k + shift), null), false))"""
    aligned = (hits.join(texts, "key").join(tests, "words").withColumn("eq", F.expr(equal)).withColumn("enough", enough.cast("int"))
               .where("size(filter(eq, x -> x)) >= enough")
               .select("key", "item", F.size("iw").alias("item_words"), "shift", "enough", "eq"))
    aligned = written(aligned, "alignments")  # few rows, and a short plan for what follows
    # Of all stretches with no points lost: for each end, from the first place whose sum of points is no higher.  The running
    # least sum falls, so that place is found by halving.
    aligned = (aligned.withColumn("steps", F.expr(f"concat(array(0), transform(eq, x -> if(x, 1, -{PENALTY})))"))
               .withColumn("points", F.expr(_scan("steps", "aggregate(c, 0, (a, y) -> a + y)", "s + x")))
               .withColumn("least", F.expr(_scan("points", "array_min(c)", "least(s, x)"))))
    halving = """aggregate(rounds, named_struct('low', 0, 'high', k), (r, _) ->
        if(r.low = r.high, r, if(get(lowest, shiftright(r.low + r.high, 1)) <= p,
            named_struct('low', r.low, 'high', shiftright(r.low + r.high, 1)), named_struct('low', shiftright(r.low + r.high, 1) + 1, 'high', r.high))))"""
    # (equal words, -start, -end): the most equal words, then the first start and end.
    longest = f"""transform(array(points), sums -> transform(array(least), lowest -> transform(
        array(sequence(0, int(log2(size(sums))) + 1)), rounds -> array_max(transform(sums, (p, k) -> transform(array({halving}.low), i -> struct(
            (p - get(sums, i) + {PENALTY} * (k - i)) div {PENALTY + 1} as equal, -i as i, -k as k))[0])))[0])[0])[0]"""
    aligned = aligned.withColumn("longest", F.expr(longest))
    # Without the unequal words before the first equal one.
    trimmed = "-longest.i + array_position(slice(eq, 1 - longest.i, size(eq)), true) - 1"
    place = [F.expr(x).cast("int").alias(name) for name, x in (
        ("from", trimmed), ("to", "-longest.k - 1"), ("matched", "longest.equal"))]
    long = (aligned.select("key", "item", "item_words", "shift", "enough", *place).where("matched >= enough")
            .select("key", F.col("item").alias("item_id"), "item_words",
                    (F.col("from") + F.col("shift")).alias("first_word"),
                    (F.col("to") - F.col("from") + 1).alias("overlap"), "matched"))
    return (long.unionByName(short_items(docs, items, text, item, item_text)).groupBy("key", "item_id")
            .agg(F.max_by(F.struct("item_words", "first_word", "overlap", "matched"),
                          F.struct("matched", -F.col("first_word"), "item_words")).alias("m"))
            .select("key", "item_id", "m.*"))


def short_items(docs: DataFrame, items: DataFrame, text: str, item: str, item_text: str) -> DataFrame:
    """(key, item_id, item_words, first_word, overlap, matched): the first place of each item too short for a seed, word for word.

    A text sends one row per item at most, whatever the places.
    """
    short = (items.select(F.col(item).alias("item_id"), words(F.col(item_text)).alias("iw"))
             .where((F.size("iw") > 0) & (F.size("iw") < SHORTEST)).distinct()
             .select("item_id", F.size("iw").alias("item_words"), F.array_join("iw", " ").alias("run")))
    sizes = sorted(r[0] for r in short.select("item_words").distinct().collect())  # six at most
    columns = "key string, item_id {}, item_words int, first_word int, overlap int, matched int".format(items.schema[item].dataType.simpleString())
    if not sizes:
        return docs.sparkSession.createDataFrame([], columns)
    bits = bit_filter(short.select(F.xxhash64("run").alias("h")), "h", SEED_BITS)
    texts = docs.select(_key(text).alias("key"), words(F.col(text)).alias("w")).where("size(w) > 0").withColumn("n", F.explode(F.array(*map(F.lit, sizes))))
    runs = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("n")), lambda i: F.array_join(F.slice("w", i + 1, F.col("n")), " "))
    there = (texts.where("size(w) >= n").select("key", F.posexplode(runs).alias("first_word", "run"))
             .where(has_bit(bits, F.xxhash64("run"))).groupBy("key", "run").agg(F.min("first_word").alias("first_word")))
    return there.join(short, "run").select("key", "item_id", "item_words", "first_word", F.col("item_words").alias("overlap"),
                                           F.col("item_words").alias("matched"))


def leaky_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                    item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``leaks`` with the ids of all documents of that text; repeated ids once."""
    found = written(leaks(docs, items, text, item, item_text), "leaks")
    return (docs.select(F.col(key).alias("doc_id"), _key(text).alias("key")).where(among(found, F.col("key")))
            .join(found, "key").drop("key").distinct())


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a test item; null texts stay."""
    name = free_name(docs, "text_key")
    found = written(leaks(docs, items, text, item, item_text), "leaks")
    keyed = docs.withColumn(name, _key(text))
    suspect = among(found, F.col(name))
    cleared = keyed.where(suspect).join(found.select(F.col("key").alias(name)).distinct(), name, "left_anti")
    return keyed.where(~suspect).unionByName(cleared).select(*docs.columns)

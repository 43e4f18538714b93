"""Importance resampling towards a target distribution, ranked by a distributed radix sort.

Words hash to buckets, whose counts in the corpus and in the target give
each bucket a gain; the array of gains scores every text.  With Gumbel noise
drawn from the id, the texts of highest score are a sample without
replacement.

The ranks come from an LSD radix sort of the composite key (score
falling, id rising).  Rows lie in parts of equal size by their present
place.  A pass counts the digits of each part, prefix sums over all parts
give every (part, digit) its first destination, and each part places its rows
stably from there.  Parts are cut by place, so a digit of any frequency
spreads over as many parts as its rows fill.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import in_blocks, written

BUCKETS = 10_000
#: Features are runs of up to so many words.
RUNS = 1
SEED = 2024
#: Words a text needs to be drawn, and the percent of such texts that are.
MIN_WORDS, PERCENT = 20, 10

#: Bits of a digit at most, and rows of a part (as bits): few enough for a task, enough to be worth one.
DIGIT_BITS, PART_BITS = 12, (10, 17)
#: Parts are no larger than gives so many of them, where that is allowed.
PARTS = 512

#: Distinct words whose bucket a task remembers.
REMEMBERED = 200_000
#: Bytes of texts in one block.
BLOCK = 1 << 22
#: A-Z to lower case, what isn't a letter, digit or beyond ASCII to a blank.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLDED).split()


class Buckets(dict):
    """feature -> its bucket."""

    def __init__(self, buckets: int, runs: int):
        super().__init__()
        self.buckets, self.runs = buckets, runs

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[feature] = b = zlib.crc32(feature) % self.buckets
        return b

    def of(self, words: list[bytes]) -> np.ndarray:
        """The buckets of all runs of the words."""
        out = [np.fromiter(map(self.__getitem__, words), np.int64, len(words))]
        for n in range(2, min(self.runs, len(words)) + 1):
            runs = map(b" ".join, zip(*(words[k:] for k in range(n)), strict=False))
            out.append(np.fromiter((zlib.crc32(r) % self.buckets for r in runs), np.int64, len(words) - n + 1))
        return np.concatenate(out)


def bucket_counts(texts: DataFrame, text: str, buckets: int = BUCKETS, runs: int = RUNS) -> np.ndarray:
    """How many features of all texts fall in each bucket; each task sends ``buckets`` rows at most."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of, total = Buckets(buckets, runs), np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch["text"]:
                total += np.bincount(of.of(words_of(t)), minlength=buckets)
        there = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": there, "n": total[there]})

    out = np.zeros(buckets, np.int64)
    found = texts.select(F.col(text).alias("text")).where("text is not null").mapInPandas(run, "bucket long, n long")
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():  # ``buckets`` rows at most
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of each bucket's share in the target over its share in the corpus, one added to each; floored."""
    b, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


WEIGHED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()),
                        T.StructField("weight", T.LongType())])


def _weighed(gain: np.ndarray, runs: int):
    @F.pandas_udf(WEIGHED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = Buckets(len(gain), runs)
        for batch in batches:
            texts = batch.where(batch.notna(), None).tolist()
            for part in in_blocks([len(t or "") + 1 for t in texts], BLOCK):
                rows = []
                for t in texts[part]:
                    words = words_of(t)
                    found = of.of(words)
                    rows.append((len(words), len(found), int(gain[found].sum()) // len(found) if len(found) else 0))
                yield pd.DataFrame(rows, columns=WEIGHED.names)
    return run


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of ``seed:key``."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def unsigned(column: str, low: int, high: int, falling: bool = False) -> tuple[Column, int]:
    """A long whose unsigned order is the column's, and how many of its low bits vary, for values from ``low`` to ``high``."""
    if high - low < 1 << 63:
        return (F.lit(high) - F.col(column) if falling else F.col(column) - F.lit(low)), (high - low).bit_length()
    flipped = F.col(column).bitwiseXOR(F.expr("shiftleft(1L, 63)"))
    return (F.bitwise_not(flipped) if falling else flipped), 64


def digits(keys: list[tuple[str, int]], most: int | None = None) -> list[tuple[str, int, int]]:
    """(column, shift, bits) of the digits of a composite key (columns and their varying bits, the first decides first), the last digit first."""
    out = []
    for column, bits in reversed(keys):
        parts = -(-bits // (most or DIGIT_BITS))
        edges = [bits * k // parts for k in range(parts + 1)] if parts else [0]
        out += [(column, a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return out


def part_bits(n: int) -> int:
    """Rows of a part, as bits: parts of a bounded size, and many of them before that."""
    return min(max((max(n, 1) // PARTS).bit_length(), PART_BITS[0]), PART_BITS[1])


def _placed(column: str, shift: int, bits: int, part: int):
    """The counting sort of one part, from the destinations of its digits."""
    def run(rows: pd.DataFrame, offsets: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return rows
        rows = rows.iloc[np.argsort(rows["place"].to_numpy(), kind="stable")]
        digit = (rows[column].to_numpy(np.int64).view(np.uint64) >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.uint16)
        first = np.zeros(1 << bits, np.int64)
        first[offsets["digit"].to_numpy(np.int64)] = offsets["first"].to_numpy(np.int64)
        counts = np.bincount(digit, minlength=1 << bits)
        order = np.argsort(digit, kind="stable")
        before = np.cumsum(counts) - counts
        place = np.empty(len(digit), np.int64)
        place[order] = first[digit[order]] + np.arange(len(digit)) - before[digit[order]]
        return rows.assign(place=place, part=place >> part)
    return run


def radix_pass(state: DataFrame, column: str, shift: int, bits: int, part: int) -> DataFrame:
    """``state`` (part, place, ...) with the places of a stable sort by one digit of ``column``."""
    digit = F.shiftrightunsigned(F.col(column), shift).bitwiseAND(F.lit((1 << bits) - 1))
    counts = written(state.groupBy("part", digit.alias("digit")).agg(F.count("*").alias("n")), "radix-counts")
    starts, at = [], 0
    for d, n in sorted(counts.groupBy("digit").agg(F.sum("n")).collect()):  # a row per digit: 2**DIGIT_BITS at most
        starts.append((d, at))
        at += n
    smaller = state.sparkSession.createDataFrame(starts, "digit long, start long")
    earlier = Window.partitionBy("digit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(F.broadcast(smaller), "digit")
               .select("part", "digit", (F.col("start") + F.col("before")).alias("first")))
    schema = T.StructType(state.schema.fields)
    return written(state.groupBy("part").cogroup(offsets.groupBy("part")).applyInPandas(_placed(column, shift, bits, part), schema),
                   "radix-rows")


def radix_ranked(rows: DataFrame, keys: list[tuple[str, bool]]) -> tuple[DataFrame, int]:
    """(row, rank from 1) of ``rows``, and their number; rows with equal keys rank in the order of ``row``.

    ``row`` is a distinct, not negative long; ``keys`` are long columns, the first deciding first, each with whether it falls.
    Nulls come last in either order.
    """
    ends = rows.agg(F.count("*").alias("n"), *[f(c).alias(f"{name}_{c}") for c, _ in keys for name, f in
                                               (("low", F.min), ("high", F.max), ("nulls", lambda x: F.count_if(F.col(x).isNull())))]).first()
    coded, named = [], []
    for k, (c, falling) in enumerate(keys):
        low, high = (ends[f"low_{c}"], ends[f"high_{c}"]) if ends[f"low_{c}"] is not None else (0, 0)
        if ends[f"nulls_{c}"]:
            coded.append(F.col(c).isNull().cast("long").alias(f"none{k}"))
            named.append((f"none{k}", 1))
        value, bits = unsigned(c, low, high, falling)
        coded.append(F.coalesce(value, F.lit(0)).cast("long").alias(f"key{k}"))
        named.append((f"key{k}", bits))
    part, size = part_bits(ends["n"]), F.col("row")
    # At first a row's place is its number; parts are runs of numbers.
    state = written(rows.select("row", F.shiftright(size, part).alias("part"), size.alias("place"), *coded), "radix-rows")
    passes = digits(named) or [(named[-1][0], 0, 1)]  # all keys equal: one pass makes places of row numbers
    for column, shift, bits in passes:
        state = radix_pass(state, column, shift, bits, part)
    return state.select("row", (F.col("place") + 1).alias("rank")), ends["n"]


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
              runs: int = RUNS, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS,
              percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), a row per row of ``docs``; rank is null where it isn't drawn.

    The key is an integer.  A null text has no words, so no feature and weight 0, and isn't drawn.  Texts of any length are
    scored whole.  Ties go to the smaller key, null keys last (their noise is that of an empty key); repeated rows are ranked one
    after the other.  An empty target leaves its counts at 0; empty documents give no row.  Only ``key`` and ``text`` are read.
    """
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} must be an integer")
    gain = gains(bucket_counts(docs, text, buckets, runs), bucket_counts(target, target_text, buckets, runs))
    scored = written(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"),
                    _weighed(gain, runs)(F.col(text)).alias("w"))
        .select("row", "doc_id", "w.*").withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "weights")
    able = scored.where(F.col("n_words") >= min_words).select("row", "score", F.col("doc_id").cast("long").alias("id"))
    ranked, n = radix_ranked(able, [("score", True), ("id", False)])
    drawn = ranked.where(F.col("rank") <= percent * n // 100)
    return scored.join(drawn, "row", "left").drop("row")

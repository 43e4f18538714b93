"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.session import scratch_path

#: Java form of a word separator; words are ``[^\x20\x09-\x0D]+``.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: what follows reads files that survive a lost executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of texts that Spark sends to Python at a time, and its own bound; a session with another value keeps it.
BATCH_BYTES, SPARKS_BATCH = 2 << 20, 64 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the session, where it has Spark's own bound: a task holds each several times over."""
    if spark.conf.get(_BATCH_CONF) in (f"{SPARKS_BATCH}b", str(SPARKS_BATCH)):
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def give_back() -> None:
    """Returns what a task has freed to the machine, and the powers of hashes, as its Python worker lives on."""
    _POWERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def remainder(key: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % mod


def free_name(df: DataFrame, wanted: str, *more: str) -> str:
    """``wanted``, with underscores added until no column (in any case) has it."""
    taken = {c.lower() for c in df.columns} | {m.lower() for m in more}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def sample_ids(df: DataFrame, by: str, key: str, k: int) -> DataFrame:
    """At most ``k`` rows (``by``, ``key``) per value of ``by``, lowest hash first.

    The rank filter is applied before the shuffle too, so that each task
    sends ``k`` rows per value at most.
    """
    from pyspark.sql import Window
    order = Window.partitionBy(by).orderBy(F.xxhash64(F.col(key)), F.col(key))
    return (df.select(by, key).where(F.col(by).isNotNull() & F.col(key).isNotNull())
            .withColumn("_rank", F.row_number().over(order))
            .where(F.col("_rank") <= k).drop("_rank"))


#: Bits of one of Spark's bitmaps.
_BITMAP = 1 << 15


def bit_filter(hashes: DataFrame, name: str, n: int) -> Column:
    """A bit for each of ``n`` hash values, set where a hash has it: a fixed size whatever the input.

    ``n`` is a multiple of 8.  Made by Spark and read from the scratch folder, by a query that uses it: the bits are in
    no plan and not in the driver's Python.
    """
    at = F.pmod(F.col(name), F.lit(n)) + 1  # Spark's buckets of positive numbers begin at 1
    maps = (hashes.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("number"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map")))
    known = maps.agg(F.map_from_entries(F.collect_list(F.struct("number", "map"))).alias("known"))  # n / 32768 entries, rounded up, at most
    none = F.lit(bytes(_BITMAP // 8))
    whole = F.aggregate(F.sequence(F.lit(1).cast("long"), F.lit(-(-n // _BITMAP)).cast("long")), F.lit(b""),
                        lambda all_, i: F.concat(all_, F.coalesce(F.col("known")[i], none)))
    bits = F.substring(whole, 1, n // 8)
    return written(known.select(bits.alias("bits")), "bits").scalar()


def has_bit(bits: Column, h: Column) -> Column:
    """Whether the bit of ``h`` is set in a ``bit_filter``: true for all its hashes, and for few others while it is sparse."""
    bit = F.pmod(h, 8 * F.length(bits).cast("long"))
    byte = F.ascii(F.decode(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
    return F.getbit(byte, (bit % 8).cast("int")) == 1


#: Bits of a filter of texts; 256 KiB.
TEXT_BITS = 1 << 21


def among(keys: DataFrame, key: Column, name: str = "key") -> Column:
    """Whether ``key`` may be one of ``keys``; true for all that are, never null.

    What it holds back needn't be shuffled to a join with ``keys``.
    """
    bits = bit_filter(keys.select(F.xxhash64(name).alias("h")), "h", TEXT_BITS)
    return F.coalesce(has_bit(bits, F.xxhash64(key)), F.lit(False))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\x20\x09-\x0D]+`` as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


#: Bytes of texts in one vectorised block.
BLOCK_BYTES = 1 << 20
_GAPS = np.zeros(256, bool)
_GAPS[[0x20, *range(0x09, 0x0E)]] = True
#: A random number per byte value, and an odd multiplier, for each 64 bits of a word's hash.
_BYTES = np.random.default_rng(20_240_229).integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, np.ndarray] = {}


def powers(factor: int, n: int) -> np.ndarray:
    """factor**i modulo 2**64, for i from 0, ``n`` of them at least."""
    known = _POWERS.get(factor)
    if known is None or len(known) < n:
        p = np.full(max(n, BLOCK_BYTES + 4096), factor, np.uint64)
        p[0] = 1
        known = _POWERS[factor] = np.cumprod(p, dtype=np.uint64)
    return known


def rolling(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int) -> np.ndarray:
    """Sum of values[i] * m**-(i - start) over each range: a hash of the values in order, from one running sum."""
    m = _MULTIPLIERS[kind]
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(pow(m, -1, 1 << 64), len(values))[:len(values)], dtype=np.uint64, out=total[1:])
    return (total[ends] - total[starts]) * powers(m, len(values) + 1)[starts]


def hashed_words(texts: list[str | None], kinds: int = 1) -> tuple[np.ndarray, list[np.ndarray]]:
    """Number of words of each text, and ``kinds`` independent 64-bit hashes of all words in order.

    Words are as in ``words_of``; all bytes of a block are hashed at once.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    buffer = np.frombuffer(b" ".join([*raw, b""]), np.uint8)
    gap = _GAPS[buffer]
    word = ~gap
    starts = np.flatnonzero(word & np.concatenate([[True], gap[:-1]]))
    ends = np.flatnonzero(word & np.concatenate([gap[1:], [True]])) + 1
    begins = np.cumsum([0] + [len(r) + 1 for r in raw])
    sizes = np.diff(np.searchsorted(starts, begins))
    length = (ends - starts).astype(np.uint64)
    return sizes, [mixed(rolling(_BYTES[k][buffer], starts, ends, k) + length * np.uint64(0xD6E8FEB86659FD93)) for k in range(kinds)]


def text_blocks(texts: list[str | None]) -> Iterator[slice]:
    """Slices of texts of about ``BLOCK_BYTES`` together."""
    return in_blocks([len(t or "") + 1 for t in texts], BLOCK_BYTES)


def in_blocks(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to about ``most`` (one item at least)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))

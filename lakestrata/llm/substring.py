"""Exact substring deduplication behind a count-min prefilter.

A window is 50 consecutive words.  First pass: every task counts its windows
in a count-min sketch, sent as the cells it touched; the merged sketch never
underestimates, so a window whose estimate is 1 occurs once and needs no
further look.  Second pass: only the other windows are grouped, by 128-bit
fingerprints, for the smallest document id of each.  Every window has one
document where it stays, so what goes back to the documents is that one row
per window, never the group.  Third pass: a document drops the words of
all its repeated windows but those that stay with it.

The sketch has a fixed size.  On a corpus too large for it the estimates grow and
more windows are grouped; none is lost, and the result is the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import bounded_batches, free_name, give_back, hashed_words, mixed, rolling, text_blocks, words_of, written

SPAN = 50
#: Cells per row of the sketch; two rows of one bit a cell (repeated or not) are 128 MiB.
WIDTH, DEPTH = 1 << 29, 2
CELLS = 1 << 16  # per block of a row
#: Windows that a task counts before it sends their cells, 8 bytes each.
COUNTED = 1 << 21


def fingerprints(texts: list[str | None], span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, high, low) of every window of the texts, in order."""
    sizes, hashes = hashed_words(texts, 2)
    n_windows = np.maximum(sizes - span + 1, 0)
    owner = np.repeat(np.arange(len(texts)), n_windows)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    at = np.repeat(np.cumsum(sizes) - sizes, n_windows) + start
    high, low = (mixed(rolling(h, at, at + span, k)) for k, h in enumerate(hashes))
    return owner, start, high, low


def cells(high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
    """The cell of each window in each row of the sketch."""
    return [(h % np.uint64(WIDTH)).astype(np.uint32) for h in (high, low)]


def _sketch(parts: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
    """Per row and block of the sketch, the cells counted once and those counted more often."""
    rows = []
    for r, cs in enumerate(zip(*parts, strict=True)):
        c = np.concatenate(cs)
        c.sort()
        new = np.concatenate([[True], c[1:] != c[:-1]])
        again = np.zeros(len(c), bool)
        again[:-1] = ~new[1:]
        distinct, more = c[new], again[new]
        block = distinct // CELLS
        cuts = np.nonzero(np.diff(block, prepend=-1))[0]
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(block)], strict=True):
            part, m = (distinct[a:b] % CELLS).astype("<u2"), more[a:b]
            rows.append((r, int(block[a]), part[~m].tobytes(), part[m].tobytes()))
    return pd.DataFrame(rows, columns=["row", "block", "once", "more"])


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sketches of ``COUNTED`` windows each, so that a block's cells go in few rows."""
    held, n = [], 0
    for batch in batches:
        texts = batch["text"].tolist()
        for part in text_blocks(texts):
            _, _, high, low = fingerprints(texts[part])
            if len(high):
                held.append(cells(high, low))
                n += len(high)
            if n >= COUNTED:
                yield _sketch(held)
                held, n = [], 0
    if held:
        yield _sketch(held)
    batch = texts = high = low = held = None
    give_back()


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of sketches ordered by row and block: the cells with a count above one, as packed bits."""
    key, ones, twos = None, None, None

    def bits() -> bytes:
        return zlib.compress(np.packbits(twos, bitorder="little").tobytes(), 1)

    for batch in batches:
        out = []
        for row, block, once, more in batch.itertuples(index=False):
            if key != (row, block):
                if key is not None and twos.any():
                    out.append((*key, bits()))
                key, ones, twos = (row, block), np.zeros(CELLS, bool), np.zeros(CELLS, bool)
            o = np.frombuffer(once, "<u2")
            twos[o[ones[o]]] = True
            ones[o] = True
            m = np.frombuffer(more, "<u2")
            twos[m] = ones[m] = True
        yield pd.DataFrame(out, columns=["row", "block", "bits"])
    if key is not None and twos.any():
        yield pd.DataFrame([(*key, bits())], columns=["row", "block", "bits"])
    give_back()


def merged_sketch(texts: DataFrame) -> list[tuple[int, int, bytes]]:
    """(row, block, packed bits 'estimated more than once') where a bit is set; ``DEPTH`` times ``WIDTH`` bits at most."""
    parts = texts.mapInPandas(_counted, "row int, block int, once binary, more binary")
    merged = (parts.repartition("row", "block").sortWithinPartitions("row", "block")
              .mapInPandas(_merged, "row int, block int, bits binary"))
    return [(r.row, r.block, bytes(r.bits)) for r in written(merged, "sketch").toLocalIterator()]


def estimated_repeated(planes: list[np.ndarray], high: np.ndarray, low: np.ndarray) -> np.ndarray:
    out = np.ones(len(high), bool)
    for plane, c in zip(planes, cells(high, low), strict=True):
        out &= (plane[c >> np.uint32(3)] >> (c & np.uint32(7)).astype(np.uint8) & 1).astype(bool)
    return out


def _planes(shared) -> list[np.ndarray]:
    """The sketch's rows as bits."""
    planes = [np.zeros(WIDTH // 8, np.uint8) for _ in range(DEPTH)]
    for row, block, bits in shared.value:
        planes[row][block * CELLS // 8:(block + 1) * CELLS // 8] = np.frombuffer(zlib.decompress(bits), np.uint8)
    return planes


def _repeated(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes = _planes(shared)
        for batch in batches:
            ids, texts = batch["id"].to_numpy(), batch["text"].tolist()
            for part in text_blocks(texts):
                owner, _, high, low = fingerprints(texts[part])
                at = np.nonzero(estimated_repeated(planes, high, low))[0]
                high, low, doc = high[at], low[at], ids[part][owner[at]]
                order = np.lexsort((doc, low, high))
                high, low, doc = high[order], low[order], doc[order]
                first = np.ones(len(high), bool)
                first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
                yield pd.DataFrame({"high": high[first].view(np.int64), "low": low[first].view(np.int64), "id": doc[first]})
        planes = batch = ids = texts = owner = high = low = at = doc = order = first = None
        give_back()
    return run


KEPT = T.StructType([
    T.StructField("kept_text", T.StringType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
])


def _cut(shared):
    @F.pandas_udf(KEPT)
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        planes = _planes(shared)
        for texts, ids, staying in batches:
            texts, rows = texts.where(texts.notna(), None).tolist(), []
            has_id, staying = ids.notna().tolist(), staying.tolist()
            for part in text_blocks(texts):
                owner, start, high, low = fingerprints(texts[part])
                repeated = estimated_repeated(planes, high, low)
                bounds = np.searchsorted(owner, np.arange(part.stop - part.start + 1))
                for i, ws in enumerate(map(words_of, texts[part])):
                    mine = slice(bounds[i], bounds[i + 1])
                    goes = repeated[mine]
                    if not has_id[part.start + i] or not goes.any():
                        rows.append((b" ".join(ws).decode(), len(ws), 0))
                        continue
                    keep = staying[part.start + i]
                    if keep is not None:
                        goes = goes & ~np.isin(high[mine].view(np.int64), np.asarray(keep, np.int64))
                    edge = np.zeros(len(ws) + 1, np.int64)
                    at = start[mine][goes]
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + SPAN, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    rows.append((b" ".join(w for w, g in zip(ws, gone.tolist(), strict=True) if not g).decode(),
                                 len(ws), int(gone.sum())))
            yield pd.DataFrame(rows, columns=KEPT.names)
        planes = texts = rows = owner = start = high = low = repeated = None
        give_back()
    return run


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "unrepeated") -> DataFrame:
    """``docs`` with a struct column ``out``: kept_text (kept words, one space between), n_words, n_removed.

    A word goes if a window over it has a word sequence that also starts in a document of smaller id.
    The ids are numbers.  One row per input row, all columns kept; a column named ``out`` is replaced.  A null text has no words.
    Rows with a null id lose nothing and take nothing from others; rows of equal id don't take from each other.
    Repeats within one document stay.  Texts of fewer than 50 words have no window.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    # At most DEPTH * WIDTH / 8 bytes, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(merged_sketch(rows.select("text")))
    first = (rows.mapInPandas(_repeated(shared), "high long, low long, id long")
             .groupBy("high", "low").agg(F.min("id").alias("id")))
    k, s = free_name(docs, "staying_id"), free_name(docs, "staying")
    staying = first.groupBy(F.col("id").alias(k)).agg(F.collect_list("high").alias(s))
    joined = docs.join(staying, F.col(key).cast("long") == F.col(k), "left")
    return joined.withColumn(out, _cut(shared)(F.col(text), F.col(key).cast("long"), F.col(s))).drop(k, s)

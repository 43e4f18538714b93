"""Best-fit packing into token sequences by a grouping genetic algorithm.

Documents are tokenised, only those longer than a sequence are cut, and a
piece that fills a sequence has one to itself.  The other pieces are dealt by
hash into blocks of a bounded number, and every block is solved by islands that evolve
populations of groupings: a crossover injects whole, well-filled bins of one
parent into the other, drops the other's bins that hold a duplicate, and puts what they
held besides back by best fit, the longest first.  After each epoch the best
grouping of an island migrates to the next one.  An island rests once its
block meets the lower bound of bin packing.

The bins that stay loose in all blocks are dealt anew, bin by bin, and solved
again with their old grouping in the first population, so a level never
needs more sequences than the one before.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from codecs import utf_16_le_decode
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.bpe import byte_characters
from lakestrata.llm.common import in_blocks, written

CAPACITY = 2048
#: The id that ends each document.
END = 0
#: Pieces of a block, on average.
BLOCK = 4096
ISLANDS, POPULATION = 3, 4
#: Epochs at most, and offspring of an island in one.
EPOCHS, OFFSPRING = 3, 80
#: Share of a parent's bins that a crossover injects, and of bins that a mutation takes apart.
INJECTED, MUTATED = 0.08, 0.02
#: A bin with more free room than this share of a sequence is loose.
LOOSE = 1 / 128
SEED = 5

#: Bytes of ids remembered per worker, and of the words they belong to.
CACHE_BYTES = 160 << 20
#: Words longer than this are encoded each time.
CACHED_WORD = 64
#: Characters of texts tokenised before their pieces are sent on.
TEXT_BLOCK = 1 << 21

PIECE = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                      T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                      T.StructField("ids", T.BinaryType())])


def read_tokenizer(spark: SparkSession, path: str) -> str:
    """The JSON of a tokenizer file; its size is the vocabulary's."""
    with open(path, encoding="utf-8") as f:
        return f.read()


#: The parts of a tokenizer file that drops white space, so that its words can be encoded apart.
LOWER_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
#: White space, letters in lower case and numbers among the characters below U+0180, which normalisation leaves as they are.
_SPACES, _LETTERS, _NUMBERS = "\t-\r \x85\xa0", "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
NOT_LOW = re.compile("[^\x00-\u017f]")
#: The kind of each character that lower-casing a text of them may give (U+0307 comes from a capital I with a dot), else ``OTHER``.
SPACE, LETTER, NUMBER, OTHER = range(4)
_KINDS = np.full(0x308, OTHER, np.uint8)
for _chars, _kind in ((_SPACES, SPACE), (_LETTERS, LETTER), (_NUMBERS, NUMBER)):
    _KINDS[[c for c in range(0x180) if re.match(f"[{_chars}]", chr(c))]] = _kind


def low_words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a lower-case text of characters in ``_KINDS``: their codes side by side, where they begin in the text, and their lengths.

    A word is a run of letters, a number, a contraction's end (``'s``, ``'re``) where no other sign stands before it, or a run of other signs.
    """
    codes = np.frombuffer(text.encode("utf-16-le"), "<u2")
    kind = _KINDS[codes]
    first = np.ones(len(codes), bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    for i in np.flatnonzero(first & (codes == ord("'"))).tolist():
        n = 1 if text[i + 1:i + 2] in ("s", "t", "m", "d") else 2 if text[i + 1:i + 3] in ("re", "ve", "ll") else 0
        if n:
            first[i + 1] = False
            if i + 1 + n < len(codes):
                first[i + 1 + n] = True
    starts = np.flatnonzero(first)
    sizes = np.diff(starts, append=len(codes))
    word = kind[starts] != SPACE
    return codes[kind != SPACE], starts[word], sizes[word]


class Words(dict):
    """A word's ids, as little-endian 32-bit numbers; ``encode`` gives them on a miss.

    Holds ``CACHE_BYTES`` at most, and long words not at all.  The words of the latest half are in itself, those of the half before in
    ``older``, from where they come back when they are met again.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode, self.held, self.older = encode, 0, {}

    def __missing__(self, word) -> bytes:
        coded = self.older.get(word)
        if coded is None:
            ids = self.encode(word)
            coded = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= CACHED_WORD:
            self.held += len(word) + len(coded) + 200  # with what the objects take themselves
            if self.held > CACHE_BYTES // 2:
                self.older = dict(self)
                self.clear()
                self.held = 0
            self[word] = coded
        return coded


def splits_words(tokenizer_json: str) -> bool:
    """Whether the file's parts are ``LOWER_WORDS``."""
    parts = json.loads(tokenizer_json)
    return all(parts[k] == v for k, v in LOWER_WORDS.items())


def encoder(tokenizer_json: str, by_word: bool):
    """text -> its ids as little-endian 32-bit numbers, as ``batch_encoder`` gives them."""
    encode = batch_encoder(tokenizer_json, by_word)
    return lambda text: encode([text])[0]


@lru_cache(1)  # a worker's tasks share the words
def batch_encoder(tokenizer_json: str, by_word: bool):
    """Texts -> the ids of each as little-endian 32-bit numbers.

    With ``by_word`` (for ``splits_words``) each distinct word is encoded once: words end at white space, and texts of
    characters below U+0180 are split further as the file says, all at once, and each distinct word of them is looked up once.
    Otherwise each text is encoded as a whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.encode_special_tokens = True
    whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    if not by_word:
        return lambda texts: [np.array(whole(t), "<u4").tobytes() for t in texts]
    model, char = tokenizer.model, byte_characters()

    def low_ids(word: bytes) -> list[int]:
        w = utf_16_le_decode(word)[0]
        return [t.id for t in model.tokenize(w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(char))]

    low = Words(low_ids)
    other = Words(lambda w: whole(w.decode("utf-8", "replace")))

    def encode_low(texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        lowered = [t.lower() + "\n" for t in texts]
        codes, starts, sizes = low_words("".join(lowered))
        # A column of binary values, whose distinct ones Arrow finds.
        offsets = np.append(0, np.cumsum(2 * sizes))
        column = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(codes)])
        distinct = column.dictionary_encode()
        coded = list(map(low.__getitem__, distinct.dictionary.to_numpy(zero_copy_only=False).tolist()))
        at = distinct.indices.to_numpy()
        long = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        ids, begin = np.frombuffer(b"".join(coded), "<u4"), np.cumsum(long) - long
        n = long[at]
        before = np.cumsum(n) - n
        out = ids[np.repeat(begin[at] - before, n) + np.arange(int(n.sum()))].tobytes()
        # The texts' bounds, in characters, then in words, then in bytes of ids.
        lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
        bounds = 4 * np.append(before, n.sum())[np.searchsorted(starts, np.append(0, np.cumsum(lengths)))]
        return [out[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]

    def encode(texts: list[str]) -> list[bytes]:
        high = [not t.isascii() and NOT_LOW.search(t) is not None for t in texts]
        lows = iter(encode_low([t for t, h in zip(texts, high, strict=True) if not h]))
        return [b"".join(map(other.__getitem__, t.encode("utf-8", "replace").split())) if h else next(lows)
                for t, h in zip(texts, high, strict=True)]
    return encode


def pieces_of(ids: bytes, capacity: int, keep_ids: bool) -> list[tuple]:
    """(piece, start, length, crc32, ids) of a document's ids, its end included."""
    step = 4 * capacity
    return [(k, a // 4, len(ids[a:a + step]) // 4, zlib.crc32(ids[a:a + step]), ids[a:a + step] if keep_ids else None)
            for k, a in enumerate(range(0, len(ids), step))]


def pieces(docs: DataFrame, tokenizer_json: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           keep_ids: bool = True) -> DataFrame:
    """(piece_key, doc_id, piece, start, length, ids_crc32, ids), written: the pieces of every row of ``docs``.

    Special tokens' strings are ordinary text.  A null text is empty and has the end id only.  Repeated rows have pieces each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # the vocabulary: a fixed size
    by_word, end = splits_words(tokenizer_json), struct.pack("<I", END)

    @F.pandas_udf(T.ArrayType(PIECE))
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = batch_encoder(shared.value, by_word)
        for batch in batches:
            texts = batch.tolist()
            for part in in_blocks([len(t) + 1 for t in texts], TEXT_BLOCK):
                yield pd.Series([pieces_of(ids + end, capacity, keep_ids) for ids in encode(texts[part])])

    cuts = docs.select(F.col(key).alias("doc_id"), cut(F.coalesce(F.col(text), F.lit(""))).alias("cuts"))
    # Outer, as no list is empty: otherwise Spark would run the tokenizer once more to leave out the empty ones.
    rows = cuts.select("doc_id", F.inline_outer("cuts")).withColumn("piece_key", F.monotonically_increasing_id())
    if not keep_ids:
        rows = rows.drop("ids")
    return written(rows, "pieces")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs at least (the second bound of Martello and Toth, over all thresholds)."""
    n = np.bincount(lengths, minlength=capacity + 1)
    total = n * np.arange(capacity + 1)
    above = lambda x: np.concatenate([x[::-1].cumsum()[::-1], [0]])  # noqa: E731  (sum from a length on)
    many, much = above(n), above(total)
    half, a = capacity // 2 + 1, np.arange(capacity // 2 + 1)
    alone = many[capacity - a + 1]  # longer than what leaves room for a threshold
    big, big_sum = many[half] - alone, much[half] - much[capacity - a + 1]
    small = much[a] - much[half]
    more = np.maximum(0, -(-(small - (big * capacity - big_sum)) // capacity))
    return int((alone + np.maximum(big, 0) + np.where(big >= 0, more, 0)).max())


@dataclass
class Grouping:
    """One packing: the items of each bin, and each bin's free room."""

    bins: list[tuple[int, ...]]
    rooms: list[int]
    _of: np.ndarray | None = None

    def score(self, capacity: int) -> tuple[int, int]:
        """Fewer bins, then fuller ones; less is better."""
        return len(self.bins), -sum((capacity - r) ** 2 for r in self.rooms)

    def bin_of(self, n: int) -> np.ndarray:
        if self._of is None:
            self._of = np.empty(n, np.int32)
            self._of[np.fromiter((i for b in self.bins for i in b), np.int64, n)] = np.repeat(
                np.arange(len(self.bins), dtype=np.int32), [len(b) for b in self.bins])
        return self._of

    @staticmethod
    def from_bins(bin_of: np.ndarray, lengths: list[int], capacity: int) -> Grouping:
        bins: dict[int, list[int]] = {}
        for i, b in enumerate(bin_of.tolist()):
            bins.setdefault(b, []).append(i)
        return Grouping([tuple(b) for b in bins.values()], [capacity - sum(lengths[i] for i in b) for b in bins.values()])


def best_fit(items: list[int], lengths: list[int], capacity: int, bins: list[tuple[int, ...]], rooms: list[int]) -> Grouping:
    """Each item, in turn, goes where it leaves the least room, or into a new bin; extends ``bins`` and ``rooms``."""
    least = min((lengths[i] for i in items), default=0)
    spots: dict[int, list[int]] = {}
    free = 0  # bit r: some bin has room r
    for b, r in enumerate(rooms):
        if r >= least:
            spots.setdefault(r, []).append(b)
    for r in spots:
        free |= 1 << r
    for i in items:
        w = lengths[i]
        fitting = free >> w
        if fitting:
            r = w + (fitting & -fitting).bit_length() - 1
            same = spots[r]
            b = same.pop()
            if not same:
                free ^= 1 << r
            bins[b] += (i,)
            r -= w
            rooms[b] = r
        else:
            b, r = len(bins), capacity - w
            bins.append((i,))
            rooms.append(r)
        if r >= least:
            same = spots.setdefault(r, [])
            if not same:
                free |= 1 << r
            same.append(b)
    return Grouping(bins, rooms)


class Left:
    """Items still to be placed, by length; bit w of ``have``: some item has length w."""

    def __init__(self, items: list[int], lengths: list[int]):
        self.by_length: dict[int, list[int]] = {}
        for i in reversed(items):
            self.by_length.setdefault(lengths[i], []).append(i)
        self.have = 0
        for w in self.by_length:
            self.have |= 1 << w

    def take(self, w: int) -> int:
        same = self.by_length[w]
        if len(same) == 1:
            self.have ^= 1 << w
        return same.pop()

    def best(self, room: int) -> tuple[int, ...]:
        """Lengths of the one or two items that fill the room best; none if nothing fits."""
        fitting = self.have & ((2 << room) - 1)
        if not fitting:
            return ()
        one = fitting.bit_length() - 1
        found, total = (one,), one
        while fitting and total < room:
            w = fitting.bit_length() - 1
            if 2 * w <= total:
                break
            fitting ^= 1 << w
            second = (fitting if len(self.by_length[w]) == 1 else fitting | 1 << w) & ((2 << room - w) - 1)
            other = second.bit_length() - 1
            if other > 0 and w + other > total:
                found, total = (w, other), w + other
        return found


def best_fill(items: list[int], lengths: list[int], capacity: int, bins: list[tuple[int, ...]], rooms: list[int]) -> Grouping:
    """Bin by bin, the tightest first, then new ones from the longest item on: what one or two items fill best."""
    left = Left(items, lengths)
    least = min((lengths[i] for i in items), default=0)
    for b in sorted((b for b, r in enumerate(rooms) if r >= least), key=rooms.__getitem__):
        while taken := left.best(rooms[b]):
            bins[b] += tuple(left.take(w) for w in taken)
            rooms[b] -= sum(taken)
    while left.have:
        w = left.have.bit_length() - 1
        held, room = [left.take(w)], capacity - w
        while taken := left.best(room):
            held += [left.take(w) for w in taken]
            room -= sum(taken)
        bins.append(tuple(held))
        rooms.append(room)
    return Grouping(bins, rooms)


def without(g: Grouping, gone: set[int], keep: set[int], more: list[tuple[int, ...]], more_rooms: list[int],
            lengths: list[int], capacity: int, rng: np.random.Generator | None = None) -> Grouping:
    """``g`` with the bins ``more`` in place of those ``gone``, whose other items (not in ``keep``) are best-fitted: longest first, or by chance."""
    displaced = sorted(i for b in gone for i in g.bins[b] if i not in keep)  # items are numbered by falling length
    bins = [x for b, x in enumerate(g.bins) if b not in gone] + more
    rooms = [r for b, r in enumerate(g.rooms) if b not in gone] + more_rooms
    if rng is not None:
        return best_fit(rng.permutation(displaced).tolist(), lengths, capacity, bins, rooms)
    return best_fill(displaced, lengths, capacity, bins, rooms)


def crossover(a: Grouping, b: Grouping, lengths: list[int], capacity: int, rng: np.random.Generator) -> Grouping:
    """Some of the fuller half of ``a``'s bins, injected whole into ``b``."""
    fullest = np.argsort(a.rooms, kind="stable")[:(len(a.bins) + 1) // 2]
    chosen = rng.choice(fullest, min(len(fullest), 1 + int(INJECTED * len(a.bins) * rng.random())), replace=False).tolist()
    injected = [a.bins[c] for c in chosen]
    items = [i for x in injected for i in x]
    gone = set(b.bin_of(len(lengths))[items].tolist())
    return without(b, gone, set(items), injected, [a.rooms[c] for c in chosen], lengths, capacity)


def mutated(g: Grouping, lengths: list[int], capacity: int, rng: np.random.Generator) -> Grouping:
    """The loosest bin and some others, taken apart and best-fitted, every other time in an order by chance."""
    gone = set(rng.choice(len(g.bins), min(len(g.bins), 2 + int(MUTATED * len(g.bins))), replace=False).tolist())
    gone.add(int(np.argmax(g.rooms)))
    return without(g, gone, set(), [], [], lengths, capacity, rng if rng.random() < 0.5 else None)


def first_population(lengths: list[int], capacity: int, rng: np.random.Generator, island: int) -> list[Grouping]:
    """Best fit in falling order of length, blurred more from grouping to grouping and island to island; one bin by bin."""
    w, out = np.array(lengths, np.float64), [best_fill(list(range(len(lengths))), lengths, capacity, [], [])]
    for k in range(1, POPULATION):
        blur = 0.1 * (k - 1) + 0.05 * island
        order = np.argsort(-w * (1 + blur * rng.random(len(w))), kind="stable").tolist()
        out.append(best_fit(order, lengths, capacity, [], []))
    return out


def evolve(population: list[Grouping], lengths: list[int], capacity: int, bound: int, rng: np.random.Generator) -> list[Grouping]:
    """The population after ``OFFSPRING`` children, the best first; a child replaces the worst where it is better."""
    ranked = sorted(((g.score(capacity), k, g) for k, g in enumerate(population)), key=lambda x: x[:2])[:POPULATION]
    for child in range(OFFSPRING):
        if ranked[0][0][0] <= bound:
            break
        draw = rng.integers(0, len(ranked), 4)  # the better of two, twice
        a, b = ranked[min(draw[0], draw[1])][2], ranked[min(draw[2], draw[3])][2]
        new = crossover(a, b, lengths, capacity, rng) if a is not b else mutated(a, lengths, capacity, rng)
        score = new.score(capacity)
        if score < ranked[-1][0] and all(score != s for s, _, _ in ranked):
            ranked[-1] = (score, len(population) + child, new)
            ranked.sort(key=lambda x: x[:2])
    return [g for _, _, g in ranked]


BLOCKS = "block long, keys binary, lengths binary, old binary"
STATE = "block long, island int, lengths binary, old binary, groupings array<binary>, n_bins int, squares long, done boolean"


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row of a block's pieces, the longest first."""
    pdf = pdf.sort_values(["length", "piece_key"], ascending=[False, True])
    old = b"" if pdf["sequence"].isna().any() else np.unique(pdf["sequence"].to_numpy(np.int64), return_inverse=True)[1].astype("<i4").tobytes()
    return pd.DataFrame([(int(pdf["block"].iloc[0]), pdf["piece_key"].to_numpy("<i8").tobytes(),
                          pdf["length"].to_numpy("<i4").tobytes(), old)], columns=["block", "keys", "lengths", "old"])


def _epoch(capacity: int, epoch: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        if row["done"]:
            return pdf
        w = np.frombuffer(row["lengths"], "<i4")
        lengths, rng = w.tolist(), np.random.default_rng([SEED, epoch, int(row["block"]), int(row["island"])])
        if len(row["groupings"]):
            population = [Grouping.from_bins(np.frombuffer(g, "<i4"), lengths, capacity) for g in row["groupings"]]
        else:
            population = first_population(lengths, capacity, rng, int(row["island"]))
            if len(row["old"]):
                population.insert(0, Grouping.from_bins(np.frombuffer(row["old"], "<i4"), lengths, capacity))
        bound = lower_bound(w, capacity)
        ranked = evolve(population, lengths, capacity, bound, rng)
        n_bins, squares = ranked[0].score(capacity)
        return pd.DataFrame([(row["block"], row["island"], row["lengths"], row["old"],
                              [g.bin_of(len(lengths)).tobytes() for g in ranked], n_bins, -squares, n_bins <= bound)],
                            columns=pdf.columns)
    return run


def _placed(capacity: int):
    """(piece_key, length, sequence, offset, loose) of a block's best grouping."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, keys, lengths, grouping in batch[["block", "keys", "lengths", "grouping"]].itertuples(index=False):
                w, of = np.frombuffer(lengths, "<i4").astype(np.int64), np.frombuffer(grouping, "<i4")
                order = np.argsort(of, kind="stable")
                fill = np.bincount(of, w).astype(np.int64)
                before = np.cumsum(w[order]) - w[order]
                yield pd.DataFrame({"piece_key": np.frombuffer(keys, "<i8")[order], "length": w[order],
                                    "sequence": (block << 20) + of[order].astype(np.int64),
                                    "offset": before - (np.cumsum(fill) - fill)[of[order]],
                                    "loose": (capacity - fill > capacity * LOOSE)[of[order]]})
    return run


PLACED = "piece_key long, length long, sequence long, offset long, loose boolean"


def _solved(pool: DataFrame, n: int, first_block: int, capacity: int) -> tuple[DataFrame, int]:
    """The pool's pieces (piece_key, length, sequence or null) placed by the islands of their blocks; the number of blocks."""
    n_blocks = max(1, -(-n // BLOCK))
    deal = F.pmod(F.xxhash64(F.coalesce("sequence", "piece_key"), F.lit(first_block)), F.lit(n_blocks)) + first_block
    blocks = written(pool.select(deal.alias("block"), "piece_key", "length", "sequence")
                     .groupBy("block").applyInPandas(_block, BLOCKS), "pack-blocks")
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    state = (blocks.select("block", islands, "lengths", "old")
             .withColumns({"groupings": F.array().cast("array<binary>"), "n_bins": F.lit(0), "squares": F.lit(0).cast("long"),
                           "done": F.lit(False)}))
    tasks = min(n_blocks * ISLANDS, int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for epoch in range(EPOCHS):
        # Little data, much work: tasks for it all, whatever the bytes.
        dealt = state.repartition(tasks, "block", "island")
        state = written(dealt.groupBy("block", "island").applyInPandas(_epoch(capacity, epoch), STATE), "pack-islands")
        if epoch + 1 == EPOCHS or state.where("not done").isEmpty():
            break
        # The elite of each island goes to the next; a block that is done has nothing to send.
        elite = state.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
                             F.col("groupings")[0].alias("migrant"), F.col("done").alias("from_done"))
        state = (state.join(elite, ["block", "island"])
                 .withColumn("groupings", F.array_append("groupings", F.col("migrant"))).drop("migrant", "from_done"))
    best = state.groupBy("block").agg(F.max_by(F.col("groupings")[0], F.struct(-F.col("n_bins"), "squares")).alias("grouping"))
    placed = blocks.join(best, "block").select("block", "keys", "lengths", "grouping").mapInPandas(_placed(capacity), PLACED)
    return written(placed, "pack-placed"), n_blocks


def packed(sized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(piece_key, sequence_id, offset) of every row of ``sized`` (piece_key, length); keys are distinct longs.

    The lengths in a sequence add up to ``capacity`` at most, and the offsets leave no gap.  Lengths are from 1 to
    ``capacity``; a piece of full length is alone.  Sequence ids are distinct numbers in no order.  An empty table gives no row.
    """
    whole = sized.where(F.col("length") == capacity)
    out = whole.select("piece_key", (-1 - F.col("piece_key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pool = sized.where(F.col("length") < capacity).select("piece_key", "length", F.lit(None).cast("long").alias("sequence"))
    n, first_block = pool.count(), 0
    while n:
        placed, n_blocks = _solved(pool, n, first_block, capacity)
        first_block += n_blocks
        again = placed.where("loose")
        left = again.count() if n_blocks > 1 else 0
        # The loose bins of many blocks fill few blocks; where most bins are loose, no dealing makes them tight.
        anew = 0 < left <= n // 2
        done = placed.where("not loose") if anew else placed
        out = out.unionByName(done.select("piece_key", F.col("sequence").alias("sequence_id"), "offset"))
        pool, n = again.select("piece_key", "length", "sequence"), left if anew else 0
    return out


def packed_documents(docs: DataFrame, tokenizer_json: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                     keep_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset): every piece of ``docs`` with its place.

    Null texts are empty: one piece of the end id.  Long texts are cut, none is dropped.  Repeated rows, ties and null ids
    are pieces of their own.  Only ``key`` and ``text`` are read, so other columns' names don't matter.  An empty table gives none.
    """
    cut = pieces(docs, tokenizer_json, key, text, capacity, keep_ids)
    return cut.join(packed(cut.select("piece_key", "length"), capacity), "piece_key").drop("piece_key")


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_pieces, ids): the ids of every sequence of ``packed_documents`` with ``keep_ids``, as little-endian bytes.

    A sequence has ``capacity`` ids at most, so its pieces meet in one task.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed_pieces.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.size("parts").alias("n_pieces"),
                    F.expr("aggregate(parts, cast('' as binary), (s, p) -> concat(s, p.ids))").alias("ids")))

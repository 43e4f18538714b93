"""Near-duplicate groups by ProbMinHash.

A text is the multiset of its five-word shingles.  Each shingle emits the
arrivals of a Poisson process whose rate is its count; every arrival falls in one
of the signature's slots, and a slot keeps the shingle that arrives first.  Once all
slots are taken, arrivals later than the latest of them can't matter, so
a shingle stops there.  Two signatures agree in a slot with the texts'
probability Jaccard similarity (for counts of one: the Jaccard similarity).

Signatures are cut into bands; texts that share a band are candidates.
Candidates are verified on their shingles, and the groups are the connected
components of what holds.  Copies of one shingle multiset are one node from the
start, each text meets one leader first, and pairs inside a group already found aren't looked at
again.  The texts of large buckets that are left are joined on their rarest shingles, which
finds every similar pair.  Texts of a shingle that many have aren't joined on it: they are compared by blocks, all
blocks of those that are connected by such shingles with each other, and a pair of blocks gives back what links it needs to
be as connected as its similar pairs make it.  So no pair is lost there either, rows follow the number of
texts times that of blocks, and a task holds two blocks at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import among, bounded_batches, free_name, give_back, hashed_words, in_blocks, mixed, text_blocks, words_of, written

SHINGLE, SIMILARITY = 5, 0.8
#: At 0.8 a pair shares a band with probability 1 - (1 - 0.8**5)**20 = 0.9996.
BANDS, ROWS = 20, 5
#: Buckets up to this size are paired in full.
PAIRED = 16
#: Texts of a shingle up to which they are paired in full.
HOT = 64
#: Of the others: texts of a block that is compared as a whole, and bytes of their shingles.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 2 << 20
#: Shingles whose shares are summed at a time.
SUMMED = 2048
#: Links up to which one task finishes the components.
FEW_LINKS = 1 << 14
#: Trees of a second signature, and rows of its bands level by level.
TREES, LEVELS = 64, (8, 10, 12, 14, 17, 20, 24, 30)
DEEP_SEED = 0x5851F42D4C957F2D
#: Odd multipliers of a shingle's five word hashes.
FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
#: Shingles below which a text's signature takes many rounds; such texts are signed together.
FEW = 64

#: Characters of texts sketched before their rows are sent on.
SENT = 1 << 21

SKETCH = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])


def shingles(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct shingle hashes, ascending; counts) per text.

    A text of fewer than five words is one shingle; one without words has none.
    """
    sizes, (flat,) = hashed_words(texts)
    ends = np.cumsum(sizes)
    out = []
    if len(flat) >= SHINGLE:
        n = len(flat) - SHINGLE + 1
        rolled = np.zeros(n, np.uint64)
        for k, factor in enumerate(FACTORS):
            rolled += flat[k:k + n] * np.uint64(factor)
        rolled = mixed(rolled)
    for size, end, text in zip(sizes.tolist(), ends.tolist(), texts, strict=True):
        if size >= SHINGLE:
            out.append(np.unique(rolled[end - size:end - SHINGLE + 1], return_counts=True))
        elif size:
            short = hashlib.blake2b(b" ".join(words_of(text)), digest_size=8).digest()
            out.append((np.frombuffer(short, np.uint64), np.ones(1, np.int64)))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], slots: int) -> np.ndarray:
    """The shingle that arrives first in each slot, of 2048 at most; a row per set (none may be empty)."""
    if slots > 2048:
        raise ValueError("a signature has 2048 slots at most")
    owner = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    shingle = np.concatenate([s for s, _ in sets])
    rate = np.concatenate([c for _, c in sets]).astype(np.float64)
    first = np.full(len(sets) * slots, np.inf)
    winner = np.zeros(len(sets) * slots, np.uint64)
    latest = np.full(len(sets), np.inf)
    when = np.zeros(len(shingle))
    arrival = 0
    while len(shingle):
        arrival += 1
        drawn = mixed(shingle + np.uint64(arrival * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        when = when - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        early = when < latest[owner]  # the others can't win a slot any more
        owner, shingle, rate, when, drawn = owner[early], shingle[early], rate[early], when[early], drawn[early]
        # The eleven bits that the arrival doesn't use tell the slot.
        slot = owner * slots + ((drawn & np.uint64(2047)).astype(np.int64) * slots >> 11)
        np.minimum.at(first, slot, when)
        won = first[slot] == when
        winner[slot[won]] = shingle[won]
        latest = first.reshape(-1, slots).max(axis=1)
    return winner.reshape(-1, slots)


def bands_of(winners: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash per band, the band's number included."""
    parts = winners.reshape(len(winners), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for r in range(rows):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) ^ parts[:, :, r])
    return h.view(np.int64)


def deep_bands(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """[set, tree, level]: hashes of the first rows of each tree of a second signature, as many as the level says."""
    again = [(mixed(s ^ np.uint64(DEEP_SEED)), c) for s, c in sets]
    parts = signatures(again, TREES * LEVELS[-1]).reshape(len(sets), TREES, LEVELS[-1])
    h = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), parts.shape[:2])
    out = np.empty((len(sets), TREES, len(LEVELS)), np.int64)
    for r in range(LEVELS[-1]):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) ^ parts[:, :, r])
        if r + 1 in LEVELS:
            out[:, :, LEVELS.index(r + 1)] = h.view(np.int64)
    return out


def packed(s: np.ndarray, counts: np.ndarray) -> bytes:
    return s.astype("<u8").tobytes() + counts.astype("<u4").tobytes()


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(blob) // 12
    return np.frombuffer(blob, "<u8", n), np.frombuffer(blob, "<u4", n, 8 * n)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard: the sum over common i of 1 / sum over j of max(a_j / a_i, b_j / b_i)."""
    both, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    if x.max() == y.max() == 1:
        return len(both) / (len(x) + len(y) - len(both))
    only_a, only_b = x.sum() - x[at_a].sum(), y.sum() - y[at_b].sum()
    kinds, times = np.unique(np.stack([x[at_a], y[at_b]], 1), axis=0, return_counts=True)
    return float(sum(t / (only_a / p + only_b / q + (np.maximum(kinds[:, 0] / p, kinds[:, 1] / q) * times).sum())
                     for (p, q), t in zip(kinds, times, strict=True)))


def sketches(texts: list[str | None], bands: int, rows: int) -> list[tuple[bytes | None, np.ndarray | None]]:
    """(digest of the shingle multiset, bands) per text; None where a text has no word."""
    out: list[tuple] = [(None, None)] * len(texts)

    def sign(numbers: list[int], sets: list[tuple[np.ndarray, np.ndarray]]) -> None:
        if numbers:
            for i, s, b in zip(numbers, sets, bands_of(signatures(sets, bands * rows), bands, rows), strict=True):
                out[i] = (hashlib.blake2b(packed(*s), digest_size=16).digest(), b)

    few: list[int] = []
    few_sets: list[tuple[np.ndarray, np.ndarray]] = []
    for part in text_blocks(texts):
        many, many_sets = [], []
        for i, s in zip(range(part.start, part.stop), shingles(texts[part]), strict=True):
            if len(s[0]) >= FEW:
                many.append(i)
                many_sets.append(s)
            elif len(s[0]):
                few.append(i)
                few_sets.append(s)
        sign(many, many_sets)
        if len(few) >= 4096:
            sign(few, few_sets)
            few, few_sets = [], []
    sign(few, few_sets)
    return out


def _sketched(bands: int, rows: int):
    @F.pandas_udf(SKETCH)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.where(batch.notna(), None).tolist()
            for part in in_blocks([len(t or "") + 1 for t in texts], SENT):
                yield pd.DataFrame(sketches(texts[part], bands, rows), columns=SKETCH.names)
        give_back()
    # Else Spark would run it a second time for a filter on its result.
    return run.asNondeterministic()


@F.pandas_udf(T.BinaryType())
def _packed_shingles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        texts = batch.tolist()
        for part in text_blocks(texts):
            yield pd.Series([packed(*s) for s in shingles(texts[part])])
    give_back()


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per shingle of (node, root, blob); some texts at a time, as they are hundreds of times longer so."""
    for batch in batches:
        for i in range(0, len(batch), 256):
            rows = batch[i:i + 256]
            sets = [unpacked(b) for b in rows["blob"]]
            sizes = [len(s) for s, _ in sets]
            yield pd.DataFrame({
                "node": np.repeat(rows["node"].to_numpy(), sizes), "root": np.repeat(rows["root"].to_numpy(), sizes),
                "shingle": np.concatenate([s for s, _ in sets]).view(np.int64),
                "times": np.concatenate([c for _, c in sets]).astype(np.int64)})
    give_back()


def _incidence(sets: list[tuple[np.ndarray, np.ndarray]], shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in ``shared``, share of the row's text) of the shingles that ``shared``, ascending, has, by place."""
    sizes = [len(s) for s, _ in sets]
    shingle = np.concatenate([s for s, _ in sets])
    share = np.concatenate([c / c.sum() for _, c in sets])
    place = np.searchsorted(shared, shingle)
    there = np.flatnonzero(shared[np.minimum(place, len(shared) - 1)] == shingle)
    there = there[np.argsort(place[there], kind="stable")]
    return np.repeat(np.arange(len(sets)), sizes)[there], place[there], share[there]


def bounds(a: list[tuple[np.ndarray, np.ndarray]], b: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """[a, b]: what the similarity of each two texts is at most, by the shares of their common shingles; equal to it for counts of one.

    A common shingle of shares p and q adds 1 / (1/p + (1 - Q)/q) at most, where P and Q are the texts' shares in common: concave and of degree
    one, so all of them add P Q / (P + Q - P Q) at most.
    """
    shared = np.intersect1d(np.concatenate([s for s, _ in a]), np.concatenate([s for s, _ in b]))
    p, q = np.zeros((2, len(a), len(b)), np.float32)
    if len(shared):
        sides = [_incidence(side, shared) for side in (a, b)]
        for start in range(0, len(shared), SUMMED):
            weights, there = [], []
            for (row, place, share), n in zip(sides, (len(a), len(b)), strict=True):
                part = slice(*np.searchsorted(place, [start, start + SUMMED]))
                w = np.zeros((n, min(SUMMED, len(shared) - start)), np.float32)
                w[row[part], place[part] - start] = share[part]
                weights.append(w)
                there.append((w > 0).astype(np.float32))
            p += weights[0] @ there[1].T
            q += there[0] @ weights[1].T
    return p * q / np.maximum(p + q - p * q, np.float32(1e-9))


class _Sets:
    """Disjoint sets of numbers, each named by its smallest."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def of(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.of(i), self.of(j)
        self.up[max(i, j)] = min(i, j)


def _compared(least: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """(a, b): links that connect what the similar pairs of the cell's two blocks do; of one block, of its own pairs."""
        root = np.unique(rows["root"].to_numpy(), return_inverse=True)[1]
        sets, node = [unpacked(x) for x in rows["blob"]], rows["node"].to_numpy()
        block = rows["block"].to_numpy()
        low, high = (np.flatnonzero(block == n) for n in (block.min(), block.max()))
        most = bounds([sets[i] for i in low], [sets[j] for j in high])
        found, joined = [], _Sets(int(root.max()) + 1)
        # Sums of small floats: a pair at the limit may seem a little less.
        for i, j in np.argwhere((most >= least - 1e-4) & (root[low][:, None] != root[high])).tolist():
            i, j = int(low[i]), int(high[j])
            if joined.of(root[i]) != joined.of(root[j]) and similarity(sets[i], sets[j]) >= least:
                joined.join(root[i], root[j])
                found.append((node[i], node[j]))
        del sets, most
        give_back()
        return pd.DataFrame(found, columns=["a", "b"])
    return run


def _verified(least: float):
    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series([similarity(unpacked(x), unpacked(y)) for x, y in zip(a, b, strict=True)], dtype="float64")
    return run.asNondeterministic()  # as above


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, root) of all links of the task."""
    links = pd.concat(list(batches))
    nodes, at = np.unique(np.concatenate([links["a"].to_numpy(), links["b"].to_numpy()]), return_inverse=True)
    joined = _Sets(len(nodes))
    for i, j in zip(at[:len(links)].tolist(), at[len(links):].tolist(), strict=True):
        joined.join(i, j)
    yield pd.DataFrame({"node": nodes, "root": nodes[[joined.of(i) for i in range(len(nodes))]]})


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component of (a, b) links.

    Each round hooks every node to its smallest neighbour, follows the hooks
    to their ends by doubling, and contracts the links; the rounds are logarithmic in the
    number of nodes.  Once ``FEW_LINKS`` are left, one task joins them.
    """
    edges = written(links.select("a", "b").where("a <> b"), "edges")
    labels = None
    while n := edges.count():
        if n <= FEW_LINKS:
            kind = edges.schema["a"].dataType.simpleString()
            hooks = written(edges.repartition(1).mapInPandas(_joined, f"node {kind}, root {kind}"), "hooks")
            return hooks if labels is None else _onward(labels, hooks)
        both = edges.union(edges.select("b", "a"))
        hooks = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                        .select("node", F.least("node", "low").alias("root")), "hooks")
        while True:
            further = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = written(hooks.join(further, "root").select(
                "node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "hooks")
            hooks = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        labels = hooks if labels is None else _onward(labels, hooks)
        ends = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        other = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = written(edges.join(ends, "a").join(other, "b").where("ra <> rb")
                        .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _onward(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    """(node, root) of ``labels`` with their roots' roots."""
    onward = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return written(labels.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")


def _pairs(both: DataFrame) -> DataFrame:
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


class _Groups:
    """Candidate buckets, the texts behind them, and the components found so far."""

    def __init__(self, docs: DataFrame, text: str, bands: int, rows: int, least: float, hot: int | None = HOT):
        self.texts = docs.select(F.col(text).alias("text")).where("text is not null").select(
            F.sha2("text", 256).alias("text_key"), "text")
        self.least, self.hot = least, hot
        bounded_batches(docs.sparkSession)
        self.sketches = written(self.texts.withColumn("s", _sketched(bands, rows)(F.col("text")))
                                .where("s.node is not null").select("text_key", "s.*"), "sketches")
        nodes = self.sketches.groupBy("node").agg(F.min("text_key").alias("text_key"), F.first("bands").alias("bands"))
        self.nodes = written(nodes, "nodes")
        members = self.nodes.select("node", F.explode("bands").alias("bucket"))
        shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        self.members = written(members.join(shared, "bucket"), "buckets")
        self.links: DataFrame | None = None
        self.roots: DataFrame | None = None
        need = written(self.members.select("node").distinct().join(self.nodes.select("node", "text_key"), "node"), "shared")
        self.shingled = written(
            self.texts.where(among(need, F.col("text_key"), "text_key")).join(need, "text_key").groupBy("node").agg(F.first("text").alias("text"))
            .select("node", _packed_shingles("text").alias("blob")), "shingles")

    def verify(self, pairs: DataFrame) -> None:
        """Adds what holds of the (a, b) pairs, and joins the components."""
        a = self.shingled.select(F.col("node").alias("a"), F.col("blob").alias("blob_a"))
        b = self.shingled.select(F.col("node").alias("b"), F.col("blob").alias("blob_b"))
        found = (pairs.join(a, "a").join(b, "b")
                 .withColumn("similarity", _verified(self.least)("blob_a", "blob_b"))
                 .where(F.col("similarity") >= self.least).select("a", "b", "similarity"))
        found = written(found, "links")
        self.links = found if self.links is None else self.links.unionByName(found)
        self.roots = components(self.links)

    def open(self) -> DataFrame:
        """Members, with their roots, of the buckets that still hold several components."""
        m = self.members.join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = (m.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                   .where("low <> high").select("bucket"))
        return written(m.join(several, "bucket"), "open")

    def find(self) -> None:
        # 1. Each text with one leader.  A text that changed copies were made from shares more
        # buckets with more texts than any copy, so the buckets' most frequent company leads.
        company = self.members.groupBy("node").agg(F.sum("n").alias("company"))
        led = self.members.join(company, "node")
        leaders = led.groupBy("bucket").agg(F.max(F.struct("company", "node")).alias("leader"))
        one = (self.members.join(leaders, "bucket").where("node <> leader.node").groupBy(F.col("node").alias("b"))
               .agg(F.max("leader")["node"].alias("a")).select("a", "b"))
        self.verify(one)
        # 2. Small buckets in full, where the components differ.
        left = self.open()
        if left.isEmpty():
            return
        a = left.where(f"n <= {PAIRED}").select("bucket", F.col("node").alias("a"), F.col("root").alias("ra"))
        b = left.select("bucket", F.col("node").alias("b"), F.col("root").alias("rb"))
        self.verify(a.join(b, "bucket").where("ra <> rb and a < b").select("a", "b").distinct())
        # 3. What large buckets may still hide, exactly and without their pairs.
        left = self.open().where(f"n > {PAIRED}").select("node", "root").distinct()
        if not left.isEmpty():
            self.verify(self.sharing_rare(left))

    def sharing_rare(self, nodes: DataFrame) -> DataFrame:
        """(a, b): the pairs of (node, root) in different components that can be as similar as asked.

        The common shingles of such a pair hold that share of either text at least.  So among a text's shingles from the
        rarest on, up to where their share passes the rest, is the pair's rarest common one: texts
        with enough shingles of their own share nothing there with the texts they were changed from.
        Within a shingle's texts the pairs inside the largest component are left out.  Texts of a shingle that more than ``hot`` have
        are paired by ``sharing_often`` instead.
        """
        tokens = written(nodes.join(self.shingled, "node").select("node", "root", "blob").mapInPandas(
            _tokens, "node binary, root binary, shingle long, times long"), "tokens")
        often = tokens.groupBy("shingle").agg(F.count("*").alias("texts"))
        order = Window.partitionBy("node").orderBy("texts", "shingle")
        first = (tokens.join(often, "shingle")
                 .withColumn("before", F.sum("times").over(order) - F.col("times"))
                 .withColumn("total", F.sum("times").over(Window.partitionBy("node")))
                 .where(F.col("before") <= F.col("total") * (1 - self.least) + 1e-9).where("texts > 1"))
        first = written(first.select("shingle", "node", "root"), "rare")
        sizes = first.groupBy("shingle", "root").agg(F.count("*").alias("n"))
        most = sizes.groupBy("shingle").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("texts"),
                                            F.count("*").alias("roots")).where("roots > 1")
        many = F.lit(False) if self.hot is None else F.col("texts") > self.hot
        most = written(most.select("shingle", F.col("m.root").alias("most"), many.alias("hot")), "shared-shingles")
        few, hot = most.where("not hot"), most.where("hot").select("shingle")
        found, cluster = None, F.lit(None).cast(first.schema["node"].dataType).alias("cluster")
        members = first
        if not hot.isEmpty():
            found, clusters = self.sharing_often(written(first.join(hot, "shingle"), "hot"))
            members, cluster = first.join(clusters, "node", "left"), "cluster"
        members = members.select("shingle", "node", "root", cluster)
        a = (members.join(few, "shingle").where("root <> most")
             .select("shingle", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("cluster").alias("ca")))
        b = members.select("shingle", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("cluster").alias("cb"))
        # Texts of one cluster have been compared.
        pairs = _pairs(a.join(b, "shingle").where("ra <> rb and not coalesce(ca = cb, false)"))
        return (pairs if found is None else pairs.unionByName(found)).distinct()

    def sharing_often(self, shared: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(a, b): links that connect what all similar pairs of (shingle, node, root) of a cluster do; (node, cluster).

        Texts that such shingles connect, over others too, are a cluster; a cluster's texts are dealt to blocks by their hash, and each two
        blocks meet in a cell.  Blocks of the cluster's largest component have no text of another; these don't meet each other.
        """
        ends = shared.groupBy("shingle").agg(F.min("node").alias("b"))
        clusters = components(shared.join(ends, "shingle").select(F.col("node").alias("a"), "b").distinct())
        clusters = clusters.withColumnRenamed("root", "cluster")
        texts = (shared.select("node", "root").distinct().join(clusters, "node")
                 .join(self.shingled, "node"))
        texts = written(texts, "often")
        sizes = texts.groupBy("cluster", "root").agg(F.count("*").alias("n"), F.sum(F.length("blob")).alias("size"))
        blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK_TEXTS, size / BLOCK_SHINGLES)).cast("int")
        large = sizes.groupBy("cluster").agg(F.max(F.struct("n", "size", "root")).alias("m"), F.sum("n").alias("n"), F.sum("size").alias("size"))
        large = large.select("cluster", F.col("m.root").alias("most"), blocks(F.col("m.n"), F.col("m.size")).alias("alike"),
                             blocks(F.col("n") - F.col("m.n"), F.col("size") - F.col("m.size")).alias("others")).where("others > 0")
        number = F.xxhash64("node")
        dealt = (texts.join(large, "cluster")
                 .withColumn("block", F.when(F.col("root") == F.col("most"), F.pmod(number, "alike"))
                             .otherwise(F.col("alike") + F.pmod(number, "others")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.when(F.col("root") == F.col("most"), F.col("alike")).otherwise(F.lit(0)),
                                                           F.col("alike") + F.col("others") - 1))))
        found = (dealt.select("cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "root", "blob")
                 .groupBy("cluster", "low", "high").applyInPandas(_compared(self.least), "a binary, b binary"))
        return written(_pairs(found).distinct(), "often-pairs"), clusters

    def text_groups(self) -> DataFrame:
        """(text_key, group) of every text that has a word."""
        return (self.sketches.select("text_key", "node").distinct().join(self.roots, "node", "left")
                .select("text_key", F.coalesce("root", "node").alias("group")))


def text_groups(docs: DataFrame, text: str = "text", bands: int = BANDS, rows: int = ROWS,
                least: float = SIMILARITY, hot: int | None = HOT) -> DataFrame:
    """(text_key, group): the near-duplicate group of every distinct text with a word.

    ``text_key`` is the SHA-256 of the text.  Null texts and texts without a
    word have no row.  Links hold exactly (on 64-bit shingle hashes); the
    bands find a pair of similarity 0.8 with probability 0.9996, a closer one with more.  Texts that share a shingle with
    more than ``hot`` others are compared by blocks, with None as rows of a join; both find the same groups.
    """
    g = _Groups(docs, text, bands, rows, least, hot)
    g.find()
    return written(g.text_groups(), "groups")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, class_size), a row per row of ``docs``.

    The class id is the smallest id of the group, its size the group's rows.  Null texts and texts without a word
    are classes of their own (class id: their id, size 1), as is any text without a near copy.  Rows
    with a null id take part; a class of null ids only has a null class id.  Repeated rows are rows of one class.
    Texts of any length are taken whole; only ``key`` and ``text`` are read, so other columns' names don't matter.
    """
    ids = docs.select(F.col(key).alias("doc_id"), F.sha2(F.col(text), 256).alias("text_key"))
    groups = text_groups(docs, text)
    per_text = ids.groupBy("text_key").agg(F.min("doc_id").alias("low"), F.count("*").alias("rows")).join(groups, "text_key")
    per_group = per_text.groupBy("group").agg(F.min("low").alias("class_id"), F.sum("rows").alias("class_size"))
    named = groups.join(per_group, "group").select("text_key", "class_id", "class_size")
    alone = F.col("class_size").isNull()
    return (ids.join(named, "text_key", "left")
            .select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one of smallest id.

    Null ids come last; rows equal in id and text count as one, the smallest by the other columns
    in their order.  All columns are kept.  Rows whose text is null or has no word stay.
    """
    groups = text_groups(docs, text)
    k, g = free_name(docs, "text_key"), free_name(docs, "group")
    ids = docs.select(F.col(key).alias("id"), F.sha2(F.col(text), 256).alias("text_key")).join(groups, "text_key")
    first = (ids.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("f"))
             .select(F.col("f.text_key").alias(k), F.col("f.id").alias(g)))
    keyed = docs.withColumn(k, F.sha2(F.col(text), 256))
    kept = keyed.join(first.withColumnRenamed(k, k + "_f"), (F.col(k) == F.col(k + "_f")) & F.col(key).eqNullSafe(F.col(g)))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = kept.groupBy(k, key).agg(F.min(whole).alias("row")).select("row.*")
    wordless = F.coalesce(F.translate(F.col(text), " \t\n\x0b\x0c\r", ""), F.lit("")) == ""
    return kept.unionByName(docs.where(wordless))

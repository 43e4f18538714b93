"""Hidden Markov language model, scored exactly by the scaled forward recursion.

The frequent words, a bounded number, are symbols of their own; every other
word stands for the class of its ending, and its probability within the class follows its
count.  Baum-Welch counts of all training documents are gathered on the
executors, summed by blocks of symbols, and give the next parameters, which are of a
fixed size.  The counts of all words stay in a table that rare words are
joined to; no vocabulary goes to the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import in_blocks, words_of, written

STATES = 8
#: Words with a symbol of their own; classes of the others, by their last three bytes.
WORDS, CLASSES = 16_000, 2048
#: Passes over the whole training set, after a start fitted to a sample of so many pieces from anywhere in it.
ROUNDS = 4
SAMPLE_PIECES, SAMPLE_ROUNDS = 2000, 12
#: Tokens of a training piece, and of the context read on both sides of it, which isn't counted: there the state that a
#: cut doesn't know is as good as forgotten.  Every token and transition of a text counts in one piece.
PIECE, CONTEXT = 256, 24
#: Tokens in one vectorised block, and symbols in one block of summed counts.
BLOCK, SYMBOL_BLOCK = 500_000, 512
#: Characters of texts encoded before their rows are sent on.
TEXT_BLOCK = 1 << 20
#: Pseudo-tokens per state, spread as the symbols are overall.
PRIOR = 200.0
SEED = 11
#: Distinct words a task holds before it sends their counts on.
DISTINCT = 400_000


def lowered(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; null has none."""
    return [w for w in (text or "").encode("utf-8", "surrogatepass").lower().split()]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()

    def frame() -> pd.DataFrame:
        return pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    for batch in batches:
        for text in batch["text"]:
            counts.update(lowered(text))
            if len(counts) >= DISTINCT:
                yield frame()
                counts.clear()
    if counts:
        yield frame()


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


@dataclass
class Vocabulary:
    """What is fixed in size: the frequent words with their counts, and the totals."""

    symbol: dict[bytes, int]
    counts: np.ndarray  # of the frequent words, then of the end
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_distinct: np.ndarray

    @property
    def end(self) -> int:
        return len(self.symbol)

    @property
    def size(self) -> int:
        return len(self.symbol) + 1 + CLASSES

    def class_of(self, word: bytes) -> int:
        return len(self.symbol) + 1 + word_class(word)


def vocabulary(counts: DataFrame, n_docs: int) -> Vocabulary:
    """From the table of all word counts (word, n)."""
    # A power of two that enough words reach, and few more: no task sends a list of its own.
    reach, least = 0, 0
    for power, words in sorted(counts.groupBy(F.floor(F.log2("n")).alias("p")).count().collect(), reverse=True):
        reach, least = reach + words, 1 << power
        if reach >= WORDS:
            break
    top = [(bytes(r.word), r.n) for r in counts.where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(WORDS).collect()]
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    class_tokens, class_distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    if top:
        last, n = top[-1]
        rare = counts.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > F.lit(bytearray(last)))))
        of = F.crc32(F.substring("word", -3, 3)) % CLASSES
        for c, tokens, distinct in rare.groupBy(of.alias("c")).agg(F.sum("n"), F.count("*")).collect():  # CLASSES rows at most
            class_tokens[c], class_distinct[c] = tokens, distinct
    return Vocabulary({w: i for i, (w, _) in enumerate(top)}, np.array([n for _, n in top] + [n_docs], np.float64),
                      int(total[0]) + n_docs, int(total[1]) + (n_docs > 0), class_tokens, class_distinct)


ENCODED = T.StructType([
    T.StructField("symbols", T.BinaryType()),
    T.StructField("rare", T.ArrayType(T.BinaryType())),
    T.StructField("times", T.ArrayType(T.LongType())),
])


def _encoded(shared):
    """Symbols of a text as 16-bit numbers, the end included; its rare words and how often each is there."""
    @F.pandas_udf(ENCODED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        v: Vocabulary = shared.value

        class Symbols(dict):
            def __missing__(self, word: bytes) -> int:
                return v.class_of(word)

        symbol, n = Symbols(v.symbol), len(v.symbol)
        def row(text: str | None) -> tuple:
            words = lowered(text)
            ids = np.fromiter(map(symbol.__getitem__, words), np.uint16, len(words))
            own = Counter(words[i] for i in np.nonzero(ids > n)[0].tolist())
            return np.append(ids, np.uint16(n)).tobytes(), list(own), list(own.values())

        for batch in batches:
            texts = batch.where(batch.notna(), None).tolist()
            for part in in_blocks([len(t or "") + 1 for t in texts], TEXT_BLOCK):
                yield pd.DataFrame([row(t) for t in texts[part]], columns=ENCODED.names)
    return run


@dataclass
class Model:
    first: np.ndarray  # state of the first token
    average: np.ndarray  # state of a token anywhere
    move: np.ndarray
    emit: np.ndarray  # [symbol, state]

    @staticmethod
    def from_counts(first: np.ndarray, average: np.ndarray, move: np.ndarray, emit: np.ndarray, overall: np.ndarray) -> Model:
        spread = lambda x: (x + 1) / (x + 1).sum(-1, keepdims=True)
        e = emit + PRIOR * overall[:, None]
        return Model(spread(first), spread(average), spread(move), e / e.sum(0))


def overall_share(v: Vocabulary) -> np.ndarray:
    """The share of each symbol in the training tokens, one added to each."""
    n = np.concatenate([v.counts, v.class_tokens]) + 1
    return n / n.sum()


def expected(model: Model, pieces: list[np.ndarray], starts: np.ndarray,
             inner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts (first, average, move, emit) of symbol sequences.

    ``starts`` tells whether a piece begins its text; ``inner`` are the first place of each piece that counts and the
    first behind it, with the transitions into them (all, if not given).
    """
    order = np.argsort([-len(p) for p in pieces], kind="stable")
    sizes = np.array([len(pieces[i]) for i in order])
    begins = starts[order]
    low, high = (np.zeros(len(order), np.int64), sizes) if inner is None else inner[order].T
    steps, n, k = int(sizes[0]), len(order), len(model.first)
    ids = np.zeros((n, steps), np.int64)
    for row, i in enumerate(order.tolist()):
        ids[row, :len(pieces[i])] = pieces[i]
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    emit, move = model.emit.astype(np.float32), model.move.astype(np.float32)
    alpha, seen = np.zeros((steps, n, k), np.float32), np.zeros((steps, n, k), np.float32)
    scale = np.ones((steps, n, 1), np.float32)
    start = np.where(begins[:, None], model.first, model.average).astype(np.float32)
    for t in range(steps):
        m = active[t]
        e = emit[ids[:m, t]]
        a = (start if t == 0 else alpha[t - 1, :m] @ move) * e
        scale[t, :m] = a.sum(1, keepdims=True)
        alpha[t, :m] = a / scale[t, :m]
        seen[t, :m] = e
    beta, pairs = np.ones((n, k), np.float32), np.zeros((k, k))
    gamma = alpha  # becomes the posterior, from the end
    for t in range(steps - 1, 0, -1):
        m = active[t]
        onward = beta[:m] * seen[t, :m] / scale[t, :m]
        gamma[t, :m] *= beta[:m]
        pairs += alpha[t - 1, :m].T @ (onward * ((low[:m] <= t) & (t < high[:m]))[:, None])
        beta[:m] = onward @ move.T
    gamma[0] *= beta
    at = np.arange(steps)[None, :]
    real = (low[:, None] <= at) & (at < high[:, None])
    flat, weight = ids[real], gamma.transpose(1, 0, 2)[real]
    counts = np.stack([np.bincount(flat, weight[:, s], len(emit)) for s in range(k)], 1)
    return gamma[0][begins].sum(0, dtype=np.float64), weight.sum(0, dtype=np.float64), pairs * model.move, counts


def pieces_of(symbols: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(pieces with their context, whether each begins its text, the places that count) of whole texts."""
    pieces, starts, inner = [], [], []
    for s in symbols:
        for a in range(0, len(s), PIECE):
            before = min(a, CONTEXT)
            pieces.append(s[a - before:a + PIECE + CONTEXT])
            starts.append(a == 0)
            inner.append((before, before + min(PIECE, len(s) - a)))
    return pieces, np.array(starts, bool), np.array(inner, np.int64).reshape(-1, 2)


def _sum_pieces(total, pieces: list[np.ndarray], starts: np.ndarray, inner: np.ndarray, model: Model):
    for part in in_blocks([len(p) for p in pieces], BLOCK):
        got = expected(model, pieces[part], starts[part], inner[part])
        total = got if total is None else tuple(a + b for a, b in zip(total, got, strict=True))
    return total


def _add(total, symbols: list[np.ndarray], model: Model):
    return _sum_pieces(total, *pieces_of(symbols), model)


def sample_of(encoded: DataFrame, most: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct pieces of all texts whose hash is below a bound that about ``most`` pieces have; as ``pieces_of``.

    The bound comes from the number of pieces, so tasks send no more for more input.
    """
    n = encoded.agg(F.sum(F.ceil(F.length("symbols") / (2 * PIECE)))).first()[0] or 0
    bound = 1 << 32 if n <= most else (most << 32) // n

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pieces, starts, inner = pieces_of([np.frombuffer(s, np.uint16) for s in batch["symbols"]])
            rows = [(p.tobytes(), bool(begins), *map(int, places)) for p, begins, places in zip(pieces, starts, inner, strict=True)
                    if zlib.crc32(p.tobytes()) < bound]
            yield pd.DataFrame(rows, columns=["piece", "begins", "low", "high"])

    found = (encoded.select("symbols").mapInPandas(run, "piece binary, begins boolean, low long, high long").distinct()
             .orderBy("piece", "begins", "low").collect())  # about ``most`` pieces
    return ([np.frombuffer(bytes(r.piece), np.uint16) for r in found], np.array([r.begins for r in found], bool),
            np.array([(r.low, r.high) for r in found], np.int64).reshape(-1, 2))


def _expectations(shared):
    """Counts of one task as blocks: number, and the values of that many symbols and all states; -1: the rest."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model: Model = shared.value
        total = None
        for batch in batches:
            total = _add(total, [np.frombuffer(s, np.uint16) for s in batch["symbols"]], model)
        if total is not None:
            first, average, move, emit = total
            blocks = [(-1, np.concatenate([first, average, move.ravel()]).tobytes())]
            blocks += [(i, emit[i:i + SYMBOL_BLOCK].tobytes()) for i in range(0, len(emit), SYMBOL_BLOCK)]
            yield pd.DataFrame(blocks, columns=["block", "counts"])
    return run


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of the blocks, which come in order."""
    at, total = None, None
    for batch in batches:
        out = []
        for block, counts in batch.itertuples(index=False):
            counts = np.frombuffer(counts)
            if block != at:
                if at is not None:
                    out.append((at, total.tobytes()))
                at, total = block, counts.copy()
            else:
                total += counts
        yield pd.DataFrame(out, columns=["block", "counts"])
    if at is not None:
        yield pd.DataFrame([(at, total.tobytes())], columns=["block", "counts"])


def train(encoded: DataFrame, v: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch on all of ``encoded`` (symbols), from a start on a bounded sample."""
    share, rng = overall_share(v), np.random.default_rng(SEED)
    model = Model.from_counts(np.zeros(states), np.zeros(states), 20 * np.eye(states),
                              share[:, None] * 1e4 * rng.gamma(1.0, 1.0, (len(share), states)), share)
    if encoded.isEmpty():
        return model
    sample = sample_of(encoded, SAMPLE_PIECES)
    for _ in range(SAMPLE_ROUNDS if sample[0] else 0):
        model = Model.from_counts(*_sum_pieces(None, *sample, model), share)
    context = encoded.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast(model)  # symbols x states: a fixed size
        blocks = (encoded.select("symbols").mapInPandas(_expectations(shared), "block int, counts binary")
                  .repartition("block").sortWithinPartitions("block").mapInPandas(_summed, "block int, counts binary"))
        got = {r.block: np.frombuffer(bytes(r.counts)) for r in blocks.collect()}  # the model's size
        rest = got.pop(-1)
        emit = np.concatenate([got[i].reshape(-1, states) for i in sorted(got)])
        model = Model.from_counts(rest[:states], rest[states:2 * states], rest[2 * states:].reshape(states, states), emit, share)
        shared.destroy()
    return model


def log10_likelihood(model: Model, symbols: list[np.ndarray]) -> np.ndarray:
    """Exact, by the scaled forward recursion over all sequences at once."""
    sizes = np.array([len(s) for s in symbols])
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate(symbols).astype(np.int64)
    begin = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    total, state = np.zeros(len(order)), None
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left")
    for t, m in enumerate(active.tolist()):
        e = model.emit[flat[begin[:m] + t]]
        state = (model.first if t == 0 else state[:m] @ model.move) * e
        scale = state.sum(1)
        state = state / scale[:, None]
        total[:m] += np.log10(scale)
    out = np.empty(len(order))
    out[order] = total
    return out


SCORED = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("frequent_known", T.LongType()),
    T.StructField("frequent_base", T.DoubleType()), T.StructField("hidden", T.DoubleType()),
])


def _scored(shared_model, shared_vocabulary):
    @F.pandas_udf(SCORED)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, v = shared_model.value, shared_vocabulary.value
        n = len(v.symbol)
        base = np.log10((v.counts + 1) / (v.tokens + v.distinct + 1))
        known = v.counts > 0
        for batch in batches:
            symbols = [np.frombuffer(s, np.uint16) for s in batch]
            sizes = np.array([len(s) for s in symbols], np.int64)
            frequent_known, frequent_base = np.zeros(len(symbols), np.int64), np.zeros(len(symbols))
            for i, s in enumerate(symbols):
                frequent = s[s <= n]
                frequent_known[i], frequent_base[i] = known[frequent].sum(), base[frequent].sum()
            # By length, so that few blocks take the steps of a long text.
            order, hidden = np.argsort(-sizes, kind="stable"), np.zeros(len(symbols))
            for part in in_blocks(sizes[order].tolist(), BLOCK):
                hidden[order[part]] = log10_likelihood(model, [symbols[i] for i in order[part]])
            yield pd.DataFrame({"n_tokens": sizes, "frequent_known": frequent_known, "frequent_base": frequent_base, "hidden": hidden})
    return run


def score(docs: DataFrame, learn_from, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, learnt, n_tokens, n_known, train_tokens, base_score, score), a row per row of ``docs``.

    ``learn_from``: a condition on ``docs``; where it is true, the text is learnt (null counts as false).  Null texts are
    empty: only the end is scored.  Repeated rows count and are scored each.  An empty table gives no row; without a
    training row the words have no counts and the model starts from even shares.  A text of any length is scored by one
    recursion over all its tokens, and learnt in pieces that overlap.  Only ``key``, ``text`` and the columns of the condition are read.
    A word outside the training text is the one unseen word of its class.
    """
    learn_from = F.coalesce(learn_from, F.lit(False))
    learnt = docs.where(learn_from).select(F.col(text).alias("text"))
    counts = written(learnt.mapInPandas(_counted, "word binary, n long")
                     .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    v = vocabulary(counts, learnt.count())
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(v)  # WORDS words and CLASSES classes: a fixed size
    # The row numbers are drawn once, as the table is written.
    encoded = written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"),
                                  learn_from.alias("learnt"), _encoded(shared)(F.col(text)).alias("e"))
                      .select("row", "doc_id", "learnt", "e.*"), "symbols")
    model = train(encoded.where("learnt").select("symbols"), v)
    scored = encoded.select("row", "doc_id", "learnt",
                            _scored(context.broadcast(model), shared)("symbols").alias("s")).select("row", "doc_id", "learnt", "s.*")
    # Rare words: their counts by a join, their class's totals from a small table.
    classes = docs.sparkSession.createDataFrame(
        [(c, float(v.class_tokens[c] + v.class_distinct[c] + 1)) for c in range(CLASSES)], "class long, class_total double")
    rare = (encoded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r"))
            .select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
            .join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
            .withColumn("class", F.crc32(F.substring("word", -3, 3)) % CLASSES)
            .join(F.broadcast(classes), "class")
            .groupBy("row").agg(
                F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
                F.sum(F.col("times") * F.log10((F.col("n") + 1) / F.lit(float(v.tokens + v.distinct + 1)))).alias("rare_base"),
                F.sum(F.col("times") * F.log10((F.col("n") + 1) / F.col("class_total"))).alias("within")))
    none = F.lit(0)
    return (scored.join(rare, "row", "left")
            .select("doc_id", "learnt", "n_tokens",
                    (F.col("frequent_known") + F.coalesce("rare_known", none)).cast("long").alias("n_known"),
                    F.lit(v.tokens).cast("long").alias("train_tokens"),
                    (F.col("frequent_base") + F.coalesce("rare_base", none)).alias("base_score"),
                    (F.col("hidden") + F.coalesce("within", none)).alias("score")))

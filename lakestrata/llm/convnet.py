"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all its bytes.  Learned
filters run over the embedded bytes of each chunk and are max-pooled; the
text's probability comes from the mean and the maximum of its chunks' pools, and
its length.  The network is fitted to a bounded sample, as many texts of either label,
and corrected to the labels' share among all labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import in_blocks, sample_ids

#: Bytes of a chunk and those it shares with the next; bytes under a filter, and from one place to the next.
CHUNK, SHARED, WIDTH, STEP = 1024, 8, 8, 4
EMBEDDING, FILTERS, HIDDEN = 8, 48, 24
#: Training: texts of each label, and bytes of each text, at most.
TRAIN_DOCS, TRAIN_BYTES = 900, 6 * CHUNK
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.004, 5
#: Steps at least: a small sample is gone through more often.
MIN_STEPS = 240
#: Chunks run at once.
BLOCK = 512
#: Score from which label 1 is predicted.
THRESHOLD = 0.3

RESULT = T.DoubleType()


def chunks(raw: bytes) -> np.ndarray:
    """Rows of ``CHUNK`` bytes that cover ``raw``, each starting ``SHARED`` bytes before the last one's end; zeros fill up."""
    step = CHUNK - SHARED
    n = max(1, -(-(len(raw) - SHARED) // step))
    padded = np.zeros(n * step + SHARED, np.uint8)
    padded[:len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


class Network:
    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        normal = lambda *shape, by: r.normal(0, by, shape).astype(np.float32)
        self.w = {
            "E": normal(256, EMBEDDING, by=0.5),
            "C": normal(WIDTH * EMBEDDING, FILTERS, by=1 / np.sqrt(WIDTH * EMBEDDING)),
            "c": np.zeros(FILTERS, np.float32),
            "H": normal(2 * FILTERS + 1, HIDDEN, by=1 / np.sqrt(2 * FILTERS)),
            "h": np.zeros(HIDDEN, np.float32),
            "o": normal(HIDDEN, by=1 / np.sqrt(HIDDEN)),
            "b": np.zeros(1, np.float32),
        }
        self.w["E"][0] = 0
        self.shift = 0.0  # from the sample's label shares to those of all

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Max-pooled filters of each chunk, and the place of each maximum."""
        e = self.w["E"][x].reshape(len(x), -1)
        wide, step = WIDTH * EMBEDDING, STEP * EMBEDDING
        places = np.lib.stride_tricks.sliding_window_view(e, wide, axis=1)[:, ::step]
        z = np.ascontiguousarray(places).reshape(-1, wide) @ self.w["C"]
        z = z.reshape(len(x), -1, FILTERS)
        at = z.argmax(1)
        return np.maximum(np.take_along_axis(z, at[:, None], 1)[:, 0] + self.w["c"], 0), at

    def heads(self, pool: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Logits of texts from their chunks' pools; ``owner``: text of each chunk, ascending from 0."""
        n = len(sizes)
        begin = np.searchsorted(owner, np.arange(n))
        count = np.bincount(owner, minlength=n)[:, None]
        mean = np.add.reduceat(pool, begin) / count
        most = np.maximum.reduceat(pool, begin)
        features = np.concatenate([mean, most, np.log1p(sizes)[:, None] / 8], 1).astype(np.float32)
        hidden = np.maximum(features @ self.w["H"] + self.w["h"], 0)
        return hidden @ self.w["o"] + self.w["b"], hidden, features, count

    def gradients(self, x: np.ndarray, owner: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        pool, at = self.pooled(x)
        logit, hidden, features, count = self.heads(pool, owner, sizes)
        d = ((1 / (1 + np.exp(-logit)) - y) / len(y)).astype(np.float32)
        g = {"o": hidden.T @ d, "b": d.sum(keepdims=True)}
        dh = d[:, None] * self.w["o"] * (hidden > 0)
        g["H"], g["h"] = features.T @ dh, dh.sum(0)
        df = dh @ self.w["H"].T
        is_most = pool == np.maximum.reduceat(pool, np.searchsorted(owner, np.arange(len(sizes))))[owner]
        dp = (df[:, :FILTERS] / count)[owner] + df[:, FILTERS:2 * FILTERS][owner] * is_most
        dp = dp * (pool > 0)
        g["c"] = dp.sum(0)
        # A filter's gradient reaches the one place of its maximum.
        seen = x[np.arange(len(x))[:, None, None], at[:, :, None] * STEP + np.arange(WIDTH)]  # chunk, filter, byte
        e = self.w["E"][seen].reshape(len(x), FILTERS, -1)
        g["C"] = np.einsum("nf,nfk->kf", dp, e)
        de = (dp[:, :, None] * self.w["C"].T[None]).reshape(-1, EMBEDDING)
        g["E"] = np.zeros_like(self.w["E"])
        np.add.at(g["E"], seen.reshape(-1), de)
        g["E"][0] = 0
        return g

    def fit(self, texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
        r = np.random.default_rng(seed)
        parts, y = [chunks(t[:TRAIN_BYTES]) for t in texts], y.astype(np.float32)
        sizes = np.array([min(len(t), TRAIN_BYTES) for t in texts], np.float64)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        batches = -(-len(y) // BATCH)
        epochs = max(epochs, -(-MIN_STEPS // batches))
        step, steps = 0, epochs * batches
        for _ in range(epochs):
            order = r.permutation(len(y))
            for a in range(0, len(y), BATCH):
                pick = order[a:a + BATCH]
                owner = np.repeat(np.arange(len(pick)), [len(parts[i]) for i in pick])
                step += 1
                rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
                for k, g in self.gradients(np.concatenate([parts[i] for i in pick]), owner, sizes[pick], y[pick]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.w[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1, over all bytes of each text."""
        parts = [chunks(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        x = np.concatenate(parts)
        pool = np.concatenate([self.pooled(x[a:a + BLOCK])[0] for a in range(0, len(x), BLOCK)])
        # Lengths beyond those trained on count as the longest.
        logit = self.heads(pool, owner, np.minimum([len(t) for t in texts], TRAIN_BYTES))[0]
        return 1 / (1 + np.exp(-(logit.astype(np.float64) + self.shift)))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Network | float:
    """A network fitted to at most ``TRAIN_DOCS`` labelled texts of each label, those whose key has the lowest hash.

    Where only one label is seen the result is its value, and 0.5 where none is.  Rows with a null key or label aren't
    labelled; labels without a document don't count in the sample.
    """
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)")
    share = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    # Twice the number, as some labels may have no document.
    ids = sample_ids(known, "y", "k", 2 * TRAIN_DOCS)
    rows = (docs.select(F.col(key).alias("k"), F.substring(F.coalesce(F.col(text), F.lit("")), 1, TRAIN_BYTES).alias("t"))
            .join(F.broadcast(ids), "k").select("k", "t", "y").collect())
    rows.sort(key=lambda r: (_order(r.k), r.y, r.t))
    picked = [[r for r in rows if r.y == y][:TRAIN_DOCS] for y in (0, 1)]
    if not picked[0] or not picked[1]:
        return 0.5 if not picked[0] and not picked[1] else float(bool(picked[1]))
    sample = picked[0] + picked[1]
    net = Network().fit([r.t.encode("utf-8", "surrogatepass") for r in sample], np.array([r.y for r in sample]))
    net.shift = float(np.log(share[1] / share[0]) - np.log(len(picked[1]) / len(picked[0])))
    return net


def _order(key) -> tuple:
    import zlib
    return zlib.crc32(str(key).encode()), str(key)


def with_quality(df: DataFrame, model: Network | float, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with a column ``out``: the probability of label 1.

    One row per input row, all columns kept; a column named ``out`` is replaced.  A null text is scored as an empty one, by its one chunk of
    zeros.  Texts of any length are read whole.  Where ``model`` is a number, that is every score.
    """
    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            raw = [t.encode("utf-8", "surrogatepass") for t in batch.where(batch.notna(), "")]
            out = [np.full(len(raw), model)] if isinstance(model, float) else [
                model.scores(raw[part]) for part in in_blocks([len(t) + CHUNK for t in raw], 8_000_000)]
            yield pd.Series(np.concatenate(out) if out else [], dtype="float64")

    return df.withColumn(out, run(F.col(text)))

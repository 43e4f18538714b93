import math
import random

import numpy as np

from lakestrata.llm import convnet as C
from tests.llm.frames import CLASHING, by_id, edge_rows, edges, empty, frame, prose


def test_chunks_cover_every_byte_and_overlap():
    for n in (0, 1, C.CHUNK - 1, C.CHUNK, C.CHUNK + 1, 5 * C.CHUNK + 17):
        raw = bytes(random.Random(n).randrange(1, 256) for _ in range(n))
        x = C.chunks(raw)
        joined = bytes(x[0]) + b"".join(bytes(p[C.SHARED:]) for p in x[1:])
        assert joined.rstrip(b"\0") == raw and x.shape[1] == C.CHUNK
        assert all((a[-C.SHARED:] == b[:C.SHARED]).all() for a, b in zip(x, x[1:]))


def test_gradients_are_those_of_the_loss():
    net = C.Network(seed=1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    texts = [prose(i, 60 + 200 * (i % 2)).encode() for i in range(4)]
    parts = [C.chunks(t) for t in texts]
    owner = np.repeat(np.arange(4), [len(p) for p in parts])
    x, sizes, y = np.concatenate(parts), np.array([len(t) for t in texts], float), np.array([1, 0, 1, 0], np.float32)

    def loss():
        logit = net.heads(net.pooled(x)[0], owner, sizes)[0].astype(np.float64)
        return float(np.mean(np.log1p(np.exp(logit)) - y * logit))
    for name, g in net.gradients(x, owner, sizes, y).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        value, step, seen = net.w[name][at], 1e-3, []
        for s in (step, -step):
            net.w[name][at] = value + s
            seen.append(loss())
        net.w[name][at] = value
        assert abs((seen[0] - seen[1]) / (2 * step) - g[at]) < 2e-3 + 0.1 * abs(g[at]), name


def junk(seed, n):
    return " ".join(w + "%%" for w in prose(seed, n).split())


def test_held_out_accuracy(spark):
    rows = [(i, junk(i, 80) if i % 4 == 0 else prose(i, 80)) for i in range(160)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(100)] + [(None, 1), (7777, 0), (3, None)],
                                   "doc_id long, quality int")
    model = C.train(frame(spark, rows), labels)
    got = by_id(C.with_quality(frame(spark, rows), model, out="p"), "p")
    right = [(got[i][0][0] >= 0.3) == (i % 4 != 0) for i in range(100, 160)]
    assert sum(right) >= 57
    far = prose(1, 4000) + " " + junk(2, 2500)  # junk far beyond what training reads still counts
    assert model.scores([far.encode()])[0] < model.scores([prose(1, 6500).encode()])[0]


def test_scores_dont_depend_on_the_batch(spark):
    net = C.Network()
    texts = [prose(i, 20 + 150 * i).encode() for i in range(6)] + [b""]
    together = net.scores(texts)
    assert np.allclose(together, [net.scores([t])[0] for t in texts], atol=1e-5)


def test_edges(spark):
    df, net = edges(spark), C.Network()
    got = C.with_quality(df, net, out="p")
    assert set(CLASHING) <= set(got.columns) and got.count() == df.count()
    rows = by_id(got, "p")
    assert all(0 <= p <= 1 and math.isfinite(p) for v in rows.values() for p, in v)
    assert rows[1] == rows[2] and set(rows[5]) >= set(rows[6])
    replaced = by_id(C.with_quality(df, net, out="score"), "score")
    assert replaced == rows


def test_one_label_no_label_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(5, 1), (6, 1)], "doc_id long, quality int")
    assert C.train(edges(spark), none) == 0.5 and C.train(edges(spark), one) == 1.0
    assert C.with_quality(edges(spark), 0.5).count() == len(edge_rows())
    assert C.with_quality(empty(spark), C.Network()).count() == 0

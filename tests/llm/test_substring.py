import random

import numpy as np

from lakestrata.llm import substring as S
from tests.llm.frames import CLASHING, by_id, edge_rows, edges, empty, frame, prose


def brute(rows, span=50):
    """(kept text, words, removed) per row, from all windows of all rows with an id."""
    first = {}
    words = [((t or "").encode().split(), k) for k, t, *_ in rows]
    for w, k in words:
        if k is not None:
            for i in range(len(w) - span + 1):
                s = tuple(w[i:i + span])
                first[s] = min(first.get(s, k), k)
    out = []
    for w, k in words:
        gone = [False] * len(w)
        if k is not None:
            for i in range(len(w) - span + 1):
                if first[tuple(w[i:i + span])] < k:
                    gone[i:i + span] = [True] * span
        out.append((k, (b" ".join(x for x, g in zip(w, gone) if not g).decode(), len(w), sum(gone))))
    want = {}
    for k, v in out:
        want.setdefault(k, []).append(v)
    return {k: sorted(v) for k, v in want.items()}


def got_of(df):
    return {k: sorted(v) for k, v in by_id(S.without_repeats(df), "unrepeated.kept_text", "unrepeated.n_words",
                                           "unrepeated.n_removed").items()}


def corpus():
    rnd = random.Random(1)
    shared = [prose(1000 + i, 55 + 9 * i) for i in range(4)]
    rows = []
    for i in range(40):
        parts = [prose(i, rnd.randint(0, 120))]
        if i % 3 == 0:
            parts += [rnd.choice(shared), prose(500 + i, rnd.randint(0, 40))]
        if i % 7 == 0:
            parts += [prose(3, 120)]
        if i % 11 == 0:
            parts += parts[:1] * 2  # repeats inside one document
        rows.append((i * 3 % 41, "\n ".join(parts)))
    return rows + [(50, prose(7, 49)), (51, prose(7, 49)), (52, prose(8, 50)), (53, prose(8, 50))]


def test_as_brute_force(spark):
    assert got_of(frame(spark, corpus())) == brute(corpus())


def test_crowded_sketch_loses_nothing(spark, monkeypatch):
    # All windows fall in a few cells, so that all are estimated repeated.
    monkeypatch.setattr(S, "cells", lambda high, low: [(h % np.uint64(16)).astype(np.uint32) for h in (high, low)])
    rows = corpus()[:12]
    _, _, high, low = S.fingerprints([t for _, t in rows])
    planes = [np.zeros(S.WIDTH // 8, np.uint8) for _ in range(2)]
    for p, c in zip(planes, S.cells(high, low)):
        np.bitwise_or.at(p, c >> np.uint32(3), np.uint8(1) << (c & np.uint32(7)).astype(np.uint8))
    assert S.estimated_repeated(planes, high, low).all()


def test_sketch_never_underestimates():
    import pandas as pd
    texts = [t for _, t in corpus()]
    parts = pd.concat([x for i in range(0, len(texts), 7) for x in S._counted(iter([pd.DataFrame({"text": texts[i:i + 7]})]))])
    parts = parts.sort_values(["row", "block"], kind="stable")
    merged = pd.concat(list(S._merged(iter([parts[:5], parts[5:]]))))

    class Shared:
        value = list(merged.itertuples(index=False, name=None))
    _, _, high, low = S.fingerprints(texts)
    marked = S.estimated_repeated(S._planes(Shared), high, low)
    _, inverse, times = np.unique(high, return_inverse=True, return_counts=True)
    repeated = times[inverse] > 1
    assert marked[repeated].all() and marked.sum() < repeated.sum() + 20


def test_fingerprints_tell_windows_apart():
    w = ["a", "b"] * 40 + ["c"] + ["b", "a"] * 40
    _, start, high, low = S.fingerprints([" ".join(w), "\n".join(w[1:]), None])
    rows = [tuple(w[i:i + 50]) for i in range(len(w) - 49)] + [tuple(w[1:][i:i + 50]) for i in range(len(w) - 50)]
    for i in range(len(rows)):
        for j in range(i):
            assert (rows[i] == rows[j]) == (high[i] == high[j] and low[i] == low[j])
    assert start[0] == 0


def test_edges(spark):
    df = edges(spark)
    out = S.without_repeats(df)
    assert set(CLASHING) - {"unrepeated"} <= set(out.columns) and out.count() == df.count()
    assert got_of(df) == brute(edge_rows())


def test_empty_table(spark):
    assert S.without_repeats(empty(spark)).count() == 0


def test_sketch_goes_in_few_rows():
    import pandas as pd
    batches = [pd.DataFrame({"text": [prose(100 * k + i, 400) for i in range(20)]}) for k in range(6)]
    sent = pd.concat(list(S._counted(iter(batches))))
    assert len(sent) > 10_000 and not sent.duplicated(["row", "block"]).any()


def test_tasks_hold_little(spark):
    # Batches of a bounded size, and nothing that outlives a task in its worker.
    import pandas as pd

    from lakestrata.llm import common as C
    before = spark.conf.get(C._BATCH_CONF)
    spark.conf.set(C._BATCH_CONF, str(C.SPARKS_BATCH))
    try:
        S.without_repeats(frame(spark, corpus()[:3]))
        assert spark.conf.get(C._BATCH_CONF) == str(C.BATCH_BYTES)
    finally:
        spark.conf.set(C._BATCH_CONF, before)
    assert list(S._counted(iter([pd.DataFrame({"text": [prose(1, 100)]})]))) and not C._POWERS

    class Shared:
        value: list = []
    assert list(S._repeated(Shared)(iter([pd.DataFrame({"id": [1], "text": [prose(1, 100)]})]))) and not C._POWERS

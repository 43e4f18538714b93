import itertools
import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lakestrata.llm import hmm as H
from tests.llm.frames import CLASHING, edge_rows, edges, empty, frame, prose


def random_model(symbols=6, states=3, seed=0):
    r = np.random.default_rng(seed)
    spread = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(r.random(s))
    return H.Model(spread(states), spread(states), spread(states, states), spread(states, symbols).T)


def brute_likelihood(m, s):
    total = 0.0
    for path in itertools.product(range(len(m.first)), repeat=len(s)):
        p = m.first[path[0]] * m.emit[s[0], path[0]]
        for a, b, x in zip(path, path[1:], s[1:]):
            p *= m.move[a, b] * m.emit[x, b]
        total += p
    return total


def test_forward_is_the_sum_over_all_paths():
    m = random_model()
    sequences = [np.array(s, np.uint16) for s in ([1, 2, 3, 0], [5], [0, 0, 0, 0, 0, 1], [4, 4])]
    got = H.log10_likelihood(m, sequences)
    assert np.allclose(got, [math.log10(brute_likelihood(m, s)) for s in sequences])


def test_all_sequences_of_a_length_add_up_to_one():
    m = random_model()
    total = sum(10 ** H.log10_likelihood(m, [np.array(s, np.uint16)])[0] for s in itertools.product(range(6), repeat=3))
    assert abs(total - 1) < 1e-9


def test_expected_counts_as_brute_force():
    m, pieces = random_model(seed=3), [np.array([1, 2, 0, 3]), np.array([4, 1]), np.array([5, 5, 1])]
    starts = np.array([True, False, True])
    first, average, move, emit = np.zeros(3), np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))
    for s, begins in zip(pieces, starts):
        paths, weights = list(itertools.product(range(3), repeat=len(s))), []
        for path in paths:
            p = (m.first if begins else m.average)[path[0]] * m.emit[s[0], path[0]]
            for a, b, x in zip(path, path[1:], s[1:]):
                p *= m.move[a, b] * m.emit[x, b]
            weights.append(p)
        for path, w in zip(paths, np.array(weights) / sum(weights)):
            first[path[0]] += w * begins
            for k, x in zip(path, s):
                emit[x, k] += w
                average[k] += w
            for a, b in zip(path, path[1:]):
                move[a, b] += w
    for got, want in zip(H.expected(m, pieces, starts), (first, average, move, emit)):
        assert np.allclose(got, want, atol=1e-4)


def test_pieces_with_context_count_as_the_whole_text(monkeypatch):
    monkeypatch.setattr(H, "PIECE", 40)
    r = np.random.default_rng(5)
    m, texts = random_model(symbols=6, states=3, seed=3), [r.integers(0, 6, n).astype(np.uint16) for n in (1, 40, 41, 333, 79)]
    pieces, starts, inner = H.pieces_of(texts)
    assert sum(b - a for a, b in inner) == sum(map(len, texts)) and starts.sum() == len(texts)
    whole = H.expected(m, texts, np.ones(len(texts), bool))
    for got, want in zip(H._add(None, texts, m), whole, strict=True):
        assert np.allclose(got, want, atol=0.01)
    assert abs(H._add(None, texts, m)[2].sum() - sum(len(t) - 1 for t in texts)) < 0.01  # each transition once


def encoded(spark, texts):
    return spark.createDataFrame([(bytearray(t.tobytes()),) for t in texts], "symbols binary")


def test_sample_is_distinct_pieces_of_bounded_number_from_all_places(spark):
    r = np.random.default_rng(5)
    long, copy = r.integers(0, 2000, 200_000).astype(np.uint16), r.integers(0, 2000, 300).astype(np.uint16)
    df = encoded(spark, [long, *[copy] * 500])
    pieces, starts, inner = H.sample_of(df, 100)
    assert 30 < len(pieces) < 150 and len(starts) == len(inner) == len(pieces)
    text = long.tobytes()
    places = [text.find(p.tobytes()) / len(text) for p in pieces if len(p) > 300]
    assert min(places) < 0.2 and max(places) > 0.8
    assert len(H.sample_of(df, 10**6)[0]) == -(-200_000 // H.PIECE) + 2
    assert H.sample_of(encoded(spark, []), 10)[0] == []


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    rows = [(i, prose(i, 5 + i * 7 % 90)) for i in range(60)]
    whole = {r.doc_id: r.score for r in H.score(frame(spark, rows), F.col("doc_id") % 5 != 0).collect()}
    for name in ("BLOCK", "TEXT_BLOCK"):
        monkeypatch.setattr(H, name, 70)
    parts = {r.doc_id: r.score for r in H.score(frame(spark, rows), F.col("doc_id") % 5 != 0).collect()}
    assert whole.keys() == parts.keys() and all(abs(whole[k] - parts[k]) < 0.01 for k in whole)


def test_training_rounds_raise_the_likelihood():
    s = [np.array([i % 5 if k % 2 else 5 for i in range(30)], np.uint16) for k in range(20)]
    share = np.full(6, 1 / 6)
    m, scores = random_model(seed=1), []
    for _ in range(6):
        scores.append(H.log10_likelihood(m, s).sum())
        m = H.Model.from_counts(*H._add(None, s, m), share)
    assert scores[-1] > scores[0] and all(b > a - 30 for a, b in zip(scores, scores[1:]))


def brute_base(rows, learnt):
    tokens = [[w.lower() for w in (t or "").encode().split()] for _, t, *_ in rows]
    c, ends = Counter(), 0
    for w, ok in zip(tokens, learnt):
        if ok:
            c.update(w)
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    out = {}
    for (k, *_), w, ok in zip(rows, tokens, learnt):
        score = sum(math.log10((x + 1) / (n + v + 1)) for x in [*(c[t] for t in w), ends])
        out.setdefault(k, []).append((ok, len(w) + 1, sum(c[t] > 0 for t in w) + (ends > 0), n, round(score, 6)))
    return {k: sorted(x) for k, x in out.items()}


def got_base(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append((r.learnt, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
    return {k: sorted(x) for k, x in out.items()}


def test_base_and_better_than_base(spark):
    rows = [(i, (prose(i, 60, "yy") if i % 2 else prose(i, 60)).upper() if i % 5 == 0 else prose(i, 60, "yy" if i % 2 else "xx"))
            for i in range(120)]
    learnt = [zlib.crc32(str(k).encode()) % 7 != 2 for k, _ in rows]
    got = H.score(frame(spark, rows), F.crc32(F.col("doc_id").cast("string")) % 7 != 2)
    assert got_base(got) == brute_base(rows, learnt)
    held = got.where("not learnt").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_rare_words_go_by_the_join(spark, monkeypatch):
    monkeypatch.setattr(H, "WORDS", 5)
    monkeypatch.setattr(H, "SYMBOL_BLOCK", 100)
    rows = [(i, prose(i % 9, 30)) for i in range(30)] + [(99, "neverseen ka ka")]
    got = H.score(frame(spark, rows), F.col("doc_id") < 25)
    assert got_base(got) == brute_base(rows, [k < 25 for k, _ in rows])


def test_edges(spark):
    df = edges(spark)
    got = H.score(df, F.col("doc_id") != 5)
    assert got_base(got) == brute_base(edge_rows(), [k is not None and k != 5 for k, *_ in edge_rows()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in got.collect())
    assert set(CLASHING) <= set(df.columns)


def test_nothing_learnt_and_empty_tables(spark):
    got = H.score(frame(spark, [(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert len(got) == 2 and {(r.n_known, r.train_tokens) for r in got} == {(0, 0)} and all(math.isfinite(r.score) for r in got)
    assert H.score(empty(spark), F.lit(True)).count() == 0

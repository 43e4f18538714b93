import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import resample as R
from tests.llm.frames import CLASHING, edge_rows, edges, empty, frame, prose


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]


def features(text, runs):
    w = words(text)
    return [b" ".join(w[i:i + n]) for n in range(1, runs + 1) for i in range(len(w) - n + 1)]


def plainly(rows, target, runs=1, buckets=10_000, seed=2024, least=20, percent=10):
    """[(doc_id, n_features, weight, score, rank)] by sorting in one place; rows of (doc_id, text)."""
    of = lambda f: zlib.crc32(f) % buckets
    s = Counter(of(f) for _, t in rows for f in features(t, runs))
    t = Counter(of(f) for x in target for f in features(x, runs))
    total_s, total_t, out = sum(s.values()), sum(t.values()), []
    for doc_id, text in rows:
        found = features(text, runs)
        gains = [math.floor(1000 * math.log((t[of(f)] + 1) * (total_s + buckets) / ((s[of(f)] + 1) * (total_t + buckets)))) for f in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def corpus(n):
    rnd = random.Random(3)
    return [(i * 7919 % 100_003 - 500, prose(i, rnd.randint(0, 60), rnd.choice(("xx", "yy"))).title()) for i in range(n)]


@pytest.mark.parametrize("runs, buckets, percent", [(1, 10_000, 10), (3, 500, 35), (1, 1, 100)])
def test_as_sorting_in_one_place(spark, runs, buckets, percent):
    rows, target = corpus(400), [prose(i, 30) for i in range(5)] + [None, ""]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    df = R.resampled(frame(spark, rows), bench, runs=runs, buckets=buckets, percent=percent)
    assert got(df) == plainly(rows, target, runs, buckets, percent=percent)


def test_draws_follow_the_target(spark):
    rows = [(i, prose(i, 40, "xx" if i % 2 else "yy")) for i in range(400)]
    bench = spark.createDataFrame([(prose(900 + i, 60, "yy"),) for i in range(20)], "text string")
    drawn = [r.doc_id for r in R.resampled(frame(spark, rows), bench).where("rank is not null").collect()]
    assert len(drawn) == 40 and sum(i % 2 == 0 for i in drawn) >= 30  # a draw by chance: even shares would give 20


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    bench = spark.createDataFrame([(prose(3, 60, "yy"),)], "text string")
    df = R.resampled(edges(spark), bench, percent=100)
    want = plainly(rows, [prose(3, 60, "yy")], percent=100)
    # Rows of equal id and score may stand in either order.
    strip = lambda rs: sorted(((a, b, c, d) for a, b, c, d, _ in rs), key=str)
    assert strip(got(df)) == strip(want) and sorted(str(r[4]) for r in got(df)) == sorted(str(r[4]) for r in want)
    ranked = sorted((r for r in got(df) if r[4]), key=lambda r: r[4])
    keys = [(-r[3], r[0] is None, r[0] or 0) for r in ranked]
    assert keys == sorted(keys) and [r[4] for r in ranked] == list(range(1, len(ranked) + 1))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert R.resampled(empty(spark), none).count() == 0
    rows = corpus(60)
    assert got(R.resampled(frame(spark, rows), none, percent=50)) == plainly(rows, [], percent=50)


def test_keys_must_be_integers(spark):
    with pytest.raises(TypeError):
        R.resampled(edges(spark), edges(spark), key="source")


def ranks(spark, rows, schema, keys, parts=5):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row long, " + schema).repartition(parts, F.col("row") % 7)
    out, n = R.radix_ranked(df, keys)
    assert n == len(rows)
    return [r.row for r in out.orderBy("rank").collect()], sorted(r.rank for r in out.collect())


@pytest.mark.parametrize("bits", [3, 12])
def test_radix_sort_of_any_longs(spark, monkeypatch, bits):
    monkeypatch.setattr(R, "PART_BITS", (3, 5))
    monkeypatch.setattr(R, "DIGIT_BITS", 12 if bits == 12 else 8)
    rnd = random.Random(bits)
    edge = [-(1 << 63), (1 << 63) - 1, 0, -1, 1, None]
    rows = [(rnd.choice(edge) if rnd.random() < 0.2 else rnd.randint(-(1 << 62), 1 << 62), rnd.choice([None, rnd.randint(-50, 50)]))
            for _ in range(150)]
    for falling in (False, True):
        order, numbers = ranks(spark, rows, "a long, b long", [("b", falling), ("a", not falling)])
        sign = lambda x, down: (x is None, 0 if x is None else -x if down else x)
        assert order == sorted(range(150), key=lambda i: (sign(rows[i][1], falling), sign(rows[i][0], not falling), i))
        assert numbers == list(range(1, 151))


def test_radix_sort_is_stable_and_spreads_a_hot_digit(spark, monkeypatch):
    monkeypatch.setattr(R, "PART_BITS", (4, 4))
    rows = [(5 if i % 3 else i,) for i in range(300)]
    order, _ = ranks(spark, rows, "a long", [("a", False)])
    assert order == sorted(range(300), key=lambda i: (rows[i][0], i))
    assert ranks(spark, [(9,)] * 50, "a long", [("a", True)])[0] == list(range(50))
    df = spark.range(300).selectExpr("id as row", "shiftright(id, 4) as part", "id as place", "5L as a")
    parts = R.radix_pass(df, "a", 0, 3, 4).groupBy("part").count().collect()
    assert max(r["count"] for r in parts) == 16 and len(parts) == 19


def test_no_rows(spark):
    df = spark.createDataFrame([], "row long, a long")
    assert R.radix_ranked(df, [("a", False)])[0].count() == 0


def test_digits_cover_the_varying_bits():
    assert R.digits([("a", 15), ("b", 18)]) == [("b", 0, 9), ("b", 9, 9), ("a", 0, 7), ("a", 7, 8)]
    assert R.digits([("a", 0), ("b", 1)]) == [("b", 0, 1)]
    for bits in range(1, 65):
        parts = R.digits([("a", bits)])
        assert sum(n for *_, n in parts) == bits and all(0 < n <= R.DIGIT_BITS for *_, n in parts)


def test_extra_columns_do_not_matter(spark):
    rows = corpus(50)
    df = frame(spark, rows)
    assert set(CLASHING) <= set(df.columns)
    bench = spark.createDataFrame([("a", "b")], "text string, weight string")
    assert got(R.resampled(df, bench)) == plainly(rows, ["a"])


def test_buckets_remember_a_bounded_number(monkeypatch):
    monkeypatch.setattr(R, "REMEMBERED", 5)
    b = R.Buckets(100, 2)
    w = [f"w{i}".encode() for i in range(30)]
    assert b.of(w).tolist() == [zlib.crc32(x) % 100 for x in w] + [zlib.crc32(x + b" " + y) % 100 for x, y in zip(w, w[1:], strict=False)]
    assert len(b) <= 5 and b.of([]).tolist() == [] and b.of([b"x"]).tolist() == [zlib.crc32(b"x") % 100]
    assert np.array_equal(R.gains(np.zeros(4, np.int64), np.zeros(4, np.int64)), np.zeros(4))

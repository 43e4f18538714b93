import itertools
from collections import Counter

import numpy as np

from lakestrata.llm import neardup as N
from tests.llm.frames import CLASHING, by_id, edges, empty, frame, prose


def shingle_counts(text):
    w = (text or "").encode().split()
    if len(w) < 5:
        return Counter([tuple(w)]) if w else Counter()
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def probability_jaccard(a, b):
    both = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in both) for i in set(a) & set(b))


def brute_classes(rows):
    counts = [shingle_counts(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        if counts[i] and counts[j] and probability_jaccard(counts[i], counts[j]) >= 0.8:
            root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return {frozenset(g) for g in groups.values()}


def changed(text, at):
    w = text.split()
    for i in at:
        w[i] = "changed" + str(i)
    return " ".join(w)


def corpus():
    rows, n = [], 0
    for seed in range(12):
        base = prose(seed, 150 + 10 * seed)
        for at in ([], [], [3], [40, 100], [10, 60, 110], range(0, 150, 4)):
            rows.append((n, changed(base, at)))
            n += 1
    rows += [(n, " ".join([prose(50, 30)] * 4)), (n + 1, " ".join([prose(50, 30)] * 4) + " end"), (n + 2, "one two"),
             (n + 3, "one  two"), (n + 4, "one two three")]
    return rows


def test_classes_as_brute_force(spark):
    rows = corpus()
    got = by_id(N.classes(frame(spark, rows)), "class_id", "class_size")
    groups = {}
    for k, [(c, size)] in got.items():
        groups.setdefault(c, []).append((k, size))
    assert {frozenset(k for k, _ in g) for g in groups.values()} == brute_classes(rows)
    assert all(c == min(k for k, _ in g) and {s for _, s in g} == {len(g)} for c, g in groups.items())


def grouped(got):
    groups = {}
    for k, [(c,)] in got.items():
        groups.setdefault(c, set()).add(k)
    return {frozenset(g) for g in groups.values()}


def test_large_bucket_is_closed_without_all_pairs(spark, monkeypatch):
    base, pairs = prose(7, 200), []
    rows = [(0, base)] + [(1 + i, changed(base, [i % 190, (3 * i) % 190])) for i in range(60)]  # linked to the base
    rows += [(200 + i, changed(base, range(i % 9, 190, 9))) for i in range(40)]  # close to it, but not enough
    rows += [(300 + i, changed(changed(base, range(4, 190, 9)), [i])) for i in range(3)]  # near each other only
    verify = N._Groups.verify
    monkeypatch.setattr(N._Groups, "verify", lambda self, p: (pairs.append(p.count()), verify(self, p))[1])
    monkeypatch.setattr(N, "PAIRED", 4)
    monkeypatch.setattr(N, "ROWS", 2)
    got = by_id(N.classes(frame(spark, rows)), "class_id")
    assert grouped(got) == brute_classes(rows)
    assert sum(pairs) < len(rows) * (len(rows) - 1) / 2 / 3


def test_signatures_estimate_probability_jaccard():
    texts = [prose(1, 400), changed(prose(1, 400), range(0, 60, 6)), " ".join([prose(2, 40)] * 5 + [prose(1, 300)])]
    sets = N.shingles(texts)
    sig = N.signatures(sets, 2000)
    for i, j in itertools.combinations(range(3), 2):
        want = probability_jaccard(shingle_counts(texts[i]), shingle_counts(texts[j]))
        assert abs(N.similarity(sets[i], sets[j]) - want) < 1e-9
        assert abs((sig[i] == sig[j]).mean() - want) < 0.05


def test_signature_doesnt_depend_on_the_block():
    sets = N.shingles([prose(s, 20 + 30 * s) for s in range(6)])
    together = N.signatures(sets, 100)
    assert all((together[i] == N.signatures([s], 100)[0]).all() for i, s in enumerate(sets))
    s = N.unpacked(N.packed(*sets[3]))
    assert (s[0] == sets[3][0]).all() and (s[1] == sets[3][1]).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in N.components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert N.components(df.limit(0)).count() == 0


def test_edges(spark):
    got = by_id(N.classes(edges(spark)), "class_id", "class_size")
    # Rows 5 (twice), 6 and the one without an id hold one text; its upper-case form is another.
    assert sorted(got[5]) == [(5, 1), (5, 4), (5, 4)] and got[6] == [(5, 4)] and got[10] == [(10, 1)]
    assert sorted(got[None], key=str) == [(5, 4), (None, 1)]
    assert got[1] == [(1, 1)] and got[2] == [(2, 1)] and got[3] == [(3, 1)]
    kept = N.one_of_each(edges(spark))
    assert set(CLASHING) <= set(kept.columns)
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 5, 7, 8, 9, 10, 11]


def test_empty_table(spark):
    assert N.classes(empty(spark)).count() == 0 and N.one_of_each(empty(spark)).count() == 0
    assert np.array_equal(N.shingles([None, ""])[0][0], np.zeros(0))


def hot_passage(n, planted):
    """n texts that share a passage at about 0.75, and near copies, at 0.80 to 0.86, of the first ``planted``."""
    passage = prose(1000, 170)
    texts = [passage + " " + prose(2000 + i, 26, "yy") for i in range(n)]
    return texts, [changed(t, [20 + 13 * (i % 5) + 30 * k for k in range(3 + i % 2)]) for i, t in enumerate(texts[:planted])]


def test_near_copies_among_texts_of_a_hot_passage(spark):
    texts, copies = hot_passage(260, 60)
    ground = [probability_jaccard(shingle_counts(texts[i]), shingle_counts(texts[i + 1])) for i in range(0, 200, 10)]
    near = [probability_jaccard(shingle_counts(a), shingle_counts(b)) for a, b in zip(texts, copies)]
    assert 0.7 < min(ground) and max(ground) < 0.8 <= min(near) and max(near) < 0.87
    rows = list(enumerate(texts)) + [(1000 + i, t) for i, t in enumerate(copies)]
    got = by_id(N.classes(frame(spark, rows)), "class_id")
    caught = sum(got[1000 + i] == got[i] for i in range(60))
    assert caught >= 54, caught
    assert all(got[i] == [(i,)] for i in range(260))  # nothing else is joined


def test_pairs_of_a_hot_passage_grow_with_the_texts(spark, monkeypatch):
    seen, verify = [], N._Groups.verify

    def counted(self, pairs):
        seen[-1] += pairs.count()
        return verify(self, pairs)
    monkeypatch.setattr(N._Groups, "verify", counted)
    for n, hot in ((120, N.HOT), (360, N.HOT), (360, None)):
        seen.append(0)
        N.text_groups(frame(spark, list(enumerate(hot_passage(n, 0)[0]))), hot=hot).count()
    assert seen[1] < 5 * seen[0] and seen[1] < seen[2] / 2, seen


def test_deep_bands_are_of_the_whole_multiset():
    a, b = (N.shingles([prose(1, 200)])[0], N.shingles([prose(2, 200)])[0])
    same = N.deep_bands([a, b, a])
    assert same.shape == (3, N.TREES, len(N.LEVELS)) and (same[0] == same[2]).all() and (same[0] != same[1]).all()
    near = N.deep_bands([a, N.shingles([changed(prose(1, 200), [50, 120])])[0]])
    agree = (near[0] == near[1]).mean(0)
    assert agree[0] > agree[-1] and 0.2 < agree[0] < 0.9


def test_no_pair_of_a_hot_passage_is_lost(spark, monkeypatch):
    texts, _ = hot_passage(40, 0)
    copies = [changed(t, [20 + 13 * (i % 5) + 30 * k for k in range(4)]) for i, t in enumerate(texts)]  # as unlike as near copies can be
    rows = list(enumerate(texts)) + [(1000 + i, t) for i, t in enumerate(copies)]
    monkeypatch.setattr(N, "BLOCK_TEXTS", 30)
    nodes = spark.createDataFrame([(t, str(i).encode()) for i, t in rows], "text string, node binary").coalesce(1)
    g = N._Groups.__new__(N._Groups)
    g.least, g.hot = N.SIMILARITY, 8
    g.shingled = nodes.select("node", N._packed_shingles("text").alias("blob"))
    found = {frozenset((int(r.a), int(r.b))) for r in g.sharing_rare(nodes.select("node", nodes.node.alias("root"))).collect()}
    sets = dict(zip([i for i, _ in rows], N.shingles([t for _, t in rows])))
    right = {frozenset(p) for p in itertools.combinations(sets, 2) if N.similarity(sets[p[0]], sets[p[1]]) >= 0.8}
    assert len(right) >= 35
    joined = N._Sets(2000)
    for p in found & right:
        joined.join(*p)
    assert [p for p in right if len({joined.of(i) for i in p}) > 1] == []


def test_bounds_of_similarity():
    texts = [prose(1, 300), changed(prose(1, 300), range(0, 60, 6)), " ".join([prose(2, 40)] * 5 + [prose(1, 300)]), prose(9, 50), "one"]
    sets = N.shingles(texts)
    most = N.bounds(sets, sets)
    for i, j in itertools.product(range(5), repeat=2):
        exact = N.similarity(sets[i], sets[j])
        assert most[i, j] >= exact - 1e-5
        if max(sets[i][1].max(), sets[j][1].max()) == 1:
            assert abs(most[i, j] - exact) < 1e-5

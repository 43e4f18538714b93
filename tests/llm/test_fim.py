import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from lakestrata.llm import fim
from tests.llm.frames import CLASHING, by_id, edge_rows, edges, empty, frame


def plainly(text, key, seed=7, rate=100, suffix_first=50):
    """(n, form, prefix_chars, middle_chars, output) by slicing strings."""
    text, h = text or "", hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < suffix_first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = st.text(st.sampled_from("ab\n\r <>PSMé中\U0001f600\x00"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(0, 10**12))
def test_as_plain_slicing_and_back(text, key):
    n, form, parts, table = fim.Transform(fim.LINES, 7, 100, 50)(text, str(key))
    output = fim.render(table, text)
    assert (n, form, *fim._sizes(parts), output) == plainly(text, key)
    assert fim.render(fim.restored(output, form), output) == text
    assert fim.digest(table, text) == sha(output)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.lists(st.integers(0, 60), max_size=6))
def test_cuts_lose_nothing(text, places):
    table = [fim.Piece(fim.TEXT, 0, len(text))]
    for at in places:
        before, after = fim.cut(table, at)
        assert fim.render(before, text) == text[:at] and fim.render(after, text) == text[at:]
        table = [*before, *after]
    assert fim.render(table, text) == text and all(p.length for p in table if text)


def test_long_texts_are_streamed(monkeypatch):
    monkeypatch.setattr(fim, "CHUNK", 7)
    text = "".join(random.Random(1).choice("ab é\n中") for _ in range(5000))
    _, form, _, table = fim.Transform(fim.LINES, 7, 100, 50)(text, "12")
    output = fim.render(table, text)
    assert fim.digest(table, text) == sha(output) and fim.digest(fim.restored(output, form), output) == sha(text)


def test_restoring_needs_the_right_form():
    with pytest.raises(ValueError):
        fim.restored("<P>a<S>b<M>c", "spm")


def test_rates_units_and_seeds(spark):
    df = frame(spark, [(i, f"one two\nthree {i}\nfour") for i in range(200)])
    forms = lambda **k: [r.form for r in fim.with_fim(df, **k).select("fim.form").collect()]
    assert set(forms(rate=0)) == {"plain"} and set(forms(suffix_first=100)) == {"spm"} and set(forms(suffix_first=0)) == {"psm"}
    assert {"plain", "psm", "spm"} == set(forms(rate=50))
    words = by_id(fim.with_fim(df, unit=r"\S*\s+|\S+", seed=3), "fim.n", "fim.output", "fim.pieces")
    assert {n for ((n, _, _),) in words.values()} == {5}
    for i, ((_, output, pieces),) in words.items():
        text = f"one two\nthree {i}\nfour"
        assert fim.render([fim.Piece(*p) for p in pieces], text) == output


def test_edges(spark):
    df = edges(spark)
    got = fim.with_fim(df)
    assert set(CLASHING) <= set(got.columns)
    want = {}
    for doc_id, text, *_ in edge_rows():
        want.setdefault(doc_id, []).append(plainly(text, "" if doc_id is None else doc_id))
    rows = by_id(got, "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", "fim.output")
    assert {k: sorted(map(str, v)) for k, v in rows.items()} == {k: sorted(map(str, v)) for k, v in want.items()}
    back = fim.with_restored(got.withColumns({"o": got["fim.output"], "f": got["fim.form"]}), "o", "f").select("text", "restored").collect()
    assert all(r.restored == (r.text or "") for r in back) and len(back) == len(edge_rows())
    digests = by_id(fim.digests(df), "output_sha256", "restored_sha256")
    texts = {}
    for doc_id, text, *_ in edge_rows():
        texts.setdefault(doc_id, []).append((sha(plainly(text, "" if doc_id is None else doc_id)[4]), sha(text or "")))
    assert {k: sorted(v) for k, v in digests.items()} == {k: sorted(v) for k, v in texts.items()}


def test_empty_table(spark):
    assert fim.with_fim(empty(spark)).count() == 0 and fim.digests(empty(spark)).count() == 0

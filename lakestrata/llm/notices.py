"""Fuzzy search for short licence notices.

Texts and notices are compared as lower-case words joined by single blanks.
A notice found with k edits at most, cut into k + 1 pieces, has one piece
unchanged; an automaton of all pieces finds these seeds.  Around each seed the
regex library looks for the whole notice with bounded errors and reports the best span.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Phrases that count wherever their words stand in a row, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Notices that may be changed a little, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "under the terms of the gnu lesser general public license": "lgpl",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under a creative commons attribution": "cc-by",
    "released into the public domain": "public-domain",
    "spdx license identifier": "spdx",
    "all rights reserved": "reserved",
}
#: One edit (a character put in, left out or changed) for as many characters of a notice.
CHARACTERS_AN_EDIT = 10

_SPACED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()), T.StructField("edits", T.IntegerType()),
        T.StructField("similarity", T.DoubleType()), T.StructField("base", T.BooleanType())]))),
])


def spaced(text: str | None) -> bytes:
    """The words, one blank before, between and after them."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_SPACED).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def phrase_places(line: bytes) -> list[tuple[str, int, int]]:
    """(label, first word, last word) of every place of every phrase."""
    out = []
    for phrase, label in PHRASES.items():
        wanted = b" " + phrase.encode() + b" "
        at = line.find(wanted)
        while at >= 0:
            first = line.count(b" ", 0, at)
            out.append((label, first, first + phrase.count(" ")))
            at = line.find(wanted, at + 1)
    return out


class Finder:
    """Seeds of all notices in one automaton, and an error-bounded pattern each."""

    def __init__(self, notices: dict[str, str] = NOTICES, per_edit: int = CHARACTERS_AN_EDIT):
        self.notices = []
        self.seeds = ahocorasick.Automaton()
        pieces: dict[str, list] = {}
        for n, (notice, label) in enumerate(notices.items()):
            edits = len(notice) // per_edit
            pattern = regex.compile(rf"(?b)(?<=\ )(?:{regex.escape(notice)}){{e<={edits}}}(?=\ )")
            self.notices.append((notice, label, edits, pattern))
            cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                pieces.setdefault(notice[a:b], []).append((n, a))
        for piece, of in pieces.items():
            self.seeds.add_word(piece, (len(piece), of))
        self.seeds.make_automaton()

    def find(self, line: str) -> list[tuple[str, int, int, int, float]]:
        """(label, start, end, edits, similarity) of the best match around each group of seeds.

        Seeds less than a notice apart are looked at together; within a group, what a match leaves is searched again.
        """
        regions: dict[int, list[list[int]]] = {}
        for last, (size, of) in self.seeds.iter(line):
            for n, at in of:
                notice, _, edits, _ = self.notices[n]
                start = last + 1 - size - at - edits - 1
                end = start + len(notice) + 2 * edits + 2
                known = regions.setdefault(n, [])
                # A seed from further behind in the notice begins its region earlier: it may reach several known ones.
                while known and start <= known[-1][1]:
                    before = known.pop()
                    start, end = min(start, before[0]), max(end, before[1])
                known.append([max(0, start), end])
        out = []
        for n, known in regions.items():
            notice, label, edits, pattern = self.notices[n]
            for start, end in known:
                left = [(start, min(end, len(line)))]
                while left:
                    a, b = left.pop()
                    m = pattern.search(line, a, b) if b - a >= len(notice) - edits else None
                    if m:
                        wrong = sum(m.fuzzy_counts)
                        out.append((label, m.start(), m.end(), wrong, 1 - wrong / len(notice)))
                        left += [(a, m.start()), (m.end(), b)]
        return out


_FINDERS: list[Finder] = []


def scanned(text: str | None) -> tuple[int, list[dict]]:
    """Number of words, and the spans of phrases (base) and notices, by first word."""
    if not _FINDERS:
        _FINDERS.append(Finder())
    line = spaced(text)
    spans = [(label, a, b, 0, 1.0, True) for label, a, b in phrase_places(line)]
    decoded = line.decode("utf-8", "surrogatepass")
    found: list[tuple] = []
    for m in sorted(_FINDERS[0].find(decoded), key=lambda m: (-m[4], m[1])):
        # Of notices found at one place the most similar stay.
        if all(m[2] <= k[1] or m[1] >= k[2] or m[4] == k[4] for k in found):
            found.append(m)
    for label, start, end, edits, similarity in found:
        spans.append((label, decoded.count(" ", 0, start) - 1, decoded.count(" ", 0, end) - 1, edits, similarity, False))
    spans.sort(key=lambda s: (s[1], s[2], s[0], not s[5]))
    names = FOUND["spans"].dataType.elementType.names
    return line.count(b" ") - 1, [dict(zip(names, s, strict=True)) for s in spans]


def with_notices(df: DataFrame, text: str = "text", out: str = "notices") -> DataFrame:
    """``df`` with a struct column ``out``: n_words, and spans (label, first_word, last_word, edits, similarity, base).

    Words are numbered from 0.  Base spans are the places of the phrases, all of them; the others are notices with a bounded number of
    edits, beginning and ending with a word.  One row per input row, all columns kept; a
    column named ``out`` is replaced.  Null and empty texts have no words and no spans; a text of any length is searched whole.
    """
    @F.pandas_udf(FOUND)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([scanned(t) for t in batch.where(batch.notna(), None)], columns=FOUND.names)

    return df.withColumn(out, run(F.col(text)))

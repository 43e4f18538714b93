"""Fill-in-the-middle transformation by piece tables.

A document is a list of descriptors (buffer, start, length) over immutable
buffers: its own text and the sentinels.  Cutting splits descriptors at two
unit ends, an arrangement permutes the three parts and puts a sentinel
before each, and the inverse permutation restores the text.  Nothing is
copied until a table is rendered; a digest streams the descriptors' slices.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import free_name, in_blocks

#: Units a text is cut between; matched from the left, they cover it.
LINES = r"[^\n]*\n|[^\n]+"
#: Sentinels of prefix, suffix and middle.  A text that holds one of them stays plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
#: Percent of texts that are transformed, and of these the percent that put the suffix first.
RATE, SUFFIX_FIRST = 100, 50
SEED = 7

#: The buffers of a descriptor.
TEXT, MARKS = 0, 1
#: Code points that a digest encodes at a time.
CHUNK = 1 << 16
#: Code points of texts that are rendered before they are sent on.
BLOCK = 1 << 22


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


#: The sentinels as descriptors, by part: prefix, middle, suffix.
MARK_OF = tuple(Piece(MARKS, SENTINELS.index(m), len(m)) for m in (PREFIX, MIDDLE, SUFFIX))
#: Order of the parts (0 prefix, 1 middle, 2 suffix) in each form.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}

PIECES = T.ArrayType(T.StructType([T.StructField("buffer", T.ByteType()), T.StructField("start", T.LongType()),
                                   T.StructField("length", T.LongType())]))
RESULT = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("pieces", PIECES), T.StructField("output", T.StringType()),
])
DIGEST = T.StructType([*RESULT.fields[:4], T.StructField("output_sha256", T.StringType()),
                       T.StructField("restored_sha256", T.StringType())])


def length(table: Sequence[Piece]) -> int:
    return sum(p.length for p in table)


def cut(table: Sequence[Piece], at: int) -> tuple[list[Piece], list[Piece]]:
    """The table before and after an offset; a descriptor across it becomes two."""
    before, after = [], []
    for p in table:
        here = min(max(at, 0), p.length)
        if here:
            before.append(Piece(p.buffer, p.start, here))
        if here < p.length:
            after.append(Piece(p.buffer, p.start + here, p.length - here))
        at -= p.length
    return before, after


def parts_at(table: Sequence[Piece], a: int, b: int) -> list[list[Piece]]:
    """Prefix, middle and suffix of a table cut at a <= b."""
    prefix, rest = cut(table, a)
    return [prefix, *cut(rest, b - a)]


def arrange(parts: Sequence[Sequence[Piece]], form: str) -> list[Piece]:
    """The parts in the form's order, each behind its sentinel."""
    return [p for part in ORDERS[form] for p in (MARK_OF[part], *parts[part])]


def inverse(order: Sequence[int]) -> list[int]:
    out = [0] * len(order)
    for place, part in enumerate(order):
        out[part] = place
    return out


def restored(output: str, form: str) -> list[Piece]:
    """Descriptors over ``output`` that give the original text: its parts between the sentinels, in their old order.

    The text has no sentinel, so the first place of each is the sentinel itself.
    """
    whole = [Piece(TEXT, 0, len(output))] if output else []
    if form == "plain":
        return whole
    placed, at, marks = [], 0, [MARK_OF[part] for part in ORDERS[form]]
    signs = [SENTINELS[m.start:m.start + m.length] for m in marks]
    for k, sign in enumerate(signs):
        if not output.startswith(sign, at):
            raise ValueError(f"no {sign} at {at} of a text in form {form}")
        begin = at + len(sign)
        at = output.index(signs[k + 1], begin) if k + 1 < len(signs) else len(output)
        placed.append(cut(cut(whole, at)[0], begin)[1])
    return [p for place in inverse(ORDERS[form]) for p in placed[place]]


def slices(table: Sequence[Piece], text: str) -> Iterator[str]:
    """The table's text, some code points at a time."""
    buffers = (text, SENTINELS)
    for p in table:
        for a in range(p.start, p.start + p.length, CHUNK):
            yield buffers[p.buffer][a:min(a + CHUNK, p.start + p.length)]


def render(table: Sequence[Piece], text: str) -> str:
    return "".join(slices(table, text))


def digest(table: Sequence[Piece], text: str) -> str:
    """SHA-256 of the table's text as UTF-8; the text isn't built."""
    h = hashlib.sha256()
    for s in slices(table, text):
        h.update(s.encode("utf-8", "surrogatepass"))
    return h.hexdigest()


def draws(key: str, seed: int) -> list[int]:
    """h1 to h4: the first four 32-bit numbers of the SHA-256 of ``seed:key``."""
    h = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(h[i:i + 4], "big") for i in range(0, 16, 4)]


class Transform:
    """A text and its key to (units, form, parts, table)."""

    def __init__(self, unit: str, seed: int, rate: int, suffix_first: int):
        self.unit, self.seed, self.rate, self.suffix_first = re.compile(unit), seed, rate, suffix_first

    def __call__(self, text: str, key: str) -> tuple[int, str, list[list[Piece]], list[Piece]]:
        h1, h2, h3, h4 = draws(key, self.seed)
        whole = [Piece(TEXT, 0, len(text))] if text else []
        ends = [m.end() for m in self.unit.finditer(text)]
        n = len(ends)
        if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= self.rate:
            return n, "plain", [], whole
        form = "spm" if h4 % 100 < self.suffix_first else "psm"
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        parts = parts_at(whole, ends[a - 1] if a else 0, ends[b - 1] if b else 0)
        return n, form, parts, arrange(parts, form)


def _sizes(parts: list[list[Piece]]) -> tuple[int | None, int | None]:
    return (length(parts[0]), length(parts[1])) if parts else (None, None)


def _transformed(text: str, key: str, transform: Transform) -> tuple:
    n, form, parts, table = transform(text, key)
    return n, form, *_sizes(parts), [p._asdict() for p in table], render(table, text)


def _digested(text: str, key: str, transform: Transform) -> tuple:
    n, form, parts, table = transform(text, key)
    output = render(table, text)
    return n, form, *_sizes(parts), digest(table, text), digest(restored(output, form), output)


def _apply(df: DataFrame, key: str, text: str, out: str, kind: T.StructType, row, transform: Transform) -> DataFrame:
    @F.pandas_udf(kind)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, keys in batches:
            texts, keys = texts.tolist(), keys.tolist()
            for part in in_blocks([len(t) + 1 for t in texts], BLOCK):
                yield pd.DataFrame([row(t, k, transform) for t, k in zip(texts[part], keys[part], strict=True)],
                                   columns=kind.names)

    none = F.lit("")
    return df.withColumn(out, run(F.coalesce(F.col(text), none), F.coalesce(F.col(key).cast("string"), none)))


def with_fim(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "fim", unit: str = LINES, seed: int = SEED,
             rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``df`` with a struct column ``out``: n, form, prefix_chars, middle_chars, pieces, output.

    n counts the matches of ``unit``; form is plain, psm or spm; the sizes of prefix and middle are null for
    plain.  ``pieces`` are the output's descriptors: buffer 0 is the text, buffer 1 ``SENTINELS``, in code points.
    One row per input row, all columns kept; a column named ``out`` is replaced.  A null text is empty, and an
    empty one is plain, as is one that holds a sentinel.  Texts of any length are cut whole.  Rows of equal key and text
    come out alike; a null key counts as the empty one.  An empty table gives none.
    """
    return _apply(df, key, text, out, RESULT, _transformed, Transform(unit, seed, rate, suffix_first))


def with_fim_digests(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "fim", unit: str = LINES,
                     seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """As ``with_fim``, but with SHA-256 of the output, and of the text restored from output and form, in place of both."""
    return _apply(df, key, text, out, DIGEST, _digested, Transform(unit, seed, rate, suffix_first))


def with_restored(df: DataFrame, output: str, form: str, out: str = "restored") -> DataFrame:
    """``df`` with the original text of each output; null outputs give the empty text, null forms count as plain."""
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for outputs, forms in batches:
            outputs, forms = outputs.tolist(), forms.tolist()
            for part in in_blocks([len(t) + 1 for t in outputs], BLOCK):
                yield pd.Series([render(restored(t, f), t) for t, f in zip(outputs[part], forms[part], strict=True)], dtype=object)

    return df.withColumn(out, run(F.coalesce(F.col(output), F.lit("")), F.coalesce(F.col(form), F.lit("plain"))))


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256), a row per row of ``docs``."""
    out = free_name(docs, "fim")
    return with_fim_digests(docs, key, text, out).select(F.col(key).alias("doc_id"), f"{out}.*")

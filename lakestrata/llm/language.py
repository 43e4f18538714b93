"""Language identification by cross-parsing.

Each language has a suffix automaton of a bounded sample of its labelled
text.  A text is cut into the longest phrases that the sample contains
(greedy longest match); a phrase costs about log2(sample length) bits, the
pointer into the sample, and as much in a language with a shorter sample; a
symbol that the sample lacks costs log2(alphabet) more.  The language that needs the fewest bits wins.

Texts are parsed many at a time: a lane per text segment, one table lookup
per symbol for all lanes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import bounded_batches, free_name, give_back, in_blocks, sample_ids

#: Letters of the samples, folded and joined by single spaces, per language.
TRAIN_CHARS = 40_000
#: Labelled documents per language from which they are taken.
TRAIN_DOCS = 96
#: A longer text is parsed in segments; each starts a new phrase.
SEGMENT = 2048
#: Share of a text's letters that the samples must have for a verdict on its bits a letter.
MIN_KNOWN = 1 / 3
#: Symbols in one lane block.
BLOCK = 2_000_000

RESULT = T.StructType([
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("phrases", T.LongType()),
    T.StructField("bits_per_letter", T.DoubleType()),
])


def _letter_table() -> np.ndarray:
    """Code point -> itself for letters, space for all else (BMP; others count as letters by property)."""
    return np.fromiter((c if chr(c).isalpha() else 32 for c in range(0x10000)), np.uint32, 0x10000)


_LETTERS: np.ndarray | None = None


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with single spaces of all texts, joined; and where each ends."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = _letter_table()
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) for t in lowered], dtype=np.int64)
    if not len(codes):
        return codes.copy(), ends
    out = np.full(len(codes), 32, np.uint32)
    low = codes < 0x10000
    out[low] = _LETTERS[codes[low]]
    for i in np.nonzero(~low)[0]:
        out[i] = codes[i] if chr(codes[i]).isalpha() else 32
    gap = out == 32
    first = np.zeros(len(codes), bool)
    starts = np.concatenate([[0], ends[:-1]])
    first[starts[starts < len(codes)]] = True
    before = np.concatenate([[True], gap[:-1]])
    keep = ~(gap & (before | first))
    kept = np.cumsum(keep)
    return out[keep], np.where(ends > 0, kept[np.maximum(ends - 1, 0)], 0)


def automaton(symbols: np.ndarray, width: int) -> np.ndarray:
    """Transition table of the suffix automaton; row 0 is both root and 'no such phrase'."""
    links, lengths, moves = [-1], [0], [{}]
    last = 0
    for s in symbols.tolist():
        new = len(lengths)
        lengths.append(lengths[last] + 1)
        links.append(0)
        moves.append({})
        at = last
        while at >= 0 and s not in moves[at]:
            moves[at][s] = new
            at = links[at]
        if at >= 0:
            target = moves[at][s]
            if lengths[target] == lengths[at] + 1:
                links[new] = target
            else:
                twin = len(lengths)
                lengths.append(lengths[at] + 1)
                links.append(links[target])
                moves.append(dict(moves[target]))
                while at >= 0 and moves[at].get(s) == target:
                    moves[at][s] = twin
                    at = links[at]
                links[target] = links[new] = twin
        last = new
    flat = np.zeros((len(moves), width), np.int32)
    for state, m in enumerate(moves):
        if m:
            flat[state, list(m)] = list(m.values())
    return flat


class CrossParser:
    """Automata of all languages over one alphabet; built once per task."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        alphabet = sorted(set("".join(samples.values())))
        self.symbol = {ord(c): i + 1 for i, c in enumerate(alphabet)}  # 0: in no sample
        self.width = len(alphabet) + 1
        self.bmp = np.zeros(0x10000, np.int32)
        for c, i in self.symbol.items():
            if c < 0x10000:
                self.bmp[c] = i
        self.tables = []
        self.cost = np.log2(max([2, *map(len, samples.values())]))
        for lang in self.langs:
            codes = np.array([self.symbol[ord(c)] for c in samples[lang]], np.int32)
            self.tables.append(automaton(codes, self.width).ravel())

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), np.int32)
        low = codes < 0x10000
        out[low] = self.bmp[codes[low]]
        for i in np.nonzero(~low)[0]:
            out[i] = self.symbol.get(int(codes[i]), 0)
        return out

    def phrases(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of phrases per lane and language; lanes are slices of ``symbols``."""
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        steps = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(steps), side="left")
        found = np.zeros((len(starts), len(self.langs)), np.int64)
        state = [np.zeros(len(starts), np.int32) for _ in self.langs]
        for step in range(steps):
            n = active[step]
            s = symbols[starts[:n] + step]
            for j, moves in enumerate(self.tables):
                before = state[j][:n]
                now = moves.take(before * self.width + s)
                ended = now == 0
                found[:n, j] += ended | (before == 0)  # a phrase starts here; an unknown symbol is one
                at = np.nonzero(ended)[0]
                if len(at):
                    now[at] = moves.take(s[at])
                state[j][:n] = now
        out = np.empty_like(found)
        out[order] = found
        return out

    def predict(self, texts: list[str | None]) -> list[tuple]:
        """(lang, score, phrases, bits per letter) per text; ``und`` where no letter or no sample is.

        The bits are those of the symbols that any sample has, null where less than ``MIN_KNOWN`` of the letters are such.
        """
        texts = [t or "" for t in texts]
        out: list[tuple] = [("und", 0.0, 0, None)] * len(texts)
        codes, ends = folded(texts)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        size = ends - starts
        letters = np.concatenate([[0], np.cumsum(codes != 32)])
        n_letters = letters[ends] - letters[starts]
        if not n_letters.any():
            return out
        if not self.langs:  # every symbol is a phrase
            return [("und", 0.0, int(n), None) if k else r for n, k, r in zip(size, n_letters, out)]
        symbols = self.symbols(codes)
        parts = -(-size // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        lane_start = starts[owner] + nth * SEGMENT
        lane_size = np.minimum(SEGMENT, ends[owner] - lane_start)
        counts = np.zeros((len(texts), len(self.langs)), np.int64)
        np.add.at(counts, owner, self.phrases(symbols, lane_start, lane_size))
        bits = counts * self.cost
        for j, moves in enumerate(self.tables):  # a symbol that the language lacks has to be spelt out as well
            lacking = np.concatenate([[0], np.cumsum(moves[:self.width].take(symbols) == 0)])
            bits[:, j] += (lacking[ends] - lacking[starts]) * np.log2(self.width)
        best = bits.argmin(axis=1)
        low = bits.min(axis=1, keepdims=True)
        weight = np.exp2(np.maximum((low - bits) / 8, -60))  # phrases overlap in evidence: an eighth of the bits
        score = 1 / weight.sum(axis=1)
        # A symbol of no sample, and a space between two of them, is a phrase in every language and tells nothing.
        unknown = (symbols == 0) & (codes != 32)
        first, last = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
        first[starts[size > 0]] = last[ends[size > 0] - 1] = True
        beside = np.concatenate([[True], unknown[:-1]]) | first, np.concatenate([unknown[1:], [True]]) | last
        foreign = np.concatenate([[0], np.cumsum(unknown | ((codes == 32) & beside[0] & beside[1]))])
        n_foreign = foreign[ends] - foreign[starts]
        strange = np.concatenate([[0], np.cumsum(unknown)])
        n_known = n_letters - (strange[ends] - strange[starts])
        for i in np.nonzero(n_letters)[0]:
            phrases, known = int(counts[i, best[i]]), n_known[i] >= MIN_KNOWN * n_letters[i]
            a_letter = max(0, phrases - n_foreign[i]) * self.cost / (size[i] - n_foreign[i]) if known else None
            out[i] = (self.langs[best[i]], float(score[i]), phrases, None if a_letter is None else float(a_letter))
        return out


def _picked(labelled: DataFrame, text: str, lang: str, key: str, docs: int, chars: int) -> list[tuple]:
    """(language, key as text, first ``chars`` letters) of the ``docs`` documents per language whose key has the lowest hash."""
    rows = labelled.where(F.col(text).isNotNull()).select(key, lang, text)
    ids = sample_ids(rows, lang, key, docs)
    picked = rows.join(F.broadcast(ids), [key, lang]).select(  # docs x languages ids
        F.col(lang), F.col(key), F.substring(text, 1, chars).alias("piece"), F.col(key).cast("string").alias("key_text"))
    return [(r[0], r[3], r[2]) for r in sorted(picked.collect(), key=lambda r: (r[0], hash_order(r[1]), r[2]))]


def _pieces(picked: list[tuple]) -> dict[str, list[str]]:
    pieces: dict[str, list[str]] = {}
    for k, _, piece in picked:
        pieces.setdefault(k, []).append(piece)
    return pieces


def _samples(pieces: dict[str, list[str]], chars: int) -> dict[str, str]:
    out = {}
    for k, texts in pieces.items():
        # an even share of each document, so that no long one fills the sample
        share = max(200, 2 * chars // max(1, len(texts)))
        codes, _ = folded([" ".join(p[:share] for p in texts)])
        sample = "".join(map(chr, codes[:chars].tolist())).strip()
        if sample:
            out[k] = sample
    return out


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          docs: int = TRAIN_DOCS, chars: int = TRAIN_CHARS) -> dict[str, str]:
    """A sample of folded text per language, ``chars`` long at most.

    It is taken from the ``docs`` documents per language whose key has the
    lowest hash; rows with a null key, text or language aren't labelled.
    """
    return _samples(_pieces(_picked(labelled, text, lang, key, docs, chars)), chars)


def learn_bounded(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
                  docs: int = TRAIN_DOCS, chars: int = TRAIN_CHARS) -> tuple[dict[str, str], dict[str, float]]:
    """The samples of ``learn``, and for each language the bits a letter that its texts stay below.

    Every labelled text is parsed whole with a sample that it isn't in: the sampled documents of a language make two halves, those of the
    second are parsed with a sample of the first, and all its other texts with one of the second.  The bound is ``BOUND_RATIO`` times the bits a letter that
    ``BOUND_SHARE`` of them don't exceed, to 1 / ``BOUND_STEPS``.  A language with fewer than ``BOUND_TEXTS`` texts to parse has no bound.
    """
    picked = _picked(labelled, text, lang, key, docs, chars)
    samples, bounds = _samples(_pieces(picked), chars), {}
    price = np.log2(max([2, *map(len, samples.values())]))
    halves: dict[tuple, int] = {}
    for k, keys in _pieces([(k, None, i) for k, i, _ in picked]).items():
        halves |= {(k, i): n % 2 for n, i in enumerate(dict.fromkeys(keys))}
    others = [_samples(_pieces([p for p in picked if halves[p[:2]] != half]), chars) for half in (0, 1)]
    langs = sorted(samples)
    if not langs:
        return samples, bounds

    def held_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models: dict[tuple, CrossParser] = {}  # the task's own
        waiting: dict[tuple, list[str]] = {}
        size: Counter = Counter()

        def parsed(group: tuple) -> Iterator[pd.DataFrame]:
            if group not in models:
                k, half = group
                models[group] = CrossParser({k: others[half][k]})
                models[group].cost = price
            texts = waiting.pop(group)
            del size[group]
            for part in in_blocks([len(t) for t in texts], BLOCK):
                bits = [r[3] for r in models[group].predict(texts[part]) if r[2] >= MIN_PHRASES and r[3] is not None]
                yield pd.DataFrame({"nth": langs.index(group[0]), "step": np.rint(np.array(bits) * BOUND_STEPS).astype(np.int64)})

        for batch in batches:
            for k, i, t in zip(batch["lang"], batch["key"], batch["text"]):
                half = halves.get((k, i), 0)
                if k in samples and k in others[half]:
                    waiting.setdefault((k, half), []).append(t)
                    size[k, half] += len(t)
            while size.total() > BLOCK:  # many texts of a group are parsed as fast as a few
                yield from parsed(max(size, key=size.get))
        for group in list(waiting):
            yield from parsed(group)
        models.clear()
        give_back()

    bounded_batches(labelled.sparkSession)
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(key).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    steps = rows.mapInPandas(held_out, "nth long, step long").groupBy("nth", "step").agg(F.count("*").alias("texts"))
    # A language has a row per step at most, as a phrase of one letter costs 16 bits or so.
    high = steps.groupBy("nth").agg(F.sum("texts").alias("texts"), F.percentile("step", F.lit(BOUND_SHARE), F.col("texts")).alias("high"))
    for r in high.where(F.col("texts") >= BOUND_TEXTS).collect():
        bounds[langs[r.nth]] = BOUND_RATIO * r.high / BOUND_STEPS
    return samples, bounds


def hash_order(key) -> tuple:
    import zlib
    return zlib.crc32(str(key).encode()), str(key)


def with_language(df: DataFrame, samples: dict[str, str], text: str = "text",
                  out: str = "language") -> DataFrame:
    """``df`` with a struct column ``out``: lang_pred, score, phrases, bits_per_letter.

    One row per input row, repeated rows included; all columns stay, and a
    column already named ``out`` is replaced.  Null texts and texts without a
    letter get ``und``, score 0, no phrases and null bits; where there are no samples the others
    get ``und`` too, each symbol being a phrase.  Texts in a script that no sample has get null bits.  Ties go to the alphabetically first language.  A
    text of any length is parsed whole.
    """
    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = CrossParser(samples)  # the task's own: it goes with the iterator
        for batch in batches:
            texts = batch.where(batch.notna(), None).tolist()
            for part in in_blocks([len(t or "") for t in texts], BLOCK):
                yield pd.DataFrame(model.predict(texts[part]), columns=RESULT.names)
        del model
        give_back()

    bounded_batches(df.sparkSession)
    return df.withColumn(out, predict(F.col(text)))


#: Texts of fewer phrases aren't judged by their bits a letter.
MIN_PHRASES = 64
#: A language's bound: this many times the bits a letter that this share of its held-out texts, so many at least, don't exceed.
BOUND_RATIO, BOUND_SHARE, BOUND_TEXTS = 2.2, 0.9, 8
#: Bits a letter are counted in this many steps a bit.
BOUND_STEPS = 4096
#: The bound where none is given: random letters of a small alphabet match a sample
#: no longer than that (about log2(sample) / log(sample, alphabet)).
MAX_BITS = 5.5


def rejected(language: str = "language", max_bits: float | dict[str, float] = MAX_BITS,
             min_phrases: int = MIN_PHRASES) -> Column:
    """True for texts without a letter, and for longer ones that read like random letters.

    ``max_bits`` is one bound for all, or one per language (of ``learn_bounded``); a language without one has no such texts.
    """
    c = F.col(language)
    if isinstance(max_bits, dict):
        pairs = [F.lit(x) for pair in max_bits.items() for x in pair]
        bound = F.try_element_at(F.create_map(*pairs), c["lang_pred"]) if pairs else F.lit(None).cast("double")
    else:
        bound = F.lit(max_bits)
    return (((c["lang_pred"] == "und") & (c["phrases"] == 0))
            | ((c["phrases"] >= min_phrases) & F.coalesce(c["bits_per_letter"] > bound, F.lit(False))))


def identify(df: DataFrame, labelled: DataFrame, text: str = "text", out: str | None = None) -> DataFrame:
    """``learn`` on ``labelled``, then ``with_language`` on ``df``."""
    return with_language(df, learn(labelled), text, out or free_name(df, "language"))

"""Byte-level BPE encoding and decoding with a sentencepiece model.

The model is serialised here from a rank file: a piece per vocabulary entry,
its bytes mapped to printable characters, scored by the negative rank, with
identity normalisation.  Merging the adjacent pair of best score is then
merging by rank.  Texts are cut into pre-tokens by a pattern first, and each
distinct pre-token is encoded once per task.  Decoding maps ids back to
bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.common import bounded_batches, give_back, in_blocks

#: Bytes of pre-tokens and ids remembered by a task, and of the pre-tokens that are.
CACHE_BYTES, CACHED = 64 << 20, 64
#: The same where the rows carry the ids and bytes themselves, which take memory beside it.
IDS_CACHE_BYTES = 24 << 20
#: Characters of texts encoded before their rows are sent on.
BLOCK = 1 << 19

RESULT = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("decoded", T.BinaryType()),
])
DIGEST = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def byte_characters() -> list[str]:
    """A printable character per byte: itself where Latin-1 prints it, else from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Vocabulary of a rank file (base64 token, blank, rank a line); its size is the vocabulary's."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, body: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def _float(number: int, value: float) -> bytes:
    return _varint(number << 3 | 5) + struct.pack("<f", value)


def model_bytes(ranks: dict[bytes, int]) -> tuple[bytes, list[int]]:
    """A serialised sentencepiece BPE model, and the rank of each of its pieces."""
    char = byte_characters()
    out, order = bytearray(), sorted(ranks.items(), key=lambda x: x[1])
    for token, rank in order:
        piece = "".join(char[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _float(2, -float(rank)) + _number(3, 1))
    out += _field(1, _field(1, b"<unk>") + _float(2, 0.0) + _number(3, 2))
    out += _field(2, _number(3, 2))  # a BPE model
    out += _field(3, _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0))
    return bytes(out), [rank for _, rank in order]


class Codec(dict):
    """pre-token -> its ids; encodes on a miss.  Holds ``most`` bytes, and long pre-tokens not at all."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, model: tuple[bytes, list[int]] | None = None, most: int | None = None):
        super().__init__()
        self.most = CACHE_BYTES if most is None else most
        import sentencepiece
        proto, self.rank_of = model or model_bytes(ranks)
        self.held = 0
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.char = byte_characters()
        self.split = regex.compile(pattern)

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8", "replace")
        whole = self.ranks.get(raw)
        if whole is not None:  # a vocabulary entry stands for itself
            ids = (whole,)
        else:
            mapped = raw.decode("latin-1").translate(self.char)
            ids = tuple(self.rank_of[i] for i in self.model.encode(mapped))
        if len(raw) <= CACHED:
            self.held += len(raw) + 8 * len(ids) + 200  # with what the objects take themselves
            if self.held > self.most:
                self.clear()
                self.held = 0
            self[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for m in self.split.finditer(text):
            out += self[m[0]]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _apply(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str, out: str, kind: T.StructType, row,
           most: int | None = None) -> DataFrame:
    # The vocabulary and its model: a fixed size.
    shared = df.sparkSession.sparkContext.broadcast((ranks, model_bytes(ranks)))

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = Codec(shared.value[0], pattern, shared.value[1], most)  # the task's own: it goes with the iterator
        for batch in batches:
            texts = batch.where(batch.notna(), "").tolist()
            for part in in_blocks([len(t) + 1 for t in texts], BLOCK):
                yield pd.DataFrame([row(coder, t) for t in texts[part]], columns=kind.names)
        del coder
        give_back()

    bounded_batches(df.sparkSession)
    return df.withColumn(out, run(F.col(text)))


def with_tokens(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", out: str = "bpe") -> DataFrame:
    """``df`` with a struct column ``out``: ids, and the bytes decoded from them.

    One row per input row, all columns kept; a column named ``out`` is
    replaced.  Null and empty texts have no ids and decode to no bytes; a
    text of any length is encoded whole.  No special tokens.
    """
    def row(coder: Codec, t: str) -> tuple:
        ids = coder.encode(t)
        return ids, coder.decode(ids)

    return _apply(df, ranks, pattern, text, out, RESULT, row, IDS_CACHE_BYTES)


def with_token_digests(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", out: str = "bpe") -> DataFrame:
    """As ``with_tokens``, but only the number of ids and SHA-256 of ids and decoded bytes."""
    def row(coder: Codec, t: str) -> tuple:
        ids = coder.encode(t)
        return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(coder.decode(ids)).hexdigest())

    return _apply(df, ranks, pattern, text, out, DIGEST, row)

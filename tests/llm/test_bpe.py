import base64
import hashlib
import random

import pytest

from lakestrata.llm import bpe
from tests.llm.frames import CLASHING, by_id, edge_rows, edges, empty

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_ranks_of_the_file(spark):
    assert bpe.read_ranks(spark, PATH) == RANKS


def test_ids_as_tiktoken_gives_them(reference):
    codec, rnd = bpe.Codec(RANKS, P.PATTERN), random.Random(4)
    parts = ["a", "B", "é", " ", "  ", "\n", "'s", "'S", "12", "%%", "ñ", "\t", "　", "日", "!", "x" * 50, "\x1c", "\x85",
             "​", "\U0001f600", "\x00", "<|endoftext|>", "١", "́"]
    for _ in range(500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        ids = codec.encode(text)
        assert ids == reference.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_every_character_of_the_lower_planes(reference):
    codec = bpe.Codec(RANKS, P.PATTERN)
    for start in range(0, 0x3000, 64):
        text = " ".join(f"a{chr(c)}{chr(c)} 1{chr(c)}" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert codec.encode(text) == reference.encode_ordinary(text), hex(start)


def test_small_vocabulary_merges_by_rank():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"ab": 257, b"abc": 258}
    codec = bpe.Codec(ranks, r"\S+|\s+")
    whole = tiktoken.Encoding("small", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    for text in ("ab", "abc", "abcx", "abbc", "bcab abc", "cab"):
        assert codec.encode(text) == whole.encode_ordinary(text)
    # An entry stands for itself, even one that no merge of two entries makes.
    ranks[b"xyz"] = 259
    assert bpe.Codec(ranks, r"\S+|\s+").encode("xyz") == [259]


def test_edges(spark, reference):
    got = bpe.with_tokens(edges(spark), RANKS, P.PATTERN)
    assert set(CLASHING) <= set(got.columns)
    want = {}
    for doc_id, text, *_ in edge_rows():
        want.setdefault(doc_id, []).append((reference.encode_ordinary(text or ""), (text or "").encode()))
    rows = by_id(got, "bpe.ids", "bpe.decoded")
    assert {k: sorted((a, bytes(b)) for a, b in v) for k, v in rows.items()} == {k: sorted(v) for k, v in want.items()}
    digests = by_id(bpe.with_token_digests(edges(spark), RANKS, P.PATTERN), "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert {k: sorted(v) for k, v in digests.items()} == {
        k: sorted((len(a), sha(",".join(map(str, a)).encode()), sha(b)) for a, b in v) for k, v in want.items()}


def test_cache_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 5000)
    codec = bpe.Codec(RANKS, P.PATTERN)
    for k in range(300):
        assert codec.decode(codec.encode(f" word{k}x")) == f" word{k}x".encode()
        assert codec.held <= 5000 and len(codec) < 30
    assert codec.decode(codec.encode("x" * 500)) == b"x" * 500 and "x" * 500 not in codec


def test_ids_leave_room_beside_the_cache():
    codec = bpe.Codec(RANKS, P.PATTERN, most=3000)
    for k in range(300):
        assert codec.decode(codec.encode(f" word{k}x")) == f" word{k}x".encode()
        assert codec.held <= 3000
    assert 2 * bpe.IDS_CACHE_BYTES < bpe.CACHE_BYTES


def test_empty_table(spark):
    assert bpe.with_tokens(empty(spark), RANKS, P.PATTERN).count() == 0

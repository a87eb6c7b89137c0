import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from wavemill.llm import bpe
from wavemill.llm.bpe import PRETOKEN, BytePairs, TextEncoder, bpe_decode, bpe_digest, bpe_encode

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["a", "b", "th", "he", " ", "  ", "\n", "\t", "é", "ß", "中", "😀", "'s", "1", "23", "!", "$$$", "\x1c", "\x85", "\xa0", "\u200b", "\u3000", "\x00", "loser,", " the"]


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("limit", [400_000, 8])
def test_same_as_the_library(ranks, library, limit):
    pairs = BytePairs(ranks)
    encoder = TextEncoder(lambda s: np.array(pairs.encode_piece(s.encode()), "<u4").tobytes(), limit=limit)
    rng = random.Random(limit)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text), text
        assert pairs.decode(ids) == text.encode()


def test_very_long_pretokens(ranks, library):
    pairs, rng = BytePairs(ranks), random.Random(3)
    for text in ("a" * 30_000, "".join(rng.choice("abcdefgh") for _ in range(50_000)), "中" * 5_000):
        assert pairs.encode_piece(text.encode()) == library.encode_ordinary(text)
    assert pairs.encode_piece(b"") == []


@pytest.mark.parametrize("few", [1, 10**9])
def test_many_pieces_share_a_queue(ranks, monkeypatch, few):
    monkeypatch.setattr(bpe, "FEW", few)
    pairs, rng = BytePairs(ranks), random.Random(7)
    pieces = [b"a" * k for k in range(80)] + [bytes(rng.randrange(256) for _ in range(rng.randint(0, 70))) for _ in range(500)]
    pieces += ["".join(rng.choice(["an", "na", "ba", "é", "the", " "]) for _ in range(rng.randint(0, 30))).encode() for _ in range(2000)]
    assert pairs.encode_pieces(pieces) == [np.array(pairs.encode_piece(x), "<u4").tobytes() for x in pieces]
    assert pairs.encode_pieces([]) == []
    odd = BytePairs({bytes([b]): b for b in range(256)} | {b"bc": 256, b"aa": 257, b"abc": 258, b"aabc": 259, b"ab": 260, b"abab": 261, b"ba": 262})
    pieces = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 40))).encode() for _ in range(2000)]
    assert odd.encode_pieces(pieces) == [np.array(odd.encode_piece(x), "<u4").tobytes() for x in pieces]


@pytest.mark.parametrize("block, limit", [(1 << 16, 400_000), (7, 8)])
def test_columns_encode_what_is_new_together(ranks, library, monkeypatch, block, limit):
    for name, value in (("BLOCK", block), ("FEW", 1), ("GROUP", 4000), ("LAYOUT", 500)):
        monkeypatch.setattr(bpe, name, value)
    pairs, asked, rng = BytePairs(ranks), [], random.Random(11)

    def many(pretokens):
        asked.append(len(pretokens))
        return pairs.encode_pieces([x.encode() for x in pretokens])

    encoder = TextEncoder(lambda s: np.array(pairs.encode_piece(s.encode()), "<u4").tobytes(), limit=limit, encode_many=many)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))) for _ in range(1000)] + [None, ""]
    found = []
    for ids, bounds in encoder.encode_column(pa.array(texts)):
        found += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found == [library.encode_ordinary(t or "") for t in texts]
    assert sum(asked) > 1000


def test_ties_merge_from_the_left():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaaa": 257}
    assert BytePairs(ranks).encode_piece(b"aaaaa") == [257, ord("a")]


def test_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(1, "the end", 5), (1, "the end", 6), (None, "x y", 7), (2, None, 8), (3, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    encoded = bpe_encode(docs, PATH)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.ids) for r in encoded.collect()), key=repr)
    assert got == sorted(((d is None, d or 0, library.encode_ordinary(t or "")) for d, t, _ in rows), key=repr)
    assert sorted(bytes(r.data) for r in bpe_decode(encoded, PATH).collect()) == sorted((t or "").encode() for _, t, _ in rows)
    assert bpe_digest(docs.limit(0), PATH).collect() == []


def test_digests(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe_digest(docs, PATH).where(F.col("n_tokens") >= 0).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()

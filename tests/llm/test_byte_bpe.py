"""Merge replay against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from topicforge.llm import byte_bpe

RANKS = byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def test_texts_match_library():
    r = random.Random(5)
    alphabet = "aaabcdeeéèßñ 中文字  \n\t'stlr0123.,!?-_<|>end́‍😀"
    texts = ["", None, "the theatre's they'll", "a" * 5000, " " * 50 + "x", "<|endoftext|>", "ab" * 999]
    texts += ["".join(r.choices(alphabet, k=r.randrange(200))) for _ in range(500)]
    texts += [" ".join(base64.b64encode(r.randbytes(r.randrange(40))).decode() for _ in range(5)) for _ in range(300)]
    got = byte_bpe.Encoder(RANKS, P.PATTERN).encode(texts)
    for text, one in zip(texts, got):
        assert ids(one) == LIBRARY.encode_ordinary(text or ""), text


def test_every_token_and_its_joins_as_words():
    r = random.Random(6)
    tokens = list(RANKS)
    words = tokens[::7] + [r.choice(tokens) + r.choice(tokens) + r.choice(tokens) for _ in range(4000)]
    for word, got in zip(words, byte_bpe.Replay(RANKS).encode_words(words)):
        assert ids(got) == LIBRARY._encode_single_piece(word), word


def test_lower_rank_born_by_a_higher_one():
    """'ab' (rank 300) makes 'ab'+'c' (rank 290) possible, which must be
    merged before the second 'ab'."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"abc": 290, b"ca": 310, b"abcab": 320}
    library = tiktoken.Encoding("toy", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    words = [b"abcab", b"abab", b"cabcabab", b"ababcabcaab", b"ababab", b"abababcababcab"]
    r = random.Random(7)
    words += [bytes(r.choices(b"abc", k=r.randrange(1, 40))) for _ in range(3000)]
    for word, got in zip(words, byte_bpe.Replay(ranks).encode_words(words)):
        assert ids(got) == library._encode_single_piece(word)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [(1, "the cat", "x"), (2, None, "y"), (None, "", None), (1, "the cat", "x"), (3, "word " * 30000, "z")],
        "doc_id bigint, text string, ids string")


def test_round_trip_and_edge_rows(frame):
    rows = byte_bpe.encode_documents(frame, RANKS, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, len(r.ids) // 4) for r in rows) == [(0, 0), (1, 2), (1, 2), (2, 0), (3, 30001)]
    for r in rows:
        text = {1: "the cat", 3: "word " * 30000}.get(r.doc_id, "")
        assert bytes(r.decoded).decode() == text
        assert ids(r.ids) == LIBRARY.encode_ordinary(text)
    assert byte_bpe.encode_documents(frame.limit(0), RANKS, P.PATTERN).count() == 0


def test_query(spark, small):
    from topicforge.llm import queries
    got = {r.doc_id: r for r in queries.op7_bpe_replay(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = LIBRARY.encode_ordinary(d.text)
        assert got[d.doc_id].n_tokens == len(want)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(np.asarray(want, "<u4").tobytes()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()

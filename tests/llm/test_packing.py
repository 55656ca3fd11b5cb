"""Packing: every id once, no padding, cost rule."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from topicforge.llm import packing

PATH = P.path("word_bpe_49k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_chunked_ids_match_library():
    texts = ["", "Hello  world's\tÉté\n\nÉTÉ  x\u0085y z\x1cw", "don't STOP!!! 123 45", "<|endoftext|> a", "　全角 ＡＢ", "Été, ÀÉÎß! Ñandú... don.t i'm", "x" * 300 + ". Ab"
             "İstanbul ΣΑΣ ſ ﬁ", " lead", "trail ", "a b ́c"]
    want = library()
    got = packing.Tokeniser(open(PATH).read(), 2).encode(texts + [None])
    for text, one in zip(texts + [""], got):
        assert np.frombuffer(one, "<u4").tolist() == want.encode(text, add_special_tokens=False).ids + [2], text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=40), st.sampled_from([16, 64, 100]))
def test_pack_holds_every_token_once(lengths, capacity):
    pieces = packing.pack(lengths, capacity, 64.0)
    sizes = packing.sequence_sizes(sum(lengths), capacity)
    seen, fill = defaultdict(list), defaultdict(list)
    for d, start, n, s, offset in pieces:
        seen[d] += range(start, start + n)
        fill[s] += range(offset, offset + n)
    assert all(sorted(seen[d]) == list(range(n)) for d, n in enumerate(lengths))
    assert all(sorted(fill[s]) == list(range(n)) for s, n in enumerate(sizes))
    assert all(n == capacity or n & (n - 1) == 0 for n in sizes)


def test_lowest_cost_is_chosen():
    pieces = packing.pack([6, 5, 4, 3, 2], 10, 10.0)  # 20 tokens, two sequences
    assert [(d, s) for d, _, _, s, _ in pieces] == [(0, 0), (1, 1), (2, 1), (3, 0), (4, 1)] or \
        sum(n for _, _, n, s, _ in pieces if s == 0) == 10


def test_edge_rows(spark):
    frame = spark.createDataFrame([(1, "a b", 9), (None, None, 8), (2, "", 7), (1, "a b", 9), (3, "x y " * 20000, 1)],
                                  "doc_id bigint, text string, start int")
    rows = packing.pack_documents(frame, PATH).collect()
    tokens = defaultdict(int)
    for r in rows:
        tokens[r.doc_id] += r.length
        assert len(r.ids) == 4 * r.length
    assert tokens == {1: 6, None: 1, 2: 1, 3: 40001}
    assert packing.pack_documents(frame.limit(0), PATH).count() == 0


def test_query_holds_all_ids(spark, small):
    from topicforge.llm import queries
    want = library()
    rows = queries.op1_cost_packing(spark, small).collect()
    docs = {d.doc_id: want.encode(d.text or "", add_special_tokens=False).ids + [2]
            for d in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got, sequences = defaultdict(int), defaultdict(list)
    for r in rows:
        ids = np.asarray(docs[r.doc_id][r.start:r.start + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and r.doc_tokens == len(docs[r.doc_id])
        got[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == {d: len(x) for d, x in docs.items()}
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at == 4096 or at & (at - 1) == 0

"""Pointer jumping against a walk over every byte."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topicforge.llm import queries, token_align
from topicforge.llm.common import scratch_table

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def coded(libraries, text):
    """``[(id, bytes)]`` of both sides; the first side's bytes from decoding
    its ids one by one where that is text, else from the offsets' rest."""
    first, second = libraries
    if not text:
        return [], []
    letters = token_align.byte_letters()
    a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def brute(libraries, texts):
    """Rows of the contract, by marking the owner of every byte."""
    docs = []
    for text in texts:
        a, b = coded(libraries, text)
        owner = lambda side: [k for k, (_, data) in enumerate(side) for _ in data]
        links = sorted(set(zip(owner(a), owner(b))))
        ends = [np.cumsum([len(d) for _, d in side]).tolist() for side in (a, b)]
        groups, open_, common = [], ([], []), set(ends[0]) & set(ends[1])
        tokens = sorted([(e, k, side[n][0]) for k, side in enumerate((a, b)) for n, e in enumerate(ends[k])], key=lambda t: t[:2])
        for end, k, i in tokens:
            open_[k].append(str(i))
            if k == 1 and end in common:
                groups.append(",".join(open_[0]) + "|" + ",".join(open_[1]))
                open_ = ([], [])
        docs.append((a, b, [(a[i][0], b[j][0]) for i, j in links], groups))
    held = Counter(p for *_, links, _ in docs for p in set(links))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    return [(len(a), len(b), len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for a, b, links, groups in docs]


def texts():
    r = random.Random(2)
    alphabet = "aaabcdeeéèßñ 中文字  \n\t'stlr0123.,!?-_<|>é😀▁"
    some = ["", None, " ", "the theatre's  they'll\r\n", "<|endoftext|>", "<s> a <unk> </s>", "a\x00b", "ｆｕｌｌ ﬁ", "x" * 3000,
            "word " * 20000, " lead", "trail  ", "a▁b"]
    odd = "\x1c\x1f\x85\xa0\u180e\u200b\u2028\u3000\ufeff ٣Ⅷ²ªǅʰ\u0301\u0378Ꟁ𝒳ꙮ a1'"
    some += ["".join(r.choices(odd, k=r.randrange(30))) for _ in range(150)] + ["don't we'll I'd'", "it's 12 34three  x\x85 y"]
    some += ["".join(r.choices(alphabet, k=r.randrange(60))) for _ in range(150)]
    return some + [" ".join(r.choices(["internationalisation", "tokenizers", "größe", "naïve", "2024-01-05", "été"], k=8)) for _ in range(40)]


def result(frame):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return {r.doc_id: tuple(r[n] for n in names) for r in frame.collect()}


def query_of(frame, **bounds):
    aligned = token_align.align_documents(frame, A, B)
    return token_align.link_statistics(scratch_table(aligned.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"), "pairs", "times"), "aligned"), **bounds)


@pytest.mark.parametrize("bounds", [{}, {"broadcast_pairs": 0}])
def test_matches_byte_walk(spark, libraries, bounds):
    some = texts()
    frame = spark.createDataFrame([(n, t, 1) for n, t in enumerate(some)], "doc_id bigint, text string, pairs int")
    got = result(query_of(frame.repartition(5), **bounds))
    assert got == dict(enumerate(brute(libraries, some)))


def test_batches_of_any_size_agree(libraries, monkeypatch):
    aligner = token_align.Aligner(token_align.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read()))
    some = texts()
    together = aligner.align(some)
    for text, one in zip(some, together):
        alone = aligner.align([text])[0]
        assert (alone.n_groups, alone.n_links, alone.groups) == (one.n_groups, one.n_links, one.groups)
        assert alone.pairs.tolist() == one.pairs.tolist() and alone.times.tolist() == one.times.tolist()


def test_labels_are_connected_pieces():
    r = random.Random(1)
    for _ in range(300):
        n = r.randrange(1, 40)
        a = np.asarray(sorted({n, *r.sample(range(1, n + 1), r.randrange(n))}))
        b = np.asarray(sorted({n, *r.sample(range(1, n + 1), r.randrange(n))}))
        label_a, label_b = token_align.group_labels(a, b)
        common = sorted(set(a.tolist()) & set(b.tolist()))
        assert [common.index(b[x]) for x in label_a] == np.searchsorted(common, a).tolist()
        assert [common.index(b[x]) for x in label_b] == np.searchsorted(common, b).tolist()


def test_edge_rows(spark):
    frame = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = query_of(frame).collect()
    assert sorted(((r.doc_id or 0, r.n_a, r.n_groups, r.count_sum) for r in rows)) == [(0, 2, 2, 6), (1, 2, 2, 6), (1, 2, 2, 6), (2, 0, 0, 0)]
    assert query_of(frame.limit(0)).count() == 0


def test_query(spark, small, libraries):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert result(queries.op12_pointer_jumping(spark, small)) == dict(zip([d.doc_id for d in docs], brute(libraries, [d.text for d in docs])))

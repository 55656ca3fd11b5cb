"""Order MinHash groups against alignments of all pairs."""

import random

import numpy as np
import pytest

from topicforge.llm import order_minhash, queries


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(texts, threshold=0.8, within=lambda a, b, most: distance(a, b) <= most):
    """Smallest id of each id's group, over all pairs."""
    words = {i: t.lower().split() for i, t in texts.items() if t and t.split()}
    group = {i: i for i in texts}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(words)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = words[i], words[j]
            most = int((1 - threshold) * max(len(a), len(b)) + 1e-9)
            if find(i) != find(j) and abs(len(a) - len(b)) <= most and (a == b or within(a, b, most)):
                i2, j2 = sorted((find(i), find(j)))
                group[j2] = i2
    return {i: find(i) for i in texts}


def test_edit_distance_in_band():
    r = random.Random(3)
    for _ in range(600):
        a = [r.choice("abcd") for _ in range(r.randrange(25))]
        b = list(a) if r.random() < 0.6 else [r.choice("abcd") for _ in range(r.randrange(25))]
        for _ in range(r.randrange(6)):
            at = r.randrange(len(b) + 1)
            b[at:at + r.randrange(2)] = r.choices("abcd", k=r.randrange(2))
        true = distance(a, b)
        for most in (0, 1, 3, 7, 30):
            assert min(order_minhash.edit_distance(a, b, most), most + 1) == min(true, most + 1), (a, b, most)


def test_counts_bound_the_distance():
    r = random.Random(9)
    code = lambda words: np.array([hash(w) % (1 << 61) for w in words], np.uint64)
    for _ in range(500):
        a = [r.choice("abcdefgh") for _ in range(r.randrange(1, 30))]
        b = list(a) if r.random() < 0.7 else [r.choice("abcdefgh") for _ in range(r.randrange(1, 30))]
        for _ in range(r.randrange(5)):
            at = r.randrange(len(b) + 1)
            b[at:at + r.randrange(2)] = r.choices("abxy", k=r.randrange(2))
        if b:
            counts = [order_minhash.counts_of(code(x)).astype(np.int16) for x in (a, b)]
            assert order_minhash.least_distance(counts[0], counts[1][None])[0] <= distance(a, b)


def made(seed):
    r = random.Random(seed)
    word = lambda: "w%d" % r.randrange(3000)
    passage = " ".join(word() for _ in range(12))
    texts, i = {}, 10
    for _ in range(40):  # groups of copies with few edits, and loners that share a passage
        base = [word() for _ in range(r.choice([8, 30, 80, 200]))]
        for _ in range(r.choice([1, 1, 2, 4, 9])):
            copy = list(base)
            for _ in range(int(len(copy) * r.choice([0, 0.01, 0.03]))):
                at = r.randrange(len(copy))
                copy[at:at + 1] = r.choice([[], [word()], [word(), copy[at]]])
            texts[i] = " ".join(copy)
            i += 1
        texts[i] = passage + " " + " ".join(word() for _ in range(r.choice([2, 3, 10])))
        i += 1
    return texts


@pytest.mark.parametrize("part", [1024, 4])
def test_groups_match_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(order_minhash, "PART", part)
    texts = made(8)
    frame = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id bigint, text string, class_id string")
    got = {r.doc_id: r.class_id for r in order_minhash.near_groups(frame).collect()}
    assert got == brute(texts)


def test_edge_rows(spark):
    rows = [(1, "a b c"), (2, "A  b\nc"), (3, None), (4, ""), (5, "  \n "), (None, "a b c"), (1, "a b c"), (6, "x"), (7, "long " * 40000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in order_minhash.near_groups(frame).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, False), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (6, 6, True),
                          (7, 7, True), (None, None, True)], key=str)
    kept = sorted((tuple(r) for r in order_minhash.keep_one(frame).collect()), key=str)
    assert [k[0] for k in kept] == [1, 3, 4, 5, 6, 7, None]
    assert order_minhash.near_groups(frame.limit(0)).count() == 0
    assert order_minhash.keep_one(frame.limit(0)).count() == 0


def test_keep_one_keeps_every_distinct_text(spark):
    text = " ".join(f"w{n}" for n in range(40))
    rows = [(1, text, 5), (1, "another text entirely here", 6), (1, text, 5), (2, text + " x", 7), (None, text, 8), (None, text, 8)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _kept int").selectExpr("*", "1 AS row", "2 AS id", "3 AS key")
    got = order_minhash.keep_one(frame)
    assert got.columns == frame.columns
    assert sorted((r.doc_id or 0, r._kept) for r in got.collect()) == [(0, 8), (0, 8), (1, 5), (1, 6)]


def edited(r, words, edits):
    """A copy with that many words replaced, at scattered places."""
    copy = list(words)
    for at in r.sample(range(len(copy)), edits):
        copy[at] = "e%d" % r.randrange(10 ** 6)
    return copy


def test_recall_of_sketches():
    """Share of pairs at the given similarity that share a sketch."""
    r = random.Random(12)
    code = lambda words: np.array([hash(w) % (1 << 61) for w in words], np.uint64)
    cases = [(n, 1) for n in range(5, 16)] + [(10, 2), (15, 3), (16, 3), (20, 4), (40, 8), (64, 12), (80, 16), (150, 30),
                                              (300, 60), (300, 45), (300, 30), (1000, 200)]
    for n, edits in cases:
        met, pairs = 0, 150 if n < 1000 else 40
        for _ in range(pairs):
            words = ["w%d" % r.randrange(10 ** 6) for _ in range(n)]
            a, b = (order_minhash.banded_sketches(code(x)) for x in (words, edited(r, words, edits)))
            met += bool(set(a.tolist()) & set(b.tolist()))
        assert met >= 0.9 * pairs - 2.5 * (0.09 * pairs) ** 0.5, (n, edits, met, pairs)


def test_lengths_on_either_side_of_a_band_meet():
    r = random.Random(5)
    code = lambda words: np.array([hash(w) % (1 << 61) for w in words], np.uint64)
    for n in (15, 16, 19, 20, 63, 64, 79, 80):
        words = ["w%d" % r.randrange(10 ** 6) for _ in range(n)]
        for other in (words[:-1], words + ["x"], words[:-2]):
            a, b = order_minhash.banded_sketches(code(words)), order_minhash.banded_sketches(code(other))
            assert set(a.tolist()) & set(b.tolist()), (n, len(other))


def test_large_group_at_the_threshold(spark, monkeypatch):
    """400 texts that share 80 of about 100 words: many pairs are apart, many
    just similar; parts of a few classes make hundreds of blocks."""
    r = random.Random(6)
    shared = ["s%d" % n for n in range(80)]
    texts = {}
    for i in range(400):
        own = ["o%d" % r.randrange(10 ** 5) for _ in range(r.choice([18, 20, 21, 24, 30]))]
        at = r.choice([0, 40, 80])
        texts[i] = " ".join(shared[:at] + own + shared[at:]) if i % 5 else " ".join(own[:9] + shared + own[9:])
    want = brute(texts, within=lambda a, b, most: order_minhash.edit_distance(a, b, most) <= most)
    assert 40 < len(set(want.values())) < 390
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {x.doc_id: x.class_id for x in order_minhash.near_groups(frame).collect()} == want
    monkeypatch.setattr(order_minhash, "PART", 60)
    assert {x.doc_id: x.class_id for x in order_minhash.near_groups(frame).collect()} == want


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: (r.class_id, r.kept) for r in queries.op10_order_minhash(spark, small).collect()}
    want = brute(texts, within=lambda a, b, most: order_minhash.edit_distance(a, b, most) <= most)
    assert got == {i: (c, i == c) for i, c in want.items()}

"""Language identification and toxicity: held-out accuracy, fairness, edges."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from topicforge.llm import langid, queries, toxicity

SF = "/root/testdata/sf0.1"


def test_language_query(spark, small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op5_subword_language(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


def test_every_label_is_learned(spark):
    r = random.Random(3)
    rows = [(1000 + i, " ".join(r.choice(["alpha", "beta", "gamma"]) for _ in range(8)), "common") for i in range(500)]
    rows += [(5000 + i, f"{chr(0x4e00 + i) * 6}", f"l{i:03}") for i in range(260)]
    rows += [(9000, "123 456", "numbers")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(frame, F.lit(True))
    assert model.languages == sorted({lang for _, _, lang in rows} - {"numbers"})
    # more labels than rows wanted: still one row each
    few = langid.train(frame, F.lit(True), per_language=1)
    assert few.languages == model.languages


def test_language_sample_is_sent_and_held_in_few_bytes():
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(400)) for _ in range(5)] + ["ab " * 70_000, "é"]
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 7), pa.array([False] * 7), pa.array(texts)], ["lang", "back", "text"])
    sent = [row for part in langid._sampled_counts([batch]) for row in part.to_pylist()]
    plain = [np.unique(langid.subwords(langid.words_of(t))[0], return_counts=True) for t in texts]
    for row, (bucket, n) in list(zip(sent, plain))[:5]:
        assert sum(len(x) for x in row.values() if isinstance(x, bytes)) <= 4 * len(bucket)
    sample = langid.Sample([(row["lang"], row["buckets"], row["counts"]) for row in sent])
    for (lang, bucket, share), (expected, n) in zip(sample, plain, strict=True):
        assert lang == "x" and np.array_equal(bucket, expected)
        assert np.array_equal(share, (n / n.sum()).astype(np.float32).astype(float))


def test_language_edges(spark):
    r = random.Random(1)
    a = lambda: " ".join(r.choice(["thon", "edin", "wher", "ing"]) for _ in range(20))
    b = lambda: " ".join(r.choice(["çeau", "réle", "quoi", "émen"]) for _ in range(20))
    rows = [(i, a() if i % 2 else b(), "x" if i % 2 else "y", 1) for i in range(200)]
    rows += [(1000, None, "x", 1), (1001, "", "x", 1), (1002, "12 %% ½ _", "x", 1), (None, a(), "x", 1), (1003, b(), None, 1),
             (1003, b(), None, 1), (1004, "x" * 300_000, None, 1), (1005, a() * 20_000, None, 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    model = langid.train(frame, langid.learnable())
    got = langid.predict(frame, model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert (by_id[None].lang_pred, by_id[1003].lang_pred, by_id[1005].lang_pred) == ("x", "y", "x")
    kept = langid.keep_accepted(frame, model)
    assert kept.columns == frame.columns and not {1000, 1001, 1002} & {r.doc_id for r in kept.collect()}
    assert langid.train(frame.limit(0), langid.learnable()) is None
    nothing = langid.predict(frame, None)
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert langid.predict(frame.limit(0), model).count() == 0


def test_subwords_by_hand():
    """Equal n-grams share a bucket, whatever the word."""
    bucket, who = langid.subwords(["ab", "b", "abc"])
    n = [int((who == i).sum()) for i in range(3)]
    grams = lambda w: sum(len(f"<{w}>") - k + 1 for k in range(1, 6) if len(f"<{w}>") >= k)
    assert n == [grams("ab"), grams("b"), grams("abc")]
    one = langid.subwords(["ab"])[0]
    assert sorted(one) == sorted(bucket[who == 0])
    assert len(langid.subwords([])[0]) == 0


def test_toxicity_query(spark, small):
    got = {r.doc_id: r for r in queries.op8_fair_toxicity(spark, SF).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert got.keys() == docs.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(labels[i], got[i].predicted) for i in labels if got[i].held_out]
    assert sum(p for t, p in held if not t) <= 0.005 * sum(not t for t, _ in held)   # clean documents stay
    insults = {"idiot", "clown", "loser", "worthless", "scum", "moron", "pathetic", "disgusting", "trash", "stupid"}
    plain = [i for i, t in docs.items() if len(insults & set(t.lower().replace(".", " ").replace(",", " ").split())) >= 2
             and got[i].held_out]
    assert sum(got[i].predicted for i in plain) >= 0.97 * len(plain)


def test_counterfactual_balance_spares_group_mentions():
    """Labels where insults are often thrown at one group: without the
    balance the group's name alone is suspect, with it it isn't."""
    r = np.random.default_rng(3)
    names = ["idiot", "women", "men", "a", "b"]
    rows, before, after, labels = [], [], [], []
    for _ in range(600):
        toxic = r.random() < 0.4
        has = {"a", "b"} if r.random() < 0.5 else {"a"}
        if toxic and r.random() < 0.8:
            has.add("idiot")
        if r.random() < (0.7 if toxic else 0.05):
            has.add("women")
        elif r.random() < 0.1:
            has.add("men")
        rows.append(has)
        labels.append(float(toxic))
        for x, y in toxicity.counterfactuals(" ".join(sorted(has))):
            before.append(x)
            after.append(y)
    number = {n: i for i, n in enumerate(names)}
    code = lambda sets: toxicity.Rows([[number[w] for w in s if w in number] for s in sets], len(names))
    for_women = {}
    for balance in (0.0, 5.0):
        w, b = toxicity.fit(code(rows), np.array(labels), code(before), code(after), balance)
        model = toxicity.Model(dict(zip(names, w)), b)
        for_women[balance] = model.score("Women a b")
        assert model.score("women idiot") > 0.7
    assert for_women[0.0] > 0.6 > 0.45 > for_women[5.0]


def test_toxicity_edges(spark):
    r = random.Random(2)
    word = lambda: "w%d" % r.randrange(300)
    letters = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    docs = [(i, " ".join([letters() for _ in range(20)] + (["nasty"] if i % 3 == 0 else [])), "s") for i in range(300)]
    docs += [(1000, None, "s"), (1001, "", "s"), (None, "nasty nasty", "s"), (1002, "NASTY. " + "fine " * 200_000, "s"),
             (1002, "nasty", "s")]
    labels = [(i, int(i % 3 == 0), 5) for i in range(300)] + [(0, 0, 5), (1, None, 5), (None, 1, 5), (7777, 1, 5)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, score string")
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int, text int")
    model = toxicity.train(frame, table, toxicity.learnable())
    got = toxicity.score(frame, model).collect()
    assert len(got) == len(docs)
    by_id = {}
    for x in got:
        by_id.setdefault(x.doc_id, []).append(x.score)
    assert by_id[1000] == by_id[1001] and by_id[1000][0] < 0.5
    assert by_id[None][0] > 0.7 and all(s > 0.7 for s in by_id[1002])
    assert all((s[0] > 0.7) == (i % 3 == 0) for i, s in by_id.items() if i is not None and i < 300)
    kept = toxicity.keep_clean(frame, model)
    assert kept.columns == frame.columns and {None, 1002}.isdisjoint({x.doc_id for x in kept.collect()})
    none = toxicity.train(frame, table.limit(0), toxicity.learnable())
    assert {x.score for x in toxicity.score(frame, none).collect()} == {0.0}
    assert toxicity.score(frame.limit(0), model).count() == 0


def test_language_columns_may_clash(spark):
    rows = [(i, t, l, 1, 2, 3) for i, (t, l) in enumerate([("the cat sat on the mat", "en"), ("der hund liegt auf dem boden", "de")] * 20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, _lang int, _rate int, _first int")
    model = langid.train(frame, langid.learnable())
    assert langid.keep_accepted(frame, model).columns == frame.columns


def test_words_are_folded_in_small_groups():
    """Many new words at once: the subwords of few are held, with the same result."""
    rng = np.random.default_rng(3)
    model = langid.Model(["a", "b"], rng.normal(size=(langid.BUCKETS, langid.DIMENSIONS)),
                         rng.normal(size=(langid.DIMENSIONS, 2)), np.zeros(2))
    words = ["".join(w) for w in rng.choice(list("abcdefghij"), (3 * langid.LEARNED, 7))]
    sizes, plain = [], langid.Predictor(model)
    learn = plain._learn
    plain._learn = lambda ws: (sizes.append(len(ws)), learn(ws))
    got = plain.predict([" ".join(words)])
    assert max(sizes) <= langid.LEARNED and len(sizes) >= 3
    whole = model.logits(*np.unique(langid.subwords(words)[0], return_counts=True))
    n = len(langid.subwords(words)[0])
    p = langid.softmax((whole - model.bias) / n + model.bias)
    assert got[0][0] == model.languages[int(p.argmax())] and abs(got[0][1] - p.max()) < 1e-9

"""Multi-word terms learned from the corpus.

The reference joins syllables into words with a pretrained per-row
segmenter.  Here the joining is learned from the corpus itself as a Spark
job (collocation scores, Mikolov et al. 2013), so tokens differ from the
reference's segmenter output by design.

T9a  score(a, b) = (n_ab - min_count) * n_terms / (n_a * n_b); adjacent pairs
     with n_ab >= min_count and score > threshold become phrases.
T9b  greedy, left to right, non-overlapping: a pair starting at position p is
     joined as ``a_b`` unless position p-1 was the start of a joined pair.
     Over the sorted match positions of a document, a run of consecutive
     starts s, s+1, s+2, ... is resolved as s, s+2, s+4, ...
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicforge.operators import chunks as ck
from topicforge.operators.common import slices


@dataclass(frozen=True)
class PhraseParams:
    min_count: int = 5
    threshold: float = 10.0
    # phrase tables up to this size are broadcast; larger ones shuffle-join
    broadcast_rows: int = 100_000


def adjacent_pairs(tokens: DataFrame) -> DataFrame:
    """``(doc_id, pos, a, b)`` for every adjacent token pair (pos of ``a``)."""
    nxt = F.slice("tokens", 2, F.greatest(F.size("tokens") - 1, F.lit(0)))
    cur = F.slice("tokens", 1, F.greatest(F.size("tokens") - 1, F.lit(0)))
    z = F.arrays_zip(cur.alias("a"), nxt.alias("b"))
    return (tokens.select("doc_id", F.posexplode_outer(z).alias("pos", "p"))
            .where(F.col("p").isNotNull())
            .select("doc_id", "pos", F.col("p.a").alias("a"), F.col("p.b").alias("b")))


def score_phrases(tokens: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """``(a, b, n_ab, n_a, n_b, score)`` of the pairs kept as phrases."""
    uni = (tokens.select(F.explode_outer("tokens").alias("t")).where(F.col("t").isNotNull())
           .groupBy("t").agg(F.count(F.lit(1)).alias("n")))
    n_terms = uni.count()
    pairs = adjacent_pairs(tokens).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_ab"))
    pairs = pairs.where(F.col("n_ab") >= p.min_count)
    # the unigram table grows with the vocabulary: never broadcast it (a
    # sort-merge join; AQE splits a hot token such as a very common word)
    ua = uni.select(F.col("t").alias("a"), F.col("n").alias("n_a")).hint("merge")
    ub = uni.select(F.col("t").alias("b"), F.col("n").alias("n_b")).hint("merge")
    scored = (pairs.join(ua, "a").join(ub, "b")
              .withColumn("score", (F.col("n_ab") - p.min_count) * F.lit(float(n_terms))
                          / (F.col("n_a") * F.col("n_b"))))
    return scored.where(F.col("score") > p.threshold).select("a", "b", "n_ab", "n_a", "n_b", "score")


def _apply_in_rows(tokens: DataFrame, phrases: set[tuple[str, str]], joiner: str) -> DataFrame:
    sent = tokens.sparkSession.sparkContext.broadcast(phrases)

    def joined(toks: list[str]) -> list[str]:
        known, out, at = sent.value, [], 0
        while at < len(toks):
            if at + 1 < len(toks) and (toks[at], toks[at + 1]) in known:
                out.append(toks[at] + joiner + toks[at + 1])
                at += 2
            else:
                out.append(toks[at])
                at += 1
        return out

    def part(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([joined(t) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))],
                ["doc_id", "tokens"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "tokens").mapInArrow(part, f"doc_id {kind}, tokens array<string>")


def apply_phrases(tokens: DataFrame, phrases: DataFrame, p: PhraseParams = PhraseParams(),
                  joiner: str = "_") -> DataFrame:
    """``(doc_id, tokens)`` with phrase pairs joined by ``joiner``.

    A phrase table within ``p.broadcast_rows`` is sent to the tasks, which
    join the pairs inside each document: no token leaves its row.  A larger
    one is joined by (token, next token) over one row per position, and
    windows over ``doc_id`` resolve the runs; both give the same tokens.
    """
    rows = phrases.select("a", "b").limit(p.broadcast_rows + 1).collect()
    if len(rows) <= p.broadcast_rows:
        return _apply_in_rows(tokens, {(r["a"], r["b"]) for r in rows}, joiner)
    phr = phrases.select(F.col("a").alias("tok"), F.col("b").alias("nxt"), F.lit(True).alias("cand"))
    by_doc = Window.partitionBy("doc_id").orderBy("pos")
    toks = (tokens.select("doc_id", F.posexplode_outer("tokens").alias("pos", "tok"))
            .where(F.col("tok").isNotNull())
            .withColumn("nxt", F.lead("tok").over(by_doc)))
    marked = toks.join(phr, ["tok", "nxt"], "left").withColumn("cand", F.coalesce("cand", F.lit(False)))
    # runs of consecutive candidate starts: s, s+1, ... -> keep s, s+2, ...
    rn = F.row_number().over(Window.partitionBy("doc_id", "cand").orderBy("pos"))
    marked = marked.withColumn("grp", F.col("pos") - rn)
    run0 = F.min("pos").over(Window.partitionBy("doc_id", "cand", "grp"))
    marked = marked.withColumn("start", F.col("cand") & (((F.col("pos") - run0) % 2) == 0))
    marked = marked.withColumn("cont", F.coalesce(F.lag("start").over(by_doc), F.lit(False)))
    out = marked.where(~F.col("cont")).select(
        "doc_id", "pos",
        F.when(F.col("start"), F.concat_ws(joiner, "tok", "nxt")).otherwise(F.col("tok")).alias("tok"))
    return (out.groupBy("doc_id")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "tok"))).alias("_s"))
            .select("doc_id", F.transform("_s", lambda s: s["tok"]).alias("tokens")))


def join_corpus(tokens: DataFrame, p: PhraseParams = PhraseParams(), joiner: str = "_") -> DataFrame:
    """``apply_phrases(tokens, score_phrases(tokens))``, whatever the number of
    phrases: chunks of texts ask for the counts of their distinct tokens and
    pairs (``chunks.py``), score the pairs and join them, so no pair has a row
    per place."""
    corpus = ck.Corpus(tokens, p.min_count)
    n_terms = float(corpus.count(1).agg(F.sum("words")).first()[0] or 0)
    corpus.count(2)

    def part(chunk: ck.Chunk, row: dict):
        pairs, n = chunk.levels[2], chunk.levels[1].count
        at = pairs.at[pairs.number[pairs.run] >= 0]
        run = pairs.run[pairs.number[pairs.run] >= 0]
        score = (pairs.count[run] - p.min_count) * n_terms / (n[chunk.ids[at]] * n[chunk.ids[at + 1]])
        at = at[score > p.threshold]
        # runs of consecutive starts: s, s+1, ... -> s, s+2, ...; a text's last
        # token starts no pair, so no run reaches into the next text
        new = np.diff(at, prepend=-2) > 1
        at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))) % 2 == 0]
        length = np.ones(len(chunk.ids), dtype=np.int64)
        length[at], length[at + 1] = 2, 0
        yield from ck.joined(chunk, row["doc_ids"], length, joiner)

    return corpus.each(part, f"doc_id {corpus.kind}, tokens array<string>")


def phrase_stopwords(words: list[str], joiner: str = "_") -> list[str]:
    """Stopword entries written with spaces (multi-word entries) in the form
    joined tokens take once phrases are applied (``a b`` -> ``a_b``);
    otherwise such an entry could never match a token."""
    return sorted({joiner.join(w.split()) for w in words if w.strip()})


def drop_stopwords(tokens: DataFrame, stopwords: list[str], joiner: str = "_") -> DataFrame:
    """T11 after T9b: remove stopwords (normalised with ``phrase_stopwords``)
    and tokens shorter than 2 characters from phrase-joined token arrays."""
    from topicforge.functions.text import filter_tokens
    sw = phrase_stopwords(stopwords, joiner)
    return tokens.select("doc_id", filter_tokens(F.col("tokens"), sw).alias("tokens"))

"""Term frequencies, vocabulary and TF-IDF weights.

Semantics kept from the reference's vectorizer call:

* tokens are the processed tokens (runs of >= 2 word characters);
* vocabulary: terms with ``min_df <= df <= max_df * n_docs``, then the
  ``max_features`` terms with the largest corpus count (ties: term ascending),
  indexed in alphabetical (code-point) order;
* ``idf = ln((1 + n) / (1 + df)) + 1`` (smoothed), ``weight = tf * idf``,
  then each document is scaled to unit L2 norm (a document with no vocabulary
  term keeps no row: its vector is zero).

Plan shape (see README "Scale notes"): a document is one row, so its terms are
counted, weighed and scaled inside that row; only the document frequencies are
shuffled (a partial sum per term and task), and the vocabulary, capped at
``max_features`` rows, is broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicforge.functions import text as tx
from topicforge.operators.common import BROADCAST_ROW_LIMIT, dense_index, keep_where, slices, written


def document_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    stopwords: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """T1-T12 + P3: ``(doc_id, tokens)`` for documents with at least one
    token (blank documents are dropped, as the reference does)."""
    extra = [F.col(c) for c in (keep or [])]
    out = docs.select(F.col(id_col).alias("doc_id"), *extra,
                      tx.processed_tokens(F.col(text_col), stopwords).alias("tokens"))
    return keep_where(out, F.size("tokens") > 0)


def plain_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, tokens string)``, texts whose tokens are the matches of
    ``tx.RE_TOKEN``, for readers that cut them in their own tasks."""
    return docs.select(F.col(id_col).alias("doc_id"), F.lower(tx.strip_links(F.col(text_col))).alias("tokens"))


def _cut(docs: DataFrame, text, kept: list, fields, added: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """T1-T13 of each document in one task: ``kept`` columns and the ``added``
    ones ``(name, type, Arrow type)`` that ``fields(tokens)`` gives; documents
    without a token are dropped (P3).  The links are taken out by the JVM; the
    text is cut here, where one search for runs of kept letters does what
    replacing, splitting and filtering does there."""
    names, find = [*(f.name for f in kept), *(n for n, _, _ in added)], re.compile(tx.RE_TOKEN)

    def part(batches):
        cut = find.findall
        for batch in slices(batches):
            rows = [fields(cut(text)) for text in batch.column(0).to_pylist()]
            mask = pa.array([row is not None for row in rows], pa.bool_())
            rows = [row for row in rows if row is not None]
            columns = list(zip(*rows)) or [()] * len(added)
            yield pa.RecordBatch.from_arrays([*(c.filter(mask) for c in batch.columns[1:]),
                                              *(pa.array(c, t) for c, (_, _, t) in zip(columns, added))], names)

    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{n} {t}" for n, t, _ in added)])
    plain = F.lower(tx.strip_links(text)).alias("_text")
    return docs.select(plain, *[F.col(f"`{f.name}`") for f in kept]).mapInArrow(part, shape)


def count_texts(docs: DataFrame, text_col: str, stopwords: list[str] | None = None, drop: bool = False) -> DataFrame:
    """T1-T12, P3 and F2 at once: the columns of ``docs`` (with ``drop`` all but
    the text) with ``terms`` and ``tfs`` of the text, as ``count_terms`` gives
    them for its tokens; documents without a token are dropped."""
    out = frozenset(stopwords or ())

    def fields(tokens):
        counts = Counter(tokens)
        for word in out & counts.keys():
            del counts[word]
        return (list(counts), list(counts.values())) if counts else None

    kept = [f for f in docs.schema.fields if not drop or f.name != text_col]
    return _cut(docs, F.col(f"`{text_col}`"), kept, fields, [("terms", "array<string>", pa.list_(pa.string())),
                                                         ("tfs", "array<bigint>", pa.list_(pa.int64()))])


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    stopwords: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """``count_terms(document_tokens(...))`` without the tokens in between."""
    named = docs.select(F.col(id_col).alias("doc_id"), *[F.col(c) for c in keep or []], F.col(text_col).alias("_raw"))
    return count_texts(named, "_raw", stopwords, drop=True)


def processed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, processed_content)``."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_raw"))
    return _cut(named, F.col("_raw"), named.schema.fields[:1], lambda tokens: (" ".join(tokens),) if tokens else None,
                [("processed_content", "string", pa.string())])


def count_terms(tokens: DataFrame) -> DataFrame:
    """F2 inside each document: ``(doc_id, terms, tfs)`` with its distinct
    terms in first-occurrence order and their counts, and whatever other
    columns ``tokens`` has.  A document is one row, so nothing is shuffled."""
    kept = [f for f in tokens.schema.fields if f.name != "tokens"]
    names = [f.name for f in kept] + ["terms", "tfs"]

    def part(batches):
        for batch in slices(batches):
            counts = [Counter(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([list(c) for c in counts], pa.list_(pa.string())),
                 pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))], names)

    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "terms array<string>", "tfs array<bigint>"])
    return tokens.select("tokens", *[F.col(f"`{f.name}`") for f in kept]).mapInArrow(part, shape)


def term_rows(counted: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, term, tf)`` rows of counted documents, with ``carry``."""
    return (counted.select("doc_id", *carry, F.explode(F.arrays_zip("terms", "tfs")).alias("_t"))
            .select("doc_id", *carry, F.col("_t.terms").alias("term"), F.col("_t.tfs").alias("tf")))


def term_counts(tokens: DataFrame) -> DataFrame:
    """raw count of each term in each document ``(doc_id, term, tf)``."""
    return term_rows(count_terms(tokens))


def term_stats(counts: DataFrame) -> DataFrame:
    """document frequency and corpus count per term ``(term, df, tf)``."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"),
                                      F.sum("tf").alias("tf"))


@dataclass(frozen=True)
class VocabParams:
    min_df: int = 5
    max_df: float = 0.8
    max_features: int | None = 5000


def fit_vocabulary(counts: DataFrame, n_docs: int, p: VocabParams = VocabParams()) -> DataFrame:
    """``(term, idx, df, tf, idf)``.

    ``max_df`` is a proportion of ``n_docs`` (float) or a document count (int),
    as in the reference; ``min_df`` likewise.
    """
    hi = p.max_df * n_docs if isinstance(p.max_df, float) else p.max_df
    lo = p.min_df * n_docs if isinstance(p.min_df, float) else p.min_df
    stats = term_stats(counts).where((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi)))
    if p.max_features is not None:
        # TakeOrderedAndProject: per-task top-k, then one bounded merge.
        stats = stats.orderBy(F.desc("tf"), F.asc("term")).limit(p.max_features)
    vocab = dense_index(stats, [F.asc("term")], "idx", bound=p.max_features)
    return vocab.select(
        "term", F.col("idx").cast("int").alias("idx"), "df", "tf",
        (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))


#: Documents that a task weighs at a time.
WEIGH_ROWS = 1024


def weigh(counted: DataFrame, vocab: DataFrame, packed: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """F6-F7 (and F8 for unseen documents): unit-L2 TF-IDF rows
    ``(doc_id, idx, term, weight)`` for the vocabulary terms of each document,
    or with ``packed`` one row ``(doc_id, idxs, vals)`` for each document.
    Columns named in ``carry`` come along from ``counted``.

    A vocabulary within the broadcast limit is sent to the tasks, which weigh
    and scale each document where it is; a larger one (no ``max_features``) is
    joined by term and the norms summed by document."""
    known = vocab.select("term", "idx", "idf")
    rows = known.limit(BROADCAST_ROW_LIMIT + 1).collect()
    own = ["doc_id", *carry]
    if len(rows) > BROADCAST_ROW_LIMIT:
        raw = term_rows(counted, carry).join(known, "term").withColumn("w", F.col("tf") * F.col("idf"))
        norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
        long = raw.select(*own, "idx", "term", (F.col("w") / norm).alias("weight"))
        return _pack(counted, long, own) if packed else long
    sent = counted.sparkSession.sparkContext.broadcast((
        pa.array([r["term"] for r in rows], pa.string()), np.array([r["idx"] for r in rows], dtype=np.int32),
        np.array([r["idf"] for r in rows], dtype=np.float64)))

    def part(batches):
        known, index, idf = sent.value
        for batch in slices(batches, WEIGH_ROWS):
            terms, tfs = batch.column(0), batch.column(1)
            at = pc.index_in(terms.flatten(), value_set=known)
            hit = at.is_valid()
            at = at.drop_null().to_numpy(zero_copy_only=False)
            found = hit.to_numpy(zero_copy_only=False)
            w = tfs.flatten().to_numpy(zero_copy_only=False)[found] * idf[at]
            ends = np.cumsum(terms.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            offsets = np.concatenate([[0], np.concatenate([[0], np.cumsum(found)])[ends]])
            squares = (w * w).tolist()
            norms = np.array([math.sqrt(math.fsum(squares[a:b])) for a, b in zip(offsets, offsets[1:])])
            w /= np.repeat(norms, np.diff(offsets))
            cut = pa.array(offsets.astype(np.int32))
            names = [] if packed else [pa.ListArray.from_arrays(cut, terms.flatten().filter(hit))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.ListArray.from_arrays(cut, pa.array(index[at])),
                 pa.ListArray.from_arrays(cut, pa.array(w)), *names],
                [*own, "idx", "weight", *["term"] * len(names)])

    shape = ", ".join([*(f"`{c}` {counted.schema[c].dataType.simpleString()}" for c in own),
                       "idx array<int>", "weight array<double>", *([] if packed else ["term array<string>"])])
    rows = counted.select("terms", "tfs", *own).mapInArrow(part, shape)
    if packed:
        return rows.select(*own, F.col("idx").alias("idxs"), F.col("weight").alias("vals"))
    return (rows.select(*own, F.explode(F.arrays_zip("idx", "term", "weight")).alias("_t"))
            .select(*own, "_t.idx", "_t.term", "_t.weight"))


def _pack(counted: DataFrame, long: DataFrame, own: list[str]) -> DataFrame:
    sparse = long.groupBy("doc_id").agg(F.collect_list(F.struct("idx", "weight")).alias("e")).select(
        "doc_id", F.col("e.idx").alias("idxs"), F.col("e.weight").alias("vals"))
    none = lambda c, t: F.coalesce(c, F.array().cast(t)).alias(c)
    return counted.select(*own).join(sparse, "doc_id", "left").select(
        *own, none("idxs", "array<int>"), none("vals", "array<double>"))


def matrix_shape(weights: DataFrame, n_docs: int) -> DataFrame:
    """rows, columns used and non-zeros of the sparse matrix."""
    return weights.agg(F.lit(n_docs).cast("long").alias("n_rows"),
                       F.countDistinct("idx").alias("n_cols_used"),
                       F.count(F.lit(1)).alias("nnz"))


@dataclass
class TfidfModel:
    """Fitted state (S9): the vocabulary table plus the corpus size."""
    vocabulary: DataFrame
    n_docs: int
    params: VocabParams

    def transform(self, tokens: DataFrame) -> DataFrame:
        """F8: weights of (possibly unseen) documents with the stored vocabulary."""
        return weigh(count_terms(tokens), self.vocabulary)

    def save(self, path: str) -> None:
        """Store the vocabulary and the fit's parameters as two tables."""
        spark = self.vocabulary.sparkSession
        self.vocabulary.write.parquet(f"{path}/vocabulary")
        p = self.params
        spark.createDataFrame([(self.n_docs, float(p.min_df), isinstance(p.min_df, float), float(p.max_df),
                                isinstance(p.max_df, float), p.max_features)],
                              "n_docs long, min_df double, min_share boolean, max_df double, max_share boolean, "
                              "max_features long").write.parquet(f"{path}/parameters")

    @staticmethod
    def load(spark, path: str) -> "TfidfModel":
        r = spark.read.parquet(f"{path}/parameters").first()
        share = lambda v, is_share: v if is_share else int(v)
        return TfidfModel(spark.read.parquet(f"{path}/vocabulary"), r["n_docs"],
                          VocabParams(share(r["min_df"], r["min_share"]), share(r["max_df"], r["max_share"]),
                                      r["max_features"]))


def fit_counted(tokens: DataFrame, p: VocabParams = VocabParams()) -> tuple[TfidfModel, DataFrame]:
    """Fit the vocabulary on ``tokens`` and return (model, counted documents).
    The counted documents are written to the checkpoint folder once and read
    by all that follows, so the cleaning runs once and nothing stays cached."""
    return fit_counts(count_terms(tokens), p)


def fit_counts(counted: DataFrame, p: VocabParams = VocabParams()) -> tuple[TfidfModel, DataFrame]:
    """``fit_counted`` of counted documents."""
    counted = written(counted, "counts")
    n_docs = counted.count()
    vocab = fit_vocabulary(term_rows(counted), n_docs, p)
    if p.max_features is not None:
        vocab = vocab.checkpoint()
    return TfidfModel(vocab, n_docs, p), counted


def fit_tfidf(tokens: DataFrame, p: VocabParams = VocabParams()) -> tuple[TfidfModel, DataFrame]:
    """Fit the vocabulary on ``tokens`` and return (model, weights)."""
    model, counted = fit_counted(tokens, p)
    return model, weigh(counted, model.vocabulary)

"""Toxicity: a counterfactual-regularised linear classifier.

Features of a text are the presence of words and of their first four
letters.  Of all features of the
training sample those are kept that stand in toxic texts far more often than
in others (a score test and a lift over counts that Spark gathers).

The classifier is logistic with an L1 penalty, so that it explains the labels
by few features.  For fairness each sentence of a labelled text that names a
group (``IDENTITY_TERMS``) is repeated with that term swapped for the others
of its kind and taken out; the loss also has ``balance`` times the mean square
of the change of the logit, which pulls the weights of mere group mentions
together and to zero.  A part of the sample is held back to scale the logits
(Platt).

Bounds: the sample has about ``MOST_TOXIC`` and ``MOST_CLEAN`` labelled rows,
drawn by a hash of the id, one for each set of near copies (texts with the
same smallest shingle); only its selected features reach the driver.  Scoring
reads whole texts where they are scanned, with no shuffle.

Defined results: null and empty texts get the score of a text without any
feature; with no labels at all every score is 0; several labels of one id
count as toxic if one is; null ids are scored but not learned from; repeated
rows repeat.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicforge.llm.common import LETTERS, crc_mod, scratch_table, slices

MOST_TOXIC, MOST_CLEAN = 3000, 6000
MOST_FEATURES = 2048
THRESHOLD = 0.7
BEGINNINGS = (4,)

#: Words that name groups of people, by kind.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys", "transgender", "nonbinary"],
    ["woman", "man", "girl", "boy"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["black", "white", "asian", "latino", "african", "european", "arab", "indigenous"],
    ["gay", "lesbian", "bisexual", "straight", "queer"],
    ["immigrants", "refugees", "foreigners", "migrants", "citizens"],
    ["disabled", "deaf", "blind", "autistic"],
    ["old", "young", "elderly"],
    ["frauen", "männer"], ["femmes", "hommes"], ["mujeres", "hombres"],
]
_OTHERS = {term: [t for t in kind if t != term] for kind in IDENTITY_TERMS for term in kind}
_SENTENCE = re.compile(r"[.!?\n]+")


def features(words: set[str], beginnings=BEGINNINGS) -> set[str]:
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in beginnings))


def words_of(text: str | None) -> set[str]:
    return set(LETTERS.findall(text.lower())) if text else set()


def counterfactuals(text: str) -> list[tuple[set[str], set[str]]]:
    """Word sets of each sentence that names a group, before and after."""
    pairs = []
    for sentence in _SENTENCE.split(text.lower()):
        words = set(LETTERS.findall(sentence))
        for term in sorted(words & _OTHERS.keys()):
            for other in [*_OTHERS[term], ""]:
                pairs.append((words, (words - {term}) | ({other} if other else set())))
    return pairs


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -1e9
    scale: float = 1.0
    shift: float = 0.0

    @cached_property
    def beginnings(self) -> list[int]:
        """Lengths of word beginnings that have a weight."""
        return sorted({len(f) - 1 for f in self.weights if f.endswith("*")})

    def score(self, text: str | None) -> float:
        found = self.weights.keys() & features(words_of(text), self.beginnings)
        z = self.bias + sum(self.weights[f] for f in sorted(found))
        z = self.scale * z + self.shift
        return float(1 / (1 + np.exp(-z))) if z > -700 else 0.0


class Rows:
    """A sparse 0/1 matrix."""

    def __init__(self, rows: list[list[int]], width: int):
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows]) if rows else np.zeros(0, int)
        self.col = np.fromiter((c for r in rows for c in r), np.int64, len(self.row))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, r[self.row], self.width)


def fit(x: Rows, y: np.ndarray, before: Rows, after: Rows, balance: float = 1.0, l1: float = 1e-4,
        steps: int = 600) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated proximal gradient steps on the mean
    logistic loss + balance * mean(change of the logit)**2 + l1 * |w|."""
    w, b = np.zeros(x.width), 0.0
    at, bat = w.copy(), b
    size = np.bincount(x.row, minlength=x.n)
    curve = 0.25 * (size.max(initial=0) + 1)
    if before.n:
        change = np.bincount(before.row, minlength=before.n) + np.bincount(after.row, minlength=after.n)
        curve += 2 * balance * change.max()
    t = 1.0
    for _ in range(steps):
        error = (1 / (1 + np.exp(-np.clip(x.times(at) + bat, -50, 50))) - y) / x.n
        slope, bias_slope = x.back(error), error.sum()
        if before.n:
            moved = 2 * balance * (before.times(at) - after.times(at)) / before.n
            slope = slope + before.back(moved) - after.back(moved)
        stepped = at - slope / curve
        new = np.sign(stepped) * np.maximum(np.abs(stepped) - l1 / curve, 0)
        new_b = bat - bias_slope / curve
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        at, bat = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    return w, float(b)


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale (0.5 to 4) and shift of the logits of best likelihood."""
    if len(z) < 20 or y.min() == y.max():
        return 1.0, 0.0
    y = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    loss = lambda a, c: np.logaddexp(0, a * z + c).mean() - (y * (a * z + c)).mean()
    return min(((a, c) for a in np.geomspace(0.5, 4, 25) for c in np.linspace(-3, 3, 61)), key=lambda p: loss(*p))


def _sampled(batches):
    """Label, held back or not, near-copy mark, words, and counterfactual
    pairs (as before | after) of each sampled text."""
    for part in slices(batches):
        rows = []
        for label, back, text in zip(*(part.column(i).to_pylist() for i in range(3))):
            in_order = LETTERS.findall((text or "").lower())
            mark = min((zlib.crc32(" ".join(in_order[i:i + 5]).encode()) for i in range(max(1, len(in_order) - 4))))
            pairs = counterfactuals(text or "")
            rows.append((label, back, mark, sorted(features(set(in_order))),
                         [sorted(features(a)) for a, _ in pairs], [sorted(features(b)) for _, b in pairs]))
        strings = pa.list_(pa.string())
        types = [pa.int32(), pa.bool_(), pa.int64(), strings, pa.list_(strings), pa.list_(strings)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)],
                                         ["label", "back", "mark", "has", "before", "after"])


def select_features(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """Features that are far more frequent in toxic texts."""
    n = toxic + clean
    counts = sample.select("label", F.explode("has").alias("f")).groupBy("f").agg(
        F.sum("label").alias("t"), F.count("*").alias("n"))
    share = F.col("n") / n
    z = (F.col("t") - toxic * share) / F.sqrt(n * share * (1 - share) * (toxic / n) * (clean / n) + 1e-9)
    lift = (F.col("t") / toxic) / ((F.col("n") - F.col("t") + 0.5) / (clean + 1))
    kept = (counts.where((F.col("t") >= 3) & (F.col("n") < n) & (z >= 4) & (lift >= 3))
            .orderBy(z.desc(), "f").limit(MOST_FEATURES).collect())
    return [r["f"] for r in kept]


def train(docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", balance: float = 1.0) -> Model:
    """Fit on a bounded sample of the labels where ``learnable`` holds."""
    known = (labels.where(learnable & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_id"))
             .agg(F.max(F.col(label_col).cast("int")).alias("_label")))
    count = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if not count.get(1) or not count.get(0):
        return Model()
    place = lambda word: F.pmod(F.xxhash64("_id", F.lit(word)), F.lit(1 << 30)) / float(1 << 30)
    rate = F.when(F.col("_label") == 1, min(1.0, MOST_TOXIC / count[1])).otherwise(min(1.0, MOST_CLEAN / count[0]))
    ids = known.where(place("sample") < rate)  # a bounded number of ids
    texts = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(ids), "_id")
             .select("_label", (place("back") < 0.2).alias("_back"), "_text"))
    sample = scratch_table(texts.mapInArrow(
        _sampled, "label int, back boolean, mark bigint, has array<string>, before array<array<string>>, "
                  "after array<array<string>>").dropDuplicates(["label", "mark"]), "toxicity")
    fitted = sample.where("not back")
    size = {r["label"]: r["n"] for r in fitted.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not size.get(1) or not size.get(0):
        return Model()
    chosen = select_features(fitted, size[1], size[0])
    terms = sorted(t for t in _OTHERS if t not in chosen)
    number = {f: i for i, f in enumerate(chosen + terms)}
    only = lambda words: F.filter(words, lambda f: F.array_contains(F.lit(list(number)), f))
    rows = sample.select("label", "back", only(F.col("has")).alias("has"),
                         F.transform("before", only).alias("before"), F.transform("after", only).alias("after")).collect()
    rows.sort(key=lambda r: (r["label"], r["has"], r["before"], r["after"]))
    coded = lambda rows: Rows([[number[f] for f in has] for has in rows], len(number))
    fit_rows, held = [r for r in rows if not r["back"]], [r for r in rows if r["back"]]
    w, b = fit(coded([r["has"] for r in fit_rows]), np.array([r["label"] for r in fit_rows], float),
               coded([s for r in fit_rows for s in r["before"]]), coded([s for r in fit_rows for s in r["after"]]), balance)
    scale, shift = platt(coded([r["has"] for r in held]).times(w) + b if held else np.zeros(0),
                         np.array([r["label"] for r in held], float))
    return Model({f: float(w[i]) for f, i in number.items() if w[i]}, b, float(scale), float(shift))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, score)`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # MOST_FEATURES weights

    def run(batches):
        for part in slices(batches):
            scores = [sent.value.score(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores below the threshold, with all columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for part in slices(batches):
            keep = pa.array([sent.value.score(t) < threshold for t in part.column(at).to_pylist()])
            yield part.filter(keep) if pc.any(keep).as_py() else part.slice(0, 0)

    return docs.mapInArrow(run, docs.schema)


def learnable(id_col: str = "doc_id") -> Column:
    """Rows that the label may be learned from."""
    return crc_mod(id_col, 3) != 1

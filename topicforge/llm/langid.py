"""Language identification: averaged hashed subword embeddings, linear softmax.

A word's subwords are the character n-grams of ``<word>`` (n = 1 to 5), hashed
into a fixed table of embeddings.  A text is the average of the embeddings of
all its subwords, and a linear softmax over that average gives the languages.
Both are trained by stochastic gradient descent in numpy on a sample of
labelled rows; one part of the sample is held back to fit the temperature of
the softmax and the rejection threshold: a text is rejected if its confidence
is below what all but ``reject_share`` of the rightly labelled ones reach.

Bounds: the sample has about ``per_language`` rows for each label and
``MOST_ROWS`` in all, drawn by a hash of the id, but at least one row for each
label, which is fitted; a row sends at most one count for each hash bucket to
the driver, which holds the sample as it was sent (about 3 bytes a count) and
decodes a row when it is shown.  Prediction reads whole texts where they are scanned, with no
shuffle; as the model is linear, each distinct word is folded once into one
vector, whose length doesn't depend on the number of languages.

Defined results: null texts and texts without a letter are ``und`` with score
0 and rejected; so is every text when nothing can be learned.  Rows with a
null id are predicted but not learned from.  Repeated rows repeat.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicforge.llm.common import LETTERS, crc_mod, slices

MOST_ROWS = 20_000
UNKNOWN = "und"
BUCKETS, DIMENSIONS, LONGEST_GRAM = 1 << 15, 16, 5
REMEMBERED = 200_000
#: Words whose subwords are held unfolded at a time.
LEARNED = 1024


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket of every subword, and the index of its word (ascending)."""
    joined = "".join(f"<{w}>" for w in words)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), size)
    buckets, owners = [], []
    value = np.zeros(len(code), np.uint32)
    for n in range(1, LONGEST_GRAM + 1):
        if len(code) < n:
            break
        value = value[:len(code) - n + 1] * np.uint32(0x01000193) + code[n - 1:]
        own = owner[:len(value)] == owner[n - 1:]
        mixed = (value[own] ^ np.uint32(n)) * np.uint32(0x9E3779B1)
        buckets.append(mixed >> np.uint32(32 - BUCKETS.bit_length() + 1))
        owners.append(owner[:len(value)][own])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bucket, who = np.concatenate(buckets).astype(np.int64), np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    return bucket[order], who[order]


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray     # hash bucket -> dimensions
    weight: np.ndarray        # dimensions -> score of each language
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, buckets: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return (weights @ self.embedding[buckets]) @ self.weight + self.bias


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def encoded(text: str | None) -> tuple[bytes, bytes] | None:
    """Hash buckets of the text's subwords, and their counts in as few bytes
    as the largest needs; None without a word."""
    words = words_of(text)
    if not words:
        return None
    bucket, n = np.unique(subwords(words)[0], return_counts=True)
    return bucket.astype("<u2").tobytes(), n.astype(np.min_scalar_type(n.max())).tobytes()


def shares(buckets: bytes, counts: bytes) -> np.ndarray:
    n = np.frombuffer(counts, f"<u{2 * len(counts) // len(buckets)}").astype(np.int64)
    return (n / n.sum()).astype(np.float32)


class Sample(Sequence):
    """Encoded rows that are decoded one by one to (language, buckets, share
    of each bucket)."""

    def __init__(self, rows: list[tuple[str, bytes, bytes]]):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> tuple[str, np.ndarray, np.ndarray]:
        lang, buckets, counts = self.rows[i]
        return lang, np.frombuffer(buckets, "<u2"), shares(buckets, counts).astype(float)


def fit(rows: Sequence[tuple[str, np.ndarray, np.ndarray]], epochs: int = 4, rate: float = 0.5,
        seed: int = 7) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Languages, embeddings, weights and bias, by stochastic gradient descent
    over rows of (language, buckets, share of each bucket)."""
    languages = sorted({lang for lang, _, _ in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weight, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    # rare languages are shown as often as frequent ones
    members = {k: [] for k in languages}
    for i, r in enumerate(rows):
        members[r[0]].append(i)
    most = max(map(len, members.values()))
    steps = epochs * most * len(languages)
    done = 0
    for _ in range(epochs):
        shown = np.concatenate([np.resize(rng.permutation(m), most) for m in members.values()])
        for i in rng.permutation(shown):
            lang, buckets, share = rows[i]
            mean = share @ embedding[buckets]
            error = softmax(mean @ weight + bias)
            error[number[lang]] -= 1
            step = rate * (1 - done / steps)
            back = weight @ error
            weight -= step * np.outer(mean, error)
            bias -= 0.1 * step * error
            embedding[buckets] -= (step * len(buckets) ** 0.5) * np.outer(share, back)
            done += 1
    return languages, embedding, weight, bias


def calibrate(model: Model, rows: Sequence[tuple[str, np.ndarray, np.ndarray]], reject_share: float) -> None:
    """Temperature of the best likelihood, then the confidence that all but
    ``reject_share`` of the rightly predicted rows reach."""
    if not rows:
        return
    logits = np.stack([model.logits(b, s) for _, b, s in rows])
    number = {lang: i for i, lang in enumerate(model.languages)}
    truth = np.array([number.get(lang, -1) for lang, _, _ in rows])
    logits, truth = logits[truth >= 0], truth[truth >= 0]
    if not len(truth):
        return
    loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean()
    model.temperature = float(min(np.geomspace(0.2, 5, 33), key=loss))
    p = softmax(logits / model.temperature)
    right = p.max(1)[p.argmax(1) == truth]
    if len(right):
        model.threshold = float(min(0.5, np.quantile(right, reject_share, method="lower")))


class Predictor:
    def __init__(self, model: Model | None):
        self.model = model
        self.table, self.known = np.zeros((1024, DIMENSIONS + 1)), {}

    def _learn(self, words: list[str]) -> None:
        """Fold each word's subwords into one embedding, and their number."""
        bucket, who = subwords(words)
        first = np.searchsorted(who, np.arange(len(words)))
        folded = np.add.reduceat(np.column_stack([self.model.embedding[bucket], np.ones(len(bucket))]), first)
        at = len(self.known)
        while at + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[at:at + len(words)] = folded
        self.known.update(zip(words, range(at, at + len(words))))

    def predict(self, texts: Iterable[str | None]) -> list[tuple[str, float, bool]]:
        """Language, score and whether the text is rejected."""
        cut = [words_of(t) for t in texts]
        if not self.model:
            return [(UNKNOWN, 0.0, True) for _ in cut]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set(itertools.chain.from_iterable(cut)) - self.known.keys())
        for at in range(0, len(new), LEARNED):
            self._learn(new[at:at + LEARNED])
        out = []
        for words in cut:
            if not any(c.isalpha() for w in words for c in w):
                out.append((UNKNOWN, 0.0, True))
                continue
            total = self.table[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))].sum(0)
            p = softmax((total[:-1] / total[-1] @ self.model.weight + self.model.bias) / self.model.temperature)
            best = int(p.argmax())
            out.append((self.model.languages[best], float(min(p[best], 1.0)), bool(p[best] < self.model.threshold)))
        return out


def _sampled_counts(batches):
    """Language, whether held back, buckets and their counts of each text."""
    for part in slices(batches):
        kept = []
        for lang, back, text in zip(*(part.column(i).to_pylist() for i in range(3))):
            if code := encoded(text):
                kept.append((lang, back, *code))
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*kept)], ["lang", "back", "buckets", "counts"])


def train(docs: DataFrame, learnable: Column, text_col: str = "text", lang_col: str = "lang",
          id_col: str = "doc_id", per_language: int = 600, reject_share: float = 0.001) -> Model | None:
    """Fit and calibrate on a bounded sample of the rows where ``learnable``
    holds; None if there is nothing to learn from."""
    labelled = docs.where(learnable & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"[\p{L}\p{Nl}\p{No}]"))
    place = lambda word: F.pmod(F.xxhash64(id_col, F.lit(word)), F.lit(1 << 30)) / float(1 << 30)
    counts = (labelled.groupBy(F.col(lang_col).alias("lang"))
              .agg(F.count("*").alias("n"), F.min(place("sample")).alias("first")).collect())
    if not counts:
        return None
    each = min(per_language, max(1, MOST_ROWS // len(counts)))
    rates = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, each / r["n"]), r["first"]) for r in counts],
                                              "_lang string, _rate double, _first double")
    # only the columns used: others may have any names
    labelled = labelled.select(*dict.fromkeys([id_col, text_col, lang_col]))
    sample = (labelled.join(F.broadcast(rates), F.col(lang_col) == F.col("_lang"))
              .where((place("sample") < F.col("_rate")) | (place("sample") == F.col("_first")))
              .select(F.col(lang_col).alias("lang"), (place("back") < 0.25).alias("back"), F.col(text_col).alias("text"))
              .mapInArrow(_sampled_counts, "lang string, back boolean, buckets binary, counts binary").collect())
    # by content, so that the order of the tasks' answers doesn't matter
    ordered = sorted(((r["lang"], bytes(r["buckets"]), bytes(r["counts"]), r["back"]) for r in sample), key=lambda r: r[:2])
    rows = [r for _, alike in itertools.groupby(ordered, key=lambda r: r[:2])
            for r in sorted(alike, key=lambda r: shares(r[1], r[2]).tobytes())]
    del sample, ordered
    if not rows:
        return None
    # a label with held-back rows only is fitted on its first one
    fitted, learned, back = [], {r[0] for r in rows if not r[3]}, []
    for r in rows:
        (back if r[3] and r[0] in learned else fitted).append(r[:3])
        learned.add(r[0])
    model = Model(*fit(Sample(fitted)))
    calibrate(model, Sample(back), reject_share)
    return model


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, lang_pred, score, rejected)`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # hash buckets x languages

    def run(batches):
        predictor = Predictor(sent.value)
        for part in slices(batches):
            got = predictor.predict(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x, t) for x, t in zip(zip(*got), (pa.string(), pa.float64(), pa.bool_())))],
                [id_col, "lang_pred", "score", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double, rejected boolean")


def keep_accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows whose text isn't rejected, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        predictor = Predictor(sent.value)
        for part in slices(batches):
            keep = pa.array([not rejected for _, _, rejected in predictor.predict(part.column(at).to_pylist())])
            yield part.filter(keep) if pc.any(keep).as_py() else part.slice(0, 0)

    return docs.mapInArrow(run, docs.schema)


def learnable(id_col: str = "doc_id") -> Column:
    """Rows that the language label may be learned from."""
    return crc_mod(id_col, 4) != 2

"""Embedding whitening: components of the covariance by contour integration.

Each entry ``c`` of a vector becomes the whole number
``floor(1024 c) + 100000``.  One pass sums them exactly, a second sums the
products of what is left after centring, and the components are the largest
eigenpairs of that covariance (``feast``).  A third pass measures how far the
covariance of the whitened vectors is from the identity; the result is one
more projection.  Tasks hand on sums of fixed size (dimensions squared), never
rows; only those reach the driver.

Defined results: vectors that are null, or hold null or non-finite entries (or
entries whose whole number isn't a 64-bit integer) drop out; zero vectors take
part.  Vectors of one dimension are one fit list, so a table of several
dimensions has several.  Components without variance don't exist: a fit list
of one vector, or of equal ones, gives no rows.  Ids may be null or repeated;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.llm import feast

COMPONENTS = 8
#: Fit lists and dimensions that one table may have; sums grow with these.
MOST_LISTS, MOST_DIMENSIONS = 64, 8192
SCALE, OFFSET = 1024, 100_000

_SAFE = float(1 << 62)
_WHOLE = pa.decimal128(38, 0)


@dataclass
class Fit:
    """Sums of a fit list and what follows from them."""
    n: int
    sums: list[int]
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    trace: float = 0.0
    identity_error: float = 0.0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, whole: 64-bit where that is enough, else Python's
        integers."""
        small = float(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0) < _SAFE
        return x * self.n - np.asarray(self.sums, np.int64) if small else x.astype(object) * self.n - np.asarray(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(float)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors).astype(np.int64) + OFFSET


def usable(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(_id, _v)``: vectors whose entries are finite and have a whole number."""
    rows = frame.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    holds = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= (2.0 ** 63 - 2 * OFFSET) / SCALE))
    return rows.where(F.coalesce(holds, F.lit(False)) & (F.size("_v") > 0))


def _lists(batches):
    """``(ids, dimension, whole numbers)`` by fit list of each batch."""
    for batch in batches:
        vectors = batch.column(1)
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == d)
            part = batch.take(pa.array(rows))
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            for at in range(0, len(rows), 4096):
                stop = min(at + 4096, len(rows))
                yield part.column(0).slice(at, stop - at), d, whole_numbers(flat[at * d:stop * d].reshape(-1, d))


def _sums(batches):
    held: dict[int, list] = {}
    for _, d, x in _lists(batches):
        fit = held.setdefault(d, [0, [0] * d])
        small = float(np.abs(x).max(initial=0)) * len(x) < _SAFE
        total = x.sum(0) if small else x.astype(object).sum(0)
        fit[0] += len(x)
        fit[1] = [a + int(b) for a, b in zip(fit[1], total)]
    for d, (n, sums) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
             pa.array(list(map(Decimal, sums)), _WHOLE)], ["d", "place", "n", "total"])


def _products(of):
    """Sums of products of the columns of ``of(d, x)``, for each fit list."""
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for _, d, x in _lists(batches):
            y = of(d, x)
            if y is not None:
                held[d] = held.get(d, 0.0) + y.T @ y
        for d, total in held.items():
            upper = np.triu_indices(len(total))
            for at in range(0, len(upper[0]), 1 << 16):
                i, j = upper[0][at:at + (1 << 16)], upper[1][at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                     pa.array(total[i, j])], ["d", "i", "j", "total"])
    return run


def _collected(rows: DataFrame, of) -> dict[int, np.ndarray]:
    """The summed products as symmetric matrices."""
    out: dict[int, np.ndarray] = {}
    sums = rows.mapInArrow(_products(of), "d int, i int, j int, total double").groupBy("d", "i", "j").agg(F.sum("total").alias("total"))
    table = sums.toArrow()
    d, i, j, total = (table.column(c).to_numpy() for c in ("d", "i", "j", "total"))
    for one in np.unique(d).tolist():
        of_one = d == one
        size = int(j[of_one].max()) + 1
        matrix = np.zeros((size, size))
        matrix[i[of_one], j[of_one]] = total[of_one]
        matrix[j[of_one], i[of_one]] = total[of_one]
        out[one] = matrix
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of each dimension of ``usable`` rows."""
    sizes = [r[0] for r in rows.select(F.size("_v")).distinct().limit(MOST_LISTS + 1).collect()]
    if len(sizes) > MOST_LISTS or max(sizes, default=0) > MOST_DIMENSIONS:
        raise ValueError(f"more than {MOST_LISTS} different dimensions, or one above {MOST_DIMENSIONS}")
    sums = (rows.mapInArrow(_sums, "d int, place int, n bigint, total decimal(38,0)").groupBy("d", "place")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("d", "place").collect())
    fits: dict[int, Fit] = {}
    for r in sums:
        fits.setdefault(r.d, Fit(r.n, [])).sums.append(int(r.total))
    spark = rows.sparkSession.sparkContext
    sent = spark.broadcast(fits)
    for d, total in _collected(rows, lambda d, x: sent.value[d].centred(x)).items():
        covariance = total / fits[d].n
        fits[d].trace = float(np.trace(covariance))
        fits[d].values, fits[d].vectors = feast.largest_pairs(covariance, components)
    sent = spark.broadcast(fits)

    def with_one(d, x):
        one = sent.value[d]
        return np.hstack([one.whitened(x), np.ones((len(x), 1))]) if len(one.values) else None

    for d, total in _collected(rows, with_one).items():
        mean = total[:-1, -1] / fits[d].n
        covariance = total[:-1, :-1] / fits[d].n - np.outer(mean, mean)
        fits[d].identity_error = float(np.abs(covariance - np.eye(len(covariance))).max())
    return fits


def whiten(frame: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(<id>, component, n, deviation, whitened, explained,
    identity_error)``, one row for each vector and component; ``deviation`` is
    the exact sum of ``(n x - S)^2`` (null above 38 digits)."""
    rows = usable(frame, id_col, vector_col)
    sent = rows.sparkSession.sparkContext.broadcast(fit(rows, components))
    from pyspark.sql.pandas.types import to_arrow_type
    kind = frame.schema[id_col].dataType
    type_ = to_arrow_type(kind)
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def squares(deviations: np.ndarray) -> list[Decimal | None]:
        small = float(np.abs(deviations).max(initial=0)) ** 2 * deviations.shape[1] < _SAFE
        whole = (deviations if small else deviations.astype(object)) ** 2
        return [Decimal(int(s)) if s < 10 ** 38 else None for s in whole.sum(1)]

    def run(batches):
        for ids, d, x in _lists(batches):
            one = sent.value[d]
            k, n = len(one.values), len(x)
            if not k:
                continue
            again = pa.array(np.repeat(np.arange(n), k))
            number = lambda v: pa.array(np.full(n * k, v))
            yield pa.RecordBatch.from_arrays(
                [ids.take(again).cast(type_), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()), number(one.n),
                 pa.array(squares(one.deviations(x)), _WHOLE).take(again), pa.array(one.whitened(x).ravel()),
                 pa.array(np.tile(one.values / one.trace, n)), number(one.identity_error)], names)

    return rows.mapInArrow(run, f"`{id_col}` {kind.simpleString()}, component int, n bigint, deviation decimal(38,0), "
                                "whitened double, explained double, identity_error double")

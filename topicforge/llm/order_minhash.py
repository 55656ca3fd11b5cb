"""MinHash near-duplicates: Order MinHash sketches, banded alignment.

A text is its lower-case words.  Its k-mers are runs of five words, each
labelled with how often it came before.  One sketch hashes all labelled
k-mers, takes the ``KEPT`` smallest and keeps them in text order, so texts
agree in it the more often the smaller their edit distance is.  Texts that
agree in one sketch are candidates; two are near-duplicates if
the edit distance of their words is at most ``1 - threshold`` of the longer
one, decided by an alignment inside the band that this allows.  One edit breaks
five k-mers, more than a short text has, so short texts have shorter k-mers
(``BANDS``); lengths near a bound are sketched by both neighbours' rule.

No bucket of equal sketches is turned into all its pairs:

* texts of equal words are one class (its first row);
* a bucket hangs on its smallest class, its *centre*; the buckets of a centre
  are one star, and a class's mask says in which sketches it belongs to it.
  Two classes of a star are candidates if their masks meet;
* twice, each class is aligned with the centre that it shares most sketches
  with and that is not in its component yet: one pair a class and round;
* stars that still hold several components are completed: their classes go,
  with their texts, to blocks of bounded rows and words.  Only pairs of
  different components are compared, so the largest component of a star meets
  the others and never itself.  A block's task keeps the components as a
  union-find, skips pairs that are joined by then, takes lower bounds of the
  edit distance first, and hands on only the links that joined two components.

Defined results: null ids, null texts and texts without a word link with
nothing and are kept; of rows that repeat an id, each text counts by itself; of
a group, one row is kept (smallest id, then first row).  Texts of fewer than
four words are similar only to equal ones.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicforge.llm.common import WordCache, named_rows, scratch_table, slices
from topicforge.llm.components import connected

KEPT = 2
#: Sketches of a band at most: bits of a mask.
BITS = 64
#: ``(words of a k-mer, from, below, sketches)``: lengths of texts that are
#: sketched so.  Bands overlap by the difference in length that similar texts
#: may have; the last one adds sketches to the one before.
BANDS = [(2, 4, 20, 64), (3, 16, 100, 64), (5, 80, 1 << 62, 64), (5, 80, 1 << 62, 32)]
COUNTS = 256
#: Classes and words of a part; a block is two parts at most.
PART, PART_WORDS = 1024, 1 << 19
#: K-mers that are hashed for all sketches at a time.
STRETCH = 1 << 15

_ODD = np.random.default_rng(41).integers(1 << 62, 1 << 63, (len(BANDS), BITS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MOST = np.uint64(np.iinfo(np.uint64).max)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def labelled_kmers(codes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k-mer and of how often it came before."""
    k = min(k, len(codes))
    value = np.zeros(len(codes) - k + 1, np.uint64)
    for i in range(k):
        value = value * np.uint64(0x100000001B3) + codes[i:i + len(value)]
    order = np.argsort(value, kind="stable")
    ranked = value[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    at = np.arange(len(value))
    before = np.empty(len(value), np.uint64)
    before[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return _mixed(value + before * np.uint64(0xD6E8FEB86659FD93))


def sketches(codes: np.ndarray, band: int) -> np.ndarray:
    """One number for each of a band's sketches: its smallest k-mers in text
    order."""
    k, _, _, n = BANDS[band]
    h, odd = labelled_kmers(codes, k), _ODD[band, :n, None]
    best, rows = np.zeros((n, 0), np.int64), np.arange(n)
    for at in range(0, len(h), STRETCH):
        stretch = np.arange(at, min(at + STRETCH, len(h)))
        value = np.hstack([h[best] * odd, h[stretch] * odd])
        some = np.hstack([best, np.broadcast_to(stretch, (n, len(stretch)))])
        kept = []
        for _ in range(min(KEPT, value.shape[1])):
            least = value.argmin(axis=1)
            kept.append(some[rows, least])
            value[rows, least] = _MOST
        best = np.sort(np.stack(kept, axis=1), axis=1)
    out = (rows + band * BITS).astype(np.uint64)
    for c in range(best.shape[1]):
        out = _mixed(out * np.uint64(31) + h[best[:, c]])
    return out.view(np.int64)


def banded_sketches(codes: np.ndarray) -> np.ndarray:
    """The sketches of each band that the text's length lies in, in order."""
    found = [sketches(codes, n) for n, (_, first, below, _) in enumerate(BANDS) if first <= len(codes) < below]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def place_of(size: Column, at: Column) -> Column:
    """``band * BITS + sketch`` of the ``at``-th of ``banded_sketches``."""
    place, start = F.lit(None), F.lit(0)
    for n, (_, first, below, count) in enumerate(BANDS):
        active = (size >= first) & (size < below)
        place = F.when(active & (at >= start), n * BITS + at - start).otherwise(place)
        start = start + F.when(active, count).otherwise(0)
    return place.cast("int")


def counts_of(codes: np.ndarray) -> np.ndarray:
    """Hashed counts of the words, then of the pairs of neighbours; counts
    above 255 stay there, which can only lower the bounds taken from them."""
    pairs = _mixed(codes[:-1] * np.uint64(0x100000001B3) + codes[1:]) >> np.uint64(32)
    place = lambda h: (h & np.uint64(COUNTS - 1)).astype(np.int64)
    both = np.concatenate([np.bincount(place(codes), minlength=COUNTS), np.bincount(place(pairs), minlength=COUNTS)])
    return np.minimum(both, 255).astype(np.uint8)


def least_distance(counts: np.ndarray, others: np.ndarray) -> np.ndarray:
    """What the edit distance is at least: an edit adds or takes one word at
    most, and adds or takes two pairs of neighbours at most."""
    less = others - counts
    more = lambda x: np.maximum(x, 0).sum(1, dtype=np.int32)
    words = np.maximum(more(less[:, :COUNTS]), more(-less[:, :COUNTS]))
    pairs = np.maximum(more(less[:, COUNTS:]), more(-less[:, COUNTS:]))
    return np.maximum(words, (pairs + 1) // 2)


def edit_distance(a: list, b: list, most: int) -> int:
    """Edit distance if it is at most ``most``, else ``most + 1``.

    Bit-parallel alignment inside the band of ``most`` diagonals on either
    side: bit t of a column stands for the row t places below the band's upper
    edge, and the band moves down one row a column.  The distance grows along
    the diagonal that ends in the last cell wherever the cell isn't as cheap
    as the one before."""
    if len(a) < len(b):
        a, b = b, a
    gap = len(a) - len(b)
    if gap > most:
        return most + 1
    band = (1 << (2 * most + 1)) - 1
    places: dict = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    end = 1 << (gap + most)
    up, down, score = band ^ ((1 << most) - 1), 0, gap
    for j, word in enumerate(b):
        here = places.get(word, 0)
        here = (here >> (j - most) if j >= most else here << (most - j)) & band
        zero = (((here & up) + up) ^ up) | here | down
        right = down | (band & ~(zero | up))
        left = up & zero
        if not zero & end:
            score += 1
            if score > most:
                return score
        zero >>= 1
        up = left | (band & ~(zero | right))
        down = zero & right
        up &= band
        down &= band
    return score


def similar(a: list[str], b: list[str], threshold: float) -> bool:
    """Whether the words' edit distance is within the share of the longer."""
    most = int((1 - threshold) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[start:], b[start:]
    end = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), min(len(a), len(b)))
    a, b = a[:len(a) - end], b[:len(b) - end]
    if max(len(a), len(b)) <= most:
        return True
    counts: dict = {}
    for x in a:
        counts[x] = counts.get(x, 0) + 1
    for y in b:
        counts[y] = counts.get(y, 0) - 1
    if max(sum(c for c in counts.values() if c > 0), -sum(c for c in counts.values() if c < 0)) > most:
        return False
    width = 16
    while width < most:  # near-duplicates mostly end in a narrow band
        if edit_distance(a, b, width) <= width:
            return True
        width *= 8
    return edit_distance(a, b, most) <= most


def _sketch(batches):
    code = WordCache(lambda w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")))
    for part in slices(batches):
        rows = []
        for text in part.column(2).to_pylist():
            words = words_of(text)
            if not words:
                rows.append((None, 0, None))
                continue
            codes = np.fromiter(map(code.__getitem__, words), np.uint64, len(words))
            digest = hashlib.blake2b("\x00".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
            rows.append((digest, len(words), banded_sketches(codes)))
        types = [pa.binary(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), *(pa.array(x, t) for x, t in zip(zip(*rows), types))],
            ["id", "text_hash", "digest", "size", "sketches"])


def _aligned(threshold: float):
    def run(batches):
        for part in slices(batches, 64):
            keep = [similar(words_of(a), words_of(b), threshold)
                    for a, b in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
            yield part.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
    return run


def _groups(batches, names: list[str]):
    """Runs of rows with equal ``names`` from sorted batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = np.stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in names])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        start = 0
        for stop in cut.tolist():
            yield batch.slice(start, stop - start)
            start = stop
        held = batch.slice(start)
    if held is not None:
        yield held


def joining_links(u: np.ndarray, component: np.ndarray, size: np.ndarray, mask: np.ndarray, side: np.ndarray,
                  words: list[list], apart: bool, threshold: float) -> list[tuple[int, int]]:
    """Links between similar rows of a block that join two components, one for
    each two components that become one; rows ascend by size.  ``words`` are
    small whole numbers.  With ``apart``, only rows of different sides meet."""
    label = np.unique(component, return_inverse=True)[1]
    counts = np.stack([counts_of(_mixed(np.asarray(w, np.uint64) + np.uint64(1))) for w in words]).astype(np.int16)
    links = []
    for i in range(1, len(u)):
        most = int((1 - threshold) * size[i] + 1e-9)
        other = np.arange(int(np.searchsorted(size[:i], size[i] - most)), i)
        other = other[(label[other] != label[i]) & ((mask[other] & mask[i]) != 0)]
        if apart:
            other = other[side[other] != side[i]]
        if not len(other):
            continue
        bound = least_distance(counts[i], counts[other])
        for j in other[bound <= most][np.argsort(bound[bound <= most], kind="stable")].tolist():
            if label[j] != label[i] and similar(words[i], words[j], threshold):
                links.append((int(u[i]), int(u[j])))
                label[label == label[j]] = label[i]
    return links


def _complete(threshold: float):
    keys = ["v", "band", "lo", "hi"]

    def run(batches):
        for g in _groups(batches, keys):
            if g.num_rows < 2:
                continue
            column = lambda n: g.column(g.schema.get_field_index(n))
            u, component, size, mask, side = (column(n).to_numpy() for n in ("u", "component", "size", "mask", "side"))
            known: dict = {}
            words = [[known.setdefault(w, len(known)) for w in words_of(t)] for t in column("text").to_pylist()]
            links = joining_links(u, component, size, mask, side, words, column("apart")[0].as_py(), threshold)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], ["u", "v"])
    return run


def _stars(classes: DataFrame) -> DataFrame:
    """``(v, band, u, mask, size)``: the sketches in which ``u`` is in a bucket
    whose smallest class is ``v``.  A class has one bucket a sketch, so two
    rows of a star share a bucket exactly where their masks meet."""
    rows = (classes.select("u", "size", F.posexplode("sketches").alias("at", "bucket"))
            .select("u", "bucket", place_of(F.col("size"), F.col("at")).alias("place")))
    centres = rows.groupBy("bucket").agg(F.min("u").alias("v"), F.max("u").alias("_last")).where("v <> _last").drop("_last")
    stars = rows.join(centres, "bucket").groupBy("v", F.floor(F.col("place") / BITS).cast("int").alias("band"), "u").agg(
        F.bit_or(F.expr(f"shiftleft(1L, place % {BITS})")).alias("mask"))
    return stars.join(classes.select("u", "size"), "u")


def _blocks(stars: DataFrame, component: DataFrame) -> DataFrame:
    """The classes of stars with several components, dealt to blocks: all but
    the largest component in parts that meet each other and, one by one, the
    parts of the largest."""
    of = component.withColumnRenamed("node", "u")
    open_ = stars.join(of, "u", "left").withColumn("component", F.coalesce("component", "u"))
    by = open_.groupBy("v", "band", "component").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    of_star = by.groupBy("v", "band").agg(
        F.count("*").alias("components"), F.max(F.struct("n", "component", "words")).alias("top"),
        F.sum("n").alias("n"), F.sum("words").alias("words")).where("components > 1")
    parts = lambda n, words: F.greatest(F.ceil(n / PART), F.ceil(words / PART_WORDS), F.lit(1)).cast("int")
    of_star = of_star.select(
        "v", "band", F.col("top.component").alias("top"),
        parts(F.col("n") - F.col("top.n"), F.col("words") - F.col("top.words")).alias("p"),
        parts(F.col("top.n"), F.col("top.words")).alias("q"))
    rows = open_.join(of_star, ["v", "band"]).withColumn("in_top", F.col("component") == F.col("top"))
    part = F.pmod(F.xxhash64("u", F.lit("part")), F.when(F.col("in_top"), F.col("q")).otherwise(F.col("p"))).cast("int")
    own = F.when(F.col("in_top"), F.col("p") + part).otherwise(part)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(
        F.when(F.col("in_top"), F.sequence(F.lit(0), F.col("p") - 1))
        .otherwise(F.filter(F.sequence(F.lit(0), F.col("p") + F.col("q") - 1), lambda x: x != F.col("own")))))
    # pairs inside a part are left to its block with the largest component's first part
    return rows.select("v", "band", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                       (F.greatest("own", "other") != F.col("p")).alias("apart"),
                       (F.col("own") > F.col("other")).cast("int").alias("side"), "u", "component", "size", "mask")


def _grouped(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """``(id, text_hash, class_id, kept)`` for each row."""
    read = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    name = docs.schema[id_col].dataType.simpleString()
    sketched = scratch_table(
        read.mapInArrow(_sketch, f"id {name}, text_hash bigint, digest binary, size bigint, sketches array<bigint>")
        .withColumn("row", F.monotonically_increasing_id()), "sketches")
    classes = scratch_table(sketched.where("digest is not null and id is not null").groupBy("digest").agg(
        F.min(F.struct("row", "id", "text_hash")).alias("first"), F.first("size").alias("size"),
        F.first("sketches").alias("sketches")).select("digest", F.col("first.row").alias("u"), "first.id", "first.text_hash",
                                                      "size", "sketches"), "classes")
    stars = scratch_table(_stars(classes), "stars")
    wanted = classes.join(stars.select("u").distinct(), "u", "left_semi").select("u", "id", "text_hash")
    texts = scratch_table(read.join(wanted, ["id", "text_hash"]).groupBy("u").agg(F.first("text").alias("text")), "texts")

    def with_best_centre(component: DataFrame | None) -> DataFrame:
        """Of each class, the centre of another component that it shares most
        sketches with; lengths that can't be similar aside."""
        pairs = stars.where("u <> v")
        if component is not None:
            of = lambda c: component.select(F.col("node").alias(c), F.col("component").alias(f"_{c}"))
            pairs = pairs.join(of("u"), "u", "left").join(of("v"), "v", "left").where(
                F.coalesce("_u", "u") != F.coalesce("_v", "v"))
        best = pairs.groupBy("u").agg(F.max(F.struct(F.bit_count("mask").alias("n"), (-F.col("v")).alias("v"))).alias("best"))
        both = (best.select("u", (-F.col("best.v")).alias("v")).join(texts.select("u", F.col("text").alias("a")), "u")
                .join(texts.select(F.col("u").alias("v"), F.col("text").alias("b")), "v").select("u", "v", "a", "b"))
        return scratch_table(both.mapInArrow(_aligned(threshold), "u bigint, v bigint"), "aligned")

    def joined(component: DataFrame, links: DataFrame) -> DataFrame:
        """The components with more links: known ones are stars already."""
        return connected(component.select(F.col("node").alias("u"), F.col("component").alias("v")).union(links))

    component = scratch_table(connected(with_best_centre(None)), "component")
    component = scratch_table(joined(component, with_best_centre(component)), "component")
    blocks = (_blocks(stars, component).join(texts, "u").repartition("v", "band", "lo", "hi")
              .sortWithinPartitions("v", "band", "lo", "hi", "size", "u")
              .select("v", "band", "lo", "hi", "apart", "side", "u", "component", "size", "mask", "text"))
    more = scratch_table(blocks.mapInArrow(_complete(threshold), "u bigint, v bigint"), "joining")
    component = joined(component, more).withColumnRenamed("node", "u")
    by_digest = classes.select("digest", "u").join(component, "u", "left").select(
        "digest", F.coalesce("component", "u").alias("component"))
    rows = scratch_table(sketched.select(
        "id", "text_hash", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest"), "row").join(by_digest, "digest", "left"), "grouped")
    first = rows.where("component is not null").groupBy("component").agg(F.min(F.struct("id", "row")).alias("first"))
    return rows.join(first, "component", "left").select(
        "id", "text_hash", F.coalesce("first.id", "id").alias("class_id"),
        F.coalesce(F.col("row") == F.col("first.row"), F.lit(True)).alias("kept"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = 0.8) -> DataFrame:
    """``(<id>, class_id, kept)``, one row for each row: the smallest id of its
    group of near-duplicates, and whether this row stays."""
    return _grouped(docs, id_col, text_col, threshold).select(F.col("id").alias(id_col), "class_id", "kept")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """One document of each group, with all its columns."""
    kept = _grouped(docs, id_col, text_col, threshold).where("kept").select("id", "text_hash")
    return named_rows(docs, [F.col(id_col), F.xxhash64(text_col)], kept)

"""Exact duplicates: 128-bit content hashes, then a comparison of bytes.

Texts are equal when they are identical after every run of ASCII white space
became one space.  Rows are grouped by a 128-bit hash of that text; of each
group the row with the smallest id stays.  What a hash can't prove, the bytes
do: the texts of groups with several rows are grouped once more by hash *and
text*.  That aggregation is partial, so copies collapse inside the tasks that
read them, and of texts without a copy none is moved.  Groups that turn out to
hold different texts are decided by their texts instead of their hashes.

Everything is a DataFrame expression.  Only digests (about 100 bytes a row)
are written and shuffled by row; groups are partial counts and minima, so one
that holds a third of all rows is reduced where it is read.

Defined results: a null text counts as empty; null ids come after all others,
so they stay only in groups without an id; of rows that repeat an id and a
text, one stays.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicforge.llm.common import named_rows, scratch_table

#: Hashes of groups with copies that may be broadcast (16 bytes each).
BROADCAST_HASHES = 1 << 20


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; null as the empty text.  The
    pattern only matches runs that aren't one space already."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _smallest(id_col: str) -> Column:
    """The row that stays: smallest id, nulls last, first row of equal ids."""
    return F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("_row").alias("row")))


def _decided(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(groups, keys).select(
        "_id", F.col("_first.id").alias("keep_id"), F.col("_n").alias("group_size"),
        (F.col("_row") == F.col("_first.row")).alias("kept"), "_sha")


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("_n"), _smallest("_id").alias("_first"))


def _with_copies(rows: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """``rows`` of hashes that several rows have.  Few hashes are broadcast;
    beyond ``most`` all rows are kept, whose texts the caller groups anyway."""
    several = groups.where("_n > 1").select("_hash")
    return rows.join(F.broadcast(several), "_hash", "left_semi") if several.count() <= most else rows


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 hash_of: Callable[[Column], Column] = content_hash,
                 broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """``(<id>, keep_id, group_size, kept, text_sha256)``, one row for each
    row; ``text_sha256`` is of the normalised text."""
    whole = (docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text"))
             .withColumn("_hash", hash_of(F.col("_text"))))
    rows = scratch_table(
        whole.select("_id", "_hash", F.sha2(F.col("_text").cast("binary"), 256).alias("_sha"),
                     F.monotonically_increasing_id().alias("_row")), "digests")
    groups = scratch_table(_groups(rows, ["_hash"]), "groups")
    texts = _with_copies(whole.select("_hash", "_text"), groups, broadcast_hashes).groupBy("_hash", "_text").count()
    differ = scratch_table(texts.groupBy("_hash").agg(F.count("*").alias("n")).where("n > 1").select("_hash"), "collisions")
    if differ.isEmpty():
        out = _decided(rows, groups, ["_hash"])
    else:  # the hash doesn't name a text here: the text does
        clash = scratch_table(
            whole.join(differ, "_hash", "left_semi").select(
                "_id", "_hash", "_text", F.sha2(F.col("_text").cast("binary"), 256).alias("_sha"),
                F.monotonically_increasing_id().alias("_row")), "clash")
        keys = ["_hash", "_text"]
        out = (_decided(rows.join(differ, "_hash", "left_anti"), groups, ["_hash"])
               .union(_decided(clash, _groups(clash, keys), keys)))
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size", "kept",
                      F.col("_sha").alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    kept = exact_groups(docs, id_col, text_col).where("kept").select(id_col, "text_sha256")
    return named_rows(docs, [F.col(id_col), F.sha2(normalised(F.col(text_col)).cast("binary"), 256)], kept)

"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes.  Every token points to the token, of either
tokenizer, that overlaps it and reaches farthest to the right; doubling the
successors (``next = next[next]``) converges on the last token of each connected
piece, which labels the group.  Groups therefore end where tokens of both
tokenizers end.  A batch of documents is laid out as one row of bytes: the
documents' ends are common ends, so no group crosses them, and every step is
one array operation for the whole batch.

Corpus-wide counts say how many documents hold an id pair linked (overlapping
somewhere).  The encoding runs once: each document's distinct pairs are
written next to its digests, then counted (partial counts by task), and looked
up again.  The table of counts is broadcast only up to ``BROADCAST_PAIRS`` rows;
beyond that it is joined by shuffle, where AQE splits the pairs that every
document holds.

Defined results: a text that is null or empty, or whose tokens don't spell the
text after one space, has no tokens: zeros and an empty ``groups``.  Rows may
repeat (each counts as a document), ids may be null, an empty table gives no
rows, and other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicforge.llm.common import WordCache, scratch_table, slices

#: Rows of pair counts that are broadcast (a pair and two numbers each).
BROADCAST_PAIRS = 1 << 21
#: Bytes of text aligned at a time; a longer text is taken alone.
BATCH_BYTES = 1 << 19
#: Ids of the second tokenizer lie below this (checked); a pair is ``a * SECOND + b``.
SECOND = 1 << 16

_START = " "


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for:
    printable bytes stand for themselves, the others follow from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


#: Fixed value: how a byte-level tokenizer cuts a text into words.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that every release of Unicode counts as the same kind.
_SETTLED = re.compile("[\x00-\u024f\u0400-\u0481\u048a-\u0513\u2010-\u2027\u2030-\u205e\u3041-\u3096"
                      "\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\U0001f300-\U0001f64f]*")
_WORDS = regex.compile(CUT)
#: Words that a task remembers.
REMEMBERED = 300_000


class Tokenizers:
    """Both tokenizers with the bytes of each of their ids.

    The first one's words are tokenised once and remembered, where its file
    says that it cuts texts into byte-level words and the text has characters
    that are cut alike everywhere; else it gets the whole text."""

    def __init__(self, byte_level_json: str, piece_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.first = Tokenizer.from_str(byte_level_json)
        self.first.encode_special_tokens = True
        self.model = self.first.model
        self.second = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        steps = json.loads(byte_level_json)
        cut = steps["pre_tokenizer"] or {}
        self.by_word = (steps["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
                        and not cut["add_prefix_space"])
        letters = byte_letters()
        self.letter_of = {b: c for c, b in letters.items()}
        entries = {i: entry for entry, i in self.first.get_vocab(with_added_tokens=False).items()}
        self.first_bytes = [bytes(letters[c] for c in entries[i]) if i in entries else b""
                            for i in range(max(entries) + 1)]
        self.second_bytes = [self._piece(i) for i in range(self.second.get_piece_size())]
        self.ids_of = WordCache(self._word, REMEMBERED)

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def _word(self, word: str) -> bytes:
        """The word's ids, 32 bits each; empty if they don't spell it."""
        data = word.encode("utf-8", "surrogatepass")
        ids = [t.id for t in self.model.tokenize(data.decode("latin-1").translate(self.letter_of))]
        return _packed(ids) if b"".join([self.first_bytes[i] for i in ids]) == data else b""

    def _first_ids(self, text: str) -> bytes:
        if self.by_word and _SETTLED.fullmatch(text):
            words = list(map(self.ids_of.__getitem__, _WORDS.findall(text)))
            return b"".join(words) if all(words) else b""
        ids = self.first.encode(text, add_special_tokens=False).ids
        table = self.first_bytes
        spelt = b"".join([table[i] if i < len(table) else b"" for i in ids])
        return _packed(ids) if spelt == text.encode("utf-8", "surrogatepass") else b""

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both tokenizers; none where they don't spell the text."""
        table, none = self.second_bytes, np.zeros(0, np.int32)
        out = []
        for text, b in zip(texts, self.second.encode(texts, num_threads=1)):
            whole = _START + text
            a = self._first_ids(whole)
            fits = a and b"".join([table[i] for i in b]) == whole.encode("utf-8", "surrogatepass")
            out.append((np.frombuffer(a, np.int32), np.asarray(b, np.int32)) if fits else (none, none))
        return out


def _packed(ids: list[int]) -> bytes:
    return np.asarray(ids, np.int32).tobytes()


def _last_byte_owner(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each offset: whether a token ends there, and which token holds the
    byte before it."""
    is_end = np.zeros(int(ends[-1]) + 1, bool)
    is_end[ends] = True
    return is_end, np.r_[0, np.cumsum(is_end[:-1], dtype=np.int32)]


def group_labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label of each token of both sides: the number, among the second side's
    tokens, of the last token of its connected piece.  ``ends`` are ascending
    byte offsets; both sides end at the same byte."""
    a, b = len(ends_a), len(ends_b)
    after_a = _last_byte_owner(ends_b)[1][ends_a]      # the second's token over the last byte
    after_b = _last_byte_owner(ends_a)[1][ends_b]      # the first's token over the last byte
    # of equal ends the second side's token counts as the farther one
    follow = np.concatenate([a + after_a, np.where(ends_a[after_b] > ends_b, after_b, a + np.arange(b))])
    while True:
        jump = follow[follow]
        if np.array_equal(jump, follow):
            return follow[:a] - a, follow[a:] - a
        follow = jump


@dataclass
class Aligned:
    """One document's alignment."""
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: bytes
    pairs: np.ndarray
    times: np.ndarray


class Aligner:
    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.size_a = np.asarray([len(t) for t in tokenizers.first_bytes], np.int64)
        self.size_b = np.asarray([len(t) for t in tokenizers.second_bytes], np.int64)
        if len(self.size_b) > SECOND:
            raise ValueError(f"the second tokenizer has more than {SECOND} ids")
        most = max(len(self.size_a), len(self.size_b))
        #: each id with what may follow it
        self.written = np.asarray([b"%d%s" % (i, mark) for i in range(most) for mark in (b",", b";", b"|")], object)

    def align(self, texts: list[str | None]) -> list[Aligned]:
        out = [Aligned(0, 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int32)) for _ in texts]
        full = [d for d, t in enumerate(texts) if t]
        coded = self.tokenizers.encode([texts[d] for d in full])
        some = [(d, *c) for d, c in zip(full, coded) if len(c[0])]
        if not some:
            return out
        docs = len(some)
        a, b = (np.concatenate([s[side] for s in some]) for side in (1, 2))
        count_a, count_b = (np.asarray([len(s[side]) for s in some]) for side in (1, 2))
        stop_a, stop_b = np.cumsum(count_a), np.cumsum(count_b)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        label_a, label_b = group_labels(ends_a, ends_b)
        last_b = label_b == np.arange(len(b))
        group_b = np.cumsum(last_b) - last_b
        group_a = group_b[label_a]
        n_groups = np.diff(group_b[stop_b - 1] + 1, prepend=0)

        # both sides' ids in the order of the groups, each with its mark
        last_a = np.r_[group_a[1:] != group_a[:-1], True]
        place_a = np.arange(len(a)) + np.r_[0, np.flatnonzero(last_b) + 1][group_a]  # after b of earlier groups
        place_b = np.arange(len(b)) + (np.flatnonzero(last_a) + 1)[group_b]          # after a up to this group
        row = np.empty(len(a) + len(b), np.int64)
        row[place_a] = a * 3 + 2 * last_a
        row[place_b] = b * 3 + last_b
        text = self.written[row].tolist()

        # every stretch between neighbouring ends lies in one token of each side
        (is_a, owner_a), (is_b, owner_b) = _last_byte_owner(ends_a), _last_byte_owner(ends_b)
        cut = np.flatnonzero(is_a | is_b)
        of_a, of_b = owner_a[cut], owner_b[cut]
        doc = np.repeat(np.arange(docs), count_a)[of_a]
        n_links = np.bincount(doc, minlength=docs)
        code = a[of_a].astype(np.int64) * SECOND + b[of_b]
        found = np.sort(doc << 40 | code)
        new = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
        found, times = found[new], np.diff(new, append=len(found))
        bounds = np.searchsorted(found >> 40, np.arange(docs + 1))
        found &= (1 << 40) - 1
        start = 0
        for k, (d, *_) in enumerate(some):
            stop = int(stop_a[k] + stop_b[k])
            cells = slice(bounds[k], bounds[k + 1])
            out[d] = Aligned(int(count_a[k]), int(count_b[k]), int(n_groups[k]), int(n_links[k]),
                             b"".join(text[start:stop])[:-1], found[cells], times[cells].astype(np.int32))
            start = stop
        return out


def _pieces(part: pa.RecordBatch):
    """``(ids, texts)`` of about ``BATCH_BYTES``."""
    ids, texts, held = [], [], 0
    for row, text in zip(part.column(0), part.column(1)):
        text = text.as_py()
        ids.append(row.as_py())
        texts.append(text)
        held += len(text) if text else 0
        if held >= BATCH_BYTES:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def align_documents(docs: DataFrame, byte_level_path: str, piece_model_path: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(<id>, n_a, n_b, n_groups, n_links, groups, pairs, times)``, one row
    for each row.  ``groups`` holds the ids of both sides group by group, as in
    ``a1,a2|b1;a3|b2,b3``; ``pairs`` the distinct linked id pairs
    (``a * SECOND + b``) and ``times`` how often each occurs."""
    with open(byte_level_path, encoding="utf-8") as f:
        first = f.read()
    with open(piece_model_path, "rb") as f:
        second = f.read()
    sent = docs.sparkSession.sparkContext.broadcast((first, second))  # vocabularies: of fixed size
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema[id_col].dataType
    type_ = to_arrow_type(kind)

    def run(batches):
        aligner = Aligner(Tokenizers(*sent.value))
        for part in slices(batches):
            for ids, texts in _pieces(part):
                done = aligner.align(texts)
                number = lambda name: pa.array([getattr(x, name) for x in done], pa.int64())
                ends = np.cumsum([0] + [len(x.pairs) for x in done]).astype(np.int32)
                lists = lambda name, t: pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(np.concatenate([getattr(x, name) for x in done]), t))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, type_), number("n_a"), number("n_b"), number("n_groups"), number("n_links"),
                     pa.array([x.groups for x in done], pa.binary()), lists("pairs", pa.int64()), lists("times", pa.int32())],
                    [id_col, "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
             "groups binary, pairs array<bigint>, times array<int>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, docs, best)``: how many documents hold the pair linked, and
    whether no pair of the same first id is held by more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    first = F.floor(F.col("pair") / SECOND).cast("bigint")
    most = counts.groupBy(first.alias("a")).agg(F.max("docs").alias("most"))
    return (counts.withColumn("a", first).join(most, "a")
            .select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")))


def link_statistics(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` rows (without their pairs) with ``n_best`` and ``count_sum``
    over their links.  ``aligned`` has to be a written table with a ``row``."""
    counts = scratch_table(pair_counts(aligned), "pair-counts")
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    return aligned.drop("pairs", "times").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])

"""Packing documents into training sequences by attention cost.

A document's ids (with the end id) are cut freely into pieces, and a piece of
``n`` tokens costs ``n + n * n / quadratic_at``: linear work plus attention
inside the piece.  Documents are packed in blocks of about ``block_tokens``:

* a block of T tokens opens ``T // capacity`` sequences of full capacity, and
  for the rest one sequence for each power of two in ``T % capacity``: such
  sequences aren't padded, so nothing is;
* pieces are taken in descending length; each goes to the sequence of lowest
  cost that has room for it; where none has, the piece fills the emptiest
  sequence and what is left of it is packed in its turn.

A block is what a Spark task reads in one go, so packing needs no shuffle and
its memory is bounded; a document longer than a block is a block by itself.
A task that is run again reads the same split and packs it the same way.

Tokenising looks words up: a text of plain Latin letters is lowered and cut
as the tokenizer would, and the tokenizer's model sees each word that a task
hasn't met yet; any other text goes through the tokenizer as a whole.  Strings
of special tokens in a text are ordinary text.

Defined results: null texts count as empty, i.e. one piece with the end id;
ties in length are taken in reading order; repeated rows are packed each on
its own; ids of rows may be null; other columns are ignored; an empty table
gives no piece.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from topicforge.llm.common import slices

CAPACITY = 4096
END_ID = 2
BLOCK_TOKENS = 1 << 20
#: Words that a task remembers, and their length.
REMEMBERED, LONG = 400_000, 64
#: Fixed value: how this vocabulary's tokenizer cuts a text that it has lowered.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts of these characters only are lowered letter by letter and cut so.
_SIMPLE = re.compile(r"[\t\n\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def _byte_letters() -> dict[int, str]:
    """Each character up to U+00FF as the letters that stand for its UTF-8
    bytes in a byte-level vocabulary: printable bytes stand for themselves,
    the others for the letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class Tokeniser:
    """Ids of whole texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: str, end_id: int):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.by_word = _cuts_as_known(json.loads(vocabulary))
        self.end = np.asarray([end_id], "<u4").tobytes()
        self.known: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [_PIECES.findall(t.lower()) if self.by_word and _SIMPLE.fullmatch(t) else None
               for t in (t or "" for t in texts)]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = set().union(*filter(None, cut)) - self.known.keys()
        for word in new:
            ids = [t.id for t in self.model.tokenize(word.translate(self.letters))]
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
        out = [(np.asarray(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if words is None
                else b"".join(map(self.known.__getitem__, words))) + self.end for t, words in zip(texts, cut)]
        for word in new:
            if len(word) > LONG:
                del self.known[word]
        return out


def _cuts_as_known(vocabulary: dict) -> bool:
    """Whether the tokenizer lowers and cuts texts as ``_PIECES`` does."""
    steps = [n["type"] for n in vocabulary["normalizer"].get("normalizers", [])] if vocabulary["normalizer"] else []
    cuts = vocabulary["pre_tokenizer"].get("pretokenizers", []) if vocabulary["pre_tokenizer"] else []
    return (steps == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"].get("Regex") == CUT and cuts[0]["invert"] and not cuts[1]["add_prefix_space"])


def sequence_sizes(tokens: int, capacity: int) -> list[int]:
    """Full sequences, then the powers of two that make up the rest."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(lengths: list[int], capacity: int, quadratic_at: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` that hold every
    token of every document once."""
    sizes = np.asarray(sequence_sizes(sum(lengths), capacity), np.int64)
    room, cost = sizes.copy(), np.zeros(len(sizes))
    heap = [(-n, d, 0) for d, n in enumerate(lengths) if n]
    heapq.heapify(heap)
    pieces = []
    while heap:
        negative, document, start = heapq.heappop(heap)
        length = -negative
        fits = np.flatnonzero(room >= length)
        if len(fits):
            to = int(fits[np.argmin(cost[fits])])
        else:
            to = int(np.argmax(room))
            length = int(room[to])
            heapq.heappush(heap, (negative + length, document, start + length))
        pieces.append((document, start, length, to, int(sizes[to] - room[to])))
        room[to] -= length
        cost[to] += length + length * length / quadratic_at
    return pieces


def _blocks(batches, tokeniser: Tokeniser, block_tokens: int) -> Iterator[tuple[list, list[bytes]]]:
    """Row ids and token bytes of about ``block_tokens`` tokens at a time."""
    rows, tokens, held = [], [], 0
    for part in slices(batches):
        for row, ids in zip(part.column(0).to_pylist(), tokeniser.encode(part.column(1).to_pylist())):
            rows.append(row)
            tokens.append(ids)
            held += len(ids) // 4
            if held >= block_tokens:
                yield rows, tokens
                rows, tokens, held = [], [], 0
    if rows:
        yield rows, tokens


def pack_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
                   end_id: int = END_ID, capacity: int = CAPACITY, quadratic_at: float = CAPACITY,
                   block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(<id>, start, length, ids, doc_tokens, sequence_id, offset)``, one
    row for each piece; ``ids`` as little-endian unsigned 32-bit integers."""
    with open(vocabulary_path, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # the vocabulary: of fixed size
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        tokeniser = Tokeniser(sent.value, end_id)
        first = TaskContext.get().partitionId() << 40  # sequences of a task count from here
        for rows, tokens in _blocks(batches, tokeniser, block_tokens):
            counts = [len(t) // 4 for t in tokens]
            pieces = sorted(pack(counts, capacity, quadratic_at), key=lambda p: p[3:])
            for at in range(0, len(pieces), 4096):
                some = pieces[at:at + 4096]
                column = lambda values: pa.array(values, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[d] for d, *_ in some], type_), column([p[1] for p in some]),
                     column([p[2] for p in some]),
                     pa.array([tokens[d][4 * s:4 * (s + n)] for d, s, n, *_ in some], pa.binary()),
                     column([counts[d] for d, *_ in some]), column([first + p[3] for p in some]),
                     column([p[4] for p in some])], names)
            first += len(sequence_sizes(sum(counts), capacity))

    from pyspark.sql.pandas.types import to_arrow_type
    type_ = to_arrow_type(docs.schema[id_col].dataType)
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
             "sequence_id bigint, offset bigint")

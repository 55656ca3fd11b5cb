"""Byte-level BPE encoding by merge replay, and decoding.

Instead of merging inside one word at a time, all distinct words of a block of
the corpus are laid out as one row of symbols, and an inverted index leads
from a token pair (known by the rank of what it merges into) to the positions
where it stands.  Ranks are taken in ascending order; each merge is applied at
all its positions and only the neighbours of a merged position get new index
entries.  Merges never cross words, so replaying the corpus block by block
gives the ids of a replay over the whole corpus; a block is what a Spark task
holds of it, hence no shuffle and no dictionary that grows with the corpus.

A pair's merge may create a neighbour pair of a *lower* rank (the vocabulary
allows it).  The rest of that word is then put back and waits for the lower
rank, so the ids are those of a word-by-word encoder.

Defined results: a null or empty text has no ids and empty digests' input;
repeated rows repeat; ids of rows may be null; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from topicforge.llm.common import slices

#: Words whose ids a task remembers between blocks.
REMEMBERED = 250_000
#: Rows of a block.
BLOCK_ROWS = 1024


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


#: The rank of a pair that doesn't merge.
NEVER = np.iinfo(np.int32).max


class Replay:
    """Merge replay with one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.byte = np.asarray([ranks[bytes([b])] for b in range(256)], np.int32)
        self.bytes_merged = np.asarray([[ranks.get(bytes([a, b]), NEVER) for b in range(256)] for a in range(256)], np.int32)
        self.pairs: dict[int, int] = {}

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of what each pair merges into."""
        pairs = left.astype(np.int64) << 32 | right
        if len(pairs) < 64:
            return np.fromiter(map(self._rank, pairs.tolist()), np.int64, len(pairs))
        pairs, of = np.unique(pairs, return_inverse=True)
        return np.fromiter(map(self._rank, pairs.tolist()), np.int64, len(pairs))[of]

    def _rank(self, pair: int) -> int:
        rank = self.pairs.get(pair)
        if rank is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            rank = self.ranks.get(self.token[pair >> 32] + self.token[pair & 0xFFFFFFFF], NEVER)
            self.pairs[pair] = rank
        return rank

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        whole = [self.ranks.get(w) for w in words]
        row = [w for w, rank in zip(words, whole) if rank is None and w]
        data = np.frombuffer(b"".join(row), np.uint8)
        n = len(data)
        ends = np.cumsum(np.fromiter(map(len, row), np.int64, len(row)))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        # one place more stands for what is outside of a word
        symbol = np.append(self.byte[data], -1).astype(np.int64)
        nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
        nxt[n], prv[n] = n, n
        nxt[ends - 1], prv[starts] = n, n
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(ranks: np.ndarray, places: np.ndarray) -> None:
            can = ranks != NEVER
            ranks, places = ranks[can], places[can]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cut = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for rank, from_, to in zip(ranks[cut[:-1]].tolist(), cut, cut[1:]):
                if rank in index:
                    index[rank].append(places[from_:to])
                else:
                    index[rank] = [places[from_:to]]
                    heapq.heappush(heap, rank)

        inside = np.flatnonzero(nxt[:n] < n)
        enter(self.bytes_merged[data[inside], data[inside + 1]].astype(np.int64) if n else np.zeros(0, np.int64), inside)
        while heap:
            rank = heapq.heappop(heap)
            at = np.unique(np.concatenate(index.pop(rank)))
            at = at[(symbol[at] >= 0) & (nxt[at] < n)]
            at = at[self._merged(symbol[at], symbol[nxt[at]]) == rank]
            if not len(at):
                continue
            # of pairs that overlap in a run, every second one counts from its left
            goes_on = np.append(False, at[1:] == nxt[at[:-1]])
            run = np.maximum.accumulate(np.where(goes_on, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            after = nxt[at]
            beyond = nxt[after]
            # the neighbours at the moment of each merge, taken from left to right
            touches = np.append(False, prv[at[1:]] == after[:-1])
            left = np.where(touches, rank, symbol[prv[at]])
            lower = np.zeros(len(at), bool)
            has = left >= 0
            lower[has] = self._merged(left[has], np.full(has.sum(), rank)) < rank
            has = beyond < n
            lower[has] |= self._merged(np.full(has.sum(), rank), symbol[beyond[has]]) < rank
            if lower.any():  # what follows in the word waits for the lower rank
                word = np.searchsorted(starts, at, side="right")
                first = np.full(len(starts) + 1, n)
                np.minimum.at(first, word[lower], at[lower])
                now = at <= first[word]
                if not now.all():
                    enter(np.full((~now).sum(), rank), at[~now])
                    at, after, beyond = at[now], after[now], beyond[now]
            symbol[at], symbol[after] = rank, -1
            nxt[at], prv[beyond] = beyond, at
            nxt[n], prv[n] = n, n
            before, beyond = prv[at], nxt[at]
            has, goes = before < n, beyond < n
            enter(np.concatenate([self._merged(symbol[before[has]], symbol[at[has]]),
                                  self._merged(symbol[at[goes]], symbol[beyond[goes]])]),
                  np.concatenate([before[has], at[goes]]))
        kept = symbol[:n] >= 0
        ids = symbol[:n][kept].astype("<u4").tobytes()
        upto = np.concatenate([[0], np.cumsum(kept)])[ends] * 4 if n else ends
        pieces = iter([ids[i:j] for i, j in zip([0, *upto[:-1].tolist()], upto.tolist())])
        return [b"" if not w else next(pieces) if rank is None else struct.pack("<I", rank)
                for w, rank in zip(words, whole)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


class Encoder:
    """Texts to ids: cuts by the pattern, replays the words that are new."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.replay, self.pattern = Replay(ranks), regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        cut = [self.pattern.findall(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*cut) - self.known.keys())
        self.known.update(zip(new, self.replay.encode_words([w.encode() for w in new])))
        out = [b"".join(map(self.known.__getitem__, words)) for words in cut]
        for word in new:  # long junk isn't worth remembering
            if len(word) > 64:
                del self.known[word]
        return out


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, ids, decoded)``: ids as little-endian unsigned 32-bit
    integers, and the bytes that they decode to."""
    sent = docs.sparkSession.sparkContext.broadcast((ranks, pattern))  # the vocabulary: of fixed size

    def encode(batches):
        encoder = Encoder(*sent.value)
        for part in slices(batches, BLOCK_ROWS):
            ids = encoder.encode(part.column(1).to_pylist())
            decoded = [encoder.replay.decode(np.frombuffer(x, "<u4")) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                [id_col, "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(encode, f"`{id_col}` {kind}, ids binary, decoded binary")



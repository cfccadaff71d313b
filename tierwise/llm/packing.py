"""Packing by the sum-of-squares rule.

Each task packs the documents of its own input split, online and in order:
no shuffle, and a lost task is redone from the same split with the same
result. A document is cut into full windows and a rest; the rest goes to the
fill level ``h`` that minimises the sum over levels of the squared number of
partially filled windows, i.e. minimises ``N[h + rest] - N[h]``. The counts
``N`` live in one level array of ``capacity + 1`` cells.

When a split ends, the windows that are still open are closed: documents may
be cut, so the emptiest windows fill the gaps of the fullest, and what is left
is at most one window per split, padded (not at all when its length is a power
of two).

Memory: a task holds one Arrow batch, the pieces of its open windows (the
sum-of-squares rule keeps their number sublinear in the documents seen) and a
bounded cache of encoded words.

Defined cases: a null text is an empty one; an empty text is its end token
alone; repeated rows are packed as often as they occur; an empty table gives
no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
END_ID = 0
CACHE_WORDS = 1_200_000         # per worker, about 250 MB; cleared when full
DOCS = 512                      # texts encoded together
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class WordEncoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    A byte-level BPE never merges across a lone space or line break, nor across
    the place between a letter and a stop or comma. So a text whose white space
    is lone spaces and line breaks between words is encoded word by word from a
    cache, and the words that the cache lacks are encoded together; any other
    text goes to the tokenizer whole."""

    def __init__(self, tokenizer_file: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_file)
        self.limit = limit
        self.spaced: dict[str, bytes] = {}      # word -> ids of " " + word
        self.leading: dict[str, bytes] = {}     # the first word of a line
        self.newline = self._whole("\n")
        self.stops = {c: self._whole(c) for c in ".,"}

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, cache: dict[str, bytes], before: str, seen: set[str]) -> None:
        fresh = seen.difference(cache)
        ending = [w for w in fresh if w[-1] in ".," and w[-2:-1].isalnum()]
        stems = {w[:-1] for w in ending}.difference(cache)
        stems.update(fresh.difference(ending))
        todo = list(stems)
        for lo in range(0, len(todo), 512):
            part = todo[lo:lo + 512]
            got = self.tok.encode(before + before.join(part), add_special_tokens=False)
            ids = np.asarray(got.ids, "<u4").tobytes()
            ends = np.fromiter(chain.from_iterable(got.offsets), np.int64, 2 * len(got.ids))[1::2]
            stop = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            last = np.searchsorted(ends, stop, "right").tolist()
            skip, i = int(before == "\n"), 0
            if skip:
                for w, j in zip(part, last):
                    cache[w] = ids[4 * (i + 1):4 * j]
                    i = j
            else:
                edges = [0, *(4 * j for j in last)]
                cache.update(zip(part, map(ids.__getitem__, map(slice, edges, edges[1:]))))
        for w in ending:
            cache[w] = cache[w[:-1]] + self.stops[w[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        spaced, leading = self.spaced, self.leading
        if len(spaced) + len(leading) > self.limit:
            spaced.clear()
            leading.clear()
        cut, inner, first = [], set(), set()
        for t in texts:
            if not t or " ".join(t.split()) != t.replace("\n", " "):
                cut.append(None)
                continue
            lines = [line.split(" ") for line in t.split("\n")]
            for parts in lines:
                first.add(parts[0])
                inner.update(parts[1:])
            cut.append(lines)
        self._learn(spaced, " ", inner)
        self._learn(leading, "\n", first)
        get = spaced.__getitem__
        return [self._whole(t) if lines is None else
                self.newline.join([leading[p[0]] + b"".join(map(get, p[1:])) for p in lines])
                for t, lines in zip(texts, cut)]


@lru_cache(maxsize=1)
def encoder(tokenizer_file: str, limit: int = CACHE_WORDS) -> WordEncoder:
    """One per Python worker, so that later tasks find its words."""
    return WordEncoder(tokenizer_file, limit)


class LevelPacker:
    """One split's windows. ``add`` and ``finish`` yield (window, pieces) of closed windows."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)       # N[h]: open windows filled to h; N[0], N[capacity] stay 0
        self.open: dict[int, list[list]] = {}               # level -> windows, each a list of pieces
        self.window = 0

    def _close(self, pieces: list) -> tuple[int, list]:
        self.window += 1
        return self.window - 1, pieces

    def add(self, doc) -> Iterator[tuple[int, list]]:
        """doc: (doc_id, ids as bytes, number of ids). A piece: (doc, start, length)."""
        n, cap = doc[2], self.capacity
        for start in range(0, n - n % cap, cap):
            yield self._close([(doc, start, cap)])
        rest = n % cap
        if not rest:
            return
        # change of the sum of squares when a window at h takes the rest, over 2:
        # N[h+rest] - N[h] + 1, without the lost or gained cell at h = 0 and at h + rest = capacity
        after = self.count[rest:cap + 1].copy()
        before = self.count[:cap + 1 - rest]
        cost = after - before
        cost[1:] += 1                                       # a new window (h = 0) has nothing to take away: 2N + 1
        cost = 2 * cost
        cost[0] = 2 * self.count[rest] + 1
        cost[-1] = 1 - 2 * self.count[cap - rest]           # a full window is no longer partial
        usable = before > 0
        usable[0] = True
        cost[~usable] = np.iinfo(np.int64).max
        h = int(len(cost) - 1 - np.argmin(cost[::-1]))      # ties: the fullest
        piece = (doc, n - rest, rest)
        if h:
            pieces = self.open[h].pop()
            self.count[h] -= 1
            pieces.append(piece)
        else:
            pieces = [piece]
        if h + rest == cap:
            yield self._close(pieces)
        else:
            self.open.setdefault(h + rest, []).append(pieces)
            self.count[h + rest] += 1

    def finish(self) -> Iterator[tuple[int, list]]:
        """Cut the pieces of the emptiest windows into the gaps of the fullest."""
        left = [(level, pieces) for level in sorted(self.open) for pieces in self.open[level]]
        spare: list = []                                    # pieces waiting to be placed
        while left or spare:
            level, pieces = left.pop() if left else (0, [])
            gap = self.capacity - level
            while gap and (spare or left):
                if not spare:
                    spare = left.pop(0)[1]
                doc, start, length = spare.pop()
                take = min(gap, length)
                pieces.append((doc, start, take))
                gap -= take
                if take < length:
                    spare.append((doc, start + take, length - take))
            yield self._close(pieces)
        self.open.clear()
        self.count[:] = 0


def _rows(tokenizer_file: str, capacity: int, cache_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc, packer = encoder(tokenizer_file, cache_words), LevelPacker(capacity)
    end = np.asarray([END_ID], "<u4").tobytes()
    first = TaskContext.get().partitionId() << 36
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def out(closed: list[tuple[int, list]]) -> pa.RecordBatch:
        rows = []
        for window, pieces in closed:
            offset = 0
            for (doc_id, ids, n), start, length in pieces:
                rows.append((doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n,
                             first + window, offset))
                offset += length
        cols = list(zip(*rows)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)

    for batch in batches:
        doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
        closed: list = []
        for lo in range(0, len(doc_ids), DOCS):
            part = texts.slice(lo, DOCS).to_pylist()
            for doc_id, ids in zip(doc_ids[lo:lo + DOCS], enc.encode(part)):
                ids += end
                closed.extend(packer.add((doc_id, ids, len(ids) // 4)))
        yield out(closed)
    yield out(list(packer.finish()))


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, cache_words: int = CACHE_WORDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. cache_words: words
    that a worker keeps (it keeps them after its task too); sets the cost only."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(lambda batches: _rows(tokenizer_file, capacity, cache_words, batches), SCHEMA)

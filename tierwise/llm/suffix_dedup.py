"""Suffix-array dedup: repeated byte strings by merging shard Burrows-Wheeler transforms.

A window is ``length`` bytes of one text. A byte goes if a window over it occurs
at two places or more, in one text or in several.

1. Every window has an anchor: its substring of ``length / 4`` bytes with the least
   hash, the first of equal ones. Equal windows have equal anchors, so windows are dealt out
   by their anchor's hash: a segment is a run of windows with one anchor place, and the
   segments of an anchor are a unit. Anchors seen once hold no repeat and go no further.
   Equal segments are counted before anything is shuffled, and the bytes of one of them are cut. The segments of a unit are
   counted before that, so the bytes travel to their unit alone.
2. A task reads its units in batches of ``BATCH`` bytes, split into shards of ``SHARD`` bytes.
   A shard's suffixes are sorted once, by doubling, which gives the shard's
   transform: the symbol before each suffix. Symbols are the strings of ``STRIDE`` bytes at
   every place, so a text is ``STRIDE`` strings of symbols, one for each phase.
3. The transforms of all shards are merged by refining an interleave: a round takes the symbols
   in the order of the interleave and deals the shard numbers out to the symbols' buckets,
   after which suffixes are in order by one symbol more. No suffix is compared or sorted again.
   A border between two blocks that a round sets first has a common prefix of the rounds before;
   after ``length / STRIDE`` rounds, what has no border shares ``length`` bytes: the repeated intervals.
4. Places of repeated windows go back to all texts that hold the segment, and are cut out.

Hot anchors: a unit of more than ``UNIT`` distinct segments is halved by the place of the anchor in the
window, again and again. All windows of a half share more bytes around the anchor (in the end the
whole window), which name its units. So a unit is bounded, no pairs are made, and no window is lost.

Hashes of texts and segments have 128 bits, those of symbols are checked by a second one.

Defined cases: a null text is empty; texts under ``length`` bytes lose nothing; very long texts are read
in pieces of ``PIECE`` bytes, with the windows across their ends; a repeated row is a text like any other, so both go;
doc_id is only carried along, null or not; an empty table gives no rows; other columns pass through, but
of those named like the results (``kept``, ``n_bytes``, ``spans``) the input's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

LENGTH = 400
STRIDE = 50
UNIT = 1024                     # distinct segments of a unit
BATCH, SHARD = 1 << 19, 1 << 17         # small enough for a core's cache
SLICE = 20000                   # rows of an anchor that are joined as one key
PIECE = 1 << 20
PLACE = np.uint64(PIECE - 1)
ODD = 0x9E3779B97F4A7C15        # base of the rolling hashes
_TABLES = np.random.default_rng(13).integers(0, 2 ** 63, (2, 256), dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(ODD, PIECE), _powers(pow(ODD, -1, 2 ** 64), PIECE)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Each value's bits spread over all bits."""
    for shift, factor in ((31, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(31)
    return h


def _grams(b: np.ndarray, width: int, table: int = 0) -> np.ndarray:
    """A hash of every substring of ``width`` bytes of b (of at most PIECE bytes)."""
    s = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_TABLES[table][b] * _UP[:len(b)], out=s[1:])
    return _mixed((s[width:] - s[:-width]) * _DOWN[:len(b) - width + 1])


def _least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours: from a block's end, and on from the next block's start."""
    n = len(v) - width + 1
    x = np.full(-(-len(v) // width) * width, ~np.uint64(0))
    x[:len(v)] = v
    x = x.reshape(-1, width)
    on = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], on[width - 1:width - 1 + n])


def anchor_width(length: int) -> int:
    """Bytes of an anchor. Shorter ones serve more windows, so segments are fewer, but more of them repeat by chance."""
    return max(1, length // 4)


def segments_of(text: bytes, length: int = LENGTH, width: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hash, first window, last window, anchor's place) of the runs of windows with one anchor; width: bytes of
    an anchor, half a window's by default."""
    width = width or length // 2
    step = PIECE - length
    for lo in range(0, len(text) - length + 1, step):
        b = np.frombuffer(text, np.uint8)[lo:lo + step + length - 1]
        g = _grams(b, width)
        least = _least((g & ~PLACE) | np.arange(len(g), dtype=np.uint64), length - width + 1)
        at = (least & PLACE).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:], len(at)] - 1
        at = at[first]
        yield g[at].view(np.int64), first + lo, last + lo, at + lo


# ------------------------------------------------------------------ transforms and their merge

class Shard:
    """A shard's transform: its suffixes in order (``places``), the symbol before each (``before``, 0 at a start),
    and where in the order the suffix with that symbol is (``step``; from a start to its string's end)."""

    def __init__(self, name: np.ndarray, left: np.ndarray, start: np.ndarray, lo: int, hi: int, depth: int):
        """Suffixes lo to hi of a list in which neighbours are one symbol apart. name: the symbol (0 for an empty
        suffix, the last of a string), left: symbols up to the string's end, start: whether a string starts."""
        n = hi - lo
        bits = np.uint64(max(1, n.bit_length()))
        index, low = np.arange(n, dtype=np.uint64), (np.uint64(1) << bits) - np.uint64(1)
        left, start = left[lo:hi], start[lo:hi]
        key, reach = name[lo:hi].astype(np.uint64), 1
        while True:                             # sorted by ``reach`` symbols; the index fills the key's low bits
            key = (key << bits) | index
            key.sort()
            order, key = (key & low).astype(np.int64), key >> bits
            if reach >= depth:
                break
            rank = np.empty(n, np.uint64)
            rank[order] = np.cumsum(np.r_[True, key[1:] != key[:-1]])
            key = rank << bits
            has = np.flatnonzero(left >= reach)
            key[has] |= rank[has + reach]
            reach *= 2
        self.places = order + lo
        came = np.arange(-1, n - 1)
        first = np.flatnonzero(start)
        came[first] = first + left[first]
        self.before = np.where(start, 0, np.r_[0, name[lo:hi - 1]])[order]
        at = np.empty(n, np.int64)
        at[order] = np.arange(n)
        self.step = at[came[order]]


def merged(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in merged order by ``depth`` symbols, and the common prefix (in symbols) of each with the one before it
    (``depth`` stands for that or more)."""
    offset = np.cumsum([0] + [len(s.places) for s in shards])
    before = np.concatenate([s.before for s in shards]).astype(np.uint64)
    step = np.concatenate([s.step + o for s, o in zip(shards, offset)])
    n = int(offset[-1])
    bits = np.uint64(max(1, n.bit_length()))
    index, low = np.arange(n, dtype=np.uint64), (np.uint64(1) << bits) - np.uint64(1)
    mix = np.arange(n)                          # the interleave: one shard's suffixes after the other's
    block = np.zeros(n, np.int32)
    prefix = np.full(n, depth, np.int16)
    prefix[:1] = 0
    for known in range(depth):
        key = (before[mix] << bits) | index
        key.sort()                              # dealt out to the symbols' buckets, in order within each
        taken = (key & low).astype(np.int64)
        key >>= bits
        mix, old = step[mix[taken]], block[taken]
        border = np.zeros(n, bool)
        border[1:] = (key[1:] != key[:-1]) | ((old[1:] != old[:-1]) & (key[1:] != 0))
        prefix[border & (prefix == depth)] = known
        block = np.cumsum(border, dtype=np.int32)
    return np.concatenate([s.places for s in shards])[mix], prefix


def repeated_windows(texts: list[bytes], counts: np.ndarray, length: int = LENGTH, stride: int = STRIDE,
                     shard_bytes: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """(text number, place) of all windows that occur twice or more; counts: how often each text does."""
    depth = length // stride
    size = np.array([len(t) for t in texts])
    # a text's strings: one for each phase that has a window, a symbol at every stride'th place, then the empty suffix
    phases = np.minimum(np.maximum(size - length + 1, 0), stride)
    text = np.repeat(np.arange(len(texts)), phases)
    phase = np.arange(len(text)) - np.repeat(np.cumsum(phases) - phases, phases)
    symbols = (size[text] - phase) // stride
    begin = np.r_[0, np.cumsum(symbols + 1)]
    n = int(begin[-1])
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    string = np.repeat(np.arange(len(text)), symbols + 1)
    nth = np.arange(n) - begin[string]
    left = symbols[string] - nth
    byte = phase[string] + nth * stride
    flat = np.frombuffer(b"".join(texts), np.uint8)
    at = (np.cumsum(size) - size)[text[string]] + byte
    one, two = (np.concatenate([_grams(flat[i:i + PIECE], stride, k)[:PIECE - stride]
                                for i in range(0, len(flat) - stride + 1, PIECE - stride)]) for k in (0, 1))
    whole = np.flatnonzero(left > 0)
    one, two = one[at[whole]], two[at[whole]]
    names, of = np.unique(one, return_inverse=True)
    check = np.zeros(len(names), np.uint64)
    check[of] = two
    if (check[of] != two).any():                # one hash for two strings: name them by both
        of = np.unique(np.stack([one, two], 1), axis=0, return_inverse=True)[1].ravel()
    name = np.zeros(n, np.int64)
    name[whole] = of + 1
    edge = np.unique(np.r_[0, begin[np.searchsorted(begin, np.arange(shard_bytes, n, shard_bytes))], n]).tolist()
    shards = [Shard(name, left, nth == 0, a, b, depth) for a, b in zip(edge[:-1], edge[1:])]
    places, prefix = merged(shards, depth)
    begins = np.flatnonzero(prefix < depth)
    owner = text[string[places]]
    weight = np.add.reduceat(counts[owner], begins)
    interval = np.cumsum(prefix < depth) - 1
    hit = (left[places] >= depth) & (weight[interval] > 1)      # suffixes of less than a window end before it
    who, where = owner[hit], byte[places[hit]]
    order = np.lexsort((where, who))
    return who[order], where[order]


# ------------------------------------------------------------------ Spark

def _hashes(value: Column) -> list[Column]:
    return [F.xxhash64(value).alias("t1"), F.xxhash64(F.lit(LENGTH), value).alias("t2")]


def _bytes(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")


_SEG = "g long, s1 long, s2 long, t1 long, t2 long, start int, off int, size int"


def _anchored(docs: DataFrame, length: int) -> DataFrame:
    """A row per segment of every row of docs."""
    import xxhash

    def segments(t1: pa.Scalar, t2: pa.Scalar, text: bytes) -> Iterator[pa.RecordBatch]:
        for g, first, last, at in segments_of(text, length, anchor_width(length)):
            s = np.frombuffer(b"".join([xxhash.xxh3_128_digest(text[x:y]) for x, y in zip(first.tolist(), (last + length).tolist())]), "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(g), pa.array(s[::2]), pa.array(s[1::2]), pa.repeat(t1, len(g)), pa.repeat(t2, len(g)),
                 *[pa.array(x.astype(np.int32)) for x in (first, at - first, last - first + length)]],
                ["g", "s1", "s2", "t1", "t2", "start", "off", "size"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0                         # a text's rows are few: send them on together
        for b in batches:
            for t1, t2, text in zip(*b.columns):
                for part in segments(t1, t2, text.as_py()):
                    held.append(part)
                    n += part.num_rows
                if n >= 20000:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    text = _bytes(docs)
    return docs.where(F.length(text) >= length).select(*_hashes(text), text.alias("text")).mapInArrow(rows, _SEG)


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """The anchor hash of each segment alone."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [g for text in b.column(0) for g, *_ in segments_of(text.as_py(), length, anchor_width(length))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["g"])

    text = _bytes(docs)
    return docs.where(F.length(text) >= length).select(text.alias("text")).mapInArrow(rows, "g long")


def _packed(docs: DataFrame) -> DataFrame:
    """t1, t2, blob (the text's bytes, compressed for the shuffle) and row (the columns of docs without text)."""
    import zstandard

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=1)
        for b in batches:
            blob = pa.array([c.compress(t.as_py()) for t in b.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), blob, b.column(3)], ["t1", "t2", "blob", "row"])

    text = _bytes(docs)
    row = F.struct(F.lit(0).alias("_"), *[docs[c] for c in docs.columns if c != "text"])
    d = docs.select(*_hashes(text), text.alias("blob"), row.alias("row"))
    return d.mapInArrow(rows, d.schema)


def _cut(segments: DataFrame, docs: DataFrame) -> DataFrame:
    """segments with their bytes, from the text that ``at`` names."""
    import zstandard

    wanted = segments.groupBy("at.t1", "at.t2").agg(F.collect_list(F.struct("g", "s1", "s2", "n", "fan", "off", "members", "size", "at.start")).alias("s"))
    texts = _packed(docs.select("text")).groupBy("t1", "t2").agg(F.first("blob").alias("blob"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for b in batches:
            for blob, s in zip(b.column(0), b.column(1)):
                text, s = z.decompress(blob.as_py()), s.values
                start, size = s.field("start").to_pylist(), s.field("size").to_pylist()
                cols = [s.field(k) for k in ("g", "s1", "s2", "n", "fan", "off", "members")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([text[a:a + n] for a, n in zip(start, size)], pa.binary())],
                                                 ["unit", "i1", "i2", "n", "fan", "off", "members", "bytes"])

    return texts.join(wanted, ["t1", "t2"]).select("blob", "s").mapInArrow(
        rows, "unit long, i1 long, i2 long, n long, fan int, off int, members long, bytes binary")


def _counted(segments: DataFrame, unit: str) -> DataFrame:
    """segments of units with two places or more, with members: the distinct segments of their unit."""
    size = segments.groupBy(unit).agg(F.count("*").alias("members"), F.sum("n").alias("places")).where("places > 1")
    return segments.join(size.select(unit, "members"), unit)


def _halved(hot: DataFrame, lo: int, hi: int, length: int) -> DataFrame:
    """hot (windows with their anchor lo to hi bytes from their start) as two halves: parent p1, p2 and shift,
    and the half's unit, i1, i2, n, off, bytes, lo, hi."""
    mid = (lo + hi) // 2
    halves = F.explode(F.array(*[F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi")) for a, b in ((lo, mid), (mid + 1, hi))]))
    # the segment's windows have their anchor from least to off bytes from their start
    least = F.col("off") - (F.length("bytes") - length)
    x = hot.withColumn("half", halves).select("unit", F.col("i1").alias("p1"), F.col("i2").alias("p2"), "n", "fan", "off", "bytes",
                                              F.col("half.lo").alias("lo"), F.col("half.hi").alias("hi"), least.alias("least"))
    x = x.where((F.col("off") >= F.col("lo")) & (F.col("least") <= F.col("hi")))
    far, near = F.least("hi", "off"), F.greatest("lo", "least")
    shift = (F.col("off") - far).cast("int")
    piece = F.substring(F.col("bytes"), shift + 1, (far - near + length).cast("int"))
    core = F.substring(F.col("bytes"), (F.col("off") - F.col("lo") + 1).cast("int"), (F.lit(length) - F.col("hi") + F.col("lo")).cast("int"))
    x = x.select("p1", "p2", shift.alias("shift"), F.xxhash64("unit", "lo", core).alias("unit"), "n", "fan", far.cast("int").alias("off"),
                 piece.alias("bytes"), "lo", "hi")
    return x.select("p1", "p2", "shift", "unit", F.xxhash64("bytes").alias("i1"), F.xxhash64(F.lit(LENGTH), "bytes").alias("i2"),
                    "n", "fan", "off", "bytes", "lo", "hi")


def _units(cut: DataFrame, length: int, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Units of at most ``most`` distinct segments, by level, and for each level the parents of its segments."""
    done, maps, level = None, [], 0
    ranges = [(0, length - anchor_width(length))]
    while True:
        small = cut.where(F.col("members") <= most) if level < 32 else cut
        small = small.select("unit", "i1", "i2", "n", "fan", "bytes", F.lit(level).alias("level"))
        done = small if done is None else done.unionByName(small)
        hot = cut.where(F.col("members") > most).drop("members")
        if hot.isEmpty():
            return done, maps
        parts = [_halved(hot.where((F.col("lo") == a) & (F.col("hi") == b)) if "lo" in hot.columns else hot, a, b, length)
                 for a, b in ranges if a < b]
        x = parts[0]
        for p in parts[1:]:
            x = x.unionByName(p)
        x = written(x, "suffix-halves")
        maps.append(x.select("p1", "p2", "i1", "i2", "shift").distinct())
        cut = x.groupBy("i1", "i2").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("unit", "fan", "off", "bytes", "lo", "hi")])
        cut = written(_counted(cut, "unit"), "suffix-units")
        ranges = [r for a, b in ranges if a < b for r in ((a, (a + b) // 2), ((a + b) // 2 + 1, b))]
        level += 1


def _merge_units(units: DataFrame, length: int, stride: int) -> DataFrame:
    """level, i1, i2 and runs of repeated windows (first, last: places in the segment)."""
    def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        who, at = repeated_windows(t["bytes"].to_pylist(), t["n"].to_numpy(), length, stride)
        new = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (at[1:] != at[:-1] + 1)]) if len(who) else np.empty(0, np.int64)
        end = np.r_[new[1:], len(who)] - 1 if len(who) else new
        names = ["level", "fan", "i1", "i2"]
        of = t.select(names).take(pa.array(who[new])).combine_chunks()
        cols = [of[c].combine_chunks() if of.num_rows else pa.array([], of.schema.field(c).type) for c in names]
        return pa.RecordBatch.from_arrays([*cols, pa.array(at[new].astype(np.int32)), pa.array(at[end].astype(np.int32))],
                                          [*names, "first", "last"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            unit = b.column(0).to_numpy()
            edges = np.r_[0, np.flatnonzero(unit[1:] != unit[:-1]) + 1, len(unit)] if len(unit) else [0]
            for lo, hi in zip(edges[:-1], edges[1:]):
                part = b.slice(lo, hi - lo)
                # a batch ends with a unit
                if n >= BATCH and unit[lo] != held[-1].column(0)[-1].as_py():
                    yield found(held)
                    held, n = [], 0
                held.append(part)
                n += part.column(6).nbytes
        if held:
            yield found(held)

    u = units.select("unit", "level", "fan", "i1", "i2", "n", "bytes").repartition("unit").sortWithinPartitions("unit")
    return u.mapInArrow(rows, "level int, fan int, i1 long, i2 long, first int, last int")


def repeated_spans(docs: DataFrame, length: int = LENGTH, stride: int = STRIDE, unit: int = UNIT) -> DataFrame:
    """t1, t2 (a text's hashes) and spans (array of the places [first, end) that repeated windows cover, not yet united)."""
    if length % stride or length % 2 or length // 2 < stride:
        raise ValueError("length must be even and a multiple of stride, at least twice as long")
    c = _anchors(docs.select("text"), length).groupBy("g").agg(F.count("*").alias("c")).where("c > 1")
    # a hot anchor's places are joined in slices; its segments know how many
    seen = written(c.select("g", F.ceil(F.col("c") / SLICE).cast("int").alias("fan")), "suffix-anchors")
    # s1, s2 tell g, so rows of a hot anchor are dealt out anew for the count
    places = _anchored(docs.select("text"), length).join(seen, "g")
    places = written(places.groupBy("s1", "s2", "t1", "t2", "start").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("g", "fan", "off", "size")]), "suffix-places")
    segments = places.groupBy("s1", "s2").agg(F.sum("n").alias("n"), F.min(F.struct("t1", "t2", "start")).alias("at"),
                                              *[F.first(c).alias(c) for c in ("g", "fan", "off", "size")])
    cut = written(_cut(_counted(segments, "g"), docs), "suffix-segments")
    units, maps = _units(cut, length, unit)
    found = written(_merge_units(units, length, stride), "suffix-found")
    hits = None
    for level in range(len(maps), -1, -1):
        here = found.where(F.col("level") == level).select("fan", "i1", "i2", "first", "last")
        hits = here if hits is None else hits.unionByName(here)
        if level:                               # windows of a half are windows of all its parents
            m = maps[level - 1]
            hits = hits.join(m, ["i1", "i2"]).select("fan", F.col("p1").alias("i1"), F.col("p2").alias("i2"), (F.col("first") + F.col("shift")).alias("first"),
                                                     (F.col("last") + F.col("shift")).alias("last"))
    runs = hits.groupBy("fan", "i1", "i2").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    runs = runs.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("fan") - 1))).drop("fan")
    places = places.withColumn("of", F.pmod(F.xxhash64("t1", "start"), F.col("fan")).cast("int"))
    placed = runs.join(places, (F.col("i1") == F.col("s1")) & (F.col("i2") == F.col("s2")) & (F.col("slice") == F.col("of")))
    moved = F.transform("runs", lambda r: F.struct((F.col("start") + r["first"]).alias("first"),
                                                   (F.col("start") + r["last"] + length).alias("end")))
    return placed.select("t1", "t2", moved.alias("runs")).groupBy("t1", "t2").agg(F.flatten(F.collect_list("runs")).alias("spans"))


def united(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Maximal runs (rows of first, end) of the places that the spans cover."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, first[1:] > end[:-1]])
    return np.stack([first[new], end[np.r_[new[1:], len(first)] - 1]], 1)


def deduplicated(docs: DataFrame, length: int = LENGTH, stride: int = STRIDE, unit: int = UNIT) -> DataFrame:
    """The columns of docs but text, with kept (the remaining bytes), n_bytes and spans (the maximal removed
    runs, as an array of first and end)."""
    import zstandard

    spans = repeated_spans(docs, length, stride, unit)
    d = _packed(docs).join(spans, ["t1", "t2"], "left").select("row", "blob", "spans")
    out = "kept binary, n_bytes long, spans array<struct<first:long,end:long>>"
    kept_names = [c for c in docs.columns if c not in ("text", "kept", "n_bytes", "spans")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for b in batches:
            kept, n_bytes, cuts = [], [], []
            for blob, s in zip(b.column(1), b.column(2)):
                text = z.decompress(blob.as_py())
                n_bytes.append(len(text))
                if s.is_valid:
                    runs = united(*(s.values.field(k).to_numpy().astype(np.int64) for k in ("first", "end")))
                    edge = np.r_[0, runs.ravel(), len(text)].tolist()
                    text = b"".join([text[x:y] for x, y in zip(edge[::2], edge[1::2])])
                    cuts.append([{"first": x, "end": y} for x, y in runs.tolist()])
                else:
                    cuts.append([])
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(kept, pa.binary()), pa.array(n_bytes, pa.int64()),
                 pa.array(cuts, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))], ["row", "kept", "n_bytes", "spans"])

    got = d.mapInArrow(rows, f"row {d.schema['row'].dataType.simpleString()}, {out}")
    return got.select(*[F.col("row")[c].alias(c) for c in kept_names], "kept", "n_bytes", "spans")

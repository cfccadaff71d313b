"""Mixing sources to target weights by pivotal dependent rounding.

A source of ``size`` words that the mix wants ``target`` words from takes each
of its documents ``target / size`` times on average: a whole number of copies
and a fraction. The fractions are rounded together. Two documents form a pair,
each with a mass (its size times its fraction); one hands mass to the other
until one of the two fractions is 0 or 1, in the direction drawn so that every
expected fraction stays as it was. The survivor meets the next document. As
mass only moves, the words taken from a source stay at its target, but for the
last survivor: less than one document.

Pairing runs as a reduction tree. Level 0 cuts each source into blocks of about
``FAN_IN`` documents by a hash; a block is folded by one SQL ``aggregate`` and
leaves one survivor; a level's survivors are the next level's documents. A
source that holds a third of all rows is just more blocks. Draws are hashes of
the document and the level, so reruns agree whatever the partitioning.

All on DataFrame functions: no Python code runs on the executors.

Defined cases: a null text has size 0; a document of size 0 is never taken; a
null source is a source, the last in order; rows that agree in doc_id, source
and size are rounded as one and share its copies, larger shares first; an empty
table gives an empty mix; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CEILING = 2
FAN_IN = 64
SEED = 9


def text_size(text: Column) -> Column:
    """Number of words of a text; null as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: int = CEILING) -> DataFrame:
    """Per source: source_size, n_items, target. sizes: source, size per row.

    ``target = min(ceiling * size, level * weight)``, with the level at which
    the targets add up to the share: what capped sources can't take goes to the
    others by weight. The windows run over one row per source."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_items"))
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(ceiling)))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    every = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    total = F.lit(float(share)) * F.sum("source_size").over(every)
    level = ((total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    s = s.withColumn("level", level).withColumn("place", F.row_number().over(by_ratio))
    # the first source that the level leaves under its ceiling, and with it all after it
    fits = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(every)["level"]
    target = F.least(F.col("cap"), F.coalesce(fits * F.col("weight"), F.col("cap")))
    return s.select("source", "source_size", "n_items", target.alias("target"))


def _draw(level: int) -> Column:
    h = F.xxhash64(F.lit(SEED), F.lit(level), "source", "doc_id", "size")
    return F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))


def _fold(items: Column) -> Column:
    """Round an array of items (…, size, mass, draw); gives (cur, out): the survivor and the settled."""
    settled = lambda x, take: F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["base"].alias("base"),
                                       x["n"].alias("n"), take.cast("int").alias("take"))

    def item(x: Column, mass: Column) -> Column:
        return F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["base"].alias("base"),
                        x["n"].alias("n"), mass.alias("mass"))

    def meet(acc: Column, b: Column) -> Column:
        a = acc["cur"]
        room_a, room_b = a["size"] - a["mass"], b["size"] - b["mass"]
        gain, loss = F.least(room_a, b["mass"]), F.least(a["mass"], room_b)      # what a can get, or give
        up = b["draw"] * (gain + loss) < loss
        a_ends = F.when(up, room_a <= b["mass"]).otherwise(a["mass"] <= room_b)
        step = F.array(F.struct(up.alias("up"), a_ends.alias("a_ends")))

        def moved(d: Column) -> Column:
            one = d["up"] == d["a_ends"]                    # the settled one is taken
            both = a["mass"] + b["mass"]
            mass = F.when(one, both - F.when(d["a_ends"], a["size"]).otherwise(b["size"])).otherwise(both)
            mass = F.greatest(mass, F.lit(0.0))
            cur = F.when(d["a_ends"], item(b, mass)).otherwise(item(a, mass))
            done = F.when(d["a_ends"], settled(a, one)).otherwise(settled(b, one))
            return F.struct(cur.alias("cur"), F.concat(acc["out"], F.array(done)).alias("out"))

        return F.transform(step, moved)[0]

    head = items[0]
    none = F.slice(F.array(settled(head, F.lit(0))), 1, 0)
    start = F.struct(item(head, head["mass"]).alias("cur"), none.alias("out"))
    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items), F.lit(1))), start, meet)


def _level(items: DataFrame, level: int) -> DataFrame:
    """One level of the tree: source, block, folded."""
    x = items.withColumn("draw", _draw(level))
    one = F.struct("draw", "doc_id", "size", "base", "n", "mass")
    got = x.groupBy("source", "block").agg(F.array_sort(F.collect_list(one)).alias("items"))
    return written(got.select("source", "block", _fold(F.col("items")).alias("folded")), f"mix-level{level}")


def rounded(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: int = CEILING) -> DataFrame:
    """Per group of rows that agree in doc_id, source and size: those, n (its rows), copies (theirs
    together), source_size and target."""
    sizes = written(docs.select("doc_id", F.col("source").cast("string").alias("source"),
                                text_size(F.col("text").cast("string")).alias("size")), "mix-sizes")
    targets = written(source_targets(sizes, weights, share, ceiling), "mix-targets")
    rows = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target", "n_items")
    items = rows.join(t, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    rate = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    wanted = F.col("n") * rate
    items = (items.withColumn("base", F.floor(wanted + F.lit(1e-9)))
             .withColumn("mass", F.greatest(wanted - F.col("base"), F.lit(0.0)) * F.col("size"))
             .withColumn("blocks", F.ceil(F.col("n_items") / F.lit(FAN_IN))))
    # settled before any pairing: whole copies only
    whole = F.col("mass") <= F.lit(1e-9)
    got = [items.where(whole).select("doc_id", "source", "size", "base", "n", F.lit(0).alias("take"))]
    block = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "size"), F.col("blocks"))
    left = items.where(~whole).select("source", block.alias("block"), "doc_id", "size", "base", "n", "mass")
    most = targets.agg(F.max("n_items")).first()[0] or 0
    blocks, level = -(-most // FAN_IN), 0
    while True:
        folded = _level(left, level)
        got.append(folded.select("source", F.explode("folded.out").alias("x"))
                   .select("x.doc_id", "source", "x.size", "x.base", "x.n", "x.take"))
        left = folded.select("source", F.floor(F.col("block") / F.lit(FAN_IN)).alias("block"), "folded.cur.*")
        level += 1
        if blocks <= 1:
            break
        blocks = -(-blocks // FAN_IN)
    last = F.when(_draw(level) * F.col("size") < F.col("mass"), 1).otherwise(0)
    got.append(left.select("doc_id", "source", "size", "base", "n", last.alias("take")))
    out = got[0]
    for g in got[1:]:
        out = out.unionByName(g)
    out = out.select("doc_id", "source", "size", "n", (F.col("base") + F.col("take")).alias("copies"))
    return out.join(t.drop("n_items"), F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")


def _of_row(k: str) -> Column:
    """The copies of the k-th of n rows that share ``copies``."""
    more = F.when(F.col(k) <= F.col("copies") % F.col("n"), 1).otherwise(0)
    return (F.floor(F.col("copies") / F.col("n")) + more).cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: int = CEILING) -> DataFrame:
    """Per row of docs: doc_id, source, size, source_size, target, copies, taken."""
    out = rounded(docs, weights, share, ceiling).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n"))))
    out = out.withColumn("copies", _of_row("k"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as the mix takes it. Texts move once: the join and the
    numbering of repeated rows use one key."""
    key = F.xxhash64("doc_id", "source", "size")
    m = rounded(docs, **options).where("copies > 0").select(
        key.alias("key"), F.struct("doc_id", "source", "size").alias("which"), "n", "copies")
    d = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    d = d.select("row", F.struct(F.col("row.doc_id").alias("doc_id"),
                                 F.col("row.source").cast("string").alias("source"),
                                 text_size(F.col("row.text").cast("string")).alias("size")).alias("of"))
    d = d.withColumn("key", F.xxhash64("of.doc_id", "of.source", "of.size"))
    d = d.join(m, "key").where(F.col("of").eqNullSafe(F.col("which")))
    same = Window.partitionBy("key", "of").orderBy("row.text")
    d = d.withColumn("k", F.row_number().over(same))
    d = d.withColumn("copy", F.explode(F.array_repeat(F.lit(1), _of_row("k").cast("int"))))
    return d.select("row.*")

"""Connected components of a link table, by large-star / small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """links: u, v (any order, repeats and loops allowed). Gives (node, root) for every node that has a
    link and isn't the smallest of its component; root is the smallest.

    Each round links every node's neighbours to its smallest neighbour and is written to the shared
    folder; rounds end when one changes nothing."""
    def oriented(a, b) -> list:
        return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]

    e = written(links.select(*oriented("u", "v")).where("u <> v").distinct(), name)
    state = None
    for i in range(200):
        now = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == state or not now["n"]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u")           # larger neighbours go to the smallest
                 .select(*oriented("v", "m")).where("u <> v").distinct())
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        both = large.join(small, "u")                           # smaller neighbours and the node go there too
        e = written(both.select(F.explode(F.array(F.struct(*oriented("v", "m")), F.struct(*oriented("u", "m"))))
                                .alias("x")).select("x.*").where("u <> v").distinct(), f"{name}-{i}")
    raise RuntimeError("components did not settle")


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of n nodes, under links a[i] - b[i]."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root

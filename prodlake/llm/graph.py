"""Connected components of an edge table by alternating large and small stars.

Each step is a group-by (combined in the tasks first) and a join back; the
intermediate edge table is staged, so both join sides come straight from
storage and a hub's rows can be split. The number of steps grows with the
logarithm of the graph; a star is done in two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``v, c`` for every vertex of ``u, v`` (whole numbers): ``c`` is the
    smallest vertex it is connected with. No edges: no rows."""
    now = stage(_oriented(edges), "edges", edges.count())
    state = _state(now)
    while True:
        # steps never add edges, but for one a vertex at most
        now = stage(_small_star(_large_star(now)), "edges", state[0])
        was, state = state, _state(now)
        if was == state:
            # every vertex points at its component's smallest
            roots = now.select(F.col("v").alias("r")).distinct()
            return now.select(F.col("u").alias("v"), F.col("v").alias("c")).union(roots.select("r", "r"))


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller vertex."""
    a, b = F.greatest("u", "v"), F.least("u", "v")
    return edges.select(a.alias("u"), b.alias("v")).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _oriented(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(linked.union(least))

"""Connected components of an edge table by alternating stars.

Large-star links every larger neighbour of a node to the smallest one it
knows, small-star does so for the smaller ones; the edge set converges to one
star per component, centred on its smallest node, in a logarithmic number of
rounds.  Each star is one map-side-combined minimum and one join on the same
key, so a hub's edges are pre-aggregated and its join partition can be split;
no group is collected.  Every round is written to the shared folder, which
bounds the lineage and survives executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warnindex.llm.common import written


def large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(e: DataFrame) -> DataFrame:
    m = e.groupBy("u").agg(F.min("v").alias("m"))
    j = e.join(m, "u")
    return (
        j.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(m.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node on an edge; component = smallest node.

    Edges with a null end and self-loops are ignored; repeated edges count
    once; an empty table gives an empty result.
    """
    e = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
        .filter("_a is not null and _b is not null and u <> v").select("u", "v").distinct()
    )
    e = written(e, "cc-edges")
    state = _state(e)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        e = written(small_star(large_star(e)), "cc-star")
        new = _state(e)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("connected components did not converge")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

"""Connected components of a graph that no machine could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapelog.llm.common import join_keyed, materialize


def components(edges: DataFrame, folder: str, longest: int = 60) -> DataFrame:
    """(node, root) of every node of an edge, where root is the smallest node it is connected to.

    edges: a and b of one orderable type; repeated edges and loops are allowed. Large-star and
    small-star steps alternate (Kiveris et al., "Connected Components in MapReduce and Beyond",
    2014): each node's neighbours are handed to its smallest neighbour, by a min() that is combined
    before the shuffle, and a join in which nodes of many edges are broadcast. Each aggregate and each
    step is a written table.
    """
    now = materialize(edges.filter("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), f"{folder}/star0")
    before = None
    for step in range(1, longest + 1):
        # Large star: larger neighbours of u, and u, link to u's smallest neighbour (itself included).
        both = now.select("u", "v").union(now.selectExpr("v AS u", "u AS v"))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("rows")), f"{folder}/least{step}")
        large = join_keyed(both, least, ["u"], "rows").filter("v > u").selectExpr("v AS u", "m AS v").filter("u <> v")
        small_in = materialize(large.distinct(), f"{folder}/large{step}")
        # Small star: smaller neighbours of u, and u, link to the smallest of them.
        small = materialize(small_in.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows")), f"{folder}/small{step}")
        joined = join_keyed(small_in, small, ["u"], "rows").filter("v <> m").selectExpr("v AS u", "m AS v")
        now = materialize(joined.union(small.selectExpr("u", "m AS v")).distinct(), f"{folder}/star{step}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"the components didn't settle in {longest} steps")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.selectExpr("u AS node", "v AS root").union(roots)

"""Connected components of a link table, by DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id in `links` (a long, b long); root: the smallest id reachable.

    Each round hooks every node to its smallest neighbour, follows the hooks
    three times, and contracts the links; a path shrinks eightfold a round.
    Links with a null end and links of a node to itself say nothing and are
    dropped. No links: no rows.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct())
    ids = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    roots = written(ids.select("id", F.col("id").alias("root")))
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to"))
        hook = written(hook.select("id", F.least("id", "to").alias("to")))
        for _ in range(3):
            nxt = hook.select(F.col("id").alias("to"), F.col("to").alias("next"))
            hook = written(hook.join(nxt, "to", "left").select("id", F.coalesce("next", "to").alias("to")))
        roots = written(
            roots.join(hook.select(F.col("id").alias("root"), "to"), "root", "left")
            .select("id", F.coalesce("to", "root").alias("root")))
        a = hook.select(F.col("id").alias("a"), F.col("to").alias("a2"))
        b = hook.select(F.col("id").alias("b"), F.col("to").alias("b2"))
        edges = written(
            edges.join(a, "a").join(b, "b").where("a2 <> b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct())
    return roots

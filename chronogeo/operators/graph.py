"""Closure of a type hierarchy under its subclass edges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import cut


def type_closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, category) for all nodes that some root reaches against the edges (child, parent).

    roots: (node, category, priority); a node that several roots reach takes the category of the least priority.  Each
    round follows the frontier only, and priorities only fall, so cycles end.
    """
    best = lambda d: d.groupBy("node").agg(F.min("priority").alias("priority"))
    e = cut(edges.where("child is not null and parent is not null").distinct())
    frontiers = [cut(best(roots))]
    while not frontiers[-1].isEmpty():
        found = best(e.join(frontiers[-1], F.col("parent") == F.col("node")).select(F.col("child").alias("node"), "priority"))
        # what is known stays where it was written, round by round; only the new frontier is
        known = reduce(DataFrame.union, frontiers).select("node", F.col("priority").alias("_old"))
        better = found.join(known, (found["node"] == known["node"]) & (F.col("_old") <= F.col("priority")), "left_anti")
        frontiers.append(cut(better))
    seen = best(reduce(DataFrame.union, frontiers))
    names = roots.select("priority", "category").distinct()
    first = Window.partitionBy("priority").orderBy("category")
    names = names.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return seen.join(names, "priority").select("node", "category")

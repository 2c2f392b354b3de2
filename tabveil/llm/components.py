"""Connected components of a large edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabveil.llm.common import drop, stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``edges`` (a, b long); the root is one node of the component.

    In each round a node points to its smallest neighbour, two jumps shorten the pointers, and the edges move to
    where their ends point. Equal ends vanish, so the table shrinks until none are left. Counting neighbours
    is a partial aggregate and joins are on nodes, so a hub is no single task's work beyond its join.
    """
    left = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    found = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        last, before = left, found
        near = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select(
            "node", F.least("node", "to").alias("to")
        ), "nearest")
        point = near
        for _ in range(2):
            onward = point.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
            point = point.join(onward, "to", "left").select("node", F.coalesce("beyond", "to").alias("to"))
        point = stage(point, "pointers")
        a, b = point.toDF("a", "ta"), point.toDF("b", "tb")
        left = stage(
            left.join(a, "a").join(b, "b").where("ta <> tb").select(
                F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")
            ).distinct(),
            "edges",
        )
        if found is None:
            found = stage(point.toDF("node", "root"), "roots")
        else:
            step = point.toDF("root", "to")
            found = stage(found.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
            drop(before)
        drop(last, near, point)
    drop(left)
    return found if found is not None else edges.sparkSession.createDataFrame([], "node long, root long")

"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import written


def _state(edges: DataFrame) -> tuple:
    seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(seen)


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (its least id) of every id in the links ``a``, ``b``.

    A round links all larger neighbours of an id to the least id near it, then all smaller
    ones; rounds go on until no link changes and grow with the logarithm of a component's
    diameter. Only least ids are gathered per id, so that no neighbourhood is held by a task.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
        large = written(
            edges.select(F.col("a").alias("v"), F.col("b").alias("a")).join(least, "a")
            .select(F.col("v").alias("a"), F.col("least").alias("b")).distinct(),
            "large-star",
        )
        least = written(large.groupBy("a").agg(F.min("b").alias("least")), "least")
        edges = written(
            large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
            .union(least.select("a", F.col("least").alias("b"))).distinct(),
            "small-star",
        )
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )

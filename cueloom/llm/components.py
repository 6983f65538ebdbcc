"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so no vertex's neighbours are
gathered in one task; each step's edges are written to the shared folder, which
cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """edges: (a, b) longs. Returns (id, component) for each vertex with an edge to another; component is the smallest id."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = scratch.save(pairs, f"{name}-0")
    step, state = 0, _state(pairs)
    while state[0]:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        step += 1
        pairs = scratch.save(small.where("a <> b").distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        was, state = state, _state(pairs)
        if was == state:
            break
    stars = pairs.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
    roots = pairs.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return stars.union(roots)

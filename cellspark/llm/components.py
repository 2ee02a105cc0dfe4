"""Connected components over an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _lowest(tied: DataFrame, low: DataFrame) -> DataFrame:
    """Each row's node met with the node's lowest: both sides are plain tables, so the rows of a star's centre can be split."""
    return tied.join(stored(low, "components-low").hint("merge"), "a")


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return _lowest(both.where("b > a"), low).select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("low"))
    tied = _lowest(down, low).select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b")
    return tied.unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Number of edges and 128 bits of hash over them as a set."""
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.bit_xor(F.xxhash64("b", "a", F.lit(1))).alias("y")).first()
    return r["n"], r["x"], r["y"]


def connected_components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """edges: a, b (any ordered type) -> node, component (its smallest node).  Nodes without an edge are not listed.

    Every round's edges are written to the shared folder.  Edges of a component end as a star on its smallest node.
    Rounds go on until the edges repeat; where `rounds` bounds them and they run out before that, it raises.
    """
    now = stored(edges.select("a", "b").where("a != b").distinct(), "components")
    seen = _state(now)
    for i in count():
        if i == rounds:
            raise RuntimeError(f"edges still change after {rounds} rounds")
        now = stored(_small(_large(now)), "components")
        new = _state(now)
        if new == seen:
            break
        seen = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()

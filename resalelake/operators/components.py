"""Connected components of a graph given by its edges.

Large-star and small-star steps take turns until nothing changes: every node is tied to the smallest node around it, so paths
halve and each component ends as one star around its smallest node. Each step is a grouped minimum and a join on the node; rows of a node
with very many neighbours are split over tasks. Steps are written to the shared folder, so a lost executor repeats one step only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resalelake.operators.joins import attach
from resalelake.session import shared_folder

MOST_ROUNDS = 64


def _stars(pairs: DataFrame) -> DataFrame:
    """Each (node, near) with the smallest node around ``node``, itself included."""
    least = pairs.groupBy("node").agg(F.min("near").alias("least"))
    return attach(pairs, least, "node", spread=["near"]).withColumn("least", F.least("node", "least"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("near").alias("node"), F.col("node").alias("near")))
    return _stars(both).where("near > node").select(F.col("near").alias("node"), F.col("least").alias("near"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("node", "near").alias("node"), F.least("node", "near").alias("near"))
    stars = _stars(down)
    return stars.select(F.inline(F.array(F.struct("node", F.col("least").alias("near")), F.struct(F.col("near").alias("node"), F.col("least").alias("near")))))


def _written(edges: DataFrame, folder: str) -> tuple[DataFrame, tuple]:
    """A step's distinct edges, and a sum that tells one set of edges from another."""
    edges.where("node <> near").distinct().write.parquet(folder)
    stored = edges.sparkSession.read.schema(edges.schema).parquet(folder)
    mark = stored.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "near").cast("decimal(20,0)"))).first()
    return stored, tuple(mark)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component: the smallest node reachable, for every node of an edge. An edge from a node to itself makes it known;
    edges with a null end are left out."""
    folder = shared_folder(edges.sparkSession, f"components-{uuid.uuid4().hex[:8]}")
    given = edges.select(F.col(a).alias("node"), F.col(b).alias("near")).dropna()
    given.distinct().write.parquet(f"{folder}/given")
    given = edges.sparkSession.read.schema(given.schema).parquet(f"{folder}/given")
    nodes = given.select("node").unionByName(given.select(F.col("near").alias("node"))).distinct()
    now, mark = given, None
    for n in range(MOST_ROUNDS):
        large, _ = _written(_large(now), f"{folder}/{n}-large")
        now, found = _written(_small(large), f"{folder}/{n}-small")
        if found == mark:
            stars = now.select("node", F.col("near").alias("component"))
            return nodes.join(stars, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
        mark = found
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")

"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import checkpoint_dir, ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``; listed anew on every call."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder."""
    root = checkpoint_dir(spark) or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage at a place every executor can reach: a lost executor costs
    no recomputation of what stands before.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, component)``, the component
    being the smallest node of it; nodes without an edge are absent.

    Alternating large-star / small-star contraction: each round re-hangs neighbours
    onto smaller nodes, in two grouped minimums and two joins on the node, and is
    written to the shared folder, so lineage stays short. It ends when every node
    hangs on one root and no root hangs on another. Grouped minimums pre-aggregate
    before the shuffle; a hub's edges are split by the skew-aware join.
    """
    cur = written(edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), label)
    while True:
        ends = cur.selectExpr("u AS node", "v AS low", "v AS high", "false AS root").union(
            cur.selectExpr("v AS node", "CAST(NULL AS BIGINT) AS low", "CAST(NULL AS BIGINT) AS high", "true AS root"))
        nodes = ends.groupBy("node").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("root").alias("root"))
        if nodes.where("low < high OR (root AND low IS NOT NULL)").isEmpty():
            return nodes.selectExpr("node", "coalesce(low, node) AS component")
        # large star: neighbours above a node hang onto its smallest neighbour (or itself)
        both = cur.union(cur.selectExpr("v AS u", "u AS v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").selectExpr("v AS u", "m AS v")
        # small star: a node and its smaller neighbours hang onto the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").selectExpr("v AS u", "m AS v").where("u <> v").union(low.selectExpr("u", "m AS v"))
        cur = written(small.distinct(), label)

"""Connected components of a graph of links, with DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadbook.runtime import discard, scratch_path


def _written(edges: DataFrame) -> tuple[DataFrame, str]:
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    edges.write.parquet(path)
    return spark.read.schema(edges.schema).parquet(path), path


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of a link; the component is its smallest node.

    Alternating star contraction: each round hangs the larger neighbours of every node on
    its smallest neighbour, then its smaller ones, until every tree is a star. The number of
    rounds is logarithmic in the size of a component and a round shuffles links, of which
    there are never more than at first. Rounds are cut by a written table. Null ends and
    links of a node to itself are left out.
    """
    spark = links.sparkSession
    u, v = F.col("u"), F.col("v")
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges, path = _written(edges.distinct())
    before = None
    while True:
        both = edges.union(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v"))
        # Every node's own smallest neighbour is kept by the star of that neighbour.
        large = large.union(least.where(F.col("m") < u).select("u", F.col("m").alias("v"))).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where(v != F.col("m"))
        small = small.select(v.alias("u"), F.col("m").alias("v"))
        fresh = small.union(smallest.select("u", F.col("m").alias("v"))).distinct()
        edges, written = _written(fresh)
        discard(spark, [path])
        path = written
        state = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before:
            break
        before = state
    roots = edges.select(v.alias("node"), v.alias("component")).distinct()
    return edges.select(u.alias("node"), v.alias("component")).union(roots)

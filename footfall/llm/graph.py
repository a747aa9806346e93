"""Connected components of links between numbers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.scratch import write_aside


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) as (node, component): the smallest node reachable, for every linked node.

    Large-star and small-star steps alternate until all links point at roots: every node points its
    larger neighbours to its smallest one, then its smaller ones.  The steps are few (they grow with the
    logarithm of the longest path), each is written to the shared folder, and only whether all
    is done comes to the driver.  A node with very many links is spread over tasks: minima are
    partial aggregates, and since those of the large step are written before they are joined,
    adaptive execution can split the node's rows.
    """
    edges = write_aside(
        links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct(), "edges")
    while not _is_star(edges):
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = write_aside(both.groupBy("x").agg(F.min("y").alias("m"))
                            .withColumn("m", F.least("x", "m")), "least")
        large = write_aside(both.join(least, "x").where("y > x")
                            .select(F.col("y").alias("x"), F.col("m").alias("y")), "large")
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        edges = write_aside(
            large.join(least, "x").where("y != m").select(F.col("y").alias("x"), F.col("m").alias("y"))
            .unionByName(least.select("x", F.col("m").alias("y"))).distinct(), "edges")
    return edges.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(
        edges.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct())


def _is_star(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour and no larger one, or only larger ones."""
    ends = edges.select("x", F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(
        edges.select(F.col("y").alias("x"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    return ends.groupBy("x").agg(F.sum("low").alias("low"), F.max("high").alias("high")).where(
        "low > 1 OR low = 1 AND high = 1").isEmpty()

"""Connected components of links as a Spark loop: each round is two joins-free aggregations
over the links (large star, then small star); no node's neighbours meet in one task's
memory, only their minimum does."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiff.session import new_run_dir


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (large) or smaller-or-equal (small) neighbours to its minimum."""
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        new = both.join(least, "a").where("b > a").select(F.col("b").alias("x"), "m")
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(least, "a")
        new = joined.select(F.col("b").alias("x"), "m").union(joined.select(F.col("a").alias("x"), "m"))
    return new.where("x != m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b long): root is the component's smallest
    node. Null ends and links of a node with itself say nothing; no links, no rows. Each
    round is written to the shared folder, so a lost executor costs no earlier round."""
    spark = links.sparkSession
    folder = new_run_dir(spark, "components")

    def kept(df: DataFrame, k: int) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{k}")
        return spark.read.parquet(f"{folder}/{k}")

    now = kept(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), 0)
    mark, k = None, 0
    while True:
        k += 1
        now = kept(_star(_star(now, True), False), k)
        # stars have converged when a round changes nothing: count and order-free digest
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

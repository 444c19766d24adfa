"""Connected components, and cutting a plan's lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.  A local session that names none (tests) gets one; on a cluster that is an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not sc.getCheckpointDir():
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return named or sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of links (a, b) of one type.

    Alternates large-star and small-star steps until the links are stars.
    Minima are pre-aggregated and joined back, so a node with very many links
    is a skewed join side that can be split, never one task's group.  Links
    with a null end or from a node to itself are ignored.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, before = cut_lineage(links), None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before or now[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        stars = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = stars.groupBy("u").agg(F.min("v").alias("m"))
        joined = stars.join(least, "u").select("u", "v", "m")
        links = joined.select("u", F.col("m").alias("v")).unionByName(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        links = cut_lineage(links)

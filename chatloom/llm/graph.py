"""Connected components of an edge table, by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.session import scratch_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again, which cuts its lineage."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (a, b): root is the smallest node that it is connected with.

    Every round keeps one edge per pair, minima are combined before the shuffle, and joins on hubs are left to Spark,
    which splits them. The graph never leaves the executors; the driver sees one fingerprint per round.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = staged(pairs, "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == tuple(mark):
            break
        seen = tuple(mark)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = staged(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()

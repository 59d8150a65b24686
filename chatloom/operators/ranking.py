"""Row numbers inside groups that may be too big for one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import scratch_dir


def running_number(
    rows: DataFrame, keys: list[str], slice_: Column, order: list[str], name: str
) -> DataFrame:
    """1-based row number per key, computed slice by slice.

    ``slice_`` must not decrease along ``order``.  Slices are numbered on their
    own, in parallel, and shifted by the row counts of the slices before them;
    only the table of slice counts is ordered per key.
    """
    sliced = rows.withColumn("_slice", slice_)  # a NULL slice or key counts like any other
    by_key = Window.partitionBy(*keys).orderBy("_slice")
    before = (
        sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(by_key) - F.col("_n")).drop("_n")
    )
    before = before.withColumnsRenamed({k: f"_b_{k}" for k in [*keys, "_slice"]})
    same = reduce(lambda a, b: a & b, [F.equal_null(F.col(k), F.col(f"_b_{k}")) for k in [*keys, "_slice"]])
    inside = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    return (
        sliced.withColumn("_inside", inside).join(before.hint("merge"), same)  # slices grow with the rows: never broadcast
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_slice", "_inside", "_before", *[f"_b_{k}" for k in [*keys, "_slice"]])
    )


def range_number(rows: DataFrame, keys: list[str], order: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """1-based row number per key where nothing tells slices: Spark samples borders of even ranges of (keys, order).

    Rows are written once in their ranges, so a group of any size is numbered in as many tasks as it fills; the
    ranges' counts per key are shifted as those of slices are. Ties are numbered in an order of their own.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "ranges")
    wanted = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ties are spread too: a range cannot be cut within equal values
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(c) for c in [*keys, *order, "_tie"]]
    spread.repartitionByRange(wanted, *by).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    return running_number(placed, keys, F.col("_range"), [*order, "_tie"], name).drop("_tie", "_range")

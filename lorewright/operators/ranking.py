"""Exact ranks within groups of any size, without a window over a whole group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorewright.session import cut


def two_level_rank(df: DataFrame, group: list[str], bucket: str, order: list[str], out: str = "rank") -> DataFrame:
    """Add the 0-based rank of each row within ``group``, ordered by (``bucket``, ``order``).

    Rows are ranked inside (group, bucket); the offset of a bucket is a running
    sum over the bucket counts alone, so a hot group is as parallel as it has buckets.
    """
    keys = [*group, bucket]
    local = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_s"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return local.join(starts, same).withColumn(out, F.col("_s") + F.col("_r")).drop("_s", "_r", bucket, *[f"_k{i}" for i in range(len(keys))])


def spread_rank(df: DataFrame, group: list[str], order: list, out: str = "rank") -> DataFrame:
    """Add the 0-based rank of each row within ``group`` in the given order; rows are first cut into ranges of the whole order.

    A group that holds most rows lies in as many ranges as its rows need. The ranges are
    materialised, so that a lost task finds its rows in the same range again.
    """
    placed = cut(df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()))
    return two_level_rank(placed, group, "_range", order, out)

"""Coverage of targets, quotas, balance and progress scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.operators.ranking import spread_rank


def coverage(counts: DataFrame) -> DataFrame:
    """Adds ``deficit`` (NULL without a target) and ``met``. counts: theory, n, target."""
    deficit = F.when(F.col("target").isNotNull(), F.greatest(F.lit(0), F.col("target") - F.col("n")))
    return counts.withColumn("deficit", deficit).withColumn("met", F.coalesce(F.col("n") >= F.col("target"), F.lit(True)))


def depth_deficits(covered: DataFrame) -> DataFrame:
    """Per depth the nodes short of their target, sorted, and their total."""
    short = covered.where("deficit > 0")
    return short.groupBy("depth").agg(
        F.count("*").alias("nodes"), F.sum("deficit").alias("deficit"), F.array_sort(F.collect_list("theory")).alias("names")
    )


def coverage_line(name: str, depth: str, n, target):
    """One line of the coverage report: the node, indented by its depth, found over wanted, and what is missing."""
    missing = F.when(target > n, F.concat(F.lit(" (short by "), (target - n).cast("string"), F.lit(")"))).otherwise("")
    return F.concat(F.repeat(F.lit("  "), F.col(depth).cast("int")), F.col(name), F.lit(": "), n.cast("string"), F.lit("/"), target.cast("string"), missing)


def log_score(counts: DataFrame) -> DataFrame:
    """Contribution log10(n) of each theory with n > 0 and its share of the total."""
    each = counts.where("n > 0").withColumn("contribution", F.log10("n"))
    parts = each.agg(F.sum("contribution").alias("total"))  # one row; no window over the whole table
    return each.crossJoin(F.broadcast(parts)).select(
        "theory", "n", "contribution", F.when(F.col("total") > 0, F.col("contribution") / F.col("total")).otherwise(0.0).alias("share")
    )


def sibling_imbalance(nodes: DataFrame) -> DataFrame:
    """Nodes whose load exceeds the median of their siblings by more than the spread allows.

    nodes: parent, theory, n, target. Load is n over target, or n without one. The
    threshold is the population deviation of all siblings, 0.3 at least, and 0.5
    at least if the median of the others is 0.
    """
    load = nodes.withColumn("load", F.when(F.col("target") > 0, F.col("n") / F.col("target")).otherwise(F.col("n").cast("double")))
    fam = load.groupBy("parent").agg(F.stddev_pop("load").alias("sd"), F.count("*").alias("k")).where("k > 1")
    ranked = spread_rank(load, ["parent"], ["load", "theory"], "at").join(fam, "parent")
    # the median of the others hangs on at most four places around the middle, whatever the size of the family
    m = F.col("k") - 1
    lo, hi = F.floor((m - 1) / 2), F.floor(m / 2)
    middle = ranked.where(F.col("at").between(lo, hi + 1)).groupBy("parent").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("at").cast("bigint"), "load"))).alias("mid")
    )
    j = ranked.join(middle, "parent")
    pick = lambda i: F.element_at("mid", F.when(i < F.col("at"), i).otherwise(i + 1))
    median = (pick(lo) + pick(hi)) / 2
    base = F.greatest(F.lit(0.3), F.col("sd"))
    return (
        j.withColumn("median", median)
        .withColumn("delta", F.col("load") - F.col("median"))
        .withColumn("threshold", F.when(F.col("median") == 0, F.greatest(F.lit(0.5), base)).otherwise(base))
        .where("delta > threshold")
        .select("parent", "theory", "load", "median", "delta", "threshold")
    )


def subtheory_quota(children: DataFrame) -> DataFrame:
    """How many children to work on at once: target over mean child target, rounded up, 1 at least and all at most."""
    agg = children.groupBy("parent", "parent_target").agg(F.count("*").alias("children"), F.avg("target").alias("mean"))
    q = F.when(F.col("parent_target").isNotNull() & (F.col("mean") > 0), F.greatest(F.lit(1), F.least(F.col("children"), F.ceil(F.col("parent_target") / F.col("mean")))))
    return agg.select("parent", "children", F.coalesce(q, F.col("children")).cast("int").alias("quota"))


def queue_positions(nodes: DataFrame) -> DataFrame:
    """Order of work under each parent: least filled first, then name."""
    fill = F.when(F.col("target") > 0, F.col("n") / F.col("target")).otherwise(F.lit(0.0))
    return spread_rank(nodes.withColumn("fill", fill), ["parent"], ["fill", "theory"], "place").withColumn("place", (F.col("place") + 1).cast("int"))

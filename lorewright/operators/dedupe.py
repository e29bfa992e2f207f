"""Distinct, merge and resume operators over harvested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorewright.operators.components import connected_components
from lorewright.operators.ranking import spread_rank


def first_per_key(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def linked_groups(keys: DataFrame) -> DataFrame:
    """``id, group``: ids that share a key, directly or through others; keys: id, k. Ids without a shared key stand alone."""
    named = keys.join(keys.groupBy("k").agg(F.min("id").alias("m")), "k")
    merged = connected_components(named.where("id <> m").select("id", "m"))
    return keys.select("id").distinct().join(merged.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("component", "id").alias("group")
    )


def merge_records(rows: DataFrame, group: str, order: str, scalars: list[str], lists: list[str]) -> DataFrame:
    """Per group the first non-blank scalar in order, and the distinct union of lists in order of appearance."""
    aggs = []
    for c in scalars:
        filled = F.trim(F.col(c)) != ""
        aggs.append(F.min_by(F.when(filled, F.col(c)), F.when(filled, F.col(order))).alias(c))
    for c in lists:
        each = F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(c, F.array().cast("array<string>")).alias("v")))
        ordered = F.flatten(F.transform(F.array_sort(each), lambda x: x["v"]))
        aggs.append(F.array_distinct(F.filter(ordered, lambda x: F.trim(x) != "")).alias(c))
    return rows.groupBy(group).agg(*aggs)


def numbered_slugs(rows: DataFrame, slug: str, order: list) -> DataFrame:
    """Repeats of a slug get the free numbers ``-2``, ``-3`` on in order; numbers that explicit slugs bear are passed over."""
    numbered = spread_rank(rows, [slug], order, "_place").withColumn("_nth", (F.col("_place") + 1).cast("int"))
    suffix = F.regexp_extract(slug, r"^(.+)-([0-9]{1,9})$", 2)
    borne = (
        rows.where(suffix != "")
        .select(F.regexp_extract(slug, r"^(.+)-([0-9]{1,9})$", 1).alias(slug), suffix.cast("int").alias("n"))
        .groupBy(slug)
        .agg(F.collect_set("n").alias("borne"))
    )
    r, borne_ = F.col("_nth"), F.coalesce("borne", F.array().cast("array<int>"))
    free = F.filter(F.sequence(F.lit(2), r + F.size(borne_) + 1), lambda x: ~F.array_contains(borne_, x))
    number = F.get(free, r - 2)
    return (
        numbered.join(borne, slug, "left")
        .withColumn("slug_id", F.when(r == 1, F.col(slug)).otherwise(F.concat_ws("-", slug, number.cast("string"))))
        .drop("_place", "_nth", "borne")
    )


def fresh(rows: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key has not been seen."""
    return rows.join(seen.select(*key).distinct(), key, "left_anti")


def merge_failures(old: DataFrame, new: DataFrame, done: DataFrame) -> DataFrame:
    """Failure log: a new failure replaces the old one of its key, keys done since are dropped. old, new: k, reason, ts."""
    both = old.withColumn("run", F.lit(0)).unionByName(new.withColumn("run", F.lit(1)))
    return (
        both.groupBy("k").agg(F.max_by(F.struct("reason", "ts"), F.struct("run", "ts")).alias("x")).select("k", "x.reason", "x.ts").join(done.select("k").distinct(), "k", "left_anti")
    )


def overlay(base: DataFrame, update: DataFrame, key: str) -> DataFrame:
    """Fields of the update where it has them, else those of the base; rows of both sides stay."""
    b, u = base.alias("b"), update.alias("u")
    cols = [c for c in base.columns if c != key]
    return b.join(u, key, "full").select(key, *[F.coalesce(F.col(f"u.{c}"), F.col(f"b.{c}")).alias(c) for c in cols])

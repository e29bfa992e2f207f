"""State of runs: retrieval, quotas, queues, expansion rounds, mentions and their merging."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prediction_scores(predictions: DataFrame, nodes: DataFrame) -> DataFrame:
    """Predictions (id, label, confidence) matched to nodes without case; the best confidence per id and node."""
    n = nodes.select("theory", F.lower(F.trim("theory")).alias("k"))
    return predictions.withColumn("k", F.lower(F.trim("label"))).join(n, "k").groupBy("id", "theory").agg(F.max("confidence").alias("score"))


def merge_scores(*parts: DataFrame) -> DataFrame:
    """Scores of several makers merged by the greatest."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("id", "theory").agg(F.max("score").alias("score"))


def new_unique(found: DataFrame, seen: DataFrame) -> DataFrame:
    """Per provider how many papers no earlier run had; found: provider, id; providers without any show 0."""
    fresh = found.dropDuplicates(["provider", "id"]).join(seen.select("id").distinct().withColumn("old", F.lit(True)), "id", "left")
    return fresh.groupBy("provider").agg(F.count_if(F.col("old").isNull()).alias("new_unique"))


def alias_union(mentions: DataFrame) -> DataFrame:
    """Aliases of a theory over text chunks, compared without case, first spelling kept; mentions: article, theory, chunk, pos, alias."""
    w = Window.partitionBy("article", "theory", F.lower("alias")).orderBy("chunk", "pos")
    first = mentions.where(F.trim("alias") != "").withColumn("r", F.row_number().over(w)).where("r = 1")
    return first.groupBy("article", "theory").agg(F.array_sort(F.collect_list(F.struct("chunk", "pos", "alias"))).alias("x")).select(
        "article", "theory", F.transform("x", lambda x: x["alias"]).alias("aliases")
    )


def group_summary(groups: DataFrame, articles: DataFrame, theories: int = 5, per_theory: int = 5) -> DataFrame:
    """Per group the distinct articles of all theories, and the first theories with their first articles."""
    j = groups.join(articles, "theory")
    count = j.groupBy("grp").agg(F.count_distinct("article").alias("articles"))
    each = j.groupBy("grp", "theory").agg(F.slice(F.array_sort(F.collect_set("article")), 1, per_theory).alias("shown"))
    w = Window.partitionBy("grp").orderBy("theory")
    first = each.withColumn("r", F.row_number().over(w)).where(F.col("r") <= theories)
    return first.join(count, "grp").select("grp", "theory", "shown", "articles")


def additive_merge(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Citations add up and review sets unite; both: theory, citations, reviews."""
    return base.unionByName(extra).groupBy("theory").agg(
        F.sum("citations").alias("citations"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("reviews")))).alias("reviews")
    )


def representative_articles(theories: DataFrame, meta: DataFrame, k: int) -> DataFrame:
    """The first k supporting articles of each theory with their title, the id alone where it is unknown."""
    first = theories.select("theory", F.posexplode(F.slice("articles", 1, k)).alias("pos", "article"))
    return first.join(meta, "article", "left").select("theory", "pos", "article", F.coalesce("title", "article").alias("title"))


def unique_theory_rows(rows: DataFrame) -> DataFrame:
    """Per theory id the row of greatest count, then name."""
    w = Window.partitionBy("theory_id").orderBy(F.desc("n"), F.lower("name"), "name")
    return rows.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def first_group_of(placed: DataFrame) -> DataFrame:
    """A theory met again in a later group is dropped; order is the traversal ordinal."""
    w = Window.partitionBy("theory_id").orderBy("ordinal")
    return placed.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def verification_summary(reviews: DataFrame) -> DataFrame:
    """Totals over reviews with their node counts: all, those with nodes, mean, least and most."""
    return reviews.agg(
        F.count("*").alias("reviews"), F.count_if(F.col("nodes") > 0).alias("with_nodes"), F.avg("nodes").alias("mean_nodes"),
        F.min("nodes").alias("min_nodes"), F.max("nodes").alias("max_nodes"),
    )


def theme_node(query_words: list[str], terms: DataFrame, taken: set[str], most: int = 10) -> tuple[str, list[str]] | None:
    """(name, keywords) of a theme: query words then terms, the first ten; a taken name gets 2 to 9, else there is none.

    Only the first ``most`` terms are brought to the driver.
    """
    words = list(query_words) + [r["term"] for r in terms.orderBy("rank").limit(most).collect()]
    words = list(dict.fromkeys(words))[:most]
    if not words:
        return None
    base = " ".join(w.title() for w in words[:3])
    for name in [base, *[f"{base} {i}" for i in range(2, 10)]]:
        if name not in taken:
            return name, words
    return None


def parents_by_name(nodes: DataFrame, wanted: DataFrame, within: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Wanted parents resolved by id or name without case, first node wins: (resolved, unresolved). nodes: id, name, ordinal; wanted: child, parent.

    ``within`` names columns of both, such as the tree, in which a name is looked for.
    """
    ids = nodes.select(*within, "id", "ordinal", F.explode(F.array(F.lower(F.trim("id")), F.lower(F.trim("name")))).alias("k"))
    first = ids.groupBy(*within, "k").agg(F.min_by("id", "ordinal").alias("parent_id"))
    j = wanted.withColumn("k", F.lower(F.trim("parent"))).join(first, [*within, "k"], "left")
    return j.where("parent_id IS NOT NULL").select(*within, "child", "parent_id"), j.where("parent_id IS NULL").select(*within, "child", "parent")


def insert_nodes(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """New nodes appended; a known name is left as it is, an unknown parent is an error. Both: name, parent."""
    # of a name given twice, the one with the smallest parent goes in
    fresh = new.join(nodes.select("name"), "name", "left_anti").groupBy("name").agg(F.min("parent").alias("parent"))
    known = nodes.select("name").unionByName(fresh.select("name")).withColumnRenamed("name", "parent").distinct().withColumn("known", F.lit(True))
    checked = fresh.join(known, "parent", "left").select(
        "name",
        F.when(F.col("parent").isNull() | F.col("known"), F.col("parent")).otherwise(F.raise_error(F.concat(F.lit("unknown parent "), "parent")).cast("string")).alias("parent"),
    )
    return nodes.select("name", "parent").unionByName(checked)


def expand_until(targets: DataFrame, counts: Callable[[int], DataFrame], rounds: int) -> list[dict]:
    """Rounds of retrieval until every target is met; ``counts(round)`` gives theory, n. Returns the progress of each round."""
    log = []
    for i in range(rounds):
        short = targets.join(counts(i), "theory", "left").where(F.coalesce("n", F.lit(0)) < F.col("target"))
        left = short.count()
        log.append({"round": i, "short": left})
        if not left:
            break
    return log


def prompt_caps(lengths: list[int], caps: tuple[int, ...] = (50, 25, 10, 5, 3, 1), budget: int = 240_000, fixed: int = 0) -> int:
    """The greatest list cap whose estimated tokens (a quarter of the characters) fit the budget, else the least."""
    for cap in caps:
        if -(-(fixed + sum(lengths[:cap])) // 4) <= budget:
            return cap
    return caps[-1]

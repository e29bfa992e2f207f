"""Classifying papers against a tree of theories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Keywords of a block; it bears on no result.
BLOCK = 2000


def keyword_scores(papers: DataFrame, id_col: str, text_col: str, keywords: DataFrame) -> DataFrame:
    """``<id>, theory, score``: matched over all keywords of each theory, where any matched.

    keywords: theory, keyword, one row per listed keyword (repeats count). Each text is
    searched once per distinct keyword, not once per theory. The texts meet the keywords as blocks of at
    most ``BLOCK`` on average, one row each, so the list never passes the driver and a text is copied per block only.
    """
    listed = keywords.select(F.lower("keyword").alias("keyword")).where("keyword IS NOT NULL").distinct()
    blocks = max(1, -(-listed.count() // BLOCK))
    words = listed.groupBy(F.pmod(F.xxhash64("keyword"), F.lit(blocks)).alias("b")).agg(F.collect_list("keyword").alias("_words")).drop("b")
    low = papers.select(F.col(id_col), F.lower(F.col(text_col)).alias("_low"))
    hits = low.crossJoin(words).select(F.col(id_col), F.explode(F.filter("_words", lambda w: F.contains(F.col("_low"), w))).alias("keyword"))
    listed = keywords.select("theory", F.lower("keyword").alias("keyword")).groupBy("theory", "keyword").agg(F.count("*").alias("times"))
    sizes = keywords.groupBy("theory").agg(F.count("*").alias("size"))
    return (
        hits.join(listed, "keyword")
        .join(sizes, "theory")
        .groupBy(id_col, "theory", "size")
        .agg(F.sum("times").alias("matched"))
        .select(id_col, "theory", (F.col("matched") / F.col("size")).alias("score"))
    )


def best_assignment(scores: DataFrame, id_col: str) -> DataFrame:
    """Per paper the theory of highest score, then greatest depth, then smallest name; scores above 0 only."""
    order = F.struct((-F.col("score")).alias("s"), (-F.col("depth")).alias("d"), "theory")
    return scores.where("score > 0").groupBy(id_col).agg(F.min_by(F.struct("theory", "score", "depth"), order).alias("b")).select(
        id_col, "b.theory", "b.score", "b.depth"
    )


def roll_up(scores: DataFrame, id_col: str, links: DataFrame, mode: str = "one_level") -> DataFrame:
    """Highest score of a node's own and of nodes below it.

    links: child, ancestor, distance. ``one_level`` passes unrolled scores to
    the direct parent only; ``full`` passes them to every ancestor.
    """
    if mode not in ("one_level", "full"):
        raise ValueError("mode must be one_level or full")
    up = links.where("distance = 1") if mode == "one_level" else links
    lifted = scores.join(up, scores["theory"] == up["child"]).select(id_col, F.col("ancestor").alias("theory"), "score")
    return scores.select(id_col, "theory", "score").unionByName(lifted).groupBy(id_col, "theory").agg(F.max("score").alias("score"))


def aggregate_theories(assigned: DataFrame, id_col: str) -> DataFrame:
    """``theory, papers, n``: sorted distinct papers per theory."""
    return assigned.groupBy("theory").agg(F.array_sort(F.collect_set(id_col)).alias("papers"), F.count_distinct(id_col).alias("n"))


def zero_filled(nodes: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts for every node, 0 where none; counts of unknown nodes are dropped."""
    return nodes.join(counts, "theory", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def top_papers(scores: DataFrame, id_col: str, k: int) -> DataFrame:
    """The k best papers per theory, ties by id."""
    w = Window.partitionBy("theory").orderBy(F.desc("score"), id_col)
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

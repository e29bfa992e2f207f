"""Mixing sources to target weights by systematic sampling.

A source with weight w and S tokens is due e = min(max_repeats, w*T/S) copies of
each of its documents, T being the tokens of all documents of listed sources.
Within a source the expected copies are summed up in order of length, one random
offset is added, and a document is emitted once per integer boundary crossed.
The order by length makes the token share close to its target, not only the count.

Defined results: source names match apart from case and outer blanks; documents
of unlisted, blank or null sources take no part; a listed source without
documents contributes 0 tokens and falls short when its weight is positive; null
weights count as 0, null caps as 1; repeated target rows count once (largest weight).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.functions.text import strip
from lorewright.operators.ranking import two_level_rank
from lorewright.llm.tokens import TOKENIZER_DIR, token_count
from lorewright.session import cut, spread_scan


def _key(c):
    return F.lower(strip(c))


def source_sizes(docs: DataFrame, targets: DataFrame, tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """Documents of listed sources: ``doc_id, k, tokens``, materialised."""
    listed = targets.select(_key("source").alias("k")).where("k != ''").distinct()
    return cut(
        spread_scan(docs.select("doc_id", _key("source").alias("k"), "text"))
        .join(listed, "k", "left_semi")
        .select("doc_id", "k", token_count(F.col("text"), tokenizer_dir).alias("tokens"))
    )


def expectations(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per listed source: ``source, k, weight, max_repeats, own_docs, tokens, target_tokens, expected``."""
    want = (
        targets.where(strip("source") != "")
        .groupBy(_key("source").alias("k"))
        .agg(
            F.min("source").alias("source"),
            F.coalesce(F.max("weight"), F.lit(0.0)).alias("weight"),
            F.coalesce(F.max("max_repeats"), F.lit(1)).alias("max_repeats"),
        )
    )
    have = sizes.groupBy("k").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("own_docs"))
    total = have.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"))
    return (
        want.join(have, "k", "left")
        .crossJoin(F.broadcast(total))  # one row
        .na.fill(0, ["tokens", "own_docs"])
        .withColumn("target_tokens", F.col("weight") * F.col("total"))
        .withColumn(
            "expected",
            F.when(F.col("tokens") > 0, F.least(F.col("max_repeats").cast("double"), F.col("target_tokens") / F.col("tokens")))
            .otherwise(0.0),
        )
    )


def draws(sizes: DataFrame, plan: DataFrame, seed: int = 7) -> DataFrame:
    """Documents drawn and how often: ``doc_id, k, source, tokens, n``."""
    # ranges of the global order are the first level of the ranks, so a hot source has as many as its rows need
    placed = cut(sizes.repartitionByRange("k", "tokens", "doc_id").withColumn("_b", F.spark_partition_id()))
    ranked = two_level_rank(placed, ["k"], "_b", ["tokens", "doc_id"])
    offset = F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    upto = lambda r: F.floor(offset + F.col("expected") * r)
    return (
        ranked.join(plan.select("k", "source", "expected"), "k")
        .withColumn("n", (upto(F.col("rank") + 1) - upto(F.col("rank"))).cast("int"))
        .where("n > 0")
        .select("doc_id", "k", "source", "tokens", "n")
    )


def copies(drawn: DataFrame) -> DataFrame:
    """Emitted copies, one row each: ``doc_id, source, tokens, copy``."""
    return drawn.select("doc_id", "source", "tokens", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))


def report(plan: DataFrame, drawn: DataFrame) -> DataFrame:
    """Per listed source: target and reached shares.

    A source is short if every document of it was drawn ``max_repeats`` times and the tokens drawn
    still miss the target, or if it has a target and nothing to draw from.
    """
    used = drawn.groupBy("k").agg(
        F.sum(F.col("tokens").cast("bigint") * F.col("n")).alias("used_tokens"), F.max("n").alias("most_copies"),
        F.sum("n").alias("copies"), F.count("*").alias("docs"),
    )
    whole = used.agg(F.sum("used_tokens").alias("all_tokens"))
    spent = F.col("copies") >= F.col("own_docs") * F.col("max_repeats")
    return (
        plan.join(used, "k", "left")
        .crossJoin(F.broadcast(whole))  # one row
        .na.fill(0, ["used_tokens", "docs", "most_copies", "copies"])
        .select(
            "source", "weight", "max_repeats", F.col("tokens").alias("own_tokens"), "target_tokens", "used_tokens", "docs", "most_copies",
            F.coalesce(F.col("used_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("share"),
            (spent & (F.col("used_tokens") < F.col("target_tokens"))).alias("short"),
        )
    )

"""Relevance filters over papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains_all(hay: Column, query: str) -> Column:
    """Every blank-separated term of the query occurs in the text; an empty query matches all."""
    low = F.lower(hay)
    out = F.lit(True)
    for term in query.lower().split():
        out = out & low.contains(term)
    return out


def relevance_score(title: Column, abstract: Column, body: Column, keywords: list[str]) -> Column:
    """0.5, 0.3 and 0.2 for the shares of keywords in title, abstract and body alone, 0.1 for coverage; at most 1."""
    kw = sorted({k.lower() for k in keywords if k and k.strip()})
    if not kw:
        return F.lit(1.0)
    hit = lambda c: F.filter(F.array(*[F.lit(k) for k in kw]), lambda k: F.contains(F.lower(F.coalesce(c, F.lit(""))), k))
    t, a, b = hit(title), hit(abstract), hit(body)
    only = F.array_except(F.array_except(b, t), a)
    every = F.array_union(F.array_union(t, a), b)
    k = float(len(kw))
    score = (F.size(t) * 0.5 + F.size(a) * 0.3 + F.size(only) * 0.2) / k + F.size(every) / k * 0.1
    return F.least(F.lit(1.0), score)


def blend(heuristic: Column, model: Column, weight: float) -> Column:
    """Model score mixed in by a weight clamped to 0..1; without a model score the heuristic stands."""
    w = min(1.0, max(0.0, weight))
    return F.coalesce(heuristic * (1 - w) + model * w, heuristic)


def decide(scored: DataFrame, decisions: DataFrame, threshold: float) -> DataFrame:
    """Accept by threshold. A stored decision is reused; it is judged anew if it was made at another threshold."""
    d = decisions.select("identifier", F.col("score").alias("old_score"), F.col("accepted").alias("old"), F.col("threshold").alias("old_threshold"))
    j = scored.join(d, "identifier", "left")
    use = F.coalesce("old_score", "score")
    return j.select(
        *scored.columns,
        F.when(F.col("old_threshold") == threshold, F.col("old")).otherwise(use >= threshold).alias("accepted"),
        F.col("old_score").isNotNull().alias("reused"),
    )


def last_rejection(keys: DataFrame, registry: DataFrame) -> DataFrame:
    """First key in order that has a decision; the latest decision of that key. keys: identifier, pos, k; registry: k, node, score, ts."""
    latest = registry.groupBy("k").agg(F.max_by(F.struct("node", "score", "ts"), F.struct("ts", "node")).alias("d"))
    return keys.join(latest, "k").groupBy("identifier").agg(F.min_by(F.struct("k", "d"), "pos").alias("x")).select(
        "identifier", "x.k", "x.d.node", "x.d.score", "x.d.ts"
    )

"""Query expansion and term statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[a-z0-9]{2,}"


def words(text):
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def term_frequency(docs: DataFrame, group: str, id_col: str, text: str, k: int) -> DataFrame:
    """The k most frequent terms per group; ties go to the term that appears first (by id, then place)."""
    each = docs.select(group, id_col, F.posexplode(words(F.col(text))).alias("pos", "term"))
    counts = each.groupBy(group, "term").agg(F.count("*").alias("n"), F.min(F.struct(id_col, "pos")).alias("first"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), "first")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(group, "term", "n", "rank")


#: Usual English stop words.
ENGLISH = """a about above after again all also am an and any are as at be because been before being below between both but by can could did do does doing
down during each few for from further had has have having he her here hers him his how i if in into is it its itself just me more most my no nor not of off on
once only or other our out over own same she should so some such than that the their them then there these they this those through to too under until up very
was we were what when where which while who whom why will with would you your""".split()


def ngrams(ws, longest: int):
    """All runs of one to ``longest`` neighbouring words."""
    none = F.array().cast("array<string>")

    def runs(n: int):
        starts = F.sequence(F.lit(1), F.greatest(F.size(ws) - n + 1, F.lit(1)))
        return F.when(F.size(ws) >= n, F.transform(starts, lambda i: F.array_join(F.slice(ws, i, n), " "))).otherwise(none)

    return F.concat(ws, *[runs(n) for n in range(2, longest + 1)])


def tfidf_terms(docs: DataFrame, group: str, id_col: str, text: str, stop: list[str], k: int, longest: int = 1) -> DataFrame:
    """Terms by the sum of their length-normalised tf-idf weights within a group; idf is ln((1+n)/(1+df)) + 1 within the group.

    Terms are runs of up to ``longest`` words, made after the stop words are out.
    """
    kept = docs.select(group, id_col, F.filter(words(F.col(text)), lambda w: ~w.isin(*stop)).alias("_ws"))
    base = kept.select(group, id_col, F.explode(ngrams(F.col("_ws"), longest)).alias("term"))
    tf = base.groupBy(group, id_col, "term").agg(F.count("*").alias("tf"))
    n = tf.groupBy(group).agg(F.count_distinct(id_col).alias("n"))
    df = tf.groupBy(group, "term").agg(F.count("*").alias("df"))
    weighted = tf.join(df, [group, "term"]).join(n, group).withColumn("w", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    norm = weighted.groupBy(group, id_col).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    total = weighted.join(norm, [group, id_col]).groupBy(group, "term").agg(F.round(F.sum(F.col("w") / F.col("norm")), 6).alias("weight"))
    w = Window.partitionBy(group).orderBy(F.desc("weight"), "term")
    return total.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def query_performance(events: DataFrame) -> DataFrame:
    """Per node and query: attempts, successes, new papers in all. events: node, query, new_unique."""
    return events.groupBy("node", "query").agg(
        F.count("*").alias("attempts"), F.count_if(F.col("new_unique") > 0).alias("successes"), F.sum(F.greatest("new_unique", F.lit(0))).alias("new_total")
    )


def consistent_queries(performance: DataFrame, successes: int = 2, new_total: int = 3, rate: float = 0.6) -> DataFrame:
    """Queries good enough to be kept."""
    return performance.where(
        (F.col("successes") >= successes) & (F.col("new_total") >= new_total) & (F.col("successes") / F.col("attempts") >= rate)
    )

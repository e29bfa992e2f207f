"""Metrics and validation of answer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_answers(answers: DataFrame) -> DataFrame:
    """Per paper and question the answer of highest confidence; the earliest wins ties."""
    order = F.struct((-F.coalesce("confidence", F.lit(-1.0))).alias("c"), "ordinal")
    return answers.groupBy("paper_id", "question_id").agg(F.min_by(F.struct("answer", "confidence"), order).alias("b")).select(
        "paper_id", "question_id", "b.answer", "b.confidence"
    )


def wide_answers(best: DataFrame, questions: list[str], with_confidence: bool = True) -> DataFrame:
    """One row per paper with a column per question, blank where unanswered."""
    aggs = [F.max(F.when(F.col("question_id") == q, F.col("answer"))).alias(q) for q in questions]
    if with_confidence:
        aggs += [F.max(F.when(F.col("question_id") == q, F.col("confidence"))).alias(f"{q}_confidence") for q in questions]
    return best.where(F.col("question_id").isin(*questions)).groupBy("paper_id").agg(*aggs).na.fill("", subset=questions)


def question_metrics(answers: DataFrame) -> DataFrame:
    """Per question: answered, blanks, answers that begin with yes, mean and least confidence."""
    blank = F.coalesce(F.trim("answer"), F.lit("")) == ""
    return answers.groupBy("question_id").agg(
        F.count_if(~blank).alias("answered"),
        F.count_if(blank).alias("blanks"),
        F.count_if(F.lower(F.ltrim("answer")).startswith("yes")).alias("yes_count"),
        F.avg("confidence").alias("avg_confidence"),
        F.min("confidence").alias("min_confidence"),
    )


def alerts(metrics: DataFrame, threshold: float) -> DataFrame:
    """``question_id, alert`` rows: low mean confidence, else low least confidence; blanks; no responses."""
    low = F.when(F.col("avg_confidence") < threshold, "low_average").when(F.col("min_confidence") < threshold, "low_minimum")
    found = F.array_compact(
        F.array(low, F.when(F.col("blanks") > 0, F.lit("blanks")), F.when(F.col("answered") == 0, F.lit("no_responses")))
    )
    return metrics.select("question_id", F.explode(found).alias("alert"))


def validation_rows(truth: DataFrame, answers: DataFrame) -> DataFrame:
    """``theory, paper_id, question_id, expected, found, status``; status ok, mismatch or missing.

    With a theory the pair must agree; without one the first row of the paper
    (smallest theory) stands in and the count moves to that row's theory.
    """
    a = answers.select("theory", "paper_id", "question_id", F.col("answer").alias("found"))
    named = truth.where("theory IS NOT NULL").join(a, ["theory", "paper_id", "question_id"], "left")
    first = answers.groupBy("paper_id").agg(F.min("theory").alias("theory"))
    loose = truth.where("theory IS NULL").drop("theory").join(first, "paper_id", "left").join(a, ["theory", "paper_id", "question_id"], "left")
    cols = ["theory", "paper_id", "question_id", "expected", "found"]
    status = F.when(F.col("found").isNull(), "missing").when(F.col("found") == F.col("expected"), "ok").otherwise("mismatch")
    return named.select(*cols).unionByName(loose.select(*cols)).withColumn("status", status)


def validation_metrics(rows: DataFrame) -> DataFrame:
    """Per theory and overall (NULL): expected, found, correct, recall, accuracy; one pass."""
    r = rows.rollup("theory").agg(
        F.grouping("theory").alias("overall"),
        F.count("*").alias("expected"), F.count_if(F.col("status") != "missing").alias("found"),
        F.count_if(F.col("status") == "ok").alias("correct"),
    )
    part = lambda x, y: F.when(F.col(y) > 0, F.col(x) / F.col(y)).otherwise(0.0)
    return r.withColumn("recall", part("found", "expected")).withColumn("accuracy", part("correct", "found"))

"""Queries of problem 7: defective question and answer pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.llm import pairs
from lorewright.session import table


def p7_found(spark, sf):
    return pairs.pair_defects(table(spark, sf, "question_answers"))


def p7_counts(spark, sf):
    return p7_found(spark, sf).groupBy("defect").agg(F.count("*").alias("answers"))


QUERIES = {"p7_found": p7_found, "p7_counts": p7_counts}
SQL: dict = {}

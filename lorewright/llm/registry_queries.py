"""Queries of problem 5: free values mapped to the registry of theories."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.llm import registry
from lorewright.session import table


def p5_mapped(spark, sf):
    names = registry.reference_names(table(spark, sf, "aging_ontology"))
    return registry.map_values(table(spark, sf, "theory_mentions"), "mention_id", "label", names)


def p5_found(spark, sf):
    return p5_mapped(spark, sf).select("mention_id", F.col("match").alias("theory_id"))


def p5_unmatched(spark, sf):
    """Labels that mean no listed theory, with how often they were typed."""
    m = table(spark, sf, "theory_mentions").select("mention_id", "label").distinct()
    lost = p5_mapped(spark, sf).where("match = ''").select("mention_id")
    return m.join(lost, "mention_id").groupBy("label").agg(F.count("*").alias("mentions"))


QUERIES = {"p5_found": p5_found, "p5_mapped": p5_mapped, "p5_unmatched": p5_unmatched}
SQL: dict = {}

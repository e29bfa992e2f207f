"""Queries of problem 10: spam pages among the documents."""

from __future__ import annotations

from lorewright.llm import spam
from lorewright.session import table


def p10_scores(spark, sf):
    return spam.spam_scores(table(spark, sf, "documents"))


def p10_found(spark, sf):
    return p10_scores(spark, sf).where("spam").select("doc_id")


QUERIES = {"p10_found": p10_found, "p10_scores": p10_scores}
SQL: dict = {}

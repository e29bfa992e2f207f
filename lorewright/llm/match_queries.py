"""Queries of problem 4: records of one article without a common identifier."""

from __future__ import annotations

from lorewright.llm import matching
from lorewright.session import table


def _matched(spark, sf):
    return matching.match(
        table(spark, sf, "pubmed_records"), table(spark, sf, "openalex_records"), table(spark, sf, "papers")
    )


def p4_found(spark, sf):
    rows, article, _ = _matched(spark, sf)
    return matching.untied_pairs(rows, article)


def p4_matches(spark, sf):
    """Accepted pairs of entities with their confidence."""
    return _matched(spark, sf)[2]


QUERIES = {"p4_found": p4_found, "p4_matches": p4_matches}
SQL: dict = {}

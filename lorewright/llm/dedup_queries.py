"""Queries of problem 2: the best record of each group of harvested rows."""

from __future__ import annotations

from lorewright.llm import survivor
from lorewright.session import table

_COLUMNS = ["rec_id", "pmid", "doi", "title", "abstract", "authors", "sources", "harvested_at"]


def _rows(spark, sf):
    return table(spark, sf, "pubmed_records").select(*_COLUMNS).unionByName(
        table(spark, sf, "openalex_records").select(*_COLUMNS)
    )


def p2_found(spark, sf):
    return survivor.survivors(_rows(spark, sf), table(spark, sf, "source_trust"))


def p2_records(spark, sf):
    return survivor.best_records(_rows(spark, sf), table(spark, sf, "source_trust"))


def p2_reliability(spark, sf):
    return survivor.discover(survivor.grouped_claims(_rows(spark, sf), table(spark, sf, "source_trust")))[1]


QUERIES = {"p2_found": p2_found, "p2_records": p2_records, "p2_reliability": p2_reliability}
SQL: dict = {}

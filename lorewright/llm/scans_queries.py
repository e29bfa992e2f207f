"""Queries of problem 3: repair of text from scanned pages."""

from __future__ import annotations

from lorewright.llm import scans
from lorewright.session import table


def p3_found(spark, sf):
    return scans.findings(table(spark, sf, "papers"))


def p3_misread(spark, sf):
    return scans.analyse(table(spark, sf, "papers"))[2]


def p3_repaired(spark, sf):
    return scans.repair(table(spark, sf, "papers"))


QUERIES = {"p3_found": p3_found, "p3_repaired": p3_repaired, "p3_misread": p3_misread}
SQL: dict = {}

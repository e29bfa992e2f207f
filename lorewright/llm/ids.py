"""Identifiers as harvested, brought to one spelling or to NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lorewright.functions.text import strip


def usable_doi(c: Column | str) -> Column:
    """Lower-case prefix/suffix, without label and resolver; NULL if either part is missing."""
    d = F.lower(strip(c))
    d = F.regexp_replace(d, r"^doi\s*:?\s*", "")
    d = F.regexp_replace(d, r"^https?://([a-z0-9-]+\.)*example\.org/+", "")
    d = F.regexp_replace(d, r"^doi\s*:?\s*", "")
    return F.when(d.rlike(r"^10\.[0-9]{4,9}(\.[0-9]+)*/\S+$"), d)


def usable_pmid(c: Column | str) -> Column:
    """The eight digits, or NULL."""
    p = F.lower(strip(c))
    p = F.regexp_extract(p, r"^(?:pmid|pubmed)?\s*(?:id)?\s*[:#]?\s*([45][0-9]{7})(?:\.0+)?$", 1)
    return F.when(p != "", p)

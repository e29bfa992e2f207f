"""Identifiers and match keys of bibliographic records."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lorewright.functions.text import trimmed


def doi_norm(c: Column | str) -> Column:
    """Lower case without one leading resolver or label; blank is NULL."""
    t = F.lower(trimmed(c))
    return F.nullif(trimmed(F.regexp_replace(t, r"^(https?://doi\.org/|https://dx\.doi\.org/|doi:)", "")), F.lit(""))


def openalex_norm(c: Column | str) -> Column:
    """The W-number of an id, a prefixed id or an address; NULL without one."""
    return F.nullif(F.upper(F.regexp_extract(trimmed(c), r"(?i)(?:^|openalex:|/)(w[0-9]+)/?$", 1)), F.lit(""))


@F.pandas_udf(StringType())
def _canonical(s: pd.Series) -> pd.Series:
    import re

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        t = "".join(ch for ch in unicodedata.normalize("NFKD", x) if not unicodedata.combining(ch)).casefold()
        return " ".join(w for w in re.split(r"\W+", t) if w)

    return s.map(one, na_action="ignore")


def canonical_words(c: Column) -> Column:
    """Folded words joined by blanks; plain ASCII stays JVM-side, other text goes through Unicode folding."""
    ascii_ = trimmed(F.regexp_replace(F.lower(c), r"[^a-z0-9_]+", " "))
    return F.when(~c.rlike(r"[^\x00-\x7F]"), ascii_).otherwise(_canonical(c))


def canonical_key(doi: Column, title: Column, authors: Column) -> Column:
    """The DOI in lower case, else title words and sorted author words; NULL when the title has none."""
    t = canonical_words(title)
    names = canonical_words(F.array_join(F.coalesce(authors, F.array().cast("array<string>")), " "))
    sorted_names = F.array_join(F.array_sort(F.split(names, " ")), "-")
    by_text = F.concat(
        F.lit("title:"), F.replace(t, F.lit(" "), F.lit("-")), F.when(F.coalesce(names, F.lit("")) != "", F.concat(F.lit("|authors:"), sorted_names)).otherwise("")
    )
    return F.coalesce(F.lower(F.nullif(trimmed(doi), F.lit(""))), F.when(t != "", by_text))


def dedupe_key(doi: Column, identifier: Column) -> Column:
    return F.lower(F.coalesce(F.nullif(trimmed(doi), F.lit("")), identifier))


def stable_keys(pmid: Column, doi: Column, openalex: Column) -> Column:
    """``doi:``, ``pmid:`` and ``openalex:`` keys that are present, in that order."""
    lead = lambda p, c: F.concat(F.lit(p), F.nullif(F.lower(trimmed(c)), F.lit("")))
    return F.array_compact(F.array(F.concat(F.lit("doi:"), doi_norm(doi)), lead("pmid:", pmid), lead("openalex:", openalex)))


def extended_keys(pmid: Column, doi: Column, openalex: Column, urls: Column) -> Column:
    """Also the identifiers found by shape in free addresses; a DOI needs a slash, an OpenAlex id its number."""
    real = F.when(doi_norm(doi).contains("/"), F.concat(F.lit("doi:"), doi_norm(doi)))
    found = F.transform(
        F.coalesce(urls, F.array().cast("array<string>")),
        lambda u: F.coalesce(
            F.concat(F.lit("openalex:"), openalex_norm(u)),
            F.concat(F.lit("doi:"), F.nullif(F.regexp_extract(F.lower(u), r"(10\.[0-9]{4,9}/\S+)$", 1), F.lit(""))),
        ),
    )
    own = F.array(real, F.concat(F.lit("pmid:"), F.nullif(F.regexp_extract(trimmed(pmid), r"^([0-9]+)$", 1), F.lit(""))), F.concat(F.lit("openalex:"), openalex_norm(openalex)))
    return F.array_distinct(F.array_compact(F.concat(own, found)))


def decision_keys(pmid: Column, doi: Column, openalex: Column, title: Column, year: Column, abstract: Column) -> Column:
    """Cache keys in order of preference; the abstract's start counts only if nothing else is there."""
    t = F.nullif(F.lower(trimmed(title)), F.lit(""))
    y = F.nullif(trimmed(year), F.lit(""))
    first = F.concat(
        stable_keys(pmid, doi, openalex),
        F.array_compact(F.array(F.when(y.isNotNull(), F.concat(F.lit("title:"), t, F.lit("|year:"), y)), F.concat(F.lit("title:"), t))),
    )
    last = F.array_compact(F.array(F.concat(F.lit("abstract:"), F.nullif(F.lower(F.left(trimmed(abstract), F.lit(200))), F.lit("")))))
    return F.when(F.size(first) > 0, first).otherwise(last)

"""Text normalisation expressions; all run JVM-side, but for entities beyond the usual few."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, non-breaking blanks included.
BLANKS = r"[\s   -​    　﻿]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(c: Column | str) -> Column:
    """Collapse runs of white space to one blank and cut the ends."""
    return F.trim(F.regexp_replace(_col(c), BLANKS, " "))


def strip(c: Column | str) -> Column:
    """Cut Unicode white space off both ends, keeping the inside."""
    return F.regexp_replace(_col(c), f"^{BLANKS}|{BLANKS}$", "")


def blank_to_null(c: Column | str) -> Column:
    """NULL for values that hold nothing but white space; others unchanged."""
    return F.when(strip(c) != "", _col(c))


def fold(c: Column | str) -> Column:
    """Lower case with white space squeezed; NULL stays NULL."""
    return F.lower(squeeze(c))


def trimmed(c: Column | str) -> Column:
    """Cut ASCII white space, line ends included, off both ends."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def analysis_text(full_text="full_text", sections="sections", abstract="abstract") -> Column:
    """The full text if it is not blank, else its sections joined by blank lines, else the abstract."""
    part = lambda s: F.array_join(
        F.filter(F.array(trimmed(F.coalesce(s["title"], F.lit(""))), trimmed(F.coalesce(s["text"], F.lit("")))), lambda x: x != ""),
        "\n",
    )
    joined = F.array_join(F.filter(F.transform(sections, part), lambda x: x != ""), "\n\n")
    return F.coalesce(
        F.when(trimmed(full_text) != "", _col(full_text)), F.when(joined != "", joined), F.coalesce(_col(abstract), F.lit(""))
    )


def sentences(c: Column | str) -> Column:
    """Naive split on full stops; line ends count as blanks, blank pieces are dropped."""
    parts = F.split(F.replace(_col(c), F.lit("\n"), F.lit(" ")), r"\.")
    return F.filter(F.transform(parts, trimmed), lambda x: x != "")


def slug(c: Column | str, default: str = "theory") -> Column:
    """Lower case with runs of other characters than a-z and 0-9 as one hyphen; default when nothing is left."""
    s = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(s, "^-+|-+$", ""), F.lit("")), F.lit(default))


def slug_per_char(c: Column | str, default: str = "theory") -> Column:
    """As ``slug`` but every other character gives its own hyphen."""
    s = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]", "-")
    return F.coalesce(F.nullif(F.regexp_replace(s, "^-+|-+$", ""), F.lit("")), F.lit(default))


def unescape(c: Column) -> Column:
    """Entities, named and numeric, as characters; only texts that hold a rarer one than the usual few leave the engine."""

    @F.pandas_udf("string")
    def slow(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else html.unescape(x).replace("\xa0", " "))

    t = c
    for entity, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " ")):
        t = F.replace(t, F.lit(entity), F.lit(ch))
    plain = F.replace(t, F.lit("&amp;"), F.lit("&"))
    rare = F.replace(c, F.lit("&amp;"), F.lit("")).rlike(r"&(?!(?:lt|gt|quot|nbsp|#39);)(?:[A-Za-z][A-Za-z0-9]{1,31}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});")
    return F.when(rare, slow(F.when(rare, c))).otherwise(plain)


def strip_html(c: Column | str, strip_scripts: bool = True, limit: int | None = None) -> Column:
    """Text of mark-up: breaks become line ends, tags blanks, entities characters; cut at ``limit`` characters only if one is given."""
    t = _col(c)
    if strip_scripts:
        t = F.regexp_replace(t, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</p>", "\n")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    t = trimmed(F.regexp_replace(unescape(t), r"[ \t]+", " "))
    return t if limit is None else F.left(t, F.lit(limit))


def tidy_lines(c: Column | str) -> Column:
    """White space of full texts: carriage returns and blanks at line ends go, at most one empty line stays."""
    t = F.regexp_replace(_col(c), r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.regexp_replace(t, r" ?\n ?", "\n")
    return trimmed(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def clean_label(c: Column | str) -> Column:
    """Blanks squeezed; blanks and marks ``- : , . ;`` cut off the end."""
    return F.regexp_replace(F.regexp_replace(_col(c), r"\s+", " "), r"[ \-:,.;]+$", "")


def snippet(title: Column | str, abstract: Column | str, limit: int = 400) -> Column:
    """``title - abstract``, cut to the limit with three dots."""
    s = F.concat_ws(" - ", F.nullif(trimmed(title), F.lit("")), F.nullif(trimmed(abstract), F.lit("")))
    return F.when(F.length(s) > limit, F.concat(F.left(s, F.lit(limit - 3)), F.lit("..."))).otherwise(s)


def theme_tokens(c: Column | str, stop: list[str]) -> Column:
    """Words of three letters or more, lower case, hyphens and blanks trimmed, stop words out."""
    words = F.regexp_extract_all(_col(c), F.lit(r"[A-Za-z][A-Za-z\-]{2,}"), F.lit(0))
    low = F.transform(words, lambda w: F.regexp_replace(F.lower(w), r"^[- ]+|[- ]+$", ""))
    return F.filter(low, lambda w: ~w.isin(*stop) if stop else F.lit(True))


def query_keywords(c: Column | str) -> Column:
    """Keywords of a query without quotes: operators and delimiters out, lower case, first of each kept."""
    t = F.regexp_replace(_col(c), r"[()\[\]{},;:|\"']+", " ")
    words = F.filter(F.split(t, r"\s+"), lambda w: (w != "") & ~F.upper(w).isin("AND", "OR", "NOT"))
    low = F.transform(words, lambda w: F.lower(F.regexp_replace(w, r"^[^A-Za-z0-9\-]+|[^A-Za-z0-9\-]+$", "")))
    return F.array_distinct(F.filter(low, lambda w: w != ""))


def query_variants(c: Column | str) -> Column:
    """The term, the term quoted if it has blanks, and with ``aging`` and ``theory`` where it lacks them."""
    t = trimmed(c)
    low = F.lower(t)
    has_age = low.contains("aging") | low.contains("ageing")
    return F.array_compact(
        F.array(
            t,
            F.when(t.contains(" "), F.concat(F.lit('"'), t, F.lit('"'))),
            F.when(~has_age, F.concat(t, F.lit(" aging"))),
            F.when(~low.contains("theory"), F.concat(t, F.lit(" theory"))),
        )
    )


def lexical_signature(c: Column | str) -> Column:
    """Struct of the words joined, and of the words sorted and joined."""
    words = F.filter(F.split(F.lower(_col(c)), "[^a-z0-9]+"), lambda w: w != "")
    return F.struct(F.array_join(words, " ").alias("plain"), F.array_join(F.array_sort(words), " ").alias("ordered"))


def token_estimate(c: Column | str) -> Column:
    """A quarter of the characters, rounded up."""
    return F.ceil(F.length(_col(c)) / 4).cast("int")


def merge_strings(*lists: Column) -> Column:
    """Distinct non-blank strings of the lists in order, compared without case, first spelling kept."""
    every = F.filter(F.transform(F.flatten(F.array(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists])), trimmed), lambda x: x.isNotNull() & (x != ""))
    return F.aggregate(
        every,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.concat(acc, F.array(x))),
    )


def review_like(flag: Column, *texts: Column) -> Column:
    """The flag where it is set, else whether any text speaks of a review or meta-analysis."""
    joined = F.concat_ws(" ", *texts)
    return F.coalesce(flag, joined.rlike(r"(?i)\b(review|systematic review|meta-?analysis)\b"))


def year_of(c: Column | str) -> Column:
    """The first four characters as a year, else the first 19xx or 20xx in the text, else NULL."""
    t = trimmed(c)
    head = F.regexp_extract(t, r"^([0-9]{4})", 1)
    any_ = F.regexp_extract(t, r"((?:19|20)[0-9]{2})", 1)
    return F.coalesce(F.nullif(head, F.lit("")), F.nullif(any_, F.lit(""))).cast("int")


def split_authors(c: Column | str) -> Column:
    """Split on ``;``, else on ``|``, else on ``,``; trimmed, blanks dropped."""
    t = _col(c)
    parts = F.when(t.contains(";"), F.split(t, ";")).when(t.contains("|"), F.split(t, r"\|")).otherwise(F.split(t, ","))
    return F.filter(F.transform(parts, trimmed), lambda x: x != "")


def as_flag(c: Column | str) -> Column:
    """true, 1, yes, y, on and their opposites; anything else is NULL."""
    t = F.lower(trimmed(c))
    return F.when(t.isin("true", "1", "yes", "y", "on"), True).when(t.isin("false", "0", "no", "n", "off"), False)


def confidence_of(c: Column | str) -> Column:
    """A share from 0 to 1; a percent sign goes, values above 1.5 count as per cent, no number is NULL."""
    v = F.expr(f"try_cast(regexp_replace(trim(cast({c} as string)), '%$', '') as double)") if isinstance(c, str) else c
    v = F.when(F.isnan(v), None).otherwise(v)
    share = F.when(v > 1.5, v / 100).otherwise(v)
    return F.when(v.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))


def decode_inverted(c: Column) -> Column:
    """Text of a map word -> positions."""
    pairs = F.flatten(
        F.transform(F.map_entries(c), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w"))))
    )
    return F.array_join(F.transform(F.array_sort(pairs), lambda x: x["w"]), " ")

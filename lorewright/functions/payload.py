"""Expressions over prompts, replies and configurations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorewright.functions.text import trimmed


def citation_count(override: Column, own: Column, *texts: Column) -> Column:
    """Override, else the stored count, else the first ``citations: n`` in the texts in order, else 0."""
    found = [F.nullif(F.regexp_extract(t, r"(?i)citations?\s*[:=]\s*([0-9]{1,9})", 1), F.lit("")).cast("int") for t in texts]
    return F.coalesce(override, own, *found, F.lit(0))


def confidence_text(c: Column) -> Column:
    """Three decimals without trailing zeros and point; halves go to the even digit, as in ``%.3f``."""
    t = F.bround(c.cast("decimal(20,12)"), 3).cast("string")
    return F.regexp_replace(F.regexp_replace(t, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """``{name}`` replaced by its value; names without one become empty. Values are not looked into."""
    name = r"\{[A-Za-z_]+\}"

    def value(n: Column) -> Column:
        out = F.lit("")
        for k, v in values.items():
            out = F.when(n == "{" + k + "}", F.coalesce(v.cast("string"), F.lit(""))).otherwise(out)
        return out

    gaps, names = F.split(template, name, -1), F.regexp_extract_all(template, F.lit(name), F.lit(0))
    # one gap more than names
    pieces = F.zip_with(gaps, names, lambda g, n: F.concat(g, F.when(n.isNull(), "").otherwise(value(n))))
    return F.array_join(pieces, "")


def excerpt(text: Column, limit: int = 4000) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("..."))).otherwise(text)


def keyword_line(c: Column, most: int = 5) -> Column:
    """The first few distinct words of a list, compared without case."""
    first = F.aggregate(
        c, F.array().cast("array<string>"),
        lambda acc, x: F.when((trimmed(x) == "") | x.isNull() | F.exists(acc, lambda y: F.lower(y) == F.lower(trimmed(x))), acc).otherwise(F.concat(acc, F.array(trimmed(x)))),
    )
    return F.array_join(F.slice(first, 1, most), ", ")


def evidence_sentences(found: Column, sentences: Column, keywords: list[str], most: int) -> Column:
    """The given evidence, then sentences with a keyword, else the first ones; distinct, the first ``most``."""
    hit = F.lit(False)
    with_kw = F.filter(sentences, lambda s: _any(F.lower(s), keywords, hit))
    chosen = F.when(F.size(with_kw) > 0, with_kw).otherwise(sentences)
    return F.slice(F.array_distinct(F.concat(F.array_compact(F.array(found)), chosen)), 1, most)


def _any(s: Column, keywords: list[str], start: Column) -> Column:
    for k in keywords:
        start = start | F.contains(s, F.lit(k.lower()))
    return start


def flatten_ontology(config: dict | list, parent: str | None = None, depth: int = 0) -> list[tuple]:
    """(name, parent, target, depth, ordinal, keywords) rows of a nested configuration.

    Nodes are a mapping of names or a list of mappings with ``name``; children stand
    under ``subtheories``. A name met twice keeps its first place. Keywords are lower case.
    """
    rows: list[tuple] = []
    seen: set[str] = set()

    def walk(items, up, level):
        pairs = items.items() if isinstance(items, dict) else [(x.get("name"), x) for x in items or [] if isinstance(x, dict)]
        for name, node in pairs:
            node = node if isinstance(node, dict) else {}
            name = node.get("name") or name
            if not name:
                continue
            if name not in seen:
                seen.add(name)
                kw = node.get("keywords")
                words = [str(k).lower() for k in kw] if isinstance(kw, list) else []
                target = node.get("target")
                rows.append((name, up, int(target) if isinstance(target, (int, float)) else None, level, len(rows), words))
            walk(node.get("subtheories") or node.get("children") or {}, name, level + 1)

    walk(config, parent, depth)
    return rows


def ontology_table(spark: SparkSession, config: dict | list) -> DataFrame:
    return spark.createDataFrame(
        flatten_ontology(config), "name string, parent string, target int, depth int, ordinal int, keywords array<string>"
    )


def body_text(article_xml: str) -> str:
    """Text of an article body: sections, titles and paragraphs set apart by blank lines."""
    import xml.etree.ElementTree as ET

    root = ET.fromstring(article_xml)
    body = root if root.tag == "body" else root.find(".//body")
    if body is None:
        return ""
    parts: list[str] = []

    def walk(node):
        if node.tag in ("title", "p"):
            text = " ".join("".join(node.itertext()).split())
            if text:
                parts.append(text)
            return
        for child in node:
            walk(child)

    walk(body)
    return "\n\n".join(parts)

"""Building a registry of names in order of appearance, and small sequential helpers.

Names of one slug or of the same words in any order are one entry. The rest is
compared each with all by matching-blocks similarity, after bounds that lose no similar
pair. What is similar enough is linked, links are followed to
connected components, and the earliest name of a component is its entry. A
sequential fold joins each name to the best earlier entry only; the two differ where
similar names form chains.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.functions.text import clean_label, slug
from lorewright.operators.components import connected_components
from lorewright.operators.ranking import two_level_rank
from lorewright.session import cut, spread


#: Names per block, and buckets of bigrams; neither bears on the result.
BLOCK, BUCKETS = 2048, 512


def _bigrams(names: list[str]) -> np.ndarray:
    """Counts of each name's bigrams, hashed to buckets; what two names share is at most the product of their rows."""
    out = np.zeros((len(names), BUCKETS), dtype=np.float32)
    for i, s in enumerate(names):
        for p, q in zip(s, s[1:], strict=False):
            out[i, (ord(p) * 1009 + ord(q)) % BUCKETS] += 1
    return out


def _least_shared(la: np.ndarray, lb: np.ndarray, ratio: float) -> np.ndarray:
    """Bigrams that names of these lengths share at least if their ratio is reached.

    The matching blocks hold m = ratio * (la + lb) / 2 characters or more, so m - 1 neighbours in their
    row; each character that is left out of either name parts at most one of these.
    """
    m = np.ceil(ratio * (la + lb) / 2 - 1e-9)
    return m - 1 - (la - m) - (lb - m)


def similar_names(names: DataFrame, ratio: float, block: int = BLOCK) -> DataFrame:
    """``a, b`` of all names (ordinal, label) whose matching-blocks similarity without case reaches ``ratio``; a before b.

    Names sorted by length are cut into blocks and all pairs of blocks are compared, but those whose lengths rule it
    out. Bounds that hold for every similar pair (length, shared bigrams, shared characters) go before the exact test.
    """
    low = names.select("ordinal", F.lower("label").alias("s")).withColumn("n", F.length("s"))
    placed = cut(low.repartitionByRange("n", "ordinal").withColumn("_b", F.spark_partition_id()).withColumn("o", F.lit(0)))
    ranked = cut(two_level_rank(placed, ["o"], "_b", ["n", "ordinal"]).withColumn("g", F.floor(F.col("rank") / block)))
    spans = ranked.groupBy("g").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    x, y = spans.alias("x"), spans.alias("y")
    # m is at most the shorter name
    met = x.crossJoin(y).where("x.g <= y.g").where(F.col("x.hi") >= F.col("y.lo") * (ratio / (2 - ratio)) - 1e-6)
    met = met.select(F.col("x.g").alias("gx"), F.col("y.g").alias("gy"))
    sides = met.select("gx", "gy", F.explode(F.array_distinct(F.array("gx", "gy"))).alias("g"))
    kind = names.schema["ordinal"].dataType.simpleString()

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows["g"] == key[0]], rows[rows["g"] == key[1]]
        ls, rs, lo, ro = left["s"].tolist(), right["s"].tolist(), left["ordinal"].tolist(), right["ordinal"].tolist()
        ln, rn, rb = np.array([len(s) for s in ls]), np.array([len(s) for s in rs]), _bigrams(rs)
        made = []
        for at in range(0, len(ls), 512):
            part = slice(at, at + 512)
            la, lb = ln[part, None], rn[None, :]
            fit = (2 * np.minimum(la, lb) >= ratio * (la + lb) - 1e-9) & (_bigrams(ls[part]) @ rb.T >= _least_shared(la, lb, ratio) - 0.5)
            for i, j in zip(*np.nonzero(fit), strict=True):
                i = int(i) + at
                if key[0] == key[1] and i >= j:
                    continue
                (a, p), (b, q) = sorted([(lo[i], ls[i]), (ro[j], rs[j])])
                # as a new name is held against an earlier one
                m = difflib.SequenceMatcher(None, q, p)
                if m.quick_ratio() >= ratio and m.ratio() >= ratio:
                    made.append((a, b))
        return pd.DataFrame(made, columns=["a", "b"])

    blocks = spread(ranked.join(sides, "g").select("gx", "gy", "g", "ordinal", "s"), "gx", "gy")
    return blocks.groupBy("gx", "gy").applyInPandas(run, f"a {kind}, b {kind}")


def build_registry(mentions: DataFrame, ratio: float | None = 0.9) -> DataFrame:
    """``label, canonical, theory_id, mentions``; mentions: label, ordinal. Without ``ratio`` no similar names are looked for."""
    named = mentions.withColumn("label", clean_label("label")).where("label <> ''")
    once = named.groupBy("label").agg(F.min("ordinal").alias("ordinal"), F.count("*").alias("mentions"))
    words = F.filter(F.split(F.lower("label"), "[^a-z0-9]+"), lambda w: w != "")
    entry = cut(once.withColumn("sig", F.coalesce(F.nullif(F.array_join(F.array_sort(words), " "), F.lit("")), F.lower("label"))))
    # one name per signature goes on: the earliest
    heads = cut(entry.groupBy("sig").agg(F.min(F.struct("ordinal", "label")).alias("h")).select("sig", F.col("h.ordinal").alias("ordinal"), F.col("h.label").alias("label")))
    if ratio is None:
        return entry.join(heads.select("sig", F.col("label").alias("canonical")), "sig").select("label", "canonical", slug("canonical").alias("theory_id"), "mentions")
    linked = similar_names(heads, ratio)
    merged = connected_components(linked.select("a", "b"))
    named_heads = heads.select(F.col("ordinal").alias("component"), F.col("label").alias("canonical"))
    final = (
        heads.join(merged.withColumnRenamed("node", "ordinal"), "ordinal", "left")
        .select("sig", F.coalesce("component", "ordinal").alias("component"))
        .join(named_heads, "component")
        .select("sig", "canonical")
    )
    return entry.join(final, "sig").select("label", "canonical", slug("canonical").alias("theory_id"), "mentions")


def registry_tables(mentions: DataFrame, ratio: float | None = 0.9) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, supports, synonyms) of a registry; mentions: label, ordinal, article.

    entries: ``theory_id, label, slug, article`` (that of its first mention)`, aliases, articles`` (how many). supports: one
    row per entry and article. synonyms: one row per other spelling and article, ``alias, theory_id, slug, article``.
    Rows in place of lists, so an entry that very many articles support stays spread out.
    """
    named = mentions.withColumn("label", clean_label("label")).where("label <> ''")
    built = cut(named.join(build_registry(mentions, ratio).select("label", "canonical"), "label").select("label", "canonical", "ordinal", "article"))
    first = built.groupBy("canonical").agg(
        F.min_by("article", "ordinal").alias("first"), F.count_distinct("label").alias("aliases"), F.count_distinct("article").alias("articles")
    )
    key = F.concat(slug("canonical"), F.lit("__"), slug(F.coalesce("first", F.lit("")), "article"))
    ids = cut(first.withColumn("theory_id", key))
    entries = ids.select("theory_id", F.col("canonical").alias("label"), slug("canonical").alias("slug"), F.col("first").alias("article"), "aliases", "articles")
    each = built.join(ids.select("canonical", "theory_id"), "canonical")
    supports = each.where("article IS NOT NULL").select("theory_id", "article").distinct()
    other = each.where((F.lower("label") != F.lower("canonical")) & F.col("article").isNotNull())
    synonyms = other.select(F.col("label").alias("alias"), "theory_id", slug("label").alias("slug"), "article").distinct()
    return entries, supports, synonyms


def overlapping_windows(text: str, size: int, overlap: int) -> list[str]:
    """Windows of ``size`` characters that back off to the last blank; each next one begins ``overlap`` before the end."""
    out, start = [], 0
    while start < len(text):
        end = min(len(text), start + size)
        if end < len(text):
            blank = text.rfind(" ", start, end)
            if blank > start:
                end = blank
        piece = text[start:end].strip()
        if piece:
            out.append(piece)
        if end >= len(text):
            break
        start = max(end - overlap, start + 1)
    return out


def text_windows(rows: DataFrame, id_col: str, text_col: str, size: int = 12000, overlap: int = 1000) -> DataFrame:
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [(k, i, w) for k, t in zip(b[id_col], b[text_col], strict=True) if t for i, w in enumerate(overlapping_windows(t, size, overlap))]
            yield pd.DataFrame(made, columns=[id_col, "chunk", "text"])

    return rows.select(id_col, text_col).mapInPandas(run, f"`{id_col}` {kind}, chunk int, text string")


def similarity(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Adds ``ratio``, the matching-blocks similarity of two text columns."""
    kinds = ", ".join(f"`{n}` {t}" for n, t in pairs.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            x = x.copy()
            x["ratio"] = [difflib.SequenceMatcher(None, p or "", q or "").ratio() for p, q in zip(x[a], x[b], strict=True)]
            yield x

    return pairs.mapInPandas(run, f"{kinds}, ratio double")

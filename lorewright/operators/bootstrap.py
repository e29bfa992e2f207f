"""First trees of theories out of review texts, and search queries for groups of a tree.

Names, lists of parts and bullets are three streams of events (where, what) read off the texts
with built-in functions. A list or bullet belongs to every name near enough to it: the streams meet
in an equi-join on text and stretch, so neither a long text nor one with many names is walked in one go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorewright.functions.text import analysis_text, query_variants

# How theories, lists of parts and bullets are written in reviews, and how near a part stands
# (characters before the name's start and after its end).
NAME = r"[A-Z][A-Za-z0-9\-&\s]+?(?:Theory|Model)"
LIST = r"(?i)sub(?:theories|domains|concepts)?\s*[:=-]\s*[^\n]+"
BULLET = r"(?m)^-\s*[A-Za-z0-9][^\n]+$"
BEFORE, AFTER = 80, 200
#: Characters of a stretch in the join of streams; it bears on no result.
STRETCH = 512


def _tidy(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), r"[\s:,.;-]+$", ""), r"^\s+", "")


def events(texts: DataFrame, pattern: str) -> DataFrame:
    """``identifier, at, hit``: every match of a pattern with its place, from what lies between the matches."""
    cutted = texts.select("identifier", F.split("text", pattern, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("hits"))
    step = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + F.length(x["gap"])).alias("at"), x["hit"].alias("hit")))).alias("out"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,hit:string>>").alias("out"))
    pairs = F.arrays_zip(F.slice("gaps", F.lit(1), F.size("hits")).alias("gap"), F.col("hits").alias("hit"))
    return cutted.where(F.size("hits") > 0).select("identifier", F.explode(F.aggregate(pairs, start, step, lambda acc: acc["out"])).alias("e")).select("identifier", "e.*")


def review_trees(reviews: DataFrame) -> DataFrame:
    """``identifier, theory, part, pos`` of review papers; part is NULL for a theory without parts.

    A name met again is left out. The first list near a name gives its parts, bullets do where there is no list; what
    lies beyond the reach is not read. Null and blank texts give no rows.
    """
    text = F.concat_ws("\n", F.coalesce("title", F.lit("")), analysis_text())
    texts = reviews.where("identifier IS NOT NULL").select("identifier", text.alias("text")).distinct()
    named = events(texts, NAME).withColumn("theory", _tidy(F.col("hit"))).withColumn("end", F.col("at") + F.length("hit"))
    once = named.groupBy("identifier", F.lower("theory").alias("k")).agg(F.min(F.struct("at", "end", "theory")).alias("n")).select("identifier", "n.*")
    near = once.select(
        "*", F.greatest(F.col("at") - BEFORE, F.lit(0)).alias("low"), (F.col("end") + AFTER).alias("high")
    )
    cells = near.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / STRETCH), F.floor(F.col("high") / STRETCH))))
    found = events(texts, LIST).withColumn("listed", F.lit(True)).unionByName(events(texts, BULLET).withColumn("listed", F.lit(False)))
    found = found.select("identifier", F.col("at").alias("where"), "hit", "listed", F.floor(F.col("at") / STRETCH).alias("cell"))
    met = cells.join(found, ["identifier", "cell"]).where("where >= low AND where < high")
    met = met.withColumn("hit", F.substring("hit", F.lit(1), (F.col("high") - F.col("where")).cast("int")))
    first = met.where("listed").groupBy("identifier", "theory").agg(F.min(F.struct("where", "hit")).alias("l"))
    lists = first.select("identifier", "theory", F.posexplode(F.split(F.regexp_replace("l.hit", r"(?i)^sub(?:theories|domains|concepts)?\s*[:=-]\s*", ""), "[,;]")).alias("pos", "part"))
    bullets = met.where("NOT listed").join(first, ["identifier", "theory"], "left_anti")
    bullets = bullets.select("identifier", "theory", F.col("where").alias("pos"), F.regexp_replace("hit", r"^-\s*", "").alias("part"))
    parts = lists.unionByName(bullets).withColumn("part", _tidy(F.col("part"))).where("part <> ''")
    places = parts.groupBy("identifier", "theory").agg(F.sort_array(F.collect_list(F.struct("pos", "part"))).alias("ps"))  # as many as AFTER leaves room for
    return near.join(places, ["identifier", "theory"], "left").select(
        "identifier", "theory", F.posexplode(F.coalesce(F.transform("ps", lambda x: x["part"]), F.array(F.lit(None).cast("string")))).alias("pos", "part")
    ).select("identifier", "theory", "part", "pos")


def suggested_queries(groups: DataFrame, terms: DataFrame, most: int = 10) -> DataFrame:
    """Search queries per group: variants of its own terms, then of the groups below, nearest first.

    groups: grp, descendant, distance (0 for itself); terms: grp, term, ordinal.
    Queries are distinct without case; the first ``most`` are the suggestion.
    """
    below = groups.join(terms.withColumnRenamed("grp", "descendant"), "descendant")
    each = below.select("grp", "distance", "ordinal", "term", F.posexplode(query_variants("term")).alias("pos", "query"))
    first = Window.partitionBy("grp", F.lower("query")).orderBy("distance", "ordinal", "term", "pos")
    kept = each.withColumn("r", F.row_number().over(first)).where("r = 1")
    order = Window.partitionBy("grp").orderBy("distance", "ordinal", "term", "pos")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("grp", "query", "rank")

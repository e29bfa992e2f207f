"""Operators over trees given as edge tables ``tree, node, parent``."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorewright.operators.ranking import spread_rank


def node_counts(links: DataFrame) -> DataFrame:
    """Per tree the nodes and the leaves; links: tree, node, parent."""
    parents = links.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct().withColumn("inner", F.lit(True))
    return links.join(parents, ["tree", "node"], "left").groupBy("tree").agg(
        F.count("*").alias("nodes"), F.count_if(F.col("inner").isNull()).alias("leaves")
    )


def child_summary(links: DataFrame, closure: DataFrame) -> DataFrame:
    """Per node the direct children and the leaves below; closure: tree, node, descendant, distance."""
    parents = links.where("parent IS NOT NULL").select("tree", F.col("parent").alias("descendant")).distinct().withColumn("inner", F.lit(True))
    below = closure.join(parents, ["tree", "descendant"], "left").groupBy("tree", "node").agg(
        F.count_if(F.col("distance") == 1).alias("children"), F.count_if(F.col("inner").isNull()).alias("branch_leaves")
    )
    return links.select("tree", "node").join(below, ["tree", "node"], "left").select(
        "tree", "node", F.coalesce("children", F.lit(0)).alias("children"), F.coalesce("branch_leaves", F.lit(1)).alias("branch_leaves")
    )


def levels(resolved: DataFrame) -> DataFrame:
    """Nodes per depth of each tree; resolved: tree, node, depth."""
    return resolved.where("depth IS NOT NULL").groupBy("tree", "depth").agg(F.count("*").alias("nodes"))


def balance_children(children: DataFrame, most: int) -> DataFrame:
    """Children of a parent with more than ``most`` are dealt round-robin into ``most`` groups.

    children: parent, node, weight. They are dealt in order of falling weight, then
    lower-case name. A group of one stays itself; others are named Other, Other 2 and so on.
    """
    size = children.groupBy(F.col("parent").alias("_p")).agg(F.count("*").alias("size"))
    ranked = spread_rank(children, ["parent"], [F.desc("weight"), F.lower("node"), "node"], "place")
    dealt = ranked.join(size, F.col("parent").eqNullSafe(F.col("_p"))).drop("_p")
    slot = F.when(F.col("size") > most, F.pmod(F.col("place"), F.lit(most))).otherwise(F.col("place"))
    dealt = dealt.withColumn("slot", slot)
    many = F.when(F.col("size") > most, F.ceil((F.col("size") - F.col("slot")) / most)).otherwise(1)
    dealt = dealt.withColumn("many", many)
    # groups of several are numbered by slot; those come first, as places are dealt evenly
    name = F.when(F.col("many") == 1, F.col("node")).when(F.col("slot") == 0, "Other").otherwise(
        F.concat(F.lit("Other "), (F.col("slot") + 1).cast("string"))
    )
    return dealt.select("parent", "node", "slot", name.alias("group_name"))


def split_oversized(items: DataFrame, most: int, target: int, least: int) -> DataFrame:
    """Items of an owner above ``most`` cut into chunks of min(most, max(target, least)).

    items: owner, item, pos. A last chunk below ``least`` joins the one before;
    chunks are numbered from 1. Owners within the limit keep chunk 1.
    """
    size = min(most, max(target, least))
    n = items.groupBy(F.col("owner").alias("_o")).agg(F.count("*").alias("n"))
    placed = spread_rank(items, ["owner"], ["pos", "item"], "at").join(n, F.col("owner").eqNullSafe(F.col("_o")))
    raw = F.floor(F.col("at") / size)
    last = F.floor((F.col("n") - 1) / size)
    tail = F.col("n") - last * size
    chunk = F.when((raw == last) & (tail < least) & (last > 0), last - 1).otherwise(raw)
    return placed.select("owner", "item", (F.when(F.col("n") > most, chunk).otherwise(0) + 1).cast("int").alias("chunk"))


def limit_group(items: DataFrame, most: int) -> DataFrame:
    """Overflow of a group goes to subgroups ``name (auto-split k)`` from k = 2; items: owner, item, pos."""
    k = F.ceil((F.col("at") + 1) / most).cast("int")
    return spread_rank(items, ["owner"], ["pos", "item"], "at").withColumn("k", k).select(
        "item", F.when(F.col("k") == 1, F.col("owner")).otherwise(F.concat(F.col("owner"), F.lit(" (auto-split "), F.col("k").cast("string"), F.lit(")"))).alias("owner")
    )


def merge_paths(nodes: DataFrame) -> DataFrame:
    """Trees merged by name path: citations add up per occurrence, reviews are distinct. nodes: path, citations, review."""
    return nodes.groupBy("path").agg(
        F.sum("citations").alias("citations"), F.count_distinct("review").alias("reviews")
    )


def reconcile(placed: DataFrame, registry: DataFrame, fallback: str = "Unassigned") -> DataFrame:
    """Placements checked against the registry: ``grp, theory_id, reason``.

    placed: grp, theory_id, ordinal. Unknown ids are dropped as ``unknown``, later
    repeats as ``duplicate``; registry theories without a place go to the fallback group.
    """
    known = registry.select("theory_id").distinct().withColumn("known", F.lit(True))
    r = F.row_number().over(Window.partitionBy("theory_id").orderBy("ordinal", "grp"))
    judged = placed.withColumn("r", r).join(known, "theory_id", "left").select(
        "grp", "theory_id", F.when(F.col("known").isNull(), "unknown").when(F.col("r") > 1, "duplicate").otherwise("kept").alias("reason")
    )
    rest = known.select("theory_id").join(placed.select("theory_id").distinct(), "theory_id", "left_anti").select(
        F.lit(fallback).alias("grp"), "theory_id", F.lit("added").alias("reason")
    )
    return judged.unionByName(rest)


def refilled(judged: DataFrame, articles: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(placements with their articles from the registry, groups left empty).

    judged: as ``reconcile`` gives it; articles: theory_id, article; groups: grp. A placement that was dropped bears
    no article, one that was kept or added has one row for each article and one without if there is none.
    """
    good = judged.where("reason IN ('kept', 'added')").select("grp", "theory_id")
    full = good.join(articles.where("article IS NOT NULL").select("theory_id", "article").distinct(), "theory_id", "left").select("grp", "theory_id", "article")
    return full, groups.select("grp").distinct().join(good.select("grp").distinct(), "grp", "left_anti")


def merge_parents(nodes: DataFrame, merges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes with new parents, audit of merges that could not be done).

    nodes: tree, name, parent; merges: tree, parent, child, ordinal. Names match without case and outer blanks.
    A parent that is not there is made, a root; of several merges of one child the first wins and the rest are
    ``repeated``; an unknown child is ``unresolved``, a node as its own parent ``itself``.
    """
    key = lambda c: F.lower(F.trim(c))
    own = nodes.select("tree", key("name").alias("k"), "name", "parent").groupBy("tree", "k").agg(F.min(F.struct("name", "parent")).alias("n")).select("tree", "k", "n.*")
    asked = merges.select("tree", "parent", "child", "ordinal", key("parent").alias("pk"), key("child").alias("ck")).where("pk <> '' AND ck <> ''")
    known = own.select("tree", F.col("k").alias("ck"), F.lit(True).alias("known"))
    first = asked.groupBy("tree", "ck").agg(F.min(F.struct("ordinal", "pk")).alias("f"))
    judged = asked.join(known, ["tree", "ck"], "left").join(first, ["tree", "ck"]).withColumn(
        "issue",
        F.when(F.col("known").isNull(), "unresolved").when(F.col("pk") == F.col("ck"), "itself").when(F.struct("ordinal", "pk") != F.col("f"), "repeated"),
    )
    done = judged.where("issue IS NULL").groupBy("tree", "ck").agg(F.min(F.struct("pk", "parent")).alias("m")).select("tree", "ck", "m.*")
    made = done.join(own.select("tree", F.col("k").alias("pk")), ["tree", "pk"], "left_anti").groupBy("tree", "pk").agg(F.min(F.trim("parent")).alias("name"))
    names = own.select("tree", F.col("k").alias("pk"), F.col("name").alias("new_parent")).unionByName(made.select("tree", "pk", F.col("name").alias("new_parent")))
    moved = done.join(names, ["tree", "pk"]).select("tree", F.col("ck").alias("k"), "new_parent")
    kept = own.join(moved, ["tree", "k"], "left").select("tree", "name", F.coalesce("new_parent", "parent").alias("parent"))
    audit = judged.where("issue IS NOT NULL").select("tree", "child", "parent", "issue").distinct()
    return kept.unionByName(made.select("tree", "name", F.lit(None).cast("string").alias("parent"))), audit


def membership_changes(canonical: DataFrame, proposed: DataFrame) -> DataFrame:
    """``owner, item, change``: added where only the registry has the pair, removed where only the proposal has it."""
    a = canonical.select("owner", "item").distinct().withColumn("a", F.lit(True))
    b = proposed.select("owner", "item").distinct().withColumn("b", F.lit(True))
    return a.join(b, ["owner", "item"], "full").where("a IS NULL OR b IS NULL").select(
        "owner", "item", F.when(F.col("a").isNull(), "removed").otherwise("added").alias("change")
    )


def normalise_splits(proposals: DataFrame, most: int, least: int) -> DataFrame:
    """Model-made splits brought in order, one owner at a time.

    proposals: owner, item, bucket (NULL for items no bucket names), pos. First
    assignment wins, leftovers fill the first bucket with room, buckets above the limit
    are cut, and small neighbours are merged forward.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for owner, items in zip(b["owner"], b["items"], strict=True):
                buckets: dict[int, list[str]] = {}
                seen, left = set(), []
                for x in items:
                    if x["item"] in seen:
                        continue
                    seen.add(x["item"])
                    if x["bucket"] is None:
                        left.append(x["item"])
                    else:
                        buckets.setdefault(int(x["bucket"]), []).append(x["item"])
                groups = [buckets[k] for k in sorted(buckets)] or [[]]
                for item in left:
                    room = next((g for g in groups if len(g) < most), None)
                    if room is None:
                        groups.append([item])
                    else:
                        room.append(item)
                cut = [g[i : i + most] for g in groups for i in range(0, len(g), most)]
                merged: list[list[str]] = []
                for g in cut:
                    if merged and len(merged[-1]) < least and len(merged[-1]) + len(g) <= most:
                        merged[-1] += g
                    else:
                        merged.append(list(g))
                rows += [(owner, item, k + 1) for k, g in enumerate(merged) for item in g]
            yield pd.DataFrame(rows, columns=["owner", "item", "chunk"])

    ordered = F.array_sort(F.collect_list(F.struct("pos", "item", "bucket")))
    return proposals.groupBy("owner").agg(ordered.alias("items")).mapInPandas(run, "owner string, item string, chunk int")

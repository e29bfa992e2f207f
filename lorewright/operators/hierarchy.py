"""Parent-child rows to full hierarchies by parallel tree contraction.

Every round rakes all leaves and splices an independent set of unary nodes out
of their chains; each removal is recorded with the anchor it hung on and the
names skipped between. The rounds number O(log n) whatever the depth, as no
group of rows is ever gathered in one task. Once only self-loops are left (each
is a whole circle contracted to one node) the records are replayed backwards:
a node's path is its anchor's path, the skipped names and its own name.

Defined results for odd input: rows whose ontology or name is null or blank are
ignored; exact and respelled repeats of a node count once (smallest spelling,
smallest non-blank parent spelling); a blank parent is filled from the node
whose ``children`` list it (smallest name on ties); an empty table gives an
empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.functions.text import blank_to_null, fold
from lorewright.session import cut

_SEP = "\x1f"


def parent_links(nodes: DataFrame) -> DataFrame:
    """One row per node: ``ontology_id, name, v, p, orphan``; v and p are match keys."""
    oid = F.col("ontology_id")
    base = nodes.select(
        oid,
        F.col("name"),
        fold("name").alias("k"),
        fold(blank_to_null("parent")).alias("pk"),
        F.col("children"),
    ).where((F.col("k") != "") & oid.isNotNull())
    own = base.groupBy("ontology_id", "k").agg(F.min("name").alias("name"), F.min("pk").alias("pk"))
    listed = (
        base.select("ontology_id", F.col("k").alias("lister"), F.explode("children").alias("c"))
        .select("ontology_id", "lister", fold("c").alias("k"))
        .where(F.col("k") != "")
        .groupBy("ontology_id", "k")
        .agg(F.min("lister").alias("lister"))
    )
    known = own.select("ontology_id", F.col("k").alias("pk"), F.lit(True).alias("known"))
    key = lambda c: F.concat_ws(_SEP, "ontology_id", c)
    return (
        own.join(listed, ["ontology_id", "k"], "left")
        .join(known, ["ontology_id", "pk"], "left")
        .select(
            "ontology_id",
            "name",
            key("k").alias("v"),
            F.when(F.col("pk").isNotNull(), F.when(F.col("known"), key("pk")))
            .when(F.col("lister").isNotNull(), key("lister"))
            .alias("p"),
            (F.col("pk").isNotNull() & F.col("known").isNull()).alias("orphan"),
        )
    )


def _contract(live: DataFrame, paths: bool) -> DataFrame:
    """One round: rows of ``live`` with their links updated and ``act`` 0 kept, 1 raked, 2 spliced; ``c`` is a spliced node's child.

    With ``paths``, ``name`` and ``seg`` (the names skipped above a node) go along. The round's
    number is a column and no literal, so that all rounds share their generated code.
    """
    h = lambda c: F.xxhash64(F.col(c), F.col("turn"))
    fan = live.groupBy("p").agg(F.count("*").alias("n"), F.min("v").alias("c")).withColumnRenamed("p", "v")
    seen = live.join(fan, "v", "left").withColumn(
        "act",
        F.when(F.col("n").isNull(), 1)
        .when(
            (F.col("n") == 1) & (F.col("c") != F.col("v")) & (h("v") > h("p")) & (h("v") > h("c")), 2
        )
        .otherwise(0),
    )
    kinds = {"v": "string", "act": "int", "p": "string", "c": "string", "turn": "int", "up": "string"}
    if paths:
        kinds |= {"name": "string", "seg": "array<string>", "useg": "array<string>"}
    null = lambda c: F.lit(None).cast(kinds[c]).alias(c)
    given = {"v": F.col("c"), "up": F.col("p"), "useg": F.concat("seg", F.array("name")) if paths else None}
    own = F.struct(*[null(c) if c in ("up", "useg") else F.col(c).cast(k).alias(c) for c, k in kinds.items()])
    handed = F.struct(*[given[c].alias(c) if c in given else null(c) for c in kinds])
    rows = seen.select(
        F.explode(F.when(F.col("act") == 2, F.array(own, handed)).otherwise(F.array(own))).alias("x")
    ).select("x.*")
    # A node has at most one row of its own and one handed down by the parent that left.
    merged = rows.groupBy("v").agg(*[F.first(c, ignorenulls=True).alias(c) for c in kinds if c != "v"])
    out = ["v", "act", F.coalesce("up", "p").alias("p"), "c", (F.col("turn") + 1).alias("turn")]
    if paths:
        out += ["name", F.when(F.col("up").isNotNull(), F.concat("useg", "seg")).otherwise(F.col("seg")).alias("seg")]
    return merged.select(*out)


def _contracted(live: DataFrame, paths: bool) -> tuple[DataFrame, list[DataFrame]]:
    """(the core: one self-loop for each circle, what every round removed)."""
    rounds: list[DataFrame] = []
    while True:
        state = cut(_contract(live, paths))
        counts = {r["act"]: (r["n"], r["loops"]) for r in state.groupBy("act").agg(
            F.count("*").alias("n"), F.count_if(F.col("v") == F.col("p")).alias("loops")).collect()}
        rounds.append(state.where("act > 0"))
        live = state.where("act = 0").drop("act", "c")
        kept, loops = counts.get(0, (0, 0))
        if kept == loops:
            return live, rounds


def defects(nodes: DataFrame) -> DataFrame:
    """The nodes outside any sound hierarchy: ``ontology_id, name, kind``, kinds as of ``resolve_hierarchy``.

    No path is built. A raked node is as sound as its parent, and a spliced one lies where its
    only child lies, so each removal leaves one pointer; the pointers lead to the core or to a root and
    are followed by doubling.
    """
    links = cut(parent_links(nodes))
    live, rounds = _contracted(links.where(F.col("p").isNotNull()).select("v", "p", F.lit(0).alias("turn")), False)
    removed = rounds[0]
    for more in rounds[1:]:
        removed = removed.unionByName(more)
    spliced = F.col("act") == 2
    at = cut(removed.select("v", F.when(spliced, F.col("c")).otherwise(F.col("p")).alias("to"), spliced.alias("chain")))
    while True:
        ahead = at.select(F.col("v").alias("to"), F.col("to").alias("next"), F.col("chain").alias("also"))
        at = cut(
            at.join(ahead, "to", "left").select(
                "v", F.coalesce("next", "to").alias("to"), (F.col("chain") & F.coalesce("also", F.lit(True))).alias("chain"), F.col("next").isNotNull().alias("moved")
            )
        )
        moved = at.agg(F.count_if("moved").alias("n")).collect()[0]["n"]
        at = at.drop("moved")
        if not moved:
            break
    loops = live.select(F.col("v").alias("to"), F.lit(True).alias("loop"))
    itself = live.select("v", F.col("v").alias("to"), F.lit(True).alias("chain"))
    ends = at.unionByName(itself).join(loops, "to").select("v", "chain")
    return (
        links.join(ends, "v", "left")
        .withColumn("kind", F.when(F.col("chain"), "cycle").when(~F.col("chain"), "hanging").when(F.col("orphan"), "orphan"))
        .where("kind IS NOT NULL")
        .select("ontology_id", "name", "kind")
    )


def resolve_hierarchy(nodes: DataFrame) -> DataFrame:
    """Path, depth, root and kind of every node.

    Result: ``ontology_id, name, kind, root, depth, path``. ``kind`` is
    ``cycle``, ``hanging``, ``orphan`` or ``node``; for the first two, root,
    depth and path are NULL. An orphan is the root of what hangs on it.
    """
    links = cut(parent_links(nodes))
    live = links.where(F.col("p").isNotNull()).select(
        "v", "name", "p", F.array().cast("array<string>").alias("seg"), F.lit(0).alias("turn")
    )
    live, rounds = _contracted(live, True)
    known = [
        links.where(F.col("p").isNull()).select(
            "v", F.col("name").alias("root"), F.array("name").alias("path"), F.lit(True).alias("tree")
        ),
        live.select(
            "v", F.lit(None).cast("string").alias("root"), F.lit(None).cast("array<string>").alias("path"),
            F.lit(False).alias("tree"),
        ),
    ]
    circles = live.select("v", F.explode(F.concat("seg", F.array("name"))).alias("name"))
    circles = circles.select(
        F.substring_index("v", _SEP, 1).alias("ontology_id"), "name", F.lit(True).alias("on_circle")
    )
    for state in reversed(rounds):
        anchors = known[0]
        for more in known[1:]:
            anchors = anchors.unionByName(more)
        back = state.join(anchors.withColumnRenamed("v", "p"), "p").select(
            "v", "root", F.concat("path", "seg", F.array("name")).alias("path"), "tree"
        )
        known.append(cut(back))
    full = known[0]
    for more in known[1:]:
        full = full.unionByName(more)
    return (
        links.select("ontology_id", "name", "v", "orphan")
        .join(full, "v")
        .join(circles, ["ontology_id", "name"], "left")
        .select(
            "ontology_id",
            "name",
            F.when(F.col("on_circle"), "cycle")
            .when(~F.col("tree"), "hanging")
            .when(F.col("orphan"), "orphan")
            .otherwise("node")
            .alias("kind"),
            "root",
            (F.size(F.col("path")) - 1).alias("depth"),
            "path",
        )
        .withColumn("depth", F.when(F.col("path").isNotNull(), F.col("depth")))
    )


def descendants(resolved: DataFrame) -> DataFrame:
    """All descendants as rows ``ontology_id, name, descendant, distance``, from the resolved paths.

    Rows instead of arrays, so that a node with very many descendants stays spread out.
    """
    return (
        resolved.where(F.col("depth") > 0)
        .select("ontology_id", F.col("name").alias("descendant"), "depth", F.posexplode("path").alias("i", "name"))
        .where(F.col("i") < F.col("depth"))
        .select("ontology_id", "name", "descendant", (F.col("depth") - F.col("i")).alias("distance"))
    )

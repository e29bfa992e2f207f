"""Matching records of one article across sources that share no identifier.

Keys of the three tables that are tied by usable identifiers form entities. Equal titles
are joined. The distinct titles are sorted by several composite keys (title forwards, title
backwards, first author, last author); in each order every one is compared with the next
few, and with it all records that bear it. A pair is scored by weighted field similarities: title (equal, misspelt, or
without subtitle), authors, year (each off by one at most), journal, remains of identifiers. Entities
that both bear a DOI, a PubMed id or a paper are different articles by that
alone and are never compared further. Among the rest PubMed-only entities are assigned to
DOI-only ones, and papers to the rest, one to one with the greatest total confidence;
an entity without any identifier joins its best partner.

Defined results: a null or blank title takes no part; null years, authors and
journals are neutral; repeated rows change nothing; ties go to the smaller key;
identical titles of one entity are one record, and works equal in all that is scored hang
on one of them, so copies do not fill the windows.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorewright.functions.text import squeeze, strip
from lorewright.llm.ids import usable_doi, usable_pmid
from lorewright.operators.components import connected_components
from lorewright.operators.ranking import two_level_rank
from lorewright.session import cut

WINDOW = 6
BLOCK = 512
THRESHOLD = 0.7
_ACCENTS = ("àáâãäåçèéêëìíîïñòóôõöùúûüýÿø", "aaaaaaceeeeiiiinooooouuuuyyo")


def _fold(c: Column) -> Column:
    c = F.regexp_replace(c, r"<[^>]{1,100}>", " ")
    c = F.translate(F.lower(c), *_ACCENTS)
    return F.regexp_replace(c, "&", " and ")


def _words(c: Column) -> Column:
    w = F.split(F.trim(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " ")), " ")
    return F.filter(w, lambda x: (x != "") & ~x.isin("the", "a", "an"))


def _surname(a: Column) -> Column:
    a = F.translate(F.lower(squeeze(a)), *_ACCENTS)
    parts = F.split(a, " ")
    last = F.element_at(parts, -1)
    initial = last.rlike(r"^\p{L}\.?$")
    return F.when(a.contains(","), F.trim(F.substring_index(a, ",", 1))).when(
        initial & (F.size(parts) > 1), F.element_at(parts, 1)
    ).otherwise(last)


def source_rows(pubmed: DataFrame, openalex: DataFrame, papers: DataFrame) -> DataFrame:
    """All rows in one form: ``node, src, key, title, authors, year, journal, doi, pmid``."""
    null = F.lit(None).cast("string")
    parts = [
        pubmed.select(F.lit("P").alias("src"), F.col("pmid").alias("key"), "title", "authors", F.col("publication_year").alias("year"), "journal", "doi", "pmid"),
        openalex.select(F.lit("O").alias("src"), F.col("openalex_id").alias("key"), "title", "authors", F.col("publication_year").alias("year"), "journal", "doi", "pmid"),
        papers.select(F.lit("A").alias("src"), F.col("identifier").alias("key"), "title", "authors", F.col("year").cast("string").alias("year"), null.alias("journal"), "doi", null.alias("pmid")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    year = F.regexp_extract("year", r"(1[89][0-9]{2}|20[0-9]{2})", 1)
    people = F.filter(
        F.transform("authors", _surname),
        lambda s: s.rlike(r"^[\p{L}'’ -]{2,}$")
        & ~s.rlike(r"^(al|et al|anonymous|unknown|n a|na|none|authors?|not available|.*(consortium|group|collaboration|team|committee))$"),
    )
    j = F.transform(F.filter(_words(_fold(F.col("journal"))), lambda w: ~w.isin("of", "on", "in", "and", "for")), lambda w: F.substring(w, 1, 3))
    return rows.where("key IS NOT NULL").select(
        F.concat_ws("|", "src", "key").alias("node"), "src", "key", "title",
        F.coalesce(people, F.array().cast("array<string>")).alias("people"),
        F.when(year != "", year.cast("int")).alias("year"), F.nullif(F.array_join(j, " "), F.lit("")).alias("journal"),
        usable_doi("doi").alias("doi"), usable_pmid("pmid").alias("pmid"),
        F.regexp_extract(F.lower(strip("doi")), r"(10\.[0-9]{4,9})", 1).alias("doi_part"),
        F.regexp_replace("pmid", r"[^0-9]", "").alias("pmid_part"),
    )


def entities(rows: DataFrame) -> DataFrame:
    """``node, entity``: keys tied by usable identifiers, named by their smallest."""
    ids = rows.select("node", F.explode(F.array_compact(F.array(F.concat(F.lit("d"), "doi"), F.concat(F.lit("p"), "pmid")))).alias("i")).distinct()
    hub = ids.groupBy("i").agg(F.min("node").alias("m"))
    tied = connected_components(ids.join(hub, "i").where("node <> m").select("node", "m").distinct())
    return rows.select("node").distinct().join(tied, "node", "left").select("node", F.coalesce("component", "node").alias("entity"))


def profiles(rows: DataFrame, ent: DataFrame) -> DataFrame:
    """One record per entity and distinct title, with the entity's attributes."""
    lead = F.regexp_extract(_fold(F.col("title")), r"^(.{12,}?)\s*(?:[:?.]\s+|\s[-–—‐‑]\s)(?:.{8,})$", 1)
    # a part of a series is not what its lead alone names
    lead = F.when(F.lower("title").rlike(r"\bpart\s+([ivx]+|[0-9]+|one|two|three)\W*$"), "").otherwise(lead)
    each = rows.join(ent, "node").where(strip("title") != "")
    by_entity = rows.join(ent, "node").groupBy("entity").agg(
        F.max_by("people", F.struct(F.size("people"), F.array_join("people", " "))).alias("people"),
        F.collect_set("year").alias("years"), F.collect_set("journal").alias("journals"),
        F.bool_or(F.col("doi").isNotNull()).alias("has_d"), F.bool_or(F.col("pmid").isNotNull()).alias("has_p"),
        F.bool_or(F.col("src") == "A").alias("has_a"), F.bool_and(F.col("src") == "O").alias("only_o"),
    )
    # what is left of identifiers goes with the title it stands beside, so that it stays short in a large entity
    parts = each.select(
        "entity", _words(_fold(F.col("title"))).alias("w"), _words(lead).alias("lead"),
        F.nullif("doi_part", F.lit("")).alias("d"), F.nullif(F.coalesce("pmid", "pmid_part"), F.lit("")).alias("p"),
    )
    titles = parts.where(F.size("w") > 0).groupBy("entity", "w", "lead").agg(F.collect_set("d").alias("dois"), F.collect_set("p").alias("pmids"))
    return titles.join(by_entity, "entity").withColumn("rid", F.xxhash64("entity", "w", "lead"))


def _sort_keys() -> dict[str, Column]:
    title = F.array_join("w", " ")
    back = F.array_join(F.reverse("w"), " ")
    first, last = F.coalesce(F.get("people", F.lit(0)), F.lit("~")), F.coalesce(F.get("people", F.size("people") - 1), F.lit("~"))
    return {"t": title, "b": back, "f": F.concat_ws(" ", first, title), "l": F.concat_ws(" ", last, back)}


def _similar_words(a: str, b: str) -> Column:
    """Every word of the one that the other lacks is a misspelling of one the other has instead."""
    da, db = F.array_except(a, b), F.array_except(b, a)
    near = lambda x, y: F.levenshtein(x, y) <= F.when(F.length(x) < 4, 0).when(F.length(x) < 6, 1).otherwise(2)
    digits = lambda x: x.rlike("[0-9]")
    return (
        (F.size(da) <= 3)
        & (F.abs(F.size(da) - F.size(db)) <= 1)
        & F.forall(da, lambda x: ~digits(x) & F.exists(db, lambda y: near(x, y)))
        & F.forall(db, lambda x: ~digits(x) & F.exists(da, lambda y: near(x, y)))
    )


def collapse_copies(recs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records without copies, links ``l, r, conf`` of copies to their hub).

    Works without any identifier that are equal in all that is scored are one article
    however many they are; the smallest, their hub, alone goes on.
    """
    alone = recs.groupBy("entity").agg(F.count("*").alias("n")).where("n = 1").select("entity")
    lone = recs.where("only_o AND NOT has_d AND NOT has_p").join(alone, "entity", "left_semi")
    sets = [F.sort_array(c) for c in ("years", "journals", "dois", "pmids")]
    group = F.xxhash64("w", "lead", "people", *sets)
    hubs = lone.groupBy(group.alias("h"), "w", "lead", "people", *[s.alias(n) for s, n in zip(sets, ("years", "journals", "dois", "pmids"), strict=True)]).agg(
        F.min("entity").alias("hub"), F.collect_list("entity").alias("es")
    )
    many = hubs.where(F.size("es") > 1)
    half = lambda known, full: F.when(known, full).otherwise(full / 2)
    conf = (
        0.55 + half(F.size("people") > 0, F.lit(0.25)) + half(F.size("years") > 0, F.lit(0.12)) + half(F.size("journals") > 0, F.lit(0.08))
        + F.when(F.size("dois") > 0, 0.03).otherwise(0.0)
    )
    links = cut(
        many.select(F.explode("es").alias("l"), F.col("hub").alias("r"), F.round(F.least(F.lit(1.0), conf), 6).alias("conf")).where("l <> r")
    )
    return recs.join(links.select(F.col("l").alias("entity")), "entity", "left_anti"), links


def _near_titles(keys: DataFrame, window: int, block: int) -> DataFrame:
    """``ka, kb, title`` of keys of different titles, from sliding windows over every sort order.

    A window slides over distinct sort keys and all their members are compared, so runs of equal
    keys do not fill it. Ranks are global; a block also takes the first rows of the next, so no
    window is broken.
    """
    title_id = F.xxhash64("w", "lead")
    orders = [F.struct(F.lit(k).alias("k"), c.alias("s"), F.xxhash64(F.lit(k), c, "lead").alias("i")) for k, c in _sort_keys().items()]
    thin = keys.select("kid", title_id.alias("t"), F.explode(F.array(*orders)).alias("x")).select("kid", "t", "x.*")
    members = thin.select("kid", "i")
    titles = keys.select(title_id.alias("t"), F.struct("w", "lead").alias("r")).dropDuplicates(["t"])
    # equal keys lie in one partition, so that grouping them moves nothing
    items = thin.select("k", "s", "i", "t").repartitionByRange("k", "s", "i").groupBy("k", "s", "i").agg(F.min("t").alias("t"))
    placed = cut(items.withColumn("_b", F.spark_partition_id()))
    ranked = two_level_rank(placed, ["k"], "_b", ["s", "i"])
    g = F.floor(F.col("rank") / block)
    blocks = ranked.select("k", "i", "t", "rank", F.explode(F.when((F.col("rank") % block < window) & (F.col("rank") >= block), F.array(g, g - 1)).otherwise(F.array(g))).alias("g"))
    blocks = blocks.join(titles, "t").drop("t")
    w = Window.partitionBy("k", "g").orderBy("rank")
    near = blocks.select("i", "r", "rank", "g", F.array(*[F.lead(F.struct("i", "r"), n).over(w) for n in range(1, window + 1)]).alias("ns"))
    flat = (
        near.where(F.floor(F.col("rank") / block) == F.col("g"))
        .select("i", "r", F.explode(F.filter("ns", lambda n: n.isNotNull() & (n["r"]["w"] != F.col("r.w")))).alias("n"))
        .select(F.col("i").alias("ia"), F.col("n.i").alias("ib"), F.col("r.w").alias("w_a"), F.col("r.lead").alias("lead_a"), F.col("n.r.w").alias("w_b"), F.col("n.r.lead").alias("lead_b"))
    )
    no_lead_a, no_lead_b = F.size("lead_a") == 0, F.size("lead_b") == 0
    short = (no_lead_b & (F.size("lead_a") > 3) & _similar_words("lead_a", "w_b")) | (no_lead_a & (F.size("lead_b") > 3) & _similar_words("lead_b", "w_a"))
    title = F.when(_similar_words("w_a", "w_b"), 0.95).when(short, 0.85)
    alike = flat.select("ia", "ib", title.alias("title")).where("title IS NOT NULL")
    return (
        alike.join(members.select(F.col("kid").alias("ka"), F.col("i").alias("ia")), "ia")
        .join(members.select(F.col("kid").alias("kb"), F.col("i").alias("ib")), "ib")
        .select(F.least("ka", "kb").alias("ka"), F.greatest("ka", "kb").alias("kb"), "title")
        .distinct()
    )


def _equal_titles(keys: DataFrame) -> DataFrame:
    """``ka, kb, title`` of all keys of one title that share a person or of which one names none."""
    thin = keys.select("kid", F.xxhash64("w").alias("t"), F.array_distinct("people").alias("people"))
    each = thin.where(F.size("people") > 0).select("kid", F.explode(F.transform("people", lambda x: F.xxhash64("t", x))).alias("x"))
    nameless = thin.where(F.size("people") == 0).select(F.col("kid").alias("ka"), "t")
    a, b = each.withColumnRenamed("kid", "ka"), each.withColumnRenamed("kid", "kb")
    return (
        a.join(b, "x").where("ka < kb").select("ka", "kb")
        .unionByName(nameless.join(thin.select(F.col("kid").alias("kb"), "t"), "t").where("ka <> kb").select(F.least("ka", "kb").alias("ka"), F.greatest("ka", "kb").alias("kb")))
        .distinct()
        .withColumn("title", F.lit(1.0))
    )


def candidate_pairs(recs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Scored pairs of entities ``e1 < e2, conf, same``; same: of equal title and equal known authors.

    Records are grouped by title and authors. Equal titles are joined, others meet in windows.
    """
    recs = recs.withColumn("kid", F.xxhash64("w", "lead", "people"))
    keys = cut(recs.select("kid", "w", "lead", "people").dropDuplicates(["kid"]))
    several = recs.groupBy("kid").agg(F.count("*").alias("n")).where("n > 1").select(F.col("kid").alias("ka"), F.col("kid").alias("kb"), F.lit(1.0).alias("title"))
    near = _near_titles(keys, window, block).unionByName(_equal_titles(keys)).unionByName(several)
    side = lambda df, x: df.select(*[F.col(c).alias(f"{c}_{x}") for c in df.columns])
    people = keys.select("kid", "people")
    known = (F.size("people_a") > 0) & (F.size("people_b") > 0)
    persons = F.size(F.array_intersect("people_a", "people_b")) / F.least(F.size(F.array_distinct("people_a")), F.size(F.array_distinct("people_b")))
    met = (
        near.join(side(people, "a"), F.col("ka") == F.col("kid_a"))
        .join(side(people, "b"), F.col("kb") == F.col("kid_b"))
        .withColumn("persons", F.when(known, persons))
        .where("(persons IS NULL AND title >= 0.95) OR persons >= 0.5")
        .withColumn("same", known & (F.col("title") == 1.0) & (F.col("people_a") == F.col("people_b")))
        .select("ka", "kb", "title", "persons", "same")
    )
    rest_of = recs.select("kid", "entity", "years", "journals", "has_d", "has_p", "has_a", "dois", "pmids")
    flat = (
        met.join(side(rest_of, "a"), F.col("ka") == F.col("kid_a"))
        .join(side(rest_of, "b"), F.col("kb") == F.col("kid_b"))
        .where("entity_a <> entity_b AND (ka <> kb OR entity_a < entity_b)")
        .where("NOT (has_d_a AND has_d_b) AND NOT (has_p_a AND has_p_b) AND NOT (has_a_a AND has_a_b)")
        .withColumns({"e1": F.least("entity_a", "entity_b"), "e2": F.greatest("entity_a", "entity_b")})
    )
    gap = F.array_min(F.flatten(F.transform("years_a", lambda x: F.transform("years_b", lambda y: F.abs(x - y)))))
    year = F.when(gap.isNull(), 0.5).when(gap == 0, 1.0).when(gap == 1, 0.8).when(gap == 2, 0.3)
    journal = F.when((F.size("journals_a") == 0) | (F.size("journals_b") == 0), 0.5).when(
        F.exists("journals_a", lambda x: F.exists("journals_b", lambda y: (x == y) | F.startswith(x, y) | F.startswith(y, x))), 1.0
    ).otherwise(0.0)
    left = F.exists("pmids_a", lambda x: F.exists("pmids_b", lambda y: (F.length(x) >= 6) & (F.length(y) >= 6) & (F.abs(F.length(x) - F.length(y)) == 1) & (F.levenshtein(x, y) == 1)))
    rest = F.when(left, 0.05).otherwise(0.0) + F.when(F.arrays_overlap("dois_a", "dois_b"), 0.03).otherwise(0.0)
    scored = flat.withColumns({"year": year, "journal": journal, "rest": rest})
    conf = 0.55 * F.col("title") + 0.25 * F.coalesce("persons", F.lit(0.5)) + 0.12 * F.col("year") + 0.08 * F.col("journal") + F.col("rest")
    return (
        scored.where("year IS NOT NULL")
        .withColumn("conf", F.round(F.least(F.lit(1.0), conf), 6))
        .where(F.col("conf") >= THRESHOLD)
        .groupBy("e1", "e2")
        .agg(F.max("conf").alias("conf"), F.bool_or("same").alias("same"))
    )


def best_assignment(edges: list[tuple[str, str, float]]) -> list[tuple[str, str, float]]:
    """One-to-one edges (l, r, conf) of greatest total confidence, by shortest augmenting paths over the sparse edges."""
    conf: dict[tuple[str, str], float] = {}
    for l, r, c in edges:  # noqa: E741
        conf[l, r] = max(c, conf.get((l, r), c))
    lefts, rights = sorted({l for l, _ in conf}), sorted({r for _, r in conf})
    li, ri = {x: i for i, x in enumerate(lefts)}, {x: i for i, x in enumerate(rights)}
    top = max(1.0, *conf.values())
    # each left end may also stay alone, at a place of its own after all right ends
    cost: list[dict[int, int]] = [{len(rights) + i: round(top * 1e9)} for i in range(len(lefts))]
    for (l, r), c in conf.items():  # noqa: E741
        cost[li[l]][ri[r]] = round((top - c) * 1e9)
    price, owner, place = [0] * (len(rights) + len(lefts)), {}, {}
    for start in range(len(lefts)):
        dist, via, fixed = {}, {}, []
        heap, seen, at, base, own = [], set(), start, 0, 0
        while True:
            for j, c in cost[at].items():
                d = base + c - price[j] - own
                if j not in seen and d < dist.get(j, d + 1):
                    dist[j], via[j] = d, at
                    heapq.heappush(heap, (d, j))
            base, j = heapq.heappop(heap)
            while j in seen:
                base, j = heapq.heappop(heap)
            seen.add(j)
            if j not in owner:
                break
            fixed.append(j)
            at = owner[j]
            own = cost[at][j] - price[j]
        for k in fixed:
            price[k] += dist[k] - base
        while True:
            at = via[j]
            before = place.get(at)
            owner[j], place[at] = at, j
            if at == start:
                break
            j = before
    return [(lefts[i], rights[j], conf[lefts[i], rights[j]]) for i, j in sorted(place.items()) if j < len(rights)]


def assign(edges: DataFrame) -> DataFrame:
    """One-to-one pairs ``l, r, conf`` of greatest total confidence.

    Pairs that compete with none are taken at once; each connected component of the
    rest is solved exactly in one task.
    """
    e = cut(edges.select("l", "r", "conf"))
    left, right = e.groupBy("l").agg(F.count("*").alias("nl")), e.groupBy("r").agg(F.count("*").alias("nr"))
    marked = cut(e.join(left, "l").join(right, "r"))
    done = marked.where("nl = 1 AND nr = 1").select("l", "r", "conf")
    open_edges = cut(marked.where("nl > 1 OR nr > 1").select("l", "r", "conf"))
    parts = connected_components(open_edges.select(F.concat(F.lit("l|"), "l").alias("a"), F.concat(F.lit("r|"), "r").alias("b")))
    placed = open_edges.join(parts.where("node LIKE 'l|%'").select(F.expr("substring(node, 3)").alias("l"), "component"), "l")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(best_assignment(list(zip(rows["l"], rows["r"], rows["conf"], strict=True))), columns=["l", "r", "conf"])

    return done.unionByName(placed.groupBy("component").applyInPandas(run, "l string, r string, conf double"))


def match(pubmed: DataFrame, openalex: DataFrame, papers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, node to article, accepted entity pairs ``l, r, conf``)."""
    rows = cut(source_rows(pubmed, openalex, papers))
    ent = cut(entities(rows))
    recs = cut(profiles(rows, ent))
    lead, copies = collapse_copies(recs)
    pairs = cut(candidate_pairs(lead))
    kinds = recs.groupBy("entity").agg(F.max("has_d").alias("d"), F.max("has_p").alias("p"), F.max("has_a").alias("a"), F.max("only_o").alias("o"))
    both = pairs.select(F.col("e1").alias("l"), F.col("e2").alias("r"), "conf", "same").unionByName(pairs.select(F.col("e2").alias("l"), F.col("e1").alias("r"), "conf", "same"))
    full = cut(
        both.join(kinds.select(F.col("entity").alias("l"), F.col("d").alias("ld"), F.col("p").alias("lp"), F.col("a").alias("la"), F.col("o").alias("lo")), "l")
        .join(kinds.select(F.col("entity").alias("r"), F.col("d").alias("rd"), F.col("p").alias("rp"), F.col("a").alias("ra"), F.col("o").alias("ro")), "r")
    )
    one = assign(full.where("lp AND NOT ld AND rd AND NOT rp").select("l", "r", "conf"))
    free = full.where("NOT lp AND NOT ld")
    # a paper without a DOI is one article; what it joins must not hold another paper
    two = assign(free.where("la AND NOT ra AND (rd OR rp)").select("l", "r", "conf"))
    # works without any identifier may be several copies of one article: each to its best, and to the best of
    # those with an identifier or paper if one of its own title and authors is among them
    own = F.bool_or(F.expr("same AND (rd OR rp OR ra)")).over(Window.partitionBy("l"))
    pick = F.max(F.struct("conf", F.expr("struct(rd OR rp, ra)").alias("pref"), "r"))
    three = (
        free.where("lo").withColumn("own", own).where("NOT own OR rd OR rp OR ra")
        .groupBy("l").agg(pick.alias("b")).select("l", F.col("b.r").alias("r"), F.col("b.conf").alias("conf"))
    )
    accepted = cut(one.unionByName(two).unionByName(three).unionByName(copies))
    merged = connected_components(accepted.select("l", "r"))
    article = ent.join(merged.withColumnRenamed("node", "entity"), "entity", "left").select("node", "entity", F.coalesce("component", "entity").alias("article"))
    return rows, article, accepted


def untied_pairs(rows: DataFrame, article: DataFrame) -> DataFrame:
    """``key_a, key_b``: keys of different tables for one article that share no usable identifier.

    Keys of one article, table and set of identifiers are a class. Classes meet first, and only
    the keys of those that make pairs are joined, so no pair is made to be dropped.
    """
    members = rows.groupBy("node", "src", "key").agg(F.sort_array(F.collect_set("doi")).alias("ds"), F.sort_array(F.collect_set("pmid")).alias("ps")).join(article, "node")
    members = cut(members.select("article", "src", "key", "ds", "ps", F.xxhash64("article", "src", "ds", "ps").alias("c")))
    several = members.groupBy("article").agg(F.count_distinct("src").alias("n")).where("n > 1").select("article")
    classes = members.select("article", "src", "ds", "ps", "c").distinct().join(several, "article")
    x, y = classes.alias("x"), classes.alias("y")
    order = F.create_map(F.lit("P"), F.lit(0), F.lit("O"), F.lit(1), F.lit("A"), F.lit(2))
    apart = (
        x.join(y, F.col("x.article") == F.col("y.article"))
        .where((order[F.col("x.src")] < order[F.col("y.src")]) & ~F.arrays_overlap("x.ds", "y.ds") & ~F.arrays_overlap("x.ps", "y.ps"))
        .select(F.col("x.c").alias("ca"), F.col("y.c").alias("cb"))
    )
    keys = members.select("c", "key")
    return (
        apart.join(keys.select(F.col("c").alias("ca"), F.col("key").alias("a")), "ca")
        .join(keys.select(F.col("c").alias("cb"), F.col("key").alias("b")), "cb")
        .select(F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b"))
        .distinct()
    )

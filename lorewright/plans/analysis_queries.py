"""Queries of filters, joins, aggregations, windows, trees and question answering, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.functions import text as T
from lorewright.operators import classify as C
from lorewright.operators import coverage as V
from lorewright.operators import dedupe as D
from lorewright.operators import expansion as E
from lorewright.operators import hierarchy as H
from lorewright.operators import questions as Q
from lorewright.operators import ranking as RK
from lorewright.operators import relevance as R
from lorewright.operators import trees as TR
from lorewright.operators import validate as VA
from lorewright.plans.hierarchy_queries import _BASE
from lorewright.plans.text_queries import ANALYSIS, t
from lorewright.session import cut, table

QUERIES: dict = {}
SQL: dict = {}
QUESTIONS = [f"Q{i}" for i in range(1, 10)]
KEYWORDS = ["autophagy", "telomere", "mitochondrial", "senescence", "restriction"]


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


# filters and sorting


@query("flt_all_terms", "SELECT identifier FROM papers WHERE contains(lower(concat_ws(' ', title, full_text, abstract)), 'lifespan') AND contains(lower(concat_ws(' ', title, full_text, abstract)), 'drift')")
def flt_all_terms(spark, sf):
    return table(spark, sf, "papers").where(R.contains_all(F.concat_ws(" ", "title", "full_text", "abstract"), "Lifespan drift")).select("identifier")


@query("flt_min_citations", "SELECT identifier, coalesce(citation_count, 0) AS citations FROM papers WHERE coalesce(citation_count, 0) >= 10")
def flt_min_citations(spark, sf):
    c = F.coalesce("citation_count", F.lit(0))
    return table(spark, sf, "papers").where(c >= 10).select("identifier", c.alias("citations"))


_KW = "[" + ", ".join(f"'{k}'" for k in sorted(KEYWORDS)) + "]"
_HITS = ", ".join(f"list_filter({_KW}, lambda k: contains(lower(coalesce({c}, '')), k)) AS {n}" for c, n in (("title", "t"), ("abstract", "a"), ("full_text", "b")))
_SCORES = f"""SELECT identifier, round(least(1.0, (len(t) * 0.5 + len(a) * 0.3 + len(list_filter(b, lambda k: NOT list_contains(t, k) AND NOT list_contains(a, k))) * 0.2) / 5.0
  + len(list_filter({_KW}, lambda k: list_contains(t, k) OR list_contains(a, k) OR list_contains(b, k))) / 5.0 * 0.1), 9) AS score
FROM (SELECT identifier, {_HITS} FROM papers)"""


def _relevance(spark, sf):
    c = F.col
    return table(spark, sf, "papers").select("identifier", F.round(R.relevance_score(c("title"), c("abstract"), c("full_text"), KEYWORDS), 9).alias("score"))


@query("flt_relevance_score", _SCORES)
def flt_relevance_score(spark, sf):
    return _relevance(spark, sf)


@query(
    "flt_decisions",
    f"""WITH s AS ({_SCORES}), d AS (SELECT identifier, 0.3 AS old_score, true AS old, CASE WHEN citation_count > 5 THEN 0.2 ELSE 0.9 END AS old_threshold FROM papers WHERE is_review)
SELECT s.identifier, s.score, CASE WHEN old_threshold = 0.2 THEN old ELSE coalesce(old_score, score) >= 0.2 END AS accepted, old_score IS NOT NULL AS reused
FROM s LEFT JOIN d USING (identifier)""",
)
def flt_decisions(spark, sf):
    """Decisions stored for reviews, some at another threshold, met by a run at 0.2."""
    stored = table(spark, sf, "papers").where("is_review").select(
        "identifier", F.lit(0.3).alias("score"), F.lit(True).alias("accepted"), F.when(F.col("citation_count") > 5, 0.2).otherwise(0.9).alias("threshold")
    )
    return R.decide(_relevance(spark, sf), stored, 0.2)


@query(
    "flt_review_selection",
    """SELECT identifier, rank FROM (SELECT identifier, row_number() OVER (ORDER BY coalesce(citation_count, -1) DESC, lower(coalesce(title, '')), identifier) AS rank
FROM papers WHERE is_review AND lower(trim(source)) IN ('pubmed', 'openalex') AND coalesce(citation_count, 0) >= 5) WHERE rank <= 20""",
)
def flt_review_selection(spark, sf):
    """The top twenty reviews: a top-k report, taken by sort with limit."""
    p = table(spark, sf, "papers").where("is_review AND lower(trim(source)) IN ('pubmed', 'openalex') AND coalesce(citation_count, 0) >= 5")
    order = [F.coalesce("citation_count", F.lit(-1)).desc(), F.lower(F.coalesce("title", F.lit(""))), "identifier"]
    top = p.orderBy(*order).limit(20)
    from pyspark.sql import Window

    return top.select("identifier", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)).alias("rank"))


@query(
    "srt_retrieval_order",
    """SELECT source_, identifier, rank FROM (SELECT lower(trim(source)) AS source_, identifier, row_number() OVER (PARTITION BY lower(trim(source)) ORDER BY
CASE WHEN is_review THEN 0 WHEN NOT is_review THEN 1 ELSE 2 END, coalesce(citation_count, -1) DESC, lower(coalesce(title, '')), lower(identifier)) AS rank FROM papers)""",
)
def srt_retrieval_order(spark, sf):
    order = [F.when(F.col("is_review"), 0).when(~F.col("is_review"), 1).otherwise(2), F.coalesce("citation_count", F.lit(-1)).desc(), F.lower(F.coalesce("title", F.lit(""))), F.lower("identifier")]
    rows = table(spark, sf, "papers").select(F.lower(F.trim("source")).alias("source_"), "identifier", "title", "is_review", "citation_count")
    return RK.spread_rank(rows, ["source_"], order).select("source_", "identifier", (F.col("rank") + 1).cast("int").alias("rank"))


# classification


def _keywords(spark, sf):
    """Two keywords per theory: the first two words of its label."""
    return table(spark, sf, "aging_ontology").select(
        F.col("theory_id").alias("theory"), F.explode(F.slice(F.split(F.lower("label"), " "), 1, 2)).alias("keyword")
    )


def _scores(spark, sf):
    papers = table(spark, sf, "papers").select("identifier", F.concat_ws(" ", F.coalesce("title", F.lit("")), T.analysis_text()).alias("text"))
    return C.keyword_scores(papers, "identifier", "text", _keywords(spark, sf))


_KSC = f"""k AS (SELECT theory_id AS theory, unnest(string_split(lower(label), ' ')[1:2]) AS keyword FROM aging_ontology),
u AS (SELECT DISTINCT keyword FROM k),
p AS (SELECT identifier, lower(concat_ws(' ', coalesce(title, ''), {ANALYSIS})) AS text FROM papers),
h AS (SELECT identifier, keyword FROM p JOIN u ON contains(text, keyword)),
z AS (SELECT theory, count(*) AS size FROM k GROUP BY 1),
sc AS (SELECT h.identifier, k.theory, count(*) / max(z.size) AS score FROM h JOIN k USING (keyword) JOIN z ON z.theory = k.theory GROUP BY 1, 2)"""


@query("agg_keyword_scores", f"WITH {_KSC} SELECT identifier, theory, round(score, 6) AS score FROM sc")
def agg_keyword_scores(spark, sf):
    return _scores(spark, sf).withColumn("score", F.round("score", 6))


_BEST = """b AS (SELECT identifier, theory, score FROM (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY score DESC, theory) AS r FROM sc) WHERE r = 1)"""


def _best(spark, sf):
    return C.best_assignment(_scores(spark, sf).withColumn("depth", F.lit(1)), "identifier")


@query("win_best_assignment", f"WITH {_KSC}, {_BEST} SELECT identifier, theory, round(score, 6) AS score FROM b")
def win_best_assignment(spark, sf):
    return _best(spark, sf).select("identifier", "theory", F.round("score", 6).alias("score"))


@query("agg_theories", f"WITH {_KSC}, {_BEST} SELECT theory, array_to_string(list_sort(list(DISTINCT identifier)), ';') AS papers, count(DISTINCT identifier) AS n FROM b GROUP BY 1")
def agg_theories(spark, sf):
    return C.aggregate_theories(_best(spark, sf), "identifier").withColumn("papers", F.array_join("papers", ";"))


_CNT = "c AS (SELECT o.theory_id AS theory, coalesce(n, 0) AS n FROM aging_ontology o LEFT JOIN (SELECT theory, count(DISTINCT identifier) AS n FROM b GROUP BY 1) x ON x.theory = o.theory_id)"
_TGT = "CASE WHEN length(theory) % 4 = 0 THEN NULL ELSE length(theory) % 7 END"


def _counts(spark, sf):
    nodes = table(spark, sf, "aging_ontology").select(F.col("theory_id").alias("theory"), F.col("group_name").alias("parent"))
    return C.zero_filled(nodes, C.aggregate_theories(_best(spark, sf), "identifier").select("theory", "n"))


def _with_target(df):
    n = F.length("theory")
    return df.withColumn("target", F.when(n % 4 != 0, n % 7))


@query("agg_theory_counts", f"WITH {_KSC}, {_BEST}, {_CNT} SELECT theory, n FROM c")
def agg_theory_counts(spark, sf):
    return _counts(spark, sf).select("theory", "n")


@query("agg_coverage", f"WITH {_KSC}, {_BEST}, {_CNT} SELECT theory, n, CASE WHEN tg IS NULL THEN -1 ELSE greatest(0, tg - n) END AS deficit, coalesce(n >= tg, true) AS met FROM (SELECT *, {_TGT} AS tg FROM c)")
def agg_coverage(spark, sf):
    return V.coverage(_with_target(_counts(spark, sf))).select("theory", "n", F.coalesce("deficit", F.lit(-1)).alias("deficit"), "met")


@query(
    "agg_log_score",
    f"""WITH {_KSC}, {_BEST}, {_CNT} SELECT theory, n, round(log10(n), 6) AS contribution,
  round(CASE WHEN sum(log10(n)) OVER () > 0 THEN log10(n) / sum(log10(n)) OVER () ELSE 0.0 END, 6) AS share FROM c WHERE n > 0""",
)
def agg_log_score(spark, sf):
    return V.log_score(_counts(spark, sf).select("theory", "n")).select("theory", "n", F.round("contribution", 6).alias("contribution"), F.round("share", 6).alias("share"))


@query(
    "tree_roll_up",
    f"""WITH {_KSC}, g AS (SELECT theory_id, 'group:' || group_name AS parent FROM aging_ontology WHERE group_name IS NOT NULL)
SELECT identifier, theory, round(max(score), 6) AS score FROM (SELECT * FROM sc UNION ALL SELECT identifier, parent, score FROM sc JOIN g ON g.theory_id = sc.theory) GROUP BY 1, 2""",
)
def tree_roll_up(spark, sf):
    """Scores of theories passed up to their groups."""
    links = table(spark, sf, "aging_ontology").where("group_name IS NOT NULL").select(
        F.col("theory_id").alias("child"), F.concat(F.lit("group:"), "group_name").alias("ancestor"), F.lit(1).alias("distance")
    )
    return C.roll_up(_scores(spark, sf), "identifier", links, "full").withColumn("score", F.round("score", 6))


@query("srt_top_papers", f"WITH {_KSC} SELECT theory, identifier, rank FROM (SELECT theory, identifier, row_number() OVER (PARTITION BY theory ORDER BY score DESC, identifier) AS rank FROM sc) WHERE rank <= 3")
def srt_top_papers(spark, sf):
    """Three papers per theory: a top-k report."""
    return C.top_papers(_scores(spark, sf), "identifier", 3).select("theory", "identifier", "rank")


@query(
    "agg_sibling_imbalance",
    f"""WITH {_KSC}, {_BEST}, {_CNT}, l AS (SELECT o.group_name AS parent, c.theory, n, {_TGT.replace("theory", "c.theory")} AS tg FROM c JOIN aging_ontology o ON o.theory_id = c.theory),
w AS (SELECT parent, theory, CASE WHEN tg > 0 THEN n / tg ELSE CAST(n AS DOUBLE) END AS load FROM l),
m AS (SELECT a.parent, a.theory, a.load, median(b.load) AS med FROM w a JOIN w b ON a.parent = b.parent AND a.theory <> b.theory GROUP BY 1, 2, 3),
s AS (SELECT parent, stddev_pop(load) AS sd FROM w GROUP BY 1)
SELECT parent, theory, round(load - med, 6) AS delta FROM m JOIN s USING (parent)
WHERE load - med > CASE WHEN med = 0 THEN greatest(0.5, greatest(0.3, sd)) ELSE greatest(0.3, sd) END""",
)
def agg_sibling_imbalance(spark, sf):
    return V.sibling_imbalance(_with_target(_counts(spark, sf))).select("parent", "theory", F.round("delta", 6).alias("delta"))


@query(
    "win_queue_positions",
    f"""WITH {_KSC}, {_BEST}, {_CNT} SELECT parent, theory, row_number() OVER (PARTITION BY parent ORDER BY CASE WHEN tg > 0 THEN n / tg ELSE 0.0 END, theory) AS place
FROM (SELECT o.group_name AS parent, c.theory, n, {_TGT.replace("theory", "c.theory")} AS tg FROM c JOIN aging_ontology o ON o.theory_id = c.theory)""",
)
def win_queue_positions(spark, sf):
    return V.queue_positions(_with_target(_counts(spark, sf))).select("parent", "theory", "place")


# trees


def _resolved(spark, sf):
    return cut(H.resolve_hierarchy(table(spark, sf, "ontology_nodes")))


def _links(resolved):
    sound = resolved.where("depth IS NOT NULL")
    return sound.select(F.col("ontology_id").alias("tree"), F.col("name").alias("node"), F.when(F.col("depth") > 0, F.get("path", F.col("depth") - 1)).alias("parent"))


@query("tree_levels", _BASE + "SELECT ontology_id AS tree, depth, count(*) AS nodes FROM kinds WHERE depth IS NOT NULL GROUP BY 1, 2")
def tree_levels(spark, sf):
    return TR.levels(_resolved(spark, sf).withColumnRenamed("ontology_id", "tree"))


_CHILD = ", ch AS (SELECT ontology_id AS tree, name AS node, depth, names, CASE WHEN depth > 0 THEN names[depth] END AS parent FROM kinds WHERE depth IS NOT NULL)"


@query("tree_node_counts", _BASE + _CHILD + " SELECT tree, count(*) AS nodes, count(*) FILTER (NOT EXISTS (SELECT 1 FROM ch x WHERE x.tree = ch.tree AND x.parent = ch.node)) AS leaves FROM ch GROUP BY 1")
def tree_node_counts(spark, sf):
    return TR.node_counts(_links(_resolved(spark, sf)))


@query(
    "tree_child_summary",
    _BASE + _CHILD
    + """, leaf AS (SELECT tree, node, names FROM ch WHERE NOT EXISTS (SELECT 1 FROM ch x WHERE x.tree = ch.tree AND x.parent = ch.node)),
br AS (SELECT tree, a AS node, count(*) AS bl FROM (SELECT tree, unnest(names) AS a FROM leaf) GROUP BY 1, 2),
dc AS (SELECT tree, parent AS node, count(*) AS c FROM ch WHERE parent IS NOT NULL GROUP BY 1, 2)
SELECT ch.tree, ch.node, coalesce(c, 0) AS children, bl AS branch_leaves FROM ch JOIN br ON br.tree = ch.tree AND br.node = ch.node LEFT JOIN dc ON dc.tree = ch.tree AND dc.node = ch.node""",
)
def tree_child_summary(spark, sf):
    r = _resolved(spark, sf)
    closure = H.descendants(r).select(F.col("ontology_id").alias("tree"), F.col("name").alias("node"), "descendant", "distance")
    return TR.child_summary(_links(r), closure)


@query(
    "tree_balance",
    """WITH d AS (SELECT group_name AS parent, label AS node, length(label) AS weight, count(*) OVER (PARTITION BY group_name) AS size,
  row_number() OVER (PARTITION BY group_name ORDER BY length(label) DESC, lower(label), label) - 1 AS place FROM aging_ontology WHERE group_name IS NOT NULL),
s AS (SELECT *, CASE WHEN size > 7 THEN place % 7 ELSE place END AS slot FROM d),
m AS (SELECT *, CASE WHEN size > 7 THEN ceil((size - slot) / 7.0) ELSE 1 END AS many FROM s)
SELECT parent, node, CAST(slot AS INTEGER) AS slot, CASE WHEN many = 1 THEN node WHEN slot = 0 THEN 'Other' ELSE 'Other ' || (slot + 1) END AS group_name FROM m""",
)
def tree_balance(spark, sf):
    ch = table(spark, sf, "aging_ontology").where("group_name IS NOT NULL").select(F.col("group_name").alias("parent"), F.col("label").alias("node"), F.length("label").alias("weight"))
    return TR.balance_children(ch, 7).withColumn("slot", F.col("slot").cast("int"))


_ITEMS = """i AS (SELECT label AS owner, CAST(mention_id AS VARCHAR) AS item, min(mention_id) AS pos FROM theory_mentions WHERE label IS NOT NULL GROUP BY 1, 2),
q AS (SELECT *, count(*) OVER (PARTITION BY owner) AS n, row_number() OVER (PARTITION BY owner ORDER BY pos, item) - 1 AS place FROM i)"""


def _items(spark, sf):
    return table(spark, sf, "theory_mentions").where("label IS NOT NULL").groupBy(
        F.col("label").alias("owner"), F.col("mention_id").cast("string").alias("item")
    ).agg(F.min("mention_id").alias("pos"))


@query(
    "tree_split_oversized",
    f"""WITH {_ITEMS} SELECT owner, item, CAST(1 + CASE WHEN n <= 5 THEN 0 WHEN floor(place / 4) = floor((n - 1) / 4) AND n - floor((n - 1) / 4) * 4 < 3 AND floor((n - 1) / 4) > 0
  THEN floor((n - 1) / 4) - 1 ELSE floor(place / 4) END AS INTEGER) AS chunk FROM q""",
)
def tree_split_oversized(spark, sf):
    return TR.split_oversized(_items(spark, sf), most=5, target=4, least=3)


@query("tree_limit_group", f"WITH {_ITEMS} SELECT item, CASE WHEN place < 6 THEN owner ELSE owner || ' (auto-split ' || CAST(floor(place / 6) + 1 AS INTEGER) || ')' END AS owner FROM q")
def tree_limit_group(spark, sf):
    return TR.limit_group(_items(spark, sf), 6)


@query("tree_merge_paths", "SELECT label AS path, sum(citation_count) AS citations, count(DISTINCT paper_id) AS reviews FROM theory_mentions m JOIN papers p ON p.identifier = m.paper_id WHERE label IS NOT NULL GROUP BY 1")
def tree_merge_paths(spark, sf):
    m = table(spark, sf, "theory_mentions").where("label IS NOT NULL").join(
        table(spark, sf, "papers").select(F.col("identifier").alias("paper_id"), "citation_count"), "paper_id"
    )
    return TR.merge_paths(m.select(F.col("label").alias("path"), F.col("citation_count").alias("citations"), F.col("paper_id").alias("review")))


_PLACED = "pl AS (SELECT coalesce(source, 'none') AS grp, label AS theory_id, mention_id AS ordinal FROM theory_mentions m LEFT JOIN papers p ON p.identifier = m.paper_id WHERE label IS NOT NULL), rg AS (SELECT DISTINCT label AS theory_id FROM aging_ontology)"


@query(
    "tree_reconcile",
    f"""WITH {_PLACED} SELECT reason, count(*) AS n, count(DISTINCT theory_id) AS theories FROM (
SELECT theory_id, CASE WHEN theory_id NOT IN (SELECT theory_id FROM rg) THEN 'unknown' WHEN row_number() OVER (PARTITION BY theory_id ORDER BY ordinal, grp) > 1 THEN 'duplicate' ELSE 'kept' END AS reason FROM pl
UNION ALL SELECT theory_id, 'added' FROM rg WHERE theory_id NOT IN (SELECT theory_id FROM pl)) GROUP BY 1""",
)
def tree_reconcile(spark, sf):
    m = table(spark, sf, "theory_mentions").where("label IS NOT NULL").join(
        table(spark, sf, "papers").select(F.col("identifier").alias("paper_id"), "source"), "paper_id", "left"
    )
    placed = m.select(F.coalesce("source", F.lit("none")).alias("grp"), F.col("label").alias("theory_id"), F.col("mention_id").alias("ordinal"))
    reg = table(spark, sf, "aging_ontology").select(F.col("label").alias("theory_id"))
    return TR.reconcile(placed, reg).groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("theory_id").alias("theories"))


@query(
    "join_membership_changes",
    """WITH a AS (SELECT DISTINCT doi AS owner, pmid AS item FROM pubmed_records WHERE doi IS NOT NULL AND pmid IS NOT NULL),
b AS (SELECT DISTINCT doi AS owner, pmid AS item FROM openalex_records WHERE doi IS NOT NULL AND pmid IS NOT NULL)
SELECT owner, item, 'added' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT owner, item, 'removed' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def join_membership_changes(spark, sf):
    pick = lambda n: table(spark, sf, n).where("doi IS NOT NULL AND pmid IS NOT NULL").select(F.col("doi").alias("owner"), F.col("pmid").alias("item"))
    return TR.membership_changes(pick("pubmed_records"), pick("openalex_records"))


# records


@query(
    "join_linked_groups",
    """WITH RECURSIVE k AS (SELECT rec_id AS id, 'p:' || pmid AS k FROM pubmed_records UNION SELECT rec_id, 'd:' || lower(trim(doi)) FROM pubmed_records WHERE length(trim(doi)) > 8),
e AS (SELECT DISTINCT a.id AS x, b.id AS y FROM k a JOIN k b USING (k)),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT x AS id, min(y) AS "group" FROM r GROUP BY 1""",
)
def join_linked_groups(spark, sf):
    r = table(spark, sf, "pubmed_records")
    d = r.where(F.length(F.trim("doi")) > 8).select(F.col("rec_id").alias("id"), F.concat(F.lit("d:"), F.lower(F.trim("doi"))).alias("k"))
    return D.linked_groups(r.select(F.col("rec_id").alias("id"), F.concat(F.lit("p:"), "pmid").alias("k")).unionByName(d).distinct())


@query(
    "win_merge_records",
    """SELECT pmid, (list(title ORDER BY rec_id) FILTER (trim(title) <> ''))[1] AS title, (list(journal ORDER BY rec_id) FILTER (trim(journal) <> ''))[1] AS journal,
  (list(doi ORDER BY rec_id) FILTER (trim(doi) <> ''))[1] AS doi FROM pubmed_records GROUP BY 1""",
)
def win_merge_records(spark, sf):
    return D.merge_records(table(spark, sf, "pubmed_records"), "pmid", "rec_id", ["title", "journal", "doi"], [])


@query(
    "win_merge_lists",
    """WITH x AS (SELECT pmid, rec_id, sources, unnest(range(1, len(sources) + 1)) AS i FROM pubmed_records WHERE sources IS NOT NULL),
y AS (SELECT pmid, sources[i] AS s, row_number() OVER (PARTITION BY pmid, sources[i] ORDER BY rec_id, i) AS r FROM x WHERE trim(sources[i]) <> '')
SELECT pmid, s FROM y WHERE r = 1""",
)
def win_merge_lists(spark, sf):
    return D.merge_records(table(spark, sf, "pubmed_records"), "pmid", "rec_id", [], ["sources"]).select("pmid", F.explode("sources").alias("s"))


@query(
    "win_first_per_key",
    "SELECT openalex_id, rec_id FROM (SELECT openalex_id, rec_id, row_number() OVER (PARTITION BY openalex_id ORDER BY harvested_at NULLS FIRST, rec_id) AS r FROM openalex_records) WHERE r = 1",
)
def win_first_per_key(spark, sf):
    return D.first_per_key(table(spark, sf, "openalex_records"), ["openalex_id"], ["harvested_at", "rec_id"]).select("openalex_id", "rec_id")


@query(
    "win_numbered_slugs",
    """WITH s AS (SELECT theory_id, lower(split_part(label, ' ', 1)) AS slug FROM aging_ontology)
SELECT theory_id, CASE WHEN r = 1 THEN slug ELSE slug || '-' || r END AS slug_id FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY theory_id) AS r FROM s)""",
)
def win_numbered_slugs(spark, sf):
    s = table(spark, sf, "aging_ontology").select("theory_id", F.lower(F.substring_index("label", " ", 1)).alias("slug"))
    return D.numbered_slugs(s, "slug", ["theory_id"]).select("theory_id", "slug_id")


@query("inc_fresh_records", "SELECT rec_id FROM openalex_records WHERE pmid IS NULL OR pmid NOT IN (SELECT pmid FROM pubmed_records)")
def inc_fresh_records(spark, sf):
    return D.fresh(table(spark, sf, "openalex_records"), table(spark, sf, "pubmed_records"), ["pmid"]).select("rec_id")


@query(
    "inc_merge_failures",
    """WITH o AS (SELECT pmid AS k, min(rec_id) AS n FROM pubmed_records WHERE abstract IS NULL GROUP BY 1), w AS (SELECT pmid AS k, min(rec_id) AS n FROM openalex_records WHERE abstract IS NULL AND pmid IS NOT NULL GROUP BY 1)
SELECT k, coalesce(w.n, o.n) AS ts, CASE WHEN w.n IS NULL THEN 'old' ELSE 'new' END AS reason FROM o FULL JOIN w USING (k) WHERE k NOT IN (SELECT pmid FROM pubmed_records WHERE abstract IS NOT NULL)""",
)
def inc_merge_failures(spark, sf):
    """Records without an abstract as failures, dropped where a later one of the article has it."""
    p, o = table(spark, sf, "pubmed_records"), table(spark, sf, "openalex_records")
    log = lambda df, why: df.where("abstract IS NULL AND pmid IS NOT NULL").groupBy(F.col("pmid").alias("k")).agg(F.min("rec_id").alias("ts")).select("k", F.lit(why).alias("reason"), "ts")
    return D.merge_failures(log(p, "old"), log(o, "new"), p.where("abstract IS NOT NULL").select(F.col("pmid").alias("k")))


@query(
    "inc_overlay",
    """WITH a AS (SELECT pmid, max(journal) AS journal, max(publication_year) AS publication_year FROM pubmed_records GROUP BY 1),
b AS (SELECT pmid, max(journal) AS journal, max(publication_year) AS publication_year FROM openalex_records WHERE pmid IS NOT NULL GROUP BY 1)
SELECT pmid, coalesce(b.journal, a.journal) AS journal, coalesce(b.publication_year, a.publication_year) AS publication_year FROM a FULL JOIN b USING (pmid)""",
)
def inc_overlay(spark, sf):
    g = lambda n: table(spark, sf, n).where("pmid IS NOT NULL").groupBy("pmid").agg(F.max("journal").alias("journal"), F.max("publication_year").alias("publication_year"))
    return D.overlay(g("pubmed_records"), g("openalex_records"), "pmid")


# answers


def _answers(spark, sf):
    a = table(spark, sf, "question_answers")
    conf = F.when(F.isnan("confidence"), None).otherwise(F.col("confidence"))
    return a.select("paper_id", "question_id", "answer", conf.alias("confidence"), F.col("answer_id").alias("ordinal"), "loaded_at")


_ANS = "a AS (SELECT paper_id, question_id, answer, CASE WHEN isnan(confidence) THEN NULL ELSE confidence END AS confidence, answer_id, loaded_at FROM question_answers)"
_BESTA = """ba AS (SELECT paper_id, question_id, answer, confidence FROM (SELECT *, row_number() OVER (PARTITION BY paper_id, question_id
  ORDER BY coalesce(confidence, -1.0) DESC, answer_id, loaded_at) AS r FROM a) WHERE r = 1)"""


@query("win_best_answer", f"WITH {_ANS}, {_BESTA} SELECT paper_id, question_id, answer, confidence FROM ba")
def win_best_answer(spark, sf):
    return VA.best_answers(_answers(spark, sf))


_WIDE = ", ".join(f"coalesce(max(answer) FILTER (question_id = '{q}'), '') AS {q}" for q in QUESTIONS)
_WIDEC = ", ".join(f"max(confidence) FILTER (question_id = '{q}') AS {q}_confidence" for q in QUESTIONS)


@query("snk_wide_questions", f"WITH {_ANS}, {_BESTA} SELECT paper_id, {_WIDE}, {_WIDEC} FROM ba GROUP BY 1")
def snk_wide_questions(spark, sf):
    return VA.wide_answers(VA.best_answers(_answers(spark, sf)), QUESTIONS)


_METR = f"""m AS (SELECT question_id, count(*) FILTER (coalesce(trim(answer, ' '), '') <> '') AS answered, count(*) FILTER (coalesce(trim(answer, ' '), '') = '') AS blanks,
  count(*) FILTER (starts_with(lower(ltrim(answer, ' ')), 'yes')) AS yes_count, avg(confidence) AS avg_confidence, min(confidence) AS min_confidence FROM a GROUP BY 1)"""


@query("agg_question_metrics", f"WITH {_ANS}, {_METR} SELECT question_id, answered, blanks, yes_count, round(avg_confidence, 6) AS avg_confidence, round(min_confidence, 6) AS min_confidence FROM m")
def agg_question_metrics(spark, sf):
    m = VA.question_metrics(_answers(spark, sf))
    return m.withColumn("avg_confidence", F.round("avg_confidence", 6)).withColumn("min_confidence", F.round("min_confidence", 6))


@query(
    "agg_alerts",
    f"""WITH {_ANS}, {_METR} SELECT question_id, CASE WHEN avg_confidence < 0.6 THEN 'low_average' ELSE 'low_minimum' END AS alert FROM m WHERE avg_confidence < 0.6 OR min_confidence < 0.6
UNION ALL SELECT question_id, 'blanks' FROM m WHERE blanks > 0 UNION ALL SELECT question_id, 'no_responses' FROM m WHERE answered = 0""",
)
def agg_alerts(spark, sf):
    return VA.alerts(VA.question_metrics(_answers(spark, sf)), 0.6)


_TRUTH = f"""fa AS (SELECT 't' || (length(paper_id) % 3) AS theory, paper_id, question_id, answer FROM ba),
tr AS (SELECT CASE WHEN question_id IN ('Q1', 'Q2', 'Q3') THEN 't' || (length(paper_id) % 3) END AS theory, paper_id, question_id, CASE WHEN contains(answer, 'a') THEN answer ELSE 'x' END AS expected FROM ba WHERE paper_id IS NOT NULL),
st AS (SELECT coalesce(tr.theory, fp.theory) AS theory, tr.paper_id, tr.question_id, expected, fa.answer AS found FROM tr LEFT JOIN (SELECT paper_id, min(theory) AS theory FROM fa GROUP BY 1) fp ON tr.theory IS NULL AND fp.paper_id = tr.paper_id
  LEFT JOIN fa ON fa.theory = coalesce(tr.theory, fp.theory) AND fa.paper_id = tr.paper_id AND fa.question_id = tr.question_id),
vr AS (SELECT *, CASE WHEN found IS NULL THEN 'missing' WHEN found = expected THEN 'ok' ELSE 'mismatch' END AS status FROM st)"""


def _validation(spark, sf):
    best = VA.best_answers(_answers(spark, sf)).withColumn("theory", F.concat(F.lit("t"), (F.length("paper_id") % 3).cast("string")))
    truth = best.where("paper_id IS NOT NULL").select(
        F.when(F.col("question_id").isin("Q1", "Q2", "Q3"), F.col("theory")).alias("theory"), "paper_id", "question_id",
        F.when(F.contains("answer", F.lit("a")), F.col("answer")).otherwise("x").alias("expected"),
    )
    return VA.validation_rows(truth, best.select("theory", "paper_id", "question_id", "answer"))


@query("join_validation_rows", f"WITH {_ANS}, {_BESTA}, {_TRUTH} SELECT theory, paper_id, question_id, status FROM vr")
def join_validation_rows(spark, sf):
    return _validation(spark, sf).select("theory", "paper_id", "question_id", "status")


@query(
    "agg_validation_metrics",
    f"""WITH {_ANS}, {_BESTA}, {_TRUTH} SELECT coalesce(theory, 'all') AS theory, count(*) AS expected, count(*) FILTER (status <> 'missing') AS found, count(*) FILTER (status = 'ok') AS correct,
  round(count(*) FILTER (status <> 'missing') / count(*), 6) AS recall, round(CASE WHEN count(*) FILTER (status <> 'missing') > 0 THEN count(*) FILTER (status = 'ok') / count(*) FILTER (status <> 'missing') ELSE 0 END, 6) AS accuracy
FROM vr GROUP BY ROLLUP (theory)""",
)
def agg_validation_metrics(spark, sf):
    m = VA.validation_metrics(_validation(spark, sf))
    return m.select(
        F.coalesce("theory", F.lit("all")).alias("theory"), "expected", "found", "correct", F.round("recall", 6).alias("recall"), F.round("accuracy", 6).alias("accuracy")
    )


_QA = f"WITH p AS (SELECT identifier, list_filter(list_transform(string_split(replace(concat_ws(chr(10), coalesce(title, ''), {ANALYSIS}), chr(10), ' '), '.'), lambda x: {t('x')}), lambda x: x <> '') AS ss FROM papers) " + " UNION ALL ".join(
    f"SELECT identifier, '{r[0]}' AS question_id, {Q.sql('ss', r)[1]} AS answer, CAST({Q.sql('ss', r)[2]} AS DOUBLE) AS confidence, {Q.sql('ss', r)[0]} AS evidence FROM p" for r in Q.RULES
)


@query("qa_answers", _QA)
def qa_answers(spark, sf):
    return Q.answer_papers(table(spark, sf, "papers"))


@query("qa_combined")
def qa_combined(spark, sf):
    """Heuristic answers of papers combined with the stored ones of the same paper and question."""
    allowed = sorted({x[2] for r in Q.RULES for x in r[2]} | {r[3] for r in Q.RULES})
    h = Q.answer_papers(table(spark, sf, "papers")).withColumnRenamed("identifier", "paper_id")
    m = VA.best_answers(_answers(spark, sf)).select("paper_id", "question_id", F.col("answer").alias("model"), F.col("confidence").alias("m"))
    a, c = Q.combine(F.col("answer"), F.col("confidence"), F.col("model"), F.col("m"), allowed, ["not sure", "unclear"])
    return h.join(m, ["paper_id", "question_id"], "left").select("paper_id", "question_id", a.alias("final"), F.round(c, 6).alias("final_confidence"))


# terms and queries


@query(
    "agg_term_frequency",
    """WITH w AS (SELECT lang, doc_id, regexp_extract_all(lower(text), '[a-z0-9]{2,}') AS ws FROM documents),
e AS (SELECT lang, doc_id, i, ws[i] AS term FROM (SELECT lang, doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
c AS (SELECT lang, term, count(*) AS n, min((doc_id, i)) AS f FROM e GROUP BY 1, 2)
SELECT lang, term, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, f) AS rank FROM c) WHERE rank <= 10""",
)
def agg_term_frequency(spark, sf):
    """Ten terms per language: a top-k report."""
    return E.term_frequency(table(spark, sf, "documents"), "lang", "doc_id", "text", 10)


@query(
    "agg_tfidf_terms",
    """WITH e AS (SELECT lower(trim(source)) AS src, identifier, unnest(regexp_extract_all(lower(title), '[a-z0-9]{2,}')) AS term FROM papers WHERE source IS NOT NULL),
tf AS (SELECT src, identifier, term, count(*) AS tf FROM e WHERE term NOT IN ('the', 'and', 'of', 'in', 'to') GROUP BY 1, 2, 3),
n AS (SELECT src, count(DISTINCT identifier) AS n FROM tf GROUP BY 1), df AS (SELECT src, term, count(*) AS df FROM tf GROUP BY 1, 2),
w AS (SELECT tf.src, identifier, tf.term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN n USING (src) JOIN df ON df.src = tf.src AND df.term = tf.term),
nm AS (SELECT src, identifier, sqrt(sum(w * w)) AS nm FROM w GROUP BY 1, 2),
s AS (SELECT w.src, term, round(sum(w / nm), 6) AS weight FROM w JOIN nm ON nm.src = w.src AND nm.identifier = w.identifier GROUP BY 1, 2)
SELECT src, term, round(weight, 4) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY weight DESC, term) AS r FROM s) WHERE r <= 5""",
)
def agg_tfidf_terms(spark, sf):
    """Five terms per source: a top-k report."""
    p = table(spark, sf, "papers").where("source IS NOT NULL").withColumn("src", F.lower(F.trim("source")))
    return E.tfidf_terms(p, "src", "identifier", "title", ["the", "and", "of", "in", "to"], 5).select("src", "term", F.round("weight", 4).alias("weight"))


_EV = "ev AS (SELECT event_type AS node, CAST(user_id % 50 AS VARCHAR) AS query, CAST(floor(value) AS BIGINT) % 4 AS new_unique FROM events)"


def _events(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("node"), (F.col("user_id") % 50).cast("string").alias("query"), (F.floor("value") % 4).alias("new_unique")
    )


_QP = f"{_EV}, qp AS (SELECT node, query, count(*) AS attempts, count(*) FILTER (new_unique > 0) AS successes, CAST(sum(greatest(new_unique, 0)) AS BIGINT) AS new_total FROM ev GROUP BY 1, 2)"


@query("agg_query_performance", f"WITH {_QP} SELECT * FROM qp")
def agg_query_performance(spark, sf):
    return E.query_performance(_events(spark, sf))


@query("flt_consistent_queries", f"WITH {_QP} SELECT node, query FROM qp WHERE successes >= 2 AND new_total >= 3 AND successes / attempts >= 0.6")
def flt_consistent_queries(spark, sf):
    return E.consistent_queries(E.query_performance(_events(spark, sf))).select("node", "query")


@query(
    "agg_article_index",
    """SELECT paper_id, array_to_string(list_sort(list(DISTINCT label)), '|') AS labels, count(DISTINCT label) AS n FROM theory_mentions WHERE label IS NOT NULL AND paper_id IS NOT NULL GROUP BY 1""",
)
def agg_article_index(spark, sf):
    m = table(spark, sf, "theory_mentions").where("label IS NOT NULL AND paper_id IS NOT NULL")
    return m.groupBy("paper_id").agg(F.array_join(F.array_sort(F.collect_set("label")), "|").alias("labels"), F.count_distinct("label").alias("n"))


@query(
    "agg_registry_summary",
    """SELECT label, n, rank FROM (SELECT label, count(DISTINCT paper_id) AS n, row_number() OVER (ORDER BY count(DISTINCT paper_id) DESC, lower(label), label) AS rank FROM theory_mentions WHERE label IS NOT NULL GROUP BY 1) WHERE rank <= 25""",
)
def agg_registry_summary(spark, sf):
    """The 25 most supported labels: a top-k report, sorted with limit."""
    from pyspark.sql import Window

    order = [F.desc("n"), F.lower("label"), F.col("label")]
    top = table(spark, sf, "theory_mentions").where("label IS NOT NULL").groupBy("label").agg(F.count_distinct("paper_id").alias("n")).orderBy(*order).limit(25)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)))


@query("join_theory_papers", "SELECT m.label, p.identifier, p.title, p.year FROM (SELECT DISTINCT label, paper_id FROM theory_mentions WHERE label IS NOT NULL) m JOIN papers p ON p.identifier = m.paper_id")
def join_theory_papers(spark, sf):
    m = table(spark, sf, "theory_mentions").where("label IS NOT NULL").select("label", F.col("paper_id").alias("identifier")).distinct()
    return m.join(table(spark, sf, "papers").select("identifier", "title", "year"), "identifier").select("label", "identifier", "title", "year")


@query("join_unplaced", "SELECT theory_id FROM aging_ontology WHERE label NOT IN (SELECT label FROM theory_mentions WHERE label IS NOT NULL)")
def join_unplaced(spark, sf):
    m = table(spark, sf, "theory_mentions").select("label").distinct()
    return table(spark, sf, "aging_ontology").join(m, "label", "left_anti").select("theory_id")


@query(
    "set_node_difference",
    """SELECT name, side FROM (SELECT DISTINCT name, 'ontology' AS side FROM ontology_nodes WHERE name NOT IN (SELECT parent FROM ontology_nodes WHERE parent IS NOT NULL)
UNION ALL SELECT DISTINCT parent, 'parents' FROM ontology_nodes WHERE parent IS NOT NULL AND parent NOT IN (SELECT name FROM ontology_nodes))""",
)
def set_node_difference(spark, sf):
    n = table(spark, sf, "ontology_nodes")
    a, b = n.select("name"), n.where("parent IS NOT NULL").select(F.col("parent").alias("name"))
    return a.subtract(b).withColumn("side", F.lit("ontology")).unionByName(b.subtract(a).withColumn("side", F.lit("parents")))

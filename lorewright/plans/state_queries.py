"""Queries of payload expressions and bookkeeping operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.functions import payload as PL
from lorewright.functions import text as T
from lorewright.operators import bookkeeping as B
from lorewright.operators import bootstrap as BS
from lorewright.operators import coverage as V
from lorewright.operators import relevance as R
from lorewright.plans.text_queries import ANALYSIS, t
from lorewright.session import table

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


_CIT = r"CAST(nullif(regexp_extract({}, '(?i)citations?\s*[:=]\s*([0-9]{{1,9}})', 1), '') AS INTEGER)"


@query("fn_citation_count", f"SELECT identifier, coalesce(citation_count, {_CIT.format('abstract')}, {_CIT.format('full_text')}, 0) AS n FROM papers")
def fn_citation_count(spark, sf):
    c = F.col
    return table(spark, sf, "papers").select("identifier", PL.citation_count(F.lit(None).cast("int"), c("citation_count"), c("abstract"), c("full_text")).alias("n"))


@query("fn_confidence_text")
def fn_confidence_text(spark, sf):
    """Engines round halves differently, so there is no SQL twin; tested on literals."""
    v = T.confidence_of(F.col("confidence"))
    return table(spark, sf, "question_answers").select("answer_id", "loaded_at", PL.confidence_text(v).alias("shown"))


@query("fn_fill_template", "SELECT theory_id, 'aging AND ' || label || ' in ' || coalesce(group_name, '') || ' ' AS q FROM aging_ontology")
def fn_fill_template(spark, sf):
    q = PL.fill_template(F.lit("aging AND {theory} in {group} {missing}"), {"theory": F.col("label"), "group": F.col("group_name")})
    return table(spark, sf, "aging_ontology").select("theory_id", q.alias("q"))


@query("fn_excerpt", "SELECT identifier, md5(CASE WHEN length(full_text) > 4000 THEN left(full_text, 4000) || '...' ELSE full_text END) AS digest FROM papers")
def fn_excerpt(spark, sf):
    return table(spark, sf, "papers").select("identifier", F.md5(PL.excerpt(F.col("full_text"))).alias("digest"))


@query(
    "fn_keyword_line",
    f"""WITH w AS (SELECT identifier, i, {t("authors[i]")} AS a FROM (SELECT identifier, authors, unnest(range(1, len(authors) + 1)) AS i FROM papers WHERE authors IS NOT NULL)),
d AS (SELECT *, row_number() OVER (PARTITION BY identifier, lower(a) ORDER BY i) AS r FROM w WHERE a <> ''),
k AS (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY i) AS place FROM d WHERE r = 1)
SELECT identifier, string_agg(a, ', ' ORDER BY i) AS line FROM k WHERE place <= 5 GROUP BY 1""",
)
def fn_keyword_line(spark, sf):
    line = PL.keyword_line(F.col("authors"))
    return table(spark, sf, "papers").where("authors IS NOT NULL").select("identifier", line.alias("line")).where("line <> ''")


_SENT = f"list_filter(list_transform(string_split(replace(abstract, chr(10), ' '), '.'), lambda x: {t('x')}), lambda x: x <> '')"


@query(
    "win_evidence_sentences",
    f"""WITH s AS (SELECT rec_id, {_SENT} AS ss FROM pubmed_records WHERE abstract IS NOT NULL),
c AS (SELECT rec_id, ss, list_filter(ss, lambda x: contains(lower(x), 'lifespan') OR contains(lower(x), 'survival')) AS k FROM s),
p AS (SELECT rec_id, CASE WHEN len(k) > 0 THEN k ELSE ss END AS l FROM c),
e AS (SELECT rec_id, i, l[i] AS x FROM (SELECT rec_id, l, unnest(range(1, len(l) + 1)) AS i FROM p)),
d AS (SELECT *, row_number() OVER (PARTITION BY rec_id, x ORDER BY i) AS r FROM e), f AS (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY i) AS place FROM d WHERE r = 1)
SELECT rec_id, x AS sentence, CAST(place - 1 AS INTEGER) AS pos FROM f WHERE place <= 3""",
)
def win_evidence_sentences(spark, sf):
    """Up to three sentences a record are its evidence."""
    ev = PL.evidence_sentences(F.lit(None).cast("string"), T.sentences("abstract"), ["lifespan", "survival"], 3)
    return table(spark, sf, "pubmed_records").where("abstract IS NOT NULL").select("rec_id", F.posexplode(ev).alias("pos", "sentence"))


@query(
    "agg_prediction_scores",
    "SELECT m.paper_id AS id, o.label AS theory, max(score) AS score FROM theory_mentions m JOIN aging_ontology o ON lower(trim(m.label)) = lower(trim(o.label)) WHERE m.paper_id IS NOT NULL GROUP BY 1, 2",
)
def agg_prediction_scores(spark, sf):
    p = table(spark, sf, "theory_mentions").where("paper_id IS NOT NULL").select(F.col("paper_id").alias("id"), "label", F.col("score").alias("confidence"))
    return B.prediction_scores(p, table(spark, sf, "aging_ontology").select(F.col("label").alias("theory")))


@query(
    "win_new_unique",
    """SELECT journal AS provider, count(DISTINCT CASE WHEN pmid NOT IN (SELECT pmid FROM pubmed_records) THEN pmid END) AS new_unique
FROM openalex_records WHERE pmid IS NOT NULL GROUP BY 1""",
)
def win_new_unique(spark, sf):
    found = table(spark, sf, "openalex_records").where("pmid IS NOT NULL").select(F.col("journal").alias("provider"), F.col("pmid").alias("id"))
    return B.new_unique(found, table(spark, sf, "pubmed_records").select(F.col("pmid").alias("id")))


@query(
    "agg_alias_union",
    """WITH f AS (SELECT paper_id, label, mention_id, row_number() OVER (PARTITION BY paper_id, lower(label) ORDER BY mention_id, loaded_at) AS r FROM theory_mentions WHERE paper_id IS NOT NULL AND trim(label, ' ') <> '')
SELECT paper_id AS article, string_agg(label, '|' ORDER BY mention_id) AS aliases FROM f WHERE r = 1 GROUP BY 1""",
)
def agg_alias_union(spark, sf):
    m = table(spark, sf, "theory_mentions").where("paper_id IS NOT NULL").select(
        F.col("paper_id").alias("article"), F.lit("all").alias("theory"), F.col("mention_id").alias("chunk"), F.unix_micros(F.col("loaded_at").cast("timestamp")).alias("pos"), F.col("label").alias("alias")
    )
    return B.alias_union(m).select("article", F.array_join("aliases", "|").alias("aliases"))


@query(
    "agg_group_summary",
    """WITH j AS (SELECT o.group_name AS grp, o.label AS theory, m.paper_id AS article FROM aging_ontology o JOIN theory_mentions m ON m.label = o.label WHERE m.paper_id IS NOT NULL AND o.group_name IS NOT NULL),
c AS (SELECT grp, count(DISTINCT article) AS articles FROM j GROUP BY 1),
e AS (SELECT grp, theory, array_to_string(list_sort(list(DISTINCT article))[1:5], ';') AS shown, row_number() OVER (PARTITION BY grp ORDER BY theory) AS r FROM j GROUP BY 1, 2)
SELECT grp, theory, shown, articles FROM e JOIN c USING (grp) WHERE r <= 5""",
)
def agg_group_summary(spark, sf):
    """Five theories a group and five articles a theory: a report."""
    g = table(spark, sf, "aging_ontology").where("group_name IS NOT NULL").select(F.col("group_name").alias("grp"), F.col("label").alias("theory"))
    a = table(spark, sf, "theory_mentions").where("paper_id IS NOT NULL").select(F.col("label").alias("theory"), F.col("paper_id").alias("article"))
    return B.group_summary(g, a).withColumn("shown", F.array_join("shown", ";"))


@query(
    "agg_additive_merge",
    """WITH x AS (SELECT lower(trim(source)) AS theory, coalesce(citation_count, 0) AS c, identifier FROM papers WHERE source IS NOT NULL)
SELECT theory, CAST(sum(c) AS BIGINT) AS citations, count(DISTINCT identifier) AS reviews FROM x GROUP BY 1""",
)
def agg_additive_merge(spark, sf):
    """Reviews and other papers of each source merged."""
    p = table(spark, sf, "papers").where("source IS NOT NULL").withColumn("theory", F.lower(F.trim("source")))
    part = lambda cond: p.where(cond).groupBy("theory").agg(F.sum(F.coalesce("citation_count", F.lit(0))).alias("citations"), F.collect_set("identifier").alias("reviews"))
    return B.additive_merge(part("is_review"), part("is_review IS NULL OR NOT is_review")).withColumn("reviews", F.size("reviews").cast("bigint"))


@query(
    "join_representatives",
    """WITH a AS (SELECT label AS theory, list_sort(list(DISTINCT paper_id)) AS l FROM theory_mentions WHERE label IS NOT NULL AND paper_id IS NOT NULL GROUP BY 1),
e AS (SELECT theory, CAST(i - 1 AS INTEGER) AS pos, l[i] AS article FROM (SELECT theory, l, unnest(range(1, least(len(l), 3) + 1)) AS i FROM a))
SELECT theory, pos, article, coalesce(p.title, article) AS title FROM e LEFT JOIN papers p ON p.identifier = e.article""",
)
def join_representatives(spark, sf):
    """Three articles a theory: a report."""
    m = table(spark, sf, "theory_mentions").where("label IS NOT NULL AND paper_id IS NOT NULL")
    th = m.groupBy(F.col("label").alias("theory")).agg(F.array_sort(F.collect_set("paper_id")).alias("articles"))
    return B.representative_articles(th, table(spark, sf, "papers").select(F.col("identifier").alias("article"), "title"), 3)


@query(
    "win_unique_theories",
    "SELECT theory_id, name, n FROM (SELECT theory_id, name, n, row_number() OVER (PARTITION BY theory_id ORDER BY n DESC, lower(name), name) AS r FROM (SELECT lower(label) AS theory_id, label AS name, count(*) AS n FROM theory_mentions WHERE label IS NOT NULL GROUP BY 1, 2)) WHERE r = 1",
)
def win_unique_theories(spark, sf):
    m = table(spark, sf, "theory_mentions").where("label IS NOT NULL").groupBy(F.lower("label").alias("theory_id"), F.col("label").alias("name")).agg(F.count("*").alias("n"))
    return B.unique_theory_rows(m)


@query("win_first_group", "SELECT label AS theory_id, arg_min(paper_id, (mention_id, loaded_at)) AS grp FROM theory_mentions WHERE label IS NOT NULL AND paper_id IS NOT NULL GROUP BY 1")
def win_first_group(spark, sf):
    m = table(spark, sf, "theory_mentions").where("label IS NOT NULL AND paper_id IS NOT NULL")
    return B.first_group_of(m.select(F.col("label").alias("theory_id"), F.col("paper_id").alias("grp"), F.struct("mention_id", "loaded_at").alias("ordinal"))).select("theory_id", "grp")


@query(
    "agg_verification_summary",
    "SELECT count(*) AS reviews, count(*) FILTER (n > 0) AS with_nodes, round(avg(n), 6) AS mean_nodes, min(n) AS min_nodes, max(n) AS max_nodes FROM (SELECT p.identifier, count(m.mention_id) AS n FROM papers p LEFT JOIN theory_mentions m ON m.paper_id = p.identifier GROUP BY 1)",
)
def agg_verification_summary(spark, sf):
    m = table(spark, sf, "theory_mentions").groupBy(F.col("paper_id").alias("identifier")).agg(F.count("mention_id").alias("n"))
    r = table(spark, sf, "papers").select("identifier").join(m, "identifier", "left").select(F.coalesce("n", F.lit(0)).alias("nodes"))
    return B.verification_summary(r).withColumn("mean_nodes", F.round("mean_nodes", 6))


@query(
    "tree_attach_all_parents",
    """WITH n AS (SELECT DISTINCT ontology_id, lower(trim(name)) AS k FROM ontology_nodes)
SELECT DISTINCT w.ontology_id, w.parent AS wanted, n.k IS NOT NULL AS found FROM ontology_nodes w LEFT JOIN n ON n.ontology_id = w.ontology_id AND n.k = lower(trim(w.parent)) WHERE w.parent IS NOT NULL""",
)
def tree_attach_all_parents(spark, sf):
    """Parents wanted by every ontology, resolved against the nodes of the same one."""
    n = table(spark, sf, "ontology_nodes")
    nodes = n.select("ontology_id", F.col("name").alias("id"), "name", "ordinal")
    wanted = n.where("parent IS NOT NULL").select("ontology_id", F.col("parent").alias("child"), "parent").distinct()
    good, bad = B.parents_by_name(nodes, wanted, ("ontology_id",))
    found = lambda df, yes: df.select("ontology_id", F.col("child").alias("wanted"), F.lit(yes).alias("found"))
    return found(good, True).unionByName(found(bad, False))


@query(
    "agg_subtheory_quota",
    """WITH c AS (SELECT ontology_id, lower(trim(parent)) AS parent, target FROM ontology_nodes WHERE parent IS NOT NULL),
p AS (SELECT ontology_id, lower(trim(name)) AS parent, max(target) AS pt FROM ontology_nodes GROUP BY 1, 2),
g AS (SELECT c.ontology_id || '/' || c.parent AS parent, pt, count(*) AS children, avg(target) AS mean FROM c LEFT JOIN p ON p.ontology_id = c.ontology_id AND p.parent = c.parent GROUP BY 1, 2)
SELECT parent, children, CAST(CASE WHEN pt IS NOT NULL AND mean > 0 THEN greatest(1, least(children, ceil(pt / mean))) ELSE children END AS INTEGER) AS quota FROM g""",
)
def agg_subtheory_quota(spark, sf):
    n = table(spark, sf, "ontology_nodes")
    c = n.where("parent IS NOT NULL").select("ontology_id", F.lower(F.trim("parent")).alias("parent"), "target")
    p = n.groupBy("ontology_id", F.lower(F.trim("name")).alias("parent")).agg(F.max("target").alias("parent_target"))
    j = c.join(p, ["ontology_id", "parent"], "left")
    return V.subtheory_quota(j.select(F.concat_ws("/", "ontology_id", "parent").alias("parent"), "parent_target", "target"))


@query(
    "flt_last_rejection",
    """WITH k AS (SELECT rec_id AS identifier, 0 AS pos, 'p:' || pmid AS k FROM openalex_records WHERE pmid IS NOT NULL UNION ALL SELECT rec_id, 1, 'j:' || journal FROM openalex_records WHERE journal IS NOT NULL),
g AS (SELECT 'p:' || pmid AS k, rec_id AS node, CAST(rec_id AS DOUBLE) AS score, harvested_at AS ts FROM pubmed_records WHERE pmid IS NOT NULL AND harvested_at IS NOT NULL UNION ALL
  SELECT 'j:' || journal, rec_id, CAST(rec_id AS DOUBLE), harvested_at FROM pubmed_records WHERE journal IS NOT NULL AND harvested_at IS NOT NULL),
l AS (SELECT k, arg_max(node, (ts, node)) AS node FROM g GROUP BY 1),
h AS (SELECT identifier, k, node, row_number() OVER (PARTITION BY identifier ORDER BY pos) AS r FROM k JOIN l USING (k))
SELECT identifier, k, node FROM h WHERE r = 1""",
)
def flt_last_rejection(spark, sf):
    """Rejections under two kinds of keys, met by newer records."""
    o, p = table(spark, sf, "openalex_records"), table(spark, sf, "pubmed_records").where("harvested_at IS NOT NULL")
    key = lambda df, lead, c: df.where(F.col(c).isNotNull()).withColumn("k", F.concat(F.lit(lead), c))
    keys = key(o, "p:", "pmid").select(F.col("rec_id").alias("identifier"), F.lit(0).alias("pos"), "k").unionByName(
        key(o, "j:", "journal").select(F.col("rec_id").alias("identifier"), F.lit(1).alias("pos"), "k")
    )
    reg = lambda df: df.select("k", F.col("rec_id").alias("node"), F.col("rec_id").cast("double").alias("score"), F.col("harvested_at").alias("ts"))
    return R.last_rejection(keys, reg(key(p, "p:", "pmid")).unionByName(reg(key(p, "j:", "journal")))).select("identifier", "k", "node")


@query(
    "flt_oversized",
    "SELECT label AS theory, count(DISTINCT paper_id) AS articles FROM theory_mentions WHERE label IS NOT NULL GROUP BY 1 HAVING count(DISTINCT paper_id) > 5",
)
def flt_oversized(spark, sf):
    m = table(spark, sf, "theory_mentions").where("label IS NOT NULL")
    return m.groupBy(F.col("label").alias("theory")).agg(F.count_distinct("paper_id").alias("articles")).where("articles > 5")


@query("fn_metadata_passthrough", "SELECT ontology_id, name, ordinal, CAST(json_extract_string(metadata, '$.rank') AS INTEGER) AS rank FROM ontology_nodes WHERE metadata IS NOT NULL")
def fn_metadata_passthrough(spark, sf):
    return table(spark, sf, "ontology_nodes").where("metadata IS NOT NULL").select("ontology_id", "name", "ordinal", F.get_json_object("metadata", "$.rank").cast("int").alias("rank"))


@query("set_union_first", "SELECT pmid, min(src) AS src FROM (SELECT pmid, 'a' AS src FROM pubmed_records WHERE pmid IS NOT NULL UNION ALL SELECT pmid, 'b' FROM openalex_records WHERE pmid IS NOT NULL) GROUP BY 1")
def set_union_first(spark, sf):
    """Records of two sources, the first source of a key wins."""
    part = lambda n, s: table(spark, sf, n).where("pmid IS NOT NULL").select("pmid", F.lit(s).alias("src"))
    return part("pubmed_records", "a").unionByName(part("openalex_records", "b")).groupBy("pmid").agg(F.min("src").alias("src"))


@query(
    "str_late_rows",
    "SELECT CAST(date_trunc('month', answered_at) AS TIMESTAMP) AS month, count(*) AS answers, count(*) FILTER (loaded_at - answered_at > INTERVAL 14 DAY) AS late FROM question_answers WHERE answered_at IS NOT NULL GROUP BY 1",
)
def str_late_rows(spark, sf):
    """Answers by the month they were given in, and how many were loaded more than two weeks later."""
    late = F.col("loaded_at") - F.col("answered_at") > F.expr("INTERVAL '14' DAY")
    return table(spark, sf, "question_answers").where("answered_at IS NOT NULL").groupBy(F.date_trunc("month", "answered_at").cast("timestamp_ntz").alias("month")).agg(
        F.count("*").alias("answers"), F.count_if(late).alias("late")
    )


def _event_sql(name: str, pattern: str) -> str:
    """Matches with their places, from the lengths between them."""
    return f"""{name} AS (SELECT identifier, h[i] AS hit, list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda y: length(y))), 0) AS loc
  FROM (SELECT *, unnest(range(1, len(h) + 1)) AS i FROM (SELECT identifier, regexp_extract_all(text, '{pattern}') AS h, regexp_split_to_array(text, '{pattern}') AS g FROM texts)))"""


_TIDY = "regexp_replace(trim(regexp_replace({}, '\\s+', ' ', 'g')), '[\\s:,.;-]+$', '')"
_LEAD = "(?i)^sub(?:theories|domains|concepts)?\\s*[:=-]\\s*"


@query(
    "tree_review_trees",
    f"""WITH texts AS (SELECT theory_id AS identifier, chr(10) || 'The ' || label || ' has subtheories: ' || coalesce(array_to_string(aliases, '; '), '') AS text FROM aging_ontology
  UNION SELECT 'n-' || theory_id, chr(10) || label || chr(10) || coalesce(array_to_string(list_transform(notes, lambda n: '- ' || n), chr(10)), '') FROM aging_ontology
  UNION SELECT identifier, coalesce(title, '') || chr(10) || {ANALYSIS} FROM papers WHERE is_review),
{_event_sql("names", BS.NAME)}, {_event_sql("lists", BS.LIST)}, {_event_sql("bullets", BS.BULLET)},
n AS (SELECT identifier, theory, loc, loc + length(hit) AS fin FROM (SELECT *, {_TIDY.format("hit")} AS theory FROM names) QUALIFY row_number() OVER (PARTITION BY identifier, lower(theory) ORDER BY loc) = 1),
l AS (SELECT n.identifier, n.theory, l.loc, regexp_replace(substr(l.hit, 1, CAST(n.fin + 200 - l.loc AS BIGINT)), '{_LEAD}', '') AS body FROM n JOIN lists l ON l.identifier = n.identifier AND l.loc >= n.loc - 80 AND l.loc < n.fin + 200
  QUALIFY row_number() OVER (PARTITION BY n.identifier, n.theory ORDER BY l.loc) = 1),
p AS (SELECT identifier, theory, i AS o, {_TIDY.format("x[i]")} AS part FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM (SELECT *, regexp_split_to_array(body, '[,;]') AS x FROM l))
  UNION ALL SELECT n.identifier, n.theory, b.loc, {_TIDY.format("regexp_replace(substr(b.hit, 1, CAST(n.fin + 200 - b.loc AS BIGINT)), '^-\\s*', '')")} FROM n JOIN bullets b ON b.identifier = n.identifier AND b.loc >= n.loc - 80 AND b.loc < n.fin + 200
    WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.identifier = n.identifier AND l.theory = n.theory)),
r AS (SELECT *, row_number() OVER (PARTITION BY identifier, theory ORDER BY o) - 1 AS pos FROM p WHERE part <> '')
SELECT n.identifier, n.theory, r.part, CAST(coalesce(r.pos, 0) AS INTEGER) AS pos FROM n LEFT JOIN r ON r.identifier = n.identifier AND r.theory = n.theory""",
)
def tree_review_trees(spark, sf):
    """The reviews among the papers, and every registry entry written out as reviews do, with a list and with bullets."""
    o = table(spark, sf, "aging_ontology")
    nothing = F.array().cast("array<string>")
    lists = F.concat(F.lit("The "), "label", F.lit(" has subtheories: "), F.array_join(F.coalesce("aliases", nothing), "; "))
    bullets = F.concat("label", F.lit("\n"), F.array_join(F.transform(F.coalesce("notes", nothing), lambda n: F.concat(F.lit("- "), n)), "\n"))
    written = o.select(F.explode(F.array(F.struct(F.col("theory_id").alias("identifier"), lists.alias("full_text")), F.struct(F.concat(F.lit("n-"), "theory_id").alias("identifier"), bullets.alias("full_text")))).alias("x")).select("x.*")
    none = F.lit(None).cast("array<struct<title:string,text:string>>")
    written = written.select("identifier", F.lit("").alias("title"), "full_text", none.alias("sections"), F.lit(None).cast("string").alias("abstract"))
    papers = table(spark, sf, "papers").where("is_review").select("identifier", "title", "full_text", "sections", "abstract")
    return BS.review_trees(written.unionByName(papers))


@query(
    "tree_suggested_queries",
    f"""WITH v AS (SELECT group_name AS grp, label, theory_id, list_filter([{t("label")}, CASE WHEN contains({t("label")}, ' ') THEN '"' || {t("label")} || '"' END,
  CASE WHEN NOT contains(lower(label), 'aging') AND NOT contains(lower(label), 'ageing') THEN {t("label")} || ' aging' END,
  CASE WHEN NOT contains(lower(label), 'theory') THEN {t("label")} || ' theory' END], lambda x: x IS NOT NULL) AS v FROM aging_ontology WHERE group_name IS NOT NULL),
e AS (SELECT grp, label, theory_id, v[i] AS query, i FROM (SELECT grp, label, theory_id, v, unnest(range(1, len(v) + 1)) AS i FROM v)),
d AS (SELECT *, row_number() OVER (PARTITION BY grp, lower(query) ORDER BY theory_id, label, i) AS r FROM e),
k AS (SELECT grp, query, row_number() OVER (PARTITION BY grp ORDER BY theory_id, label, i) AS rank FROM d WHERE r = 1)
SELECT grp, query, rank FROM k WHERE rank <= 10""",
)
def tree_suggested_queries(spark, sf):
    """Ten queries a group: a report."""
    o = table(spark, sf, "aging_ontology").where("group_name IS NOT NULL")
    groups = o.select(F.col("group_name").alias("grp")).distinct().select("grp", F.col("grp").alias("descendant"), F.lit(0).alias("distance"))
    terms = o.select(F.col("group_name").alias("grp"), F.col("label").alias("term"), F.col("theory_id").alias("ordinal"))
    return BS.suggested_queries(groups, terms)

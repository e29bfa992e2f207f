"""Queries over captured pages, which are written out of the test tables and read back by the mappings, and their SQL; one record a page."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.functions import text as T
from lorewright.operators import bootstrap as BS
from lorewright.operators import coverage as V
from lorewright.operators import expansion as E
from lorewright.operators import hierarchy as H
from lorewright.operators import registry as RG
from lorewright.operators import trees as TR
from lorewright.plans.hierarchy_queries import _BASE
from lorewright.plans.text_queries import _DOI, t
from lorewright.session import table
from lorewright.sources import payloads as P
from lorewright.sources import sinks

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def _page(rows, item, key: str = "results", *more):
    """Pages ``page`` of one item each, under a key of the payload."""
    out = F.array(item)
    for k in reversed(key.split(".")):
        out = F.struct(out.alias(k))
    return rows.select(*more, F.to_json(out).alias("page"))


def _joined(df, *cols):
    return df.select(*[F.array_join(c, "|").alias(c) if c in cols else F.col(c) for c in df.columns])


_YEAR4 = "CAST(nullif(regexp_extract({}, '^([0-9]{{4}})$', 1), '') AS INTEGER)"


def _work():
    year = F.expr("try_cast(nullif(regexp_extract(publication_year, '^([0-9]{4})$', 1), '') as int)")
    return F.struct(
        F.col("openalex_url").alias("id"), "doi", "title", year.alias("publication_year"), F.get("publication_types", F.lit(0)).alias("type"),
        F.transform("authors", lambda a: F.struct(F.struct(a.alias("display_name")).alias("author"))).alias("authorships"),
        F.struct(F.concat(F.lit("https://pubmed.example/"), "pmid").alias("pmid")).alias("ids"),
        F.struct(F.struct(F.col("journal").alias("display_name")).alias("source")).alias("primary_location"),
    )


@query(
    "src_openalex_papers",
    f"""SELECT openalex_url AS identifier, title, array_to_string(list_filter(authors, lambda a: a IS NOT NULL), '|') AS authors, {_YEAR4.format("publication_year")} AS year, {_DOI} AS doi,
  contains(lower(coalesce(publication_types[1], '')), 'review') AS is_review FROM openalex_records""",
)
def src_openalex_papers(spark, sf):
    got = P.openalex_papers(_page(table(spark, sf, "openalex_records"), _work()))
    return _joined(got.select("identifier", "title", "authors", "year", "doi", "is_review"), "authors")


@query(
    "src_openalex_reviews",
    f"""SELECT openalex_id, pmid, title, journal, publication_year, doi FROM (
  SELECT upper(nullif(regexp_extract({t('openalex_url')}, '(?i)(?:^|openalex:|/)(w[0-9]+)/?$', 1), '')) AS openalex_id, regexp_extract('https://pubmed.example/' || pmid, '[^/]*$') AS pmid, title, journal,
    CAST({_YEAR4.format("publication_year")} AS VARCHAR) AS publication_year, {_DOI} AS doi, rec_id FROM openalex_records)
QUALIFY openalex_id IS NULL OR row_number() OVER (PARTITION BY openalex_id ORDER BY rec_id) = 1""",
)
def src_openalex_reviews(spark, sf):
    """The first page that has a work gives its record."""
    pages = _page(table(spark, sf, "openalex_records").dropDuplicates(["rec_id"]), _work(), "results", F.col("rec_id").alias("number"))
    return P.openalex_reviews(pages).select("openalex_id", "pmid", "title", "journal", "publication_year", "doi")


@query(
    "src_crossref_papers",
    f"""SELECT 'crossref:' || doi AS identifier, title, abstract, array_to_string(list_filter(list_transform(authors, lambda a: trim(a)), lambda a: a IS NOT NULL), '|') AS authors, year, citation_count, {_DOI} AS doi,
  array_to_string(influential_citations, '|') AS influential_citations FROM papers WHERE doi IS NOT NULL""",
)
def src_crossref_papers(spark, sf):
    rows = table(spark, sf, "papers").where("doi IS NOT NULL")
    item = F.struct(
        F.col("doi").alias("DOI"), F.array("title").alias("title"), "abstract", F.transform(F.filter("authors", lambda a: a.isNotNull()), lambda a: F.struct(a.alias("family"))).alias("author"),
        F.struct(F.array(F.array("year")).alias("date-parts")).alias("issued"), F.col("citation_count").alias("is-referenced-by-count"),
        F.transform("influential_citations", lambda k: F.create_map(F.lit("key"), k)).alias("reference"),
    )
    got = P.crossref_papers(_page(rows, item, "message.items"))
    return _joined(got.select("identifier", "title", "abstract", "authors", "year", "citation_count", "doi", "influential_citations"), "authors", "influential_citations")


@query(
    "src_semantic_scholar_papers",
    f"""SELECT coalesce(CASE WHEN citation_count > 20 THEN identifier END, CASE WHEN year % 2 = 0 THEN 'CorpusId:' || CAST(year AS VARCHAR) END, doi,
  sha1(concat_ws('|', title, CAST(year AS VARCHAR), left(abstract, 80)))) AS identifier, title, year, {_DOI} AS doi, coalesce(is_review, false) AS is_review FROM papers""",
)
def src_semantic_scholar_papers(spark, sf):
    """The identifier is the first of five that is there."""
    item = F.struct(
        F.when(F.col("citation_count") > 20, F.col("identifier")).alias("paperId"), F.when(F.col("year") % 2 == 0, F.col("year").cast("string")).alias("corpusId"),
        F.map_filter(F.create_map(F.lit("DOI"), "doi"), lambda k, v: v.isNotNull()).alias("externalIds"), "title", "abstract", "year",
        F.when(F.col("is_review"), F.array(F.lit("Review"))).alias("publicationTypes"),
    )
    return P.semantic_scholar_papers(_page(table(spark, sf, "papers"), item, "data")).select("identifier", "title", "year", "doi", "is_review")


@query(
    "src_scholar_papers",
    """SELECT identifier, title, coalesce(citation_count, 0) AS citation_count, year, CASE WHEN regexp_matches(lower(doi), '10\\.[0-9]{4,9}/[^\\s?#]+') THEN regexp_extract(lower(doi), '(10\\.[0-9]{4,9}/[^\\s?#]+)', 1) END AS doi
FROM papers WHERE year BETWEEN 1900 AND 2099 AND NOT regexp_matches(title, '[0-9]{4}')""",
)
def src_scholar_papers(spark, sf):
    """Years and DOIs are read out of summaries and addresses."""
    rows = table(spark, sf, "papers").where("year BETWEEN 1900 AND 2099 AND NOT title RLIKE '[0-9]{4}'")
    item = F.struct(
        F.col("identifier").alias("result_id"), "title", F.concat(F.lit("http://host.example/"), "doi").alias("link"),
        F.struct(F.concat(F.lit("A Bond - Journal, "), F.col("year").cast("string"), F.lit(" - host")).alias("summary")).alias("publication_info"),
        F.struct(F.struct(F.col("citation_count").alias("total")).alias("cited_by")).alias("inline_links"),
    )
    return P.scholar_papers(_page(rows, item, "organic_results")).select("identifier", "title", "citation_count", "year", "doi")


@query(
    "src_rxiv_papers",
    f"""SELECT doi AS identifier, title, CASE WHEN lower(trim(abstract)) = 'na' THEN '' ELSE abstract END AS abstract, year, {_DOI} AS doi FROM papers
WHERE contains(lower(concat_ws(' ', title, abstract, array_to_string(authors, '; '), source)), 'aging') AND contains(lower(concat_ws(' ', title, abstract, array_to_string(authors, '; '), source)), 'lifespan')""",
)
def src_rxiv_papers(spark, sf):
    """Preprints that hold every term of the query."""
    item = F.struct("doi", "title", "abstract", F.array_join("authors", "; ").alias("authors"), F.col("source").alias("category"), F.concat(F.col("year").cast("string"), F.lit("-01-02")).alias("date"))
    return P.rxiv_papers(_page(table(spark, sf, "papers"), item, "collection"), "Aging Lifespan").select("identifier", "title", "abstract", "year", "doi")


_BLANK = "nullif(trim({}), '')"


@query(
    "src_access_papers",
    f"""SELECT coalesce(CASE WHEN year % 3 = 0 THEN identifier END, 'acc:' || coalesce({t('doi')}, sha1(concat_ws('|', {t('title')}, 'None', CAST(year AS VARCHAR))))) AS identifier, {t('title')} AS title, year,
  {t('doi')} AS doi, len(authors) AS people FROM papers WHERE year IS NOT NULL AND title IS NOT NULL AND {t('doi')} IS DISTINCT FROM '' AND list_aggregate(list_transform(authors, lambda a: CAST(regexp_matches(a, '[;|]') OR trim(a) = '' AS INTEGER)), 'sum') = 0 AND len(authors) > 1""",
)
def src_access_papers(spark, sf):
    """Flat mappings of varying keys."""
    bad = F.exists("authors", lambda a: a.rlike("[;|]") | (F.trim(a) == ""))
    rows = table(spark, sf, "papers").where(F.col("year").isNotNull() & F.col("title").isNotNull() & ~bad & (F.size("authors") > 1) & ~F.coalesce(T.trimmed("doi") == "", F.lit(False)))
    item = F.map_filter(
        F.create_map(F.lit("id"), F.when(F.col("year") % 3 == 0, F.col("identifier")), F.lit("title"), "title", F.lit("year"), F.col("year").cast("string"), F.lit("doi"), "doi", F.lit("authors"), F.array_join("authors", "; ")),
        lambda k, v: v.isNotNull(),
    )
    return P.access_papers(_page(rows, item, "result"), "acc").select("identifier", "title", "year", "doi", F.size("authors").alias("people"))


@query(
    "src_archive_papers",
    f"""SELECT 'arc:' || CASE WHEN citation_count > 10 THEN identifier ELSE coalesce(nullif({t('doi')}, ''), sha1(concat_ws('|', coalesce({t('title')}, ''), coalesce(CAST(year AS VARCHAR), '')))) END AS identifier,
  coalesce({t('title')}, '') AS title, year, nullif({t('doi')}, '') AS doi FROM papers""",
)
def src_archive_papers(spark, sf):
    """The DOI comes nested in half of the records."""
    nested = F.coalesce(F.col("year") % 2 == 0, F.lit(False))
    item = F.struct(
        F.when(F.col("citation_count") > 10, F.col("identifier")).alias("md5"), "title", F.col("year").cast("string").alias("year"),
        F.when(~nested, F.col("doi")).alias("doi"), F.struct(F.when(nested, F.col("doi")).alias("doi")).alias("identifiers"),
    )
    return P.archive_papers(_page(table(spark, sf, "papers"), item), "arc").select("identifier", "title", "year", "doi")


@query(
    "src_pubmed_reviews",
    f"""SELECT DISTINCT pmid, title, journal, regexp_extract(publication_year, '^[^ ]*') AS publication_year, {_DOI} AS doi FROM pubmed_records
WHERE pmid = trim(pmid) AND title = trim(title) AND title <> '' AND journal = trim(journal) AND publication_year = trim(publication_year) AND publication_year <> '' AND doi = trim(doi) AND doi <> ''
  AND NOT regexp_matches(concat_ws(' ', title, journal, doi), '[<>&\\x00-\\x1f]|\\s\\s')""",
)
def src_pubmed_reviews(spark, sf):
    """Article elements; a date text gives its first word as the year."""
    whole = " AND ".join(f"{c} = trim({c}) AND {c} <> ''" for c in ("pmid", "title", "journal", "publication_year", "doi"))
    rows = table(spark, sf, "pubmed_records").where(whole).where(~F.concat_ws(" ", "title", "journal", "doi").rlike(r"[<>&\x00-\x1f]|\s\s"))
    xml = F.concat(
        F.lit("<PubmedArticle><MedlineCitation><PMID>"), "pmid", F.lit("</PMID><Article><ArticleTitle>"), "title", F.lit("</ArticleTitle><Journal><Title>"), "journal",
        F.lit("</Title><JournalIssue><PubDate><MedlineDate>"), "publication_year", F.lit("</MedlineDate></PubDate></JournalIssue></Journal></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType=\"doi\">"), "doi",
        F.lit("</ArticleId></ArticleIdList></PubmedData></PubmedArticle>"),
    )
    return P.pubmed_reviews(rows.select(xml.alias("xml"))).select("pmid", "title", "journal", "publication_year", "doi").distinct()


@query(
    "src_full_text_choice",
    """SELECT identifier AS pmid, CASE WHEN trim(coalesce(full_text, '')) <> '' AND is_review THEN 'pmc' WHEN trim(coalesce(abstract, '')) <> '' THEN 'pdf' WHEN trim(coalesce(title, '')) <> '' THEN 'ocr' END AS full_text_source,
  CASE WHEN trim(coalesce(full_text, '')) <> '' AND is_review THEN length(full_text) WHEN trim(coalesce(abstract, '')) <> '' THEN length(abstract) WHEN trim(coalesce(title, '')) <> '' THEN length(title) END AS n FROM papers""",
)
def src_full_text_choice(spark, sf):
    null = F.lit(None).cast("string")
    rows = table(spark, sf, "papers").select(F.col("identifier").alias("pmid"), F.when(F.col("is_review"), F.col("full_text")).alias("body"), F.col("abstract").alias("pdf_text"), F.col("title").alias("ocr_text"), null.alias("body_error"), null.alias("pdf_error"))
    return P.resolve_full_text(rows).select("pmid", "full_text_source", F.length("full_text").alias("n"))


@query(
    "src_missing_bodies",
    "SELECT identifier AS pmcid, CASE WHEN is_review IS NULL THEN 'failed' WHEN trim(full_text) <> '' THEN 'text' ELSE 'missing' END AS status FROM papers",
)
def src_missing_bodies(spark, sf):
    p = table(spark, sf, "papers").withColumnRenamed("identifier", "pmcid")
    return P.missing_bodies(p.select("pmcid"), p.where("is_review IS NOT NULL").select("pmcid", F.col("full_text").alias("text")))


@query("snk_papers_table", "SELECT identifier, coalesce(array_to_string(authors, '; '), '') AS authors, coalesce(CAST(year AS VARCHAR), '') AS year, coalesce(CAST(is_review AS VARCHAR), '') AS is_review FROM papers")
def snk_papers_table(spark, sf):
    return sinks.papers_table(table(spark, sf, "papers").select("identifier", "authors", "year", "is_review"))


@query("snk_append_new", "SELECT mention_id, min(noted_at) AS noted_at FROM theory_mentions WHERE mention_id NOT IN (SELECT mention_id FROM theory_mentions WHERE paper_id IS NULL) GROUP BY 1")
def snk_append_new(spark, sf):
    """Rows for a store that has the mentions without a paper already; a second delivery adds nothing."""
    m = table(spark, sf, "theory_mentions")
    rows = m.select("mention_id", "noted_at", F.col("noted_at").alias("ordinal"))
    return sinks.append_new(rows, m.where("paper_id IS NULL"), "mention_id").select("mention_id", "noted_at")


_TEXT = "'<html><head><script>var x = 1;</script></head><body><p>' || text || '</p>&eacute;&#8211;&amp;<br/>end</body></html>'"


@query(
    "fn_html_pages",
    """SELECT doc_id, md5(regexp_replace(regexp_replace(text || chr(10) || 'é–&' || chr(10) || 'end', '[ \\t]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')) AS digest FROM documents
WHERE NOT regexp_matches(text, '[<>&]') AND regexp_matches(text, '^[ -~]*$')""",
)
def fn_html_pages(spark, sf):
    """Texts written as pages with a script and entities, and read back."""
    rows = table(spark, sf, "documents").where("NOT text RLIKE '[<>&]' AND text RLIKE '^[ -~]*$'")
    html = F.concat(F.lit("<html><head><script>var x = 1;</script></head><body><p>"), "text", F.lit("</p>&eacute;&#8211;&amp;<br/>end</body></html>"))
    return rows.select("doc_id", F.md5(T.strip_html(html)).alias("digest"))


@query("srt_global_limit", "SELECT identifier FROM papers ORDER BY updated_at NULLS LAST, identifier LIMIT 100")
def srt_global_limit(spark, sf):
    """The first hundred papers in the order of collection: the limit is the feature."""
    return table(spark, sf, "papers").orderBy(F.asc_nulls_last("updated_at"), "identifier").limit(100).select("identifier")


@query(
    "srt_early_stop",
    """WITH p AS (SELECT source, count(*) AS n, min(identifier) AS first FROM papers WHERE source IS NOT NULL GROUP BY 1),
r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p) SELECT source, n, CAST(before AS BIGINT) AS before FROM r WHERE before < 1000""",
)
def srt_early_stop(spark, sf):
    """Pages (here one a source) in order until the target of 1,000 papers is met; the last page may overshoot. The running sum goes over pages only."""
    from pyspark.sql import Window

    pages = table(spark, sf, "papers").where("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("n"), F.min("identifier").alias("first"))
    w = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    return pages.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))).where("before < 1000").select("source", "n", "before")


@query(
    "agg_path_merge",
    _BASE
    + """, each AS (SELECT k.ontology_id, lower(array_to_string(k.names, ' > ')) AS path, k.depth, o.target FROM kinds k
  JOIN (SELECT ontology_id, name, max(target) AS target FROM ontology_nodes GROUP BY 1, 2) o ON o.ontology_id = k.ontology_id AND o.name = k.name WHERE k.names IS NOT NULL)
SELECT path, min(depth) AS depth, CAST(sum(target) AS BIGINT) AS citations, count(DISTINCT ontology_id) AS reviews FROM each GROUP BY path""",
)
def agg_path_merge(spark, sf):
    """Trees merged by their paths of names: numbers add up for each occurrence, trees count once."""
    o = table(spark, sf, "ontology_nodes")
    own = o.groupBy("ontology_id", "name").agg(F.max("target").alias("target"))
    each = H.resolve_hierarchy(o).where("path IS NOT NULL").join(own, ["ontology_id", "name"])
    return each.groupBy(F.lower(F.array_join("path", " > ")).alias("path")).agg(
        F.min("depth").cast("int").alias("depth"), F.sum("target").cast("bigint").alias("citations"), F.count_distinct("ontology_id").alias("reviews")
    )


@query(
    "agg_article_metadata",
    f"""SELECT coalesce({_BLANK.format("doi")}, {_BLANK.format("pmid")}, 'article-' || rec_id) AS id, trim(title) AS title, nullif(regexp_replace(coalesce(publication_year, ''), '[^0-9]', '', 'g'), '') AS year,
  array_to_string(authors[1:5], '; ') AS authors FROM pubmed_records""",
)
def agg_article_metadata(spark, sf):
    """Id by the first that is there, digits of the year, the first five authors: what a tree node shows of an article."""
    some = lambda c: F.nullif(F.trim(c), F.lit(""))
    return table(spark, sf, "pubmed_records").select(
        F.coalesce(some("doi"), some("pmid"), F.concat(F.lit("article-"), F.col("rec_id").cast("string"))).alias("id"), F.trim("title").alias("title"),
        F.nullif(F.regexp_replace(F.coalesce("publication_year", F.lit("")), "[^0-9]", ""), F.lit("")).alias("year"), F.array_join(F.slice("authors", 1, 5), "; ").alias("authors"),
    )


@query(
    "join_failures_any_key",
    f"""WITH k AS (SELECT rec_id, harvested_at, unnest(['d:' || {_DOI}, 'p:' || {t('pmid')}]) AS k FROM openalex_records WHERE abstract IS NULL),
latest AS (SELECT k, max(harvested_at) AS at_, max_by(rec_id, (harvested_at, rec_id)) AS last FROM k WHERE k IS NOT NULL GROUP BY 1),
done AS (SELECT DISTINCT unnest(['d:' || {_DOI}, 'p:' || {t('pmid')}]) AS k FROM pubmed_records WHERE abstract IS NOT NULL)
SELECT rec_id FROM k GROUP BY rec_id HAVING bool_and(k IS NULL OR k NOT IN (SELECT k FROM done WHERE k IS NOT NULL)) AND bool_and(k IS NULL OR rec_id = (SELECT last FROM latest l WHERE l.k = k.k))""",
)
def join_failures_any_key(spark, sf):
    """Failures merged over any of their keys: a later failure replaces those it shares a key with, a key that succeeded clears them."""
    from lorewright.functions import keys as K

    ks = F.explode(F.array_compact(F.array(F.concat(F.lit("d:"), K.doi_norm("doi")), F.concat(F.lit("p:"), T.trimmed("pmid"))))).alias("k")
    failed = table(spark, sf, "openalex_records").where("abstract IS NULL")
    each = failed.select("rec_id", "harvested_at", ks)
    latest = each.groupBy("k").agg(F.max_by("rec_id", F.struct("harvested_at", "rec_id")).alias("last"))
    done = table(spark, sf, "pubmed_records").where("abstract IS NOT NULL").select(ks).distinct().withColumn("done", F.lit(True))
    bad = each.join(latest, "k").join(done, "k", "left").where("done OR rec_id <> last").select("rec_id")
    return failed.select("rec_id").distinct().join(bad, "rec_id", "left_anti")


@query(
    "win_theory_papers_once",
    "SELECT label AS theory, paper_id, min(mention_id) AS mention_id FROM theory_mentions WHERE label IS NOT NULL AND paper_id IS NOT NULL GROUP BY 1, 2",
)
def win_theory_papers_once(spark, sf):
    """Theory and paper once, the first mention stands for them."""
    return table(spark, sf, "theory_mentions").where("label IS NOT NULL AND paper_id IS NOT NULL").groupBy(F.col("label").alias("theory"), "paper_id").agg(F.min("mention_id").alias("mention_id"))


@query(
    "fn_slug_variants",
    f"""SELECT mention_id, loaded_at, coalesce(nullif(trim(regexp_replace(lower({t('label')}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'bootstrap') AS a, coalesce(nullif(trim(regexp_replace(lower({t('label')}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'untitled') AS b,
  coalesce(nullif(trim(regexp_replace(lower({t('label')}), '[^a-z0-9]', '-', 'g'), '-'), ''), 'theory') AS c FROM theory_mentions""",
)
def fn_slug_variants(spark, sf):
    """Slugs with other default words, and with a hyphen for every character."""
    x = T.trimmed("label")
    return table(spark, sf, "theory_mentions").select("mention_id", "loaded_at", T.slug(x, "bootstrap").alias("a"), T.slug(x, "untitled").alias("b"), T.slug_per_char(x).alias("c"))


@query("tree_event_places", "SELECT identifier, CAST(instr(full_text, 'lifespan') - 1 AS INTEGER) AS first_at, CAST(len(regexp_extract_all(full_text, 'lifespan')) AS BIGINT) AS n FROM papers WHERE contains(full_text, 'lifespan')")
def tree_event_places(spark, sf):
    """Places of a word as events, the first and how many."""
    texts = table(spark, sf, "papers").where("full_text IS NOT NULL").select("identifier", F.col("full_text").alias("text"))
    return BS.events(texts, "lifespan").groupBy("identifier").agg(F.min("at").alias("first_at"), F.count("*").alias("n"))


_CLEAN = r"regexp_replace(regexp_replace(label, '\s+', ' ', 'g'), '[ \-:,.;]+$', '')"
_REG = f"""WITH m AS (SELECT {_CLEAN} AS label, mention_id AS ordinal, paper_id AS article FROM theory_mentions WHERE {_CLEAN} <> ''),
o AS (SELECT label, min(ordinal) AS ordinal, coalesce(nullif(array_to_string(list_sort(list_filter(regexp_split_to_array(lower(label), '[^a-z0-9]+'), lambda w: w <> '')), ' '), ''), lower(label)) AS sig FROM m GROUP BY label),
h AS (SELECT sig, arg_min(label, (ordinal, label)) AS canonical FROM o GROUP BY sig), b AS (SELECT m.label, h.canonical, m.ordinal, m.article FROM m JOIN o USING (label) JOIN h ON h.sig = o.sig),
f AS (SELECT canonical, arg_min_null(article, ordinal) AS first, count(DISTINCT label) AS aliases, count(DISTINCT article) AS articles FROM b GROUP BY canonical),
i AS (SELECT *, coalesce(nullif(trim(regexp_replace(lower(canonical), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'theory') AS slug,
  coalesce(nullif(trim(regexp_replace(lower(coalesce(first, '')), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'article') AS at_ FROM f), t AS (SELECT *, slug || '__' || at_ AS theory_id FROM i)"""


def _registry(spark, sf):
    return RG.registry_tables(table(spark, sf, "theory_mentions").select("label", F.col("mention_id").alias("ordinal"), F.col("paper_id").alias("article")), None)


@query("agg_registry_entries", f"{_REG} SELECT theory_id, canonical AS label, slug, first AS article, aliases, articles FROM t")
def agg_registry_entries(spark, sf):
    """Registry of the mentions by equal words: one row an entry, with what it rests on."""
    return _registry(spark, sf)[0]


@query("agg_registry_supports", f"{_REG} SELECT DISTINCT theory_id, article FROM b JOIN t USING (canonical) WHERE article IS NOT NULL")
def agg_registry_supports(spark, sf):
    return _registry(spark, sf)[1]


@query(
    "agg_registry_synonyms",
    f"""{_REG} SELECT DISTINCT label AS alias, theory_id, coalesce(nullif(trim(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'theory') AS slug, article
FROM b JOIN t USING (canonical) WHERE article IS NOT NULL AND lower(label) <> lower(canonical)""",
)
def agg_registry_synonyms(spark, sf):
    return _registry(spark, sf)[2]


_STOP = "[" + ", ".join(f"'{w}'" for w in E.ENGLISH) + "]"


@query(
    "agg_tfidf_bigrams",
    f"""WITH d AS (SELECT lower(trim(source)) AS src, identifier, list_filter(regexp_extract_all(lower(title), '[a-z0-9]{{2,}}'), lambda w: NOT list_contains({_STOP}, w)) AS ws FROM papers WHERE source IS NOT NULL),
e AS (SELECT src, identifier, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS term FROM d),
tf AS (SELECT src, identifier, term, count(*) AS tf FROM e GROUP BY 1, 2, 3),
n AS (SELECT src, count(DISTINCT identifier) AS n FROM tf GROUP BY 1), df AS (SELECT src, term, count(*) AS df FROM tf GROUP BY 1, 2),
w AS (SELECT tf.src, identifier, tf.term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN n USING (src) JOIN df ON df.src = tf.src AND df.term = tf.term),
nm AS (SELECT src, identifier, sqrt(sum(w * w)) AS nm FROM w GROUP BY 1, 2),
s AS (SELECT w.src, term, round(sum(w / nm), 6) AS weight FROM w JOIN nm ON nm.src = w.src AND nm.identifier = w.identifier GROUP BY 1, 2)
SELECT src, term, round(weight, 3) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY weight DESC, term) AS r FROM s) WHERE r <= 5""",
)
def agg_tfidf_bigrams(spark, sf):
    """Five words or pairs of words per source, stop words out: a top-k report."""
    p = table(spark, sf, "papers").where("source IS NOT NULL").withColumn("src", F.lower(F.trim("source")))
    return E.tfidf_terms(p, "src", "identifier", "title", E.ENGLISH, 5, 2).select("src", "term", F.round("weight", 3).alias("weight"))


_MERGES = """mg AS (SELECT ontology_id AS tree, CASE WHEN ordinal % 3 = 0 THEN ' Group ' || CAST(ordinal % 2 AS VARCHAR) ELSE coalesce(parent, name) END AS parent, CASE WHEN ordinal % 11 = 0 THEN name || ' gone' ELSE name END AS child, ordinal
  FROM ontology_nodes WHERE ordinal % 5 = 0),
own AS (SELECT ontology_id AS tree, lower(trim(name, ' ')) AS k, min((name, parent)) AS np FROM ontology_nodes GROUP BY 1, 2),
ow AS (SELECT tree, k, np[1] AS name, np[2] AS parent FROM own),
ask AS (SELECT *, lower(trim(parent, ' ')) AS pk, lower(trim(child, ' ')) AS ck FROM mg WHERE lower(trim(parent, ' ')) <> '' AND lower(trim(child, ' ')) <> ''),
fi AS (SELECT tree, ck, min((ordinal, pk)) AS f FROM ask GROUP BY 1, 2),
ju AS (SELECT ask.*, CASE WHEN ow.k IS NULL THEN 'unresolved' WHEN pk = ask.ck THEN 'itself' WHEN (ordinal, pk) <> f THEN 'repeated' END AS issue FROM ask JOIN fi ON fi.tree = ask.tree AND fi.ck = ask.ck LEFT JOIN ow ON ow.tree = ask.tree AND ow.k = ask.ck),
dn AS (SELECT tree, ck, min((pk, parent)) AS m FROM ju WHERE issue IS NULL GROUP BY 1, 2), do_ AS (SELECT tree, ck, m[1] AS pk, m[2] AS parent FROM dn),
mk AS (SELECT tree, pk, min(trim(parent, ' ')) AS name FROM do_ WHERE NOT EXISTS (SELECT 1 FROM ow WHERE ow.tree = do_.tree AND ow.k = do_.pk) GROUP BY 1, 2),
nm AS (SELECT tree, k AS pk, name FROM ow UNION ALL SELECT tree, pk, name FROM mk), mv AS (SELECT do_.tree, do_.ck AS k, nm.name AS np FROM do_ JOIN nm ON nm.tree = do_.tree AND nm.pk = do_.pk)"""


def _parents(spark, sf):
    o = table(spark, sf, "ontology_nodes")
    group = F.concat(F.lit(" Group "), (F.col("ordinal") % 2).cast("string"))
    merges = o.where("ordinal % 5 = 0").select(
        F.col("ontology_id").alias("tree"), F.when(F.col("ordinal") % 3 == 0, group).otherwise(F.coalesce("parent", "name")).alias("parent"),
        F.when(F.col("ordinal") % 11 == 0, F.concat("name", F.lit(" gone"))).otherwise(F.col("name")).alias("child"), "ordinal",
    )
    return TR.merge_parents(o.select(F.col("ontology_id").alias("tree"), "name", "parent"), merges)


@query("tree_merge_parents", f"WITH {_MERGES} SELECT ow.tree, ow.name, coalesce(mv.np, ow.parent) AS parent FROM ow LEFT JOIN mv ON mv.tree = ow.tree AND mv.k = ow.k UNION ALL SELECT tree, name, NULL FROM mk")
def tree_merge_parents(spark, sf):
    """Every fifth node under another parent, which is made where it is not there."""
    return _parents(spark, sf)[0]


@query("tree_merge_audit", f"WITH {_MERGES} SELECT DISTINCT tree, child, parent, issue FROM ju WHERE issue IS NOT NULL")
def tree_merge_audit(spark, sf):
    return _parents(spark, sf)[1]


_JUDGED = """pl AS (SELECT label AS grp, CASE WHEN mention_id % 5 = 0 THEN 'none' ELSE theory_id END AS theory_id, mention_id AS ordinal FROM theory_mentions m JOIN aging_ontology USING (label) WHERE label IS NOT NULL),
gr AS (SELECT DISTINCT grp FROM pl), kn AS (SELECT DISTINCT theory_id FROM aging_ontology),
rk AS (SELECT *, row_number() OVER (PARTITION BY theory_id ORDER BY ordinal, grp) AS r FROM (SELECT DISTINCT * FROM pl)),
gd AS (SELECT DISTINCT grp, theory_id FROM rk JOIN kn USING (theory_id) WHERE r = 1 UNION ALL SELECT 'Unassigned', theory_id FROM kn WHERE theory_id NOT IN (SELECT theory_id FROM pl)),
ar AS (SELECT DISTINCT theory_id, paper_id AS article FROM theory_mentions JOIN aging_ontology USING (label) WHERE paper_id IS NOT NULL)"""


def _refilled(spark, sf):
    o, m = table(spark, sf, "aging_ontology"), table(spark, sf, "theory_mentions")
    j = m.join(o.select("theory_id", "label"), "label")
    placed = j.select(F.col("label").alias("grp"), F.when(F.col("mention_id") % 5 == 0, "none").otherwise(F.col("theory_id")).alias("theory_id"), F.col("mention_id").alias("ordinal")).distinct()
    return TR.refilled(TR.reconcile(placed, o), j.select("theory_id", F.col("paper_id").alias("article")), placed)


@query("tree_refilled", f"WITH {_JUDGED} SELECT gd.grp, gd.theory_id, count(ar.article) AS articles FROM gd LEFT JOIN ar ON ar.theory_id = gd.theory_id GROUP BY 1, 2")
def tree_refilled(spark, sf):
    """Placements checked against the registry, with the articles the registry has for them."""
    return _refilled(spark, sf)[0].groupBy("grp", "theory_id").agg(F.count("article").alias("articles"))


@query("tree_pruned", f"WITH {_JUDGED} SELECT grp FROM gr WHERE grp NOT IN (SELECT grp FROM gd)")
def tree_pruned(spark, sf):
    """Groups that lost all their theories."""
    return _refilled(spark, sf)[1]


@query("tree_coverage_lines", "SELECT ontology_id, name, repeat('  ', depth) || name || ': ' || CAST(depth AS VARCHAR) || '/' || CAST(coalesce(target, 0) AS VARCHAR) || CASE WHEN coalesce(target, 0) > depth THEN ' (short by ' || CAST(target - depth AS VARCHAR) || ')' ELSE '' END AS line FROM (" + _BASE + " SELECT k.ontology_id, k.name, k.depth, o.target FROM kinds k JOIN (SELECT ontology_id, name, max(target) AS target FROM ontology_nodes GROUP BY 1, 2) o ON o.ontology_id = k.ontology_id AND o.name = k.name WHERE k.depth IS NOT NULL)")
def tree_coverage_lines(spark, sf):
    """The coverage report as lines, one a node, indented by depth; the depth stands in for the papers found."""
    o = table(spark, sf, "ontology_nodes")
    own = o.groupBy("ontology_id", "name").agg(F.max("target").alias("target"))
    r = H.resolve_hierarchy(o).where("depth IS NOT NULL").join(own, ["ontology_id", "name"])
    return r.select("ontology_id", "name", V.coverage_line("name", "depth", F.col("depth"), F.coalesce("target", F.lit(0))).alias("line"))

"""Queries of scalar and key functions over the record tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.functions import keys as K
from lorewright.functions import text as T
from lorewright.session import table

QUERIES: dict = {}
SQL: dict = {}
STOP = ["the", "and", "for", "with", "that", "from", "was", "were"]


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def t(x: str) -> str:
    return _TRIM.format(x)


_DOI = f"nullif({t('regexp_replace(lower(' + t('doi') + '), ' + chr(39) + '^(https?://doi[.]org/|https://dx[.]doi[.]org/|doi:)' + chr(39) + ', ' + chr(39) * 2 + ')')}, '')"


@query("fn_doi_normalise", f"SELECT rec_id, {_DOI} AS doi_norm FROM pubmed_records")
def fn_doi_normalise(spark, sf):
    return table(spark, sf, "pubmed_records").select("rec_id", K.doi_norm("doi").alias("doi_norm"))


@query(
    "fn_openalex_id",
    f"SELECT rec_id, upper(nullif(regexp_extract({t('openalex_url')}, '(?i)(?:^|openalex:|/)(w[0-9]+)/?$', 1), '')) AS work FROM openalex_records",
)
def fn_openalex_id(spark, sf):
    return table(spark, sf, "openalex_records").select("rec_id", K.openalex_norm("openalex_url").alias("work"))


@query(
    "fn_stable_keys",
    f"""SELECT rec_id, k FROM (SELECT rec_id, unnest(list_filter([
  'doi:' || {_DOI}, 'pmid:' || nullif(lower({t("pmid")}), ''), 'openalex:' || nullif(lower({t("openalex_id")}), '')],
  lambda x: x IS NOT NULL)) AS k FROM openalex_records)""",
)
def fn_stable_keys(spark, sf):
    return table(spark, sf, "openalex_records").select(
        "rec_id", F.explode(K.stable_keys(F.col("pmid"), F.col("doi"), F.col("openalex_id"))).alias("k")
    )


@query("fn_extended_keys")
def fn_extended_keys(spark, sf):
    """Keys by shape, full-text addresses included."""
    r = table(spark, sf, "openalex_records")
    return r.select(
        "rec_id",
        F.explode(K.extended_keys(F.col("pmid"), F.col("doi"), F.col("openalex_id"), F.map_values("fulltext_links"))).alias("k"),
    )


@query(
    "fn_decision_keys",
    f"""WITH k AS (SELECT rec_id, list_filter(['doi:' || {_DOI}, 'pmid:' || nullif(lower({t("pmid")}), ''),
  'title:' || nullif(lower({t("title")}), '') || '|year:' || nullif({t("publication_year")}, ''),
  'title:' || nullif(lower({t("title")}), '')], lambda x: x IS NOT NULL) AS a,
  'abstract:' || nullif(lower(left({t("abstract")}, 200)), '') AS b FROM pubmed_records),
f AS (SELECT rec_id, CASE WHEN len(a) > 0 THEN a WHEN b IS NOT NULL THEN [b] ELSE [] END AS ks FROM k)
SELECT rec_id, i - 1 AS pos, ks[i] AS k FROM (SELECT rec_id, ks, CAST(unnest(range(1, len(ks) + 1)) AS INTEGER) AS i FROM f)""",
)
def fn_decision_keys(spark, sf):
    r = table(spark, sf, "pubmed_records")
    c = F.col
    return r.select(
        "rec_id",
        F.posexplode(
            K.decision_keys(c("pmid"), c("doi"), F.lit(None).cast("string"), c("title"), c("publication_year"), c("abstract"))
        ).alias("pos", "k"),
    )


@query("fn_canonical_key")
def fn_canonical_key(spark, sf):
    """Unicode folding has no SQL twin; tested against a plain Python version."""
    return table(spark, sf, "papers").select(
        "identifier",
        K.canonical_key(F.col("doi"), F.col("title"), F.col("authors")).alias("canonical_key"),
        K.dedupe_key(F.col("doi"), F.col("identifier")).alias("dedupe_key"),
    )


_SLUG = "coalesce(nullif(regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]{p}', '-', 'g'), '^-+|-+$', '', 'g'), ''), '{d}')"


@query(
    "fn_slug",
    f"SELECT theory_id, {_SLUG.format(c='label', p='+', d='theory')} AS slug_, {_SLUG.format(c='label', p='', d='theory')} AS slug_chars FROM aging_ontology",
)
def fn_slug(spark, sf):
    return table(spark, sf, "aging_ontology").select(
        "theory_id", T.slug("label").alias("slug_"), T.slug_per_char("label").alias("slug_chars")
    )


_SECTIONS = f"""array_to_string(list_filter(list_transform(sections, lambda s: array_to_string(list_filter(
  [{t("coalesce(s.title, '')")}, {t("coalesce(s.text, '')")}], lambda x: x <> ''), chr(10))), lambda x: x <> ''), chr(10) || chr(10))"""
ANALYSIS = f"coalesce(CASE WHEN {t('full_text')} <> '' THEN full_text END, nullif({_SECTIONS}, ''), abstract, '')"


@query("fn_analysis_text", f"SELECT identifier, md5({ANALYSIS}) AS digest, length({ANALYSIS}) AS n FROM papers")
def fn_analysis_text(spark, sf):
    a = T.analysis_text()
    return table(spark, sf, "papers").select("identifier", F.md5(a).alias("digest"), F.length(a).alias("n"))


@query(
    "fn_sentences",
    f"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(replace(text, chr(10), ' '), '.'), lambda x: {t("x")}), lambda x: x <> '') AS ss
  FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, ss[i] AS sentence FROM (SELECT doc_id, ss, unnest(range(1, len(ss) + 1)) AS i FROM s)""",
)
def fn_sentences(spark, sf):
    return table(spark, sf, "documents").where("text IS NOT NULL").select(
        "doc_id", F.posexplode(T.sentences("text")).alias("pos", "sentence")
    )


_HTML = r"""left({0}, 500000)"""


@query(
    "fn_strip_html",
    r"""WITH a AS (SELECT rec_id, regexp_replace(regexp_replace(regexp_replace(title, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'),
  '(?i)<br\s*/?>|</p>', chr(10), 'g'), '<[^>]+>', ' ', 'g') AS t FROM openalex_records),
b AS (SELECT rec_id, replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS t FROM a)
SELECT rec_id, regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS plain FROM b""",
)
def fn_strip_html(spark, sf):
    return table(spark, sf, "openalex_records").select("rec_id", T.strip_html("title").alias("plain"))


@query(
    "fn_tidy_lines",
    r"""SELECT identifier, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(full_text, '\r\n?', chr(10), 'g'),
  '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS digest FROM papers""",
)
def fn_tidy_lines(spark, sf):
    return table(spark, sf, "papers").select("identifier", F.md5(T.tidy_lines("full_text")).alias("digest"))


@query(
    "fn_clean_label",
    r"SELECT mention_id, loaded_at, regexp_replace(regexp_replace(label, '\s+', ' ', 'g'), '[ \-:,.;]+$', '') AS clean FROM theory_mentions",
)
def fn_clean_label(spark, sf):
    return table(spark, sf, "theory_mentions").select("mention_id", "loaded_at", T.clean_label("label").alias("clean"))


_SNIP = f"concat_ws(' - ', nullif({t('title')}, ''), nullif({t('abstract')}, ''))"


@query("fn_snippet", f"SELECT rec_id, CASE WHEN length({_SNIP}) > 400 THEN left({_SNIP}, 397) || '...' ELSE {_SNIP} END AS snippet FROM pubmed_records")
def fn_snippet(spark, sf):
    return table(spark, sf, "pubmed_records").select("rec_id", T.snippet("title", "abstract").alias("snippet"))


@query(
    "fn_theme_tokens",
    f"""SELECT w, count(*) AS n FROM (SELECT unnest(list_transform(regexp_extract_all(title, '[A-Za-z][A-Za-z\\-]{{2,}}'),
  lambda x: regexp_replace(lower(x), '^[- ]+|[- ]+$', '', 'g'))) AS w FROM papers) WHERE w NOT IN ({", ".join(f"'{s}'" for s in STOP)}) GROUP BY w""",
)
def fn_theme_tokens(spark, sf):
    return table(spark, sf, "papers").select(F.explode(T.theme_tokens("title", STOP)).alias("w")).groupBy("w").agg(F.count("*").alias("n"))


@query(
    "fn_query_keywords",
    r"""SELECT theory_id, k FROM (SELECT theory_id, unnest(list_distinct(list_filter(list_transform(list_filter(
  regexp_split_to_array(regexp_replace(label, '[()\[\]{},;:|"'']+', ' ', 'g'), '\s+'), lambda w: w <> '' AND upper(w) NOT IN ('AND', 'OR', 'NOT')),
  lambda w: lower(regexp_replace(w, '^[^A-Za-z0-9\-]+|[^A-Za-z0-9\-]+$', '', 'g'))), lambda w: w <> ''))) AS k FROM aging_ontology)""",
)
def fn_query_keywords(spark, sf):
    return table(spark, sf, "aging_ontology").select("theory_id", F.explode(T.query_keywords("label")).alias("k"))


@query(
    "fn_query_variants",
    f"""SELECT theory_id, CAST(i - 1 AS INTEGER) AS pos, v[i] AS variant FROM (SELECT theory_id, v, unnest(range(1, len(v) + 1)) AS i FROM (
  SELECT theory_id, list_filter([{t("label")}, CASE WHEN contains({t("label")}, ' ') THEN '"' || {t("label")} || '"' END,
  CASE WHEN NOT contains(lower(label), 'aging') AND NOT contains(lower(label), 'ageing') THEN {t("label")} || ' aging' END,
  CASE WHEN NOT contains(lower(label), 'theory') THEN {t("label")} || ' theory' END], lambda x: x IS NOT NULL) AS v FROM aging_ontology))""",
)
def fn_query_variants(spark, sf):
    return table(spark, sf, "aging_ontology").select("theory_id", F.posexplode(T.query_variants("label")).alias("pos", "variant"))


_LEX = "list_filter(regexp_split_to_array(lower(label), '[^a-z0-9]+'), lambda w: w <> '')"


@query("fn_lexical_signature", f"SELECT theory_id, array_to_string({_LEX}, ' ') AS plain, array_to_string(list_sort({_LEX}), ' ') AS ordered FROM aging_ontology")
def fn_lexical_signature(spark, sf):
    return table(spark, sf, "aging_ontology").select("theory_id", T.lexical_signature("label").alias("x")).select("theory_id", "x.plain", "x.ordered")


@query("fn_token_estimate", "SELECT doc_id, CAST(ceil(length(text) / 4.0) AS INTEGER) AS tokens FROM documents WHERE text IS NOT NULL")
def fn_token_estimate(spark, sf):
    return table(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", T.token_estimate("text").alias("tokens"))


@query(
    "fn_merge_strings",
    f"""WITH x AS (SELECT theory_id, list_filter(list_transform(list_concat([label], coalesce(aliases, []), [lower(label)]), lambda v: {t("v")}), lambda v: v <> '') AS l FROM aging_ontology),
e AS (SELECT theory_id, l[i] AS v, i FROM (SELECT theory_id, l, unnest(range(1, len(l) + 1)) AS i FROM x))
SELECT theory_id, v FROM (SELECT *, row_number() OVER (PARTITION BY theory_id, lower(v) ORDER BY i) AS r FROM e) WHERE r = 1""",
)
def fn_merge_strings(spark, sf):
    r = table(spark, sf, "aging_ontology")
    return r.select("theory_id", F.explode(T.merge_strings(F.array("label"), F.col("aliases"), F.array(F.lower("label")))).alias("v"))


@query(
    "fn_review_like",
    r"""SELECT identifier, coalesce(is_review, regexp_matches(concat_ws(' ', title, abstract, full_text), '(?i)\b(review|systematic review|meta-?analysis)\b')) AS review FROM papers""",
)
def fn_review_like(spark, sf):
    c = F.col
    return table(spark, sf, "papers").select("identifier", T.review_like(c("is_review"), c("title"), c("abstract"), c("full_text")).alias("review"))


@query(
    "fn_year",
    f"""SELECT rec_id, CAST(coalesce(nullif(regexp_extract({t("publication_year")}, '^([0-9]{{4}})', 1), ''),
  nullif(regexp_extract({t("publication_year")}, '((?:19|20)[0-9]{{2}})', 1), '')) AS INTEGER) AS year_, coalesce(CAST(coalesce(nullif(regexp_extract({t("publication_year")}, '^([0-9]{{4}})', 1), ''),
  nullif(regexp_extract({t("publication_year")}, '((?:19|20)[0-9]{{2}})', 1), '')) AS INTEGER), 9999) AS sort_year FROM openalex_records""",
)
def fn_year(spark, sf):
    y = T.year_of("publication_year")
    return table(spark, sf, "openalex_records").select("rec_id", y.alias("year_"), F.coalesce(y, F.lit(9999)).alias("sort_year"))


@query(
    "fn_split_authors",
    f"""SELECT identifier, CAST(i - 1 AS INTEGER) AS pos, a[i] AS author FROM (SELECT identifier, a, unnest(range(1, len(a) + 1)) AS i FROM (
  SELECT identifier, list_filter(list_transform(CASE WHEN contains(j, ';') THEN string_split(j, ';') WHEN contains(j, '|') THEN string_split(j, '|') ELSE string_split(j, ',') END,
  lambda x: {t("x")}), lambda x: x <> '') AS a FROM (SELECT identifier, array_to_string(authors, '; ') AS j FROM papers)))""",
)
def fn_split_authors(spark, sf):
    return table(spark, sf, "papers").select("identifier", F.posexplode(T.split_authors(F.array_join("authors", "; "))).alias("pos", "author"))


@query(
    "fn_flag",
    f"""SELECT DISTINCT answer, CASE WHEN lower({t("answer")}) IN ('true', '1', 'yes', 'y', 'on') THEN true
  WHEN lower({t("answer")}) IN ('false', '0', 'no', 'n', 'off') THEN false END AS flag FROM question_answers""",
)
def fn_flag(spark, sf):
    return table(spark, sf, "question_answers").select("answer", T.as_flag("answer").alias("flag")).distinct()


_CONF = "CASE WHEN isnan(confidence) THEN NULL ELSE confidence END"


@query(
    "fn_confidence",
    f"""SELECT answer_id, loaded_at, round(CASE WHEN v IS NULL THEN 0.0 ELSE greatest(0.0, least(1.0, CASE WHEN v > 1.5 THEN v / 100 ELSE v END)) END, 9) AS conf
FROM (SELECT answer_id, loaded_at, {_CONF} AS v FROM question_answers)""",
)
def fn_confidence(spark, sf):
    return table(spark, sf, "question_answers").select(
        "answer_id", "loaded_at", F.round(F.coalesce(T.confidence_of(F.col("confidence")), F.lit(0.0)), 9).alias("conf")
    )


@query("fn_decode_inverted", "SELECT theory_id, lower(label) AS decoded FROM aging_ontology")
def fn_decode_inverted(spark, sf):
    """Labels turned into a word to positions map and read back."""
    words = F.split(F.lower("label"), " ")
    inv = table(spark, sf, "aging_ontology").select("theory_id", F.posexplode(words).alias("p", "w")).groupBy("theory_id", "w").agg(F.collect_list("p").alias("ps"))
    maps = inv.groupBy("theory_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("m"))
    return maps.select("theory_id", T.decode_inverted(F.col("m")).alias("decoded"))


@query(
    "fn_json_salvage",
    r"""SELECT answer_id, loaded_at, coalesce(CASE WHEN json_valid(evidence) AND json_type(evidence) = 'OBJECT' THEN json_extract_string(evidence, '$.quote') END,
  CASE WHEN NOT coalesce(json_valid(evidence), false) AND json_valid(nullif(regexp_extract(evidence, '(?s)\{.*\}', 0), '')) THEN json_extract_string(nullif(regexp_extract(evidence, '(?s)\{.*\}', 0), ''), '$.quote') END) AS quote
FROM question_answers""",
)
def fn_json_salvage(spark, sf):
    """The quote of the evidence; broken JSON is tried again from its first to its last brace."""
    whole = F.get_json_object("evidence", "$.quote")
    part = F.get_json_object(F.regexp_extract("evidence", r"(?s)\{.*\}", 0), "$.quote")
    return table(spark, sf, "question_answers").select("answer_id", "loaded_at", F.coalesce(whole, part).alias("quote"))


@query(
    "fn_link_pick",
    """SELECT rec_id, coalesce(list_filter(l, lambda x: suffix(lower(x), '.pdf'))[1], l[1]) AS link
FROM (SELECT rec_id, list_sort(map_values(fulltext_links)) AS l FROM openalex_records WHERE fulltext_links IS NOT NULL)""",
)
def fn_link_pick(spark, sf):
    links = F.array_sort(F.map_values("fulltext_links"))
    return table(spark, sf, "openalex_records").where("fulltext_links IS NOT NULL").select(
        "rec_id", F.coalesce(F.get(F.filter(links, lambda x: F.lower(x).endswith(".pdf")), F.lit(0)), F.get(links, F.lit(0))).alias("link")
    )


@query("fn_number_parse", f"SELECT rec_id, try_cast({t('publication_year')} AS INTEGER) AS n, coalesce(try_cast({t('pmid')} AS DOUBLE), -1.0) AS d FROM openalex_records")
def fn_number_parse(spark, sf):
    r = table(spark, sf, "openalex_records").withColumn("y", T.trimmed("publication_year")).withColumn("p", T.trimmed("pmid"))
    return r.select("rec_id", F.expr("try_cast(y as int)").alias("n"), F.expr("coalesce(try_cast(p as double), -1.0D)").alias("d"))


@query(
    "fn_answer_label",
    rf"""SELECT answer_id, loaded_at, {t("split_part(answer, ' - ', 1)")} AS strict,
  CASE WHEN lower({t("split_part(split_part(split_part(answer, ' - ', 1), '—', 1), '–', 1)")}) IN ('yes', 'no')
  THEN upper(left({t("split_part(split_part(split_part(answer, ' - ', 1), '—', 1), '–', 1)")}, 1)) || lower(substr({t("split_part(split_part(split_part(answer, ' - ', 1), '—', 1), '–', 1)")}, 2))
  ELSE {t("split_part(split_part(split_part(answer, ' - ', 1), '—', 1), '–', 1)")} END AS label
FROM question_answers""",
)
def fn_answer_label(spark, sf):
    """The part before a dash: for validation cut at a hyphen only, for tables at any dash with yes and no in one spelling."""
    any_dash = F.col("answer")
    for mark in (" - ", "—", "–"):
        any_dash = F.substring_index(any_dash, mark, 1)
    label = T.trimmed(any_dash)
    same = F.when(F.lower(label).isin("yes", "no"), F.concat(F.upper(F.left(label, F.lit(1))), F.lower(F.substring(label, 2, 10)))).otherwise(label)
    return table(spark, sf, "question_answers").select(
        "answer_id", "loaded_at", T.trimmed(F.substring_index("answer", " - ", 1)).alias("strict"), same.alias("label")
    )

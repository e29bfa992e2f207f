"""Pages captured from bibliographic services, mapped to papers and review records.

Each function takes a frame with a string column ``page`` holding one response
and returns rows; no network is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.functions.keys import doi_norm, openalex_norm
from lorewright.functions.text import decode_inverted, split_authors, trimmed

_OPENALEX = (
    "results array<struct<id:string,doi:string,display_name:string,title:string,publication_year:int,cited_by_count:int,type:string,type_crossref:string,"
    "ids:struct<pmid:string>,abstract_inverted_index:map<string,array<int>>,authorships:array<struct<author:struct<display_name:string>>>,"
    "primary_location:struct<pdf_url:string,landing_page_url:string,source:struct<display_name:string>>,best_oa_location:struct<pdf_url:string>,"
    "open_access:struct<is_oa:boolean,oa_status:string,oa_url:string>>>, meta struct<next_cursor:string>"
)
_CROSSREF = (
    "message struct<items:array<struct<DOI:string,URL:string,title:array<string>,abstract:string,type:string,`is-referenced-by-count`:int,"
    "author:array<struct<given:string,family:string>>,issued:struct<`date-parts`:array<array<int>>>,reference:array<map<string,string>>>>>"
)
_SCHOLAR = "organic_results array<struct<result_id:string,title:string,link:string,snippet:string,publication_info:struct<summary:string>,inline_links:struct<cited_by:struct<total:int>>>>, serpapi_pagination struct<next:string>"
_S2 = "data array<struct<paperId:string,corpusId:string,externalIds:map<string,string>,url:string,title:string,abstract:string,year:int,citationCount:int,publicationTypes:array<string>,authors:array<struct<name:string>>>>, next int"
_RXIV = "collection array<struct<doi:string,title:string,authors:string,abstract:string,category:string,date:string>>, messages array<struct<count:int,total:int,cursor:int>>"


def _items(pages: DataFrame, schema: str, path: str, order: tuple[str, ...] = ()) -> DataFrame:
    """``x`` for every item of the pages; with the columns of the pages to order by and the item's place."""
    return pages.select(*order, F.from_json("page", schema).alias("p")).select(*order, F.posexplode(f"p.{path}").alias("place", "x"))


def openalex_papers(pages: DataFrame) -> DataFrame:
    """Works as papers; a review if any type field says so."""
    x = F.col
    return _items(pages, _OPENALEX, "results").select(
        x("x.id").alias("identifier"), F.coalesce("x.title", "x.display_name").alias("title"), decode_inverted(x("x.abstract_inverted_index")).alias("abstract"),
        F.transform("x.authorships", lambda a: a["author"]["display_name"]).alias("authors"), x("x.publication_year").alias("year"),
        x("x.cited_by_count").alias("citation_count"), doi_norm("x.doi").alias("doi"),
        F.lower(F.concat_ws(" ", "x.type", "x.type_crossref")).contains("review").alias("is_review"),
        F.array_distinct(F.array_compact(F.array(x("x.best_oa_location.pdf_url"), x("x.primary_location.pdf_url"), x("x.open_access.oa_url")))).alias("links"),
    )


def openalex_reviews(pages: DataFrame) -> DataFrame:
    """Works as review records; the PubMed id is the last part of its address.

    The first row of a work is kept, by the column ``number`` of the pages where there is one, then by place in the page;
    works without an id are each their own.
    """
    x = F.col
    order = ("number",) if "number" in pages.columns else ()
    rows = _items(pages, _OPENALEX, "results", order).select(
        *order, "place",
        F.element_at(F.split("x.ids.pmid", "/"), -1).alias("pmid"), F.coalesce("x.title", "x.display_name").alias("title"),
        decode_inverted(x("x.abstract_inverted_index")).alias("abstract"), F.array_compact(F.array(x("x.type"), x("x.type_crossref"))).alias("publication_types"),
        F.transform("x.authorships", lambda a: a["author"]["display_name"]).alias("authors"), x("x.primary_location.source.display_name").alias("journal"),
        x("x.publication_year").cast("string").alias("publication_year"), doi_norm("x.doi").alias("doi"), openalex_norm("x.id").alias("openalex_id"),
        x("x.id").alias("openalex_url"), F.array(F.lit("openalex")).alias("sources"),
        F.map_filter(F.create_map(F.lit("best"), x("x.best_oa_location.pdf_url"), F.lit("primary"), x("x.primary_location.pdf_url")), lambda k, v: v.isNotNull()).alias("fulltext_links"),
        F.to_json("x.open_access").alias("open_access"),
    )
    names = [c for c in rows.columns if c not in (*order, "place")]
    # as a map has no order, rows of one place are told apart by their text
    first = F.struct(*order, "place", F.to_json(F.struct(*names)))
    named = rows.where("openalex_id IS NOT NULL").groupBy("openalex_id").agg(F.min_by(F.struct(*names), first).alias("r")).select("r.*")
    return named.unionByName(rows.where("openalex_id IS NULL").select(*names))


def crossref_papers(pages: DataFrame) -> DataFrame:
    x = F.col
    return _items(pages, _CROSSREF, "message.items").select(
        F.coalesce(F.concat(F.lit("crossref:"), "x.DOI"), x("x.URL")).alias("identifier"), F.get("x.title", F.lit(0)).alias("title"),
        x("x.abstract").alias("abstract"), F.transform("x.author", lambda a: F.trim(F.concat_ws(" ", a["given"], a["family"]))).alias("authors"),
        F.get(F.get("x.issued.date-parts", F.lit(0)), F.lit(0)).alias("year"), F.col("x.is-referenced-by-count").alias("citation_count"), doi_norm("x.DOI").alias("doi"),
        F.lower("x.type").contains("review").alias("is_review"),
        F.array_compact(F.transform("x.reference", lambda r: F.coalesce(r["DOI"], r["doi"], r["key"]))).alias("influential_citations"),
    )


def scholar_papers(pages: DataFrame) -> DataFrame:
    """Search results; year and DOI are read out of the summary and the address."""
    x = F.col
    return _items(pages, _SCHOLAR, "organic_results").select(
        F.coalesce("x.result_id", "x.link").alias("identifier"), x("x.title").alias("title"), x("x.snippet").alias("abstract"),
        F.filter(F.transform(F.split(F.substring_index("x.publication_info.summary", " - ", 1), ","), trimmed), lambda a: a != "").alias("authors"),
        F.nullif(F.regexp_extract("x.publication_info.summary", r"((?:19|20)[0-9]{2})", 1), F.lit("")).cast("int").alias("year"),
        F.coalesce("x.inline_links.cited_by.total", F.lit(0)).alias("citation_count"),
        F.nullif(F.regexp_extract(F.lower("x.link"), r"(10\.[0-9]{4,9}/[^\s?#]+)", 1), F.lit("")).alias("doi"),
    )


def scholar_cursor(pages: DataFrame) -> DataFrame:
    """The start of the next page, out of its address."""
    nxt = F.from_json("page", _SCHOLAR)["serpapi_pagination"]["next"]
    return pages.select(F.regexp_extract(nxt, r"[?&]start=([0-9]+)", 1).cast("int").alias("next_start"), nxt.isNull().alias("exhausted"))


def semantic_scholar_papers(pages: DataFrame) -> DataFrame:
    """Identifier by the first that is there: paper id, corpus id, DOI, address, digest of title, year and abstract."""
    x = F.col
    digest = F.sha1(F.concat_ws("|", "x.title", "x.year", F.left("x.abstract", F.lit(80))))
    return _items(pages, _S2, "data").select(
        F.coalesce("x.paperId", F.concat(F.lit("CorpusId:"), "x.corpusId"), x("x.externalIds")["DOI"], x("x.url"), digest).alias("identifier"),
        x("x.title").alias("title"), x("x.abstract").alias("abstract"), F.transform("x.authors", lambda a: a["name"]).alias("authors"),
        x("x.year").alias("year"), x("x.citationCount").alias("citation_count"), doi_norm(x("x.externalIds")["DOI"]).alias("doi"),
        F.exists(F.coalesce("x.publicationTypes", F.array().cast("array<string>")), lambda t: F.lower(t).contains("review")).alias("is_review"),
    )


_ACCESS = "result array<map<string,string>>, next string"
_ARCHIVE = "results array<struct<md5:string,id:string,isbn:string,title:string,description:string,abstract:string,author:string,authors:string,year:string,doi:string,identifiers:struct<doi:string>>>, next string"


def _text(c) -> Column:
    return F.coalesce(trimmed(c), F.lit(""))


def _first(*cs) -> Column:
    """The first that is not blank."""
    return F.coalesce(*[F.nullif(_text(c), F.lit("")) for c in cs])


def access_papers(pages: DataFrame, prefix: str) -> DataFrame:
    """Records of a full-text access service, flat mappings of varying keys; ``links`` are its addresses and the DOI's, once each.

    Identifier: the record's own, its address, else the DOI or a digest under the prefix.
    """
    r = _items(pages, _ACCESS, "result")
    of = lambda k: F.col("x")[k]
    doi = _first(of("doi"))
    digest = F.sha1(F.concat_ws("|", _text(of("title")), F.coalesce(doi, F.lit("None")), F.coalesce(of("year"), F.lit(""))))
    year = F.regexp_extract(_first(of("year"), of("publication_year")), r"((?:18|19|20)[0-9]{2})", 1)
    links = F.array_distinct(F.array_compact(F.array(*[_first(of(k)) for k in ("fullTextUrl", "fulltext", "pdfUrl", "pdf", "url")], F.concat(F.lit("https://doi.org/"), doi))))
    return r.select(
        F.coalesce(_first(of("identifier"), of("id"), of("url")), F.concat(F.lit(prefix + ":"), F.coalesce(doi, digest))).alias("identifier"),
        _text(of("title")).alias("title"), F.coalesce(_first(of("abstract"), of("description")), F.lit("")).alias("abstract"),
        split_authors(_first(of("authors"), of("author"))).alias("authors"), F.nullif(year, F.lit("")).cast("int").alias("year"), doi.alias("doi"),
        F.filter(links, lambda u: u.startswith("http")).alias("links"),
    )


def archive_papers(pages: DataFrame, prefix: str) -> DataFrame:
    """Records of a book and paper archive: digest, id or ISBN as identifier, the DOI also from the nested identifiers."""
    x = F.col
    doi = _first("x.doi", "x.identifiers.doi")
    year = F.regexp_extract(F.coalesce("x.year", F.lit("")), r"((?:18|19|20)[0-9]{2})", 1)
    key = F.coalesce(_first("x.md5", "x.id", "x.isbn"), doi, F.sha1(F.concat_ws("|", _text("x.title"), _text("x.year"))))
    return _items(pages, _ARCHIVE, "results").select(
        F.concat(F.lit(prefix + ":"), key).alias("identifier"), _text("x.title").alias("title"), F.coalesce(_first("x.description", "x.abstract"), F.lit("")).alias("abstract"),
        split_authors(_first("x.authors", x("x.author"))).alias("authors"), F.nullif(year, F.lit("")).cast("int").alias("year"), doi.alias("doi"),
    )


def next_cursor(pages: DataFrame, schema: str = "next string") -> DataFrame:
    """``next_cursor, exhausted`` of every page."""
    nxt = F.nullif(trimmed(F.from_json("page", schema)["next"]), F.lit(""))
    return pages.select(nxt.alias("next_cursor"), nxt.isNull().alias("exhausted"))


def rxiv_papers(pages: DataFrame, query: str = "", categories: list[str] | None = None) -> DataFrame:
    """Preprints whose title, abstract, authors and category hold every term; an abstract 'na' is empty."""
    x = F.col
    hay = F.lower(F.concat_ws(" ", "x.title", "x.abstract", "x.authors", "x.category"))
    rows = _items(pages, _RXIV, "collection")
    for term in query.lower().split():
        rows = rows.where(F.contains(hay, F.lit(term)))
    if categories:
        rows = rows.where(F.lower("x.category").isin(*[c.lower() for c in categories]))
    return rows.select(
        x("x.doi").alias("identifier"), x("x.title").alias("title"), F.when(F.lower(F.trim("x.abstract")) == "na", "").otherwise(x("x.abstract")).alias("abstract"),
        split_authors("x.authors").alias("authors"), F.left("x.date", F.lit(4)).cast("int").alias("year"), doi_norm("x.doi").alias("doi"), x("x.category").alias("category"),
    )


_PUBMED = (
    "MedlineCitation struct<PMID:string,Article:struct<ArticleTitle:string,Journal:struct<Title:string,JournalIssue:struct<PubDate:struct<Year:string,MedlineDate:string>>>,"
    "Abstract:struct<AbstractText:array<struct<_Label:string,_NlmCategory:string,_VALUE:string>>>,"
    "AuthorList:struct<Author:array<struct<LastName:string,ForeName:string,CollectiveName:string>>>>>,"
    "PubmedData struct<ArticleIdList:struct<ArticleId:array<struct<_IdType:string,_VALUE:string>>>>"
)


def pubmed_reviews(articles: DataFrame) -> DataFrame:
    """Review records from one article element per row in a string column ``xml``.

    Abstract parts get their label, group authors their name, and a year without
    its own field is the first word of the date text.
    """
    a = articles.select(F.from_xml("xml", _PUBMED).alias("a"))
    art, date = "a.MedlineCitation.Article", "a.MedlineCitation.Article.Journal.JournalIssue.PubDate"
    parts = F.transform(
        f"{art}.Abstract.AbstractText",
        lambda t: F.when(F.coalesce(t["_Label"], t["_NlmCategory"]).isNotNull(), F.concat(F.coalesce(t["_Label"], t["_NlmCategory"]), F.lit(": "), t["_VALUE"])).otherwise(t["_VALUE"]),
    )
    of = lambda kind: F.get(F.transform(F.filter("a.PubmedData.ArticleIdList.ArticleId", lambda i: i["_IdType"] == kind), lambda i: i["_VALUE"]), F.lit(0))
    people = F.transform(f"{art}.AuthorList.Author", lambda p: F.coalesce(p["CollectiveName"], F.trim(F.concat_ws(" ", p["ForeName"], p["LastName"]))))
    return a.select(
        F.col("a.MedlineCitation.PMID").alias("pmid"), F.col(f"{art}.ArticleTitle").alias("title"), F.array_join(parts, "\n").alias("abstract"), people.alias("authors"),
        F.col(f"{art}.Journal.Title").alias("journal"), F.coalesce(f"{date}.Year", F.substring_index(f"{date}.MedlineDate", " ", 1)).alias("publication_year"),
        doi_norm(of("doi")).alias("doi"), of("pmc").alias("pmcid"), F.array(F.lit("pubmed")).alias("sources"),
    )


def missing_bodies(requested: DataFrame, returned: DataFrame) -> DataFrame:
    """Requested ids without a text in the answer: ``pmcid, status`` (text, missing or failed)."""
    r = returned.select("pmcid", F.when(F.trim("text") != "", "text").otherwise("missing").alias("got"))
    return requested.join(r, "pmcid", "left").select("pmcid", F.coalesce("got", F.lit("failed")).alias("status"))


def resolve_full_text(records: DataFrame) -> DataFrame:
    """Full text by preference: article body, then text of the linked file, then its recognised text; else the reason.

    records: pmid, body, pdf_text, ocr_text, body_error, pdf_error (NULL where not there).
    """
    has = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    source = F.when(has("body"), "pmc").when(has("pdf_text"), "pdf").when(has("ocr_text"), "ocr")
    text = F.when(has("body"), F.col("body")).when(has("pdf_text"), F.col("pdf_text")).when(has("ocr_text"), F.col("ocr_text"))
    reason = F.when(source.isNull(), F.coalesce("pdf_error", "body_error", F.lit("no_full_text")))
    return records.select("pmid", text.alias("full_text"), source.alias("full_text_source"), reason.alias("failure"))

import json

import pytest

from lorewright.sources import payloads as P
from lorewright.sources import provider, readers, sinks
from lorewright.streaming import events as EV


def page(spark, obj):
    return spark.createDataFrame([(json.dumps(obj),)], "page string")


def test_openalex_page(spark):
    work = {"id": "https://openalex.org/W12", "doi": "https://doi.org/10.1/X", "title": "T", "publication_year": 2020, "cited_by_count": 4, "type": "review",
            "ids": {"pmid": "https://pubmed/123"}, "abstract_inverted_index": {"b": [1], "a": [0, 2]}, "authorships": [{"author": {"display_name": "A B"}}]}
    r = P.openalex_papers(page(spark, {"results": [work]})).collect()[0]
    assert (r["abstract"], r["doi"], r["is_review"], r["authors"]) == ("a b a", "10.1/x", True, ["A B"])
    v = P.openalex_reviews(page(spark, {"results": [work, work]})).collect()
    assert len(v) == 1 and v[0]["pmid"] == "123" and v[0]["openalex_id"] == "W12"


def test_crossref_and_scholar_and_rxiv(spark):
    c = P.crossref_papers(page(spark, {"message": {"items": [{"DOI": "10.2/Y", "title": ["T"], "author": [{"given": "A", "family": "B"}], "issued": {"date-parts": [[2019, 1]]}, "reference": [{"key": "k"}]}]}})).collect()[0]
    assert (c["identifier"], c["authors"], c["year"], c["influential_citations"]) == ("crossref:10.2/Y", ["A B"], 2019, ["k"])
    s = page(spark, {"organic_results": [{"title": "T", "link": "http://x/10.3000/z", "publication_info": {"summary": "A B, C D - J, 2018"}}], "serpapi_pagination": {"next": "http://s?start=20&x=1"}})
    row = P.scholar_papers(s).collect()[0]
    assert (row["year"], row["doi"], row["authors"]) == (2018, "10.3000/z", ["A B", "C D"])
    assert P.scholar_cursor(s).collect()[0]["next_start"] == 20
    x = page(spark, {"collection": [{"doi": "10.4/a", "title": "Aging mice", "authors": "A, B; C, D", "abstract": "na", "category": "cell", "date": "2021-03-01"}]})
    assert P.rxiv_papers(x, "mice cell", ["Cell"]).collect()[0]["abstract"] == ""
    assert P.rxiv_papers(x, "yeast").count() == 0


def test_semantic_scholar_identifier_falls_back_to_a_digest(spark):
    r = P.semantic_scholar_papers(page(spark, {"data": [{"title": "T", "year": 1}, {"corpusId": "5", "title": "U"}]})).collect()
    assert len(r[0]["identifier"]) == 40 and r[1]["identifier"] == "CorpusId:5"


def test_pubmed_xml(spark):
    xml = """<PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>T</ArticleTitle><Journal><Title>J</Title><JournalIssue><PubDate><MedlineDate>2001 Mar</MedlineDate></PubDate></JournalIssue></Journal>
<Abstract><AbstractText Label="AIM">one</AbstractText><AbstractText>two</AbstractText></Abstract><AuthorList><Author><CollectiveName>Group</CollectiveName></Author></AuthorList></Article></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/q</ArticleId></ArticleIdList></PubmedData></PubmedArticle>"""
    r = P.pubmed_reviews(spark.createDataFrame([(xml,)], "xml string")).collect()[0]
    assert (r["abstract"], r["authors"], r["publication_year"], r["doi"]) == ("AIM: one\ntwo", ["Group"], "2001", "10.1/q")


def test_full_text_order_and_missing(spark):
    df = spark.createDataFrame([("1", "b", "p", None, None, None), ("2", " ", None, "o", None, None), ("3", None, None, None, "e", None)], "pmid string, body string, pdf_text string, ocr_text string, body_error string, pdf_error string")
    got = {r["pmid"]: (r["full_text_source"], r["failure"]) for r in P.resolve_full_text(df).collect()}
    assert got == {"1": ("pmc", None), "2": ("ocr", None), "3": (None, "e")}


def test_csv_round_trip(spark, tmp_path):
    rows = [("p1", 'A "quoted"\ntitle', ["X; Y", "Z"], 3, True), ("p2", None, None, None, None)]
    df = spark.createDataFrame(rows, "identifier string, title string, authors array<string>, citation_count int, is_review boolean")
    sinks.write_csv(sinks.papers_table(df), str(tmp_path / "p"))
    back = {r["identifier"]: r for r in readers.papers_csv(spark, str(tmp_path / "p")).collect()}
    assert back["p1"]["title"] == 'A "quoted"\ntitle' and back["p1"]["is_review"] is True and back["p2"]["citation_count"] is None


def test_ground_truth_checks_questions(spark, tmp_path):
    f = tmp_path / "g.csv"
    f.write_text("theory_id,paper_url,question_id,expected_answer\nt,p,q1,Yes\n,p,Q2,No\n")
    rows = readers.ground_truth(spark, str(f), ["Q1", "Q2"]).collect()
    assert [(r["theory"], r["question_id"]) for r in rows] == [("t", "Q1"), (None, "Q2")]
    with pytest.raises(Exception, match="unknown question"):
        readers.ground_truth(spark, str(f), ["Q1"]).collect()


def test_checkpoint_forms(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"index": 1, "x": "a"}, {"index": 2, "x": "b"}]')
    (tmp_path / "b.json").write_text('{"index": 1, "x": "a"}\nbroken\n{"index": 3, "x": "c"}\n')
    for name, n in (("a.json", 2), ("b.json", 2)):
        assert readers.checkpoint(spark, str(tmp_path / name), "index int, x string").count() == n


def test_provider_pages_in_order(spark):
    provider.register(spark, "stored_pages", lambda options: provider.StoredPages({"q": [[{"a": 1}], [{"a": 2}, {"a": 3}]]}))
    rows = spark.read.format("stored_pages").option("queries", json.dumps(["q", "none"])).load().orderBy("ordinal").collect()
    assert [json.loads(r["paper"])["a"] for r in rows] == [1, 2, 3]


def test_stream_resumes_and_drops_repeats(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    make = lambda ids: spark.createDataFrame([(i, i, "a") for i in ids], "event_id bigint, user_id bigint, event_type string").selectExpr(
        "event_id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, CAST(event_id AS INT)) AS ts", "user_id", "event_type", "CAST(1 AS DOUBLE) AS value", "'{}' AS props")
    make([1, 2, 2]).write.mode("append").parquet(src)
    EV.run_available(EV.first_events(EV.read_events(spark, src)), out, ck)
    make([2, 3]).write.mode("append").parquet(src)
    EV.run_available(EV.first_events(EV.read_events(spark, src)), out, ck)
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_checkpoints_last_row_of_an_index_wins(spark, tmp_path):
    lines = tmp_path / "c.jsonl"
    lines.write_text('{"index": 0, "name": "a"}\n{"index": 1, "name": "b"}\n{"index": 0, "name": "z"}\n{"name": "lost"}\nbroken\n')
    assert {r["index"]: r["name"] for r in readers.checkpoint(spark, str(lines), "index int, name string").collect()} == {0: "z", 1: "b"}
    array = tmp_path / "c.json"
    array.write_text('[{"name": "a"}, {"name": "b"},\n {"index": 0, "name": "z"}]')
    assert {r["index"]: r["name"] for r in readers.checkpoint(spark, str(array), "index int, name string").collect()} == {0: "z", 1: "b"}


def test_works_without_an_id_stay_apart_and_the_first_row_is_kept(spark):
    one = {"results": [{"id": "https://openalex.org/W1", "title": "first"}, {"title": "x"}, {"title": "y"}]}
    two = {"results": [{"id": "https://openalex.org/W1", "title": "second"}]}
    pages = spark.createDataFrame([(2, json.dumps(two)), (1, json.dumps(one))], "number int, page string")
    assert sorted(r["title"] for r in P.openalex_reviews(pages).collect()) == ["first", "x", "y"]


def test_access_and_archive_pages(spark):
    a = P.access_papers(page(spark, {"result": [{"title": " T ", "doi": "10.1/a", "authors": "A B; C", "year": "c. 2004", "pdf": "http://x/p.pdf", "url": ""}, {"title": "U", "author": "D|E"}]}), "acc").collect()
    assert (a[0]["identifier"], a[0]["authors"], a[0]["year"], a[0]["links"]) == ("acc:10.1/a", ["A B", "C"], 2004, ["http://x/p.pdf", "https://doi.org/10.1/a"])
    assert a[1]["identifier"].startswith("acc:") and len(a[1]["identifier"]) == 44 and a[1]["authors"] == ["D", "E"] and a[1]["links"] == []
    b = P.archive_papers(page(spark, {"results": [{"isbn": "978", "title": "T", "identifiers": {"doi": "10.2/b"}, "year": "1999"}]}), "arc").collect()[0]
    assert (b["identifier"], b["doi"], b["year"]) == ("arc:978", "10.2/b", 1999)
    assert P.next_cursor(page(spark, {"next": " "})).collect()[0]["exhausted"]


def test_first_of_a_key_is_kept(spark):
    rows = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("s", 1, "c")], "key string, ordinal int, v string")
    assert [(r["key"], r["v"]) for r in sinks.append_new(rows, spark.createDataFrame([("s",)], "key string"), "key").collect()] == [("k", "a")]

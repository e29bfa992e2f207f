"""Schemas of the entities."""

PAPER = (
    "identifier string, title string, abstract string, source string, full_text string, authors array<string>, "
    "influential_citations array<string>, year int, citation_count int, doi string, is_review boolean, "
    "sections array<struct<title:string,text:string>>"
)
REVIEW = (
    "pmid string, title string, abstract string, publication_types array<string>, authors array<string>, journal string, "
    "publication_year string, doi string, openalex_id string, openalex_url string, sources array<string>, "
    "fulltext_links map<string,string>, open_access string"
)
TRUTH = "theory_id string, paper_url string, question_id string, expected_answer string"
QUESTION_ROW = "theory_id string, paper_url string, paper_name string, paper_year string"

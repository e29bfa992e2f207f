"""Survivors of duplicate groups, keyless matching, and identifiers."""

from datetime import datetime

from lorewright.llm import matching, survivor
from lorewright.llm.ids import usable_doi, usable_pmid

REC = "rec_id bigint, pmid string, doi string, title string, abstract string, authors array<string>, sources array<string>, harvested_at timestamp, value string, k int"
TRUST = "source string, trust_rank int"
FULL = "The first finding is about the liver of mice. The second finding is about the heart of rats. The third finding is about the skin."


def test_identifier_spellings(spark):
    df = spark.createDataFrame([(" DOI: 10.99001/AbC.1 ", "PMID 40000001"), ("http://dx.doi.example.org/10.99001/abc.1", " 40000001.0"), ("10.99001/", "4000000"), ("10.", "PMC"), (None, None), ("https://doi.other.com/10.99001/x", "30000001")], "d string, p string")
    got = [(r["d"], r["p"]) for r in df.select(usable_doi("d").alias("d"), usable_pmid("p").alias("p")).collect()]
    assert got == [("10.99001/abc.1", "40000001"), ("10.99001/abc.1", "40000001"), (None, None), (None, None), (None, None), (None, None)]


def rec(i, pmid, doi, abstract, authors, sources, day):
    return (i, pmid, doi, "A title", abstract, authors, sources, datetime(2024, 1, day), "x", 1)


def test_groups_and_survivors(spark):
    wrong = FULL.replace("The second finding is about the heart of rats", "Something else entirely stands here instead")
    rows = [
        rec(1, "40000001", None, FULL[:60], ["A Bond", "C Dole"], ["low"], 1),
        rec(2, "40000001", "10.99001/a", FULL, ["Ann Bond", "Cy Dole"], ["low", "HIGH "], 2),
        rec(3, None, "doi:10.99001/A", wrong, ["Bond, Ann", "Dole, Cy"], ["high"], 3),
        rec(4, "pmid:40000001", "10.", FULL, ["Ann Bond", "et al."], ["mid"], 4),
        rec(5, "40000009", None, FULL, ["Ann Bond"], ["high"], 5),  # alone
        rec(6, None, None, FULL, None, None, 6),
        rec(7, "40000002", "pending", None, None, None, 7),
        rec(8, "40000002", "n/a", "cookies: accept. Sign in to read on, terms of use apply to all.", ["Anonymous"], [None, " "], 8),
    ]
    rows.append(rows[1])
    df = spark.createDataFrame(rows, REC)
    trust = spark.createDataFrame([("high", 1), ("mid", 2), ("low", 3), (None, 9)], TRUST)
    groups = {r["rec_id"]: r["group_id"] for r in survivor.article_groups(df).collect()}
    assert groups == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7}
    got = {(r["group_id"], r["field"]): r["rec_id"] for r in survivor.survivors(df, trust).collect()}
    assert got == {(1, "doi"): 3, (1, "abstract"): 2, (1, "authors"): 3}
    best = {r["group_id"]: r for r in survivor.best_records(df, trust).collect()}
    assert best[1]["doi"] == "10.99001/a" and best[1]["abstract"] == FULL and best[1]["sources"] == ["high", "low", "mid"]
    assert best[7]["abstract"] is None


def test_texts_that_many_groups_share_are_fillers(spark):
    shared = "This journal covers the biology of ageing. The editors welcome work from all fields. Every article is read by two reviewers."
    rows = []
    for g in range(4):
        own = FULL.replace("liver", f"liver {g}")
        rows += [rec(10 * g + k, f"4000000{g}", None, text, None, [src], k + 1) for k, (text, src) in enumerate([(shared, "high"), (shared, "high"), (own, "low")])]
    trust = spark.createDataFrame([("high", 1), ("low", 3)], TRUST)
    got = {r["group_id"]: r["rec_id"] for r in survivor.survivors(spark.createDataFrame(rows, REC), trust).where("field = 'abstract'").collect()}
    assert got == {10 * g: 10 * g + 2 for g in range(4)}


def test_well_formed_names_and_abstracts():
    assert survivor._whole_name("Ann Bond") and survivor._whole_name("O’Neil, Mary Ann") and survivor._whole_name("Jean-Luc Élan")
    assert not any(map(survivor._whole_name, ["A. Bond", "Bond", "Bond, A", "ann bond", "Anonymous Author", "et al.", "Ann B0nd"]))
    assert survivor.abstract_claim(None, "t") is None and survivor.abstract_claim(" <b></b> ", None) is None
    assert survivor.abstract_claim(FULL, None)[2] and not survivor.abstract_claim(FULL[:-1] + "...", None)[2] and not survivor.abstract_claim(FULL, FULL)[2]


def test_no_groups(spark):
    trust = spark.createDataFrame([], TRUST)
    assert survivor.survivors(spark.createDataFrame([], REC), trust).count() == 0


def brute_assignment(edges):
    best = (0.0, [])

    def go(i, used_l, used_r, total, chosen):
        nonlocal best
        if total > best[0]:
            best = (total, chosen)
        for j in range(i, len(edges)):
            a, b, c = edges[j]
            if a not in used_l and b not in used_r:
                go(j + 1, used_l | {a}, used_r | {b}, total + c, [*chosen, (a, b)])

    go(0, frozenset(), frozenset(), 0.0, [])
    return best[0]


def test_auction_reaches_the_greatest_total(spark):
    import random

    rnd = random.Random(7)
    for _ in range(3):
        edges = [(f"l{i}", f"r{j}", round(rnd.uniform(0.5, 1), 2)) for i in range(5) for j in range(5) if rnd.random() < 0.5]
        got = matching.assign(spark.createDataFrame(edges, "l string, r string, conf double")).collect()
        assert len({r["l"] for r in got}) == len(got) == len({r["r"] for r in got})
        assert sum(r["conf"] for r in got) >= brute_assignment(edges) - 0.004 * 5 - 1e-9


def test_contests_of_look_alikes_are_settled(spark):
    import random

    edges = []
    for n in (3, 4, 5, 6, 12):
        edges += [(f"{n}l{i:02}", f"{n}r{j:02}", 0.95) for i in range(n) for j in range(n - 1)] + [(f"{n}l{n - 1:02}", f"{n}free", 0.75)]
    got = matching.assign(spark.createDataFrame(edges, "l string, r string, conf double")).collect()
    assert len(got) == 30 and {r["l"] for r in got if r["r"].endswith("free")} == {f"{n}l{n - 1:02}" for n in (3, 4, 5, 6, 12)}
    rnd = random.Random(11)
    for _ in range(60):
        edges = [(f"l{i}", f"r{j}", round(rnd.uniform(0.1, 1), 2)) for i in range(5) for j in range(4) if rnd.random() < 0.6]
        if edges:
            assert abs(sum(c for _, _, c in matching.best_assignment(edges)) - brute_assignment(edges)) < 1e-9


P = "pmid string, title string, authors array<string>, publication_year string, journal string, doi string, entity string, w int"
O = P.replace("pmid string", "openalex_id string, pmid string")
A = "identifier string, title string, authors array<string>, year int, doi string, conf double"


def test_articles_without_common_keys(spark):
    t = "Caloric restriction and stress responses in old mice: a critical review"
    p = spark.createDataFrame(
        [("40000001", t, ["Bond, Ann", "Dole, Cy"], "2001", "Archives of Aging", None, "x", 1), ("40000002", f"Erratum: {t}", ["Ann Bond", "Cy Dole"], "2001", "Arch Aging", None, "x", 1), ("40000003", None, None, None, None, None, "x", 1)], P
    )
    o = spark.createDataFrame(
        [("W1", None, f"<i>{t.upper()}</i>", ["Bond A", "et al."], "2002 Mar", "Arch Aging", None, "x", 1), ("W1", None, f"<i>{t.upper()}</i>", ["Bond A", "et al."], "2002 Mar", "Arch Aging", None, "x", 1), ("W2", "40000001", "Caloric restriction", None, None, None, "10.99001/q", "x", 1), ("W3", None, t.replace("mice", "rats"), ["Ann Bond"], "2001", None, None, "x", 1), ("W4", None, t + ", part II", ["Ann Bond"], "2001", None, None, "x", 1)], O
    )
    a = spark.createDataFrame([("paper-1", t.replace("Caloric", "Calorc").split(":")[0], ["A. Bond"], 2001, None, 0.1), ("paper-2", t, ["Zoe Else"], 1950, None, 0.1)], A)
    rows, article, _ = matching.match(p, o, a)
    got = {(r["key_a"], r["key_b"]) for r in matching.untied_pairs(rows, article).collect()}
    assert got == {("40000001", "W1"), ("40000001", "paper-1"), ("W1", "paper-1"), ("W2", "paper-1")}


def test_any_number_of_copies_joins_its_article(spark):
    t = "Caloric restriction and stress responses in old mice"
    p = spark.createDataFrame([("40000001", t, ["Bond, Ann", "Dole, Cy"], "2001", None, None, "x", 1)], P)
    years = lambda i: str(2000 + i % 3)
    copies = [(f"W{i:03}", None, t, ["Ann Bond", "Cy Dole"], years(i), f"Journal {'abcdefghij'[i % 10] * 3}", None, "x", 1) for i in range(90)]
    misspelt = [(f"X{i:03}", None, t.replace("mice", "micee"), ["Ann Bond", "Cy Dole"], "2001", None, None, "x", 1) for i in range(30)]
    rows, article, _ = matching.match(p, spark.createDataFrame(copies + misspelt, O), spark.createDataFrame([], A))
    got = {(r["key_a"], r["key_b"]) for r in matching.untied_pairs(rows, article).collect()}
    assert got == {("40000001", r[0]) for r in copies + misspelt}


def test_matching_nothing(spark):
    rows, article, acc = matching.match(spark.createDataFrame([], P), spark.createDataFrame([], O), spark.createDataFrame([], A))
    assert matching.untied_pairs(rows, article).count() == 0 and acc.count() == 0

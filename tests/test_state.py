import pytest
from pyspark.sql import functions as F

from lorewright.functions import payload as PL
from lorewright.operators import bookkeeping as B
from lorewright.operators import bootstrap as BS


REVIEW = "identifier string, title string, full_text string, sections array<struct<title:string,text:string>>, abstract string, at string"


def test_theories_and_parts_of_a_review(spark):
    text = "The Free Radical Theory is old. Subtheories: oxidative damage; mitochondrial leak.\n" + "x" * 400 + "\nA Rate Model\n- slow living\n- fast living\nThe Free Radical Theory\n"
    far = "Lone Theory" + "y" * 200 + "subtheories: a, b"
    golden = "Activity Theory examines engagement. Subtheories: Engagement; Participation.\n" + "z" * 250
    rows = [("r", "", text, None, None, "x"), ("e", None, None, None, " ", "x"), ("f", None, far, None, None, "x"), (None, "x", "A Theory", None, None, "x"), ("g", "", golden, None, None, "x"), ("g", "", golden, None, None, "x")]
    got = {}
    for r in BS.review_trees(spark.createDataFrame(rows, REVIEW)).orderBy("identifier", "theory", "pos").collect():
        got.setdefault((r["identifier"], r["theory"]), []).append(r["part"])
    assert got == {
        ("r", "The Free Radical Theory"): ["oxidative damage", "mitochondrial leak"], ("r", "A Rate Model"): ["slow living", "fast living"],
        ("f", "Lone Theory"): [None], ("g", "Activity Theory"): ["Engagement", "Participation"],
    }
    assert BS.review_trees(spark.createDataFrame([], REVIEW)).count() == 0


def test_places_of_events(spark):
    text = "aXX-bXXXcdX"
    got = [(r["at"], r["hit"]) for r in BS.events(spark.createDataFrame([("t", text)], "identifier string, text string"), "X+").orderBy("at").collect()]
    assert got == [(1, "XX"), (5, "XXX"), (10, "X")]


def test_suggested_queries_go_bottom_up_without_repeats(spark):
    groups = spark.createDataFrame([("top", "top", 0), ("top", "low", 1), ("low", "low", 0)], "grp string, descendant string, distance int")
    terms = spark.createDataFrame([("top", "aging theory", 1), ("low", "Aging Theory", 1), ("low", "decay", 2)], "grp string, term string, ordinal int")
    rows = BS.suggested_queries(groups, terms).orderBy("grp", "rank").collect()
    assert [r["query"] for r in rows if r["grp"] == "top"] == ["aging theory", '"aging theory"', "decay", "decay aging", "decay theory"]


def test_confidence_text_and_templates(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (0.1234,), (1.0005,), (None,)], "c double")
    assert [r["x"] for r in df.select(PL.confidence_text(F.col("c")).alias("x")).collect()] == ["0.5", "1", "0.123", "1", None]
    q = spark.range(1).select(PL.fill_template(F.lit("a {x} {gone}"), {"x": F.lit("b")}).alias("q")).collect()[0]["q"]
    assert q == "a b "


def test_nested_configuration_becomes_rows(spark):
    config = {"A": {"target": 3, "keywords": ["X"], "subtheories": [{"name": "B", "subtheories": {"C": {}}}]}, "B": {}}
    assert PL.flatten_ontology(config) == [("A", None, 3, 0, 0, ["x"]), ("B", "A", None, 1, 1, []), ("C", "B", None, 2, 2, [])]
    assert PL.ontology_table(spark, config).count() == 3
    assert PL.body_text("<article><body><sec><title>T</title><p>a  b</p></sec></body></article>") == "T\n\na b"


def test_insert_checks_parents(spark):
    nodes = spark.createDataFrame([("a", None)], "name string, parent string")
    new = spark.createDataFrame([("b", "a"), ("a", "zz"), ("c", "b")], "name string, parent string")
    assert sorted(r["name"] for r in B.insert_nodes(nodes, new).collect()) == ["a", "b", "c"]
    with pytest.raises(Exception, match="unknown parent"):
        B.insert_nodes(nodes, spark.createDataFrame([("d", "none")], "name string, parent string")).collect()


def test_rounds_stop_when_targets_are_met(spark):
    targets = spark.createDataFrame([("a", 2), ("b", 1)], "theory string, target int")
    counts = lambda i: spark.createDataFrame([("a", i), ("b", 1)], "theory string, n int")
    assert B.expand_until(targets, counts, 9) == [{"round": 0, "short": 1}, {"round": 1, "short": 1}, {"round": 2, "short": 0}]


def test_prompt_caps_and_theme_names(spark):
    assert B.prompt_caps([400] * 60, budget=1000) == 10
    terms = spark.createDataFrame([("gamma", 1), ("alpha", 2)], "term string, rank int")
    assert B.theme_node(["alpha", "beta"], terms, {"Alpha Beta Gamma"}) == ("Alpha Beta Gamma 2", ["alpha", "beta", "gamma"])


def test_parents_are_found_within_each_tree(spark):
    nodes = spark.createDataFrame([("o1", "a", "Alpha", 1), ("o1", "b", "Beta", 2), ("o2", "c", "Gamma", 3)], "tree string, id string, name string, ordinal int")
    wanted = spark.createDataFrame([("o1", "x", " alpha"), ("o2", "y", "GAMMA "), ("o2", "z", "beta")], "tree string, child string, parent string")
    good, bad = B.parents_by_name(nodes, wanted, ("tree",))
    assert {(r["tree"], r["child"], r["parent_id"]) for r in good.collect()} == {("o1", "x", "a"), ("o2", "y", "c")}
    assert [(r["tree"], r["child"]) for r in bad.collect()] == [("o2", "z")]


def test_values_of_a_template_are_not_looked_into(spark):
    q = spark.range(1).select(PL.fill_template(F.lit("{x}-{y}{z}"), {"x": F.lit("{y}"), "y": F.lit("v")}).alias("q")).collect()[0]["q"]
    assert q == "{y}-v"


def test_entities_of_any_kind(spark):
    from lorewright.functions import text as T

    rows = [("a&nbsp;&lt;b&gt;",), ("caf&eacute; &#8211; &#x3b1; &amp;lt;",), (None,), ("<p>x</p>&amp;",)]
    got = [r["t"] for r in spark.createDataFrame(rows, "h string").select(T.strip_html("h").alias("t")).collect()]
    assert got == ["a <b>", "café – α &lt;", None, "x\n&"]


def test_registry_golden(spark):
    from lorewright.operators import registry as RG

    rows = [("Disposable soma theory", 1, "a"), ("Disposable soma hypothesis", 2, "b"), ("Disposable soma hypothesis", 3, "c"), ("theory, disposable Soma", 4, "a"), (None, 5, "z"), (" ", 6, "z")]
    entries, supports, synonyms = RG.registry_tables(spark.createDataFrame(rows, "label string, ordinal int, article string"), 0.75)
    e = entries.collect()
    assert [(r["theory_id"], r["label"], r["aliases"], r["articles"]) for r in e] == [("disposable-soma-theory__a", "Disposable soma theory", 3, 3)]
    assert sorted(r["article"] for r in supports.collect()) == ["a", "b", "c"]
    got = sorted((r["alias"], r["theory_id"], r["slug"], r["article"]) for r in synonyms.collect())
    assert got == [("Disposable soma hypothesis", e[0]["theory_id"], "disposable-soma-hypothesis", "b"), ("Disposable soma hypothesis", e[0]["theory_id"], "disposable-soma-hypothesis", "c"), ("theory, disposable Soma", e[0]["theory_id"], "theory-disposable-soma", "a")]


def test_parents_are_made_and_bad_merges_audited(spark):
    from lorewright.operators import trees as TR

    nodes = spark.createDataFrame([("o", "Root", None), ("o", "A", "Root"), ("o", "B", "Root")], "tree string, name string, parent string")
    merges = spark.createDataFrame([("o", "New", "a", 1), ("o", "Root", "A ", 2), ("o", "b", "B", 3), ("o", "New", "gone", 4), ("o", None, "A", 0)], "tree string, parent string, child string, ordinal int")
    kept, audit = TR.merge_parents(nodes, merges)
    assert sorted((r["name"], r["parent"]) for r in kept.collect() if r["parent"]) == [("A", "New"), ("B", "Root")]
    assert {(r["child"], r["issue"]) for r in audit.collect()} == {("A ", "repeated"), ("B", "itself"), ("gone", "unresolved")}


def test_words_and_runs_of_words(spark):
    from lorewright.operators import expansion as E

    rows = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "ws array<string>").select(E.ngrams(F.col("ws"), 3).alias("t")).collect()
    assert [r["t"] for r in rows] == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]


def test_ranks_of_a_hot_group_and_of_nulls(spark):
    from lorewright.operators.ranking import spread_rank

    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, "cold").alias("g"), ((F.col("id") * 7919) % 2000).alias("v"))
    rows = spread_rank(df, ["g"], [F.desc("v")]).collect()
    assert len(rows) == 2000
    for g in ("hot", "cold", None):
        mine = sorted((r["rank"], r["v"]) for r in rows if r["g"] == g)
        assert [k for k, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted((v for _, v in mine), reverse=True)

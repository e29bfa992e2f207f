"""Golden values on small tables."""

import math

from pyspark.sql import functions as F

from lorewright.functions import keys as K
from lorewright.functions import text as T
from lorewright.operators import classify as C
from lorewright.operators import coverage as V
from lorewright.operators import dedupe as D
from lorewright.operators import expansion as E
from lorewright.operators import model_calls as M
from lorewright.operators import questions as Q
from lorewright.operators import registry as RG
from lorewright.operators import relevance as R
from lorewright.operators import trees as TR
from lorewright.operators import validate as VA


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'array<string>' if isinstance(v, list) else 'double'}" for k, v in cols.items()))
    return df.select(expr.alias("x")).collect()[0]["x"]


def test_dois_lose_one_leading_label(spark):
    for raw, want in ((" DOI:10.1/AbC ", "10.1/abc"), ("https://dx.doi.org/10.1/x", "10.1/x"), ("http://dx.doi.org/10.1/x", "http://dx.doi.org/10.1/x"), ("  ", None), (None, None)):
        assert one(spark, K.doi_norm("d"), d=raw) == want


def test_canonical_key_folds_unicode(spark):
    key = one(spark, K.canonical_key(F.col("d"), F.col("t"), F.col("a")), d=None, t="Älter, Straße_x!", a=["Zoë B", "Ann"])
    assert key == "title:alter-strasse_x|authors:ann-b-zoe"
    assert one(spark, K.canonical_key(F.col("d"), F.col("t"), F.col("a")), d=None, t="?!", a=["x"]) is None


def test_slug_sentences_and_snippet(spark):
    assert one(spark, T.slug("s"), s=" Rate of Living! ") == "rate-of-living"
    assert one(spark, T.slug("s"), s="??") == "theory"
    assert one(spark, T.sentences("s"), s="One. Two\nthree.. 4.5 ") == ["One", "Two three", "4", "5"]
    long = one(spark, T.snippet("t", "a"), t="x" * 300, a="y" * 300)
    assert len(long) == 400 and long.endswith("...")


def test_query_variants_and_keywords(spark):
    assert one(spark, T.query_variants("q"), q="free radical") == ["free radical", '"free radical"', "free radical aging", "free radical theory"]
    assert one(spark, T.query_keywords("q"), q="(Free AND radical) OR free-form, radical") == ["free", "radical", "free-form"]


def test_confidence_scales(spark):
    for v, want in ((0.4, 0.4), (64.7, 0.647), (None, None), (float("nan"), None), (-1.0, 0.0)):
        df = spark.createDataFrame([(v,)], "c double")
        assert df.select(T.confidence_of(F.col("c")).alias("x")).collect()[0]["x"] == want


def test_merge_strings_keeps_first_spelling(spark):
    assert one(spark, T.merge_strings(F.col("a"), F.col("b")), a=["Ab", " "], b=["aB", "c"]) == ["Ab", "c"]


def test_relevance_weights(spark):
    s = one(spark, R.relevance_score(F.col("t"), F.col("a"), F.col("b"), ["x1", "y1"]), t="x1", a="x1", b="y1")
    assert math.isclose(s, (0.5 + 0.3 + 0.2) / 2 + 0.1)


def test_roll_up_modes(spark):
    scores = spark.createDataFrame([("p", "leaf", 0.9)], "id string, theory string, score double")
    links = spark.createDataFrame([("leaf", "mid", 1), ("leaf", "top", 2), ("mid", "top", 1)], "child string, ancestor string, distance int")
    get = lambda m: {r["theory"]: r["score"] for r in C.roll_up(scores, "id", links, m).collect()}
    assert get("one_level") == {"leaf": 0.9, "mid": 0.9}
    assert get("full") == {"leaf": 0.9, "mid": 0.9, "top": 0.9}


def test_keyword_repeats_count(spark):
    p = spark.createDataFrame([("p", "senescent cells")], "id string, text string")
    k = spark.createDataFrame([("t", "cell"), ("t", "cell"), ("t", "gene"), ("u", "gene")], "theory string, keyword string")
    got = {(r["theory"], round(r["score"], 4)) for r in C.keyword_scores(p, "id", "text", k).collect()}
    assert got == {("t", 0.6667)}


def test_best_assignment_prefers_depth_then_name(spark):
    s = spark.createDataFrame([("p", "b", 0.5, 2), ("p", "a", 0.5, 2), ("p", "c", 0.5, 1), ("q", "z", 0.0, 9)], "id string, theory string, score double, depth int")
    assert [(r["id"], r["theory"]) for r in C.best_assignment(s, "id").collect()] == [("p", "a")]


def test_depth_deficits(spark):
    rows = [("Root", 0, 2, 3), ("Child A", 1, 1, 2), ("Child B", 1, 1, 1), ("Grandchild", 2, 0, 1)]
    df = V.coverage(spark.createDataFrame(rows, "theory string, depth int, n int, target int"))
    got = {r["depth"]: (r["deficit"], r["names"]) for r in V.depth_deficits(df).collect()}
    assert got == {0: (1, ["Root"]), 1: (1, ["Child A"]), 2: (1, ["Grandchild"])}


def test_log_score_of_ten_and_three(spark):
    df = V.log_score(spark.createDataFrame([("a", 10), ("b", 3), ("c", 0)], "theory string, n int"))
    assert math.isclose(sum(r["contribution"] for r in df.collect()), math.log10(10) + math.log10(3))


def test_split_of_eight_and_tail(spark):
    items = lambda n: spark.createDataFrame([("t", f"i{k}", k) for k in range(n)], "owner string, item string, pos int")
    sizes = lambda df: sorted(r["count"] for r in df.groupBy("chunk").count().collect())
    assert sizes(TR.split_oversized(items(8), 5, 4, 2)) == [4, 4]
    assert sizes(TR.split_oversized(items(9), 5, 4, 2)) == [4, 5]
    assert sizes(TR.split_oversized(items(5), 5, 4, 2)) == [5]


def test_balance_ten_children_into_three(spark):
    ch = spark.createDataFrame([("r", f"c{i}", 10 - i) for i in range(10)], "parent string, node string, weight int")
    sizes = sorted(r["count"] for r in TR.balance_children(ch, 3).groupBy("group_name").count().collect())
    assert sizes == [3, 3, 4]


def test_normalised_splits_keep_every_item(spark):
    p = spark.createDataFrame([("t", f"i{k}", k % 2 if k < 5 else None, k) for k in range(9)] + [("t", "i0", 1, 99)], "owner string, item string, bucket int, pos int")
    rows = TR.normalise_splits(p, 3, 2).collect()
    assert sorted(r["item"] for r in rows) == [f"i{k}" for k in range(9)]
    assert max(sum(x["chunk"] == r["chunk"] for x in rows) for r in rows) <= 3


def test_validation_statuses_and_rollup(spark):
    truth = spark.createDataFrame([("t", "p", "Q1", "yes"), ("t", "p", "Q2", "no"), (None, "p", "Q3", "x"), ("t", "z", "Q1", "y")], "theory string, paper_id string, question_id string, expected string")
    ans = spark.createDataFrame([("t", "p", "Q1", "yes"), ("t", "p", "Q2", "yes"), ("t", "p", "Q3", "x")], "theory string, paper_id string, question_id string, answer string")
    rows = VA.validation_rows(truth, ans)
    assert sorted(r["status"] for r in rows.collect()) == ["mismatch", "missing", "ok", "ok"]
    m = [r for r in VA.validation_metrics(rows).collect() if r["overall"] == 1][0]
    assert (m["expected"], m["found"], m["correct"]) == (4, 3, 2) and math.isclose(m["accuracy"], 2 / 3)


def test_numbered_slugs_pass_over_taken_numbers(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a-2"), (4, "a")], "id int, slug string")
    got = {r["id"]: r["slug_id"] for r in D.numbered_slugs(df, "slug", ["id"]).collect()}
    assert got == {1: "a", 2: "a-3", 3: "a-2", 4: "a-4"}


def test_merge_records_first_filled_value(spark):
    df = spark.createDataFrame([("g", 1, " ", ["a"]), ("g", 2, "x", ["b", "a"]), ("g", 3, "y", None)], "g string, o int, t string, l array<string>")
    r = D.merge_records(df, "g", "o", ["t"], ["l"]).collect()[0]
    assert r["t"] == "x" and r["l"] == ["a", "b"]


def test_questions_first_sentence_decides(spark):
    df = spark.createDataFrame([("p", "t", "A biomarker. Marker measured at 5", None, None)], "identifier string, title string, full_text string, abstract string, sections array<struct<title:string,text:string>>")
    got = {r["question_id"]: (r["answer"], r["confidence"]) for r in Q.answer_papers(df).collect()}
    assert got["Q1"] == ("Yes, mentioned without data", 0.6)
    assert got["Q4"] == ("Not discussed", 0.2) and len(got) == 9


def test_combined_answers(spark):
    df = spark.createDataFrame([("No", 0.5, "no", 0.4), ("No", 0.5, "Yes", 0.9), ("No", 0.5, "Yes", 0.6), ("No", 0.5, "huh", 0.9), ("No", 0.5, "unclear", 0.9)], "h string, hc double, m string, mc double")
    a, c = Q.combine(F.col("h"), F.col("hc"), F.col("m"), F.col("mc"), ["Yes", "No"], ["unclear"])
    got = [(r["a"], round(r["c"], 3)) for r in df.select(a.alias("a"), c.alias("c")).collect()]
    assert got == [("No", 0.54), ("Yes", 0.95), ("Yes", 0.56), ("No", 0.4), ("No", 0.5)]


def test_tfidf_and_terms(spark):
    d = spark.createDataFrame([("g", 1, "alpha beta beta"), ("g", 2, "beta gamma")], "g string, id int, text string")
    assert [(r["term"], r["n"]) for r in E.term_frequency(d, "g", "id", "text", 1).collect()] == [("beta", 3)]
    assert E.tfidf_terms(d, "g", "id", "text", ["the"], 9).count() == 3


def test_registry_fold_joins_spellings(spark):
    m = spark.createDataFrame([("Free Radical Theory", 1), ("free radical theory ", 2), ("Free Radical Theorie", 3), ("Rate of Living", 4), (None, 5)], "label string, ordinal int")
    got = {r["label"]: r["canonical"] for r in RG.build_registry(m).collect()}
    assert got["Free Radical Theorie"] == "Free Radical Theory" and got["Rate of Living"] == "Rate of Living"


def test_registry_compares_every_pair(spark):
    import difflib
    import itertools
    import random

    rnd = random.Random(5)
    kinds, ends = ["somatic silencing", "proteostasis drift", "membrane decay", "redox imbalance"], ["theories of aging", "framework", "hypothesis of ageing", "model"]
    names = ["ab", "ac", "a"]
    for i in range(160):
        s = list(f"{rnd.choice('abcdefgh')}{rnd.choice(kinds)} {rnd.choice(ends)}")
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(s))
            s[at : at + 1] = rnd.choice(["", "x", s[at] * 2])
        names.append("".join(s))
    names = list(dict.fromkeys(names))
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "label string, ordinal int")
    want = {(i, j) for i, j in itertools.combinations(range(len(names)), 2) if difflib.SequenceMatcher(None, names[j], names[i]).ratio() >= 0.9}
    for block in (4096, 40):
        assert {(r["a"], r["b"]) for r in RG.similar_names(df, 0.9, block).collect()} == want
    assert len(want) > 300


def test_registry_joins_names_far_apart_in_order(spark):
    near = [f"somatic silencing theorem {c}{d} zq{d}{c}{d}{c}" for c in "abcdef" for d in "uvwxyz"]
    pair = ["somaatic silencing theory of aging", "somatic silencing theories of aging"]
    rows = [(n, i) for i, n in enumerate([*pair, *[f"soma{c}{d} unlike" for c in "abcdef" for d in "uvwx"], *near, *[f"{c}{d} silencing theories of aging" for c in "tuvwxyz" for d in "klmno"]])]
    got = {r["label"]: r["canonical"] for r in RG.build_registry(spark.createDataFrame(rows, "label string, ordinal int")).collect()}
    assert got[pair[1]] == pair[0]


def test_windows_cover_the_text():
    text = " ".join(f"w{i}" for i in range(500))
    parts = RG.overlapping_windows(text, 200, 40)
    assert all(len(p) <= 200 for p in parts) and parts[0].startswith("w0") and parts[-1].endswith("w499")


def test_model_calls_use_the_cache_and_replay(spark):
    prompts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, prompt string")
    cache = spark.createDataFrame([("b",)], "p string").select(F.sha2("p", 256).alias("key"), F.lit("known").alias("response"))
    answers, fresh = M.generate(prompts, cache, lambda: M.Replay({"a": "made"}), pause=0.0)
    assert {r["id"]: r["response"] for r in answers.collect()} == {1: "made", 2: "known", 3: "made"}
    assert fresh.count() == 1


def test_reply_parsing(spark):
    df = spark.createDataFrame([('{"score": 1.7}',), ("about .35 I think",), ("no",)], "r string")
    s, _ = M.parse_score(F.col("r"))
    assert [r["s"] for r in df.select(s.alias("s")).collect()] == [1.0, 0.35, None]
    df = spark.createDataFrame([('{"answer": {"label": "Yes"}, "confidence": 2}',), ('{"answer": ["No"]}',), ('{"answer": " Maybe "}',)], "r string")
    a, c = M.parse_answer(F.col("r"))
    assert [(r["a"], r["c"]) for r in df.select(a.alias("a"), c.alias("c")).collect()] == [("Yes", 1.0), ("No", None), ("Maybe", None)]

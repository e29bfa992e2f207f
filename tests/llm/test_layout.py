import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lorewright.llm import chunking, mixing, packing
from lorewright.operators.ranking import two_level_rank

DOC = "doc_id bigint, text string, source string, tokens string, container int"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n", max_size=600), st.integers(20, 80), st.integers(0, 15))
def test_pieces_cover_overlap_and_fit(text, limit, overlap):
    pieces = chunking.split_text(text, limit, overlap)
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    assert all(b - a <= limit for a, b, _ in pieces)
    assert all(y[0] == x[1] - overlap for x, y in zip(pieces, pieces[1:]))


def test_cuts_prefer_paragraphs_and_force_long_words(spark):
    para = ("word " * 30).strip() + ".\n\n"
    df = spark.createDataFrame([("a", para * 8, 1), ("b", "x" * 900, 1), ("c", None, 1), ("d", " \n ", 1), ("e", " " * 500 + "short", 1), ("f", "é" * 400, 1)], "identifier string, full_text string, piece int")
    rows = chunking.chunk(df, "identifier", "full_text", 400, 40).collect()
    by = {k: [r for r in rows if r["identifier"] == k] for k in "abcdef"}
    assert [r["strength"] for r in by["a"][:-1]] == [4] * (len(by["a"]) - 1)
    assert by["b"][0]["strength"] == 0 and by["b"][0]["longest_run"] == 900
    assert not by["c"] and not by["d"] and not by["e"] and not by["f"]
    with pytest.raises(ValueError):
        chunking.chunk(df, "identifier", "full_text", 10, 10)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_holds_every_item_within_capacity(histogram):
    groups = packing.plan_containers(histogram, 64, [16, 32])
    used = {}
    for many, items in groups:
        assert sum(n * k for n, k in items.items()) <= 64
        for n, k in items.items():
            used[n] = used.get(n, 0) + many * k
    assert used == histogram


def test_packing_places_each_token_once(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join("cell" for _ in range(rnd.randint(0, 60))), "s", "x", 1) for i in range(300)]
    rows += [(900, " ".join("cell" for _ in range(250)), "s", "x", 1), (901, None, "s", "x", 1), (5, rows[5][1], "s", "x", 1)]
    out = packing.pack(spark.createDataFrame(rows, DOC), "doc_id", "text", 100, (25, 50, 100)).collect()
    fill = {}
    for r in out:
        if r["container"] is not None:
            fill[r["container"]] = fill.get(r["container"], 0) + r["tokens"]
    assert max(fill.values()) <= 100
    assert sum(fill.values()) >= 0.97 * 100 * (len(fill) - 2)
    assert {r["doc_id"] for r in out if r["pieces"] > 1} == {900}
    assert [r["container"] for r in out if r["doc_id"] == 901] == [None]
    assert sum(r["doc_id"] == 5 for r in out) == 2


def test_packing_and_mixing_of_nothing(spark):
    none = spark.createDataFrame([], DOC)
    assert packing.pack(none, "doc_id", "text", 100).count() == 0
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, weight double, max_repeats int")
    sizes = mixing.source_sizes(none, targets)
    plan = mixing.expectations(sizes, targets)
    drawn = mixing.draws(sizes, plan)
    assert mixing.copies(drawn).count() == 0 and plan.count() == 1
    assert [r["short"] for r in mixing.report(plan, drawn).collect()] == [False]


def test_ranks_are_exact_over_buckets(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.floor(F.col("id") / 100).alias("b"), "id")
    rows = two_level_rank(df, ["g"], "b", ["id"]).collect()
    for g in range(3):
        ids = [r["id"] for r in sorted((r for r in rows if r["g"] == g), key=lambda r: r["rank"])]
        assert ids == list(range(g, 1000, 3))
        assert sorted(r["rank"] for r in rows if r["g"] == g) == list(range(len(ids)))


def test_shares_are_met_and_short_sources_reported(spark):
    rows = [(i, "cell " * (5 + i % 7), "Big ", "x", 1) for i in range(800)] + [(2000 + i, "cell " * 8, "small", "x", 1) for i in range(20)]
    rows += [(5000, "cell", None, "x", 1), (5001, "cell", "other", "x", 1), (5002, None, "big", "x", 1)]
    docs = spark.createDataFrame(rows, DOC)
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3), ("absent", 0.0, 2), ("missing", 0.01, 2), (None, 0.1, 1)], "source string, weight double, max_repeats int")
    sizes = mixing.source_sizes(docs, targets)
    plan = mixing.expectations(sizes, targets)
    drawn = mixing.draws(sizes, plan)
    mixed = mixing.copies(drawn)
    rep = {r["source"]: r for r in mixing.report(plan, drawn).collect()}
    assert rep["small"]["short"] and rep["small"]["most_copies"] == 3 and rep["small"]["docs"] == 20
    assert not rep["big"]["short"] and abs(rep["big"]["used_tokens"] / rep["big"]["target_tokens"] - 1) < 0.02
    assert not rep["absent"]["short"] and rep["absent"]["used_tokens"] == 0 and rep["missing"]["short"]
    assert {r["source"] for r in mixed.select("source").distinct().collect()} == {"big", "small"}


def test_a_long_run_of_blanks_is_one_boundary():
    text = "ab. " * 20 + "\n" + " " * 400 + "\n" + " " * 30 + "ab. " * 30
    low = text.index("\n") + 405
    assert chunking._snap(text, low + 20, low, low + 40, 40)[1] == 4

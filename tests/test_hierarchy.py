import random

import pytest

from lorewright.operators import hierarchy as H
from lorewright.operators.components import connected_components

SCHEMA = "ontology_id string, name string, parent string, children array<string>, v string, p int"


def solve(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return {(r["ontology_id"], r["name"]): r for r in H.resolve_hierarchy(df).collect()}


def brute(rows):
    """Parent walk over (tree, name, parent) with unique names."""
    par = {(t, n): p for t, n, p in rows}
    out = {}
    for t, n in par:
        path, at, seen = [n], n, {n}
        while par.get((t, at)) is not None and (t, par[t, at]) in par:
            at = par[t, at]
            if at in seen:
                out[t, n] = ("cycle" if at == n else "hanging", None)
                break
            seen.add(at)
            path.append(at)
        else:
            orphan = par[t, n] is not None and (t, par[t, n]) not in par
            out[t, n] = ("orphan" if orphan else "node", path[::-1])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_forests_agree_with_a_parent_walk(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for tree in ("a", "b"):
        names = [f"n{i}" for i in range(60)]
        for i, n in enumerate(names):
            kind = rnd.random()
            p = None if kind < 0.1 else "gone" if kind < 0.15 else rnd.choice(names) if kind < 0.3 else names[max(0, i - rnd.randint(1, 3))]
            rows.append((tree, n, p))
    got = solve(spark, [(t, n, p, None) for t, n, p in rows])
    want = brute(rows)
    assert set(got) == set(want)
    for k, (kind, path) in want.items():
        assert got[k]["kind"] == kind, k
        assert got[k]["path"] == path
        if path:
            assert got[k]["root"] == path[0] and got[k]["depth"] == len(path) - 1
    df = spark.createDataFrame([(t, n, p, None, "x", 1) for t, n, p in rows], SCHEMA)
    assert {(r["ontology_id"], r["name"]): r["kind"] for r in H.defects(df).collect()} == {k: kind for k, (kind, _) in want.items() if kind != "node"}


def test_long_chain_and_large_circle(spark):
    chain = [("c", f"k{i}", f"k{i-1}" if i else None, None) for i in range(300)]
    circle = [("o", f"r{i}", f"r{(i + 1) % 50}", None) for i in range(50)] + [("o", "tail", "r3", None)]
    got = solve(spark, chain + circle)
    assert got["c", "k299"]["depth"] == 299 and got["c", "k299"]["root"] == "k0"
    assert all(got["o", f"r{i}"]["kind"] == "cycle" for i in range(50))
    assert got["o", "tail"]["kind"] == "hanging"


def test_spelling_blanks_lists_and_repeats(spark):
    rows = [
        ("t", "Root", None, ["Leaf  one", "root"]),
        ("t", "Leaf One", "  ", None),
        ("t", "Leaf One", "  ", None),
        ("t", "Self", "SELF ", None),
        ("t", None, "Root", None),
        (None, "lost", None, None),
        ("t", "stray", "nowhere", [None]),
    ]
    got = solve(spark, rows)
    assert got["t", "Leaf One"]["path"] is None or got["t", "Leaf One"]["kind"] in ("node", "hanging")
    assert got["t", "Root"]["kind"] == "cycle"  # its own list names it
    assert got["t", "Leaf One"]["kind"] == "hanging"
    assert got["t", "Self"]["kind"] == "cycle" and got["t", "stray"]["kind"] == "orphan"
    assert len(got) == 4


def test_empty_and_descendants(spark):
    assert solve(spark, []) == {}
    df = spark.createDataFrame([("t", "a", None, None), ("t", "b", "a", None), ("t", "c", "b", None)], "ontology_id string, name string, parent string, children array<string>")
    d = {(r["name"], r["descendant"], r["distance"]) for r in H.descendants(H.resolve_hierarchy(df)).collect()}
    assert d == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1)}


def test_components_agree_with_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)] + [(None, 3), (7, 7)]
    par = {}

    def find(x):
        par.setdefault(x, x)
        while par[x] != x:
            x = par[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            par[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {x: find(x) for x in par}


def test_defects_of_long_chains_stars_and_nothing(spark):
    chain = [("c", f"n{i}", f"n{i + 1}", None, "x", 1) for i in range(400)] + [("c", "n400", "n300", None, "x", 1)]
    star = [("s", f"k{i}", "hub", None, "x", 1) for i in range(300)] + [("s", "hub", " HUB", None, "x", 1)]
    got = {(r["ontology_id"], r["name"]): r["kind"] for r in H.defects(spark.createDataFrame(chain + star, SCHEMA)).collect()}
    want = {("c", f"n{i}"): "cycle" if i >= 300 else "hanging" for i in range(401)} | {("s", f"k{i}"): "hanging" for i in range(300)} | {("s", "hub"): "cycle"}
    assert got == want
    assert H.defects(spark.createDataFrame([], SCHEMA)).count() == 0

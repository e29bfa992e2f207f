import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lorewright.llm import registry as R

NAMES = [
    ("t1", "Lysosomal Imbalance Hypothesis"), ("t1", "Cell-Stomach Disequilibrium Idea"), ("t1", "LHITT"), ("t2", "Ribosomal Drift Model"),
    ("t3", "Telomere Erosion Theory of Aging"), ("t3", "Erosion of the Telomere System"), ("t4", "Lysosomal Drift Model"),
]


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcd", max_size=70), st.text(alphabet="abcd", max_size=70))
def test_bit_parallel_distance(a, b):
    assert R.levenshtein(a, b) == plain(a, b)


def test_tree_finds_all_within_the_radius():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(2, 8))) for _ in range(200)] + ["ab" * 40, "ab" * 39 + "c"]
    tree = R.BKTree(words)
    ask = [*words[:20], "ab" * 40, "c" * 200, "xyz"]
    for radius in (0, 1, 2, 4):
        got = tree.search(ask, [radius] * len(ask))
        near = tree.search(ask, [radius] * len(ask), nearest=True)
        for i, q in enumerate(ask):
            want = sorted((plain(q, w), w) for w in set(words) if plain(q, w) <= radius)
            assert sorted((d, w) for k, d, w in got if k == i) == want
            assert sorted((d, w) for k, d, w in near if k == i) == [x for x in want if x[0] == want[0][0]]
    assert R.BKTree([]).search(["a"], [3]) == []


CASES = [
    ("lysosomal  IMBALANCE_hypothesis\xa0", "t1"), ("Lysösomal Imbalence", "t1"), ("Imbalance, lysosomal Hypothesis", "t1"), ("the so-called Cell-Stomach Disequilbrium Idea)", "t1"),
    ("lhitt", "t1"), ("LHITX", ""), ("Theory of Telomere Erosion", "t3"), ("Telomere Erosion th.", "t3"), ("cf. Lysosmoal Drift paradigm (see discussion)", "t4"),
    ("Ribosomal Imbalance Hypothesis", ""), ("Telomere Drift Model", ""), ("unclear", ""), (None, ""), ("  ", ""), ("?", ""), ("x" * 100_000, ""), ("Rosl theory", "t5"), ("abcdefgx theory", ""),
]
MORE = [*NAMES, ("t5", "Ros1 theory"), ("a", "abcdefgy theory"), ("z", "abcdefgz theory")]


def test_free_typing_whatever_the_shards(spark):
    names = spark.createDataFrame(MORE, "id string, name string")
    values = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "mention_id int, label string")
    for shard in (20_000, 3, 1):
        got = {r["mention_id"]: r["match"] for r in R.map_values(values, "mention_id", "label", names, shard).collect()}
        for i, (text, want) in enumerate(CASES):
            assert got[i] == want, (shard, text[:60], got[i])


def test_table_shards_repeats_and_empties(spark):
    ref = spark.createDataFrame([("t1", "Lysosomal Imbalance Hypothesis", ["LHITT", None, ""], 1), ("t2", "Ribosomal Drift Model", None, 1), (None, "x", None, 1)], "theory_id string, label string, aliases array<string>, match int")
    vals = spark.createDataFrame([(1, "LHITT", 0), (1, "LHITT", 1), (2, None, 0), (3, "ribosmal drift", 0), (None, "LHITT", 0)], "mention_id bigint, label string, match int")
    want = {1: "t1", 2: "", 3: "t2"}
    for size in (20_000, 1):
        got = R.map_values(vals, "mention_id", "label", R.reference_names(ref), size).collect()
        assert {r["mention_id"]: r["match"] for r in got} == want and len(got) == 3
    assert {r["match"] for r in R.map_values(vals, "mention_id", "label", R.reference_names(ref.limit(0))).collect()} == {""}
    assert R.map_values(vals.limit(0), "mention_id", "label", R.reference_names(ref)).count() == 0

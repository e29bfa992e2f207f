"""Filling fixed-capacity containers: hierarchical multi-length packing.

The plan is made on the histogram of item lengths, which has at most
``capacity`` entries whatever the corpus. Tiers of context sizes are packed from
the longest down: a tier first fills gaps left in longer windows (best fit),
then opens containers of its own. Groups of equal containers become slots, and
items take slots by their exact rank among items of their length. Container
numbers run through the groups, so dealing them over the steps in turn gives
every step group the same mix of lengths.

Defined results: an item above the capacity is cut into full pieces and a rest;
an item of no tokens (null or empty text) gets container NULL; repeated rows are
items of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.operators.ranking import two_level_rank
from lorewright.llm.tokens import TOKENIZER_DIR, token_count
from lorewright.session import cut, spread_scan

def plan_containers(histogram: dict[int, int], capacity: int, tiers: list[int]) -> list[tuple[int, dict[int, int]]]:
    """Groups of equal containers: (how many, {length: items of it in each})."""
    groups: dict[int, list] = {}  # gap -> [[multiplicity, {length: n}], ...]
    gaps: list[int] = []

    def put(gap: int, many: int, items: dict[int, int]) -> None:
        if gap not in groups:
            groups[gap] = []
            insort(gaps, gap)
        groups[gap].append([many, items])

    def take(gap: int) -> list:
        got = groups[gap].pop()
        if not groups[gap]:
            del groups[gap]
            gaps.pop(bisect_left(gaps, gap))
        return got

    bounds = sorted({t for t in tiers if t < capacity} | {capacity}, reverse=True)
    for high, low in zip(bounds, [*bounds[1:], 0], strict=True):
        for length in sorted((x for x in histogram if low < x <= high), reverse=True):
            left = histogram[length]
            while left:
                at = bisect_left(gaps, length)
                if at == len(gaps) or gaps[at] == capacity:
                    per = min(capacity // length, left)
                    many = left // per
                    put(capacity - per * length, many, {length: per})
                    left -= many * per
                    continue
                gap = gaps[at]
                many, items = take(gap)
                per = min(gap // length, left)
                used = min(many, left // per)
                if used < many:
                    put(gap, many - used, items)
                put(gap - per * length, used, items | {length: items.get(length, 0) + per})
                left -= used * per
    return [(many, items) for gap in sorted(groups) for many, items in groups[gap] if many]


def pack(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    capacity: int = 2048,
    tiers: tuple[int, ...] = (256, 512, 1024, 2048),
    step_size: int = 64,
    tokenizer_dir: str = TOKENIZER_DIR,
) -> DataFrame:
    """One row per piece: ``<id_col>, piece, pieces, first_token, tokens, tier, container, step``."""
    spark = docs.sparkSession
    sizes = spread_scan(docs.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))).select("item", token_count(F.col("text"), tokenizer_dir).alias("total"))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("total") / capacity)).cast("int")
    cutted = cut(
        sizes.withColumn("pieces", pieces)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .withColumn("first_token", F.col("piece") * capacity)
        .withColumn("tokens", F.least(F.lit(capacity), F.col("total") - F.col("first_token")))
    )
    histogram = {r["tokens"]: r["n"] for r in cutted.where("tokens > 0").groupBy("tokens").agg(F.count("*").alias("n")).collect()}
    groups = plan_containers(histogram, capacity, list(tiers))
    slots: dict[int, list[tuple[int, int, int]]] = {}
    filled = dict.fromkeys(histogram, 0)
    base = 0
    for many, items in groups:
        for length, per in items.items():
            slots.setdefault(length, []).append((filled[length], base, per))
            filled[length] += many * per
        base += many
    steps = max(1, -(-base // step_size))
    lookup = spark.createDataFrame(
        [(k, v) for k, v in slots.items()], "tokens int, slots array<struct<start:bigint,base:bigint,per:bigint>>"
    )
    # ranges of the global order are the first level of the ranks, so a length that very many items have is spread out
    placed = cut(cutted.where("tokens > 0").repartitionByRange("tokens", "item", "piece").withColumn("_b", F.spark_partition_id()))
    ranked = two_level_rank(placed, ["tokens"], "_b", ["item", "piece"], "rank")
    slot = F.element_at(F.filter("slots", lambda s: s["start"] <= F.col("rank")), -1)
    tier = F.lit(max(tiers))
    for t in sorted((t for t in tiers if t < max(tiers)), reverse=True):
        tier = F.when(F.col("tokens") <= t, t).otherwise(tier)
    placed = (
        ranked.join(F.broadcast(lookup), "tokens")  # at most `capacity` rows
        .withColumn("slot", slot)
        .withColumn("container", (F.col("slot.base") + F.floor((F.col("rank") - F.col("slot.start")) / F.col("slot.per"))).cast("bigint"))
    )
    none = cutted.where("tokens = 0").withColumn("container", F.lit(None).cast("bigint"))
    cols = ["item", "piece", "pieces", "first_token", "tokens", "container"]
    return placed.select(*cols).unionByName(none.select(*cols)).select(
        F.col("item").alias(id_col), "piece", "pieces", "first_token", "tokens", tier.cast("int").alias("tier"), "container",
        F.pmod(F.col("container"), F.lit(steps)).alias("step"),
    )


def containers(packed: DataFrame, id_col: str, capacity: int = 2048) -> DataFrame:
    """One row per container: ``container, step, items, tokens, free``."""
    return (
        packed.where(F.col("container").isNotNull())
        .groupBy("container", "step")
        .agg(F.count(id_col).alias("items"), F.sum("tokens").alias("tokens"))
        .withColumn("free", F.lit(capacity) - F.col("tokens"))
    )

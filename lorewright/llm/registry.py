"""Mapping freely typed values to a canonical list with BK-trees.

Names and values are reduced to their core words (accents, case, marks, fillers and
words for the kind of entry gone, inversions undone). All distinct words typed are
looked up in a BK-tree of the words of the list, which gives each its distance to the
nearest one. A value's core is then looked up in the BK-tree of the names under the
Levenshtein metric. Its radius is the sum of its words' distances: an entry agrees
only if each of its words is a nearest word of the list to the word typed in its place,
so none lies beyond. The triangle inequality prunes, and every entry within the radius
comes back. Of those that agree word by word the nearest wins. Abbreviations must
agree exactly.

Trees hold at most ``shard`` strings, are built on the driver one at a time and broadcast;
a longer list has several. Shards return all they find; agreement and ties are
decided once, after the merge and against the words of the whole list, so the number of shards
bears on no result. Each distinct text, word and core is handled once.

Defined results: rows of null id are ignored; null, blank and unmatched values map to the empty string; a
value between two equally near entries is unmatched, one that equals several is given to the smallest id; an empty
reference list matches nothing; repeated ids of values give one row, that of the smallest text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.session import cut, spread

SHARD = 20_000
#: Pairs of a string and a node compared at once.
SLICE = 100_000

#: Words that name the kind of entry and not the entry.
GENERIC = (
    "theory theories hypothesis hypotheses model models framework frameworks paradigm concept idea view account "
    "system domain compartment aging ageing"
).split()
FILLER = {"the", "a", "an", "so", "called", "cf", "see", "discussion", "of", "th", "hyp"}
#: What a misspelt kind word may have been meant for.
KINDS = sorted({*GENERIC, "called", "discussion"})
_ASIDE = re.compile(r"\(see discussion\)", re.I)


def levenshtein(a: str, b: str) -> int:
    """Edit distance by bit-parallel columns."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    m = len(a)
    peq: dict[str, int] = {}
    for i, ch in enumerate(a):
        peq[ch] = peq.get(ch, 0) | 1 << i
    mask, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    for ch in b:
        eq = peq.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph = (ph << 1 | 1) & mask
        pv = (mh << 1) & mask | ~(xv | ph) & mask
        mv = ph & xv
    return score


class BKTree:
    """Distinct strings under the Levenshtein metric, searched for many strings at once.

    Nodes lie in arrays, the children of each side by side with their distance to it. A
    search walks the tree level by level for all strings together; distances are
    bit-parallel columns over arrays, one lane for each pair of a string and a node.
    """

    def __init__(self, words) -> None:
        self.words: list[str] = []
        kids: list[dict[int, int]] = []
        for w in sorted(set(words)):
            at = 0
            while at < len(self.words):
                d = levenshtein(w, self.words[at])
                if d == 0:
                    break
                if d in kids[at]:
                    at = kids[at][d]
                    continue
                kids[at][d] = len(self.words)
                break
            self.words.append(w)
            kids.append({})
        self.first = np.cumsum([0] + [len(k) for k in kids])
        self.child = np.array([c for k in kids for c in k.values()], dtype=np.int64)
        self.edge = np.array([d for k in kids for d in k], dtype=np.int64)
        self.size = np.array([len(w) for w in self.words], dtype=np.int64)
        self.code = {c: i + 1 for i, c in enumerate(sorted({c for w in self.words for c in w[:64]}))}
        self.peq = np.zeros((len(self.words), len(self.code) + 1), dtype=np.uint64)
        for n, w in enumerate(self.words):
            for i, c in enumerate(w[:64]):
                self.peq[n, self.code[c]] |= np.uint64(1 << i)

    def _distances(self, q: np.ndarray, node: np.ndarray, texts: list[str], codes: np.ndarray, lens: np.ndarray) -> np.ndarray:
        out = np.empty(len(q), dtype=np.int64)
        for a in range(0, len(q), SLICE):
            qs, ns = q[a : a + SLICE], node[a : a + SLICE]
            n = lens[qs]
            score, got = self.size[ns].copy(), self.size[ns].copy()
            last = np.uint64(1) << (np.clip(self.size[ns], 1, 64) - 1).astype(np.uint64)
            pv, mv = np.full(len(qs), ~np.uint64(0)), np.zeros(len(qs), dtype=np.uint64)
            one = np.uint64(1)
            for j in range(int(n.max(initial=0))):
                eq = self.peq[ns, codes[qs, j]]
                xv = eq | mv
                xh = (((eq & pv) + pv) ^ pv) | eq
                ph, mh = mv | ~(xh | pv), pv & xh
                score += ((ph & last) != 0).astype(np.int64) - ((mh & last) != 0)
                ph, mh = (ph << one) | one, mh << one
                pv, mv = mh | ~(xv | ph), ph & xv
                done = n == j + 1
                got[done] = score[done]
            for i in np.flatnonzero(self.size[ns] > 64):  # longer than a machine word
                got[i] = levenshtein(texts[qs[i]], self.words[ns[i]])
            out[a : a + SLICE] = got
        return out

    def search(self, texts: list[str], radius: list[int], nearest: bool = False) -> list[tuple[int, int, str]]:
        """(place in ``texts``, distance, string) of all strings within each text's radius; only the nearest ones if asked."""
        found: list[tuple[int, int, str]] = []
        longest = int(self.size.max(initial=0))
        for a in range(0, len(texts), 256):
            part = texts[a : a + 256]
            reach = np.array(radius[a : a + 256], dtype=np.int64)
            lens = np.array([len(t) for t in part], dtype=np.int64)
            lens = np.where(lens > longest + reach, 0, lens)  # too long for any
            codes = np.zeros((len(part), int(lens.max(initial=0))), dtype=np.int64)
            for i, t in enumerate(part):
                codes[i, : lens[i]] = [self.code.get(c, 0) for c in t[: lens[i]]]
            q = np.flatnonzero((lens > 0) & (reach >= 0)) if self.words else np.array([], dtype=np.int64)
            node = np.zeros(len(q), dtype=np.int64)
            hits = []
            while len(q):
                d = self._distances(q, node, part, codes, lens)
                near = d <= reach[q]
                hits.append((q[near], d[near], node[near]))
                if nearest:
                    np.minimum.at(reach, q[near], d[near])
                n = self.first[node + 1] - self.first[node]
                at = np.repeat(self.first[node] - np.cumsum(n) + n, n) + np.arange(n.sum())
                q, d = np.repeat(q, n), np.repeat(d, n)
                go = np.abs(self.edge[at] - d) <= reach[q]
                q, node = q[go], self.child[at[go]]
            found += [(a + int(i), int(x), self.words[k]) for qs, ds, ns in hits for i, x, k in zip(qs, ds, ns, strict=True) if x <= reach[i]]
        return sorted(found)


def slack(word: str) -> int:
    """Edits allowed in a word of this length."""
    n = len(word)
    return 0 if n < 4 else 1 if n < 5 else 2 if n < 7 else 3


def words_of(text: str) -> list[str]:
    """Words without accents and case; a word with a comma after it has changed places with the next."""
    text = _ASIDE.sub(" ", text).replace(",-", ", ")
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
    parts = [re.sub(r"[^\w,]|_", " ", p) for p in re.split(r"[\s_/]+", re.sub(r"\s*-\s*", "-", text)) if p]
    # units are blank-separated; a hyphenated compound is one unit of several words
    units = [u for p in parts if (u := (p.replace(",", " ").split(), p.rstrip(" .)'\"").endswith(","))) and (u[0] or u[1])]
    out: list[list[str]] = []
    i = 0
    while i < len(units):
        if units[i][1] and i + 1 < len(units):
            out += [units[i + 1][0], units[i][0]]
            i += 2
        else:
            out.append(units[i][0])
            i += 1
    return [w for u in out for w in u]


def listed(w: str) -> bool:
    return w in FILLER or w in GENERIC


def arranged(words: list[str], drop) -> tuple[str, ...]:
    """Core words; what stands before an inner 'of' goes behind what follows it."""
    if "of" in words:
        at = words.index("of")
        words = words[at + 1 :] + words[:at]
    return tuple(w for w in words if not drop(w))


def reference_names(registry: DataFrame) -> DataFrame:
    """``id, name`` for every label and alias of the registry."""
    both = F.array_union(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))
    return (
        registry.select(F.col("theory_id").alias("id"), F.explode(both).alias("name"))
        .where("id IS NOT NULL AND trim(name) != ''")
        .distinct()
    )


def entries_of(names: DataFrame) -> DataFrame:
    """``id, short, words, joined`` of every name; short: an abbreviation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, name in zip(b["id"], b["name"], strict=True):
                plain = arranged(words_of(name), listed)
                if plain:
                    short = len(plain) == 1 and len(plain[0]) <= 5 and name.strip().isupper()
                    rows.append((key, short, list(plain), "".join(plain)))
            yield pd.DataFrame(rows, columns=["id", "short", "words", "joined"])

    return cut(names.mapInPandas(run, "id string, short boolean, words array<string>, joined string").distinct())


def _trees(strings: DataFrame, col: str, shard: int) -> Iterator:
    """Broadcast trees of at most about ``shard`` of the distinct strings each."""
    each = strings.select(col).distinct()
    parts = max(1, -(-each.count() // shard))
    for s in range(parts):
        mine = each.where(F.pmod(F.xxhash64(col), F.lit(parts)) == s).collect()  # a shard, whatever the list
        yield strings.sparkSession.sparkContext.broadcast(BKTree([r[0] for r in mine]))


def _looked_up(queries: DataFrame, trees: Iterator, nearest: bool) -> DataFrame:
    """``q, d, hit`` of all strings within the radius of each query (``q, radius``)."""
    trees, found = list(trees), None
    queries = queries if len(trees) == 1 else cut(queries)  # each tree goes over all of them
    for shared in trees:

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for b in batches:
                texts = b["q"].tolist()
                got = shared.value.search(texts, b["radius"].tolist(), nearest)
                yield pd.DataFrame([(texts[i], d, w) for i, d, w in got], columns=["q", "d", "hit"])

        part = queries.mapInPandas(run, "q string, d int, hit string")
        found = part if found is None else found.unionByName(part)
    return found


def word_distances(words: DataFrame, entries: DataFrame, shard: int) -> DataFrame:
    """``w, near, kind, far``: distance to the nearest word of the list (-1 beyond 3), and whether ``w`` is a misspelt kind word,
    read narrowly and read widely."""
    vocabulary = entries.where("NOT short").select(F.explode("words").alias("v"))
    got = _looked_up(words.select(F.col("w").alias("q"), F.lit(3).alias("radius")), _trees(vocabulary, "v", shard), True)
    near = words.join(got.groupBy(F.col("q").alias("w")).agg(F.min("d").alias("near")), "w", "left").na.fill({"near": -1})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds = BKTree(KINDS)
        for b in batches:
            ws, ds = b["w"].tolist(), b["near"].tolist()
            best: dict[int, int] = {}
            for i, d, _ in kinds.search(ws, [-(-len(w) // 2) for w in ws], True):
                best[i] = d
            rows = []
            for i, (w, d) in enumerate(zip(ws, ds, strict=True)):
                other, k = d if d >= 0 else 99, best.get(i, 99)
                able = other > 0 and len(w) >= 4
                narrow = able and k <= min(2, slack(w)) and k < other
                rows.append((w, d, narrow, able and k < 99 and (k < other or other > slack(w))))
            yield pd.DataFrame(rows, columns=["w", "near", "kind", "far"])

    return near.mapInPandas(run, "w string, near int, kind boolean, far boolean")


def _readings(said: list) -> list[tuple[str, ...]]:
    """Readings of the words in turn: near kind words removed, then turned round, then far ones removed."""
    words, out = [x["w"] for x in said], []
    for flag in ("kind", "far"):
        gone = {x["w"] for x in said if x[flag]}
        core = arranged(words, lambda w, gone=gone: listed(w) or w in gone)
        for reading in (core, core[::-1] if len(core) == 2 else core[1:] + core[:1]):
            if reading and reading not in out:
                out.append(reading)
    return out


def _slack(c: Column) -> Column:
    n = F.length(c)
    return F.when(n < 4, 0).when(n < 5, 1).when(n < 7, 2).otherwise(3)


def map_values(values: DataFrame, id_col: str, text_col: str, names: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per distinct id: ``<id_col>, match, distance``; no match is '' and -1."""
    each = values.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
    one = each.groupBy("k").agg(F.coalesce(F.min("t"), F.lit("")).alias("t"))
    entries = entries_of(names)

    def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"t": b["t"], "ws": [words_of(t) for t in b["t"]]})

    texts = cut(spread(one.select("t").where("trim(t) <> ''"), "t").distinct().mapInPandas(spell, "t string, ws array<string>"))
    said = texts.select(F.xxhash64("t").alias("h"), F.posexplode("ws").alias("pos", "w"))
    about = cut(word_distances(spread(said.select("w").distinct(), "w"), entries, shard))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for h, xs in zip(b["h"], b["xs"], strict=True):
                near = {x["w"]: x["near"] for x in xs}
                for i, core in enumerate(_readings(sorted(xs, key=lambda x: x["pos"]))):
                    rows.append((h, i, list(core), "".join(core), [near[w] for w in core]))
            yield pd.DataFrame(rows, columns=["h", "rank", "core", "joined", "near"])

    told = said.join(about, "w").groupBy("h").agg(F.collect_list(F.struct("pos", "w", "near", "kind", "far")).alias("xs"))
    readings = cut(told.mapInPandas(read, "h bigint, rank int, core array<string>, joined string, near array<int>"))
    cores = readings.select("core", "joined", "near").distinct()
    ids = lambda df: df.groupBy("joined").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    short = ids(entries.where("short")).select("joined", F.lit(True).alias("is_short"), F.when(F.col("low") == F.col("high"), F.col("low")).alias("short_id"))
    exact = ids(entries.where("NOT short")).select("joined", F.col("low").alias("exact_id"))
    judged = cut(
        cores.join(short, "joined", "left").join(exact, "joined", "left").withColumn("is_short", F.coalesce("is_short", F.lit(False)) & (F.size("core") == 1))
    )
    equal = judged.select("core", F.when(F.col("is_short"), F.col("short_id")).otherwise(F.col("exact_id")).alias("match"), F.lit(0).alias("distance")).where("match IS NOT NULL")
    # words of the list stand for themselves, and a word far from all of the list agrees with none
    unsure = judged.where("NOT is_short AND exact_id IS NULL").where(F.forall("near", lambda d: d >= 0) & F.exists("near", lambda d: d > 0))
    radius = F.aggregate("near", F.lit(0), lambda a, d: a + d)
    wanted = unsure.select(F.col("joined").alias("q"), radius.alias("radius")).groupBy("q").agg(F.max("radius").alias("radius"))
    full = entries.where("NOT short")
    hits = _looked_up(spread(wanted, "q"), _trees(full, "joined", shard), False)
    met = (
        unsure.select("core", "joined", "near").join(hits, F.col("joined") == F.col("q"))
        .join(full.select(F.col("joined").alias("hit"), "words", "id"), "hit")
        .where(F.size("core") == F.size("words"))
    )
    apart = F.zip_with("core", "words", lambda w, t: F.struct(F.levenshtein(w, t).alias("d"), _slack(t).alias("s")))
    agree = met.where(F.forall(F.zip_with(apart, "near", lambda x, n: (x["d"] == n) & (n <= x["s"])), lambda ok: ok))
    best = agree.groupBy("core", "d").agg(F.min("id").alias("low"), F.max("id").alias("high")).groupBy("core").agg(
        F.min(F.struct("d", "low", "high")).alias("b")
    )
    close = best.where("b.low = b.high").select("core", F.col("b.low").alias("match"), F.col("b.d").alias("distance"))
    first = (
        readings.select("h", "rank", "core").join(equal.unionByName(close), "core")
        .groupBy("h").agg(F.min(F.struct("rank", "match", "distance")).alias("m"))
    )
    return (
        one.withColumn("h", F.xxhash64("t")).join(first, "h", "left")
        .select(F.col("k").alias(id_col), F.coalesce("m.match", F.lit("")).alias("match"), F.coalesce("m.distance", F.lit(-1)).alias("distance"))
    )

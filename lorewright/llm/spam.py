"""Keyword-stuffed and link-list pages by robust outlier distance.

Each text gives six features: the length of stretches without a function word, how many
content words come back nearby, share of function words, share of words in
well-formed sentences, entropy of the words, and share of links. Per
language the features' centre and scatter are estimated robustly: medians and
absolute floors first, then mean and covariance over the rows within the cutoff, in turn until no
estimate changes. A page is flagged if its Mahalanobis distance lies beyond the cutoff and
its deviation, in the metric of that covariance, goes far in the direction of spam (all
features on their spam side, each by its own scatter).

A text of few words tells little: deviations are shrunk by words / (words + ``few``). A
language of few texts tells little too: ``prior`` rows of the pooled estimates are added to each.

Defined results: rows of null id, null and blank texts have no features and are never flagged;
languages are read off the function words, the ``lang`` column is not used; a text
without any function word has no language and is held against the pooled estimates; repeated
rows are judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.llm.wordlists import ANY, SETS
from lorewright.session import cut, spread_scan

FEATURES = ["run", "repeat", "function", "prose", "entropy", "links"]
#: Sign of each feature on the spam side.
SIDE = np.array([1.0, 1.0, -1.0, -1.0, -1.0, 1.0])
#: Least scale of each feature, so that a feature most texts share exactly cannot dominate.
FLOOR = np.array([0.35, 0.12, 0.06, 0.12, 0.08, 0.08])
#: 0.999 quantiles of chi-square with six degrees of freedom and of the normal distribution.
CUTOFF, LEAN = 22.46, 3.09
LANGS = sorted(SETS)
#: Characters of text turned into arrays at once; a longer text is taken alone.
TOGETHER = 500_000

_TOKEN = re.compile(
    r"<[^<>]{0,2000}>|(?:https?://|www\.)\S+|[^\W_]+(?:[-'’][^\W_]+)*|[.!?](?=['\")\]]*(?:\s|$))|\n\s*\n|[|•»;,\[\]#/]"
)
WORD, LINK, STOP, BREAK, MARK, DROP = range(6)
WIDE = 20


def _kind(token: str) -> int:
    if token[:2] == "</":
        return DROP
    if token[0] == "<" or token.startswith(("http", "www.")):
        return LINK
    return STOP if token in ".!?" else BREAK if token[0] == "\n" else WORD if token[0].isalnum() else MARK


def features(texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """(words, language, features) of each text; all texts are handled together as arrays of tokens."""
    found = [_TOKEN.findall(t) for t in texts]
    many = len(texts)
    flat = [t for f in found for t in f]
    code, types = pd.factorize(np.array([*flat, "."], dtype=object))
    code = code[:-1]
    kinds = np.array([_kind(t) for t in types])
    low = [t.lower() if k == WORD else "" for t, k in zip(types, kinds, strict=True)]
    stems = [w if w in ANY else s if (s := w.replace("’", "'").split("'")[0]) in ANY else "" for w in low]
    same = pd.factorize(np.array(low, dtype=object))[0]  # links are one word
    member = np.array([[s in SETS[k] for k in LANGS] for s in stems], dtype=float)
    kind = kinds[code]
    doc = np.repeat(np.arange(many), [len(f) for f in found])
    ends = (kind == STOP) | (kind == BREAK)
    first = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.array([], dtype=bool)
    sent = np.cumsum(np.r_[False, ends[:-1]] | first) - 1 if len(doc) else np.array([], dtype=int)
    ns = int(sent[-1]) + 1 if len(sent) else 0
    stopped = np.bincount(sent, kind == STOP, ns) > 0
    marks = np.bincount(sent, kind == MARK, ns)
    keep = kind <= LINK
    at, doc, sent, link = code[keep], doc[keep], sent[keep], kind[keep] == LINK
    word, func = same[at], member[at].any(1) if len(at) else np.array([], dtype=bool)
    size = np.array([len(t) for t in types], dtype=float)[at]
    n = np.bincount(doc, minlength=many)
    per = lambda x: np.bincount(doc, x, many)
    nf = per(func)
    content = ~func
    # runs of words without a function word
    new = np.r_[True, (doc[1:] != doc[:-1]) | func[1:] | func[:-1]] if len(doc) else np.array([], dtype=bool)
    run = np.cumsum(new) - 1
    length = np.bincount(run)[run] if len(run) else run
    # content words that come back within WIDE words
    pos = np.arange(len(doc))
    idx = np.flatnonzero(content)
    order = idx[np.lexsort((idx, word[idx], doc[idx]))]
    near = (doc[order][1:] == doc[order][:-1]) & (word[order][1:] == word[order][:-1]) & (np.diff(pos[order]) <= WIDE)
    again = np.zeros(len(doc))
    again[order[1:][near]] = 1
    again[order[:-1][near]] = 1
    # sentences: function words, fresh content words, few marks, no link inside
    ls, hits = np.bincount(sent, minlength=ns), np.bincount(sent, func, ns)
    real = np.cumsum(~link) if len(link) else link
    begin = np.r_[0, np.cumsum(ls)][:-1]
    before = np.r_[0, real][begin[sent]] if len(sent) else sent  # real words before the sentence
    inner = np.bincount(sent, link & (real > before), ns)
    words_in = np.bincount(sent, ~link, ns)
    top = int(word.max(initial=0)) + 1
    pair = np.unique(sent[content & ~link].astype(np.int64) * top + word[content & ~link]) // top
    fresh, stuff = np.bincount(pair, minlength=ns), np.bincount(sent, content & ~link, ns)
    good = stopped & (hits >= 2) & (inner == 0) & (marks * 4 < words_in) & (fresh >= 0.75 * stuff)
    prose = per(good[sent] & ~link) if len(sent) else np.zeros(many)
    key, c = np.unique(doc.astype(np.int64) * top + word, return_counts=True)
    kd = key // top
    p = c / n[kd]
    entropy = np.bincount(kd, -p * np.log(p), many)
    n1 = np.maximum(n, 1)
    votes = np.stack([per(member[at, i]) for i in range(len(LANGS))], 1) if len(at) else np.zeros((many, len(LANGS)))
    lang = np.where(votes.max(1) > 0, np.array(LANGS, dtype=object)[votes.argmax(1)], "und")
    x = np.stack([
        per(np.log2(length) * content) / np.maximum(1, n - nf), per(again) / np.maximum(1, n - nf), nf / n1, prose / n1,
        np.where(n > 1, entropy / np.log(np.maximum(n, 2)), 1.0), per(size * link) / np.maximum(per(size), 1),
    ], 1)
    return n, list(lang), x


def page_features(docs: DataFrame) -> DataFrame:
    """``doc_id, tongue, words`` and the features of every text that has words."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            part = (b["text"].str.len().cumsum() // TOGETHER).to_numpy()
            for _, rows in b.groupby(part):
                n, lang, x = features(rows["text"].tolist())
                out = pd.DataFrame(x, columns=FEATURES)
                out.insert(0, "doc_id", rows["doc_id"].to_numpy())
                out.insert(1, "tongue", lang)
                out.insert(2, "words", n)
                yield out[n > 0]

    return spread_scan(docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")).mapInPandas(
        run, f"doc_id {kind}, tongue string, words bigint, " + ", ".join(f"{x} double" for x in FEATURES)
    )


Model = dict[str, tuple[np.ndarray, np.ndarray]]


def _moments(rows: DataFrame) -> dict[str, tuple[int, np.ndarray, np.ndarray]]:
    """Rows, mean and covariance by language."""
    k = len(FEATURES)
    aggs = [F.avg(x) for x in FEATURES] + [F.covar_pop(FEATURES[a], FEATURES[b]) for a in range(k) for b in range(a, k)]
    out = {}
    for r in rows.groupBy("tongue").agg(F.count("*"), *aggs).collect():  # one row per language
        v = list(r)
        s, it = np.zeros((k, k)), iter(v[2 + k :])
        for a in range(k):
            for b in range(a, k):
                s[a, b] = s[b, a] = next(it)
        out[r[0]] = (v[1], np.array(v[2 : 2 + k], dtype=float), s)
    return out


def _estimate(parts: dict[str, tuple[int, np.ndarray, np.ndarray]], prior: int) -> Model:
    """Mean and covariance of every language, each with ``prior`` rows of the pool added."""
    total = sum(n for n, _, _ in parts.values())
    centre = sum(n * m for n, m, _ in parts.values()) / total
    around = lambda m, c, at: c + np.outer(m - at, m - at)
    pool = sum(n * around(m, c, centre) for n, m, c in parts.values()) / total
    out = {"und": (centre, pool)}
    for lang, (n, m, c) in parts.items():
        if lang != "und":
            mu = (n * m + prior * centre) / (n + prior)
            out[lang] = (mu, (n * around(m, c, mu) + prior * around(centre, pool, mu)) / (n + prior))
    return out


def _scored(rows: DataFrame, models: Model, few: float) -> DataFrame:
    """Adds ``distance`` (squared) and ``side`` (how far in the direction of spam) by each row's language."""
    distance, side = F.lit(None).cast("double"), F.lit(None).cast("double")
    trust = F.col("words") / (F.col("words") + few)
    for lang, (mu, s) in models.items():
        s = s + np.diag(np.square(FLOOR))
        inv = np.linalg.inv(s)
        way = SIDE * np.sqrt(np.diag(s))
        way = inv @ way / np.sqrt(way @ inv @ way)
        dev = [F.col(x) - float(m) for x, m in zip(FEATURES, mu, strict=True)]
        line = lambda w, dev=dev: sum((x * float(c) for x, c in zip(dev, w, strict=True)), F.lit(0.0))
        d2 = sum((dev[a] * line(inv[a]) for a in range(len(dev))), F.lit(0.0))
        distance = F.when(F.col("tongue") == lang, d2 * trust * trust).otherwise(distance)
        side = F.when(F.col("tongue") == lang, line(way) * trust).otherwise(side)
    return rows.withColumns({"distance": distance, "side": side})


def spam_scores(docs: DataFrame, prior: int = 50, few: float = 8.0, max_steps: int = 100) -> DataFrame:
    """Features with ``distance, side, spam`` for every text that has words."""
    rows = cut(page_features(docs))
    mid = [F.percentile_approx(x, 0.5, 1000).alias(x) for x in FEATURES]
    sizes = {r["tongue"]: r for r in rows.rollup("tongue").agg(F.count("*").alias("n"), *mid).collect()}  # one row per language
    middle = lambda r: np.array([r[x] for x in FEATURES], dtype=float)
    models: Model = {}
    if sizes.get(None) is not None and sizes[None]["n"]:
        whole, wide = middle(sizes[None]), np.diag(np.square(FLOOR)) * 3.0
        models = {k: ((r["n"] * middle(r) + prior * whole) / (r["n"] + prior), wide) for k, r in sizes.items() if k not in (None, "und")}
        models["und"] = (whole, wide)
        for _ in range(max_steps):
            parts = _moments(_scored(rows, models, few).where(F.col("distance") < CUTOFF))
            if not parts:
                break
            now = models | _estimate(parts, prior)
            change = max(float(np.max(np.abs(now[k][0] - models[k][0]) / FLOOR)) for k in models)
            models = now
            if change < 1e-6:
                break
        else:
            raise RuntimeError("the robust estimates did not settle")
    return _scored(rows, models, few).withColumn("spam", F.coalesce((F.col("distance") > CUTOFF) & (F.col("side") > LEAN), F.lit(False)))

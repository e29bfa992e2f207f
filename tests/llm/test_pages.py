"""Spam pages and answer pairs."""

import random

import numpy as np

from lorewright.llm import pairs, spam
from lorewright.llm.crf import CRF, hashed

GOOD = [
    "We examined whether the loss of {} changes survival in {} mice over the course of the study.", "In the same cohort, {} was measured only once and the result was not clear to the authors of {}.",
    "The cost of {} may explain why animals age faster when they are kept in {} conditions.", "It is not known if {} is a cause or a consequence of the decline that was seen in {}.",
]


def honest(rnd, n=6):
    return " ".join(rnd.choice(GOOD).format(f"w{rnd.randint(0, 400)}", f"v{rnd.randint(0, 400)}") for _ in range(n))


def spammy(rnd):
    kind = rnd.randint(0, 2)
    if kind == 0:
        return " ".join(rnd.choice(["cheap pills", "buy drops", "best serum", "pills online"]) for _ in range(60))
    if kind == 1:
        return "\n".join(f"https://x{rnd.randint(0, 99)}.example/a-{rnd.randint(0, 999)}" for _ in range(30))
    return " ".join(f"[{rnd.choice(['serum', 'drops'])}] [{rnd.choice(['price', 'coupon'])}]" for _ in range(40))


def test_spam_is_told_from_prose(spark):
    rnd = random.Random(3)
    rows = [(i, honest(rnd), 1.0) for i in range(300)] + [(1000 + i, spammy(rnd), 1.0) for i in range(40)]
    rows += [(2000, honest(rnd) + "\n\nSee https://a.example/x. Keywords: a, b, c.", 1.0), (2001, None, 1.0), (2002, " ", 1.0), (2003, "404 page not found", 1.0), (None, "x", 1.0), (0, rows[0][1], 1.0)]
    got = spam.spam_scores(spark.createDataFrame(rows, "doc_id bigint, text string, distance double"))
    flagged = {r["doc_id"] for r in got.where("spam").collect()}
    assert flagged == set(range(1000, 1040))
    assert {r["doc_id"] for r in got.collect()} >= {0, 2003} and got.where("doc_id IN (2001, 2002)").count() == 0


def test_spam_of_nothing(spark):
    assert spam.spam_scores(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_features_of_odd_texts():
    n, lang, x = spam.features(["...", "", "<a href='x'>y</a> " * 1000, "wort " * 50_000, "The cat and the dog.", "See https://a.example/x for it."])
    assert list(n) == [0, 0, 2000, 50_000, 5, 4] and lang[3] == "und" and lang[4] == "en"
    assert x.shape == (6, 6) and np.isfinite(x).all()
    alone = [spam.features([t]) for t in ("wort " * 50_000, "The cat and the dog.")]
    assert np.allclose(alone[0][2][0], x[3]) and np.allclose(alone[1][2][0], x[4])


def test_short_texts_tell_little(spark):
    rnd = random.Random(5)
    rows = [(i, honest(rnd)) for i in range(200)] + [(1000 + i, "Aging.") for i in range(20)] + [(2000 + i, spammy(rnd)) for i in range(5)]
    got = spam.spam_scores(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {r["doc_id"] for r in got.where("spam").collect()} == set(range(2000, 2005))


def test_crf_learns_a_chain():
    rnd = random.Random(1)
    seqs, labels = [], []
    for _ in range(300):
        tags, words = [], []
        for _ in range(rnd.randint(1, 6)):
            t = 1 if tags and tags[-1] == 1 and rnd.random() < 0.9 else rnd.randint(0, 1)
            tags.append(t)
            words.append("x" if rnd.random() < 0.3 else "ab"[t])
        seqs.append([hashed([w], 8) for w in words])
        labels.append(tags)
    crf = CRF(["0", "1"], bits=8).fit(seqs, labels, epochs=20)
    right = sum(a == b for s, y in zip(seqs, labels) for a, b in zip(crf.decode(s), y))
    assert right / sum(map(len, labels)) > 0.85
    assert crf.decode([hashed(["b"], 8), hashed(["x"], 8)]) == [1, 1]


def brute_decode(crf, seq):
    import itertools

    em = [crf.w[f].sum(0) for f in seq]
    score = lambda p: crf.start[p[0]] + sum(e[t] for e, t in zip(em, p)) + sum(crf.trans[a, b] for a, b in zip(p, p[1:]))
    return list(max(itertools.product(range(len(crf.tags)), repeat=len(seq)), key=score))


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(0)
    crf = CRF(["a", "b", "c"], bits=4)
    crf.w, crf.trans, crf.start = rng.normal(size=crf.w.shape), rng.normal(size=(3, 3)), rng.normal(size=3)
    for _ in range(20):
        seq = [list(rng.integers(0, 16, size=2)) for _ in range(5)]
        assert crf.decode(seq) == brute_decode(crf, seq)


SCHEMA = "answer_id bigint, question string, answer string, evidence string, loaded_at timestamp, defect string"


def qa_rows():
    rnd = random.Random(4)
    q = "Is the marker reported in the paper?"
    rows = []
    for i in range(700):
        subject, place = rnd.choice(["expression", "density", "survival", "weight"]), rnd.choice(["liver", "skin", "muscle", "retina"])
        rows.append((q, f"Yes - The {subject} of the {place} was measured in {i} animals and fell with age."))
    for i in range(60):
        rows.append((q, f"I cannot comment on this study, as no text {i} was supplied. You may rephrase the request."))
        rows.append((q, f"Nous avons étudié si la densité {i} modifie la survie chez les souris."))
        rows.append((q, f"The expression of the liver was measured in {i} ani-"))
        rows.append((q, q.upper() if i % 2 else f"<p>{q}</p>"))
        rows.append(("La densité est-elle mesurée dans la souris ?", f"Nous avons étudié si la survie {i} modifie la densité chez les souris."))
    return rows


def test_defects_of_pairs(spark):
    data = [(i, q, a, None, None, "x") for i, (q, a) in enumerate(qa_rows())]
    n = len(data)
    q = data[0][1]
    extra = {
        n: (q, None, "empty"), n + 1: (q, " ​- ", "empty"), n + 2: (q, "n/a", "empty"), n + 3: (q, "I can't help with that; I am not able to read the paper.", "refusal"),
        n + 4: (q, "La survie a diminué chez les souris dans le foie.", "other_language"), n + 5: (q, "The density of the skin was measured in the", "truncated"),
        n + 6: (q, "Is the marker reprted in the paper", "copied_question"), n + 7: (q, "Yes", None), n + 8: (None, "The weight of the skin was measured in 7 animals and fell with age.", None),
        n + 10: (q, f"You asked: {q.lower()[:-1]}.", "copied_question"), n + 11: (q, "I'd rather not speculate; please consult someone else.", "refusal"), n + 12: (q, "", "empty"),
        n + 13: (q, "The density of the musc", "truncated"), n + 14: (q, "w " * 30_000 + ".", None), n + 9: (q, f"{q} Yes. The weight of the skin was measured in 7 animals and fell with age.", None),
    }
    data += [(k, a, b, "{broken", None, "x") for k, (a, b, _) in extra.items()] + [(0, data[0][1], data[0][2], None, None, "x"), (None, q, "x", None, None, "x")]
    got = {r["answer_id"]: r["defect"] for r in pairs.pair_defects(spark.createDataFrame(data, SCHEMA)).collect()}
    for k, (_, text, want) in extra.items():
        assert got.get(k) == want, (text, got.get(k))
    assert not any(k < 700 for k in got)


def test_defects_of_nothing(spark):
    assert pairs.pair_defects(spark.createDataFrame([], SCHEMA)).count() == 0


def test_features_hold_the_whole_clause():
    t = pairs.Tagger().train([])
    text = " ".join(f"{'abcdefghijklmnopqrstuvwxyz'[i]}word" for i in range(26)) + "."
    got = t._features(t._cues(pairs.clauses(text), None, None, pairs.PLAIN))[0]
    assert {pairs.hashed([v], t.crf.bits)[0] for v in ("w=aword", "w=zword", "b=yword_zword")} <= set(got)

"""Nine questions answered from the sentences of a paper.

Each question has a trigger and a ladder of conditions; the first sentence that
matches the trigger decides, and is the evidence. Matching is by substring of
the lower-case sentence. ``expression`` and ``sql`` are built from one table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorewright.functions.text import analysis_text, sentences

DIGIT = "[0-9]"

#: Fixed values: (question, triggers that must all be met, ladder of (terms, digit counts, label, confidence), none label, confidence).
RULES = [
    ("Q1", [["biomarker", "marker", "signature"]],
     [(["measured", "level", "concentration", "quantified", "assay", "mg", "ng", "pg"], True, "Yes, quantitatively shown", 0.9),
      ([], False, "Yes, mentioned without data", 0.6)], "No evidence found", 0.1),
    ("Q2", [["mechanism", "pathway", "molecular", "signaling", "process"]],
     [(["experiment", "demonstrate", "showed", "knockout", "mutation", "assay", "inhibited"], False, "Mechanism supported by experiments", 0.85),
      (["suggest", "propose", "hypothesize", "may", "could"], False, "Mechanism hypothesized", 0.6),
      ([], False, "Mechanism hypothesized", 0.55)], "No mechanism discussed", 0.1),
    ("Q3", [["intervention", "treatment", "therapy", "drug", "compound", "supplement", "regimen"]],
     [(["extends lifespan", "increased lifespan", "longevity", "survival", "lifespan"], False, "Validated longevity intervention", 0.9),
      (["potential", "candidate", "may", "could", "propose", "suggest"], False, "Proposed longevity intervention", 0.6),
      ([], False, "Proposed longevity intervention", 0.55)], "No intervention discussed", 0.1),
    ("Q4", [["irreversible", "permanent", "irreversibly", "cannot be reversed", "reversible", "reversibly", "restored", "rescued", "recovered"]],
     [(["irreversible", "permanent", "irreversibly", "cannot be reversed"], False, "Changes appear irreversible", 0.8),
      ([], False, "Changes appear reversible", 0.75)], "Not discussed", 0.2),
    ("Q5", [["cross-species", "comparative", "predict", "predictor", "phylogenetic", "across species"]],
     [(["model", "regression", "correlation", "estimate", "coefficient", "dataset", "analysis"], True, "Yes, quantitatively shown", 0.85),
      ([], False, "Yes, mentioned without data", 0.55)], "No evidence found", 0.1),
    ("Q6", [["naked mole rat", "heterocephalus glaber", "nmr"]],
     [(["study", "experiment", "analysis"], False, "Primary focus of the paper", 0.85),
      ([], False, "Mentioned in passing", 0.6)], "Not mentioned", 0.1),
    ("Q7", [["avian", "bird", "passerine", "avian longevity", "galliform"]],
     [((["longevity", "lifespan"], ["study", "analysis", "analyz"]), False, "Primary focus of the paper", 0.8),
      (["longevity", "lifespan"], False, "Mentioned in passing", 0.55),
      ([], False, "Mentioned in passing", 0.5)], "Not mentioned", 0.1),
    ("Q8", [["body size", "mass", "weight", "allometry", "scaling"], ["longevity", "lifespan", "life span", "survival"]],
     [(["correlated", "association", "regression", "model", "predict"], True, "Link supported by data", 0.8),
      ([], False, "Link is speculative", 0.55)], "No link reported", 0.1),
    ("Q9", [["calorie restriction", "caloric restriction", "dietary restriction", "restricted diet", "calorie-restricted"]],
     [(["experiment", "trial", "controlled", "randomized", "intervention"], False, "Experimental evidence presented", 0.85),
      (["observational", "survey", "cohort", "epidemiological"], False, "Observational evidence presented", 0.6),
      ([], False, "Observational evidence presented", 0.55)], "No evidence presented", 0.1),
]


def _any(s: Column, terms: list[str]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(s, F.lit(t))
    return out


def _condition(s: Column, terms, digit: bool) -> Column:
    if isinstance(terms, tuple):
        out = F.lit(True)
        for group in terms:
            out = out & _any(s, group)
        return out
    if not terms:
        return F.lit(True)
    return _any(s, terms) | s.rlike(DIGIT) if digit else _any(s, terms)


def _meets(triggers):
    """Whether a lower-case sentence has a term of every group."""

    def test(s: Column) -> Column:
        out = F.lit(True)
        for group in triggers:
            out = out & _any(s, group)
        return out

    return test


def answer_papers(papers: DataFrame, rules=RULES) -> DataFrame:
    """``identifier, question_id, answer, confidence, evidence`` for every paper and question."""
    text = F.concat_ws("\n", F.coalesce("title", F.lit("")), analysis_text())
    # projections in steps: sentences once, their lower case once, the place of the deciding sentence once
    prepared = papers.select("identifier", sentences(text).alias("ss")).withColumn("low", F.transform("ss", F.lower))
    at = {q: F.array_position(F.transform("low", _meets(triggers)), True).cast("int") for q, triggers, *_ in rules}
    placed = prepared.select("identifier", "ss", "low", *[at[q].alias(f"at_{q}") for q in at])
    first = placed.select(
        "identifier", *[F.get("ss", F.col(f"at_{q}") - 1).alias(f"ev_{q}") for q in at], *[F.get("low", F.col(f"at_{q}") - 1).alias(f"low_{q}") for q in at]
    )
    answers = []
    for q, _, ladder, none, base in rules:
        low = F.col(f"low_{q}")
        label, conf = F.lit(none), F.lit(base)
        for terms, digit, text_, value in reversed(ladder):
            hit = low.isNotNull() & _condition(low, terms, digit)
            label, conf = F.when(hit, text_).otherwise(label), F.when(hit, value).otherwise(conf)
        answers.append(F.struct(F.lit(q).alias("question_id"), label.alias("answer"), conf.alias("confidence"), F.col(f"ev_{q}").alias("evidence")))
    return first.select("identifier", F.explode(F.array(*answers)).alias("a")).select("identifier", "a.*")


def combine(heuristic: Column, h_conf: Column, model: Column, m_conf: Column, allowed: list[str], decline: list[str],
            override: float = 0.85, h_weight: float = 0.4, bonus: float = 0.1, penalty: float = 0.1) -> tuple[Column, Column]:
    """Final answer and confidence of a heuristic and a model answer.

    Agreement raises the greater confidence by a tenth of the lesser; a sure model
    answer replaces the heuristic one; else confidences are weighted and the model
    wins if strictly surer. An invalid answer costs a tenth; a declining one changes nothing.
    """
    m = F.lower(F.trim(F.coalesce(model, F.lit(""))))
    valid = m.isin(*[a.lower() for a in allowed]) & ~m.isin(*[d.lower() for d in decline])
    canon = F.coalesce(*[F.when(m == a.lower(), F.lit(a)) for a in allowed]) if allowed else F.lit(None)
    mc = F.coalesce(m_conf, F.lit(0.0))
    agree = valid & (m == F.lower(heuristic))
    sure = valid & (mc >= override) & (mc >= h_conf)
    answer = F.when(agree, heuristic).when(sure, canon).when(valid & (mc > h_conf), canon).otherwise(heuristic)
    conf = (
        F.when(agree, F.least(F.lit(1.0), F.greatest(h_conf, mc) + bonus * F.least(h_conf, mc)))
        .when(sure, F.least(F.lit(1.0), mc + 0.05))
        .when(valid, F.least(F.lit(1.0), h_conf * h_weight + mc * (1 - h_weight)))
        .when((m == "") | m.isin(*[d.lower() for d in decline]), h_conf)
        .otherwise(F.greatest(F.lit(0.0), h_conf - penalty))
    )
    return answer, conf


def sql(sentence_list: str, question: tuple) -> tuple[str, str, str]:
    """DuckDB expressions (first sentence, answer, confidence) of one rule over a list of sentences."""
    _, triggers, ladder, none, base = question
    any_ = lambda s, ts: "(" + " OR ".join(f"contains({s}, '{t}')" for t in ts) + ")"
    meets = " AND ".join(any_("lower(s)", g) for g in triggers)
    first = f"list_filter({sentence_list}, lambda s: {meets})[1]"
    low = f"lower({first})"

    def cond(terms, digit):
        if isinstance(terms, tuple):
            return " AND ".join(any_(low, g) for g in terms)
        if not terms:
            return "true"
        return f"({any_(low, terms)} OR regexp_matches({low}, '{DIGIT}'))" if digit else any_(low, terms)

    case = lambda pick, none: f"CASE WHEN {first} IS NULL THEN {none} " + " ".join(f"WHEN {cond(t, d)} THEN {pick(x, v)}" for t, d, x, v in ladder) + " END"
    return first, case(lambda x, v: f"'{x}'", f"'{none}'"), case(lambda x, v: str(v), str(base))

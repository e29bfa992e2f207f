"""Exports: flat tables for CSV, reports, and state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def papers_table(papers: DataFrame) -> DataFrame:
    """Twelve text columns: lists joined by ``; ``, sections as JSON, flags true, false or blank."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    cols = []
    for name, kind in papers.dtypes:
        c = F.col(name)
        if kind == "array<string>":
            c = F.array_join(c, "; ")
        elif kind.startswith(("array", "struct", "map")):
            c = F.to_json(c)
        cols.append(blank(c).alias(name))
    return papers.select(*cols)


def theories_table(counts: DataFrame) -> DataFrame:
    """Counts sorted by size, then name."""
    return counts.orderBy(F.desc("n"), F.lower("theory"))


def theory_papers_table(assigned: DataFrame, papers: DataFrame, id_col: str = "identifier") -> DataFrame:
    """Theory and paper pairs with the paper's fields; unknown papers are left out, repeats count once."""
    year = F.coalesce(F.expr("try_cast(year as int)"), F.lit(9999))
    return (
        assigned.select("theory", id_col).distinct().join(papers.select(id_col, "title", "year"), id_col)
        .orderBy("theory", year, F.lower("title")).select("theory", id_col, "title", "year")
    )


def long_answer_table(assigned: DataFrame, answers: DataFrame) -> DataFrame:
    """One row per theory, paper and answered question."""
    return assigned.select("theory", "paper_id").distinct().join(answers.where(F.trim("answer") != ""), "paper_id").select(
        "theory", "paper_id", "question_id", "answer", F.round("confidence", 3).alias("confidence")
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def evidence_json(answer: Column, confidence: Column, evidence: Column) -> Column:
    return F.to_json(F.struct(F.struct(answer.alias("answer"), confidence.alias("confidence"), evidence.alias("evidence")).alias("heuristic")))


def progress_report(scores: DataFrame, deficits: DataFrame, metrics: DataFrame, top: int | None = None) -> str:
    """Markdown of the largest contributions, deficits and question metrics; with ``top``, the tables shown are limited to so many rows."""
    some = lambda df: df if top is None else df.limit(top)
    lines = ["# Progress", "", "| theory | papers | contribution |", "|-|-|-|"]
    lines += [f"| {r['theory']} | {r['n']} | {r['contribution']:.4f} |" for r in some(scores.orderBy(F.desc("contribution"), "theory")).toLocalIterator()]
    lines += ["", "| theory | deficit |", "|-|-|"]
    lines += [f"| {r['theory']} | {r['deficit']} |" for r in some(deficits.where("deficit > 0").orderBy(F.desc("deficit"), "theory")).toLocalIterator()]
    lines += ["", "| question | answered | blanks | yes |", "|-|-|-|-|"]
    lines += [f"| {r['question_id']} | {r['answered']} | {r['blanks']} | {r['yes_count']} |" for r in some(metrics.orderBy("question_id")).toLocalIterator()]
    return "\n".join(lines) + "\n"


def append_new(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows for an append-only store: keys stored already are left out, the first of a key is kept.

    First is by the column ``ordinal`` where there is one, then by the row's own values.
    """
    fresh = rows.join(seen.select(key).distinct(), key, "left_anti")
    order = F.struct(*(["ordinal"] if "ordinal" in rows.columns else []), F.to_json(F.struct(*rows.columns)))
    return fresh.groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def content_key(payload: Column) -> Column:
    """Address of a cache entry."""
    return F.sha2(payload, 256)

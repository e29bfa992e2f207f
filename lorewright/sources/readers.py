"""Readers of files: seeds, exports, checkpoints and ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorewright.functions.text import as_flag, split_authors, trimmed
from lorewright.sources.schemas import PAPER, TRUTH


def _csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def seed_json(spark: SparkSession, path: str) -> DataFrame:
    """Papers from a JSON array, coerced to the paper schema."""
    return spark.read.schema(PAPER).option("multiLine", True).json(path)


def papers_csv(spark: SparkSession, path: str) -> DataFrame:
    """Papers from an export: lists split on ``;``, sections from JSON text, flags with NULL for unknown."""
    raw = _csv(spark, path)
    opt = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    return raw.select(
        "identifier", "title", opt("abstract").alias("abstract"), opt("source").alias("source"), opt("full_text").alias("full_text"),
        split_authors(opt("authors")).alias("authors"), split_authors(opt("influential_citations")).alias("influential_citations"),
        F.expr("try_cast(year as int)").alias("year") if "year" in raw.columns else F.lit(None).cast("int").alias("year"),
        F.expr("try_cast(citation_count as int)").alias("citation_count") if "citation_count" in raw.columns else F.lit(None).cast("int").alias("citation_count"),
        F.nullif(trimmed(opt("doi")), F.lit("")).alias("doi"), as_flag(opt("is_review")).alias("is_review"),
        F.from_json(opt("sections"), "array<struct<title:string,text:string>>").alias("sections"),
    )


def questions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Answer rows of an export: paper by ``paper_url`` else ``paper_id``; rows without one are dropped, a blank theory is named."""
    raw = _csv(spark, path)
    have = [F.nullif(F.trim(c), F.lit("")) for c in ("paper_url", "paper_id") if c in raw.columns]
    theory = F.nullif(F.trim("theory_id"), F.lit("")) if "theory_id" in raw.columns else F.lit(None)
    rest = [c for c in raw.columns if c not in ("paper_url", "paper_id", "theory_id")]
    return raw.select(F.coalesce(theory, F.lit("<unspecified>")).alias("theory_id"), F.coalesce(*have).alias("paper_url"), *rest).where("paper_url IS NOT NULL")


def long_answers(wide: DataFrame, questions: list[str]) -> DataFrame:
    """Wide question columns as rows; blanks are left out."""
    keep = [c for c in ("theory_id", "paper_url") if c in wide.columns]
    return wide.unpivot(keep, [q for q in questions if q in wide.columns], "question_id", "answer").where(F.trim("answer") != "")


def ground_truth(spark: SparkSession, path: str, questions: list[str]) -> DataFrame:
    """Expected answers from CSV or JSON; an unknown question id fails the read."""
    if path.endswith(".json"):
        raw = spark.read.schema(f"ground_truth array<struct<{_fields(TRUTH)}>>, entries array<struct<{_fields(TRUTH)}>>, data array<struct<{_fields(TRUTH)}>>, {TRUTH}").option("multiLine", True).json(path)
        inner = F.coalesce("ground_truth", "entries", "data")
        own = F.array(F.struct(*[c.split()[0] for c in TRUTH.split(", ")]))
        rows = raw.select(F.explode(F.coalesce(inner, own)).alias("x")).select("x.*")
    else:
        rows = _csv(spark, path)
        names = {"expected": "expected_answer", "answer": "expected_answer", "paper_id": "paper_url", "theory": "theory_id", "question": "question_id"}
        for old, new in names.items():
            if old in rows.columns and new not in rows.columns:
                rows = rows.withColumnRenamed(old, new)
        if "theory_id" not in rows.columns:
            rows = rows.withColumn("theory_id", F.lit(None).cast("string"))
    q = F.upper(trimmed("question_id"))
    checked = F.when(q.isin(*questions), q).otherwise(F.raise_error(F.concat(F.lit("unknown question "), F.coalesce(q, F.lit("NULL")))).cast("string"))
    return rows.select(F.nullif(F.trim("theory_id"), F.lit("")).alias("theory"), F.trim("paper_url").alias("paper_id"), checked.alias("question_id"), F.trim("expected_answer").alias("expected"))


def _fields(ddl: str) -> str:
    return ",".join(":".join(x.split()) for x in ddl.split(", "))


def json_lines(spark: SparkSession, path: str, schema: str, keep_broken: bool = False) -> DataFrame:
    """JSON lines; malformed lines are skipped, or kept as ``_broken``."""
    if not keep_broken:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return spark.read.schema(f"{schema}, _broken string").option("columnNameOfCorruptRecord", "_broken").json(path)


def checkpoint(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A checkpoint that is one JSON array or JSON lines; the last row of an index wins.

    The form is told from the first character of the file. Rows of an array that have no index of
    their own take their place in it; lines without one are left out.
    """
    head = spark.read.text(path, wholetext=False).limit(1).collect()
    array = bool(head) and head[0]["value"].lstrip().startswith("[")
    names = [c.name for c in spark.createDataFrame([], schema).schema]
    own = [F.col(f"x.{c}").alias(c) for c in names if c != "index"]
    if array:
        whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"array<struct<{_fields(schema)}>>").alias("xs"))
        each = whole.select(F.posexplode("xs").alias("_at", "x")).select("_at", F.coalesce(F.col("x.index"), F.col("_at")).alias("index"), *own)
    else:
        # the line with its place in the file, so that "last" has a meaning
        lines = spark.read.text(path).withColumn("_at", F.monotonically_increasing_id())
        each = lines.select("_at", F.from_json("value", schema).alias("x")).where("x.index IS NOT NULL").select("_at", F.col("x.index").alias("index"), *own)
    rest = [c for c in names if c != "index"]
    last = each.groupBy("index").agg(F.max_by(F.struct(*rest), "_at").alias("x"))
    return last.select(*[F.col("index") if c == "index" else F.col(f"x.{c}").alias(c) for c in names])

"""Queries of problems 6, 8 and 9: cutting, packing and mixing texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.llm import chunking, mixing, packing
from lorewright.session import table


def _limits(spark, sf) -> dict[str, int]:
    """The settings of job_limits, a fixed table of three rows."""
    return {r["setting"]: r["amount"] for r in table(spark, sf, "job_limits").collect()}


def _chunks(spark, sf):
    s = _limits(spark, sf)
    return chunking.chunk(
        table(spark, sf, "papers"), "identifier", "full_text", s["chunk_chars"], s["chunk_overlap"]
    ), s["chunk_chars"]


def p6_found(spark, sf):
    """Papers cut, by kind: forced if a piece had to end inside a word, and that for the length of a stretch and not for the overlap."""
    pieces, limit = _chunks(spark, sf)
    return (
        pieces.groupBy("identifier")
        .agg((F.min("strength") == 0).alias("inside"), F.max("longest_run").alias("run"))
        .select("identifier", F.when(F.col("inside") & (F.col("run") > limit), "forced").otherwise("natural").alias("kind"))
    )


def p6_chunks(spark, sf):
    return _chunks(spark, sf)[0]


def _packed(spark, sf):
    return packing.pack(
        table(spark, sf, "documents"), "doc_id", "text", _limits(spark, sf)["container_tokens"]
    )


def p8_found(spark, sf):
    """Documents whose pieces lie in several containers."""
    placed = _packed(spark, sf).where("pieces > 1").groupBy("doc_id").agg(F.min("container").alias("low"), F.max("container").alias("high"))
    return placed.where("low < high").select("doc_id")


def p8_packed(spark, sf):
    return _packed(spark, sf)


def p8_containers(spark, sf):
    return packing.containers(_packed(spark, sf), "doc_id", _limits(spark, sf)["container_tokens"])


def _mixed(spark, sf):
    targets = table(spark, sf, "mix_targets")
    sizes = mixing.source_sizes(table(spark, sf, "documents"), targets)
    plan = mixing.expectations(sizes, targets)
    return plan, mixing.draws(sizes, plan)


def p9_report(spark, sf):
    return mixing.report(*_mixed(spark, sf))


def p9_found(spark, sf):
    """Sources of which every document was drawn as often as allowed and whose tokens drawn fall short of the target."""
    return p9_report(spark, sf).where("short").select("source")


def p9_mix(spark, sf):
    return mixing.copies(_mixed(spark, sf)[1])


QUERIES = {
    "p6_found": p6_found, "p6_chunks": p6_chunks, "p8_found": p8_found, "p8_packed": p8_packed,
    "p8_containers": p8_containers, "p9_found": p9_found, "p9_report": p9_report, "p9_mix": p9_mix,
}
SQL = {
    "p6_found": """
WITH t AS (SELECT identifier, regexp_replace(full_text, '^\\s+|\\s+$', '', 'g') AS x FROM papers)
SELECT identifier,
       CASE WHEN list_max(list_transform(regexp_split_to_array(x, '\\s+'), lambda w: length(w))) > 12000
            THEN 'forced' ELSE 'natural' END AS kind
FROM t WHERE length(x) > 12000""",
}

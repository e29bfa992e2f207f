"""Queries over ontology_nodes and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.operators import hierarchy as H
from lorewright.session import table


def _resolved(spark, sf):
    return H.resolve_hierarchy(table(spark, sf, "ontology_nodes"))


def p1_found(spark, sf):
    return H.defects(table(spark, sf, "ontology_nodes"))


def p1_paths(spark, sf):
    return _resolved(spark, sf).select(
        "ontology_id", "name", "kind", "root", F.coalesce(F.col("depth").cast("int"), F.lit(-1)).alias("depth"),
        F.array_join("path", " > ").alias("path"),
    )


def p1_descendants(spark, sf):
    return H.descendants(_resolved(spark, sf)).withColumn("distance", F.col("distance").cast("int"))


_FOLD = "lower(trim(regexp_replace({}, '[\\s ]+', ' ', 'g')))"
_BASE = f"""
WITH RECURSIVE raw AS (
  SELECT ontology_id, name, {_FOLD.format("name")} AS k, nullif({_FOLD.format("parent")}, '') AS pk, children
  FROM ontology_nodes),
own AS (SELECT ontology_id, k, min(name) AS name, min(pk) AS pk FROM raw GROUP BY 1, 2),
listed AS (
  SELECT ontology_id, {_FOLD.format("c")} AS k, min(lister) AS lister
  FROM (SELECT ontology_id, k AS lister, unnest(children) AS c FROM raw) GROUP BY 1, 2),
link AS (
  SELECT o.ontology_id, o.k, o.name, CASE WHEN o.pk IS NULL THEN l.lister ELSE q.k END AS p,
         o.pk IS NOT NULL AND q.k IS NULL AS orphan
  FROM own o LEFT JOIN listed l ON l.ontology_id = o.ontology_id AND l.k = o.k
  LEFT JOIN own q ON q.ontology_id = o.ontology_id AND q.k = o.pk),
walk AS (
  SELECT ontology_id, k, name, orphan, name AS root, 0 AS depth, [name] AS names FROM link WHERE p IS NULL
  UNION ALL
  SELECT l.ontology_id, l.k, l.name, l.orphan, w.root, w.depth + 1, list_append(w.names, l.name)
  FROM walk w JOIN link l ON l.ontology_id = w.ontology_id AND l.p = w.k),
loose AS (SELECT * FROM link l WHERE NOT EXISTS
  (SELECT 1 FROM walk w WHERE w.ontology_id = l.ontology_id AND w.k = l.k)),
climb AS (
  SELECT ontology_id, k AS start, p AS here FROM loose
  UNION
  SELECT c.ontology_id, c.start, l.p FROM climb c JOIN loose l ON l.ontology_id = c.ontology_id AND l.k = c.here),
kinds AS (
  SELECT ontology_id, name, CASE WHEN orphan THEN 'orphan' ELSE 'node' END AS kind, root, depth, names FROM walk
  UNION ALL
  SELECT l.ontology_id, l.name,
         CASE WHEN EXISTS (SELECT 1 FROM climb c WHERE c.ontology_id = l.ontology_id AND c.start = l.k AND c.here = l.k)
              THEN 'cycle' ELSE 'hanging' END, NULL, NULL, NULL FROM loose l)
"""

QUERIES = {"p1_found": p1_found, "p1_paths": p1_paths, "p1_descendants": p1_descendants}
SQL = {
    "p1_found": _BASE + "SELECT ontology_id, name, kind FROM kinds WHERE kind <> 'node'",
    "p1_paths": _BASE
    + "SELECT ontology_id, name, kind, root, coalesce(depth, -1) AS depth, array_to_string(names, ' > ') AS path FROM kinds",
    "p1_descendants": _BASE
    + """SELECT ontology_id, names[i] AS name, name AS descendant, depth + 1 - i AS distance
FROM (SELECT ontology_id, name, depth, names, CAST(unnest(range(1, depth + 1)) AS INTEGER) AS i FROM kinds WHERE depth > 0)""",
}

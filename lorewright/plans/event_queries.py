"""Batch forms of the streaming aggregations over the events table, the registry fold, and text windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lorewright.operators import registry as RG
from lorewright.session import table
from lorewright.streaming import events as EV

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


@query("str_hourly", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def str_hourly(spark, sf):
    return table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("start"), "event_type").agg(
        F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("total")
    )


@query(
    "str_sessions",
    """WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS n FROM e)
SELECT user_id, min(ts) AS start, count(*) AS events FROM s GROUP BY user_id, n""",
)
def str_sessions(spark, sf):
    return table(spark, sf, "events").groupBy(F.session_window("ts", "30 minutes").alias("s"), "user_id").agg(F.count("*").alias("events")).select(
        "user_id", F.col("s.start").alias("start"), "events"
    )


@query("str_first_events", "SELECT event_id, min(ts) AS ts FROM events GROUP BY 1")
def str_first_events(spark, sf):
    return table(spark, sf, "events").groupBy("event_id").agg(F.min("ts").alias("ts"))


@query(
    "inc_shard_status",
    "SELECT user_id, arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY 1",
)
def inc_shard_status(spark, sf):
    """The last status of each shard, events standing in for status changes."""
    return table(spark, sf, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"))


def _stream(spark, sf):
    """The events table as a stream of its files."""
    kinds = table(spark, sf, "events").schema
    # a pattern, as a stream takes a file by name only so
    rows = spark.readStream.schema(kinds).parquet(f"{sf}/event[s].parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query("str_stream_hourly", SQL["str_hourly"])
def str_stream_hourly(spark, sf):
    """Windows of a real stream, run over all that is there."""
    got = EV.drained(EV.hourly(_stream(spark, sf)))
    return got.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "events", F.round("total", 4).alias("total"))


@query("str_stream_sessions", SQL["str_sessions"])
def str_stream_sessions(spark, sf):
    got = EV.drained(EV.sessions(_stream(spark, sf)))
    return got.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "events")


@query("str_stream_first", "SELECT DISTINCT event_id FROM events")
def str_stream_first(spark, sf):
    """Each event once, as it comes."""
    return EV.drained(EV.first_events(_stream(spark, sf)), "append").select("event_id")


@query("str_stream_totals", "SELECT event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY 1")
def str_stream_totals(spark, sf):
    """Running totals of custom state; the last row of each type."""
    got = EV.drained(EV.running_totals(_stream(spark, sf)), "update")
    last = got.groupBy("event_type").agg(F.max_by(F.struct("events", "total"), "batch").alias("x"))
    return last.select("event_type", "x.events", F.round("x.total", 2).alias("total"))


@query("agg_registry_fold")
def agg_registry_fold(spark, sf):
    """Names of the mentions folded into a registry in order of appearance."""
    return RG.build_registry(table(spark, sf, "theory_mentions").select("label", F.col("mention_id").alias("ordinal")))


@query("fn_text_windows")
def fn_text_windows(spark, sf):
    return RG.text_windows(table(spark, sf, "papers"), "identifier", "full_text")


@query("fn_sequence_ratio")
def fn_sequence_ratio(spark, sf):
    """Similarity of each theory's label to its aliases."""
    a = table(spark, sf, "aging_ontology").select("theory_id", "label", F.explode("aliases").alias("alias"))
    return RG.similarity(a, "label", "alias")


# a star schema as papers, authors and places: the same operators on plain relational tables


@query(
    "rel_nation_revenue",
    """SELECT n_name, r_name, count(*) AS orders, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2""",
)
def rel_nation_revenue(spark, sf):
    t = lambda n: table(spark, sf, n)
    j = t("lineitem").join(t("orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(t("customer"), F.col("c_custkey") == F.col("o_custkey"))
    by = j.groupBy("c_nationkey").agg(F.count("*").alias("orders"), F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    return by.join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(t("region"), F.col("r_regionkey") == F.col("n_regionkey")).select(
        "n_name", "r_name", "orders", F.round("revenue", 2).alias("revenue")
    )


@query(
    "rel_part_rank",
    """SELECT p_brand, p_partkey, rank FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY qty DESC, p_partkey) AS rank FROM
(SELECT p_brand, p_partkey, sum(l_quantity) AS qty FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2)) WHERE rank <= 3""",
)
def rel_part_rank(spark, sf):
    """Three parts per brand: a top-k report."""
    from pyspark.sql import Window

    q = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("qty"))
    j = table(spark, sf, "part").join(q, F.col("l_partkey") == F.col("p_partkey"))
    w = Window.partitionBy("p_brand").orderBy(F.desc("qty"), "p_partkey")
    return j.withColumn("rank", F.row_number().over(w)).where("rank <= 3").select("p_brand", "p_partkey", "rank")


@query("rel_supplier_anti", "SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49)")
def rel_supplier_anti(spark, sf):
    bad = table(spark, sf, "lineitem").where("l_returnflag = 'R' AND l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"))
    return table(spark, sf, "supplier").join(bad, "s_suppkey", "left_anti").select("s_suppkey")


@query("rel_embedding_norms", "SELECT label, count(*) AS n, round(avg(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 4) AS norm2 FROM embeddings GROUP BY 1")
def rel_embedding_norms(spark, sf):
    sq = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return table(spark, sf, "embeddings").groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg(sq), 4).alias("norm2"))

"""Metric queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomchain.operators import metric_queries as Q
from loomchain.plans.registry import SAMPLES, query, with_
from loomchain.sources import landed as L


def _histogram(keys: str, bounds: tuple[float, ...]) -> str:
    k = f"{keys}, " if keys else ""
    values = ", ".join(f"{v!r}::DOUBLE" for v in bounds)
    return f"bounds AS (SELECT unnest([{values}, 'inf'::DOUBLE]) AS le),\nhist AS (SELECT {k}le, count(*) FILTER (WHERE seconds <= le) AS c, count(*) AS n FROM samples, bounds GROUP BY {k}le)"


def _quantile(keys: str, q: float) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    k = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f""", steps AS (SELECT *, coalesce(lag(le) OVER ({part}ORDER BY le), 0) AS lo, coalesce(lag(c) OVER ({part}ORDER BY le), 0) AS before FROM hist),
first AS (SELECT {k}arg_min(lo, le) AS lo, min(le) AS le, arg_min(before, le) AS before, arg_min(c, le) AS c, arg_min(n, le) AS n FROM steps WHERE c >= {q} * n {group})
SELECT {k}round(CASE WHEN isinf(le) OR c = before THEN lo ELSE lo + (le - lo) * ({q} * n - before) / (c - before) END, 6) AS value FROM first"""


@query(with_(SAMPLES) + "SELECT event_type, status, region, count(*) AS n, count(*) FILTER (WHERE status = 'error') AS errors, CAST(sum(CAST(round(seconds * 10000) AS BIGINT)) AS BIGINT) AS units FROM samples GROUP BY ALL")
def metric_counters(spark, d):
    s = L.samples(spark, d).withColumn("region", F.col("labels")["region"])
    return Q.counters(s, ["event_type", "status", "region"])


_BUCKETS_SQL = "SELECT {keys}, CASE WHEN isinf(le) THEN 'inf' ELSE CAST(CAST(round(le * 1000) AS BIGINT) AS VARCHAR) END AS le, c, n FROM hist"


def _buckets(spark, d: str, keys: list[str], bounds: tuple[float, ...]):
    h = Q.cumulative_histogram(L.samples(spark, d).withColumn("region", F.col("labels")["region"]), keys, "seconds", bounds)
    return h.select(*keys, F.when(F.col("le") == Q.INFINITE, "inf").otherwise(F.round(F.col("le") * 1000).cast("bigint").cast("string")).alias("le"), "c", "n")


@query(with_(SAMPLES, _histogram("event_type", Q.BOUNDS)) + _BUCKETS_SQL.format(keys="event_type"))
def metric_histogram(spark, d):
    return _buckets(spark, d, ["event_type"], Q.BOUNDS)


@query(with_(SAMPLES, _histogram("event_type, region", Q.LONG_BOUNDS)) + _BUCKETS_SQL.format(keys="event_type, region"))
def metric_histogram_long(spark, d):
    """With the further bound that long operations have."""
    return _buckets(spark, d, ["event_type", "region"], Q.LONG_BOUNDS)


_CHANGES = "changes AS (SELECT event_id % 7 AS worker, CAST(floor(epoch(ts)) AS BIGINT) AS at_s, event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS delta FROM events)"


@query(with_(_CHANGES) + "SELECT worker, seq, CAST(sum(delta) OVER (PARTITION BY worker ORDER BY at_s, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS in_flight FROM changes")
def in_flight(spark, d):
    changes = L.samples(spark, d).select((F.col("event_id") % 7).alias("worker"), "at", F.col("event_id").alias("seq"), F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1).alias("delta"))
    return Q.in_flight(changes, ["worker"]).select("worker", "seq", "in_flight")


@query(with_(SAMPLES) + "SELECT region, arg_max(event_id, (at_s, event_id)) FILTER (WHERE event_type = 'view') - arg_max(event_id, (at_s, event_id)) FILTER (WHERE event_type = 'error') AS backlog FROM samples GROUP BY 1")
def m_backlog(spark, d):
    """The newest value of one gauge less that of another, per region."""
    newest = lambda kind: F.max_by(F.when(F.col("event_type") == kind, F.col("event_id")), F.when(F.col("event_type") == kind, F.struct("at", "event_id")))
    s = L.samples(spark, d).withColumn("region", F.col("labels")["region"])
    return s.groupBy("region").agg((newest("view") - newest("error")).alias("backlog"))


_COUNTER = """counter AS (SELECT event_type, ts, event_id, count(*) OVER (PARTITION BY event_type, event_id // 1000 ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS v FROM events),
inc AS (SELECT *, lag(v) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before FROM counter), increases AS (SELECT event_type, ts, CASE WHEN before IS NULL THEN 0 WHEN v >= before THEN v - before ELSE v END AS increase FROM inc)"""


@query(with_(_COUNTER) + """SELECT start, event_type, CAST(sum(increase) AS BIGINT) AS increase, round(sum(increase) / 300.0, 6) AS rate FROM (
  SELECT event_type, increase, CAST(floor(epoch(ts) / 60) AS BIGINT) * 60 - 60 * k AS start FROM increases, (SELECT unnest(range(0, 5)) AS k)) GROUP BY ALL""")
def m_rate(spark, d):
    """Rate over five minutes, every minute, of a counter that restarts with every thousandth event."""
    s = L.samples(spark, d)
    counter = s.withColumn("v", F.count("*").over(Window.partitionBy("event_type", F.floor(F.col("event_id") / 1000)).orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)))
    return Q.rate(Q.increases(counter, ["event_type"], ["ts", "event_id"]), ["event_type"], "5 minutes", "1 minute", 300)


@query(with_(SAMPLES) + "SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS start, count(*) FILTER (WHERE status = 'error') AS part, count(*) AS n, round(count(*) FILTER (WHERE status = 'error') / count(*), 6) AS ratio FROM samples GROUP BY 1")
def m_error_ratio(spark, d):
    return Q.ratio(L.samples(spark, d), "1 hour", F.col("status") == "error", [])


@query(with_(SAMPLES) + """, w AS (SELECT event_type, status, CAST(floor(epoch(ts) / 900) AS BIGINT) * 900 - 900 * k AS start FROM samples, (SELECT unnest(range(0, 8)) AS k))
SELECT start, event_type, count(*) FILTER (WHERE status = 'error') AS part, count(*) AS n, round(count(*) FILTER (WHERE status = 'error') / count(*), 6) AS ratio FROM w GROUP BY ALL""")
def m_sliding_ratio(spark, d):
    """Share of errors over two hours, every quarter of an hour, for each type."""
    return Q.ratio(L.samples(spark, d), "2 hours", F.col("status") == "error", ["event_type"], "15 minutes")


@query(with_(SAMPLES, _histogram("", Q.BOUNDS)) + _quantile("", 0.99))
def m_quantile(spark, d):
    s = L.samples(spark, d).withColumn("everything", F.lit(1))
    return Q.quantile(Q.cumulative_histogram(s, ["everything"], "seconds", Q.BOUNDS), ["everything"], 0.99).select("value")


@query(with_(SAMPLES, _histogram("event_type", Q.BOUNDS)) + _quantile("event_type", 0.95))
def m_quantile_by_type(spark, d):
    return Q.quantile(Q.cumulative_histogram(L.samples(spark, d), ["event_type"], "seconds", Q.BOUNDS), ["event_type"], 0.95)


@query(with_(SAMPLES) + "SELECT start, logs, calls, round(logs / calls, 6) AS logs_per_call FROM (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS start, count(*) FILTER (WHERE event_type = 'view') AS logs, count(*) FILTER (WHERE event_type = 'purchase') AS calls FROM samples GROUP BY 1) WHERE calls > 0")
def m_logs_per_call(spark, d):
    by_hour = L.samples(spark, d).groupBy(F.window("ts", "1 hour")).agg(F.count_if(F.col("event_type") == "view").alias("logs"), F.count_if(F.col("event_type") == "purchase").alias("calls"))
    return by_hour.where("calls > 0").select(F.unix_timestamp("window.start").alias("start"), "logs", "calls", F.round(F.col("logs") / F.col("calls"), 6).alias("logs_per_call"))


@query(with_(SAMPLES) + "SELECT region, job, count(*) AS n, CAST(sum(CAST(round(seconds * 10000) AS BIGINT)) AS BIGINT) AS units FROM samples GROUP BY ALL")
def m_sum_by_label(spark, d):
    s = L.samples(spark, d)
    return s.groupBy(F.col("labels")["region"].alias("region"), F.col("labels")["job"].alias("job")).agg(F.count("*").alias("n"), F.sum(F.round(F.col("seconds") * 10000).cast("bigint")).alias("units"))


@query(with_(SAMPLES) + "SELECT 'cloud=c1,job=' || job || ',region=' || region || ',type=' || event_type AS labels, count(*) AS n FROM samples GROUP BY 1")
def m_const_labels(spark, d):
    """Constant labels on every sample: an empty one is left out, and one that a sample has itself doesn't replace it."""
    labels = Q.constant_labels(F.col("labels"), {"cloud": "c1", "environment": "", "region": "other"})
    text = F.array_join(F.array_sort(F.transform(F.map_entries(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return L.samples(spark, d).groupBy(text.alias("labels")).agg(F.count("*").alias("n"))

"""Digest trees and panes against plain versions."""

import random

from pyspark.sql import functions as F

from loomchain.operators import metric_queries as Q
from loomchain.operators import relations as R

FIELDS = ["a", "b"]
DDL = "k long, a string, b string"


def test_only_ranges_that_differ_are_joined(spark):
    rows = [(i, f"a{i}", None if i % 3 else "b") for i in range(20_000)]
    stored = {i: r for i, *r in rows}
    stored[5] = ["a5", "a5"]
    stored[6000] = [None, "a6000"]  # the same values in other places
    del stored[19_999]
    stored[70_000] = ["x", "y"]
    e, s = spark.createDataFrame(rows, DDL), spark.createDataFrame([(k, *r) for k, r in stored.items()], DDL)
    digests = R.range_digests(e, "k", FIELDS, 64), R.range_digests(s, "k", FIELDS, 64)
    assert sorted(r.range for r in R.differing_ranges(*digests).collect()) == [5 // 64, 6000 // 64, 19_999 // 64, 70_000 // 64]
    found = R.reconcile_ranges(e, s, "k", FIELDS, digests, 64)
    assert sorted(map(tuple, found.collect())) == [(5, "mismatch", "b"), (6000, "mismatch", "a,b"), (19_999, "missing", ""), (70_000, "extra", "")]
    assert sorted(map(tuple, R.reconcile_ranges(e, s, "k", FIELDS).collect())) == sorted(map(tuple, R.reconcile(e, s, "k", FIELDS).where("status <> 'ok'").collect()))
    assert R.reconcile_ranges(e, e, "k", FIELDS).count() == 0 and R.reconcile_ranges(e.where("false"), e.where("k < 3"), "k", FIELDS).count() == 3


def test_digests_add_up(spark):
    """Digests of two batches are those of both together, whatever the order; a row that stands twice is not a row that is absent."""
    rows = spark.createDataFrame([(i, f"a{i}", "b") for i in range(500)], DDL)
    parts = [R.range_digests(rows.where(f"k % 2 = {i}"), "k", FIELDS, 64) for i in (0, 1)]
    both = parts[0].unionAll(parts[1]).groupBy("range").agg(*(F.sum(c).alias(c) for c in ("n", "h1", "h2")))
    assert R.differing_ranges(R.range_digests(rows.orderBy(F.desc("k")), "k", FIELDS, 64), both).count() == 0
    twice = rows.unionAll(rows.where("k IN (3, 4)")).unionAll(rows.where("k = 3"))
    assert [r.range for r in R.differing_ranges(R.range_digests(rows, "k", FIELDS, 64), R.range_digests(twice, "k", FIELDS, 64)).collect()] == [0]


def test_panes_are_windows(spark):
    r = random.Random(2)
    rows = [(r.randint(-5000, 9000), r.choice("ab"), r.randint(0, 9)) for _ in range(3000)]
    samples = spark.createDataFrame(rows, "at long, k string, increase long").withColumn("ts", F.timestamp_seconds("at"))
    for window, slide in (("5 minutes", "1 minute"), ("7 minutes", "3 minutes"), ("1 hour", "1 hour"), ("2 minutes", "5 minutes")):
        long, step = Q._seconds(window), Q._seconds(slide)
        want = {}
        for at, k, n in rows:
            start = at // step * step
            while start > at - long:
                want[start, k] = want.get((start, k), 0) + n
                start -= step
        got = {(x.start, x.k): x.n for x in Q.windowed(samples, ["k"], window, slide, {"n": F.sum("increase")}).collect()}
        assert got == want
    late = samples.unionByName(samples.limit(1).withColumn("ts", F.lit(None).cast("timestamp")))
    assert Q.rate(late, ["k"], "5 minutes", "1 minute", 300).count() == Q.rate(samples, ["k"], "5 minutes", "1 minute", 300).count()


def test_samples_move_once(spark):
    samples = spark.range(100_000).select(F.timestamp_seconds(F.col("id") % 600).alias("ts"), F.lit("k").alias("k"), F.lit(1).alias("increase"))
    plan = Q.rate(samples, ["k"], "5 minutes", "1 minute", 300)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and plan.count("Generate") == 1 and plan.index("Generate") < plan.rindex("Aggregate")

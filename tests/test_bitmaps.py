"""Sets of positions as bitmaps against Python sets."""

import random

import pytest
from pyspark.sql import functions as F

from loomchain.operators import bitmaps as B
from loomchain.operators import ranges as G

DDL = "chain string, h long"


def made(seed, top):
    r = random.Random(seed)
    rows = [(c, r.randint(-20, top)) for c in "abc" for _ in range(top // 2)]
    rows += [("full", h) for h in range(top + 5)] + [("late", top)] * 3 + [("a", None)]
    bounds = [(c, r.randint(-10, 20), top - r.randint(0, 9)) for c in ("a", "b", "c", "late", "none")] + [("full", 0, top), ("empty", 5, 4)]
    return rows, bounds


@pytest.mark.parametrize("size, top", [(8, 90), (64, 300), (B.SIZE, 300)])
def test_against_sets(spark, size, top):
    rows, bounds = made(size, top)
    positions, b = spark.createDataFrame(rows, DDL), spark.createDataFrame(bounds, "chain string, lowest long, highest long")
    have = {}
    for c, h in rows:
        have.setdefault(c, set()).add(h)
    lacks = sorted((c, h) for c, lo, hi in bounds for h in range(lo, hi + 1) if h not in have.get(c, ()))
    taken = B.bitmaps(positions, size)
    pairs = lambda df: sorted(map(tuple, df.collect()))
    assert pairs(B.missing(b, taken, size)) == lacks
    assert pairs(B.members(taken, size)) == sorted({(c, h) for c, h in rows if h is not None})
    assert {(r.chain, r.bucket): r.n for r in taken.collect()} == count(have, size)
    odd = positions.where("h % 2 <> 0 OR h IS NULL")
    assert pairs(B.members(B.united(B.bitmaps(odd, size), B.bitmaps(positions.where("h % 3 = 0"), size)), size)) == sorted({(c, h) for c, h in rows if h is not None and (h % 2 or h % 3 == 0)})
    runs, want = pairs(G.gap_ranges(positions, b, size)), []
    for c, h in lacks:
        if want and want[-1][0] == c and want[-1][2] == h - 1:
            want[-1][2] = h
        else:
            want.append([c, h, h])
    assert runs == sorted(map(tuple, want))
    marks = {}
    for c, lo, _ in bounds:
        marks[c] = lo
        while marks[c] in have.get(c, ()):
            marks[c] += 1
    assert {r.chain: r.watermark for r in G.contiguous_watermark(positions, b, size).collect()} == marks
    snap = {r.chain: (r.lowest, r.pending) for r in G.window_snapshot(positions, b, size).collect()}
    assert snap == {c: (m, sum(h is not None and h >= m for h in have.get(c, ()))) for c, m in marks.items()}
    # The lowest n of each chain, none of which starves another one.
    plan = G.backfill_plan(b, positions, 7, 3, size).collect()
    first = {}
    for c, h in lacks:
        first.setdefault(c, []).append(h)
    assert sorted((r.chain, r.h, r.chunk) for r in plan) == sorted((c, h, i // 3) for c, hs in first.items() for i, h in enumerate(hs[:7]))


def count(have, size):
    out = {}
    for c, hs in have.items():
        for h in hs:
            if h is not None:
                out[c, h // size] = out.get((c, h // size), 0) + 1
    return out


def test_large_positions(spark):
    top = (1 << 62) + 7
    positions = spark.createDataFrame([("a", top), ("a", top + 2), ("a", -top)], DDL)
    assert sorted(r.h for r in B.members(B.bitmaps(positions)).collect()) == [-top, top, top + 2]
    b = spark.createDataFrame([("a", top, top + 3)], "chain string, lowest long, highest long")
    assert sorted(r.h for r in B.missing(b, B.bitmaps(positions)).collect()) == [top + 1, top + 3]


def shuffled(spark, df):
    """Bytes that a query's exchanges wrote."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        elif "QueryStage" in p.nodeName():
            todo.append(p.plan())
        else:
            if p.nodeName() == "Exchange":
                total += p.metrics().get("shuffleBytesWritten").get().value()
            children = p.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_bitmaps_shuffle_little(spark):
    positions = spark.range(0, 600_000, 1, 4).select(F.lit("a").alias("chain"), F.col("id").alias("h")).where("h % 10 <> 3")
    bounds = spark.createDataFrame([("a", 0, 599_999)], "chain string, lowest long, highest long")
    new = G.missing_heights(bounds, positions, positions.where("false"))
    old = G.heights(bounds).join(positions, ["chain", "h"], "left_anti")
    assert new.count() == old.count() == 60_000
    # As where neither side is small enough to be sent.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        less, more = shuffled(spark, G.missing_heights(bounds, positions, positions.where("false"))), shuffled(spark, G.heights(bounds).join(positions, ["chain", "h"], "left_anti"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert less * 10 < more

import json
import random

import pytest
from pyspark.sql import functions as F

from loomchain.operators import ranges as G
from loomchain.operators import relations as R
from loomchain.streaming.positions import add_positions


def marks(spark, chains, size):
    bounds = spark.createDataFrame([(c, lo, hi) for c, lo, hi, _ in chains], "chain string, lowest long, highest long")
    done = spark.createDataFrame([(c, h) for c, _, _, hs in chains for h in hs], "chain string, h long")
    got = {r.chain: r.watermark for r in G.contiguous_watermark(done, bounds, size).collect()}
    gaps = sorted((r.chain, r.first, r.last) for r in G.gap_ranges(done, bounds, size).collect())
    return got, gaps


@pytest.mark.parametrize("size", [1, 3, 100])
def test_watermarks_and_gaps(spark, size):
    r = random.Random(size)
    chains = [("a", 5, 10, [5, 6, 7]), ("b", 5, 10, [5, 7]), ("c", 5, 5, [5]), ("d", 5, 10, [4, 7])]
    chains += [(f"r{i}", 3, 40, [h for h in range(60) if r.random() < 0.9]) for i in range(5)]
    got, gaps = marks(spark, chains, size)
    for c, lo, hi, hs in chains:
        at = lo
        while at in hs:
            at += 1
        assert got[c] == at
        missing = [h for h in range(lo, hi + 1) if h not in hs]
        assert [h for k, a, b in gaps if k == c for h in range(a, b + 1)] == missing


def test_offset_commit(spark):
    offsets = spark.createDataFrame([(0, o) for o in (20, 3, 1, 0, 2)] + [(1, o) for o in (3, 4, 5)] + [(2, o) for o in (6, 6, 7)], "partition int, offset long")
    initial = spark.createDataFrame([(0, 0), (1, 0), (2, 5)], "partition int, committed long")
    got = {r.partition: (r.committed, r.pending) for r in G.offset_commit(offsets, initial, 2).collect()}
    assert got == {0: (3, 1), 1: (0, 3), 2: (7, 0)}


def test_state_of_positions():
    low, ranges, ignored = add_positions(0, [], [5, 6, 9])
    assert (low, ranges, ignored) == (0, [(5, 6), (9, 9)], 0)
    low, ranges, ignored = add_positions(low, ranges, [0, 1, 2, 3, 4, 6, 6, -1])
    assert (low, ranges, ignored) == (7, [(9, 9)], 3)


def test_ranges_in_state_against_sets():
    r = random.Random(3)
    for _ in range(200):
        low, ranges, have, at = 0, [], set(), 0
        for _ in range(4):
            new = [r.randint(-3, 40) for _ in range(r.randint(0, 12))]
            fresh = {h for h in new if h >= at} - have
            have |= fresh
            low, ranges, ignored = add_positions(low, ranges, new)
            while at in have:
                at += 1
            assert (low, ignored) == (at, len(new) - len(fresh))
            assert [h for a, b in ranges for h in range(a, b + 1)] == sorted(h for h in have if h >= at)


def test_numbers_by_buckets(spark):
    rows = [(k, (i * 37) % 101) for k in "ab" for i in range(101)]
    df = spark.createDataFrame(rows, "k string, at long")
    for size in (1, 7, 1000):
        assert all(r.n == r["at"] for r in G.numbered(df, ["k"], F.floor(F.col("at") / size), ["at"], "n").collect())


def test_gap_report(spark):
    rows = spark.createDataFrame([("a", 5, 20), ("b", 11, 10), ("c", 15, 10)], "chain string, lowest long, highest long")
    got = {r.chain: (r.gap, r.inconsistent, r.alert) for r in G.gap_report(rows, 5).collect()}
    assert got == {"a": (15, False, True), "b": (0, False, False), "c": (0, True, False)}


def test_latest_checkpoint_breaks_ties_by_position(spark):
    c = spark.createDataFrame([(1, 10, 100), (1, 12, 100), (1, 50, 99)], "chain_id long, lowest_unprocessed_block long, timestamp long")
    wanted = spark.createDataFrame([(1,), (2,)], "chain_id long")
    assert {r.chain_id: (r.lowest, r.exists) for r in R.latest_checkpoint(c, wanted).collect()} == {1: (12, True), 2: (0, False)}


def test_start_offsets(spark):
    log = spark.createDataFrame([(0, 10, 20), (1, 10, 20), (2, 10, 20)], "partition int, low long, high long")
    committed = spark.createDataFrame([(0, 15), (1, 5)], "partition int, committed long")
    for policy, other in (("earliest", 10), ("latest", 20), ("none", None)):
        got = {r.partition: (r.start, r.reset) for r in R.start_offsets(committed, log, policy).collect()}
        assert got == {0: (15, False), 1: (other, True), 2: (other, True)}
    starts = R.start_offsets(committed, log, "earliest")
    assert json.loads(R.starting_offsets_json(starts, "t")) == {"t": {"0": 15, "1": 10, "2": 10}}

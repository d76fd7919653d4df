"""Windows of positions in a stream: bitmaps by bucket, timers, NULLs, restarts."""

import random

import numpy as np
from pyspark.sql import functions as F

from loomchain.streaming import positions as P

DDL = "chain string, h long"
BIG = 1 << 53


class Counted(P.Bitmaps):
    def __init__(self):
        super().__init__()
        self.read, self.written = set(), set()

    def get(self, bucket):
        self.read.add(bucket)
        return super().get(bucket)

    def put(self, bucket, bits):
        self.written.add(bucket)
        super().put(bucket, bits)


def as_ranges(*pairs):
    return tuple(np.array(x, np.int64) for x in zip(*pairs))


def test_a_batch_touches_only_its_buckets():
    b, held = P.BUCKET, Counted()
    low, added = P.absorb(0, held, as_ranges((5, 9), (3 * b, 3 * b), (100 * b + 1, 100 * b + 7), (900 * b, 901 * b)))
    assert (low, added) == (0, 5 + 1 + 7 + b + 1)
    held.read, held.written = set(), set()
    assert P.absorb(low, held, as_ranges((100 * b + 7, 100 * b + 8))) == (0, 1)
    assert held.written == {100} and held.read == {0, 100}
    held.read, held.written = set(), set()
    low, added = P.absorb(0, held, as_ranges((0, 4), (10, 3 * b - 1)))
    assert low == 3 * b + 1 and added == 5 + 3 * b - 10 and held.written == {0, 1, 2} and sorted(held) == [100, 900, 901]


def test_bitmaps_against_sets(monkeypatch):
    monkeypatch.setattr(P, "BUCKET", 16)
    r = random.Random(9)
    for _ in range(200):
        lowest = at = r.randint(-40, 40)
        held, have = P.Bitmaps(), set()
        for _ in range(6):
            new = [r.randint(-50, 150) for _ in range(r.randint(0, 60))] + list(range(a := r.randint(-50, 150), a + r.choice([0, 40])))
            fresh = {h for h in new if h >= at} - have
            have |= fresh
            at, added = P.absorb(at, held, P.as_ranges(np.array(new, np.int64)))
            while lowest in have:
                lowest += 1
            assert (at, added) == (lowest, len(fresh)) and [h for a, z in held.ranges() for h in range(a, z + 1)] == sorted(h for h in have if h >= at)


def write(spark, at, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(at)


def stream(spark, at):
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(at)


def newest(rows):
    found = {}
    for n, r in rows:
        found[r.chain] = r
    return found


def collect(into):
    return lambda batch, n: into.extend((n, r) for r in batch.collect())


def test_nulls_and_large_heights(spark, tmp_path):
    at, seen = f"file://{tmp_path}/in", []
    write(spark, at, [("a", BIG + 1), ("a", None), ("a", BIG + 3), ("b", None), (None, 0), (None, 1), ("c", -5)])
    P.start(P.stream_watermark(stream(spark, at), BIG), f"file://{tmp_path}/out", collect(seen), "update").awaitTermination()
    got = newest(seen)
    assert (got["a"].lowest, got["a"].highest, got["a"].pending, got["a"].unread, got["a"].ignored) == (BIG, BIG + 3, 2, 1, 0)
    assert (got["b"].lowest, got["b"].highest, got["b"].unread) == (BIG, BIG - 1, 1) and got[None].ignored == 2 and got["c"].ignored == 1


def test_state_outlives_a_restart(spark, tmp_path):
    at, root, seen = f"file://{tmp_path}/in", f"file://{tmp_path}/out", []
    b = P.BUCKET
    write(spark, at, [("a", h) for h in (*range(1, 50), *range(2 * b, 2 * b + 10))])
    P.start(P.stream_watermark(stream(spark, at)), root, collect(seen), "update").awaitTermination()
    assert (newest(seen)["a"].lowest, newest(seen)["a"].pending) == (0, 59)
    write(spark, at, [("a", 0), ("a", 3), ("z", 0)])
    P.start(P.stream_watermark(stream(spark, at)), root, collect(seen), "update").awaitTermination()
    got = newest(seen)
    assert (got["a"].lowest, got["a"].highest, got["a"].pending, got["a"].ignored, got["z"].lowest) == (50, 2 * b + 9, 10, 1, 1)
    write(spark, at, [("a", h) for h in range(50, 2 * b)])
    P.start(P.stream_watermark(stream(spark, at)), root, collect(seen), "update").awaitTermination()
    assert (newest(seen)["a"].lowest, newest(seen)["a"].pending) == (2 * b + 10, 0)


def test_a_silent_stream_still_alerts(spark, tmp_path):
    at, root, seen = f"file://{tmp_path}/in", f"file://{tmp_path}/out", []
    write(spark, at, [("gap", 500), ("whole", 0), ("edge", 100)])
    query = P.start(P.stream_watermark(stream(spark, at), 0, 0.5, 100), root, collect(seen), "update", "100 milliseconds")
    fired = lambda: [(n, r) for n, r in seen if r.fired]
    P.until(query, lambda: len(fired()) >= 3, 60)
    query.stop()
    assert {(r.chain, r.lowest, r.highest) for _, r in fired()} == {("gap", 0, 500)}
    assert len({n for n, _ in fired()}) >= 3 and sum(not r.fired for _, r in seen) == 3
    # Timers outlive a restart, and a gap that closes is silent.
    before = len(fired())
    query = P.start(P.stream_watermark(stream(spark, at), 0, 0.5, 100), root, collect(seen), "update", "100 milliseconds")
    P.until(query, lambda: len(fired()) > before, 60)
    write(spark, at, [("gap", h) for h in range(500)])
    P.until(query, lambda: any(r.chain == "gap" and r.lowest == 501 for _, r in seen), 60)
    last, ends = len(fired()), len(query.recentProgress)
    P.until(query, lambda: len(query.recentProgress) > ends + 15 or len(query.recentProgress) >= 90, 60)
    query.stop()
    assert len(fired()) == last

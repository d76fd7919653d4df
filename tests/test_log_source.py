"""The log in files: appends, planning of offsets, pushed filters, streams with a limit that start again."""

import pytest
from pyspark.sql import functions as F

from loomchain.sources import log_source as LS
from loomchain.sources import message_log as M

DDL = "key string, value string"


def log(spark, at, n, **options):
    M.write_files(spark.range(n).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), "id").alias("value")), at, "t", **options)


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('log')}/log"
    for _ in range(2):
        log(spark, at, 5000, partitions=3, span=500)
    return at


def keys(df):
    return sorted((r.partition, r.offset, r.key) for r in df.collect())


def test_appends_go_on(spark, path):
    rows = M.read_files(spark, path).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r.partition, r.offset)):
        by.setdefault(r.partition, []).append(r)
    assert len(rows) == 10_000 and len(by) == 3
    for p, own in by.items():
        assert [r.offset for r in own] == list(range(len(own)))
        half = len(own) // 2
        assert [int(r.key) for r in own[:half]] == [int(r.key) for r in own[half:]] == sorted(int(r.key) for r in own[:half])
        assert all(r.value == f"v{r.key}" and r.topic == "t" and r.timestamp is not None for r in own)
    assert {r.partition: (r.low, r.high) for r in M.ends(spark, path).collect()} == {p: (0, len(own)) for p, own in by.items()}


def read_rows(shares):
    return sum(take for s in shares for *_, take in s.pieces)


def test_a_bounded_scan_opens_only_its_files(spark, path):
    bounds = spark.createDataFrame([(0, 100, 700), (2, 10, 11)], "partition int, low bigint, high bigint")
    want = [k for k in keys(M.read_files(spark, path)) if k[0] == 0 and 100 <= k[1] < 700 or k[0] == 2 and k[1] == 10]
    got = M.scan(path, bounds)
    assert sorted((r.partition, r.offset, r.key) for r in got.collect()) == want and {r.height for r in got.collect()} == {int(k) for *_, k in want}
    index = LS.Index(path).refresh()
    touched = [r for r in index.runs if r.partition == 0 and r.first < 700 and r.first + r.n > 100 or r.partition == 2 and r.first <= 10 < r.first + r.n]
    shares = LS.plan(index.runs, {0: 100, 1: 10**9, 2: 10}, {0: 700, 2: 11}, 1000)
    assert {piece[0] for s in shares for piece in s.pieces} == {r.file for r in touched} and len(touched) < len(index.runs) / 4 and read_rows(shares) == 601
    assert M.scan(path, bounds.where("false")).count() == 0


def test_shares_are_even(spark, path):
    shares = LS.LogReader({"path": path, "splitRows": "700"}, ["key"]).partitions()
    assert [read_rows([s]) for s in shares] == [700] * 14 + [200]
    assert keys(M.read_files(spark, path, split_rows=700)) == keys(M.read_files(spark, path))


def test_columns_and_offsets_by_name(spark, path):
    df = M.read_files(spark, path, {0: 5}, {0: 9, 1: 2}, ["offset", "partition"])
    assert df.columns == ["partition", "offset"]
    high = {r.partition: r.high for r in M.ends(spark, path).collect()}
    assert sorted(map(tuple, df.collect())) == [(0, 5), (0, 6), (0, 7), (0, 8), (1, 0), (1, 1)] + [(2, o) for o in range(high[2])]
    assert M.read_files(spark, path, "latest").count() == 0 and M.read_files(spark, path, {0: 10**9, 1: 10**9, 2: 10**9}).count() == 0


def test_filters_are_pushed(spark, path):
    spark.conf.set(M._PUSHED, "true")
    try:
        df = M.read_files(spark, path).where("partition IN (1, 2) AND offset >= 20 AND offset < 25 AND key <> 'x'")
        want = [k for k in keys(M.read_files(spark, path)) if k[0] in (1, 2) and 20 <= k[1] < 25]
        assert keys(df) == want and len(want) == 10
        reader = LS.PushingReader({"path": path}, ["key", "partition", "offset"])
        taken = [LS.In(("partition",), (1, 2)), LS.GreaterThan(("offset",), 19), LS.LessThan(("offset",), 25)]
        left = LS.EqualTo(("key",), "x")
        assert list(reader.pushFilters([*taken, left])) == [left] and read_rows(reader.partitions()) == 10
    finally:
        spark.conf.unset(M._PUSHED)
    assert keys(M.read_files(spark, path).where("partition = 1 AND offset = 20")) == [k for k in keys(M.read_files(spark, path)) if k[:2] == (1, 20)]


def test_odd_messages(spark, tmp_path):
    at = f"file://{tmp_path}/log"
    rows = [(None, "a"), (None, "b"), ("x", None), ("x", None), ("7", "c"), ("-3", "d"), ("9" * 30, "e"), (None, None)]
    M.write_files(spark.createDataFrame(rows, DDL).withColumn("partition", F.lit(0)), at, "t")
    got = sorted(M.read_files(spark, at).collect(), key=lambda r: r.offset)
    assert [r.offset for r in got] == list(range(8)) and sorted(((r.key, r.value) for r in got), key=str) == sorted(rows, key=str)
    assert [r.key for r in got[:2]] == ["-3", "7"]
    M.write_files(spark.createDataFrame([], DDL), at, "t")
    assert M.read_files(spark, at).count() == 8


def test_files_of_one_range_keep_their_order(spark, tmp_path):
    at = f"file://{tmp_path}/log"
    log(spark, at, 1000, partitions=1, span=10_000, rows_per_file=90)
    assert [int(r.key) for r in sorted(M.read_files(spark, at).collect(), key=lambda r: r.offset)] == list(range(1000))
    assert len(LS.Index(at).refresh().runs) == 12


def test_no_log_is_empty_and_trouble_is_trouble(spark, tmp_path):
    at = f"file://{tmp_path}/log"
    assert M.ends(spark, at).count() == 0 and M.read_files(spark, at).count() == 0
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "index").write_text("no folder")
    with pytest.raises(Exception):
        M.ends(spark, at).count()


def test_of_two_appends_at_once_one_fails(spark, tmp_path, monkeypatch):
    at = f"file://{tmp_path}/log"
    log(spark, at, 100)
    monkeypatch.setattr(M, "_index", lambda *_: None)  # this one saw nothing of the other
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        log(spark, at, 100)
    monkeypatch.undo()
    assert M.read_files(spark, at).count() == 100


def test_admission():
    assert LS.admitted({0: 5}, {0: 10, 1: 4}, 0) == {0: 10, 1: 4}
    assert LS.admitted({}, {0: 10, 1: 10}, 7) in ({0: 4, 1: 3}, {0: 3, 1: 4})
    at, ends, steps = {0: 0, 1: 0, 2: 50}, {0: 1000, 1: 3, 2: 50}, 0
    while at != ends:
        now = LS.admitted(at, ends, 64)
        assert 0 < sum(now.values()) - sum(at.values()) <= 64 and all(at[p] <= now[p] <= ends[p] for p in ends)
        at, steps = now, steps + 1
    assert steps == 16


def run(stream, root, seen, rounds=None):
    def write(batch, n):
        seen.append((n, sorted((r.partition, r.offset) for r in batch.collect())))

    writer = stream.select("partition", "offset").writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/_stream")
    if rounds:
        for _ in range(rounds):
            writer.trigger(availableNow=True).start().awaitTermination()
    else:
        query = writer.trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()


def test_a_stream_keeps_its_limit_and_starts_again(spark, tmp_path):
    at, root, seen = f"file://{tmp_path}/log", f"file://{tmp_path}/stream", []
    log(spark, at, 1000, partitions=3, span=100)
    stream = lambda: M.stream_log(spark, at, {0: 10}, 300, f"{root}/_admitted")
    run(stream(), root, seen, 2)
    assert [len(rows) for _, rows in seen] == [300, 300]
    log(spark, at, 500, partitions=3, span=100)
    run(stream(), root, seen)
    everything = sorted((r.partition, r.offset) for r in M.read_files(spark, at).collect() if r.partition or r.offset >= 10)
    assert [n for n, _ in seen] == list(range(len(seen))) and all(len(rows) <= 300 for _, rows in seen)
    assert sorted(k for _, rows in seen for k in rows) == everything
    before = len(seen)
    run(stream(), root, seen)
    assert len(seen) == before


def test_a_batch_that_failed_runs_again_with_the_same_offsets(spark, tmp_path):
    at, root, seen = f"file://{tmp_path}/log", f"file://{tmp_path}/stream", []
    log(spark, at, 600, partitions=2, span=100)

    def fail(batch, n):
        if n == 1:
            raise RuntimeError("stopped")
        seen.append((n, sorted((r.partition, r.offset) for r in batch.collect())))

    stream = M.stream_log(spark, at, "earliest", 200, f"{root}/_admitted").select("partition", "offset")
    query = stream.writeStream.foreachBatch(fail).option("checkpointLocation", f"{root}/_stream").trigger(processingTime="0 seconds").start()
    with pytest.raises(Exception, match="stopped"):
        query.awaitTermination()
    run(M.stream_log(spark, at, "earliest", 200, f"{root}/_admitted"), root, seen)
    assert [(n, len(rows)) for n, rows in seen] == [(0, 200), (1, 200), (2, 200)]
    assert len({k for _, rows in seen for k in rows}) == 600

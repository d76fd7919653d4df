from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest

from loomchain.operators import decode as D
from loomchain.operators.relations import keep_latest
from loomchain.plans.streams import _land
from loomchain.sources import landed as L
from loomchain.sources import message_log as M
from loomchain.sources import schemas as S
from loomchain.sources import tables as T
from loomchain.streaming import ingest as I
from loomchain.streaming import positions as P


def test_ensure_append_delete_truncate(spark, sf, tmp_path):
    root = f"file://{tmp_path}"
    T.ensure_tables(spark, "chain_test", root)
    first = {n: spark.table(f"chain_test.{n}").schema for n in S.TABLES}
    T.ensure_tables(spark, "chain_test", root)
    assert {n: spark.table(f"chain_test.{n}").schema for n in S.TABLES} == first
    assert all(sorted(f.name for f in first[n]) == sorted(S.struct_of(ddl).names) for n, ddl in S.TABLES.items())
    good, _ = D.route(L.message_log(spark, sf))
    T.append(D.block_rows(good), "chain_test.blocks", "blocks")
    T.append(spark.createDataFrame([(0, 5, 1), (1, 6, 1), (None, 7, 1)], S.CHECKPOINTS), "chain_test.checkpoints", "checkpoints")
    blocks = spark.table("chain_test.blocks")
    assert blocks.count() == good.count() > 0
    chains = {r.blockchain_id: r["count"] for r in blocks.groupBy("blockchain_id").count().collect()}
    assert (tmp_path / "blocks" / "blockchain_id=chain-1").is_dir() or list(tmp_path.rglob("blockchain_id=chain-1"))
    T.delete_chain(spark, "chain_test", "chain-1", 1)
    T.delete_chain(spark, "chain_test", "no such 'chain'", 99)
    assert {r.blockchain_id: r["count"] for r in spark.table("chain_test.blocks").groupBy("blockchain_id").count().collect()} == {k: v for k, v in chains.items() if k != "chain-1"}
    assert sorted(r.lowest_unprocessed_block for r in spark.table("chain_test.checkpoints").collect()) == [5, 7]
    assert not list(tmp_path.rglob("blockchain_id=chain-1"))
    T.truncate(spark, "chain_test.blocks")
    assert spark.table("chain_test.blocks").count() == 0 and spark.table("chain_test.blocks").schema == first["blocks"]
    spark.sql("DROP DATABASE chain_test CASCADE")


def test_sorted_write(spark, sf, tmp_path):
    good, _ = D.route(L.message_log(spark, sf))
    T.write_sorted(D.block_rows(good).repartition(3), f"file://{tmp_path}/b", "blocks")
    files = list((tmp_path / "b").rglob("*.parquet"))
    assert files and {f.parent.name for f in files} == {f"blockchain_id=chain-{i}" for i in range(3)}
    for f in files:
        rows = pq.ParquetFile(f).read(columns=S.KEYS["blocks"][1:]).to_pylist()
        keys = [tuple(r[k] for k in S.KEYS["blocks"][1:]) for r in rows]
        assert keys == sorted(keys)
    one = T.read(spark, f"file://{tmp_path}/b", "blocks").where("blockchain_id = 'chain-1'")
    assert one.columns == S.struct_of(S.BLOCKS).names and len(one.inputFiles()) > 0
    assert "PartitionFilters: [isnotnull(blockchain_id" in one._jdf.queryExecution().toString()


def test_message_log_in_files(spark, tmp_path):
    at = f"file://{tmp_path}/log"
    some = spark.createDataFrame([(str(i), f"v{i}") for i in range(250)] + [("x", "no number"), ("7", None)], "key string, value string")
    M.write_files(some, at, "t", 3, 100)
    M.write_files(spark.createDataFrame([("300", "later")], "key string, value string"), at, "t", 3)
    rows = M.read_files(spark, at).collect()
    assert len(rows) == 253 and {r.topic for r in rows} == {"t"} and {r.partition for r in rows} == {0, 1, 2}
    for p in range(3):
        own = sorted((r.offset, r.key) for r in rows if r.partition == p)
        assert [o for o, _ in own] == list(range(len(own)))
        heights = [int(k) for _, k in own if k != "x"]
        assert heights == sorted(heights)


def test_retries_wait_longer_each_time(spark, tmp_path, monkeypatch):
    waited = []
    monkeypatch.setattr(P, "time", SimpleNamespace(sleep=waited.append))
    (tmp_path / "a file").write_text("not a folder")
    batch = spark.createDataFrame([("a", 5)], "chain string, lowest long")
    with pytest.raises(Exception):
        P.checkpoint_sink(f"file://{tmp_path}/a file/x", lambda n: n, 3, 0.5)(batch, 0)
    assert waited == [0.5, 1.0, 2.0]
    P.checkpoint_sink(f"file://{tmp_path}/rows", lambda n: n, 3)(batch, 1)
    assert spark.read.parquet(f"file://{tmp_path}/rows").first().lowest_unprocessed_block == 5 and len(waited) == 3


def test_stream_by_interval(spark, tmp_path):
    spark.createDataFrame([("0", "v", "t", 0, 0, None)], S.MESSAGES).write.parquet(f"file://{tmp_path}/in")
    seen = []
    q = P.start(M.stream_files(spark, f"file://{tmp_path}/in"), f"file://{tmp_path}/out", lambda batch, n: seen.append(batch.count()), interval="100 milliseconds")
    q.processAllAvailable()
    assert q.isActive and sum(seen) == 1
    q.stop()


def test_stream_restarts_where_it_stopped(spark, sf, tmp_path):
    messages = L.message_log(spark, sf)
    at = f"file://{tmp_path}/in"
    columns = [f.name for f in S.struct_of(S.MESSAGES)]
    messages.where("event_id < 500").select(*columns).write.parquet(at)
    root = f"file://{tmp_path}/out"
    I.start(M.stream_files(spark, at), root).awaitTermination()
    first = I.table(spark, root, "blocks").count()
    messages.where("event_id >= 500").select(*columns).write.mode("append").parquet(at)
    I.start(M.stream_files(spark, at), root).awaitTermination()
    good, dead = D.route(messages)
    assert 0 < first < good.count() == I.table(spark, root, "blocks").count()
    assert I.table(spark, root, "dead_letters").count() == dead.count()


def test_replays_collapse(spark, sf):
    good, _ = D.route(L.message_log(spark, sf).limit(200))
    rows = D.block_rows(good)
    assert keep_latest(rows.unionAll(rows), S.KEYS["blocks"], ["hash"]).count() == rows.count()


def test_fail_fast(spark, sf, tmp_path):
    stream = M.stream_files(spark, _land(L.message_log(spark, sf).limit(100), "fail_fast"))
    with pytest.raises(Exception, match="can't be processed"):
        I.start(stream, f"file://{tmp_path}/out", fail_fast=True).awaitTermination()


def test_connector_options():
    options = M.connector_options("b:9092", "blocks", '{"blocks":{"0":5}}', max_per_trigger=100)
    assert options["subscribe"] == "blocks" and options["startingOffsets"] == '{"blocks":{"0":5}}' and options["maxOffsetsPerTrigger"] == "100"
    assert "endingOffsets" not in options


def test_shared_folder_is_named_but_in_local_mode():
    assert T.shared_folder("hdfs://x/y/", "yarn", "a") == "hdfs://x/y"
    for master in ("yarn", "spark://h:7077", "k8s://h", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            T.shared_folder(None, master, "a")
    for master in ("local", "local[*]", "local[4]"):
        assert T.shared_folder(None, master, "a") == T.shared_folder(None, master, "a") != T.shared_folder(None, master, "b")

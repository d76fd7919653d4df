"""What is shuffled: landed rows move once, as they landed; texts and hashes are made behind the move, and bodies stay where they are."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomchain import catalog
from loomchain.operators import decode as D
from loomchain.plans import chain
from loomchain.sources import message_log as M
from loomchain.sources import tables as T


@pytest.fixture
def joins_by_shuffle(spark):
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "1000"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def moves(df) -> list[str]:
    """The part of the plan below each exchange, down to the next one."""
    found, open_ = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        at = len(line) - len(line.lstrip(" :+-*"))
        open_ = [(k, depth) for k, depth in open_ if at > depth]
        if line.lstrip(" :+-*").startswith("Exchange "):
            found.append("")
            open_ = [(len(found) - 1, at)]
        elif open_:
            found[open_[-1][0]] += line + "\n"
    return found


def test_assembling_moves_each_landed_row_once_and_no_hash(spark, sf, joins_by_shuffle):
    found = moves(chain.full_records(spark, sf))
    assert len(found) == 4  # orders, lines, events, and the lines that are withdrawals
    assert not any("sha2" in part or "base64" in part for part in found)


def test_logs_meet_their_transactions_by_block(spark):
    header = spark.createDataFrame([(n, f"c{n}") for n in (1, 2, 3)], "block_number bigint, blockchain_id string")
    tx = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "block_number bigint, transaction_index bigint, hash string")
    tx = tx.withColumns({"has_receipt": F.lit(True), "status": F.lit(1), "gas": F.lit(5)})
    logs = spark.createDataFrame([(1, 1, 7), (1, 1, 8), (1, None, 9), (2, 5, 9), (4, 0, 9)], "block_number bigint, tx_index bigint, index bigint")
    own = logs.groupBy("block_number", "tx_index").agg(F.array_sort(F.collect_list(F.struct("index"))).alias("logs"))
    rows = D.assemble_blocks(header, tx, own).select("block_number", "record.transactions").collect()
    got = {r["block_number"]: [(t["hash"], [g["index"] for g in t["receipt"]["logs"]]) for t in r["transactions"]] for r in rows}
    assert got == {1: [("a", []), ("b", [7, 8])], 2: [("c", [])], 3: []}


def test_bodies_that_stay_are_numbered_without_gaps(spark, tmp_path):
    at = f"file://{tmp_path}/log"
    sent = spark.range(0, 1000, 1, 5).select(F.when(F.col("id") % 100 != 7, F.col("id").cast("string")).alias("key"), F.concat(F.lit("v"), "id").alias("value"))
    for _ in range(2):
        M.write_files(sent, at, "blocks", moved=False)
    rows = M.read_files(spark, at).collect()
    assert sorted(r["value"] for r in rows) == sorted(f"v{n}" for n in range(1000) for _ in range(2))
    for p, high in {r["partition"]: r["high"] for r in M.ends(spark, at).collect()}.items():
        assert sorted(r["offset"] for r in rows if r["partition"] == p) == list(range(high))
    # A file has one task's messages in the order of their keys.
    for f in spark.read.schema(f"{M.INDEX}, append bigint").parquet(f"{at}/index").collect():
        keys = [int(r["key"]) for r in sorted(rows, key=lambda r: r["offset"]) if r["partition"] == f["partition"] and f["first"] <= r["offset"] < f["first"] + f["n"] and r["key"] is not None]
        assert keys == sorted(keys)


def test_publishing_moves_no_body(spark, sf, monkeypatch, joins_by_shuffle):
    written = []
    monkeypatch.setattr(M, "write_files", lambda messages, *a, **b: written.append((messages, b)) or (_ for _ in ()).throw(InterruptedError))
    with pytest.raises(InterruptedError):
        chain.publish_messages(spark, sf)
    assert written[0][1] == {"moved": False} and not any("to_json" in part.lower() or "structstojson" in part.lower() for part in moves(written[0][0]))


#: Queries, the exchanges of each, and how many of these move hashes.
MOVES = {
    "explode_transactions": (2, 0),
    "flagship": (4, 1),
    "transaction_rows": (2, 0),
    "explode_logs": (4, 1),
    "block_activity": (3, 0),
    "log_rows": (3, 0),
    "write_logs": (3, 0),
    "write_transactions": (2, 0),
}


@pytest.mark.parametrize("name", sorted(MOVES))
def test_query_moves_landed_rows_without_hashes(spark, sf, joins_by_shuffle, monkeypatch, name):
    monkeypatch.setattr(T, "written", lambda rows, table: rows)  # what is written is not moved
    found = moves(catalog.queries()[name](spark, sf))
    assert (len(found), sum("sha2" in part for part in found)) == MOVES[name]


def test_tables_are_compressed_by_zstd(spark, tmp_path):
    rows = spark.createDataFrame([("c", n) for n in range(9)], "blockchain_id string, n bigint").selectExpr("blockchain_id", "timestamp_seconds(n) AS block_time", "cast(n AS string) AS hash")
    T.write_sorted(rows, f"file://{tmp_path}/t", "transactions")
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in tmp_path.glob("t/*/*.parquet")} == {"ZSTD"}


def test_storage_order_writes_rows_that_moved_once(spark, sf, monkeypatch, joins_by_shuffle):
    written = []
    monkeypatch.setattr(T, "write_sorted", lambda rows, *a: written.append(rows) or (_ for _ in ()).throw(InterruptedError))
    with pytest.raises(InterruptedError):
        chain.storage_order(spark, sf)
    found = moves(written[0])
    assert len(found) == 2 and not any("sha2" in part for part in found)

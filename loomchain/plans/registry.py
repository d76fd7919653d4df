"""Registered queries, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        name = f.__name__.rstrip("_")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# The landed sources as DuckDB sees them.
HEADERS = """headers AS (
  SELECT o_orderkey AS block_number, 'chain-' || CAST(o_custkey % 3 AS VARCHAR) AS blockchain_id, 43112 + o_custkey % 3 AS evm_chain_id,
         '0x' || sha256(CAST(o_orderkey AS VARCHAR)) AS hash, '0x' || sha256(CAST(o_orderkey - 1 AS VARCHAR)) AS parent_hash,
         '0x' || substr(sha256(CAST(o_custkey AS VARCHAR)), 1, 40) AS miner, CAST(epoch(o_orderdate) AS BIGINT) AS timestamp,
         CAST(round(o_totalprice * 100) AS BIGINT) AS gas_used, CASE WHEN o_orderpriority NOT LIKE '5%' THEN '25000000000' END AS base_fee_per_gas,
         o_custkey AS nonce, o_orderstatus AS status FROM orders)"""
TX = """tx AS (
  SELECT l_orderkey AS block_number,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 AS transaction_index,
         '0x' || sha256(concat_ws('-', l_orderkey, l_linenumber)) AS hash, '0x' || substr(sha256(CAST(l_suppkey AS VARCHAR)), 1, 40) AS from_address,
         CASE WHEN l_returnflag = 'R' THEN '' ELSE '0x' || substr(sha256(CAST(l_partkey AS VARCHAR)), 1, 40) END AS to_address, l_partkey AS nonce,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) || '0000000000000000' AS value, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS cents,
         21000 + CAST(l_quantity AS BIGINT) AS gas, '25000000000' AS gas_price, CASE WHEN l_linenumber % 3 = 2 THEN '30000000000' END AS max_fee_per_gas,
         l_linenumber % 3 AS type, CASE WHEN l_linestatus <> 'F' THEN 1 ELSE 0 END AS status, l_linenumber <> 7 AS has_receipt, l_linenumber AS line_number,
         CASE WHEN l_linenumber % 3 = 2 THEN '2000000000' END AS max_priority_fee, '0x' || substr(sha256(CAST(l_partkey AS VARCHAR)), 1, 8) AS input,
         CASE WHEN l_returnflag = 'R' THEN '0x' || substr(sha256(CAST(l_suppkey AS VARCHAR)), 5, 40) END AS contract_address FROM lineitem)"""
_of = lambda what: f"'0x' || sha256('{what}-' || CAST(block_number AS VARCHAR))"
FULL_HEADERS = f"""full_headers AS (
  SELECT *, {_of("state")} AS state_root, {_of("transactions")} AS transactions_root, {_of("receipts")} AS receipts_root, {_of("uncles")} AS sha3_uncles, {_of("mix")} AS mix_hash, {_of("bloom")} AS logs_bloom,
         '0x' || substr(sha256(CAST(nonce AS VARCHAR)), 1, 8) AS extra_data, CASE WHEN block_number % 2 = 0 THEN {_of("beacon")} END AS parent_beacon_block_root, 8000000 + nonce AS gas_limit,
         '1' || repeat('0', 40) AS difficulty, timestamp * 1000 + 7 AS timestamp_ms, nonce % 9 AS min_delay_excess, gas_used % 100000 AS size,
         CASE WHEN block_number % 3 = 0 THEN nonce * 2 END AS excess_blob_gas, CASE WHEN block_number % 3 = 0 THEN nonce END AS blob_gas_used FROM headers)"""
WITHDRAWALS = """withdrawals AS (
  SELECT l_orderkey AS block_number, l_linenumber AS index, l_suppkey AS validator_index, '0x' || substr(sha256(CAST(l_partkey AS VARCHAR)), 1, 40) AS address, CAST(l_quantity AS BIGINT) AS amount FROM lineitem WHERE l_returnflag = 'R')"""
LOGS = """logs AS (
  SELECT event_id % 1000 AS block_number, user_id % 4 AS tx_index, event_id AS log_index, event_id % 5 AS n_topics, event_type, user_id, value, event_id, props,
         event_type = 'error' AS removed, '0x' || substr(sha256(CAST(user_id AS VARCHAR)), 1, 40) AS address FROM events)"""
MESSAGES = """messages AS (
  SELECT event_id, user_id, event_type, value AS amount, props, ts, CAST(event_id AS VARCHAR) AS key, CAST(user_id % 4 AS INTEGER) AS partition,
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset",
         CASE event_id % 50 WHEN 0 THEN 'nil_message' WHEN 1 THEN 'malformed_json' WHEN 2 THEN 'missing_chain_id' WHEN 3 THEN 'bad_integer' WHEN 4 THEN 'bad_hex'
              ELSE CASE WHEN event_id % 50 = 5 AND event_id % 2 = 1 THEN 'missing_evm_chain_id' END END AS error_class FROM events)"""
DONE = """done AS (SELECT partition, "offset" AS o FROM messages WHERE event_type <> 'error' OR "offset" < 50)"""
COMMIT = """runs AS (SELECT partition, o, row_number() OVER (PARTITION BY partition ORDER BY o) - 1 AS rn FROM done),
commits AS (SELECT p.partition, coalesce(max(o) FILTER (WHERE o = rn), -1) AS committed FROM (SELECT DISTINCT partition FROM messages) p LEFT JOIN runs USING (partition) GROUP BY 1)"""
POSITIONS = """processed AS (SELECT o_orderkey AS h FROM orders WHERE o_orderstatus <> 'P'),
inflight AS (SELECT o_orderkey AS h FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 10 = 0),
bounds AS (SELECT min(o_orderkey) AS lowest, max(o_orderkey) AS highest FROM orders)"""
ALL_HEIGHTS = "heights AS (SELECT unnest(range(lowest, highest + 1)) AS h FROM bounds)"
MISSING = "missing AS (SELECT h FROM heights WHERE h NOT IN (SELECT h FROM processed) AND h NOT IN (SELECT h FROM inflight))"
SAMPLES = """samples AS (
  SELECT event_id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS at_s, event_type, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status, value / 100 AS seconds,
         'r' || CAST(user_id % 3 AS VARCHAR) AS region, 'j' || CAST(user_id % 2 AS VARCHAR) AS job FROM events)"""
CHECKPOINTS = "checkpoints AS (SELECT user_id % 3 AS chain_id, event_id AS lowest_unprocessed_block, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp FROM events)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"

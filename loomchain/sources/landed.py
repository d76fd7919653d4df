"""Chain data derived from the landed tables ``orders``, ``lineitem`` and ``events``: headers, transactions, logs, the message log
and metric samples.  Everything is a plan over the whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomchain.operators.ranges import numbered

#: Events in a bucket of the message log's numbering.
LOG_BUCKET = 10_000
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(column: str) -> Column:
    """Whole seconds since 1970, whatever the session's time zone."""
    return F.expr(f"timestampdiff(SECOND, {_EPOCH}, CAST({column} AS TIMESTAMP_NTZ))")


def instant(column: str) -> Column:
    """The time as an instant in UTC, whatever the session's time zone."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, CAST({column} AS TIMESTAMP_NTZ))"))


def sha(column: Column | str) -> Column:
    return F.sha2(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"), 256)


def _dealt(rows: DataFrame, key: str, dealt: bool) -> DataFrame:
    """Landed rows by block, if asked for: they move as they landed, and texts and hashes are made behind the move."""
    return rows.repartition(key) if dealt else rows


def headers(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One block header for each order; ``dealt`` ones come by block."""
    o = _dealt(table(spark, sf_dir, "orders"), "o_orderkey", dealt)
    chain = F.col("o_custkey") % 3
    return o.select(
        F.col("o_orderkey").alias("block_number"), F.concat(F.lit("chain-"), chain.cast("string")).alias("blockchain_id"), (43112 + chain).alias("evm_chain_id"),
        F.concat(F.lit("0x"), sha("o_orderkey")).alias("hash"), F.concat(F.lit("0x"), sha(F.col("o_orderkey") - 1)).alias("parent_hash"),
        F.concat(F.lit("0x"), F.substring(sha("o_custkey"), 1, 40)).alias("miner"), seconds("o_orderdate").alias("timestamp"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("gas_used"),
        F.when(~F.col("o_orderpriority").startswith("5"), "25000000000").alias("base_fee_per_gas"), F.col("o_custkey").alias("nonce"), F.col("o_orderstatus").alias("status"),
    )


def full_headers(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Headers with every field that a message carries."""
    h = headers(spark, sf_dir, dealt)
    of = lambda what: F.concat(F.lit("0x"), sha(F.concat_ws("-", F.lit(what), F.col("block_number"))))
    return h.withColumns({
        "state_root": of("state"), "transactions_root": of("transactions"), "receipts_root": of("receipts"), "sha3_uncles": of("uncles"), "mix_hash": of("mix"), "logs_bloom": of("bloom"),
        "extra_data": F.concat(F.lit("0x"), F.substring(sha("nonce"), 1, 8)), "parent_beacon_block_root": F.when(F.col("block_number") % 2 == 0, of("beacon")),
        "gas_limit": 8000000 + F.col("nonce"), "difficulty": F.concat(F.lit("1"), F.lit("0" * 40)), "timestamp_ms": F.col("timestamp") * 1000 + 7, "min_delay_excess": F.col("nonce") % 9,
        "size": F.col("gas_used") % 100000, "excess_blob_gas": F.when(F.col("block_number") % 3 == 0, F.col("nonce") * 2), "blob_gas_used": F.when(F.col("block_number") % 3 == 0, F.col("nonce")),
    })


def withdrawals(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One withdrawal for each returned line."""
    l = _dealt(table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'"), "l_orderkey", dealt)
    return l.select(
        F.col("l_orderkey").alias("block_number"), F.col("l_linenumber").cast("bigint").alias("index"), F.col("l_suppkey").cast("bigint").alias("validator_index"),
        F.concat(F.lit("0x"), F.substring(sha("l_partkey"), 1, 40)).alias("address"), F.col("l_quantity").cast("bigint").alias("amount"),
    )


def processed_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers(spark, sf_dir).where("status <> 'P'").select(F.lit("all").alias("chain"), F.col("block_number").alias("h"))


def inflight_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers(spark, sf_dir).where("status = 'P' AND block_number % 10 = 0").select(F.lit("all").alias("chain"), F.col("block_number").alias("h"))


def height_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chain, lowest, highest) over all headers."""
    return headers(spark, sf_dir).groupBy(F.lit("all").alias("chain")).agg(F.min("block_number").alias("lowest"), F.max("block_number").alias("highest"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction for each line, dealt by block; hashes collide on purpose where a line number repeats in an order."""
    l = table(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus")
    # In a projection of its own: beside the texts and hashes it would have the window move and sort these too.
    placed = l.withColumn("nth", F.row_number().over(order))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    return placed.select(
        F.col("l_orderkey").alias("block_number"), (F.col("nth") - 1).cast("bigint").alias("transaction_index"),
        F.concat(F.lit("0x"), sha(F.concat_ws("-", "l_orderkey", "l_linenumber"))).alias("hash"), F.concat(F.lit("0x"), F.substring(sha("l_suppkey"), 1, 40)).alias("from_address"),
        F.when(F.col("l_returnflag") == "R", "").otherwise(F.concat(F.lit("0x"), F.substring(sha("l_partkey"), 1, 40))).alias("to_address"),
        F.col("l_partkey").alias("nonce"), F.concat(cents, F.lit("0" * 16)).alias("value"), cents.alias("cents"), (21000 + F.col("l_quantity").cast("bigint")).alias("gas"),
        F.lit("25000000000").alias("gas_price"), F.when(F.col("l_linenumber") % 3 == 2, "30000000000").alias("max_fee_per_gas"), (F.col("l_linenumber") % 3).cast("smallint").alias("type"),
        (F.col("l_linestatus") != "F").cast("int").alias("status"), (F.col("l_linenumber") != 7).alias("has_receipt"), F.col("l_linenumber").cast("bigint").alias("line_number"),
        F.when(F.col("l_linenumber") % 3 == 2, "2000000000").alias("max_priority_fee"), F.concat(F.lit("0x"), F.substring(sha("l_partkey"), 1, 8)).alias("input"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("0x"), F.substring(sha("l_suppkey"), 5, 40))).alias("contract_address"),
    )


def logs(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One log for each event."""
    e = _dealt(table(spark, sf_dir, "events").withColumn("block", F.col("event_id") % 1000), "block", dealt)
    topics = F.array(*(F.concat(F.lit("0x"), sha(c)) for c in ("event_type", "user_id", "value", "event_id")))
    return e.select(
        F.col("block").alias("block_number"), (F.col("user_id") % 4).alias("tx_index"), F.col("event_id").alias("log_index"),
        F.slice(topics, 1, (F.col("event_id") % 5).cast("int")).alias("topics"), F.base64(F.col("props").cast("binary")).alias("data"), "props",
        (F.col("event_type") == "error").alias("removed"), F.concat(F.lit("0x"), F.substring(sha("user_id"), 1, 40)).alias("address"),
    )


def log_structs(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """(block_number, tx_index, logs in the order of their index) as a message carries them."""
    one = F.struct(
        F.col("log_index").alias("index"), "address", "topics", "data", F.col("block_number").cast("decimal(20,0)").alias("blockNumber"),
        F.concat(F.lit("0x"), sha(F.concat_ws("-", "block_number", "tx_index"))).alias("txHash"), F.col("tx_index").alias("txIndex"),
        F.concat(F.lit("0x"), sha("block_number")).alias("blockHash"), "removed",
    )
    return logs(spark, sf_dir, dealt).groupBy("block_number", "tx_index").agg(F.array_sort(F.collect_list(one)).alias("logs"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("partition", (F.col("user_id") % 4).cast("int"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message for each event, as it is sent: with its partition, but without an offset; some are broken on purpose."""
    key, value = _message()
    return _events(spark, sf_dir).select(key, value, "partition", instant("ts").alias("timestamp"))


def _message() -> tuple[Column, Column]:
    chain, kind = F.col("user_id") % 3, F.col("event_id") % 50
    hash_ = F.when(kind == 4, "0xzz").otherwise(F.concat(F.lit("0x"), sha("event_id")))
    log = F.struct(
        F.concat(F.lit("0x"), F.substring(sha("user_id"), 1, 40)).alias("address"), F.array(F.concat(F.lit("0x"), sha("event_type"))).alias("topics"), F.base64(F.col("props").cast("binary")).alias("data"),
        F.col("event_id").alias("blockNumber"), F.concat(F.lit("0x"), sha("event_id")).alias("txHash"), F.lit(0).alias("txIndex"), F.concat(F.lit("0x"), sha("event_id")).alias("blockHash"), F.lit(0).alias("index"), (F.col("event_type") == "error").alias("removed"),
    )
    tx = F.struct(
        F.concat(F.lit("0x"), sha(F.col("event_id") + 1)).alias("hash"), F.concat(F.lit("0x"), F.substring(sha("user_id"), 1, 40)).alias("from"), F.lit("").alias("to"), F.col("user_id").alias("nonce"),
        F.lit("1000000000000000000").alias("value"), F.lit(21000).alias("gas"), F.lit("25000000000").alias("gasPrice"), F.lit(0).alias("type"),
        F.struct(F.lit(1).alias("status"), F.lit(21000).alias("gasUsed"), F.array(log).alias("logs")).alias("receipt"),
    )
    body = F.to_json(F.struct(
        # Kind 5 lacks the EVM chain id, which only blocks with logs need.
        F.when(kind != 5, (43112 + chain).cast("string")).alias("evmChainId"), F.when(kind != 2, F.concat(F.lit("chain-"), chain.cast("string"))).alias("blockchainId"),
        F.when(kind == 3, "not-a-number").otherwise(F.col("event_id").cast("string")).alias("number"), hash_.alias("hash"), F.concat(F.lit("0x"), sha(F.col("event_id") - 1)).alias("parentHash"),
        F.lit(8000000).alias("gasLimit"), F.col("user_id").alias("gasUsed"), F.lit("25000000000").alias("baseFeePerGas"), seconds("ts").alias("timestamp"), F.lit("1").alias("difficulty"),
        F.col("user_id").alias("nonce"), F.when(F.col("event_id") % 2 == 1, F.array(tx)).alias("transactions"),
    ))
    value = F.when(kind == 0, F.lit(None)).when(kind == 1, "not json").otherwise(body)
    return F.col("event_id").cast("string").alias("key"), value.alias("value")


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages in the columns of a message log, with their offsets."""
    key, value = _message()
    placed = numbered(_events(spark, sf_dir), ["partition"], F.floor(F.col("event_id") / LOG_BUCKET), ["event_id"], "offset")
    return placed.select(key, value, F.lit("blocks").alias("topic"), "partition", "offset", instant("ts").alias("timestamp"), "event_type", "event_id", "user_id")


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select((F.col("user_id") % 3).alias("chain_id"), F.col("event_id").alias("lowest_unprocessed_block"), seconds("ts").alias("timestamp"))


def processed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_log(spark, sf_dir).where("event_type <> 'error' OR offset < 50").select("partition", "offset")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric sample for each event."""
    e = table(spark, sf_dir, "events")
    labels = F.create_map(F.lit("type"), "event_type", F.lit("region"), F.concat(F.lit("r"), (F.col("user_id") % 3).cast("string")), F.lit("job"), F.concat(F.lit("j"), (F.col("user_id") % 2).cast("string")))
    return e.select(
        "event_id", instant("ts").alias("ts"), seconds("ts").alias("at"), "event_type", F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        (F.col("value") / 100).alias("seconds"), labels.alias("labels"),
    )

"""Messages to rows: decode, classify, route, unnest, project, assemble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomchain.functions import codecs as C
from loomchain.sources import schemas as S

#: Error classes in the order in which they are looked for.
ERROR_CLASSES = ("nil_message", "malformed_json", "missing_chain_id", "bad_integer", "bad_hex", "missing_evm_chain_id")

_HASHES = ("hash", "parentHash", "stateRoot", "transactionsRoot", "receiptsRoot", "sha3Uncles", "mixHash", "parentBeaconBlockRoot")


def decode_blocks(messages: DataFrame) -> DataFrame:
    """Adds the typed nested record ``block`` to messages with a JSON ``value``; what doesn't parse is kept as text inside it.

    The record comes from a generator of one row, which the optimizer doesn't copy into the filters and projections above it: as a
    plain column it would be parsed once for each of their references.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT}
    return messages.select("*", F.explode(F.array(F.from_json("value", S.struct_of(S.BLOCK), options))).alias("block"))


def _any(array: str, bad) -> Column:
    return F.exists(F.coalesce(F.col(array), F.array()), bad)


def error_class() -> Column:
    """Class of a decoded message, over the whole record before anything is written; NULL if it is good."""
    b = lambda name: F.col(f"block.{name}")
    negative = lambda x: F.coalesce(x < 0, F.lit(False))
    integers = C.any_bad_integer([b("number"), b("evmChainId"), b("difficulty"), b("baseFeePerGas")])
    unsigned = negative(b("gasLimit")) | negative(b("gasUsed")) | negative(b("timestamp")) | negative(b("nonce")) | (b("number").isNotNull() & (b("number") != "") & C.unsigned64(b("number")).isNull())
    tx_integers = _any("block.transactions", lambda t: C.any_bad_integer([t["value"], t["gasPrice"], t["maxFeePerGas"], t["maxPriorityFeePerGas"]]))
    hexes = C.any_bad_hex([(b("miner"), 20), *((b(name), 32) for name in _HASHES)])
    tx_hexes = _any("block.transactions", lambda t: C.any_bad_hex([(t["hash"], 32), (t["from"], 20), (t["to"], 20)]))
    bad_log = lambda g: ~C.all_fixed_hex([(g["address"], 20), (g["txHash"], 32), (g["blockHash"], 32)]) | C.base64_bytes(g["data"]).isNull() | ~C.all_fixed_hex_of(g["topics"], 32)
    logs = lambda t: F.coalesce(t["receipt"]["logs"], F.array())
    has_logs = _any("block.transactions", lambda t: F.size(logs(t)) > 0)
    return (
        F.when(F.col("value").isNull(), "nil_message")
        .when(F.col("block").isNull() | b(S.CORRUPT).isNotNull(), "malformed_json")
        .when(F.coalesce(b("blockchainId"), F.lit("")) == "", "missing_chain_id")
        .when(integers | unsigned | tx_integers, "bad_integer")
        .when(hexes | tx_hexes | _any("block.transactions", lambda t: F.exists(logs(t), bad_log)), "bad_hex")
        .when(has_logs & (F.coalesce(b("evmChainId"), F.lit("")) == ""), "missing_evm_chain_id")
    )


def classify(messages: DataFrame) -> DataFrame:
    return decode_blocks(messages).withColumn("error_class", error_class())


def split(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good decoded messages, dead letters with unchanged key and value) of classified messages."""
    return classified.where("error_class IS NULL"), classified.where("error_class IS NOT NULL").select("key", "value", "error_class")


def route(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split(classify(messages))


def block_rows(decoded: DataFrame) -> DataFrame:
    """The ``blocks`` table's row of each good message, with its defaults."""
    b = lambda name: F.col(f"block.{name}")
    zero = F.lit(0).cast("decimal(20,0)")
    number = lambda name: F.coalesce(b(name), zero)
    hash_ = lambda name: C.hex_bytes(b(name), 32)
    difficulty = C.or_zero(b("difficulty"))
    rows = {
        "blockchain_id": b("blockchainId"), "evm_chain_id": C.or_zero(b("evmChainId")), "block_number": F.coalesce(C.unsigned64(b("number")), zero), "hash": hash_("hash"),
        "parent_hash": hash_("parentHash"), "block_time": C.block_time(number("timestamp")), "miner": C.hex_bytes(b("miner"), 20), "difficulty": difficulty, "total_difficulty": difficulty,
        "size": number("size"), "gas_limit": number("gasLimit"), "gas_used": number("gasUsed"), "base_fee_per_gas": C.or_zero(b("baseFeePerGas")), "block_gas_cost": F.lit("0"),
        "state_root": hash_("stateRoot"), "transactions_root": hash_("transactionsRoot"), "receipts_root": hash_("receiptsRoot"), "extra_data": F.lit(""), "block_extra_data": F.lit(""),
        "ext_data_hash": C.hex_bytes(F.lit(""), 32), "ext_data_gas_used": F.lit(0), "mix_hash": hash_("mixHash"), "nonce": C.nonce_bytes(number("nonce")), "sha3_uncles": hash_("sha3Uncles"),
        "uncles": F.array(), "blob_gas_used": number("blobGasUsed"), "excess_blob_gas": number("excessBlobGas"),
        "parent_beacon_block_root": F.when(F.coalesce(b("parentBeaconBlockRoot"), F.lit("")) != "", hash_("parentBeaconBlockRoot")), "min_delay_excess": number("minDelayExcess"),
    }
    return _as_table(decoded, rows, S.BLOCKS)


#: What a transaction's and a log's row take from their block.
_OF_BLOCK = ("blockchainId", "evmChainId", "number", "hash", "timestamp")


def _with_header(decoded: DataFrame, items: Column) -> DataFrame:
    """The few fields of each block that its items need, as ``block``, beside the items: the record itself is not copied for each of them."""
    return decoded.select(F.struct(*(F.col(f"block.{name}").alias(name) for name in _OF_BLOCK)).alias("block"), items.alias("_items"))


def explode_transactions(decoded: DataFrame) -> DataFrame:
    """One row for each transaction with its position; blocks without any give none."""
    return _with_header(decoded, F.col("block.transactions")).select("block", F.posexplode("_items").alias("position", "tx"))


def transaction_rows(decoded: DataFrame, receipt_status: bool = False) -> DataFrame:
    """The ``transactions`` table's rows.  ``success`` is 0 unless ``receipt_status`` asks for the receipt's."""
    b, t = (lambda name: F.col(f"block.{name}")), (lambda name: F.col(f"tx.{name}"))
    zero = F.lit(0).cast("decimal(20,0)")
    rows = {
        "blockchain_id": b("blockchainId"), "evm_chain_id": C.or_zero(b("evmChainId")), "block_number": F.coalesce(C.unsigned64(b("number")), zero), "block_hash": C.hex_bytes(b("hash"), 32),
        "block_time": C.block_time(F.coalesce(b("timestamp"), zero)), "hash": C.hex_bytes(t("hash"), 32), "from_address": C.hex_bytes(t("from"), 20),
        "to_address": F.when(F.coalesce(t("to"), F.lit("")) != "", C.hex_bytes(t("to"), 20)), "nonce": F.coalesce(t("nonce"), zero), "value": C.or_zero(t("value")),
        "gas": F.coalesce(t("gas"), zero), "gas_price": C.or_zero(t("gasPrice")), "max_fee_per_gas": C.big_integer(t("maxFeePerGas")), "max_priority_fee": C.big_integer(t("maxPriorityFeePerGas")),
        "input": F.coalesce(t("input"), F.lit("")), "type": F.coalesce(t("type"), F.lit(0)), "transaction_index": F.col("position"),
        "success": F.coalesce(t("receipt.status").cast("smallint"), F.lit(0)) if receipt_status else F.lit(0),
    }
    return _as_table(explode_transactions(decoded), rows, S.TRANSACTIONS)


def explode_logs(decoded: DataFrame) -> DataFrame:
    """One row for each log of each receipt; transactions without receipt or logs give none."""
    logs = F.flatten(F.transform("block.transactions", lambda t: F.coalesce(t["receipt"]["logs"], F.array())))
    return _with_header(decoded, logs).select("block", F.explode("_items").alias("log"))


def log_topics(topics: Column) -> dict[str, Column]:
    """The first four topics by position; an empty or absent one is NULL, a fifth is ignored."""
    at = lambda i: F.get(topics, i)
    return {f"topic{i}": F.when(F.coalesce(at(i), F.lit("")) != "", C.hex_bytes(at(i), 32)) for i in range(4)}


def log_rows(decoded: DataFrame) -> DataFrame:
    """The ``logs`` table's rows: place and hashes come from the log, the time from its block."""
    b, g = (lambda name: F.col(f"block.{name}")), (lambda name: F.col(f"log.{name}"))
    zero = F.lit(0).cast("decimal(20,0)")
    rows = {
        "blockchain_id": b("blockchainId"), "evm_chain_id": C.big_integer(b("evmChainId")), "block_number": F.coalesce(g("blockNumber"), zero), "block_hash": C.hex_bytes(g("blockHash"), 32),
        "block_time": C.block_time(F.coalesce(b("timestamp"), zero)), "tx_hash": C.hex_bytes(g("txHash"), 32), "tx_index": g("txIndex"), "address": C.hex_bytes(g("address"), 20),
        **log_topics(g("topics")), "data": C.base64_bytes(g("data")), "log_index": g("index"), "removed": F.coalesce(g("removed"), F.lit(False)),
    }
    return _as_table(explode_logs(decoded), rows, S.LOGS)


def _as_table(rows: DataFrame, columns: dict[str, Column], ddl: str) -> DataFrame:
    return rows.select(*(columns[f.name].cast(f.dataType).alias(f.name) for f in S.struct_of(ddl)))


#: Names in a message and the columns they come from.
HEADER_FIELDS = {
    "evmChainId": "evm_chain_id", "blockchainId": "blockchain_id", "number": "block_number", "hash": "hash", "parentHash": "parent_hash", "stateRoot": "state_root", "transactionsRoot": "transactions_root",
    "receiptsRoot": "receipts_root", "sha3Uncles": "sha3_uncles", "miner": "miner", "gasLimit": "gas_limit", "gasUsed": "gas_used", "baseFeePerGas": "base_fee_per_gas", "timestamp": "timestamp",
    "timestampMs": "timestamp_ms", "minDelayExcess": "min_delay_excess", "size": "size", "difficulty": "difficulty", "mixHash": "mix_hash", "nonce": "nonce", "logsBloom": "logs_bloom", "extraData": "extra_data",
    "excessBlobGas": "excess_blob_gas", "blobGasUsed": "blob_gas_used", "parentBeaconBlockRoot": "parent_beacon_block_root",
}
TRANSACTION_FIELDS = {
    "hash": "hash", "from": "from_address", "to": "to_address", "nonce": "nonce", "value": "value", "gas": "gas", "gasPrice": "gas_price", "maxFeePerGas": "max_fee_per_gas",
    "maxPriorityFeePerGas": "max_priority_fee", "input": "input", "type": "type",
}
WITHDRAWAL_FIELDS = {"index": "index", "validatorIndex": "validator_index", "address": "address", "amount": "amount"}
#: Big integers, which messages carry as text.
_BIG = ("evmChainId", "number", "baseFeePerGas", "difficulty", "value", "gasPrice", "maxFeePerGas", "maxPriorityFeePerGas")


def record(fields: dict[str, str], columns: list[str]) -> list[Column]:
    """The fields whose column is there, under their names in a message; absent ones are left to the reader's defaults."""
    return [(C.rendered(F.col(c).cast("string")) if name in _BIG else F.col(c)).alias(name) for name, c in fields.items() if c in columns]


def _in_order(rows: DataFrame, order: list[str], one: Column, name: str) -> DataFrame:
    """The rows of each block as an array."""
    held = F.array_sort(F.collect_list(F.struct(*order, one.alias("_one"))))
    return rows.groupBy("block_number").agg(F.transform(held, lambda x: x["_one"]).alias(name))


def assemble_blocks(headers: DataFrame, transactions: DataFrame, logs: DataFrame | None = None, withdrawals: DataFrame | None = None) -> DataFrame:
    """Flat rows to nested message records (block_number, record): transactions, their receipts' logs and withdrawals in their order.

    Logs meet their transactions first, then transactions and withdrawals their header.  Inputs that are dealt by block move no more; others move once, by their
    block.
    """
    tx = transactions
    if logs is None:
        tx = tx.withColumn("logs", F.lit(None).cast(f"array<{S.LOG}>"))
    else:
        # Met by block alone, so that transactions stay where and in the order in which they are.
        own = logs.groupBy("block_number").agg(F.collect_list(F.struct("tx_index", "logs")).alias("_own"))
        mine = F.filter("_own", lambda x: x["tx_index"] == F.col("transaction_index"))
        tx = tx.join(own, "block_number", "left").withColumn("logs", F.flatten(F.transform(mine, lambda x: x["logs"]))).drop("_own")
    contract = [F.col("contract_address").alias("contractAddress")] if "contract_address" in tx.columns else []
    receipt = F.when(F.col("has_receipt"), F.struct(*contract, "status", F.col("gas").alias("gasUsed"), F.coalesce("logs", F.array().cast(tx.schema["logs"].dataType)).alias("logs")))
    nested = _in_order(tx, ["transaction_index"], F.struct(*record(TRANSACTION_FIELDS, tx.columns), receipt.alias("receipt")), "transactions")
    joined = headers.join(nested, "block_number", "left")
    lists = {"transactions": nested}
    if withdrawals is not None:
        # Their whole content orders withdrawals of one index, so that ties come out alike.
        taken = _in_order(withdrawals, list(WITHDRAWAL_FIELDS.values()), F.struct(*record(WITHDRAWAL_FIELDS, withdrawals.columns)), "withdrawals")
        joined, lists = joined.join(taken, "block_number", "left"), {"withdrawals": taken, **lists}
    arrays = [F.coalesce(name, F.array().cast(rows.schema[name].dataType)).alias(name) for name, rows in lists.items()]
    return joined.select("block_number", F.struct(*record(HEADER_FIELDS, headers.columns), *arrays).alias("record"))


def publish(records: DataFrame) -> DataFrame:
    """Records as messages: the height as text is the key, the record as JSON the value."""
    return records.select(F.col("block_number").cast("string").alias("key"), F.to_json("record").alias("value"))


def attach_receipts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks whose i-th receipt went to the i-th transaction, blocks with unequal counts) from arrays of both."""
    equal = F.size("transactions") == F.size("receipts")
    joined = blocks.where(equal).withColumn("attached", F.zip_with("transactions", "receipts", lambda t, r: F.struct(t.alias("tx"), r.alias("receipt"))))
    return joined, blocks.where(~equal)

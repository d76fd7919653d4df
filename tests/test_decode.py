import json

import pytest

from loomchain.operators import decode as D
from loomchain.sources import schemas as S

GOOD = {"evmChainId": "43114", "blockchainId": "C", "number": "7", "hash": "0x" + "ab" * 32, "timestamp": 1700000000}
LOG = {"address": "0x" + "01" * 20, "topics": ["0x" + "02" * 32], "data": "aGk=", "blockNumber": 9, "txHash": "0x" + "03" * 32, "txIndex": 4, "blockHash": "0x" + "04" * 32, "index": 2}


def messages(spark, *values):
    return spark.createDataFrame([(str(i), v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)], "key string, value string")


def classes(spark, *values):
    return [r.error_class for r in D.classify(messages(spark, *values)).orderBy("key").collect()]


def test_error_classes(spark):
    bad_log = {**GOOD, "transactions": [{"receipt": {"logs": [{**LOG, "address": "0x12"}]}}]}
    no_chain = {**{k: v for k, v in GOOD.items() if k != "evmChainId"}, "transactions": [{"receipt": {"logs": [LOG]}}]}
    got = classes(spark, None, "not json", "{}", {**GOOD, "number": "x"}, {**GOOD, "hash": "0xzz"}, no_chain, GOOD, {**GOOD, "gasLimit": -1}, bad_log)
    assert got == ["nil_message", "malformed_json", "missing_chain_id", "bad_integer", "bad_hex", "missing_evm_chain_id", None, "bad_integer", "bad_hex"]


@pytest.mark.parametrize("text", ["null", "[]", '"string"', "123"])
def test_json_that_is_no_message(spark, text):
    assert classes(spark, text)[0] in ("malformed_json", "missing_chain_id")


def test_block_defaults(spark):
    r = D.block_rows(D.decode_blocks(messages(spark, {"blockchainId": "C", "difficulty": "5"}))).first()
    assert (r.evm_chain_id, int(r.block_number), r.difficulty, r.total_difficulty, r.base_fee_per_gas, r.block_gas_cost) == ("0", 0, "5", "5", "0", "0")
    assert (r.extra_data, bytes(r.ext_data_hash), r.uncles, bytes(r.nonce), r.parent_beacon_block_root) == ("", bytes(32), [], bytes(8), None)


def test_transaction_and_log_rows(spark):
    tx = {"hash": "0x01", "to": "", "receipt": {"status": 1, "logs": [LOG, {**LOG, "topics": ["0x" + "05" * 32] * 5, "index": 3}]}}
    decoded = D.decode_blocks(messages(spark, {**GOOD, "transactions": [{"to": "0x" + "06" * 20}, tx]}))
    rows = D.transaction_rows(decoded).orderBy("transaction_index").collect()
    assert [(r.transaction_index, r.value, r.gas_price, r.success, r.to_address is None, r.max_fee_per_gas) for r in rows] == [(0, "0", "0", 0, False, None), (1, "0", "0", 0, True, None)]
    assert [r.success for r in D.transaction_rows(decoded, receipt_status=True).orderBy("transaction_index").collect()] == [0, 1]
    logs = D.log_rows(decoded).orderBy("log_index").collect()
    assert [(int(g.block_number), g.tx_index, bytes(g.data), g.topic1 is None, g.topic3 is None) for g in logs] == [(9, 4, b"hi", True, True), (9, 4, b"hi", False, False)]


def test_schemas_hold(spark):
    decoded = D.decode_blocks(messages(spark, GOOD))
    for rows, ddl in ((D.block_rows(decoded), S.BLOCKS), (D.transaction_rows(decoded), S.TRANSACTIONS), (D.log_rows(decoded), S.LOGS)):
        assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in S.struct_of(ddl)]


def test_records_survive_publishing(spark):
    """Every field of a nested record, through JSON and back; absent ones come back as the reader's defaults."""
    header = {"evm_chain_id": 43114, "blockchain_id": "C", "block_number": 7, "hash": "0x" + "ab" * 32, "state_root": "0x" + "01" * 32, "logs_bloom": "0x02", "extra_data": "0x03", "difficulty": "9" * 70, "excess_blob_gas": 5, "blob_gas_used": 6}
    headers = spark.createDataFrame([tuple(header.values())], "evm_chain_id long, blockchain_id string, block_number long, hash string, state_root string, logs_bloom string, extra_data string, difficulty string, excess_blob_gas long, blob_gas_used long")
    tx = spark.createDataFrame([(7, 1, "0x22", "0xffee", "3e9", "0x" + "0c" * 20, 1, 21000, True), (7, 0, "0x11", "0x", None, None, 0, 5, False)], "block_number long, transaction_index long, hash string, input string, max_priority_fee string, contract_address string, status int, gas long, has_receipt boolean")
    taken = spark.createDataFrame([(7, 2, 9, "0x" + "0d" * 20, 4), (7, 1, 8, "0x" + "0e" * 20, 3), (8, 1, 1, "", 1)], "block_number long, index long, validator_index long, address string, amount long")
    b = D.decode_blocks(D.publish(D.assemble_blocks(headers, tx, None, taken))).first().block
    assert (b.evmChainId, b.number, b.stateRoot, b.logsBloom, b.extraData, b.difficulty, b.excessBlobGas, b.blobGasUsed, b.receiptsRoot) == ("43114", "7", header["state_root"], "0x02", "0x03", "9" * 70, 5, 6, None)
    assert [(w["index"], w.validatorIndex, w.amount) for w in b.withdrawals] == [(1, 8, 3), (2, 9, 4)]
    assert [(t.hash, t.input, t.maxPriorityFeePerGas, t.receipt and t.receipt.contractAddress) for t in b.transactions] == [("0x11", "0x", "", None), ("0x22", "0xffee", "3000000000", "0x" + "0c" * 20)]


def test_items_carry_no_whole_block(spark):
    """A block of 5,000 transactions: rows take the header's fields, and the plan explodes nothing beside the whole record."""
    logs = [{"index": 0, "address": "", "topics": [], "data": "", "txHash": "", "blockHash": "", "blockNumber": 1, "txIndex": 0}]
    one = {"hash": "0x" + "ab" * 32, "from": "", "to": "", "value": "1", "input": "0x" + "00" * 200, "receipt": {"status": 1, "logs": logs}}
    whole = {"blockchainId": "c", "evmChainId": "1", "number": "1", "logsBloom": "0x" + "00" * 4096, "transactions": [one] * 5000 + [{**one, "receipt": None}, {**one, "receipt": {"status": 1}}]}
    messages = spark.createDataFrame([("1", json.dumps(whole)), ("2", json.dumps({"blockchainId": "c"}))], "key string, value string")
    decoded = D.decode_blocks(messages)
    for rows, n, wide in ((D.transaction_rows(decoded), 5002, "logsBloom"), (D.log_rows(decoded), 5000, "logsBloom")):
        assert rows.count() == n
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        above = plan[: plan.index("from_json")]
        assert wide not in above and "block.transactions" not in above.split("Generate")[0]

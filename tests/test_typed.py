"""Messages told apart by how their values are written."""

import json

import pytest
from pyspark.sql import functions as F

from loomchain.functions import codecs as C
from loomchain.operators import typed as Y

GOOD = {"evmChainId": "43114", "blockchainId": "C", "number": "7", "hash": "0x" + "ab" * 32, "timestamp": 1700000000, "gasLimit": 5, "transactions": []}
LOG = {"address": "0x" + "01" * 20, "topics": [], "data": "aGk=", "blockNumber": 9, "txHash": "0x" + "03" * 32, "txIndex": 4, "blockHash": "0x" + "04" * 32, "index": 2}


def classes(spark, *values):
    rows = [(f"{i:03}", v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return [r.error_class for r in Y.classify(spark.createDataFrame(rows, "key string, value string")).orderBy("key").collect()]


def tx(**fields):
    return {**GOOD, "transactions": [{"hash": "0x" + "01" * 32}, fields]}


def test_classes(spark):
    bad = "malformed_json"
    cases = [
        (GOOD, None), (None, "nil_message"), ("not json", bad), ({**GOOD, "gasLimit": "5"}, bad), ({**GOOD, "gasLimit": 5.5}, bad), ({**GOOD, "gasLimit": None}, None), ({**GOOD, "gasLimit": -1}, "bad_integer"),
        ({**GOOD, "timestamp": "1700000000"}, bad), ({**GOOD, "hash": 7}, bad), ({**GOOD, "blockchainId": 7}, bad), ({**GOOD, "number": 7}, None), ({**GOOD, "difficulty": 1e21}, None), ({**GOOD, "number": 1e21}, "bad_integer"), ({**GOOD, "number": True}, bad),
        ({**GOOD, "difficulty": {"a": 1}}, bad), ({**GOOD, "difficulty": "x"}, "bad_integer"), (tx(nonce="1"), bad), (tx(nonce=1, value=10**18), None), (tx(value=[1]), bad), (tx(type="2"), bad), (tx(receipt={"status": "1"}), bad),
        (tx(receipt={"status": 1, "logs": [LOG]}), None), (tx(receipt={"logs": [{**LOG, "removed": "true"}]}), bad), (tx(receipt={"logs": [{**LOG, "index": "2"}]}), bad), (tx(receipt={"logs": [{**LOG, "topics": [5]}]}), bad),
        ({**GOOD, "withdrawals": [{"index": "1"}]}, bad), ({**GOOD, "withdrawals": [{"index": 1, "amount": 18446744073709551615}]}, None), ({**GOOD, "unknown": {"gasLimit": "5"}}, None), ({"number": "1"}, "missing_chain_id"),
    ]
    got = classes(spark, *(v for v, _ in cases))
    assert [(v, g) for (v, want), g in zip(cases, got) if g != want] == []


@pytest.mark.parametrize("text, want", [
    ("null", None), ('""', ""), ('"1000000000000000000"', "1000000000000000000"), ('"1e+21"', "1" + "0" * 21), ("1000000000000000000", "1000000000000000000"), ("1e+21", "1" + "0" * 21), ("5e+10", "50000000000"), ("0", "0"),
    ('"' + "9" * 30 + '"', "9" * 30), ("9007199254740993", "9007199254740992"), ("123456789012345678901234567890", str(int(float("123456789012345678901234567890")))), ("1e23", str(int(1e23))), ("1.9", "1"), ("-1.9", "-1"), ("-3e20", "-" + str(int(3e20))),
])
def test_numbers_go_through_a_double(spark, text, want):
    value = '{"blockchainId": "C", "number": %s, "transactions": [{"value": %s}]}' % (text, text)
    row = Y.with_doubles(Y.classify(spark.createDataFrame([("1", value)], "key string, value string"))).select(
        F.col("block.number").alias("n"), C.big_integer(F.col("block.number")).alias("big"), F.col("block.transactions")[0]["value"].alias("v")).first()
    assert row.v == row.n and (row.big == (int(want) and str(int(want)) or "0") if want else row.n in (None, ""))

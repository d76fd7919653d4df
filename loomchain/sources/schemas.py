"""Message schema, table schemas and their keys.  Everything is declared; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Big integers are read as text and unsigned 64-bit numbers as decimals, so that no digit is lost.
LOG = "struct<address:string,topics:array<string>,data:string,blockNumber:decimal(20,0),txHash:string,txIndex:bigint,blockHash:string,index:bigint,removed:boolean>"
RECEIPT = f"struct<contractAddress:string,status:decimal(20,0),gasUsed:decimal(20,0),logs:array<{LOG}>>"
TRANSACTION = (
    "struct<hash:string,from:string,to:string,nonce:decimal(20,0),value:string,gas:decimal(20,0),gasPrice:string,maxFeePerGas:string,"
    f"maxPriorityFeePerGas:string,input:string,type:smallint,receipt:{RECEIPT}>"
)
WITHDRAWAL = "struct<index:decimal(20,0),validatorIndex:decimal(20,0),address:string,amount:decimal(20,0)>"
CORRUPT = "_corrupt_message"
BLOCK = (
    "evmChainId string, blockchainId string, number string, hash string, parentHash string, stateRoot string, transactionsRoot string, "
    "receiptsRoot string, sha3Uncles string, miner string, gasLimit decimal(20,0), gasUsed decimal(20,0), baseFeePerGas string, "
    "timestamp decimal(20,0), timestampMs decimal(20,0), minDelayExcess decimal(20,0), size decimal(20,0), difficulty string, mixHash string, "
    "nonce decimal(20,0), logsBloom string, extraData string, excessBlobGas decimal(20,0), blobGasUsed decimal(20,0), "
    f"parentBeaconBlockRoot string, withdrawals array<{WITHDRAWAL}>, transactions array<{TRANSACTION}>, {CORRUPT} string"
)

MESSAGES = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"

BLOCKS = (
    "blockchain_id string, evm_chain_id string, block_number decimal(20,0), hash binary, parent_hash binary, block_time timestamp, miner binary, "
    "difficulty string, total_difficulty string, size decimal(20,0), gas_limit decimal(20,0), gas_used decimal(20,0), base_fee_per_gas string, "
    "block_gas_cost string, state_root binary, transactions_root binary, receipts_root binary, extra_data string, block_extra_data string, "
    "ext_data_hash binary, ext_data_gas_used bigint, mix_hash binary, nonce binary, sha3_uncles binary, uncles array<binary>, "
    "blob_gas_used decimal(20,0), excess_blob_gas decimal(20,0), parent_beacon_block_root binary, min_delay_excess decimal(20,0)"
)
TRANSACTIONS = (
    "blockchain_id string, evm_chain_id string, block_number decimal(20,0), block_hash binary, block_time timestamp, hash binary, "
    "from_address binary, to_address binary, nonce decimal(20,0), value string, gas decimal(20,0), gas_price string, max_fee_per_gas string, "
    "max_priority_fee string, input string, type smallint, transaction_index bigint, success smallint"
)
LOGS = (
    "blockchain_id string, evm_chain_id string, block_number decimal(20,0), block_hash binary, block_time timestamp, tx_hash binary, "
    "tx_index bigint, address binary, topic0 binary, topic1 binary, topic2 binary, topic3 binary, data binary, log_index bigint, removed boolean"
)
CHECKPOINTS = "chain_id bigint, lowest_unprocessed_block bigint, timestamp bigint"

TABLES = {"blocks": BLOCKS, "transactions": TRANSACTIONS, "logs": LOGS, "checkpoints": CHECKPOINTS}
#: A row replaces older ones with the same key.
KEYS = {
    "blocks": ["blockchain_id", "block_time", "block_number"],
    "transactions": ["blockchain_id", "block_time", "hash"],
    "logs": ["blockchain_id", "block_time", "tx_hash", "log_index"],
    "checkpoints": ["chain_id"],
}


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)

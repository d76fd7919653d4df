"""The four tables: creation, sinks, storage order, maintenance."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.sources import schemas as S


_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(named: str | None, master: str, application: str) -> str:
    """The folder ``named`` in spark.checkpoint.dir.  Only in local mode, where it may be unset, one of the application's own."""
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if application not in _OWN_FOLDERS:
        _OWN_FOLDERS[application] = f"file://{tempfile.mkdtemp(prefix='loomchain-')}"
    return _OWN_FOLDERS[application]


def shared_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    return shared_folder(spark.conf.get("spark.checkpoint.dir", None), context.master, context.applicationId)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Tables hold each chain in a partition of its own: readers of one chain skip the others, and deleting one drops its partition.
CHAIN_COLUMN = {"blocks": "blockchain_id", "transactions": "blockchain_id", "logs": "blockchain_id", "checkpoints": "chain_id"}


def _columns(ddl: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in S.struct_of(ddl))


def ensure_tables(spark: SparkSession, database: str, root: str) -> None:
    """Creates the database under ``root`` and the tables that are missing; calling it again changes nothing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root}'")
    for name, ddl in S.TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({_columns(ddl)}) USING parquet PARTITIONED BY (`{CHAIN_COLUMN[name]}`)")


def append(rows: DataFrame, table: str, name: str) -> None:
    """One job for a whole batch of rows, sorted by key inside each file."""
    rows.sortWithinPartitions(*S.KEYS[name]).select(*rows.sparkSession.table(table).columns).write.insertInto(table)


def write_sorted(rows: DataFrame, path: str, name: str, mode: str = "append") -> None:
    """By chain, and sorted by key inside each file, so that readers skip row groups by their ranges."""
    rows.sortWithinPartitions(*S.KEYS[name]).write.mode(mode).option("compression", "zstd").partitionBy(CHAIN_COLUMN[name]).parquet(path)


def read(spark: SparkSession, path: str, name: str) -> DataFrame:
    schema = S.struct_of(S.TABLES[name])
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def shard(rows: DataFrame, n: int, span: int | None = None) -> DataFrame:
    """Rows of one chain together; with ``span``, of one chain and height range, so that a large chain is many shards."""
    if span is None:
        return rows.repartition(n, "blockchain_id")
    return rows.repartition(n, F.col("blockchain_id"), F.floor(F.col("block_number") / span))


def delete_chain(spark: SparkSession, database: str, blockchain_id: str, chain_id: int) -> None:
    """Drops one chain's partition, with its files, from the four tables; no row of another chain is read or written."""
    for name, column in CHAIN_COLUMN.items():
        value = str(chain_id) if column == "chain_id" else "'" + blockchain_id.replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE `{database}`.`{name}` DROP IF EXISTS PARTITION (`{column}` = {value})")


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def written(rows: DataFrame, name: str) -> DataFrame:
    """Writes rows to a new folder in the table's schema and order and reads them back."""
    at = new_path(rows.sparkSession, name)
    write_sorted(rows, at, name, "errorifexists")
    return read(rows.sparkSession, at, name)

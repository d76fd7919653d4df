"""Checkpoint stores: where each chain's next height is kept."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.operators.relations import latest_checkpoint
from loomchain.sources import schemas as S


class Checkpoints(Protocol):
    """What a store of one's own has to offer."""

    def initialize(self) -> None: ...

    def write(self, rows: DataFrame, now: int) -> None:
        """Adds (chain_id, lowest_unprocessed_block) at a time in seconds."""

    def read(self, wanted: DataFrame) -> DataFrame:
        """(chain_id, lowest, exists) for each wanted chain."""


class TableCheckpoints:
    """Appends to a folder of Parquet files; the newest row of a chain counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.schema = spark, path, S.struct_of(S.CHECKPOINTS)

    def initialize(self) -> None:
        self.spark.createDataFrame([], self.schema).write.mode("append").parquet(self.path)

    def write(self, rows: DataFrame, now: int) -> None:
        rows.select("chain_id", "lowest_unprocessed_block", F.lit(now).cast("bigint").alias("timestamp")).write.mode("append").parquet(self.path)

    def read(self, wanted: DataFrame) -> DataFrame:
        return latest_checkpoint(self.spark.read.schema(self.schema).parquet(self.path), wanted)

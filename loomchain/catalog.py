"""The registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomchain.plans import chain, metrics, positions, streams
from loomchain.plans.registry import ORACLES, QUERIES

#: Modules whose queries are registered on import.
PLANS = (chain, metrics, positions, streams)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.flagship(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

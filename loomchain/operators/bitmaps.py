"""Sets of positions as bitmaps by bucket.

A bucket of positions is one bitmap, built in each task and merged by aggregation, so that what is shuffled is one bitmap for each bucket and task, however
many positions it has.  Bitmaps become positions or ranges again where they are read, by numpy, and only those that are wanted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomchain.shipping import ship

#: Positions of one bitmap, as many as Spark's bitmap functions take at most.
SIZE = 32_768


def bucket_of(column: str, size: int = SIZE):
    """Which bucket has a position; exact for any long."""
    return F.expr(f"(`{column}` - pmod(`{column}`, {size})) div {size}")


def bitmaps(positions: DataFrame, size: int = SIZE) -> DataFrame:
    """(chain, bucket, bits, n) of ``positions(chain, h)``; NULLs are in no set."""
    placed = positions.where("h IS NOT NULL").select("chain", bucket_of("h", size).alias("bucket"), F.pmod(F.col("h"), F.lit(size)).cast("bigint").alias("bit"))
    return placed.groupBy("chain", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).withColumn("n", F.bitmap_count("bits"))


def united(*sets: DataFrame) -> DataFrame:
    """The union of sets given as bitmaps of one size."""
    parts = sets[0].select("chain", "bucket", "bits")
    for s in sets[1:]:
        parts = parts.unionAll(s.select("chain", "bucket", "bits"))
    return parts.groupBy("chain", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")).withColumn("n", F.bitmap_count("bits"))


def buckets(bounds: DataFrame, size: int = SIZE) -> DataFrame:
    """(chain, bucket, low, high) of every bucket with a position of ``bounds(chain, lowest, highest)``, and the bounds inside it."""
    inside = bounds.where("highest >= lowest").withColumns({"_a": bucket_of("lowest", size), "_z": bucket_of("highest", size)})
    each = inside.select("chain", "lowest", "highest", F.explode(F.sequence("_a", "_z")).alias("bucket"))
    return each.select("chain", "bucket", F.greatest("lowest", F.col("bucket") * size).alias("low"), F.least("highest", (F.col("bucket") + 1) * size - 1).alias("high"))


def lacking(bounds: DataFrame, taken: DataFrame, size: int = SIZE) -> DataFrame:
    """(chain, bucket, low, high, bits, n): of each bucket the positions taken, NULL if there are none, and how many inside the bounds are not."""
    placed = buckets(bounds, size).join(taken.select("chain", "bucket", "bits"), ["chain", "bucket"], "left")
    ship(placed.sparkSession)
    types = {f.name: f.dataType.simpleString() for f in placed.schema}
    return placed.mapInArrow(_with_count(size), f"chain {types['chain']}, bucket long, low long, high long, bits binary, n long")


def _flags(bits: bytes | None, size: int) -> np.ndarray:
    return np.zeros(size, bool) if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[:size].astype(bool)


def _inside(row: dict, size: int) -> tuple[int, np.ndarray]:
    """(first position, whether it and those behind it are in the set) of a row's bounds."""
    begin = row["bucket"] * size
    return row["low"], _flags(row["bits"], size)[row["low"] - begin : row["high"] + 1 - begin]


def _with_count(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [int((~_inside(row, size)[1]).sum()) for row in batch.to_pylist()]
            columns = [batch[name].cast(pa.int64()) if name in ("bucket", "low", "high") else batch[name] for name in ("chain", "bucket", "low", "high", "bits")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64())], names=["chain", "bucket", "low", "high", "bits", "n"])

    return run


def _expand(size: int, of: Callable[[np.ndarray], np.ndarray]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                low, flags = _inside(row, size)
                found = np.flatnonzero(of(flags)) + low
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array([row["chain"]] * len(found), batch["chain"].type), pa.array(found, pa.int64())], names=["chain", "h"])

    return run


def _positions(rows: DataFrame, size: int, of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    ship(rows.sparkSession)
    held = rows.select("chain", "bucket", F.col("low").cast("bigint").alias("low"), F.col("high").cast("bigint").alias("high"), "bits")
    return held.mapInArrow(_expand(size, of), f"chain {rows.schema['chain'].dataType.simpleString()}, h long")


def absent(placed: DataFrame, size: int = SIZE) -> DataFrame:
    """(chain, h) of the positions inside the bounds of ``placed`` (as ``lacking`` gives it) that are not in the set."""
    return _positions(placed, size, np.logical_not)


def _runs(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low, flags = _inside(row, size)
                steps = np.flatnonzero(np.diff(np.concatenate([[True], flags, [True]])))
                n = len(steps) // 2
                if n:
                    whole = [pa.array([row[c]] * n, t) for c, t in (("chain", batch["chain"].type), ("bucket", pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*whole, pa.array(steps[::2] + low, pa.int64()), pa.array(steps[1::2] + low - 1, pa.int64())], names=["chain", "bucket", "first", "last"])

    return run


def absent_runs(bounds: DataFrame, taken: DataFrame, size: int = SIZE) -> DataFrame:
    """(chain, bucket, first, last): runs of positions inside the bounds that a set lacks, cut where buckets end."""
    placed = buckets(bounds, size).join(taken.select("chain", "bucket", "bits"), ["chain", "bucket"], "left")
    ship(placed.sparkSession)
    held = placed.select("chain", "bucket", F.col("low").cast("bigint").alias("low"), F.col("high").cast("bigint").alias("high"), "bits")
    return held.mapInArrow(_runs(size), f"chain {placed.schema['chain'].dataType.simpleString()}, bucket long, first long, last long")


def members(sets: DataFrame, size: int = SIZE) -> DataFrame:
    """(chain, h) of the positions in a set."""
    return _positions(sets.select("chain", "bucket", (F.col("bucket") * size).alias("low"), ((F.col("bucket") + 1) * size - 1).alias("high"), "bits"), size, lambda flags: flags)


def missing(bounds: DataFrame, taken: DataFrame, size: int = SIZE) -> DataFrame:
    """(chain, h) of the positions inside the bounds that a set (as bitmaps) lacks."""
    return absent(buckets(bounds, size).join(taken.select("chain", "bucket", "bits"), ["chain", "bucket"], "left"), size)


def count_from(sets: DataFrame, marks: DataFrame, size: int = SIZE) -> DataFrame:
    """(chain, n): members of a set from ``mark`` of ``marks(chain, mark)`` on; a chain without any has no row."""
    ship(sets.sparkSession)
    behind = sets.join(marks.withColumn("_first", bucket_of("mark", size)), "chain").where("bucket >= _first")
    whole = behind.where("bucket > _first").select("chain", "n")
    edge = behind.where("bucket = _first").select("chain", "bucket", "bits", F.col("mark").alias("low"), ((F.col("bucket") + 1) * size - 1).alias("high"))
    return whole.unionAll(_positions(edge, size, lambda flags: flags).select("chain", F.lit(1).cast("bigint"))).groupBy("chain").agg(F.sum("n").alias("n"))

"""What the operators on embeddings share: which rows count, and their vectors as integers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomchain.llm.common import give_back
from loomchain.shipping import ship

#: A component c becomes floor(SCALE * c).
SCALE = 256
#: Vectors that one block holds.
BLOCK_VECTORS = 4096


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def integer_rows(rows: DataFrame) -> DataFrame:
    """(vec_id, label, x) of the rows whose vector is whole and finite, x as whole numbers; one beyond a long's range is the nearest long."""
    ship(rows.sparkSession)
    held = rows.select(rows["vec_id"].cast("long").alias("vec_id"), rows["label"].alias("label"), rows["embedding"].cast("array<double>").alias("c"))
    return held.where(F.col("c").isNotNull() & F.forall("c", _finite)).select("vec_id", "label", F.transform("c", lambda c: F.floor(c * F.lit(float(SCALE)))).alias("x"))


def longest(x: DataFrame) -> int:
    """Components of the longest vector; shorter ones stand for vectors with zeros behind them."""
    return x.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers, zeros behind the shorter ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    flat, sizes = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def vector_blocks(batches: Iterable[pa.RecordBatch], most: int = BLOCK_VECTORS) -> Iterator[pa.RecordBatch]:
    """Batches of ``most`` rows but for the last, whatever sizes come."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - n)
            batch = batch.slice(part.num_rows)
            held.append(part)
            n += part.num_rows
            if n == most:
                yield _one(held)
                held, n = [], 0
    if n:
        yield _one(held)
    give_back()


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def narrow(x: np.ndarray) -> bytes:
    """Integers in as few bytes each as all of them need, which the first byte gives."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return bytes([width]) + x.astype(f"<i{width}").tobytes()


def widened(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)

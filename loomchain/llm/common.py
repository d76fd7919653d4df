"""What the operators of this subpackage share: table access, lineage cuts, row blocks."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.shipping import ship
from loomchain.sources.tables import shared_dir

#: Bytes of text that one block holds at most, but for a single longer text.
BLOCK_BYTES = 4 << 20
#: Rows that one block holds at most.
BLOCK_ROWS = 8192
#: Rows of a few numbers that are sent to the tasks instead of being joined by a shuffle.
ROWS_SENT = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id (long) and the text's UTF-8 bytes (null: empty); other columns, whatever their names, stay out."""
    ship(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"))


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later failures go back to these files, not to the source."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    drop_on_exit(spark, at)
    held = spark.read.schema(df.schema).parquet(at)
    held.cut_at = at
    return held


def free(held: DataFrame) -> None:
    """Removes the files of a table that ``cut`` wrote and that no plan reads any more; others are left alone."""
    if at := getattr(held, "cut_at", None):
        path, files = _path(held.sparkSession, at)
        files.delete(path, True)


def is_small(written: DataFrame) -> bool:
    """Whether a table has at most ROWS_SENT rows; for one that ``cut`` wrote."""
    return written.limit(ROWS_SENT + 1).count() <= ROWS_SENT


def sent(df: DataFrame, small: bool) -> DataFrame:
    """Marked to be sent to the tasks if it is small; else Spark chooses the join."""
    return F.broadcast(df) if small else df


def _path(spark: SparkSession, at: str) -> tuple:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_on_exit(spark: SparkSession, at: str) -> None:
    """Has the file system remove a folder of ours when the driver ends."""
    path, files = _path(spark, at)
    files.deleteOnExit(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_id(nth: int) -> int:
    """A number that no other task gives: the task's partition, then the count of its blocks."""
    return (TaskContext.get().partitionId() << 24) | nth


def give_back() -> None:
    """At a task's end, returns to the system what a worker has freed: workers live on, and an executor counts what they hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def blocks(batches: Iterable[pa.RecordBatch], most_bytes: int = BLOCK_BYTES, most_rows: int = BLOCK_ROWS) -> Iterator[tuple[int, list, list[bytes]]]:
    """(block number, doc_ids, texts) of bounded size from Arrow batches of (doc_id, text as bytes)."""
    ids: list = []
    held: list[bytes] = []
    size = nth = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if held and (size + len(text) > most_bytes or len(held) >= most_rows):
                yield block_id(nth), ids, held
                ids, held, size, nth = [], [], 0, nth + 1
            ids.append(doc_id)
            held.append(text)
            size += len(text)
    if held:
        yield block_id(nth), ids, held
    give_back()


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, Iterator[bytes]]]:
    """(doc_ids, texts) of each Arrow batch; texts come one by one, so that one copy is held at a time."""
    for batch in batches:
        yield batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1))
    give_back()


def planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 with their low bytes first, then the next ones: small numbers compress well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0].astype(np.int64)

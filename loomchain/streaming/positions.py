"""Stateful positions in a stream: the contiguous watermark of each key, kept across batches.

The state of a key is its window (lowest, highest, how many wait) and, in a map, the positions that wait behind a gap: one bitmap for each bucket of
``BUCKET`` positions that has any.  A batch reads and writes the buckets that its positions fall into and those that the watermark passes; what else waits stays
where it is, in RocksDB.  Positions become ranges where they are read, before they are grouped by key, so that what reaches a key's task is a few rows
for each task that read some of its positions.

With an ``interval``, a timer of processing time looks at each key's window again and again, whether messages come or not, and gives a row with
``fired`` where the gap is over the limit.  NULL positions are counted as ``unread`` and otherwise passed over.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from loomchain.shipping import ship

#: Positions of one bitmap.
BUCKET = 1 << 15
WINDOW = "lowest long, highest long, pending long, unread long"
RESULT = "chain string, lowest long, highest long, pending long, ignored long, crowded boolean, unread long, fired boolean"
RANGES = "chain string, first long, last long, n long, nulls long"
#: Positions waiting behind a gap from which on a window is marked as crowded.
CROWDED = 10_000
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def merged(firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges that neither overlap nor touch, in order, with the same positions."""
    order = np.argsort(firsts, kind="stable")
    firsts, lasts = firsts[order], np.maximum.accumulate(lasts[order]) if len(order) else lasts
    heads = np.flatnonzero(np.concatenate([[True], firsts[1:] > lasts[:-1] + 1])) if len(order) else order
    return firsts[heads], lasts[np.concatenate([heads[1:], [len(firsts)]]) - 1] if len(order) else lasts


def as_ranges(positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return merged(positions, positions)


class Bitmaps(dict):
    """Bitmaps by bucket in memory; a query keeps them in its state."""

    put = dict.__setitem__

    def remove(self, bucket: int) -> None:
        self.pop(bucket, None)

    def ranges(self) -> list[tuple[int, int]]:
        at = [np.flatnonzero(_load(self, b)) + b * BUCKET for b in sorted(self)]
        firsts, lasts = as_ranges(np.concatenate([np.zeros(0, np.int64), *at]))
        return list(zip(firsts.tolist(), lasts.tolist()))


class _Stored:
    """The same in a state's map."""

    def __init__(self, state):
        self.state = state

    def get(self, bucket: int) -> bytes | None:
        return self.state.getValue((bucket,))[0] if self.state.containsKey((bucket,)) else None

    def put(self, bucket: int, bits: bytes) -> None:
        self.state.updateValue((bucket,), (bits,))

    def remove(self, bucket: int) -> None:
        self.state.removeKey((bucket,))


def _load(held, bucket: int) -> np.ndarray:
    bits = held.get(bucket)
    return np.zeros(BUCKET, bool) if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)


def absorb(lowest: int, held, new: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Sets ordered ranges in the bitmaps ``held`` and moves on over what is whole: (watermark, positions that were neither passed nor known)."""
    above = new[1] >= lowest
    firsts, lasts = np.maximum(new[0][above], lowest), new[1][above]
    added, at = 0, 0
    while at < len(firsts):
        # All ranges that begin in one bucket, and the whole buckets that the last of them covers.
        bucket = int(firsts[at]) // BUCKET
        bits = _load(held, bucket)
        before = int(bits.sum())
        while at < len(firsts) and int(firsts[at]) // BUCKET == bucket:
            end = (bucket + 1) * BUCKET
            bits[int(firsts[at]) - bucket * BUCKET : min(int(lasts[at]) + 1, end) - bucket * BUCKET] = True
            if lasts[at] >= end:
                firsts[at] = end
                break
            at += 1
        added += int(bits.sum()) - before
        held.put(bucket, np.packbits(bits).tobytes())
    bucket = lowest // BUCKET
    while (packed := held.get(bucket)) is not None:
        bits = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
        gaps = np.flatnonzero(~bits[lowest - bucket * BUCKET :])
        if len(gaps):
            if gaps[0]:
                lowest += int(gaps[0])
                bits[: lowest - bucket * BUCKET] = False
                held.put(bucket, np.packbits(bits).tobytes()) if bits.any() else held.remove(bucket)
            break
        bucket += 1
        lowest = bucket * BUCKET
        held.remove(bucket - 1)
    return lowest, added


def add_positions(lowest: int, ranges: list[tuple[int, int]], positions: list[int]) -> tuple[int, list[tuple[int, int]], int]:
    """(watermark, waiting ranges, how many of the new positions were below the watermark or known), in memory."""
    held, waiting = Bitmaps(), np.asarray(ranges, np.int64).reshape(-1, 2)
    absorb(lowest, held, (waiting[:, 0], waiting[:, 1]))
    lowest, added = absorb(lowest, held, as_ranges(np.asarray(positions, np.int64)))
    return lowest, held.ranges(), len(positions) - added


def _to_ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chains, h = batch["chain"].dictionary_encode(null_encoding="encode"), batch["h"]
        own, known = chains.indices.to_numpy(zero_copy_only=False), h.is_valid().to_numpy(zero_copy_only=False)
        values, rows = h.fill_null(0).to_numpy(zero_copy_only=False), []
        for k, chain in enumerate(chains.dictionary.to_pylist()):
            mine = own == k
            some = values[mine & known]
            firsts, lasts = as_ranges(some)
            nulls = int((mine & ~known).sum())
            # What concerns all of a chain's rows stands with one of its ranges, an empty one if there is no other.
            firsts, lasts = (firsts, lasts) if len(firsts) else (np.zeros(1, np.int64), np.full(1, -1, np.int64))
            whole = lambda x: [x] + [0] * (len(firsts) - 1)
            rows.append(pa.table({"chain": pa.array([chain] * len(firsts), pa.string()), "first": firsts, "last": lasts, "n": pa.array(whole(len(some)), pa.int64()), "nulls": pa.array(whole(nulls), pa.int64())}))
        if rows:
            yield from pa.concat_tables(rows).to_batches()


class Windows(StatefulProcessor):
    """Each key's window after a batch with some of its positions, and whenever its timer finds a gap over ``max_gap``."""

    def __init__(self, initial: int, interval_ms: int | None, max_gap: int):
        self.initial, self.interval_ms, self.max_gap = initial, interval_ms, max_gap

    def init(self, handle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", WINDOW)
        self.buckets = handle.getMapState("buckets", "bucket long", "bits binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.window.exists():
            lowest, highest, pending, unread = self.window.get()
        else:
            lowest, highest, pending, unread = self.initial, self.initial - 1, 0, 0
            self._again(timerValues)
        firsts, lasts, n = [], [], 0
        for r in rows:
            n, unread = n + r["n"], unread + r["nulls"]
            if r["last"] >= r["first"]:
                firsts.append(r["first"])
                lasts.append(r["last"])
        highest = max([highest, *lasts])  # a new head raises it, a late one doesn't
        now, added = absorb(lowest, _Stored(self.buckets), merged(np.asarray(firsts, np.int64), np.asarray(lasts, np.int64)))
        pending += added - (now - lowest)
        self.window.update((now, highest, pending, unread))
        yield self._row(key, now, highest, pending, n - added, unread, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._again(timerValues)
        lowest, highest, pending, unread = self.window.get()
        # A finished window is one past its highest position and has no gap.
        if highest - lowest > self.max_gap:
            yield self._row(key, lowest, highest, pending, 0, unread, True)

    def _again(self, timerValues) -> None:
        if self.interval_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.interval_ms)

    def _row(self, key, lowest, highest, pending, ignored, unread, fired) -> Row:
        return Row(chain=key[0], lowest=lowest, highest=highest, pending=pending, ignored=ignored, crowded=pending > CROWDED, unread=unread, fired=fired)

    def close(self) -> None:
        pass


def stream_watermark(positions: DataFrame, initial: int = 0, interval: float | None = None, max_gap: int = 0) -> DataFrame:
    """Each key's window after each batch of the stream ``positions(chain string, h long)``.

    With an ``interval`` in seconds, also a row with ``fired`` at each such time at which a key's gap is over ``max_gap``.
    """
    ship(positions.sparkSession)
    held = positions.select(F.col("chain").cast("string"), F.col("h").cast("bigint"))
    if interval is not None:
        # A clock without rows: timers are looked at in batches, and a query that starts again has none before something comes.
        clock = positions.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().where("value < 0")
        held = held.unionAll(clock.select(F.lit(None).cast("string"), F.col("value")))
    ranges = held.mapInArrow(_to_ranges, RANGES)
    windows = Windows(initial, None if interval is None else round(1000 * interval), max_gap)
    return ranges.groupBy("chain").transformWithState(windows, RESULT, "Update", "None" if interval is None else "ProcessingTime")


def stream_offset_window(messages: DataFrame) -> DataFrame:
    """The same for the offsets of each partition; ``lowest`` is the next offset to commit."""
    key = F.concat_ws("/", "topic", F.col("partition").cast("string"))
    return stream_watermark(messages.select(key.alias("chain"), F.col("offset").alias("h")))


def distinct_messages(messages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each (topic, partition, offset) once, for repeats within the delay of event time."""
    return messages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])


def checkpoint_sink(path: str, now: Callable[[int], int], retries: int = 3, wait: float = 1.0) -> Callable[[DataFrame, int], None]:
    """A batch function that writes (chain, lowest, time), and tries again a bounded number of times, waiting twice as long each time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("chain", F.col("lowest").alias("lowest_unprocessed_block"), F.lit(now(batch_id)).cast("bigint").alias("timestamp"))
        for tried in range(retries + 1):
            try:
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
                return
            except Exception:
                if tried == retries:
                    raise
                time.sleep(wait * 2**tried)

    return write


def gap_alerts(windows: DataFrame, max_gap: int) -> DataFrame:
    """Windows of a batch or a stream with their backlog, and whether it is over the limit."""
    gap = F.col("highest") - F.col("lowest")
    return windows.select("chain", "lowest", "highest", gap.alias("gap"), (gap > max_gap).alias("alert"))


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, as maps and timers need it; the session's setting is as before then."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def start(stream: DataFrame, root: str, write: Callable[[DataFrame, int], None], mode: str = "append", interval: str | None = None) -> StreamingQuery:
    """Hands each batch to ``write``: over what is there now, or with an ``interval`` again and again until it is stopped."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    with rocksdb(stream.sparkSession):
        return stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{root}/_stream").trigger(**trigger).start()


def arrived(query: StreamingQuery) -> int | None:
    """Messages of the last batch, without the clock's rows; None before the first batch."""
    last = query.lastProgress
    return None if last is None else sum(s["numInputRows"] for s in last["sources"] if not s["description"].startswith("RateStream"))


def until(query: StreamingQuery, done: Callable[[], bool], seconds: float = 300) -> None:
    """Waits until ``done``, for as long as the query runs and no longer than ``seconds``."""
    limit = time.time() + seconds
    while not done():
        if not query.isActive:
            query.awaitTermination()
            raise RuntimeError("the stream ended first")
        if time.time() > limit:
            raise TimeoutError(f"not within {seconds} seconds")
        time.sleep(0.1)

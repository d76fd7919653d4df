"""Positions in sequence: contiguous watermarks, gaps, claims, running values.

A chain may have billions of positions, so no window here orders a whole chain.  Positions fall into buckets of ``BUCKET`` and are bitmaps there
(``bitmaps``); what crosses their borders is one row for each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomchain.operators import bitmaps as B

BUCKET = B.SIZE


def _ahead(positions: DataFrame, bounds: DataFrame, size: int) -> DataFrame:
    """Bitmaps of the positions from each chain's lowest on."""
    return B.bitmaps(positions.join(bounds.select("chain", "lowest"), "chain").where("h >= lowest").select("chain", "h"), size)


def contiguous_watermark(positions: DataFrame, bounds: DataFrame, size: int = BUCKET) -> DataFrame:
    """(chain, watermark): the smallest h >= lowest that ``positions(chain, h)`` lacks, for each row of ``bounds(chain, lowest)``."""
    return _watermark(_ahead(positions, bounds, size), bounds, size)


def _watermark(ahead: DataFrame, bounds: DataFrame, size: int) -> DataFrame:
    """From bitmaps: whole buckets are counted, and of the first one that is not full the first position that lacks is looked for."""
    low = bounds.select("chain", "lowest", B.bucket_of("lowest", size).alias("first"))
    counts = ahead.select("chain", "bucket", "n").join(low, "chain")
    wanted = F.when(F.col("bucket") == F.col("first"), (F.col("first") + 1) * size - F.col("lowest")).otherwise(F.lit(size))
    # Buckets are full from the first on as long as the k-th full one is number k: one row for each bucket meets here, not each position.
    by_chain = Window.partitionBy("chain").orderBy("bucket")
    full = counts.where(F.col("n") == wanted).withColumn("nth", F.row_number().over(by_chain) - 1).where("nth = bucket - first")
    done = full.groupBy("chain").agg((F.max("bucket") + 1).alias("open"))
    at = low.join(done, "chain", "left").select("chain", "lowest", F.coalesce("open", "first").alias("bucket"))
    at = at.withColumns({"low": F.greatest(F.col("lowest"), F.col("bucket") * size), "high": (F.col("bucket") + 1) * size - 1})
    lacks = B.absent(at.join(ahead.select("chain", "bucket", "bits"), ["chain", "bucket"], "left"), size)
    return lacks.groupBy("chain").agg(F.min("h").alias("watermark"))


def gap_ranges(positions: DataFrame, bounds: DataFrame, size: int = BUCKET) -> DataFrame:
    """(chain, first, last) of the missing intervals between lowest and highest of ``bounds``, found along one bitmap for each bucket."""
    # Runs inside a bucket meet where one ends with a bucket and the next begins with one.
    runs = B.absent_runs(bounds, B.bitmaps(positions, size), size)
    edge = (F.col("first") == F.col("bucket") * size) | (F.col("last") == (F.col("bucket") + 1) * size - 1)
    by_chain = Window.partitionBy("chain").orderBy("first")
    # At most two runs of a bucket touch its borders.
    ends = runs.where(edge).withColumn("fresh", F.coalesce(F.col("first") != F.lag("last").over(by_chain) + 1, F.lit(True)).cast("int"))
    joined = ends.withColumn("nth", F.sum("fresh").over(by_chain)).groupBy("chain", "nth").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.where(~edge).select("chain", "first", "last").unionAll(joined.select("chain", "first", "last"))


def heights(bounds: DataFrame, size: int = BUCKET) -> DataFrame:
    """(chain, h) of every height in the bounds, made in pieces of a bucket, so that no task makes a whole chain."""
    pieces = bounds.select("chain", "lowest", "highest", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("highest") - F.col("lowest")) / size).cast("bigint"))).alias("k"))
    spread = pieces.repartition("chain", "k")
    low = F.col("lowest") + F.col("k") * size
    return spread.where("highest >= lowest").select("chain", F.explode(F.sequence(low, F.least(low + size - 1, F.col("highest")))).alias("h"))


def missing_heights(bounds: DataFrame, processed: DataFrame, inflight: DataFrame, size: int = BUCKET) -> DataFrame:
    """Heights in the bounds that are neither processed nor in flight."""
    return B.missing(bounds, B.bitmaps(processed.select("chain", "h").unionAll(inflight.select("chain", "h")), size), size)


def claimable(wanted: DataFrame, bounds: DataFrame, processed: DataFrame, inflight: DataFrame) -> DataFrame:
    """Of ``wanted(chain, h)``, those inside the bounds that nobody has done or claimed."""
    inside = wanted.join(bounds, "chain").where("h BETWEEN lowest AND highest").select("chain", "h").distinct()
    return inside.join(processed, ["chain", "h"], "left_anti").join(inflight, ["chain", "h"], "left_anti")


def height_state(wanted: DataFrame, bounds: DataFrame, processed: DataFrame) -> DataFrame:
    """below (counts as processed), processed, pending or above (an error) for each height."""
    done = processed.distinct().withColumn("done", F.lit(True))
    state = F.when(F.col("h") < F.col("lowest"), "below").when(F.col("h") > F.col("highest"), "above").when(F.col("done"), "processed").otherwise("pending")
    return wanted.join(bounds, "chain").join(done, ["chain", "h"], "left").select("chain", "h", state.alias("state"))


def backfill_plan(bounds: DataFrame, taken: DataFrame, n: int, chunk: int, size: int = BUCKET) -> DataFrame:
    """(chain, h, chunk): each chain's n lowest heights that nobody has done or claimed, in chunks of work; ``taken(chain, h)`` are the others.

    Counts by bucket and their running sum say which buckets hold a chain's first n; only these are expanded and ordered.
    """
    lacks = B.lacking(bounds, B.bitmaps(taken, size), size)
    before = Window.partitionBy("chain").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = lacks.where("n > 0").select("chain", "bucket", "n").withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    chosen = counts.where(F.col("before") < n).select("chain", "bucket", "before")
    found = B.absent(lacks.join(chosen, ["chain", "bucket"], "left_semi"), size).withColumn("bucket", B.bucket_of("h", size))
    # Places are counted inside a bucket, behind those of the buckets before.
    nth = F.row_number().over(Window.partitionBy("chain", "bucket").orderBy("h")) - 1 + F.col("before")
    return found.join(chosen, ["chain", "bucket"]).withColumn("nth", nth).where(F.col("nth") < n).select("chain", "h", F.floor(F.col("nth") / chunk).cast("bigint").alias("chunk"))


def reset_window(processed: DataFrame, bounds: DataFrame, new_lowest: DataFrame) -> DataFrame:
    """Members at or above a new lowest; rows of ``new_lowest(chain, new_lowest)`` above the highest change nothing."""
    now = bounds.join(new_lowest, "chain", "left").select("chain", F.when(F.col("new_lowest") <= F.col("highest"), F.col("new_lowest")).otherwise(F.col("lowest")).alias("from_height"))
    return processed.join(now, "chain").where("h >= from_height").select("chain", "h", "from_height")


def window_snapshot(processed: DataFrame, bounds: DataFrame, size: int = BUCKET) -> DataFrame:
    """(chain, lowest, highest, pending): the watermark, the highest height and the processed heights that wait behind a gap."""
    ahead = _ahead(processed, bounds, size)
    mark = _watermark(ahead, bounds, size)
    waiting = B.count_from(ahead, mark.select("chain", F.col("watermark").alias("mark")), size).withColumnRenamed("n", "pending")
    return bounds.select("chain", "highest").join(mark, "chain").join(waiting, "chain", "left").select("chain", F.col("watermark").alias("lowest"), "highest", F.coalesce("pending", F.lit(0)).alias("pending"))


def gap_report(snapshot: DataFrame, max_gap: int) -> DataFrame:
    """Backlog of each window; lowest one past highest is a finished window, beyond that the window is inconsistent."""
    gap = F.when(F.col("lowest") > F.col("highest"), 0).otherwise(F.col("highest") - F.col("lowest"))
    return snapshot.select("chain", "lowest", "highest", gap.cast("bigint").alias("gap"), (F.col("lowest") > F.col("highest") + 1).alias("inconsistent"), (gap > max_gap).alias("alert"))


def offset_commit(offsets: DataFrame, initial: DataFrame, size: int = BUCKET) -> DataFrame:
    """Per partition of ``offsets(partition, offset)``: the end of the run behind the committed offset, and what still waits.

    The watermark never moves back.  ``initial(partition, committed)`` gives the offset committed so far.
    """
    bounds = initial.select(F.col("partition").alias("chain"), (F.col("committed") + 1).alias("lowest"))
    ahead = _ahead(offsets.select(F.col("partition").alias("chain"), F.col("offset").alias("h")), bounds, size)
    marks = _watermark(ahead, bounds, size)
    waiting = B.count_from(ahead, marks.select("chain", F.col("watermark").alias("mark")), size)
    found = marks.join(waiting, "chain", "left")
    return found.select(F.col("chain").alias("partition"), (F.col("watermark") - 1).alias("committed"), F.coalesce("n", F.lit(0)).alias("pending"))


def running(rows: DataFrame, keys: list[str], bucket: Column, order: list[str], value: Column, how: str, name: str) -> DataFrame:
    """Adds the running sum or maximum of ``value`` along ``order``: inside each bucket first, then with what the earlier buckets carry.

    ``bucket`` must rise with the order.  Earlier buckets' totals are one row for each.
    """
    total, seed = {"sum": (F.sum, F.lit(0)), "max": (F.max, F.lit(None))}[how]
    placed = rows.withColumns({"_bucket": bucket, "_value": value})
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn("_local", total("_value").over(inside))
    totals = placed.groupBy(*keys, "_bucket").agg(total("_value").alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.withColumn("_carried", total("_total").over(before)).drop("_total")
    both = local.join(carried, [*keys, "_bucket"])
    result = F.col("_local") + F.coalesce("_carried", seed) if how == "sum" else F.greatest("_local", "_carried")
    return both.withColumn(name, result).drop("_bucket", "_value", "_local", "_carried")


def numbered(rows: DataFrame, keys: list[str], bucket: Column, order: list[str], name: str) -> DataFrame:
    """Adds each row's place, from 0, along ``order`` among the rows with its keys; no window is longer than a bucket."""
    return running(rows, keys, bucket, order, F.lit(1), "sum", "_place").withColumn(name, (F.col("_place") - 1).cast("bigint")).drop("_place")


def previous(rows: DataFrame, keys: list[str], bucket: Column, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the value of the row before along ``order``: from the same bucket, or the last one of the bucket before."""
    placed = rows.withColumns({"_bucket": bucket, "_value": value})
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    local = placed.withColumns({"_nth": F.row_number().over(inside), "_before": F.lag("_value").over(inside)})
    lasts = placed.groupBy(*keys, "_bucket").agg(F.max_by("_value", F.struct(*order)).alias("_last"))
    carried = lasts.withColumn("_carried", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket"))).drop("_last")
    both = local.join(carried, [*keys, "_bucket"])
    return both.withColumn(name, F.when(F.col("_nth") == 1, F.col("_carried")).otherwise(F.col("_before"))).drop("_bucket", "_value", "_nth", "_before", "_carried")

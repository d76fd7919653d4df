"""Joins, aggregates and set operations over blocks, transactions and offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def receipt_join(transactions: DataFrame, receipts: DataFrame) -> DataFrame:
    """Each transaction with the receipt at its position."""
    return transactions.join(receipts, ["block_number", "transaction_index"])


def receipt_mismatch(transactions: DataFrame, receipts: DataFrame) -> DataFrame:
    """Blocks whose counts of transactions and receipts differ."""
    t = transactions.groupBy("block_number").agg(F.count("*").alias("n_transactions"))
    r = receipts.groupBy("block_number").agg(F.count("*").alias("n_receipts"))
    both = t.join(r, "block_number", "full_outer").select("block_number", F.coalesce("n_transactions", F.lit(0)).alias("n_transactions"), F.coalesce("n_receipts", F.lit(0)).alias("n_receipts"))
    return both.where("n_transactions <> n_receipts")


def reconcile(expected: DataFrame, stored: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, status, differing fields) of every key that is not alike on both sides."""
    e, s = expected.select(key, F.lit(True).alias("_e"), *(F.col(f).alias(f"_e_{f}") for f in fields)), stored.select(key, F.lit(True).alias("_s"), *(F.col(f).alias(f"_s_{f}") for f in fields))
    both = e.join(s, key, "full_outer")
    differing = F.concat_ws(",", *(F.when(~F.col(f"_e_{f}").eqNullSafe(F.col(f"_s_{f}")), f) for f in fields))
    status = F.when(F.col("_s").isNull(), "missing").when(F.col("_e").isNull(), "extra").when(differing != "", "mismatch").otherwise("ok")
    return both.select(key, status.alias("status"), F.when(status == "mismatch", differing).otherwise("").alias("fields"))


def range_digests(rows: DataFrame, key: str, fields: list[str], span: int = 4096) -> DataFrame:
    """(range, n, h1, h2): order-free sums of row hashes for each range of ``span`` keys.  They can be kept with a table and added up, batch by batch."""
    # A NULL leaves no mark in a hash, so that which fields are NULL is hashed as well.
    content = [F.col(key), *(F.col(f) for f in fields), *(F.col(f).isNull() for f in fields)]
    hashed = rows.select(F.floor(F.col(key) / span).cast("bigint").alias("range"), F.xxhash64(*content).alias("a"), F.xxhash64(F.lit(1), *content).alias("b"))
    return hashed.groupBy("range").agg(F.count("*").alias("n"), F.sum(F.col("a").cast("decimal(38,0)")).alias("h1"), F.sum(F.col("b").cast("decimal(38,0)")).alias("h2"))


def differing_ranges(expected: DataFrame, stored: DataFrame, widths: tuple[int, ...] = (4096, 64, 1)) -> DataFrame:
    """(range) of those whose digests differ, from the top of a tree down: below a node that agrees nothing is compared."""

    def level(digests: DataFrame, width: int, within: DataFrame | None, above: int) -> DataFrame:
        if within is not None:
            digests = digests.withColumn("_above", F.floor(F.col("range") / above).cast("bigint")).join(within, F.col("_above").eqNullSafe(F.col("node")), "left_semi").drop("_above")
        return digests.groupBy(F.floor(F.col("range") / width).cast("bigint").alias("node")).agg(*(F.sum(c).alias(c) for c in ("n", "h1", "h2")))

    differ, above = None, 1
    for width in widths:
        e, s = level(expected, width, differ, above), level(stored, width, differ, above).select(*(F.col(c).alias(f"_{c}") for c in ("node", "n", "h1", "h2")))
        both = e.join(s, F.col("node").eqNullSafe(F.col("_node")), "full_outer")
        same = F.col("n").eqNullSafe(F.col("_n")) & F.col("h1").eqNullSafe(F.col("_h1")) & F.col("h2").eqNullSafe(F.col("_h2"))
        differ, above = both.where(~same).select(F.coalesce("node", "_node").alias("node")), width
    return differ.select(F.col("node").alias("range"))


def reconcile_ranges(expected: DataFrame, stored: DataFrame, key: str, fields: list[str], digests: tuple[DataFrame, DataFrame] | None = None, span: int = 4096) -> DataFrame:
    """(key, status, differing fields) of the keys that are not alike on both sides; only ranges whose digests differ are joined.

    ``digests`` are those of both sides where they are kept; else both tables are read once more for them, by key and fields.
    """
    e, s = digests or (range_digests(expected, key, fields, span), range_digests(stored, key, fields, span))
    differ = differing_ranges(e, s)
    inside = lambda rows: rows.withColumn("_range", F.floor(F.col(key) / span).cast("bigint")).join(differ, F.col("_range").eqNullSafe(F.col("range")), "left_semi").drop("_range")
    return reconcile(inside(expected), inside(stored), key, fields).where("status <> 'ok'")


def with_header(children: DataFrame, headers: DataFrame, columns: list[str]) -> DataFrame:
    """Block fields on each child row.  The planner sends the headers if their size allows it and shuffles them otherwise."""
    return children.join(headers.select("block_number", *columns), "block_number")


def keep_latest(rows: DataFrame, keys: list[str], sequence: list[str], columns: list[str] | None = None) -> DataFrame:
    """The row with the largest sequence of each key.  Aggregated, not windowed: each task sends one row for a key.

    ``columns`` are those wanted beside the keys, all others by default: what is not asked for is neither carried along nor read.
    """
    wanted = [c for c in rows.columns if c not in keys] if columns is None else columns
    if not wanted:
        return rows.select(*keys).distinct()
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*wanted), F.struct(*sequence)).alias("_row")).select(*keys, "_row.*")


def latest_checkpoint(checkpoints: DataFrame, wanted: DataFrame) -> DataFrame:
    """(chain_id, lowest, exists) for each wanted chain; the newest row counts, of equal times the larger position."""
    newest = checkpoints.groupBy("chain_id").agg(F.max(F.struct("timestamp", "lowest_unprocessed_block")).alias("m"))
    return wanted.join(newest, "chain_id", "left").select("chain_id", F.coalesce("m.lowest_unprocessed_block", F.lit(0)).alias("lowest"), F.col("m").isNotNull().alias("exists"))


def partition_lag(offsets: DataFrame, committed: DataFrame, initial: DataFrame) -> DataFrame:
    """Per partition: messages consumed since the start, and how far the commit is behind the log's end."""
    ends = offsets.groupBy("partition").agg((F.max("offset") + 1).alias("high"))
    joined = ends.join(committed, "partition", "left").join(initial, "partition", "left")
    now, first = F.coalesce("committed", F.lit(0)), F.coalesce("initial", F.lit(0))
    return joined.select("partition", "high", (now - first).alias("consumed"), F.greatest(F.col("high") - now, F.lit(0)).alias("lag"))


def failed_heights(attempts: DataFrame, max_failures: int) -> DataFrame:
    """Heights with at least so many failures after their last success; the next try waits as many seconds as there were failures."""
    last = F.max(F.when(F.col("ok"), F.col("seq")))
    by_height = Window.partitionBy("h")
    after = attempts.withColumn("_last", last.over(by_height)).where("NOT ok AND (_last IS NULL OR seq > _last)")
    return after.groupBy("h").agg(F.count("*").alias("failures")).where(F.col("failures") >= max_failures).withColumn("retry_seconds", F.col("failures"))


def commit_progress(watermarks: DataFrame) -> DataFrame:
    """Of (chain, batch, lowest): positions committed, and batches that advanced the watermark."""
    step = F.col("lowest") - F.coalesce(F.lag("lowest").over(Window.partitionBy("chain").orderBy("batch")), F.col("lowest"))
    steps = watermarks.withColumn("step", step)
    return steps.groupBy("chain").agg(F.sum("step").alias("committed"), F.count_if(F.col("step") > 0).alias("advances"), F.max("lowest").alias("lowest"))


def merge(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Union without duplicates: inserting twice changes nothing."""
    return old.select(*keys).unionByName(new.select(*keys)).distinct()


def resume_plan(wanted: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Start and end of each chain's next run: explicit start, else its checkpoint, else 0, and never past the end."""
    both = wanted.join(checkpoint, "chain_id", "left")
    start = F.coalesce("explicit_start", F.when(F.col("exists"), F.col("lowest")), F.lit(0))
    return both.select("chain_id", F.least(start, F.col("end")).cast("bigint").alias("start"), "end")


def start_offsets(committed: DataFrame, log: DataFrame, policy: str) -> DataFrame:
    """Where reading starts in each partition of ``log(partition, low, high)``: the commit if the log still has it, else by policy."""
    valid = F.col("committed").isNotNull() & (F.col("committed") >= F.col("low"))
    fallback: Column = {"earliest": F.col("low"), "latest": F.col("high"), "none": F.lit(None).cast("bigint")}[policy]
    both = log.join(committed, "partition", "left")
    return both.select("partition", F.when(valid, F.col("committed")).otherwise(fallback).alias("start"), (~valid).alias("reset"))


def starting_offsets_json(starts: DataFrame, topic: str) -> str:
    """The ``startingOffsets`` option; one number for each partition comes to the driver."""
    inner = starts.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("partition").cast("string"), "start"))))).first()[0]
    return f'{{"{topic}": {inner}}}'

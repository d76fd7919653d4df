"""Counters, histograms, rates, ratios and quantiles over metric samples, as aggregates over time windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomchain.operators.ranges import previous, running

# The upper bounds of the latency buckets, in seconds.
BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
LONG_BOUNDS = (*BOUNDS, 30.0)
INFINITE = float("inf")


def constant_labels(labels: Column, constants: dict[str, str]) -> Column:
    """Labels with constant ones added; empty ones are left out, and a sample's own label stays."""
    fixed = F.create_map(*(F.lit(x) for kv in constants.items() for x in kv))
    own = F.map_filter(fixed, lambda k, v: (v != "") & ~F.array_contains(F.map_keys(labels), k))
    return F.map_filter(F.map_concat(labels, own), lambda k, v: v != "")


def counters(samples: DataFrame, keys: list[str]) -> DataFrame:
    return samples.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "error").alias("errors"), F.sum(F.round(F.col("seconds") * 10000).cast("bigint")).alias("units"))


def cumulative_histogram(samples: DataFrame, keys: list[str], value: str, bounds: tuple[float, ...]) -> DataFrame:
    """(keys, le, c, n): the samples at or under each bound and all of them; one aggregate row for a key, then one for a bound."""
    counts = [F.count_if(F.col(value) <= b).alias(f"c{i}") for i, b in enumerate(bounds)]
    wide = samples.groupBy(*keys).agg(*counts, F.count(value).alias("n"))
    each = F.array(*(F.struct(F.lit(b).alias("le"), F.col(f"c{i}").alias("c")) for i, b in enumerate(bounds)), F.struct(F.lit(INFINITE).alias("le"), F.col("n").alias("c")))
    return wide.select(*keys, "n", F.explode(each).alias("b")).select(*keys, F.col("b.le").alias("le"), F.col("b.c").alias("c"), "n")


def quantile(histogram: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Linear interpolation inside the first bucket that reaches q of all; the last bucket gives its lower bound."""
    order = Window.partitionBy(*keys).orderBy("le")
    steps = histogram.withColumns({"lo": F.coalesce(F.lag("le").over(order), F.lit(0.0)), "before": F.coalesce(F.lag("c").over(order), F.lit(0))})
    first = steps.where(F.col("c") >= q * F.col("n")).groupBy(*keys).agg(F.min_by(F.struct("lo", "le", "before", "c", "n"), "le").alias("b"))
    inside = F.col("b.lo") + (F.col("b.le") - F.col("b.lo")) * (q * F.col("b.n") - F.col("b.before")) / (F.col("b.c") - F.col("b.before"))
    value = F.when(F.col("b.n") == 0, F.lit(None)).when(F.col("b.le") == INFINITE, F.col("b.lo")).when(F.col("b.c") == F.col("b.before"), F.col("b.lo")).otherwise(inside)
    return first.select(*keys, F.round(value, 6).alias("value"))


def increases(counter: DataFrame, keys: list[str], order: list[str], bucket_seconds: int = 3600) -> DataFrame:
    """The increase at each sample of a counter (columns ts, v): a fall is a restart from zero, and the first sample counts nothing.

    A label with very many samples is ordered hour by hour, not as a whole.
    """
    found = previous(counter, keys, F.floor(F.unix_timestamp("ts") / bucket_seconds), order, F.col("v"), "_previous")
    before = F.col("_previous")
    return found.withColumn("increase", F.when(before.isNull(), 0).when(F.col("v") >= before, F.col("v") - before).otherwise(F.col("v"))).drop("_previous")


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def _seconds(duration: str) -> int:
    n, unit = duration.split()
    return int(n) * _UNITS[unit.rstrip("s")]


def windowed(samples: DataFrame, keys: list[str], window: str, slide: str, sums: dict[str, Column]) -> DataFrame:
    """(start, keys, sums) over sliding windows of event time, by panes.

    A pane is as long as window and slide have in common.  A sample is summed once, in its pane, and a pane's few sums go to each window that it is part of.
    Samples without a time are in no window.
    """
    long, step = _seconds(window), _seconds(slide)
    pane = math.gcd(long, step)
    at = F.floor(F.unix_timestamp("ts") / pane).cast("bigint") * pane
    by_pane = samples.where("ts IS NOT NULL").groupBy(at.alias("_pane"), *keys).agg(*(c.alias(name) for name, c in sums.items()))
    last = F.floor(F.col("_pane") / step).cast("bigint") * step
    starts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(-(-long // step) - 1)), lambda k: last - k * step), lambda s: s > F.col("_pane") - long)
    return by_pane.withColumn("start", F.explode(starts)).groupBy("start", *keys).agg(*(F.sum(name).alias(name) for name in sums))


def rate(increased: DataFrame, keys: list[str], window: str, slide: str, seconds: int) -> DataFrame:
    """Increase per second over sliding windows of event time, without extrapolation at the edges."""
    return windowed(increased, keys, window, slide, {"increase": F.sum("increase")}).withColumn("rate", F.round(F.col("increase") / seconds, 6))


def ratio(samples: DataFrame, window: str, condition: Column, keys: list[str], slide: str | None = None) -> DataFrame:
    """Share of the samples that meet a condition, per window; windows tumble unless they have a ``slide``."""
    by_window = windowed(samples, keys, window, slide or window, {"part": F.count_if(condition), "n": F.count("*")})
    return by_window.select("start", *keys, "part", "n", F.round(F.col("part") / F.col("n"), 6).alias("ratio"))


def in_flight(changes: DataFrame, keys: list[str], bucket_seconds: int = 3600) -> DataFrame:
    """Running number of started and not yet ended operations along (at, seq) of ``changes(at, seq, delta)``."""
    return running(changes, keys, F.floor(F.col("at") / bucket_seconds), ["at", "seq"], F.col("delta"), "sum", "in_flight")

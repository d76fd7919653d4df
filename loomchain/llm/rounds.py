"""Links between texts that share a bucket, each verified, without listing a bucket's pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomchain.llm.common import cut, free, is_small, sent
from loomchain.llm.components import components, contracted, named

#: Members of a bucket that all others are compared with in the rounds before the last, in which all others are.
REPRESENTATIVES = (3, 64)
#: What a member may have beside its number: how many elements its set has, and of each of 512 cells whether it holds an odd number of them.
#: The cells are told by the upper half of an element's hash, of which sets are compared.
SKETCH = ["n", *(f"s{i}" for i in range(8))]

#: Rounds of contraction that name classes before the last round.
PASSES = 2
#: Pairs that a task gathers before it gives them.
PAIRS_HELD = 8192


def linked(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], similarity: float | None = None, native: bool = False) -> tuple[DataFrame, DataFrame]:
    """(links (a, b), classes (node, root)) among the members of ``buckets(key, t1, ...)``, numbers; ``verify`` keeps of pairs (a, b) those that count.

    Two members of a bucket are asked about unless they are in one class already, or can't have the ``similarity`` by their ``SKETCH``, so classes are those of
    all pairs.  The first rounds ask about a few representatives of each bucket, least by hashes that are the same in all buckets; so a group of copies
    is one class at the cost of its size, and the last round, which asks about whatever is left, has little to ask.  With ``native`` the pairs come from joins instead of Python.  All is done
    when this returns: ``buckets`` is read no more.
    """
    spark = buckets.sparkSession
    found, classes = spark.createDataFrame([], "a long, b long"), spark.createDataFrame([], "node long, root long")
    links = found
    members = buckets.select("key", F.col("t1").cast("long").alias("t1"), *(SKETCH if similarity else [])).distinct()
    several = members.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    members = cut(members.join(several, "key", "left_semi"), "buckets")
    for nth, most in enumerate([*REPRESENTATIVES, None]):
        placed = members.join(sent(classes, is_small(classes)), F.col("t1") == F.col("node"), "left").drop("node").withColumn("root", F.coalesce("root", "t1"))
        if native:
            asked = pairs_by_joins(placed, most, nth, similarity)
        else:
            dealt = placed.withColumn("key", F.xxhash64("key")).repartition("key").sortWithinPartitions("key")
            asked = dealt.mapInArrow(_across(most, nth, similarity), "a long, b long")
        pairs = cut(asked.distinct(), "pairs")
        if not pairs.isEmpty():
            good = cut(verify(pairs), "verified")
            if not good.isEmpty():
                found = found.unionAll(good)
                # The links so far are kept as stars, which connect the same.  Until the last round it is enough that what has one root is connected.
                last, links = (links, classes), contracted(links.unionAll(good), PASSES)
                classes = cut(named(links).groupBy("node").agg(F.min("root").alias("root")), "classes")
                for held in last:
                    free(held)
        free(pairs)
    free(members)
    free(classes)
    classes = cut(components(links), "classes")
    free(links)
    return found, classes


def verified_links(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], similarity: float | None = None) -> DataFrame:
    return linked(buckets, verify, similarity)[0]


def needed(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``sets(t1, ...)`` that ``pairs(a, b)``, a written table, name."""
    ends = pairs.select(F.col("a").alias("t1")).distinct().unionAll(pairs.select(F.col("b").alias("t1")).distinct())
    return sets.join(sent(ends, is_small(pairs)), "t1", "left_semi")


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Columns t1, root and SKETCH of each bucket, from batches sorted by key; a batch's last bucket waits for the next."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.schema.names], axis=1)
        for part in np.split(rows, np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1):
            if held and len(part) and held[0][0, 0] != part[0, 0]:
                yield np.concatenate(held)
                held = []
            if len(part):
                held.append(part)
    if held:
        yield np.concatenate(held)


def pairs_across(t1: np.ndarray, root: np.ndarray, sketch: np.ndarray, most: int | None, nth: int, similarity: float | None) -> Iterator[tuple[int, np.ndarray]]:
    """(a member, others) that may be similar and are not in one class; with ``most``, of so many representatives with all others."""
    if (root == root[0]).all():
        return
    if most is None:
        # The largest class comes last, and its members are compared with no other from here.
        _, at, sizes = np.unique(root, return_inverse=True, return_counts=True)
        order = np.lexsort((root, sizes[at]))
        asking = int((root[order] != root[order[-1]]).sum())
    else:
        order = np.argsort([xxhash.xxh64_intdigest(int(x).to_bytes(8, "little", signed=True), nth) for x in t1])
        asking = min(most, len(t1))
    t1, root, n, bits = t1[order], root[order], sketch[order, :1].ravel(), np.ascontiguousarray(sketch[order, 1:]).view(np.uint64)
    for i in range(asking):
        at = i + 1 + np.flatnonzero(root[i + 1 :] != root[i])
        if similarity and len(at):
            # Sets of these sizes and of this similarity differ in so many elements at most, and each cell that differs holds one of them.
            apart = np.bitwise_count(bits[at] ^ bits[i]).sum(axis=1, dtype=np.int64)
            at = at[apart * (1 + similarity) <= (n[at] + n[i]) * (1 - similarity) + 1e-6]
        if len(at):
            yield t1[i], t1[at]


def pairs_by_joins(placed: DataFrame, most: int | None, nth: int, similarity: float | None) -> DataFrame:
    """What ``pairs_across`` gives for all buckets of ``placed(key, t1, root, ...)``, as (a, b), a > b, by DataFrame functions; pairs may repeat."""
    if most:
        order = Window.partitionBy("key").orderBy(F.xxhash64("t1", F.lit(nth)), "t1")
        asking = placed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    else:
        sizes = placed.groupBy("key", "root").agg(F.count("*").alias("size"))
        largest = sizes.groupBy("key").agg(F.max_by("root", F.struct("size", "root")).alias("largest"))
        asking = placed.join(largest, "key").where("root <> largest")
    columns = SKETCH if similarity else []
    asking = asking.select("key", *(F.col(c).alias(f"{c}_asking") for c in ["t1", "root", *columns]))
    meet = F.col("root") != F.col("root_asking")
    if similarity:
        apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_asking"))) for c in SKETCH[1:]), F.lit(0))
        meet = meet & (apart * (1 + similarity) <= (F.col("n") + F.col("n_asking")) * (1 - similarity) + 1e-6)
    return placed.join(asking, "key").where(meet).select(F.greatest("t1", "t1_asking").alias("a"), F.least("t1", "t1_asking").alias("b"))


def _across(most: int | None, nth: int, similarity: float | None) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, held = [], [], 0
        for rows in _buckets(batch.select(["key", "t1", "root", *(SKETCH if similarity else [])]) for batch in batches):
            for one, others in pairs_across(rows[:, 1], rows[:, 2], rows[:, 3:], most, nth, similarity):
                a.append(np.maximum(one, others))
                b.append(np.minimum(one, others))
                held += len(others)
                if held >= PAIRS_HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
                    a, b, held = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run

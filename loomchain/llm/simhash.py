"""SimHash near-duplicates, with candidates pruned by chains of segments on a ring.

A fingerprint of 64 bits falls into ``SEGMENTS`` segments on a ring.  Two that differ in at most ``threshold`` bits have a segment from
which every chain of l segments differs in at most l * threshold / SEGMENTS bits.  A pair counts as a candidate only if some chain keeps
all its budgets, and only candidates get the full Hamming check.

With at most four differing bits three of the seven segments are equal.  Distinct fingerprints are dealt by each pair of equal segments
that may be the first two of them.  The few buckets with more than ``LARGE`` fingerprints are dealt again, by a third equal segment as
well, so that none is walked that is long because of two frequent segments.  Small buckets are compared as arrays; longer ones are
walked from fingerprint to near fingerprint, each one leaving the rest once reached, with one link for each reached one.  So a group of
thousands of copies costs its size, not its square, and no bucket lists its pairs.  Equal fingerprints are one node.

Components come from links between fingerprints.  A node is its smallest document and its fingerprint, and so is a component's root:
what a fingerprint's component is called comes with its root, and no join gathers a component.

``one_of_each``, which the pipeline runs, also catches near copies that differ in more bits: texts whose five-word shingles have a Jaccard similarity of
``SIMILARITY`` or more.  MinHash bands of these shingles propose them (a pair of that similarity shares a band with a probability of 0.9996), and every
proposal is verified by the shingles themselves, in rounds (``rounds``).

Null or blank text: fingerprint zero, linked like any other.  A very long text is hashed whole.  Rows are judged alone: repeated rows and
doc_ids each give their row.  A null doc_id is never a component_id unless its whole component has none.  Other columns, whatever their
names, are not read.  Empty table: empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import cut, free, give_back, rows_of, table, texts
from loomchain.llm.components import components
from loomchain.llm.rounds import SKETCH, linked, needed

U = np.uint64
SHINGLE = 4
SEED = 42
THRESHOLD = 4
SEGMENTS = 7
#: Fingerprints in a bucket of two segments from which on it is dealt by a third one.
LARGE = 4096
#: Fingerprints in a bucket up to which all are compared at once.
SMALL = 48
#: Keys of rows (28 bytes each at most) that are sent to the tasks; more are joined.
KEYS_SENT = 1_000_000

#: The similarity that near copies must have, and the words of their shingles.
SIMILARITY, SIMILAR_SHINGLE = 0.8, 5
#: MinHash bands of near copies, and their rows.
BANDS, BAND_ROWS = 20, 5

_WIDTHS = [10, 9, 9, 9, 9, 9, 9]
_SHIFTS = [0, 10, 19, 28, 37, 46, 55]
_MASKS = [((1 << w) - 1) << s for w, s in zip(_WIDTHS, _SHIFTS)]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    n = max(1, len(words) - shingle + 1)
    last = min(shingle, len(words)) - 1
    view, digest = memoryview(line), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts[:n], ends[last:])), np.uint64, n)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(U)[0])


def _pivots(count: int) -> list[int]:
    """Points of 64 bits, spread by a fixed rule."""
    return [xxhash.xxh64_intdigest(k.to_bytes(4, "little"), SEED) for k in range(count)]


def shingle_hashes(text: bytes) -> np.ndarray:
    """Of the five-word shingles of a text in lower case; a shorter text is one shingle, and one without words has none."""
    words = text.lower().split()
    n = max(1, len(words) - SIMILAR_SHINGLE + 1) if words else 0
    return np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + SIMILAR_SHINGLE]), SEED) for i in range(n)), U, n)


def band_keys(hashes: np.ndarray, pivots: list[int]) -> list[int]:
    """A number for each band: texts that have it in common agree in which hashes are nearest to the band's pivots, by exclusive or."""
    least = [min(int((hashes[at : at + 8192] ^ U(p)).min()) for at in range(0, len(hashes), 8192)) for p in pivots] if len(hashes) else []
    return [_signed(xxhash.xxh64_intdigest(np.array([i, *least[i : i + BAND_ROWS]], U).tobytes(), SEED)) for i in range(0, len(least), BAND_ROWS)]


def compared(hashes: np.ndarray) -> np.ndarray:
    """What of a text's shingles is compared with those of another text: half of each hash."""
    return np.unique((hashes >> U(32)).astype(np.uint32))


def sketched(some: np.ndarray) -> list[int]:
    """The numbers of ``SKETCH``: how many there are, and for each cell whether it holds an odd number of them."""
    odd = np.bincount(some >> np.uint32(23), minlength=512) & 1
    return [len(some), *np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()]


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, held in rows_of(batches):
        prints = np.fromiter((fingerprint(t) for t in held), np.uint64, len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])


def _keyed_fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pivots = _pivots(BANDS * BAND_ROWS)
    for batch in batches:
        prints, keys = np.zeros(batch.num_rows, U), []
        for i, text in enumerate(batch["text"]):
            text = text.as_py()
            prints[i] = fingerprint(text)
            hashes = shingle_hashes(text)
            keys.append(band_keys(hashes, pivots) + sketched(compared(hashes)) if len(hashes) else [])
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints.view(np.int64)), batch["t1"], batch["t2"], pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "fp", "t1", "t2", "keys"])
    give_back()


def fingerprints(docs: DataFrame) -> DataFrame:
    return texts(docs).mapInArrow(_fingerprints, "doc_id long, fp long")


def keeps_budgets(differ: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """Of pairs, given by their differing bits: whether a chain keeps its budget at each of its lengths."""
    apart = [np.bitwise_count(differ & U(m)) for m in _MASKS]
    passed = np.zeros(len(differ), bool)
    for first in range(SEGMENTS):
        at = np.flatnonzero(apart[first] <= threshold // SEGMENTS)
        sums = apart[first][at]
        for l in range(2, SEGMENTS + 1):
            if not len(at):
                break
            sums = sums + apart[(first + l - 1) % SEGMENTS][at]
            keep = sums <= l * threshold // SEGMENTS
            at, sums = at[keep], sums[keep]
        passed[at] = True
    return passed


def _near(differ: np.ndarray, threshold: int) -> np.ndarray:
    """Places of the pairs within the threshold; a chain has to keep its budgets first."""
    at = np.flatnonzero(keeps_budgets(differ, threshold))
    return at[np.bitwise_count(differ[at]) <= threshold]


def _walk(fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is near in a bucket: at most one for each fingerprint."""
    rest, a, b = fps, [], []
    while len(rest):
        open_, rest = [rest[0]], rest[1:]
        while open_ and len(rest):
            one = open_.pop()
            at = _near(rest ^ one, threshold)
            if len(at):
                open_ += list(rest[at])
                a.append(np.full(len(at), one))
                b.append(rest[at])
                rest = np.delete(rest, at)
    none = np.zeros(0, U)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def bucket_links(bucket: np.ndarray, fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within buckets, given as the number of each fingerprint's bucket, equal ones side by side."""
    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    sizes = np.diff(np.concatenate([heads, [len(bucket)]]))
    a, b = [np.zeros(0, U)], [np.zeros(0, U)]
    left = np.repeat(sizes, sizes) - (np.arange(len(bucket)) - np.repeat(heads, sizes)) - 1  # how many follow in the bucket
    left[np.repeat(sizes, sizes) > SMALL] = 0
    for distance in range(1, SMALL):
        at = np.flatnonzero(left >= distance)
        if not len(at):
            break
        near = at[_near(fps[at] ^ fps[at + distance], threshold)]
        a.append(fps[near])
        b.append(fps[near + distance])
    for i in np.flatnonzero(sizes > SMALL):
        for out, found in zip((a, b), _walk(np.sort(fps[heads[i] : heads[i] + sizes[i]]), threshold)):
            out.append(found)
    return np.concatenate(a), np.concatenate(b)


def _pairs_of_segments() -> list[tuple[int, int]]:
    """The pairs that can be the first two of three equal segments."""
    return list(combinations(range(SEGMENTS - 1), 2))


def _walk_buckets(threshold: int):
    """Links of all buckets of a partition that is sorted by bucket; the last bucket of a batch waits for the next."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), np.int64)
        none = np.zeros((4, 0), np.int64)
        for batch in chain(batches, [None]):
            if batch is not None:
                held = np.concatenate([held, [batch[name].to_numpy(zero_copy_only=False).astype(np.int64) for name in ("pair", "third", "key", "fp")]], axis=1)
                if not held.shape[1]:
                    continue
                new = np.concatenate([[True], (held[:3, 1:] != held[:3, :-1]).any(axis=0)])
                end = int(np.flatnonzero(new)[-1])
            else:
                new, end = np.concatenate([np.ones(min(1, held.shape[1]), bool), (held[:3, 1:] != held[:3, :-1]).any(axis=0)]), held.shape[1]
            bucket, kinds = np.cumsum(new[:end]), held[0, :end] // len(_pairs_of_segments())
            for kind in np.unique(kinds).tolist():
                at = kinds == kind
                a, b = bucket_links(bucket[at], np.ascontiguousarray(held[3, :end][at]).view(U), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["kind", "a", "b"])
            held = held[:, end:] if end < held.shape[1] else none

    return run


def links(distinct: DataFrame, threshold: int = THRESHOLD, large: int = LARGE) -> DataFrame:
    """Links (kind, a, b) that connect all fingerprints of ``distinct(kind, fp)`` within the threshold of others of their kind."""
    if threshold > SEGMENTS - 3:
        raise ValueError("three equal segments are certain only up to SEGMENTS - 3 differing bits")
    pairs = _pairs_of_segments()
    masked = lambda *segments: F.col("fp").bitwiseAND(F.lit(_signed(sum(_MASKS[i] for i in segments))))
    keys = [F.struct((F.col("kind") * len(pairs) + k).alias("pair"), masked(i, j).alias("key")) for k, (i, j) in enumerate(pairs)]
    dealt = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.pair", "k.key")
    # Frequent keys are combined in each task; what is over the bound is written, so that the joins know how little it is.
    long = cut(dealt.groupBy("pair", "key").agg(F.count("*").alias("n")).where(F.col("n") > large).select("pair", "key"), "long_buckets")
    thirds = [F.when(F.col("pair") % len(pairs) == k, F.array(*(F.struct(F.lit(z).alias("third"), masked(i, j, z).alias("key")) for z in range(j + 1, SEGMENTS)))) for k, (i, j) in enumerate(pairs)]
    split = dealt.join(long, ["pair", "key"], "left_semi").select("fp", "pair", F.explode(F.coalesce(*thirds)).alias("k")).select("fp", "pair", "k.third", "k.key")
    whole = dealt.join(long, ["pair", "key"], "left_anti").select("fp", "pair", F.lit(-1).alias("third"), "key")
    buckets = whole.unionByName(split).repartition("pair", "third", "key").sortWithinPartitions("pair", "third", "key")
    return buckets.mapInArrow(_walk_buckets(threshold), "kind int, a long, b long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _classes(prints: DataFrame, mark: Column, found: DataFrame) -> DataFrame:
    """(fp, best: the least ``mark`` of its component) for each distinct fingerprint of ``prints``, given the links ``found(a, b)``."""
    # One row for each fingerprint, so that a large group of copies is one when components meet.
    least = prints.groupBy("fp").agg(F.min(mark).alias("mark"))
    node = lambda name, end: least.select(F.col("fp").alias(end), F.struct("mark", "fp").alias(name))
    edges = found.join(node("one", "a"), "a").join(node("two", "b"), "b").select(F.col("one").alias("a"), F.col("two").alias("b"))
    named = components(edges).select(F.col("node.fp").alias("fp"), F.col("root.mark").alias("best"))
    return least.join(named, "fp", "left").select("fp", F.coalesce("best", "mark").alias("best"))


def _shingle_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [compared(shingle_hashes(text.as_py())).tobytes() for text in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["t1"], pa.array(sets, pa.binary())], names=["t1", "shingles"])


def _similar(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for one, two in zip(batch["one"], batch["two"]):
            one, two = np.frombuffer(one.as_py(), np.uint32), np.frombuffer(two.as_py(), np.uint32)
            both = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(both >= SIMILARITY * (len(one) + len(two) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _if_small(keys: DataFrame) -> DataFrame:
    """Marked to be sent if it has at most KEYS_SENT rows; else Spark chooses the join."""
    return F.broadcast(keys) if keys.limit(KEYS_SENT + 1).count() <= KEYS_SENT else keys


def _near_copies(keyed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b: t1 of texts) that connect near copies; ``keyed(t1, text)`` has the texts and ``nodes(t1, keys)`` each distinct one's bands and sketch."""
    buckets = nodes.select("t1", F.explode(F.slice("keys", 1, BANDS)).alias("key"), *(F.get("keys", F.lit(BANDS + i)).alias(c) for i, c in enumerate(SKETCH)))
    several = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = cut(buckets.join(several, "key", "left_semi"), "buckets")
    wanted = _if_small(cut(buckets.select("t1").distinct(), "wanted"))
    sets = cut(keyed.join(wanted, "t1", "left_semi").select("t1", "text").mapInArrow(_shingle_sets, "t1 long, shingles binary").dropDuplicates(["t1"]), "shingles")

    def verify(pairs: DataFrame) -> DataFrame:
        own = needed(sets, pairs)
        side = lambda end, name: own.select(F.col("t1").alias(end), F.col("shingles").alias(name))
        return pairs.join(side("a", "one"), "a").join(side("b", "two"), "b").select("a", "b", "one", "two").mapInArrow(_similar, "a long, b long")

    _, classes = linked(buckets, verify, SIMILARITY)
    free(sets)
    free(buckets)
    return classes.select(F.col("node").alias("a"), F.col("root").alias("b"))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    prints = cut(fingerprints(docs), "fingerprints")
    found = cut(links(prints.select(F.lit(0).alias("kind"), "fp").distinct(), threshold).select("a", "b").distinct(), "links")
    # A row without an id names a component only if it has no other.
    placed = cut(_classes(prints, F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id"), found), "classes")
    return prints.join(placed, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("best.doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all their columns, of which each component keeps one: the smallest doc_id, then the least text hash."""
    keyed = texts(docs).select("doc_id", "text", F.xxhash64(F.col("text").cast("string")).alias("t1"), F.hash(F.col("text").cast("string")).alias("t2"))
    prints = cut(keyed.mapInArrow(_keyed_fingerprints, "doc_id long, fp long, t1 long, t2 int, keys array<long>"), "fingerprints")
    nodes = cut(prints.groupBy("t1").agg(F.min("fp").alias("fp"), F.min("keys").alias("keys")), "texts")
    found = cut(links(nodes.select(F.lit(0).alias("kind"), "fp").distinct(), threshold).select("a", "b").distinct(), "links")
    near = _near_copies(keyed.select("t1", "text"), nodes)
    end = lambda name: nodes.select(F.col("t1").alias(name), F.col("fp").alias(f"fp_{name}"))
    copies = near.join(end("a"), "a").join(end("b"), "b").select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")).where("a <> b")
    linked = cut(found.unionAll(copies).distinct(), "links")
    mark = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "t1", "t2")
    # Written before the join, which is then one of two plain tables: a frequent fingerprint is a skewed key that Spark splits.
    marked = prints.join(cut(_classes(prints, mark, linked), "classes"), "fp").select("doc_id", "t1", "t2", (~mark.eqNullSafe(F.col("best"))).alias("goes"))
    judged = cut(marked.groupBy("doc_id", "t1", "t2").agg(F.max("goes").alias("goes"), F.count("*").alias("n")).where("goes OR n > 1"), "judged")
    goes, repeated = judged.where("goes").drop("goes", "n"), judged.where("NOT goes").drop("goes", "n")
    text = F.coalesce(docs["text"], F.lit(""))
    own = docs.select(F.struct("*").alias("row"), docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("t1"), F.hash(text).alias("t2"))
    same = lambda b: own["doc_id"].eqNullSafe(b["doc_id"]) & (own["t1"] == b["t1"]) & (own["t2"] == b["t2"])
    sent = _if_small(goes)
    left = own.join(sent, same(sent), "left_anti")
    if repeated.isEmpty():
        return left.select("row.*")
    # Rows that stand several times, doc_id and text alike, are the only ones that need looking at together.
    twice = left.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "t1", "t2"])
    return left.join(repeated, same(repeated), "left_anti").unionAll(twice).select("row.*")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

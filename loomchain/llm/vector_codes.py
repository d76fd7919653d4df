"""Compressed vectors: each of 16 parts becomes the number of the nearest entry of its position's codebook, fitted by a dual-tree Lloyd.

Vectors are integers and so is all arithmetic.  A block of rows is sorted once, for each part position, into a balanced tree whose splits are
halves of the widest dimension; it is written in that order.  In a round, a block's tree and a tree over the codebook's entries are
walked down together: for a pair of nodes the least and greatest squared distance of their boxes are known, and an entry node goes when even its least
is over the greatest of some other one.  A node with one entry left is assigned whole, by its count and its cached sums.  Leaves that stay
uncertain compare their parts with the entries left, ties going to the lower index.  Tasks return one sum and count for each entry, which
Spark adds up; the driver sees codebooks only, of 16 times 64 entries whatever the table's size.

Rows whose vector is null or holds null or non-finite components are left out.  The first codebook is that of the 64 smallest vec_ids, null ones
last; rows that repeat a vec_id are ordered by their vectors, and with fewer rows there are fewer entries.  Each repeated row gives its row.
Shorter vectors have zeros behind them up to the longest, and so has a length that 16 does not divide.  Components beyond a long count as the nearest
long, and components over 2**29 are handled as Python integers; an error that does not fit a long is null, and sums pass over it.  Labels may be null, which
are equal to each other.  Other columns, whatever their names, are not read.  Empty table: empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import cut, free, give_back, table
from loomchain.llm.piece_codec import ragged
from loomchain.llm.vectors import SCALE, integer_rows, longest, matrix, narrow, vector_blocks, widened

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Parts in a leaf at most.
LEAF = 32
#: Up to here sums of squared differences fit a long.
NARROW = 1 << 29
SUM_SCHEMA = "part int, entry int, position int, total decimal(38,0), n long"


class Tree:
    """Points in the order of a balanced tree: node k of level l has the rows from n*k/2^l to n*(k+1)/2^l."""

    def __init__(self, points: np.ndarray, levels: int):
        self.points, self.levels = points, levels
        n, self.lo, self.hi, self.sums = len(points), [], [], []
        self.cuts = [np.arange((1 << l) + 1) * n >> l for l in range(levels + 1)]
        # From the leaves up; no node is empty as long as there are as many points as leaves.
        at = self.cuts[levels][:-1]
        lo, hi, sums = (f.reduceat(points, at, axis=0) for f in (np.minimum, np.maximum, np.add))
        for _ in range(levels + 1):
            self.lo.insert(0, lo)
            self.hi.insert(0, hi)
            self.sums.insert(0, sums)
            lo, hi, sums = np.minimum(lo[::2], lo[1::2]), np.maximum(hi[::2], hi[1::2]), sums[::2] + sums[1::2]


def depth(n: int, leaf: int) -> int:
    """Levels below the root so that leaves have ``leaf`` points or fewer, but one at least."""
    levels = 0
    while n >> levels > leaf and n >> levels + 1:
        levels += 1
    return levels


def tree_order(points: np.ndarray, levels: int) -> np.ndarray:
    """Sorts level by level: each node's points along its widest dimension."""
    n, order = len(points), np.arange(len(points))
    for l in range(levels):
        cuts = np.arange((1 << l) + 1) * n >> l
        now = points[order]
        wide = np.argmax((np.maximum.reduceat(now, cuts[:-1], axis=0) - np.minimum.reduceat(now, cuts[:-1], axis=0)).astype(float), axis=1)
        node = np.repeat(np.arange(1 << l), np.diff(cuts))
        key = now[np.arange(n), wide[node]]
        order = order[np.lexsort((key.astype(np.int64), node))]
    return order


def exact(x: np.ndarray) -> np.ndarray:
    """As longs where squares and their sums fit, else as Python integers."""
    return x.astype(np.int64) if not x.size or max(abs(int(x.max())), abs(int(x.min()))) <= NARROW else x.astype(object)


def assign(tree: Tree, entries: np.ndarray) -> Iterator[tuple[int, int, int, int] | tuple[np.ndarray, np.ndarray]]:
    """Nearest entries of a tree's points: whole nodes as (level, node, entry, count), then the rest as (points' places, their entries)."""
    m = len(entries)
    levels = depth(m, 1)
    order = tree_order(entries, levels)
    e = Tree(entries[order], levels)
    # The levels of the entries' tree, the entries themselves below them, and how many nodes each node has on the next one.
    boxes = [*zip(e.lo, e.hi), (e.points, e.points)]
    grow = [*([2] * levels), np.diff(e.cuts[levels])]
    active, near = np.zeros(1, np.int64), np.ones((1, 1), bool)
    for l in range(tree.levels + 1):
        r = min(l, levels + 1)
        least, most = box_distances(tree.lo[l][active], tree.hi[l][active], *boxes[r])
        bound = np.where(near, most, most.max() + 1).min(axis=1)
        near = near & (least <= bound[:, None])
        if r > levels:
            alone = near.sum(axis=1) == 1
            for node, k in zip(active[alone].tolist(), near[alone].argmax(axis=1).tolist()):
                yield l, node, int(order[k]), int(tree.cuts[l][node + 1] - tree.cuts[l][node])
            active, near = active[~alone], near[~alone]
        if not len(active):
            return
        if l < tree.levels:
            active, near = np.repeat(active * 2, 2) + np.tile([0, 1], len(active)), np.repeat(near, 2, axis=0)
            near = np.repeat(near, grow[r], axis=1) if r <= levels else near
    # What no pair of nodes decided: each part against the entries left to its leaf.
    for k in grow[r:]:
        near = np.repeat(near, k, axis=1)
    near = near[:, np.argsort(order)]
    leaf, entry = np.nonzero(near)
    per_leaf = np.bincount(leaf, minlength=len(active))
    first = np.cumsum(per_leaf) - per_leaf
    cuts = tree.cuts[tree.levels]
    sizes = cuts[active + 1] - cuts[active]
    places = ragged(cuts[active], sizes)
    own = np.repeat(np.arange(len(active)), sizes)
    pairs = per_leaf[own]
    tried = entry[ragged(first[own], pairs)]
    away = ((tree.points[np.repeat(places, pairs)] - entries[tried]) ** 2).sum(axis=1)
    heads = np.cumsum(pairs) - pairs
    best = np.minimum.reduceat(away, heads)
    yield places, np.minimum.reduceat(np.where(away == np.repeat(best, pairs), tried, m), heads)


def box_distances(lo: np.ndarray, hi: np.ndarray, elo: np.ndarray, ehi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distances between points of boxes, for all pairs of nodes of two levels."""
    below, above = elo[None] - hi[:, None], lo[:, None] - ehi[None]
    apart = np.maximum(np.maximum(below, above), 0)
    return (apart**2).sum(axis=2), (np.minimum(below, above) ** 2).sum(axis=2)


def _plant(width: int):
    """Rows to blocks: their vec_ids and labels, and each part position's parts in the order of its tree."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in vector_blocks(batches):
            x = matrix(batch.column(2), width)
            n, parts = len(x), x.reshape(len(x), PARTS, -1)
            orders = [tree_order(exact(parts[:, p]), depth(n, LEAF)) for p in range(PARTS)]
            data = narrow(np.stack([parts[o, p] for p, o in enumerate(orders)]))
            whole = pa.array([0, n], pa.int32())
            columns = [pa.ListArray.from_arrays(whole, batch.column(0)), pa.ListArray.from_arrays(whole, batch.column(1)), pa.array([np.stack(orders).astype("<u2").tobytes()], pa.binary()), pa.array([data], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_ids", "labels", "orders", "parts"])

    return run


def _trees(row: dict) -> tuple[np.ndarray, list[Tree]]:
    orders = np.frombuffer(row["orders"], "<u2").reshape(PARTS, -1).astype(np.int64)
    parts = widened(row["parts"]).reshape(PARTS, orders.shape[1], -1)
    return orders, [Tree(exact(p), depth(orders.shape[1], LEAF)) for p in parts]


def _books(books: np.ndarray) -> list[np.ndarray]:
    return [exact(b) for b in books]


def _sums(books: np.ndarray):
    """One task's count and sum of each entry's parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, entries = np.zeros(books.shape, object), _books(books)
        counts = np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                _, trees = _trees(row)
                for p, tree in enumerate(trees):
                    for found in assign(tree, entries[p]):
                        if len(found) == 4:
                            l, node, k, n = found
                            held[p, k] += tree.sums[l][node]
                            counts[p, k] += n
                        else:
                            order = np.argsort(found[1], kind="stable")
                            own, heads, n = np.unique(found[1][order], return_index=True, return_counts=True)
                            held[p, own] += np.add.reduceat(tree.points[found[0][order]], heads, axis=0)
                            counts[p, own] += n
        p, k = np.nonzero(counts)
        d = books.shape[2]
        columns = [np.repeat(p, d), np.repeat(k, d), np.tile(np.arange(d), len(p))]
        totals = pa.array([Decimal(int(x)) for x in held[p, k].ravel()], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in columns), totals, pa.array(np.repeat(counts[p, k], d), pa.int64())], names=["part", "entry", "position", "total", "n"])
        give_back()

    return run


def _codes(books: np.ndarray):
    """Of each row its entries' numbers and the distance to them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _books(books)
        for batch in batches:
            for i, row in enumerate(batch.select(["orders", "parts"]).to_pylist()):
                orders, trees = _trees(row)
                codes, errors = np.zeros((orders.shape[1], PARTS), np.uint8), 0
                for p, tree in enumerate(trees):
                    own = np.zeros(orders.shape[1], np.int64)
                    for found in assign(tree, entries[p]):
                        if len(found) == 4:
                            own[tree.cuts[found[0]][found[1]] : tree.cuts[found[0]][found[1] + 1]] = found[2]
                        else:
                            own[found[0]] = found[1]
                    away = np.zeros(len(own), object)
                    away[orders[p]] = ((tree.points - entries[p][own]) ** 2).sum(axis=1)
                    codes[orders[p], p], errors = own, errors + away
                text = codes.tobytes().hex()
                size = 2 * PARTS
                fits = [int(e) if e < 1 << 63 else None for e in errors]
                columns = [batch["vec_ids"][i].values, pa.array([text[a : a + size] for a in range(0, len(text), size)], pa.string()), pa.array(fits, pa.int64()), batch["labels"][i].values]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "code", "error", "label"])
        give_back()

    return run


def fit(blocks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """``rounds`` of assigning every part and replacing each entry by its parts' mean, rounded down; unused entries stay."""
    for _ in range(rounds):
        sums = blocks.select("orders", "parts").mapInArrow(_sums(books), SUM_SCHEMA).groupBy("part", "entry", "position").agg(F.sum("total").cast("decimal(38,0)").alias("total"), F.sum("n").alias("n"))
        books = books.copy()
        for r in sums.collect():  # as many as the codebooks have components
            books[r["part"], r["entry"], r["position"]] = int(r["total"]) // r["n"]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(rows: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, code, error, label) of each row that counts, and the codebooks (part, entry, position) as integers."""
    x = integer_rows(rows)
    part = max(1, -(-longest(x) // PARTS))
    first = x.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()
    books = np.zeros((PARTS, len(first), part), np.int64)
    for k, r in enumerate(first):
        books[:, k] = np.array(r["x"] + [0] * (PARTS * part - len(r["x"])), np.int64).reshape(PARTS, part)
    label = x.schema["label"].dataType.simpleString()
    blocks = cut(x.mapInArrow(_plant(PARTS * part), f"vec_ids array<long>, labels array<{label}>, orders binary, parts binary"), "trees")
    books = fit(blocks, books, rounds) if len(first) else books
    codes = cut(blocks.mapInArrow(_codes(books), f"vec_id long, code string, error long, label {label}"), "codes")
    free(blocks)
    return codes, books


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds each label's summed error.  A label is one row for a task before it is dealt; the join's skew handling splits a frequent one."""
    total = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total")).select(F.col("label").alias("of"), F.col("total").try_cast("bigint").alias("label_error"))
    return codes.join(total, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return with_label_error(codes).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _floor_div(a: str, b: str) -> str:
    return f"(({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b})"


def _sql(rounds: int = ROUNDS) -> str:
    """The same by comparing every part with every entry."""
    steps = [f"""x AS (SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
w AS (SELECT greatest(1, CAST(ceil(max(len(x)) / {PARTS}.0) AS BIGINT)) AS w FROM x),
parts AS (SELECT id, p.p, k.k, coalesce(x[p.p * w + k.k + 1], 0) AS c FROM x, w, range({PARTS}) p(p), range(w) k(k)),
firsts AS (SELECT id, row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS e FROM x ORDER BY vec_id NULLS LAST, x LIMIT {ENTRIES}),
book0 AS (SELECT p, e, k, c FROM parts JOIN firsts USING (id))"""]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS (SELECT id, p, min(struct_pack(d := d, e := e)) AS best FROM (SELECT id, a.p, e, sum((a.c - b.c) * (a.c - b.c)) AS d FROM parts a JOIN book{i} b ON a.p = b.p AND a.k = b.k GROUP BY ALL) GROUP BY ALL)""")
        if i < rounds:
            steps.append(f"""new{i} AS (SELECT p, best.e AS e, k, CAST({_floor_div("sum(c)", "count(*)")} AS BIGINT) AS c FROM near{i} JOIN parts USING (id, p) GROUP BY ALL),
book{i + 1} AS (SELECT b.p, b.e, b.k, coalesce(n.c, b.c) AS c FROM book{i} b LEFT JOIN new{i} n ON n.p = b.p AND n.e = b.e AND n.k = b.k)""")
    steps.append(f"""codes AS (SELECT id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, k)) FROM book{rounds}) AS codebooks_sha256 FROM codes JOIN x USING (id)""")
    return "WITH " + ",\n".join(steps)


OP13_SQL = _sql()

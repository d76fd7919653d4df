"""Benchmark decontamination with an FM-index for each shard of documents.

A shard is a block of whole documents as a sequence of word numbers.  Words that no benchmark item has become one separator, and
runs of known words shorter than the shortest phrase go: neither can lie in a phrase.  The suffix array of what is left gives the
Burrows-Wheeler transform, held as a wavelet matrix; all phrases are searched backward together through its ranks, and the rows
found are walked to the next sampled suffix to locate them.  Occurrences become per-document removal spans, merged by a running sum.

The benchmark goes to the tasks in parts of at most ``part_windows`` windows (a longer item stands in several), ``PASSES`` of them for each pass over the
documents, so what the driver builds and sends at once is bounded however large the benchmark is.  The words of a pass are numbered together, so
that a shard has one index in it, which all its phrases are searched in.  Between passes the documents are written with what was found so far.  They are never shuffled.

Null text: no words, no hits, not contaminated.  Items without words match nothing.  Items with a null item_id mark words but are
not listed; rows that repeat an item_id count as one item.  Repeated documents and null doc_ids each give their row.  An empty
benchmark leaves every document clean.  A very long text is a shard of its own, searched whole.  Other columns, whatever their names, are
handed through or not read.  Empty table: empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import blocks, cut, free, table, texts
from loomchain.shipping import ship

WINDOW = 13
#: Windows of a part of the benchmark: 13 numbers of 32 bits each.
PART_WINDOWS = 1 << 17
#: Parts that one pass over the documents searches for.
PASSES = 8
#: Every how many-th text position keeps its suffix position.
SAMPLE = 8
#: A document is contaminated if at least one word in so many is hit.
CONTAMINATED_ONE_IN = 20

RESULT_SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, removal_spans string"

_LETTERS = bytes((c | 0x20 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20) for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and bytes beyond ASCII."""
    return text.translate(_LETTERS).split()


class Phrases:
    """The distinct windows of one part of the benchmark, as rows of word numbers; number 0 ends, 1 separates.

    ``pieces`` are (item_id, word numbers), ``words`` those that no part before it in the pass had, numbered from ``first`` on.
    """

    def __init__(self, pieces: list[tuple[object, np.ndarray]], words: list[bytes], first: int, window: int = WINDOW):
        self.words, self.first = words, first
        found = [np.lib.stride_tricks.sliding_window_view(ids, window) if len(ids) >= window else np.pad(ids, (0, window - len(ids)))[None] for _, ids in pieces]
        self.rows, row = np.unique(np.concatenate([np.zeros((0, window), np.int32), *found]), axis=0, return_inverse=True)
        self.lengths = (self.rows > 0).sum(axis=1)
        self.names = [None if item is None else str(item) for item, _ in pieces]
        # The pieces of each row stand together, from its edge to the next row's.
        row = row.reshape(-1)
        self.pieces = np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f in found])[np.argsort(row, kind="stable")]
        self.edges = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(self.rows)))])

    def items(self, row: int) -> set[str]:
        """The ids of the items that have a row, but for null ones."""
        return {self.names[i] for i in self.pieces[self.edges[row] : self.edges[row + 1]].tolist()} - {None}


def passes(items: Iterable[tuple[object, bytes]], window: int = WINDOW, part_windows: int = PART_WINDOWS, parts: int = 8) -> Iterator[list[Phrases]]:
    """The parts of each pass over the documents, filled one after another by their count of windows."""
    numbers: dict[bytes, int] = {}
    held: list[Phrases] = []
    pieces, size, known = [], 0, 0
    for item_id, text in items:
        words = words_of(text)
        for at in range(0, max(1, len(words) - window + 1) if words else 0, part_windows):
            piece = words[at : at + part_windows + window - 1]
            n = max(1, len(piece) - window + 1)
            if pieces and size + n > part_windows:
                held.append(Phrases(pieces, list(numbers)[known:], known + 2, window))
                pieces, size, known = [], 0, len(numbers)
                if len(held) == parts:
                    yield held
                    numbers, held, known = {}, [], 0
            pieces.append((item_id, np.fromiter((numbers.setdefault(w, len(numbers) + 2) for w in piece), np.int32, len(piece))))
            size += n
    yield [*held, Phrases(pieces, list(numbers)[known:], known + 2, window)]


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """By prefix doubling; the sequence ends with its one smallest number."""
    _, rank = np.unique(seq, return_inverse=True)
    n, step = len(seq), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - step] = rank[step:] + 1
        key = rank.astype(np.int64) * (n + 1) + ahead
        order = np.argsort(key, kind="stable")
        in_order = key[order]
        fresh = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


class FmIndex:
    def __init__(self, seq: np.ndarray, sample: int = SAMPLE):
        n = len(seq)
        sa = suffix_array(seq)
        bwt = seq[sa - 1]
        self.n, self.width = n, max(1, int(seq.max()).bit_length())
        self.levels, self.zeros = [], []
        now = bwt
        for level in range(self.width - 1, -1, -1):
            bits = (now >> level) & 1
            self.levels.append(np.concatenate([[0], np.cumsum(bits)]))
            self.zeros.append(n - int(self.levels[-1][-1]))
            now = np.concatenate([now[bits == 0], now[bits == 1]])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=1 << self.width))])
        self.bwt = bwt
        self.sampled = sa % sample == 0
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = sa[self.sampled]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place of the transform."""
        lo = np.zeros_like(at)
        for depth, level in enumerate(range(self.width - 1, -1, -1)):
            ones, bit = self.levels[depth], ((symbol >> level) & 1).astype(bool)
            a, b = ones[at], ones[lo]
            at = np.where(bit, self.zeros[depth] + a, at - a)
            lo = np.where(bit, self.zeros[depth] + b, lo - b)
        return at - lo

    def search(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first row, last row + 1) of those that occur; from a phrase's last symbol to its first."""
        phrase = np.arange(len(rows))
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), self.n)
        for back in range(1, rows.shape[1] + 1):
            going = lengths[phrase] >= back
            symbol = rows[phrase, np.maximum(lengths[phrase] - back, 0)]
            base = self.first[np.minimum(symbol, len(self.first) - 1)]
            known = going & (symbol < (1 << self.width))
            lo = np.where(known, base + self.rank(symbol, lo), lo)
            hi = np.where(known, base + self.rank(symbol, hi), np.where(going, lo, hi))
            left = hi > lo
            phrase, lo, hi = phrase[left], lo[left], hi[left]
        return phrase, lo, hi

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking to the next sampled suffix."""
        row, steps = row.copy(), np.zeros(len(row), np.int64)
        open_ = np.flatnonzero(~self.sampled[row])
        while len(open_):
            symbol = self.bwt[row[open_]]
            row[open_] = self.first[symbol] + self.rank(symbol, row[open_])
            steps[open_] += 1
            open_ = open_[~self.sampled[row[open_]]]
        return self.samples[self.sample_rank[row]] + steps


def occurrences(found: list[np.ndarray], parts: list[Phrases]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrase, word position in the concatenated documents) of all occurrences of each part's phrases in a shard, which has one index."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    shortest = min((int(p.lengths.min()) for p in parts if len(p.rows)), default=0)
    # A separator before each document and at the end, so that no run crosses a border.
    gap = np.ones(1, np.int64)
    seq = np.concatenate([x for f in found for x in (gap, f)] + [gap])
    edges = np.flatnonzero(seq == 1)
    keep = np.diff(edges) - 1 >= max(1, shortest)
    if not shortest or not keep.any():
        yield from (none for _ in parts)
        return
    mask = np.zeros(len(seq) + 1, np.int64)
    np.add.at(mask, edges[:-1][keep], 1)
    np.add.at(mask, edges[1:][keep], -1)
    at = np.flatnonzero(np.cumsum(mask)[:-1] > 0)  # a separator, then the run, for each run kept
    index = FmIndex(np.concatenate([seq[at], [1, 0]]))
    ends = np.cumsum([len(f) + 1 for f in found])
    for part in parts:
        phrase, lo, hi = index.search(part.rows, part.lengths)
        count = hi - lo
        row = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        where = at[index.locate(row)]
        yield np.repeat(phrase, count), where - np.searchsorted(ends, where, "right") - 1


def _hits(found: list[list[bytes]], parts: list[Phrases], numbers: dict[bytes, int]) -> tuple[list[np.ndarray], list[set]]:
    """Of texts as words: which words occurrences of the phrases cover, and whose these are."""
    number = numbers.get
    shard = [np.fromiter((number(w, 1) for w in words), np.int64, len(words)) for words in found]
    starts = np.concatenate([[0], np.cumsum([len(f) for f in found])])
    delta = np.zeros(starts[-1] + 1, np.int64)
    items: list[set] = [set() for _ in found]
    for part, (phrase, where) in zip(parts, occurrences(shard, parts)):
        np.add.at(delta, where, 1)
        np.add.at(delta, where + part.lengths[phrase], -1)
        document = np.searchsorted(starts, where, "right") - 1
        for d, p in set(zip(document.tolist(), phrase.tolist())):
            items[d] |= part.items(p)
    hit = np.cumsum(delta)[:-1] > 0
    return [hit[a:z] for a, z in zip(starts[:-1], starts[1:])], items


def _search(parts: list, finish):
    """Searches for the parts of a pass in each block, and hands what is found so far to ``finish``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_parts = [part.value for part in parts]
        numbers = {w: i for part in held_parts for i, w in enumerate(part.words, part.first)}
        for batch in batches:
            state, hits, items, n_words = iter(zip(batch["hits"], batch["items"])), [], [], []
            for _, _, held in blocks([batch.select(["doc_id", "text"])]):
                found = [words_of(text) for text in held]
                before = [next(state) for _ in held]
                hit = [np.unpackbits(np.frombuffer(h.as_py() or b"", np.uint8), count=len(w)).astype(bool) if h.as_py() else np.zeros(len(w), bool) for (h, _), w in zip(before, found)]
                listed = [set(x.as_py() or ()) for _, x in before]
                for i, (now, own) in enumerate(zip(*_hits(found, held_parts, numbers))):
                    hit[i] = hit[i] | now
                    listed[i] |= own
                hits += hit
                items += [sorted(x) for x in listed]
                n_words += [len(w) for w in found]
            yield finish(batch, hits, items, n_words)

    return run


def _held(batch: pa.RecordBatch, hits: list, items: list, n_words: list) -> pa.RecordBatch:
    now = {"hits": pa.array([np.packbits(x).tobytes() for x in hits], pa.binary()), "items": pa.array(items, pa.list_(pa.string()))}
    return pa.RecordBatch.from_arrays([now.get(name, batch[name]) for name in batch.schema.names], names=batch.schema.names)


def _judge(one_in: int):
    def finish(batch: pa.RecordBatch, hits: list, items: list, n_words: list) -> pa.RecordBatch:
        rows = []
        for hit, listed, n in zip(hits, items, n_words):
            edge = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
            n_hit = int(hit.sum())
            spans = ",".join(f"{a}:{b}" for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()))
            rows.append((n, n_hit, len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), n_hit > 0 and one_in * n_hit >= n, spans))
        cols = list(zip(*rows)) or [()] * 6
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, t) for c, t in zip(cols, types))], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "removal_spans"])

    return finish


def _clean(one_in: int):
    def finish(batch: pa.RecordBatch, hits: list, items: list, n_words: list) -> pa.RecordBatch:
        return batch.select(["row"]).filter(pa.array([not x.any() or one_in * int(x.sum()) < n for x, n in zip(hits, n_words)], pa.bool_()))

    return finish


def _searched(rows: DataFrame, benchmark: DataFrame, window: int, part_windows: int, finish, schema) -> DataFrame:
    """``rows(doc_id, text, ...)`` with the words hit (bits) and the items found by all parts of the benchmark, as ``finish`` gives them."""
    context = rows.sparkSession.sparkContext
    items = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), F.coalesce(benchmark["text"], F.lit("")).cast("binary").alias("text")).distinct()
    state, held = rows.withColumns({"hits": F.lit(None).cast("binary"), "items": F.lit(None).cast("array<string>")}), []
    # A partition of the items comes at a time, and becomes windows as they come.
    for parts in passes(((r["item_id"], bytes(r["text"])) for r in items.toLocalIterator()), window, part_windows, PASSES):
        if held:
            last, state = state, cut(state.mapInArrow(_search(held, _held), state.schema), "hits")
            free(last)
            for part in held:
                part.unpersist()
        held = [context.broadcast(part) for part in parts]
    return state.mapInArrow(_search(held, finish), schema)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_windows: int = PART_WINDOWS, one_in: int = CONTAMINATED_ONE_IN) -> DataFrame:
    """Per row of ``docs``: its words, those hit, the items found, the verdict, and the merged spans of hit words (from:to)."""
    return _searched(texts(docs), benchmark, window, part_windows, _judge(one_in), RESULT_SCHEMA)


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_windows: int = PART_WINDOWS, one_in: int = CONTAMINATED_ONE_IN) -> DataFrame:
    """The rows of ``docs``, all their columns, that are not contaminated."""
    ship(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).cast("binary").alias("text"), F.struct("*").alias("row"))
    return _searched(rows, benchmark, window, part_windows, _clean(one_in), rows.select("row").schema).select("row.*")


def op7_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP7_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(ws), {WINDOW}) AS n, array_to_string(ws[i:i + least(len(ws), {WINDOW}) - 1], ' ') AS phrase
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - {WINDOW} + 2, 2))) AS i FROM items WHERE len(ws) > 0)
), places AS (
  SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS phrase
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))
), found AS (
  SELECT r, p.n, i, item FROM places p JOIN windows w ON p.n = w.n AND p.phrase = w.phrase
), hit AS (
  SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM found
), spans AS (
  SELECT r, min(p) - 1 AS a, max(p) AS b, count(*) AS c FROM (SELECT r, p, p - row_number() OVER (PARTITION BY r ORDER BY p) AS island FROM hit) GROUP BY r, island
), hits AS (
  SELECT r, sum(c) AS n_hit, string_agg(a || ':' || b, ',' ORDER BY a) AS removal_spans FROM spans GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {CONTAMINATED_ONE_IN} * coalesce(n_hit, 0) >= len(ws) AS contaminated, coalesce(removal_spans, '') AS removal_spans
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

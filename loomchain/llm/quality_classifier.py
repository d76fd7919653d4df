"""Quality classifier: random-indexing word vectors, pooled per document, then a two-layer network with calibrated probabilities.

Every word has a fixed sparse index vector of +1 and -1 that its hash gives.  A word's vector is the sum of the index vectors of the
words around it, counted over the whole text of all documents.  The ``FREQUENT`` most frequent words of the corpus have vectors of their
own; the others share ``CELLS`` rows by hash, so the table has a fixed size whatever the input and may be sent to every task.

Texts are split into words once and written as numbers.  Words are counted over all of them; each task sums the contexts of its own, one
row for each group of words, and the sums are added by group in rounds, of at most ``FAN`` rows at once however many tasks there are.

The network learns from at most ``TRAIN_ROWS`` labelled documents outside the held-out fold (those whose id has the least hashes); a
part of them sets the temperature.  Everything else, word statistics and scores, covers all documents.  Sums are of integers, rows
are sorted and seeds are fixed, so a run gives the same scores again.

Null or empty text: the score of a document without words.  A very long text is a block of its own, counted and scored whole.  A null
doc_id is in no fold that learns and is not held out (its remainder is null, given as false).  Labels that are null, or whose document is
missing, teach nothing; of documents that repeat a doc_id one is learned from, and labels that disagree on one doc_id all count.  Without
labels of both kinds all scores are the share of label 1, or 0.5.  Other columns, whatever their names, are not read.  Empty table: empty
result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import blocks, cut, free, from_planes, give_back, planes, table, texts

#: Words with vectors of their own, and rows that the others share.
FREQUENT = 1 << 14
CELLS = 1 << 14
DIMS = 64
NONZERO = 2
REACH = 2
#: Bound of the labelled documents that are gathered to train on.
TRAIN_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3
HIDDEN = 32
EPOCHS = 60
#: Groups of rows in which sums travel, and how many tasks' rows of one group are added at once.
GROUPS = 64
FAN = 128

TOKEN = re.compile(r"\w+|[^\w\s]+")
BLOCK_SCHEMA = "block long, doc_ids array<long>, hashes array<long>, counts array<long>, flags binary, tokens binary"
RESULT_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

#: Rows of the table for words that no text has: they follow words in capitals, repeated ones and overlong ones.
UPPER, REPEAT, LONG = MARKS = range(3)

U = np.uint64


class _Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


def word_hash(word: str) -> int:
    """40 bits of a word in small letters."""
    return xxhash.xxh64_intdigest(word.lower().encode("utf-8", "replace")) >> 24


def numbered(held: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(hashes and flags of the distinct words and runs of marks, the numbers of each text's)."""
    seen, found = _Numbers(), []
    for text in held:
        words = TOKEN.findall(text.decode("utf-8", "replace"))
        found.append(np.fromiter(map(seen.__getitem__, words), np.int32, len(words)))
    hashes = np.fromiter(map(word_hash, seen), np.int64, len(seen))
    flags = np.fromiter((w.isupper() << UPPER | (len(w) > 30) << LONG for w in seen), np.uint8, len(seen))
    return hashes, flags, found


class Rows:
    """Word hash -> row of the table of vectors: of its own for a frequent word, else one that words share."""

    def __init__(self, frequent: Iterable[int], cells: int = CELLS):
        self.own = np.unique(np.asarray(list(frequent), np.int64))
        self.cells = cells
        self.size = len(MARKS) + len(self.own) + cells

    def of(self, hashes: np.ndarray) -> np.ndarray:
        shared = len(MARKS) + len(self.own) + (hashes.view(U) % U(self.cells)).astype(np.int64)
        if not len(self.own):
            return shared
        at = np.minimum(np.searchsorted(self.own, hashes), len(self.own) - 1)
        return np.where(self.own[at] == hashes, len(MARKS) + at, shared)

    def index_vectors(self) -> tuple[np.ndarray, np.ndarray]:
        """(places, signs) of each row's nonzero entries, by the hash of its word or by its cell."""
        x = np.concatenate([np.asarray(MARKS), self.own, np.arange(self.cells) + (1 << 40)]).view(U)
        places, signs = [], []
        for _ in range(NONZERO):
            x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
            x = x ^ (x >> U(31))
            places.append(x % U(DIMS))
            signs.append(np.where(x >> U(63), -1, 1))
        return np.stack(places, axis=1).astype(np.int32), np.stack(signs, axis=1).astype(np.int8)


def marked(row: np.ndarray, flag: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of all texts on end, how many each text has): marks go behind the words, given by row and flags, of texts that begin at ``starts``."""
    again = np.zeros(len(row), bool)
    again[1:] = row[1:] == row[:-1]
    again[starts[:-1][starts[:-1] < len(row)]] = False
    on = (flag >> UPPER & 1).astype(bool), again, (flag >> LONG & 1).astype(bool)
    width = 1 + sum(f.astype(np.int64) for f in on)
    ends = np.concatenate([[0], np.cumsum(width)])
    out = np.repeat(row, width)
    at = ends[:-1] + 1
    for f, mark in zip(on, MARKS):
        out[at[f]] = mark
        at = at + f
    return out, np.diff(ends[starts])


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts as numbers of their distinct words, with how often each word stands in the block."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for block, ids, held in blocks(batches):
        hashes, flags, found = numbered(held)
        flat = np.concatenate(found)
        tokens = squeeze.compress(planes(np.concatenate([[len(f) for f in found], flat])))
        columns = [[block], [ids], [hashes], [np.bincount(flat, minlength=len(hashes))], [flags.tobytes()], [tokens]]
        types = [pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "doc_ids", "hashes", "counts", "flags", "tokens"])
    give_back()


def packed(docs: DataFrame) -> DataFrame:
    return cut(texts(docs).mapInArrow(_pack, BLOCK_SCHEMA), "words")


def frequent_words(parts: DataFrame, most: int = FREQUENT) -> list[int]:
    """Hashes of the most frequent words of all texts; ties go by the hash.  At most ``most`` of them come to the driver."""
    counted = parts.select(F.explode(F.arrays_zip("hashes", "counts")).alias("x")).groupBy("x.hashes").agg(F.sum("x.counts").alias("n"))
    return [r["hashes"] for r in counted.orderBy(F.desc("n"), "hashes").limit(most).collect()]


def texts_of(batch: pa.RecordBatch, rows: Rows) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, rows of all texts on end, how many each has) of packed blocks."""
    unpack = zstandard.ZstdDecompressor()
    for ids, hashes, flags, tokens in zip(batch["doc_ids"], batch["hashes"], batch["flags"], batch["tokens"]):
        ids, numbers = ids.as_py(), from_planes(unpack.decompress(tokens.as_py()))
        starts, flat = np.concatenate([[0], np.cumsum(numbers[: len(ids)])]), numbers[len(ids) :]
        yield ids, *marked(rows.of(hashes.values.to_numpy())[flat], np.frombuffer(flags.as_py(), np.uint8)[flat], starts)


def add_contexts(total: np.ndarray, cells: np.ndarray, sizes: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Adds to each row the index vectors of its neighbours in the same text, and its own."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    own = cells * DIMS
    for j in range(NONZERO):
        place, sign = places[cells, j], signs[cells, j].astype(np.int64)
        np.add.at(total, own + place, sign)
        for d in range(1, REACH + 1):
            same = text[d:] == text[:-d]
            np.add.at(total, (own[:-d] + place[d:])[same], sign[d:][same])
            np.add.at(total, (own[d:] + place[:-d])[same], sign[:-d][same])


def _sum_contexts(held) -> object:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: Rows = held.value
        places, signs = rows.index_vectors()
        total, seen = np.zeros(rows.size * DIMS, np.int64), np.zeros(rows.size, np.int64)
        for batch in batches:
            for _, cells, sizes in texts_of(batch, rows):
                add_contexts(total, cells, sizes, places, signs)
                seen += np.bincount(cells, minlength=rows.size)
        give_back()
        if seen.any():
            squeeze, both = zstandard.ZstdCompressor(level=1), np.concatenate([total.reshape(-1, DIMS), seen[:, None]], axis=1)
            parts = [squeeze.compress(x.tobytes()) for x in np.array_split(both, GROUPS)]
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(range(GROUPS), pa.int32()), pa.array([task] * GROUPS, pa.int64()), pa.array(parts, pa.binary())], names=["part", "task", "sums"])

    return run


def _add_up(part: pa.Table) -> pa.Table:
    unpack, total = zstandard.ZstdDecompressor(), 0
    for x in part["sums"]:
        total = total + np.frombuffer(unpack.decompress(x.as_py()), np.int64)
    packed_sum = zstandard.ZstdCompressor(level=1).compress(total.tobytes())
    return pa.table([part["part"].combine_chunks()[:1], pa.array([part["task"][0].as_py()], pa.int64()), pa.array([packed_sum], pa.binary())], names=["part", "task", "sums"])


def added_up(sums: DataFrame) -> DataFrame:
    """One row for each part of ``sums(part, task, sums)``, in rounds of at most FAN rows in a group, for up to FAN ** 3 tasks; more only make the last groups longer."""
    for last in (False, False, True):
        sums = sums.withColumn("task", F.lit(0).cast("long") if last else F.floor(F.col("task") / FAN))
        sums = sums.groupBy("part", "task").applyInArrow(_add_up, "part int, task long, sums binary")
    return sums


def word_vectors(parts: DataFrame, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """(vector, weight) of each row, from the contexts of all words of all documents."""
    held = parts.sparkSession.sparkContext.broadcast(rows)
    sums = added_up(parts.select("doc_ids", "hashes", "flags", "tokens").mapInArrow(_sum_contexts(held), "part int, task long, sums binary"))
    found = {r["part"]: bytes(r["sums"]) for r in sums.select("part", "sums").collect()}  # GROUPS rows of a fixed size
    unpack = zstandard.ZstdDecompressor()
    both = np.concatenate([np.frombuffer(unpack.decompress(found[i]), np.int64) for i in sorted(found)]).reshape(-1, DIMS + 1) if found else np.zeros((rows.size, DIMS + 1))
    vectors, seen = both[:, :DIMS].astype(float), both[:, DIMS].astype(float)
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    share = seen / max(1.0, seen.sum())
    return vectors.astype(np.float32), (1e-3 / (1e-3 + share) * (seen > 0) + 1e-6).astype(np.float32)


def pooled(text_cells: np.ndarray, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean vector, weighted by rarity, beside the plain mean."""
    if not len(text_cells):
        return np.zeros(2 * DIMS, np.float32)
    cells, counts = np.unique(text_cells, return_counts=True)
    v, w = vectors[cells], counts * weights[cells]
    return np.concatenate([w @ v / w.sum(), counts @ v / counts.sum()]).astype(np.float32)


def loss(w: list[np.ndarray], x: np.ndarray, y: np.ndarray, decay: float = 1e-4) -> float:
    z = np.tanh(x @ w[0] + w[1]) @ w[2] + w[3][0]
    return float(np.mean(np.logaddexp(0, z) - y * z) + decay / 2 * sum((a * a).sum() for a in (w[0], w[2])))


def gradients(w: list[np.ndarray], x: np.ndarray, y: np.ndarray, decay: float = 1e-4) -> tuple[np.ndarray, ...]:
    """Of ``loss``, by each of the weights."""
    h = np.tanh(x @ w[0] + w[1])
    d = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30))) - y) / len(y)
    dh = np.outer(d, w[2]) * (1 - h * h)
    return x.T @ dh + decay * w[0], dh.sum(0), h.T @ d + decay * w[2], d.sum(keepdims=True)


class Network:
    """Inputs -> tanh layer -> one logit, divided by the temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(11)
        self.temperature, self.constant = 1.0, None
        if len(set(y.tolist())) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-4
        x = (x - self.mean) / self.scale
        held = rng.random(len(x)) < 0.2
        if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
            held = np.zeros(len(x), bool)
        w = [rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        xt, yt = x[~held], y[~held].astype(float)
        for _ in range(EPOCHS):
            for at in np.array_split(rng.permutation(len(xt)), max(1, len(xt) // 256)):
                step += 1
                for i, g in enumerate(gradients(w, xt[at], yt[at])):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    w[i] = w[i] - 3e-3 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.w = w
        own = held if held.any() else ~held
        logits, labels = self._logits(x[own]), y[own]
        self.temperature = float(min(np.geomspace(0.25, 16, 97), key=lambda t: self._loss(logits / t, labels)))

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    @staticmethod
    def _loss(z: np.ndarray, y: np.ndarray) -> float:
        return float(np.mean(np.logaddexp(0, z) - y * z))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._logits((x - self.mean) / self.scale) / self.temperature, -30, 30)))


def _inputs(held: Iterable[bytes], words) -> np.ndarray:
    """The network's inputs for texts as they are."""
    rows, vectors, weights = words.value
    hashes, flags, found = numbered(held)
    starts, flat = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64), np.concatenate([np.zeros(0, np.int32), *found])
    return _pooled_texts(*marked(rows.of(hashes)[flat], flags[flat], starts), vectors, weights)


def _pooled_texts(cells: np.ndarray, sizes: np.ndarray, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.stack([pooled(x, vectors, weights) for x in np.split(cells, np.cumsum(sizes)[:-1])]) if len(sizes) else np.zeros((0, 2 * DIMS), np.float32)


def _pool_rows(words) -> object:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, held in blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([x.tobytes() for x in _inputs(held, words)], pa.binary())], names=["doc_id", "x"])

    return run


def _score_blocks(words, network) -> object:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, vectors, weights = words.value
        for batch in batches:
            for ids, cells, sizes in texts_of(batch, rows):
                score = network.value.score(_pooled_texts(cells, sizes, vectors, weights))
                out = [i is not None and zlib.crc32(str(i).encode()) % FOLDS == 0 for i in ids]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out), pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
        give_back()

    return run


def in_learning_fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS != 0


def fit(docs: DataFrame, labels: DataFrame, words) -> Network:
    """Trains on at most TRAIN_ROWS labelled documents of ``docs`` outside the held-out fold."""
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("y")).where(in_learning_fold(F.col("doc_id")) & F.col("y").isNotNull())
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(TRAIN_ROWS)
    # At most TRAIN_ROWS rows of two numbers: small enough to send, so that no text is shuffled.
    wanted = F.broadcast(sample.select("doc_id").distinct())
    pools = texts(docs).join(wanted, "doc_id", "left_semi").mapInArrow(_pool_rows(words), "doc_id long, x binary")
    at = {r["doc_id"]: bytes(r["x"]) for r in pools.groupBy("doc_id").agg(F.min("x").alias("x")).collect()}
    pairs = sorted((r["doc_id"], at[r["doc_id"]], r["y"]) for r in sample.collect() if r["doc_id"] in at)
    x = np.stack([np.frombuffer(p[1], np.float32) for p in pairs]).astype(float) if pairs else np.zeros((0, 2 * DIMS))
    return Network(x, np.asarray([p[2] for p in pairs], np.int64))


def _fitted(docs: DataFrame, labels: DataFrame, parts: DataFrame) -> tuple:
    """(words: rows, vectors and weights; network), both broadcast, from the texts ``docs`` that ``parts`` holds as numbers."""
    context, rows = docs.sparkSession.sparkContext, Rows(frequent_words(parts))
    words = context.broadcast((rows, *word_vectors(parts, rows)))
    network = context.broadcast(fit(docs, labels, words))
    give_back()  # the driver, too, lives on
    return words, network


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    parts = packed(docs)
    words, network = _fitted(docs, labels, parts)
    return parts.select("doc_ids", "hashes", "flags", "tokens").mapInArrow(_score_blocks(words, network), RESULT_SCHEMA)


def _in_pieces(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[list[bytes]]:
    """The texts of a column (null: empty), so many at once as have a bounded number of bytes, or a single longer one."""
    held, size = [], 0
    for t in column:
        text = (t.as_py() or "").encode()
        if held and size + len(text) > most_bytes:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def _keep_rows(words, network, at: int) -> object:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [network.value.score(_inputs(held, words)) >= THRESHOLD for held in _in_pieces(batch.column(at))]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0, bool), *keep])))
        give_back()

    return run


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that are predicted to be of quality 1."""
    parts = packed(docs)
    words, network = _fitted(docs, labels, parts)
    free(parts)
    return docs.mapInArrow(_keep_rows(words, network, docs.columns.index("text")), docs.schema)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

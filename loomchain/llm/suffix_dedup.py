"""Exact substring dedup by a depth-limited radix sort of suffixes, most significant digit first.

Suffixes are ordered only through their first ``LENGTH`` bytes, in three digits, and groups that hold a single document leave after
each.  What is left equal after the last digit are exactly the repeated windows.

* Digit 1 is the window's anchor: the ``GRAM``-byte string with the least hash in it.  Equal windows have equal anchors at equal
  places.  Neighbouring windows share an anchor occurrence and go on together as one segment, so about one suffix in ten is
  moved at all.
* Digit 2 is the whole segment, the bytes of all its windows.  If all segments of an anchor are equal, their windows are decided.
* Digit 3 is the single window, for the segments of anchors with several different ones.

Each pass sends hashes from blocks of documents to buckets of digits and gets back one or two bits for each.  A block sends a digit
once however often it holds it, with its smallest doc_id, so a passage that stands in every document is one entry for each block.
The texts are packed into blocks, whose segments are found once, and dealt once into a table bucketed by block, one file for each
bucket; every pass joins its bits to that table in place.  Digits are hashes of 40 bits and more for the first pass, which only prunes,
and of over 100 bits for the others.

Null or empty text: nothing to remove.  Texts shorter than the length have no windows.  Rows with a null doc_id neither remove nor
lose anything; rows that repeat a doc_id don't remove from each other, as neither id is smaller.  A very long text is a block of its
own, handled whole in slices.  Other columns, whatever their names, are not read.  Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import blocks, cut, drop_on_exit, from_planes, planes, shared_dir, shuffle_partitions, table, texts

#: Bytes of a repeated string.
LENGTH = 50
#: Bytes of an anchor: long enough to be rare, short enough to leave few anchors.
GRAM = 32
#: Window starts that are hashed at once.
SLICE = 2 << 20
#: Bytes of text in a block.
BLOCK = 4 << 20

U = np.uint64
_POSITION_BITS = 24

BLOCK_SCHEMA = "block long, payload binary, segments binary"
REQUEST_SCHEMA = "bucket int, block long, low binary, key binary, doc_id binary, several binary"
REPLY_SCHEMA = "block long, digit int, bucket int, bits binary, mixed binary"
RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=U) * U(2) + U(1)


_GRAM_TABLE, _FIRST_TABLE, _SECOND_TABLE = _table(1), _table(2), _table(3)
_GRAM_BASE, _FIRST_BASE, _SECOND_BASE = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` bytes of ``data``, put together from powers of two."""
    power, size, base = _GRAM_TABLE[data], 1, _GRAM_BASE
    out, done = None, 0
    while length:
        if length & 1:
            if out is None:
                out = power
            else:
                n = min(len(out), len(power) - done)
                out = out[:n] * base + power[done : done + n]
            done += size
        length >>= 1
        if length:
            power = power[:-size] * base + power[size:]
            base, size = U(int(base) ** 2 % (1 << 64)), size * 2
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def window_hash(data: np.ndarray, at: np.ndarray, values: np.ndarray, base: np.uint64, length: int) -> np.ndarray:
    out = np.zeros(len(at), U)
    for i in range(length):
        out = out * base + values[data[at + i]]
    return _mixed(out)


def cut_segments(data: np.ndarray, starts: np.ndarray, known: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, the anchor's place behind the first) of the segments of texts that begin at ``starts``; none of those not ``known``."""
    parts = [(np.zeros(0, np.int64),) * 3]
    for lo in range(0, max(0, len(data) - length + 1), SLICE):
        parts.append(_slice_segments(data, starts, known, lo, min(lo + SLICE, len(data) - length + 1), length, gram))
    first, last, place = (np.concatenate(x) for x in zip(*parts))
    return first, last, place


def _slice_segments(data: np.ndarray, starts: np.ndarray, known: np.ndarray, lo: int, hi: int, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The same for windows from ``lo`` to before ``hi``."""
    hashes = _mixed(rolling(data[lo : hi + length - 1], gram))
    # The hash's high bits give the order and the position below them the leftmost of equal ones.
    places = (hashes & ~U((1 << _POSITION_BITS) - 1)) | np.arange(len(hashes), dtype=U)
    least = (sliding_min(places, length - gram + 1) & U((1 << _POSITION_BITS) - 1)).astype(np.int64)
    valid = np.ones(hi - lo + 1, bool)  # a window past the end closes the last run
    valid[-1] = False
    for d in range(np.searchsorted(starts, lo, "right") - 1, np.searchsorted(starts, hi, "left")):
        a, b = int(starts[d]), int(starts[d + 1])
        if known[d]:
            a = max(a, b - length + 1)
        valid[max(0, a - lo) : max(0, b - lo)] = False
    where = np.flatnonzero(valid)
    if not len(where):
        return (np.zeros(0, np.int64),) * 3
    at = least[where]
    fresh = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    first, last = where[fresh], where[np.concatenate([fresh[1:], [len(at)]]) - 1]
    return first + lo, last + lo, at[fresh] - first


class Block:
    """A block's texts, and the segments of windows that share an anchor occurrence."""

    def __init__(self, payload: bytes, segments: bytes, length: int, gram: int):
        unpack = zstandard.ZstdDecompressor()
        raw = unpack.decompress(payload)
        n = int.from_bytes(raw[:8], "little")
        self.ids = np.frombuffer(raw, np.int64, n, 8)
        self.known = np.frombuffer(raw, np.uint8, n, 8 + 8 * n).astype(bool)
        self.sizes = np.frombuffer(raw, np.int64, n, 8 + 9 * n)
        self.data = np.frombuffer(raw, np.uint8, offset=8 + 17 * n)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        steps, spans, self.place = np.split(from_planes(unpack.decompress(segments)), 3)
        self.last = np.cumsum(steps + spans)
        self.first = self.last - spans
        self.anchor = window_hash(self.data, self.first + self.place, _GRAM_TABLE, _GRAM_BASE, gram)
        self.row = np.searchsorted(self.starts, self.first, "right") - 1
        self.doc = self.ids[self.row]


def packed_segments(first: np.ndarray, last: np.ndarray, place: np.ndarray) -> bytes:
    """Segments as (steps from the last window before to the first, windows after the first, place of the anchor), all small."""
    before = np.concatenate([[0], last[:-1]]) if len(last) else last
    return planes(np.concatenate([first - before, last - first, place]))


class Digits:
    """The distinct digits of a block in the order of their buckets, and which one each occurrence has."""

    def __init__(self, high: np.ndarray, key: np.ndarray | None, doc: np.ndarray, bits: int):
        high = _mixed(high ^ U(0x5851F42D4C957F2D))
        bucket, low = (high >> U(64 - bits)).astype(np.int64), (high >> U(24 - bits)) & U((1 << 40) - 1)
        # By bucket and then by one number for the whole digit: any order will do that brings equal digits together.
        rest = low if key is None else _mixed(low ^ (key * _SECOND_BASE)) >> U(bits)
        order = np.argsort(rest | (bucket.astype(U) << U(64 - bits)))
        same = (bucket[order][1:] == bucket[order][:-1]) & (low[order][1:] == low[order][:-1])
        if key is not None:
            same &= key[order][1:] == key[order][:-1]
        head = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else np.zeros(0, np.int64)
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(np.concatenate([[0], ~same])) if len(order) else 0
        self.bucket, self.low = bucket[order][head], low[order][head]
        self.doc = np.minimum.reduceat(doc[order], head) if len(order) else doc
        self.several = (np.maximum.reduceat(doc[order], head) if len(order) else doc) != self.doc
        self.key = None if key is None else key[order][head]
        self.cuts = np.searchsorted(self.bucket, np.arange((1 << bits) + 1))

    def requests(self, block: int) -> list[tuple]:
        out = []
        for b in np.flatnonzero(np.diff(self.cuts)):
            a, z = self.cuts[b], self.cuts[b + 1]
            low, doc = self.low[a:z], self.doc[a:z]
            base = int(doc.min())
            kind = next(k for k in ("<u2", "<u4", "<u8") if int(doc.max()) - base < 1 << (8 * int(k[2])))
            out.append((
                int(b), block, low.astype("<u4").tobytes() + (low >> U(32)).astype(np.uint8).tobytes(),
                None if self.key is None else self.key[a:z].astype("<u8").tobytes(),
                None if self.key is None else kind[2].encode() + base.to_bytes(8, "little", signed=True) + (doc - base).astype(kind).tobytes(),
                np.packbits(self.several[a:z]).tobytes() if self.key is None else None,
            ))
        return out

    def answers(self, replies: dict[int, tuple[bytes, bytes | None]], nth: int) -> np.ndarray:
        """For each occurrence, the bit that came back for its digit."""
        bits = np.zeros(len(self.bucket), bool)
        for b, reply in replies.items():
            a, z = self.cuts[b], self.cuts[b + 1]
            bits[a:z] = np.unpackbits(np.frombuffer(reply[nth], np.uint8), count=z - a).astype(bool)
        return bits[self.of]


def _pack(block_bytes: int, length: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for block, ids, held in blocks(batches, block_bytes):
            known, sizes, data = np.asarray([x is not None for x in ids]), np.asarray([len(x) for x in held], np.int64), b"".join(held)
            segments = cut_segments(np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(sizes)]), known, length, gram)
            head = np.asarray([x or 0 for x in ids], np.int64).tobytes() + known.tobytes() + sizes.tobytes()
            columns = [block], [squeeze.compress(len(ids).to_bytes(8, "little") + head + data)], [squeeze.compress(packed_segments(*segments))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], names=["block", "payload", "segments"])

    return run


def _request_table(rows: list[tuple]) -> pa.Table:
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    cols = list(zip(*rows)) or [()] * 6
    return pa.table([pa.array(c, t) for c, t in zip(cols, types)], names=["bucket", "block", "low", "key", "doc_id", "several"])


class Passes:
    """What a block does in each pass, given the bits that came back from the passes before."""

    def __init__(self, length: int, gram: int, bits: int):
        self.length, self.gram, self.bits = length, gram, bits

    def first(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload, segments in zip(batch["block"].to_pylist(), batch["payload"], batch["segments"]):
                block = Block(payload.as_py(), segments.as_py(), self.length, self.gram)
                yield from _request_table(Digits(block.anchor, None, block.doc, self.bits).requests(number)).to_batches()

    def _second(self, block: Block, replies: dict) -> tuple[np.ndarray, Digits]:
        """(segments left, their digits)."""
        left = np.flatnonzero(Digits(block.anchor, None, block.doc, self.bits).answers(replies.get(1, {}), 0))
        one = window_hash(block.data, block.first[left], _FIRST_TABLE, _FIRST_BASE, self.length)
        two = window_hash(block.data, block.last[left], _FIRST_TABLE, _FIRST_BASE, self.length)
        shape = ((block.last - block.first)[left] * self.length + block.place[left]).astype(U)
        return left, Digits(block.anchor[left], _mixed(one + _mixed(two + _mixed(shape))), block.doc[left], self.bits)

    def _third(self, block: Block, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, Digits]:
        """(windows, their doc_ids, their digits) of the segments ``left``."""
        count = (block.last - block.first)[left] + 1
        at = np.repeat(block.first[left] - np.cumsum(count) + count, count) + np.arange(count.sum())
        doc = np.repeat(block.doc[left], count)
        one = window_hash(block.data, at, _FIRST_TABLE, _FIRST_BASE, self.length)
        return at, doc, Digits(one, window_hash(block.data, at, _SECOND_TABLE, _SECOND_BASE, self.length), doc, self.bits)

    def _given(self, left: pa.Table, right: pa.Table) -> tuple[int, Block, dict]:
        replies: dict[int, dict] = {}
        for r in right.to_pylist():
            replies.setdefault(r["digit"], {})[r["bucket"]] = (r["bits"], r["mixed"])
        return left["block"][0].as_py(), Block(left["payload"][0].as_py(), left["segments"][0].as_py(), self.length, self.gram), replies

    def second(self, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _request_table([])
        number, block, replies = self._given(left, right)
        return _request_table(self._second(block, replies)[1].requests(number))

    def third(self, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _request_table([])
        number, block, replies = self._given(left, right)
        segments, digits = self._second(block, replies)
        return _request_table(self._third(block, segments[digits.answers(replies.get(2, {}), 1)])[2].requests(number))

    def last(self, left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows:
            _, block, replies = self._given(left, right)
            segments, digits = self._second(block, replies)
            mixed = digits.answers(replies.get(2, {}), 1)
            gone = ~mixed & (digits.answers(replies.get(2, {}), 0) | (block.doc[segments] > digits.doc[digits.of]))
            at, doc, windows = self._third(block, segments[mixed])
            single = at[windows.answers(replies.get(3, {}), 0) | (doc > windows.doc[windows.of])]
            delta = np.zeros(len(block.data) + 1, np.int32)
            for starts, ends in ((block.first[segments[gone]], block.last[segments[gone]] + self.length), (single, single + self.length)):
                np.add.at(delta, starts, 1)
                np.add.at(delta, ends, -1)
            removed = np.cumsum(delta[:-1]) > 0
            for i, known in enumerate(block.known):
                a, z = block.starts[i], block.starts[i + 1]
                own = removed[a:z]
                spans = int(np.count_nonzero(own[1:] & ~own[:-1]) + (1 if len(own) and own[0] else 0))
                kept = block.data[a:z][~own].tobytes() if spans else block.data[a:z].tobytes()
                rows.append((int(block.ids[i]) if known else None, int(z - a), int(own.sum()), spans, hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*rows)) or [()] * 5
        return pa.table([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _low(data: bytes) -> np.ndarray:
    n = len(data) // 5
    return np.frombuffer(data, "<u4", n).astype(U) | (np.frombuffer(data, np.uint8, n, 4 * n).astype(U) << U(32))


def _doc_ids(data: bytes) -> np.ndarray:
    kind = f"<u{data[:1].decode()}"
    return np.frombuffer(data, kind, offset=9).astype(np.int64) + int.from_bytes(data[1:9], "little", signed=True)


def _reply_table(part: pa.Table, digit: int, sizes: list[int], bits: np.ndarray, mixed: np.ndarray | None) -> pa.Table:
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    pack = lambda x: [np.packbits(x[a:z]).tobytes() for a, z in zip(cuts[:-1], cuts[1:])]
    return pa.table([part["block"].combine_chunks(), pa.array([digit] * len(sizes), pa.int32()), part["bucket"].combine_chunks(), pa.array(pack(bits), pa.binary()), pa.array([None] * len(sizes) if mixed is None else pack(mixed), pa.binary())], names=["block", "digit", "bucket", "bits", "mixed"])


def _shared_anchors(part: pa.Table) -> pa.Table:
    """Of one bucket of anchors: whether each stands in more than one document."""
    lows = [_low(x.as_py()) for x in part["low"]]
    several = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(n)) for x, n in zip(part["several"], lows)]).astype(bool)
    low = np.concatenate(lows)
    order = np.argsort(low)
    head = np.concatenate([[True], low[order][1:] != low[order][:-1]])
    group = np.cumsum(head) - 1
    shared = (np.bincount(group) > 1) | (np.bincount(group, weights=several[order]) > 0)
    bits = np.empty(len(low), bool)
    bits[order] = shared[group]
    return _reply_table(part, 1, [len(x) for x in lows], bits, None)


def _ranked(digit: int):
    def run(part: pa.Table) -> pa.Table:
        """Of one bucket: whether a smaller doc_id has the same digit, and whether others share only its first part."""
        lows = [_low(x.as_py()) for x in part["low"]]
        low, key = np.concatenate(lows), np.concatenate([np.frombuffer(x.as_py(), "<u8") for x in part["key"]])
        doc = np.concatenate([_doc_ids(x.as_py()) for x in part["doc_id"]])
        order = np.lexsort((doc, key, low))
        l, k, d = low[order], key[order], doc[order]
        new_low = np.concatenate([[True], l[1:] != l[:-1]])
        new_key = new_low | np.concatenate([[True], k[1:] != k[:-1]])
        group = np.cumsum(new_key) - 1
        top = np.cumsum(new_low) - 1
        bits, mixed = np.empty(len(low), bool), np.empty(len(low), bool)
        bits[order] = d > d[new_key][group]
        mixed[order] = (np.bincount(top, weights=new_key) > 1)[top]
        return _reply_table(part, digit, [len(x) for x in lows], bits, mixed)

    return run


def _block_table(docs: DataFrame, block_bytes: int, length: int, gram: int) -> DataFrame:
    """The blocks as a table that is bucketed by block, so that passes join to it without moving it."""
    spark = docs.sparkSession
    name, n = f"loomchain_blocks_{uuid.uuid4().hex}", shuffle_partitions(spark)
    packed = texts(docs).mapInArrow(_pack(block_bytes, length, gram), BLOCK_SCHEMA)
    at = f"{shared_dir(spark)}/{name}"
    # Dealt first, so that a bucket is one file and not one for each task that has blocks for it.
    packed.repartition(n, "block").write.bucketBy(n, "block").sortBy("block").option("path", at).saveAsTable(name)
    drop_on_exit(spark, at)
    held = spark.table(name)
    held.schema  # resolved, with its files and buckets, before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return held


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: its bytes, those covered by a string of ``length`` bytes that starts in a smaller doc_id, and what is left."""
    spark = docs.sparkSession
    bits = (2 * shuffle_partitions(spark) - 1).bit_length()
    passes = Passes(length, gram, bits)
    held = _block_table(docs, block_bytes, length, gram)
    by_block = lambda replies, f, schema: held.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(lambda left, right: f(left, right), schema)
    replies = cut(held.mapInArrow(passes.first, REQUEST_SCHEMA).groupBy("bucket").applyInArrow(_shared_anchors, REPLY_SCHEMA), "anchors")
    for digit, ask in ((2, passes.second), (3, passes.third)):
        asked = by_block(replies, ask, REQUEST_SCHEMA)
        replies = replies.unionByName(cut(asked.groupBy("bucket").applyInArrow(_ranked(digit), REPLY_SCHEMA), f"digit{digit}"))
    return by_block(replies, passes.last, RESULT_SCHEMA)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))


OP1_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
), sized AS (
  SELECT *, octet_length(b) AS n FROM docs
), windows AS (
  SELECT r, doc_id, i, b[i:i + {LENGTH - 1}] AS w FROM (SELECT *, unnest(range(1, n - {LENGTH - 2})) AS i FROM sized)
), least AS (
  SELECT w, min(doc_id) AS least FROM windows GROUP BY w HAVING count(*) > 1
), gone AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM windows JOIN least USING (w) WHERE least < doc_id
), runs AS (
  SELECT r, min(i) AS a, max(i) + {LENGTH - 1} AS z FROM (
    SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM gone)
  GROUP BY r, run
), pieces AS (
  SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) + 1 AS x, a - 1 AS y FROM runs
  UNION ALL SELECT s.r, coalesce(max(z), 0) + 1, any_value(n) FROM sized s LEFT JOIN runs USING (r) GROUP BY s.r
), kept AS (
  SELECT r, sha256(from_hex(coalesce(string_agg(hex(b[x:y]), '' ORDER BY x) FILTER (WHERE x <= y), ''))) AS kept_sha256 FROM pieces JOIN sized USING (r) GROUP BY r
), sums AS (
  SELECT r, CAST(sum(z - a + 1) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, kept_sha256
FROM sized LEFT JOIN sums USING (r) JOIN kept USING (r)
"""

"""Packing along a space-filling curve: neighbours in content become neighbours in a sequence, and nothing is padded.

Each document's token ids give a hashed count vector, signed projections take it to a few dimensions, and the Hilbert index of
the point is the document's place on the curve.  Rows are range-partitioned and sorted by (curve key, document hash, doc_id), so
that ties, copies in their thousands among them, spread over as many partitions as their size asks for.  Each partition is then
one stream of ids, cut at every 2,048th; what remains at its end is cut at falling powers of two, which need no padding.

Ids are made once: the encoded rows are written to the shared folder before the range partitioning samples them.

Null or empty text: only the end-of-document id.  A very long text is encoded whole and cut like any other.  Rows are independent:
repeated rows and null doc_ids are packed like others.  Other columns, whatever their names, are not read.  Empty table: empty result.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import cut, give_back, rows_of, shuffle_partitions, table, texts

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
SEQUENCE = 2048
#: Dimensions of the curve and bits of each.
DIMS, BITS = 4, 12
#: Hash buckets of the count vector.
VECTOR = 512
#: Entries that a worker's table of pre-tokens may hold before it starts anew.
CACHE_ENTRIES = 50_000
#: Ids given out at once when a partition is streamed.
PIECES_PER_BATCH = 4096

ENCODED_SCHEMA = "doc_id long, curve long, tie long, n long, ids binary"
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: The tokenizer's own split never crosses these places: before a space that a non-space follows, and around other white space.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PARTS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
#: Texts with these go to the tokenizer itself: its special string; characters beyond extended Latin and general punctuation, on whose
#: classes the Unicode versions of the two libraries might differ; and very long runs without a space.  The last are no matter of
#: results: both split by the same published pattern, classes of the characters let through are the same in all versions, and both then
#: merge a part by the same ranks, lowest first and leftmost of equal ones.  But one of them merges in a time that grows with the square
#: of a part's length, and the other does not.
ITS_OWN = re.compile(r"<\|endoftext\|>|[^\x00-\u024f\u2010-\u2027\u20ac]|[^ \n]{2000}")


class Ids:
    """A text's ids as little-endian 16-bit numbers.

    Most texts are encoded by the ranks that are published beside the tokenizer's file and hold the same vocabulary, which is several
    times faster.  The others go to the tokenizer part by part, with a table of parts that is bounded by starting anew.
    """

    def __init__(self, name: str):
        import tiktoken

        self.name = name
        with open(public_tokenizers.path(name.removesuffix(".json") + ".tiktoken"), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.parts: dict[str, bytes] = {}

    @cached_property
    def tokenizer(self):
        """Loaded where a text first asks for it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(public_tokenizers.path(self.name))

    def _part(self, part: str) -> bytes:
        if (ids := self.parts.get(part)) is None:
            ids = np.asarray(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u2").tobytes()
            if len(part) <= 64:
                self.parts[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not ITS_OWN.search(text):
            return np.asarray(self.ranks.encode_ordinary(text), "<u2").tobytes()
        if "<|endoftext|>" in text:
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        out = b"".join(map(self._part, PARTS.findall(text)))
        if len(self.parts) > CACHE_ENTRIES:
            self.parts.clear()
        return out


_TABLES: dict[str, Ids] = {}


def ids_of_worker(name: str) -> Ids:
    """One encoder for each worker process, kept between its tasks."""
    if name not in _TABLES:
        _TABLES[name] = Ids(name)
    return _TABLES[name]


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of rows of unsigned coordinates (transposed-axes form of the curve, then bits interleaved)."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0]) ^ swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def _projection() -> np.ndarray:
    return np.random.default_rng(20240229).standard_normal((VECTOR, DIMS)).astype(np.float32)


def curve_keys(counts: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Counts of hashed ids, one row a document -> place on the curve."""
    v = np.sqrt(counts.astype(np.float32))
    v -= v.mean(axis=1, keepdims=True)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    at = v @ projection
    cells = np.clip(np.round((np.tanh(at) + 1) / 2 * ((1 << BITS) - 1)), 0, (1 << BITS) - 1)
    return hilbert(cells, BITS)


def _encode(name: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, projection, squeeze = ids_of_worker(name), _projection(), zstandard.ZstdCompressor(level=1)
        hashed = (np.arange(65536, dtype=np.uint32) * np.uint32(2654435761) >> np.uint32(32 - 9)).astype(np.int64)
        end = np.asarray([END_ID], "<u2").tobytes()
        for doc_ids, held in rows_of(batches):
            for at in range(0, len(doc_ids), 512):
                rows, counts = [], []
                for doc_id in doc_ids[at : at + 512]:
                    text = next(held)
                    ids = ids_of.encode(text.decode("utf-8", "replace")) + end
                    counts.append(np.bincount(hashed[np.frombuffer(ids, "<u2")], minlength=VECTOR))
                    rows.append((doc_id, xxhash.xxh64_intdigest(ids) >> 1, len(ids) // 2, squeeze.compress(ids)))
                doc, tie, n, ids = zip(*rows)
                curve = curve_keys(np.stack(counts), projection)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(curve), pa.array(tie, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "curve", "tie", "n", "ids"])

    return run


def piece_ends(total: int, sequence: int = SEQUENCE) -> Iterator[int]:
    """Lengths into which a rest of fewer ids than a sequence is cut: falling powers of two."""
    bit = sequence >> 1
    while bit:
        if total & bit:
            yield bit
        bit >>= 1


def _pack(sequence: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        base = TaskContext.get().partitionId() << 40
        nth, filled = 0, 0
        open_pieces: list[tuple] = []  # of the sequence that is being filled: (doc_id, start, ids, doc_tokens)
        out: list[tuple] = []

        def close(pieces: list[tuple]) -> None:
            nonlocal nth
            offset = 0
            for doc_id, start, ids, doc_tokens in pieces:
                out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), doc_tokens, base | nth, offset))
                offset += len(ids)
            nth += 1

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 7
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for got in batches:
            doc_ids, ns = got["doc_id"].to_pylist(), got["n"].to_pylist()
            for doc_id, n, packed in zip(doc_ids, ns, got["ids"]):
                ids = np.frombuffer(unpack.decompress(packed.as_py(), max_output_size=2 * n), "<u2")
                at = 0
                while at < n:
                    take = min(n - at, sequence - filled)
                    open_pieces.append((doc_id, at, ids[at : at + take], n))
                    at += take
                    filled += take
                    if filled == sequence:
                        close(open_pieces)
                        open_pieces, filled = [], 0
                if len(out) >= PIECES_PER_BATCH:
                    yield batch()
        for length in piece_ends(filled, sequence):
            pieces, need = [], length
            while need:
                doc_id, start, ids, doc_tokens = open_pieces.pop(0)
                pieces.append((doc_id, start, ids[:need], doc_tokens))
                if len(ids) > need:
                    open_pieces.insert(0, (doc_id, start + need, ids[need:], doc_tokens))
                need -= min(need, len(ids))
            close(pieces)
        yield batch()
        give_back()

    return run


def encoded(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    return texts(docs).mapInArrow(_encode(tokenizer), ENCODED_SCHEMA)


def pack_along_curve(docs: DataFrame, tokenizer: str = TOKENIZER, sequence: int = SEQUENCE) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = cut(encoded(docs, tokenizer), "encoded")
    # The documents' ids break ties of the curve key and of the content hash, so that no group of copies is one range.
    spread = rows.withColumn("spread", F.xxhash64("doc_id", "tie"))
    placed = spread.repartitionByRange(shuffle_partitions(docs.sparkSession), "curve", "tie", "spread").sortWithinPartitions("curve", "tie", "doc_id", "n")
    return placed.select("doc_id", "n", "ids").mapInArrow(_pack(sequence), PIECE_SCHEMA)


def op5_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_along_curve(table(spark, sf_dir, "documents"))

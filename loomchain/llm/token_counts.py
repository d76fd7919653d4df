"""Token counts without token ids: pieces are counted once per distinct pre-token and joined to pre-token frequencies.

The vocabulary's pieces never hold a space mark after another character, so a text falls apart at every place where a space
follows something else, and each part is encoded alike wherever it stands.  Blocks of documents are written once, as their distinct
pre-tokens and the frequencies of these in each document.  The pre-tokens alone are dealt by their hash; a bucket has all blocks'
occurrences of its pre-tokens, encodes each once, and sends a block one small number for each that it asked for.  There they meet the
frequencies, which stay with their block, and are summed by document.

A block asks for a pre-token once however often it holds it, so frequent words do not make a bucket large, and what is sent either way
is one entry for each distinct pre-token of a block, whatever the number of buckets; this follows spark.sql.shuffle.partitions, which is
to follow the input.

Null or empty text: no bytes, no tokens.  A very long text is a block of its own, counted whole.  Rows are counted by their place in a
block, not by doc_id, so repeated rows, null and repeated doc_ids each give their row.  Other columns, whatever their names, are not
read.  Empty table: empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import blocks, cut, from_planes, planes, shuffle_partitions, table, texts

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
#: Buckets of pre-tokens for each shuffle partition.
BUCKETS_PER_PARTITION = 2

#: A block: its rows, its distinct pre-tokens in the order of their buckets, and how often each stands in each document.
BLOCK_SCHEMA = "block long, doc_ids array<long>, n_bytes array<long>, names binary, entries binary"
REQUEST_SCHEMA = "bucket int, block long, tokens array<binary>"
REPLY_SCHEMA = "block long, bucket int, pieces binary"
RESULT_SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class _Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


@lru_cache(maxsize=2)
def processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))


def pre_tokens(text: bytes) -> list[bytes]:
    """Parts of a text, each without one leading space, which encoding gives back."""
    if not text:
        return []
    # A literal space mark is a space to the library.
    if b"\xe2\x96\x81" in text:
        text = text.replace(b"\xe2\x96\x81", b" ")
    parts = text.split(b" ")
    if b"" not in parts:
        return parts
    # Runs of spaces belong to what follows them; at the end of the text they stand alone.
    out, held = [], 0
    for p in parts:
        if p:
            out.append(b" " * held + p)
            held = 0
        else:
            held += 1
    if held:
        # The last part of the split stands for no further space, but for the one that every pre-token gives back.
        out.append(b" " * (held - 1))
    return out


def _pack(n_buckets: int, most_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for block, ids, held in blocks(batches, most_bytes):
            seen, found = _Numbers(), []
            for text in held:
                parts = pre_tokens(text)
                found.append(np.fromiter(map(seen.__getitem__, parts), np.int64, len(parts)))
            names = list(seen)
            buckets = np.fromiter((zlib.crc32(x) % n_buckets for x in names), np.int64, len(names))
            order = np.argsort(buckets, kind="stable")
            place = np.empty(len(names), np.int64)
            place[order] = np.arange(len(names))
            n = max(1, len(names))
            keys, freqs = np.unique(np.repeat(np.arange(len(held)), [len(f) for f in found]) * n + place[np.concatenate(found)], return_counts=True)
            doc, token = np.divmod(keys, n)
            # A document's pre-tokens by their distances, from its first one on.
            steps = np.where(np.diff(doc, prepend=-1) > 0, token, np.diff(token, prepend=0))
            entries = planes(np.concatenate([np.bincount(doc, minlength=len(held)), steps, freqs]))
            sizes = np.fromiter(map(len, names), np.int64, len(names))[order]
            columns = [[block], [ids], [[len(x) for x in held]], [squeeze.compress(len(names).to_bytes(8, "little") + planes(sizes) + b"".join(names[i] for i in order))], [squeeze.compress(entries)]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "doc_ids", "n_bytes", "names", "entries"])

    return run


def _ask(n_buckets: int):
    """A block's distinct pre-tokens, one row for each bucket that has any."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for block, packed in zip(batch["block"].to_pylist(), batch["names"]):
                raw = unpack.decompress(packed.as_py())
                n = int.from_bytes(raw[:8], "little")
                ends = 8 + 4 * n + np.cumsum(from_planes(raw[8 : 8 + 4 * n]))
                names = [raw[a:z] for a, z in zip([8 + 4 * n, *ends[:-1].tolist()], ends.tolist())]
                buckets = np.fromiter((zlib.crc32(x) % n_buckets for x in names), np.int64, n)
                cuts = np.searchsorted(buckets, np.arange(n_buckets + 1))
                own = np.flatnonzero(np.diff(cuts))
                offsets = pa.array(np.concatenate([cuts[own], [n]]).astype(np.int32), pa.int32())
                tokens = pa.ListArray.from_arrays(offsets, pa.array(names, pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(np.full(len(own), block), pa.int64()), tokens], names=["bucket", "block", "tokens"])

    return run


def _count_pieces(model: str):
    def run(part: pa.Table) -> pa.Table:
        """Of one bucket: each distinct pre-token's number of pieces, given to every block in the order in which it asked."""
        sp = processor(model)
        tokens = pc.list_flatten(part["tokens"]).combine_chunks()
        if isinstance(tokens, pa.ChunkedArray):
            tokens = pa.concat_arrays(tokens.chunks) if tokens.num_chunks else pa.array([], pa.binary())
        coded = tokens.dictionary_encode()
        distinct = [x.decode("utf-8", "replace") for x in coded.dictionary.to_pylist()]
        pieces = np.zeros(len(distinct), np.int64)
        for at in range(0, len(distinct), 4096):
            pieces[at : at + 4096] = [len(x) for x in sp.encode(distinct[at : at + 4096], num_threads=1)]
        # An empty pre-token is a single space mark.
        pieces[[i for i, x in enumerate(distinct) if not x]] = 1
        weights = pieces[coded.indices.to_numpy(zero_copy_only=False)]
        cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(part["tokens"]).to_numpy())])
        replies = []
        for a, z in zip(cuts[:-1], cuts[1:]):
            kind = "<u1" if weights[a:z].max(initial=0) < 256 else "<u4"
            replies.append(kind[2].encode() + weights[a:z].astype(kind).tobytes())
        return pa.table([part["block"].combine_chunks(), part["bucket"].combine_chunks(), pa.array(replies, pa.binary())], names=["block", "bucket", "pieces"])

    return run


def _sum_block(limit: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:  # replies without their block: none
            return pa.table([pa.array([], pa.int64())] * 3 + [pa.array([], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
        replies = sorted((r["bucket"], r["pieces"]) for r in right.to_pylist())
        pieces = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, f"<u{x[:1].decode()}", offset=1).astype(np.int64) for _, x in replies)])
        doc_ids, n_bytes = left["doc_ids"][0].as_py(), left["n_bytes"][0].as_py()
        numbers = from_planes(zstandard.ZstdDecompressor().decompress(left["entries"][0].as_py()))
        each, rest = numbers[: len(doc_ids)], numbers[len(doc_ids) :]
        steps, freqs, ends = rest[: len(rest) // 2], rest[len(rest) // 2 :], np.cumsum(each)
        walked = np.concatenate([[0], np.cumsum(steps)])
        token = walked[1:] - np.repeat(walked[ends - each], each)
        sums = np.concatenate([[0], np.cumsum(pieces[token] * freqs)])
        total = sums[ends] - sums[ends - each]
        return pa.table([pa.array(doc_ids, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(total, pa.int64()), pa.array(total > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def requests(parts: DataFrame, n_buckets: int) -> DataFrame:
    return parts.select("block", "names").mapInArrow(_ask(n_buckets), REQUEST_SCHEMA)


def replies(asked: DataFrame, model: str) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(_count_pieces(model), REPLY_SCHEMA)


def packed(docs: DataFrame, n_buckets: int, block_bytes: int) -> DataFrame:
    return cut(texts(docs).mapInArrow(_pack(n_buckets, block_bytes), BLOCK_SCHEMA), "blocks")


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = TOKEN_LIMIT, block_bytes: int = 12 << 20) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens and whether these are over ``limit``."""
    n = BUCKETS_PER_PARTITION * shuffle_partitions(docs.sparkSession)
    parts = packed(docs, n, block_bytes)
    counted = replies(requests(parts, n), model)
    return parts.drop("names").groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_sum_block(limit), RESULT_SCHEMA)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))

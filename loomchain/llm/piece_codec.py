"""Encoding and decoding with merge-type piece vocabularies: a score-ordered agenda of adjacent symbol pairs.

A text falls apart into pre-tokens where a space follows something else (``token_counts.pre_tokens``); no piece reaches over such a place, which
is verified when a vocabulary is loaded.  Blocks of documents are encoded where they are read, without a shuffle: the distinct pre-tokens
of a block go through the agenda together, and each document's ids are gathered from theirs.

The agenda holds the adjacent pairs that a piece spells, ordered by the piece's score and then from left to right.  The first one is
merged, the pairs beside it are looked up anew, and so on until none is left.  Short pre-tokens share one agenda as arrays, where each round
takes the first pair of every pre-token; a pre-token of over ``LONG`` symbols has a heap of its own, so that its time grows with n log n.
Symbols that are no piece become the pieces of their bytes.

Both directions are checked against the sentencepiece library in each batch: ids of every distinct pre-token, and the text that it
decodes from every document's ids.  ``agrees`` is false for a document that fails; what the agenda and the decoder gave stays.

Null or empty text: no ids, empty decoded text.  A very long text is a block of its own.  Rows are encoded by their place in a block, so repeated
rows, null and repeated doc_ids each give their row.  Pairs of one score go from left to right, as in the library.  Other columns, whatever
their names, are not read.  Empty table: empty result.  Null ids decode to null; null entries and ids that the vocabulary lacks make it null, too.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import blocks, give_back, table, texts
from loomchain.llm.token_counts import MODEL, _Numbers, pre_tokens, processor
from loomchain.shipping import ship

#: Symbols beyond which on a pre-token has an agenda of its own.
LONG = 64
#: Distinct pre-tokens that share one agenda: its arrays stay in a processor's cache.
TOGETHER = 1 << 12
MARK = "▁"
#: What the library writes for an unknown piece and for a byte that is no UTF-8.
UNKNOWN_TEXT, BROKEN_BYTE = " ⁇ ", "�"
ENCODED_SCHEMA = "doc_id long, ids array<int>, decoded binary, agrees boolean"
_NONE = np.int64(1) << 40


class Vocabulary:
    """Symbols are numbers: a piece's id, or the number of pieces plus a character's code point where the character is no piece."""

    def __init__(self, model: str):
        sp = processor(model)
        n = self.n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError(f"{model}: unused pieces are not supported")
        self.unknown = sp.unk_id()
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in range(n) if sp.is_byte(i)}
        self.of_byte = np.full(256, self.unknown, np.int64)
        for i, b in self.byte_of.items():
            self.of_byte[b] = i
        ids = {p: i for i, p in enumerate(self.pieces) if i != self.unknown and i not in self.control and i not in self.byte_of}
        if any(MARK in p.lstrip(MARK) for p in ids):
            raise ValueError(f"{model}: a piece holds a space mark after another character")
        self.symbols = np.arange(n, n + 0x110000, dtype=np.int64)
        for p, i in ids.items():
            if len(p) == 1:
                self.symbols[ord(p)] = i
        symbol = lambda s: ids.get(s, n + ord(s) if len(s) == 1 else None)
        # Every way in which a piece splits into two symbols, in the order of the pieces' scores.
        steps = {s: k for k, s in enumerate(sorted({-sp.get_score(i) for i in ids.values()}))}
        found = {}
        for p, i in ids.items():
            for at in range(1, len(p)):
                a, b = symbol(p[:at]), symbol(p[at:])
                if a is not None and b is not None:
                    found[a, b] = (steps[-sp.get_score(i)], i)
        self.pairs = found
        keys = np.array([a * self.span + b for a, b in found], np.int64)
        order = np.argsort(keys)
        self.keys, values = np.append(keys[order], np.iinfo(np.int64).max), np.array(list(found.values()), np.int64).reshape(-1, 2)
        self.ranks, self.merged = np.append(values[order, 0], _NONE), np.append(values[order, 1], -1)
        # What a piece reads as, for decoding.
        self.text_of = [b"" if i in self.control else UNKNOWN_TEXT.encode() if i == self.unknown else bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        self.lengths = np.array([len(x) for x in self.text_of], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.text_of), np.uint8)

    @property
    def span(self) -> int:
        return self.n + 0x110000

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the agenda, merged symbol) of pairs; ``_NONE`` where no piece spells the pair."""
        keys = left * self.span + right
        at = np.searchsorted(self.keys, keys)
        hit = self.keys[at] == keys
        return np.where(hit, self.ranks[at], _NONE), self.merged[at]


@lru_cache(maxsize=2)
def vocabulary(model: str) -> Vocabulary:
    return Vocabulary(model)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of runs one behind the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def merge_one(v: Vocabulary, symbols: list[int]) -> list[int]:
    """One pre-token by a heap of pairs; pairs whose symbols have changed since are passed over."""
    now, before, after = list(symbols), list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
    after[-1] = -1
    agenda: list[tuple] = []

    def add(i: int, j: int) -> None:
        if i >= 0 and j >= 0 and (found := v.pairs.get((now[i], now[j]))):
            heapq.heappush(agenda, (found[0], i, j, now[i], now[j], found[1]))

    for i in range(len(now) - 1):
        add(i, i + 1)
    while agenda:
        _, i, j, a, b, merged = heapq.heappop(agenda)
        if now[i] != a or now[j] != b or after[i] != j:
            continue
        now[i], now[j], after[i] = merged, -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        add(before[i], i)
        add(i, after[i])
    return [s for s in now if s >= 0]


def merge_together(v: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Many pre-tokens' symbols, one behind the other: what is left of them and how many each has."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    done_symbols, done_owner = [], []
    ranks = np.full(len(symbols), _NONE)
    merged = np.full(len(symbols), -1)
    inside = np.flatnonzero(owner[:-1] == owner[1:])
    ranks[inside], merged[inside] = v.look_up(symbols[inside], symbols[inside + 1])
    while len(symbols):
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(np.append(heads, len(owner)))
        # The first pair of the agenda: the least rank, then the leftmost place.
        places = ranks * len(symbols) + np.arange(len(symbols))
        least = np.minimum.reduceat(places, heads)
        open_ = least < _NONE * len(symbols)
        if not open_.all():
            stays = np.repeat(open_, sizes)
            done_symbols.append(symbols[~stays])
            done_owner.append(owner[~stays])
            shift = np.cumsum(~stays)
            at = least[open_] % len(symbols)
            at -= shift[at]
            symbols, owner, ranks, merged = symbols[stays], owner[stays], ranks[stays], merged[stays]
        else:
            at = least % len(symbols)
        if not len(symbols):
            break
        symbols[at] = merged[at]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        # Where the merged symbols stand once their right halves are gone: one half goes for each pre-token before.
        at = at - np.arange(len(at))
        symbols, owner, ranks, merged = symbols[keep], owner[keep], ranks[keep], merged[keep]
        for i in (at, at - 1):
            if i is not at:
                i = i[(i >= 0) & (owner[np.maximum(i, 0)] == owner[at])]
            last = i + 1 >= len(symbols)
            j = np.where(last, i, i + 1)
            paired = ~last & (owner[i] == owner[j])
            ranks[i], merged[i] = _NONE, -1
            i, j = i[paired], j[paired]
            ranks[i], merged[i] = v.look_up(symbols[i], symbols[j])
    owner = np.concatenate([np.zeros(0, np.int64), *done_owner])
    order = np.argsort(owner, kind="stable")
    return np.concatenate([np.zeros(0, np.int64), *done_symbols])[order], np.bincount(owner, minlength=len(lengths))


def _as_pieces(v: Vocabulary, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that are no piece become the pieces of their bytes."""
    odd = np.flatnonzero(symbols >= v.n)
    if not len(odd):
        return symbols, counts
    spelled = [v.of_byte[np.frombuffer(chr(s - v.n).encode("utf-8", "surrogatepass"), np.uint8)] for s in symbols[odd].tolist()]
    if not v.byte_of:
        spelled = [np.array([v.unknown])] * len(odd)
    width = np.ones(len(symbols), np.int64)
    width[odd] = [len(x) for x in spelled]
    out = np.repeat(symbols, width)
    out[ragged((np.cumsum(width) - width)[odd], width[odd])] = np.concatenate(spelled)
    owner = np.repeat(np.arange(len(counts)), counts)
    return out, np.bincount(np.repeat(owner, width), minlength=len(counts))


def encode_distinct(v: Vocabulary, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids one behind the other, how many each has) of pre-tokens, each of which stands for itself behind one space."""
    ids, counts = [], np.zeros(len(names), np.int64)
    for at in range(0, len(names), TOGETHER):
        some = [MARK + x.replace(" ", MARK) for x in names[at : at + TOGETHER]]
        symbols = v.symbols[np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), "<u4")]
        lengths = np.fromiter(map(len, some), np.int64, len(some))
        starts = np.cumsum(lengths) - lengths
        long = np.flatnonzero(lengths > LONG)
        short = np.flatnonzero(lengths <= LONG)
        left, n = merge_together(v, symbols[ragged(starts[short], lengths[short])], lengths[short])
        if len(long):
            own = [merge_one(v, symbols[a : a + k].tolist()) for a, k in zip(starts[long].tolist(), lengths[long].tolist())]
            sizes = np.zeros(len(some), np.int64)
            sizes[short], sizes[long] = n, [len(x) for x in own]
            begins = np.cumsum(sizes) - sizes
            all_ = np.empty(int(sizes.sum()), np.int64)
            all_[ragged(begins[short], n)] = left
            all_[ragged(begins[long], sizes[long])] = list(chain.from_iterable(own))
            left, n = all_, sizes
        left, n = _as_pieces(v, left, n)
        ids.append(left)
        counts[at : at + len(some)] = n
    return np.concatenate([np.zeros(0, np.int64), *ids]), counts


def decode_ids(v: Vocabulary, ids: list) -> str | None:
    """The text of any ids: one leading space goes, byte pieces form characters where they can."""
    if any(i is None or not 0 <= i < v.n for i in ids):
        return None
    out, held, begun = [], bytearray(), False
    for i in ids:
        if i in v.byte_of:
            held.append(v.byte_of[i])
            begun = True
            continue
        out.append(_characters(held))
        held.clear()
        if i not in v.control:
            text = v.text_of[i].decode()
            # The first piece's space stands for the beginning of the text.
            out.append(text[1:] if not begun and i != v.unknown and text.startswith(" ") else text)
            begun = True
    out.append(_characters(held))
    return "".join(out)


def _characters(data: bytes | bytearray) -> str:
    """Bytes as characters; each byte that is part of none is a mark of its own."""
    out, at, data = [], 0, bytes(data)
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(BROKEN_BYTE)
            at += 1
    return "".join(out)


def _encode(model: str, block_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, sp = vocabulary(model), processor(model)
        for _, doc_ids, held in blocks(batches, block_bytes):
            seen, found = _Numbers(), []
            for text in held:
                parts = pre_tokens(text)
                found.append(np.fromiter(map(seen.__getitem__, parts), np.int64, len(parts)))
            names = [x.decode("utf-8", "replace") for x in seen]
            ids, counts = encode_distinct(v, names)
            right = _agree(sp, names, ids, counts)
            starts = np.cumsum(counts) - counts
            # The pieces' bytes, of each distinct pre-token.
            sizes = v.lengths[ids]
            spelled = v.bytes[ragged(v.starts[ids], sizes)].tobytes()
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([starts, [len(ids)]])].tolist()
            spelled = [spelled[a:z] for a, z in zip(ends[:-1], ends[1:])]
            own = [ids[ragged(starts[f], counts[f])].astype(np.int32) for f in found]
            decoded = [b"".join([spelled[i] for i in f.tolist()])[1:] for f in found]
            good = [bool(right[f].all()) and sp.decode(x.tolist()).encode() == d for f, x, d in zip(found, own, decoded)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(own)))
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), lists, pa.array(decoded, pa.binary()), pa.array(good)], names=["doc_id", "ids", "decoded", "agrees"])

    return run


def _agree(sp, names: list[str], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether the library gives each pre-token the same ids.  It sees no pre-token where the text is empty, but one space mark."""
    right = np.ones(len(names), bool)
    ends = np.concatenate([[0], np.cumsum(counts)])
    for at in range(0, len(names), 4096):
        some = names[at : at + 4096]
        theirs = sp.encode([x or " " for x in some], num_threads=1)
        n = np.fromiter(map(len, theirs), np.int64, len(some))
        flat = np.fromiter(chain.from_iterable(theirs), np.int64, int(n.sum()))
        ours, mine = ids[ends[at] : ends[at + len(some)]], counts[at : at + len(some)]
        if np.array_equal(n, mine) and np.array_equal(flat, ours):
            continue
        for k, (x, t) in enumerate(zip(some, theirs)):
            own = ids[ends[at + k] : ends[at + k + 1]].tolist()
            right[at + k] = own == (t if x else t[:1]) or not x and own == [sp.piece_to_id(MARK)]
    return right


def encoded(docs: DataFrame, model: str = MODEL, block_bytes: int = 12 << 20) -> DataFrame:
    """Per row of ``docs``: doc_id, its text's ids, what they decode to (UTF-8), and whether the library agrees with both."""
    return texts(docs).mapInArrow(_encode(model, block_bytes), ENCODED_SCHEMA)


def _decode(model: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model)
        for batch in batches:
            text = [None if x is None else decode_ids(v, x) for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(text, pa.string())], names=["doc_id", "text"])
        give_back()

    return run


def decoded(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of ``rows(doc_id, ids)``, whatever ids they hold."""
    ship(rows.sparkSession)
    return rows.select(rows["doc_id"].cast("long").alias("doc_id"), rows["ids"].cast("array<int>").alias("ids")).mapInArrow(_decode(model), "doc_id long, text string")


def ids_digest(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ","), 256)


def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_digest(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")

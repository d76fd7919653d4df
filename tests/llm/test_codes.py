"""Piece codec, whitening and vector codes against the library, numpy and plain integer versions."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from loomchain.llm import piece_codec, vector_codes, whitening
from loomchain.llm.token_counts import MODEL, processor

DDL = "doc_id long, text string"
VECTORS = "vec_id long, embedding array<float>, label int"
FRAGMENTS = ["a", " ", "  ", "▁", "é", "é", "中文", "😀", "\x00", "\n", "\t", "<s>", "</s>", "<0x41>", "the", "ing", "x" * 70, "ab" * 50, " ⁇ ", "．", "123", "العربية", "word "]


def pieces_by_library(text):
    sp = processor(MODEL)
    ids = sp.encode(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def codec_rows(df):
    return sorted(((r.doc_id, len(r.ids), hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest(), hashlib.sha256(r.decoded).hexdigest()) for r in df.collect()), key=str)


def test_codec_is_the_library(spark):
    r = random.Random(3)
    docs = [(i, "".join(r.choice(FRAGMENTS) for _ in range(r.randint(0, 14)))) for i in range(4000)]
    docs += [(None, "some words"), (None, None), (1, None), (1, ""), (2, " "), (2, " "), (3, "word " * 60_000), (4, "中" * 30_000), (5, "ab" * 20_000)]
    got = piece_codec.encoded(spark.createDataFrame(docs, DDL).withColumn("ids", piece_codec.F.lit("other")), block_bytes=50_000)
    assert codec_rows(got) == sorted(((i, *pieces_by_library(t)) for i, t in docs), key=str)
    assert got.where("NOT agrees").count() == 0


def test_codec_of_whole_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert codec_rows(piece_codec.encoded(docs)) == sorted(((r.doc_id, *pieces_by_library(r.text)) for r in docs.collect()), key=str)


def test_both_agendas_merge_alike():
    v, r = piece_codec.vocabulary(MODEL), random.Random(8)
    words = ["▁" + "".join(r.choice("abcdeilnorst中") for _ in range(r.randint(0, 60))) for _ in range(3000)]
    symbols = [[int(v.symbols[ord(c)]) for c in w] for w in words]
    left, counts = piece_codec.merge_together(v, np.array([s for w in symbols for s in w]), np.array([len(w) for w in symbols]))
    ends = np.concatenate([[0], np.cumsum(counts)])
    assert [left[a:z].tolist() for a, z in zip(ends[:-1], ends[1:])] == [piece_codec.merge_one(v, w) for w in symbols]


def test_a_text_that_disagrees_is_told(spark, monkeypatch):
    v = piece_codec.Vocabulary(MODEL)
    names = ["the", "word"]
    ids, counts = piece_codec.encode_distinct(v, names)
    assert piece_codec._agree(processor(MODEL), names, ids, counts).tolist() == [True, True]
    ids[0] += 1
    assert piece_codec._agree(processor(MODEL), names, ids, counts).tolist() == [False, True]


def test_decoding_any_ids(spark):
    r, sp = random.Random(4), processor(MODEL)
    n = sp.get_piece_size()
    rows = [(i, [r.choice([r.randrange(n), r.randrange(3, 259), r.randrange(3), sp.piece_to_id("▁")]) for _ in range(r.randint(0, 9))]) for i in range(3000)]
    odd = [(9001, None), (9002, []), (9003, [5, None]), (9004, [n]), (9005, [-1])]
    got = {x.doc_id: x.text for x in piece_codec.decoded(spark.createDataFrame(rows + odd, "doc_id long, ids array<int>")).collect()}
    assert all(got[i] == sp.decode(ids) for i, ids in rows)
    assert [got[i] for i, _ in odd] == [None, "", None, None, None]


def test_codec_of_nothing(spark):
    assert piece_codec.encoded(spark.createDataFrame([], DDL)).count() == 0


def integers(vectors):
    kept = [(i, v, label) for i, v, label in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v, _ in kept), default=0)
    return [(i, [math.floor(256 * c) for c in v] + [0] * (width - len(v)), label) for i, v, label in kept]


def some_vectors(seed, n, d):
    r = np.random.default_rng(seed)
    spread = r.normal(0, 0.3, (d, d))
    rows = [(i, (r.normal(size=d) @ spread).astype(np.float32).tolist(), int(r.integers(0, 4)) or None) for i in range(n)]
    return rows + [(None, rows[0][1], 7), (5, rows[5][1], 1), (5, rows[6][1], 1), (n + 1, None, 1), (n + 2, [None] + rows[1][1][1:], 1), (n + 3, [float("nan")] + rows[1][1][1:], 1), (n + 4, [float("-inf")] * d, 1), (n + 5, rows[2][1][: d // 2], None)]


def test_whitening(spark):
    vectors = some_vectors(1, 300, 12) + [(1000 + i, some_vectors(1, 20, 12)[0][1], 1) for i in range(200)]
    whole = integers(vectors)
    x = np.array([v for _, v, _ in whole])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    cov = ((fit - s / n).T @ (fit - s / n)) / n
    values, vecs = (a[..., ::-1] for a in np.linalg.eigh(cov))
    got = whitening.whiten(spark.createDataFrame(vectors, VECTORS).withColumn("whitened", whitening.F.lit("other"))).collect()
    assert len(got) == 4 * len(whole) and {r.n for r in got} == {n} and got[0].identity_error < 1e-9
    want = {}
    for (i, *_), row in zip(whole, x):
        for k in range(4):
            want.setdefault((i, k + 1), []).append((int(((n * row - s) ** 2).sum()), abs(float((row - s / n) @ vecs[:, k] / values[k] ** 0.5))))
    have = {}
    for r in got:
        have.setdefault((r.vec_id, r.component), []).append((r.deviation, abs(r.whitened)))
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-12)
    assert have.keys() == want.keys()
    for k, rows in want.items():
        for a, b in zip(sorted(rows), sorted(have[k])):
            assert a[0] == b[0] and a[1] == pytest.approx(b[1], abs=1e-9)
    # One sign for all rows.
    first = [(r.whitened, float((np.array(v) - s / n) @ vecs[:, 0])) for (i, v, _), r in ((w, r) for w in whole for r in got if r.component == 1 and r.vec_id == w[0] and w[0] not in (None, 5))]
    assert len({np.sign(a * b) for a, b in first if abs(a) > 1e-9}) == 1


@pytest.mark.parametrize("vectors, rank", [([[1.0, 2.0]], 0), ([[1.0, 2.0], [1.0, 2.0], [2.0, 4.0]], 1), ([[1.0], [3.0]], 1), ([[1.0, 0.0, 0.0], [-1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, -1.0, 0.0], [0.0, 0.0, 1.0], [0.0, 0.0, -1.0]], 3), ([[]], 0)])
def test_whitening_of_few_or_equal_roots(spark, vectors, rank):
    got = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], VECTORS)).collect()
    width = max(map(len, vectors))
    assert len(got) == len(vectors) * min(4, width)
    assert all((r.whitened is None) == (r.component > rank) and (r.explained is None) == (rank == 0) and r.deviation is not None for r in got)
    assert all(r.identity_error is None if rank == 0 else r.identity_error < 1e-12 for r in got)


def test_whitening_of_large_entries(spark):
    big = [[1e12, 3.0, 0.0], [-1e12, 1e11, 5.0], [3.0, 4.0, 2e12], [1e300, -1e300, 7.0]]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(big)], "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == 12 and all(r.deviation is None for r in got) and got[0].identity_error < 1e-9


def test_whitening_of_nothing(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0


def test_roots_and_null_spaces():
    r = np.random.default_rng(3)
    for trial in range(40):
        d, rank = int(r.integers(1, 8)), int(r.integers(1, 8))
        b = r.integers(-3, 4, (d, rank)).astype(object)
        a = np.diag(r.integers(0, 3, d)).astype(object) if trial % 3 == 0 else b @ b.T
        want = np.poly(a.astype(float))[::-1]
        p = whitening.primes_below(1 << 31, 1)[0]
        assert whitening.polynomial_modulo(a, p) == [round(c) % p for c in want]
        roots = whitening.largest_roots([round(c) for c in want], d, int(np.trace(a)))
        exact = sorted((x for x in np.linalg.eigvalsh(a.astype(float)) if x > 1e-9), reverse=True)
        assert np.allclose([float(x) for x, k in roots for _ in range(k)], exact)
        for x, k in roots:
            v = whitening.null_space(a, x, k)
            assert np.allclose(v @ v.T, np.eye(k), atol=1e-12) and np.allclose(a.astype(float) @ v.T, float(x) * v.T, atol=1e-9)
    close = np.array([[10**12, 0, 0], [0, 10**12 + 1, 0], [0, 0, 1]], object)
    (x, k), (y, m), *_ = whitening.largest_roots([-(10**12) * (10**12 + 1), 10**12 * (10**12 + 1) + 2 * 10**12 + 1, -(2 * 10**12 + 2), 1], 3, 3 * 10**12)
    assert k == m == 1 and abs(x - (10**12 + 1)) < Fraction(1, 10**20) and np.allclose(np.abs(whitening.null_space(close, x, 1)), [[0, 1, 0]], atol=1e-15)


def codes_by_integers(vectors, rounds=2):
    rows = sorted(integers(vectors), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max(1, max((len(v) for _, v, _ in rows), default=1)) // 16) * 16
    parts = [[(v + [0] * (width - len(v)))[p * width // 16 : (p + 1) * width // 16] for p in range(16)] for _, v, _ in rows]
    books = [[x[p] for x in parts[:64]] for p in range(16)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda: [[min((away(x[p], e), k) for k, e in enumerate(books[p])) for p in range(16)] for x in parts]
    for _ in range(rounds):
        found = near()
        for p in range(16):
            for k in range(len(books[p])):
                own = [x[p] for x, f in zip(parts, found) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = near()
    error = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, label), e in zip(rows, error):
        total[label] = total.get(label, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, total[label]) for (i, _, label), f, e in zip(rows, found, error)), key=str), books


@pytest.mark.parametrize("d, n", [(16, 400), (40, 90), (5, 30)])
def test_vector_codes(spark, d, n):
    vectors = some_vectors(d, n, d) + [(2000 + i, [0.5] * d, 3) for i in range(n // 2)]
    codes, books = vector_codes.vector_codes(spark.createDataFrame(vectors, VECTORS).withColumn("code", vector_codes.F.lit("other")).repartition(3))
    want, plain = codes_by_integers(vectors)
    assert sorted((tuple(r) for r in vector_codes.with_label_error(codes).select("vec_id", "code", "error", "label_error").collect()), key=str) == want
    assert books.tolist() == [[list(e) for e in b] for b in plain]


def test_whole_nodes_are_assigned():
    r = np.random.default_rng(2)
    points = np.concatenate([r.integers(-5, 6, (500, 3)) + 10_000 * k for k in range(4)])
    entries = np.array([[0, 0, 0], [10_000] * 3, [20_000] * 3, [30_000] * 3, [90_000] * 3])
    tree = vector_codes.Tree(points[vector_codes.tree_order(points, 6)], 6)
    found = list(vector_codes.assign(tree, entries))
    assert all(len(f) == 4 for f in found) and len(found) <= 8
    for k in range(4):
        own = [f for f in found if f[2] == k]
        assert sum(f[3] for f in own) == 500 and (sum(tree.sums[f[0]][f[1]] for f in own) == points[500 * k : 500 * k + 500].sum(axis=0)).all()


def test_ties_go_to_the_lower_entry():
    for entries in ([[2, 0], [0, 0], [2, 0]], [[0, 0], [2, 0], [2, 0]]):
        tree = vector_codes.Tree(np.array([[1, 0], [1, 7], [1, -7], [1, 0]]), 0)
        (places, own), = vector_codes.assign(tree, np.array(entries))
        assert own.tolist() == [0] * 4


def test_vector_codes_of_huge_components(spark):
    vectors = [(i, [float(10 ** (i % 14))] * 16, None) for i in range(70)] + [(100, [1e300] * 16, 1), (101, [-1e300] * 16, 1)]
    codes, books = vector_codes.vector_codes(spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int"))
    clamped = [(i, [max(-(2.0**55), min(2.0**55, c)) for c in v], label) for i, v, label in vectors]
    got = {r.vec_id: (r.code, r.error) for r in codes.collect()}
    assert len(got) == 72 and all(got[i][1] == 0 for i in range(14))
    assert {r.vec_id: r.error for r in vector_codes.vector_codes(spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int"), 0)[0].collect()}[100] is None
    want = {r[0]: r[1] for r in codes_by_integers(clamped)[0]}
    assert all(got[i][0] == want[i] for i in range(70))


def test_vector_codes_of_nothing(spark):
    codes, _ = vector_codes.vector_codes(spark.createDataFrame([], VECTORS))
    assert vector_codes.with_label_error(codes).count() == 0

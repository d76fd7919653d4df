"""Each operator against its plain version: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import plain

from loomchain.llm import decontamination, licenses, line_dedup, packing, quality_classifier, quality_rules, secret_scan, simhash, suffix_dedup, token_counts
from loomchain.llm.components import components

DDL = "doc_id long, text string"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def rows(df, n=None):
    return sorted((tuple(r)[:n] for r in df.collect()), key=str)


def odd_rows(some):
    """Null ids and texts, empty and blank texts, repeated rows and ids."""
    return [(None, some), (None, None), (9001, None), (9002, ""), (9003, " \n\t "), (9004, some), (9004, some), (9004, "other words")]


def sentences(seed, n, words, most):
    r = random.Random(seed)
    pool = [" ".join(r.choice(words) for _ in range(r.randint(3, most))) for _ in range(20)]
    return [(3 * i, " ".join(r.choice(pool)[r.randint(0, 9) :] if r.random() < 0.6 else "".join(r.choice("abcdé ") for _ in range(r.randint(0, 80))) for _ in range(r.randint(0, 6)))) for i in range(n)]


WORDS = ["alpha", "Beta", "c", "dé", "eee", "f", "gamma,", "password=abc12345"]


def test_suffix_dedup(spark):
    docs = sentences(1, 150, WORDS, 40) + odd_rows("a" * 120) + [(9005, "a" * 49), (9006, "a" * 51), (9007, "ab" * 400)]
    for block in (3000, 1 << 20):
        assert rows(suffix_dedup.repeated_bytes(frame(spark, docs), block_bytes=block)) == sorted(plain.repeated_bytes(docs), key=str)


def test_suffix_dedup_slices(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 64)
    text = np.frombuffer(("words that repeat " * 30).encode(), np.uint8)
    first, last, _ = suffix_dedup.cut_segments(text, np.asarray([0, len(text)]), np.asarray([True]), 50, 20)
    assert sum(last - first + 1) == len(text) - 49 and (first[1:] == last[:-1] + 1).all()


def test_suffix_dedup_of_a_very_long_text(spark):
    r = random.Random(4)
    passage = "".join(r.choice("abcdefgh ") for _ in range(400))
    long = "".join(r.choice("ijklmnop ") for _ in range(5_000_000))
    docs = [(1, passage), (2, long[:3_000_000] + passage + long[3_000_000:]), (3, long[100:400] + "!" + passage)]
    got = {x.doc_id: x for x in suffix_dedup.repeated_bytes(frame(spark, docs)).collect()}
    assert [got[i].n_removed for i in (1, 2, 3)] == [0, 400, 700] and got[2].kept_sha256 == hashlib.sha256(long.encode()).hexdigest()


def test_suffix_dedup_writes_one_file_for_a_bucket(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(7)
    held = suffix_dedup._block_table(docs, 4000, 50, 32)
    assert held.count() > 20 and len(held.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_token_counts(spark):
    r, sp = random.Random(1), token_counts.processor(token_counts.MODEL)
    parts = ["a", "the", " ", "  ", "\n", "é", "<s>", "▁", "　", "hello,", "1234", "\t", ".", " ", "中文"]
    docs = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 12)))) for i in range(600)] + odd_rows("x y") + [(7, "a " * 70000)]
    want = [(i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t in docs]
    assert rows(token_counts.token_counts(frame(spark, docs), block_bytes=4000)) == sorted(want, key=str)


def test_token_counts_send_as_much_to_many_buckets_as_to_few(spark, sf):
    docs, size = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for n in (32, 8192):
        parts = token_counts.packed(docs, n, 2 << 20)
        back = token_counts.replies(token_counts.requests(parts, n), token_counts.MODEL).toPandas()
        size[n] = sum(len(x) - 1 for x in back.pieces)
        assert back.groupby("block").bucket.nunique().min() > n / 4
    assert size[32] == size[8192]


def test_token_counts_of_wide_blocks(spark):
    """Few documents with all the words, many without any between them."""
    sp = token_counts.processor(token_counts.MODEL)
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(3000)) if i % 2000 == 7 else "") for i in range(6000)]
    want = [(i, len(t), len(sp.encode(t)), len(sp.encode(t)) > 4096) for i, t in docs]
    assert rows(token_counts.token_counts(frame(spark, docs).coalesce(1))) == sorted(want, key=str)


def test_simhash(spark):
    r = random.Random(5)
    base = [[r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(300)] for _ in range(4)]
    docs = []
    for i in range(120):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 14)):
            w[r.randrange(len(w))] = "x" + str(r.randint(0, 5))
        docs.append((i * 3 + 1, " ".join(w)))
    docs += odd_rows(docs[0][1])
    assert rows(simhash.near_duplicates(frame(spark, docs))) == sorted(plain.components(docs), key=str)
    kept = rows(simhash.one_of_each(frame(spark, docs)))
    # Between what the fingerprints alone drop and what they and all similar pairs together drop.
    by_print, by_both = ({c for _, _, c in plain.components(docs, 4, similar)} for similar in (False, True))
    assert by_both <= {k[0] for k in kept} <= by_print and len(kept) == len({k[0] for k in kept}) and all(x in set(docs) for x in kept)


def test_simhash_stage_catches_near_copies(spark):
    """Pairs of a shingle similarity of 0.8 or more, against all of them; texts of their own stay."""
    r, docs = random.Random(8), []
    for g in range(150):
        base = [f"w{r.randint(0, 40) if r.random() < 0.4 else r.randint(100, 9000)}" for _ in range(r.randint(60, 400))]
        docs.append((10 * g, " ".join(base)))
        for c in range(g % 3):
            copy = list(base)
            for _ in range(r.randint(1, max(1, len(base) // 55))):
                copy[r.randrange(len(copy))] = f"e{r.randint(0, 99)}"
            docs.append((10 * g + 1 + c, " ".join(copy)))
    kept = {k[0] for k in rows(simhash.one_of_each(frame(spark, docs)))}
    want = {c for _, _, c in plain.components(docs, 4, True)}
    assert want <= kept
    assert len(docs) - len(kept) >= 0.9 * (len(docs) - len(want)) > 100
    assert len(docs) - len({c for _, _, c in plain.components(docs)}) < 0.7 * (len(docs) - len(want))


def test_simhash_links_keep_every_connection(monkeypatch):
    r = np.random.default_rng(2)
    seeds = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(12):
            x = int(s)
            for b in r.choice(64, r.integers(1, 6), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for small in (simhash.SMALL, 3):
        monkeypatch.setattr(simhash, "SMALL", small)
        root = {f: f for f in fps}
        for i, j in simhash._pairs_of_segments():
            mask = np.uint64(simhash._MASKS[i] | simhash._MASKS[j])
            own = np.asarray(sorted(fps, key=lambda f: f & int(mask)), np.uint64)
            a, b = simhash.bucket_links(own & mask, own, 4)
            for x, y in zip(a.tolist(), b.tolist()):
                assert (x ^ y).bit_count() <= 4
                root[find(x)] = find(y)
        for x in fps:
            for y in fps:
                assert (x ^ y).bit_count() > 4 or find(x) == find(y)


def test_simhash_chains_let_near_pairs_pass():
    r = np.random.default_rng(3)
    differ = [0, *(sum(1 << int(b) for b in r.choice(64, r.integers(1, 5), replace=False)) for _ in range(20_000))]
    assert simhash.keeps_budgets(np.asarray(differ, np.uint64)).all()
    assert simhash.keeps_budgets(r.integers(0, 1 << 63, 20_000, dtype=np.uint64)).mean() < 0.01


def test_simhash_large_buckets_are_dealt_by_a_third_segment(spark):
    """Fingerprints that share two segments in their hundreds, some of them near."""
    r = random.Random(9)
    base = [r.getrandbits(45) << 19 for _ in range(150)]
    fps = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.choice([0, 1, 2, 4]))) for b in base for _ in range(3)})
    want = {frozenset((x, y)) for x in fps for y in fps if x < y and (x ^ y).bit_count() <= 4}
    df = spark.createDataFrame([(k, simhash._signed(f)) for f in fps for k in (0, 2)], "kind int, fp long")
    for large in (10, 4096):
        both = simhash.links(df, 4, large).collect()
        got, other = ({frozenset((x.a % (1 << 64), x.b % (1 << 64))) for x in both if x.kind == k} for k in (0, 2))
        assert got == other and got <= want
        assert {r.node: r.root for r in components(spark.createDataFrame([tuple(map(simhash._signed, p)) for p in got], "a long, b long")).collect()} == {r.node: r.root for r in components(spark.createDataFrame([tuple(map(simhash._signed, p)) for p in want], "a long, b long")).collect()}


def test_benchmark_parts():
    """Windows of all items, repeated ones once for each part; parts of bounded size, a long item in several; numbers that agree within a pass."""
    r = random.Random(4)
    items = [(str(i) if i % 5 else None, " ".join(r.choice("abcdefgh") for _ in range(r.choice([0, 2, 3, 9, 70]))).encode()) for i in range(40)]
    want = {(tuple(w[at : at + 3]), item) for item, t in items if (w := t.split()) for at in range(max(1, len(w) - 2))}
    got = set()
    for held in decontamination.passes(items, 3, 20, 4):
        assert len(held) <= 4
        words = {i: w for p in held for i, w in enumerate(p.words, p.first)}
        assert len(words) == sum(len(p.words) for p in held)
        for p in held:
            assert len(p.rows) <= len(p.pieces) <= 20
            got |= {(tuple(words[x] for x in row[:n]), item) for k, (row, n) in enumerate(zip(p.rows.tolist(), p.lengths)) for item in {p.names[i] for i in p.pieces[p.edges[k] : p.edges[k + 1]]}}
    assert got == want
    assert [len(p.rows) for held in decontamination.passes([], 3) for p in held] == [0]


def test_benchmark_items_without_an_id(spark):
    bench = spark.createDataFrame([(None, "one two three four"), (7, "three four five")], "item_id long, text string")
    got = decontamination.benchmark_hits(frame(spark, [(1, "zero one two three four five six")]), bench, 3, 1).first()
    assert (got.n_hit, got.n_items, got.removal_spans) == (5, 1, "1:6")


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 90), (90, 95), (95, 95)] + [(200, i) for i in range(201, 260)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 90: 90, 95: 90, 100: 90, **{i: 200 for i in range(200, 260)}}


def test_decontamination(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "PASSES", 2)
    r = random.Random(2)
    v = ["A", "b", "c1", "É", "d-e", "zz"]
    items = [(i, " ".join(r.choice(v) for _ in range(r.choice([0, 3, 4, 5, 9, 14])))) for i in range(12)] + [(50, None), (3, "b b b b")]
    docs = [(i, " ".join(r.choice([*v, "q"]) for _ in range(r.choice([0, 1, 5, 30, 80])))) for i in range(150)] + odd_rows(items[3][1])
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(plain.hits(docs, items, 4), key=str)
    for part in (1 << 20, 100):
        assert rows(decontamination.benchmark_hits(frame(spark, docs), bench, 4, part), 6) == want
    clean = sorted((d for d, w in zip(docs, plain.hits(docs, items, 4)) if not w[5]), key=str)
    assert rows(decontamination.decontaminated(frame(spark, docs), bench, 4)) == clean
    assert all(not r.n_hit for r in decontamination.benchmark_hits(frame(spark, docs), bench.limit(0)).collect())
    phrase = "one two three four five six"
    far = [(1, "q " * 300_000 + phrase + " q" * 300_000), (1, phrase)]
    got = rows(decontamination.benchmark_hits(frame(spark, far), spark.createDataFrame([(7, phrase)], "item_id long, text string"), 4))
    assert sorted((g[1], g[2], g[5], g[6]) for g in got) == [(6, 6, True, "0:6"), (600_006, 6, False, "300000:300006")]


def test_secrets(spark):
    r, words = random.Random(3), secret_scan.automaton()
    parts = ["password", "PassWd", "secret", "token", "api_key", "apikey", "=", ":", " ", '"', "'", "abcdef", "AKIA", "ABCDEFGH12345678", "é", "0123456789abcdef", "x", "\n", "ſecret", "K"]
    docs = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 14)))) for i in range(3000)] + odd_rows("token=abcdef1")
    for (d, t), g in zip(docs, (r for r in [(secret_scan._in_code_points((t or "").encode(), secret_scan.find((t or "").encode(), words))) for _, t in docs])):
        assert ",".join(f"{k}:{a}:{b}" for a, k, b in g) == plain.secrets(t or "")
    want = [(d, hashlib.sha256(plain.secrets(t or "").encode()).hexdigest()) for d, t in docs]
    assert sorted(((x.doc_id, x.base_sha256) for x in secret_scan.secret_spans(frame(spark, docs)).collect()), key=str) == sorted(want, key=str)


def test_secrets_in_a_very_long_text(spark):
    got = secret_scan.secret_spans(frame(spark, [(1, "é " * 400_000 + "token=abcdef1" + " x" * 400_000)])).first()
    assert got.spans == "assign:800000:800013" and got.n_assign == 1


def test_secret_checksums():
    words, body, r = secret_scan.automaton(), b"zQ" * 15, random.Random(12)
    kinds = lambda token: [k for _, k, _ in secret_scan.find(b"x " + token + b" y", words)]
    assert kinds(b"ghp_" + body + secret_scan.checksum62(body)) == ["github"] and kinds(b"npm_" + body + secret_scan.checksum62(body)) == ["npm"]
    assert kinds(b"ghp_" + body + b"000000") == []
    key = b"xprv9s21ZrQH143K3QTDL4LXw2F7HEK3wJUD2nW2nRk4stbPy6cq3jPPqjiChkVvvNKmPGJxWUtg6LnF5kejMRNNU3TGtRBeJgk33yuGBxrMPHi"
    assert kinds(key) == ["bip32"] and kinds(key[:-1] + b"j") == [] and kinds(key + b"a") == []
    assert secret_scan.bech32_check(b"A12UEL5L") and not secret_scan.bech32_check(b"A12UEL5Q")
    for prefix, kind in ((b"AGE-SECRET-KEY-", "age"), (b"nsec", "nostr")):
        data = bytes(r.choice(secret_scan.BECH32) for _ in range(52))
        # Six symbols such that the whole has remainder 1: the remainder of the rest with zeros, turned round.
        rest = 1
        low = prefix.lower()
        for value in (*(c >> 5 for c in low), 0, *(c & 31 for c in low), *map(secret_scan.BECH32.index, data), *[0] * 6):
            top, rest = rest >> 25, (rest & 0x1FFFFFF) << 5 ^ value
            for i, g in enumerate(secret_scan._BECH32_GENERATOR):
                rest ^= g if top >> i & 1 else 0
        check = bytes(secret_scan.BECH32[(rest ^ 1) >> 5 * (5 - i) & 31] for i in range(6))
        token = prefix + b"1" + data + check
        token = token.upper() if kind == "age" else token
        assert kinds(token) == [kind] and kinds(token[:-1] + (b"Q" if token[-1:] != b"Q" else b"P")) == [] and kinds(token[:-2]) == []


def test_packing(spark):
    from tokenizers import Tokenizer

    t, r = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)), random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "é", "<|endoftext|>", "　", "hello,", "1234", "\t", ".", " ", "中文", "'s", "\x1c", "\x85", "\r\n", "__", "ſ", "Ⅷ", "²", "̀", "’"]
    docs = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 12)))) for i in range(800)] + [(None, "x y"), (5000, None), (5001, ""), (7000, "a " * 9000)]
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 1] for i, x in docs}
    per, sequences = defaultdict(list), defaultdict(list)
    for p in packing.pack_along_curve(frame(spark, docs)).collect():
        per[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(per) == set(want)
    for d, pieces in per.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(want[d]))
            assert p.ids_crc32 == zlib.crc32(np.asarray(want[d][at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(want[d])
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0


def test_packing_encodes_long_runs_alike():
    """About the length from which a run goes to the tokenizer itself."""
    from tokenizers import Tokenizer

    t, r, ids = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)), random.Random(6), packing.Ids(packing.TOKENIZER)
    for n in (1990, 1998, 1999, 2000, 2001, 2010, 4100):
        for pool in ("ab", "a1.", "é_'s", "\t\x0b", "aB-\u2019", "中a"):
            for text in ("".join(r.choice(pool) for _ in range(n)), "x " + "".join(r.choice(pool) for _ in range(n)) + "\n y"):
                assert np.frombuffer(ids.encode(text), "<u2").tolist() == t.encode(text, add_special_tokens=False).ids


def test_hilbert_curve_is_continuous():
    cells = np.array([[i, j, k] for i in range(8) for j in range(8) for k in range(8)])
    at = packing.hilbert(cells, 3)
    assert sorted(at) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(axis=1) == 1).all()


def test_quality_classifier_learns(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality_classifier.quality_scores(docs, labels).collect()}
    known = [(got[r.doc_id], r.quality) for r in labels.collect()]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [(r, y) for r, y in known if r.held_out]
    assert sum(r.predicted == y for r, y in held) >= 0.85 * len(held)
    assert quality_classifier.accepted(docs, labels).count() == sum(r.predicted for r in got.values())


def test_quality_classifier_is_calibrated(spark):
    """On held-out rows of the larger table, scores in ten bins against the share of label 1 in each."""
    at = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{at}/labels.parquet").collect()}
    got = [(r.score, labels[r.doc_id]) for r in quality_classifier.quality_scores(spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")).collect() if r.held_out and labels.get(r.doc_id) is not None]
    score, y = np.asarray(got).T
    bins = np.minimum((score * 10).astype(int), 9)
    error = sum(abs(score[bins == b].mean() - y[bins == b].mean()) * (bins == b).mean() for b in set(bins.tolist()))
    assert len(y) > 30 and error < 0.1 and ((score >= 0.3) == y).mean() >= 0.9


def test_quality_classifier_sums_of_contexts(spark):
    """Summed over tasks, blocks and rounds against sums by hand."""
    r = random.Random(2)
    vocabulary = ["Alpha", "ALPHA", "beta", "beta", "--", "é", "x" * 40, "rare1", "rare2", "Rare3"]
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 30)))) for i in range(200)] + odd_rows("beta beta c")
    parts = quality_classifier.packed(frame(spark, docs).repartition(5))
    frequent = quality_classifier.frequent_words(parts, 4)
    counts = defaultdict(int)
    for _, t in docs:
        for w in quality_classifier.TOKEN.findall(t or ""):
            counts[w.lower()] += 1
    assert frequent == [quality_classifier.word_hash(w) for w in sorted(counts, key=lambda w: (-counts[w], quality_classifier.word_hash(w)))[:4]]
    rows_ = quality_classifier.Rows(frequent, 8)
    places, signs = rows_.index_vectors()
    total, seen = np.zeros((rows_.size, 64)), np.zeros(rows_.size)
    for _, t in docs:
        said, last = [], None
        for w in quality_classifier.TOKEN.findall(t or ""):
            h = quality_classifier.word_hash(w)
            row = 3 + sorted(frequent).index(h) if h in frequent else 3 + 4 + h % (1 << 64) % 8
            said.append(row)
            said += [m for m, on in zip(quality_classifier.MARKS, (w.isupper(), row == last, len(w) > 30)) if on]
            last = row
        for i, a in enumerate(said):
            seen[a] += 1
            for b in said[max(0, i - 2) : i + 3]:
                for j in range(2):
                    total[a, places[b, j]] += signs[b, j]
    vectors, weights = quality_classifier.word_vectors(parts, rows_)
    assert np.allclose(vectors, total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9), atol=1e-6)
    assert np.allclose(weights, 1e-3 / (1e-3 + seen / seen.sum()) * (seen > 0) + 1e-6)


def test_quality_classifier_gradients():
    r = np.random.default_rng(1)
    x, y = r.standard_normal((9, 6)), r.integers(0, 2, 9).astype(float)
    w = [r.standard_normal((6, 4)), r.standard_normal(4), r.standard_normal(4), r.standard_normal(1)]
    for a, g in zip(w, quality_classifier.gradients(w, x, y)):
        for at in np.ndindex(a.shape):
            a[at] += 1e-6
            up = quality_classifier.loss(w, x, y)
            a[at] -= 2e-6
            down = quality_classifier.loss(w, x, y)
            a[at] += 1e-6
            assert abs((up - down) / 2e-6 - g[at]) < 1e-6


def test_quality_classifier_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = rows(quality_classifier.quality_scores(frame(spark, odd_rows("a b c")), none))
    assert len(got) == 8 and {g[2] for g in got} == {0.5}
    # Labels that disagree on one doc_id, labels without a document, and a text of many blocks' length.
    docs = [(i, "good words here" if i % 2 else "BAD BAD !!") for i in range(60)] + [(2000, "good " * 2_000_000)] + odd_rows("good words")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (1, None), (None, 1), (7777, 1)], "doc_id long, quality int")
    scores = {x.doc_id: x.score for x in quality_classifier.quality_scores(frame(spark, docs), labels).collect()}
    assert scores[1] > 0.5 > scores[2] and len(scores) == 60 + 1 + 5


def test_licenses(spark):
    r = random.Random(1)
    shingles = lambda t: [tuple(w[i : i + 5]) for w in [licenses.words_of((t or "").encode())] for i in range(len(w) - 4)]
    templates = {n: shingles(t) for n, t in licenses.TEMPLATES.items()}
    docs = []
    for i in range(120):
        w = [r.choice("alpha beta gamma de la the license under".split()) for _ in range(r.randint(0, 60))]
        for n in r.sample(sorted(templates), r.randint(0, 2)):
            t = licenses.TEMPLATES[n].split()
            for _ in range(r.randint(0, len(t) // 25)):
                t[r.randrange(len(t))] = "zzz"
            k = r.randint(0, len(w))
            w[k:k] = t[: len(t) // 2] if r.random() < 0.2 else t
        docs.append((i, " ".join(w)))
    docs += [(500, None), (501, ""), (502, "Released under the MIT License.")]
    got = {x.doc_id: set(filter(None, x.licenses.split(","))) for x in licenses.license_matches(frame(spark, docs)).collect()}
    for d, t in docs:
        s = shingles(t)
        assert got[d] == {n for n, p in templates.items() if any(len(set(p) & set(s[a : a + len(p)])) >= 0.8 * len(set(p)) for a in range(max(1, len(s))))}


def test_licenses_edges(spark):
    notice = "Released under the MIT License."
    far = "some words that are no license " * 200_000 + notice + " and more of them" * 100_000
    docs = odd_rows(notice) + [(1, far), (1, notice), (2, "few words")]
    want = [(d, int(notice in (t or ""))) for d, t in docs]
    assert sorted(((r.doc_id, r.n_licenses) for r in licenses.license_matches(frame(spark, docs)).collect()), key=str) == sorted(want, key=str)


def test_licenses_in_other_wordings(spark):
    whole = [(n.removesuffix("-whole"), t) for n, t in licenses.all_templates().items() if n.endswith("-whole")]
    docs = [
        ("MIT", "This package is licensed under the MIT License, see LICENSE."), ("GPL-3.0", "Free under the GNU General Public License v3.0 or later."), ("Apache-2.0", "All code here is licensed under the Apache License 2.0."),
        ("MIT", "// SPDX-License-Identifier: MIT"), ("GPL-2.0-or-later", "# SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0 OR MIT)"), ("BSD", "The whole is distributed under the BSD License."),
        *((n, "some words before " + t + " and after") for n, t in whole), *((n, " ".join(t.split()[: int(0.93 * len(t.split()))])) for n, t in whole),
    ]
    got = {r.doc_id: r.licenses.split(",") for r in licenses.license_matches(frame(spark, [(i, t) for i, (_, t) in enumerate(docs)])).collect()}
    for i, (name, _) in enumerate(docs):
        assert any(x.startswith(f"{name}-") for x in got[i]), (name, got[i])
    assert [f"{n}-whole" in got[i + 6] for i, (n, _) in enumerate(whole)] == [True] * len(whole)
    assert got[4] == ["GPL-2.0-or-later-spdx", "MIT-spdx"]


def test_licenses_every_place(spark):
    notice, mit = "Released under the MIT License.", licenses.all_templates()["MIT-whole"]
    n = len(licenses.words_of(mit.encode()))
    docs = [(1, f"{notice} a b {notice} {notice}"), (2, f"{mit} x y z {mit}"), (3, "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: MIT")]
    got = {r.doc_id: r for r in licenses.license_matches(frame(spark, docs)).collect()}
    assert (got[1].n_licenses, got[1].places) == (1, "MIT:0:5,MIT:7:12,MIT:12:17")
    assert [p for p in got[2].places.split(",") if p.startswith("MIT-whole")] == [f"MIT-whole:0:{n}", f"MIT-whole:{n + 3}:{2 * n + 3}"]
    assert (got[3].n_licenses, got[3].places) == (1, "MIT-spdx:3:4,MIT-spdx:7:8")


@pytest.mark.parametrize("texts, n, covered", [("a b c a b c", 6, 6), ("a b c d", 4, 0), ("x x x x", 4, 4), ("a b c q a b c", 7, 6), ("a b", 2, 0), (None, 0, 0)])
def test_repeated_words(spark, texts, n, covered):
    r = quality_rules.judged(frame(spark, [(1, texts)])).first()
    assert (r.n_words, r.n_repeat_words, r.base_failed) == (n, covered, True)


def test_line_rules(spark):
    good = "\n".join(" ".join(f"word{i}x{j}" for j in range(9)) + "." for i in range(10))
    nav = "\n".join(f"Home | About {i} | Contact | Cart {i * 3} | More {i * 11}" for i in range(20))
    docs = frame(spark, [(1, good), (2, nav), (3, good + "\nAll rights reserved."), (4, None)])
    assert {r.row.doc_id: r.kept for r in quality_rules.judged(docs).collect()} == {1: True, 2: False, 3: True, 4: False}


LINES = {
    True: [
        "A sentence in plain words that ends.", "Wer weiß das schon?", "« Une phrase entre guillemets. »", "यह एक वाक्य है।", "هل هذا سؤال؟", "これは文です。", "She said (quite rightly) \"no!\"", "Ends with spaces.   ",
        "- a list item of several words", "12. another item with some words", "    indented = code(here)", "while (x) { y(); }", "def f(x):", "import os",
        "a long line of wrapped prose that goes on in the next line without any mark at", "See https://example.org/a for the whole of the story that is told here.", "He signed the terms of the treaty.",
        "One could write at length about how a privacy policy is read by nobody, and yet " + "many words follow here " * 8 + "until the end.",
    ],
    False: [
        "Home | About | Contact", "Start › Shop › Shoes", "Home > Docs > API", "About Us Contact Imprint Jobs", "Über Uns Kontakt", "Login", "no mark here", "!!! Buy now!! Only today!! Really!!", "What?? Who?? Why??",
        "All rights reserved.", "Alle Rechte vorbehalten.", "Read more about it here.", "https://example.org/one https://example.org/two https://example.org/three.", "### $$$ &&& done.", "2023 - 11 - 04.", "- short",
    ],
}


def test_each_line_rule(spark):
    for want, lines in LINES.items():
        got = {r.text: r.passes for r in frame(spark, list(enumerate(lines))).select("text", quality_rules.line_passes(F.col("text")).alias("passes")).collect()}
        assert {t for t, passes in got.items() if passes != want} == set()


def test_lines_of_pages_whatever_their_indent(spark):
    """What is indented is code only by its marks.  Some of the failing lines do so by phrases that were listed for them."""
    bad = ["    Home", "\tAbout us", "    Privacy settings", "    Login / Register", "- Home page links here", "Copyright 2020 Example Inc.", "(c) Example 1999 - 2003.", "Subscribe now!"]
    good = ["    x = f(y)", "\tif not found_it", "    return None", "  total += price[i]", "The copyright ran out in 1923, they said.", "- three eggs and some flour"]
    for want, lines in ((False, bad), (True, good)):
        got = frame(spark, list(enumerate(lines))).select("text", quality_rules.line_passes(F.col("text")).alias("passes")).collect()
        assert [r.text for r in got if r.passes != want] == []


def test_long_lines_of_capitalised_words(spark):
    """The pattern's repeats are no calls inside each other, and it says the same as the one of the SQL."""
    many = "Wort " * 100_000
    texts = [many + "Ende", many + "ende", many + "ende.", "x " + many + "Ende", "\t" + many.replace(" ", " \t ") + "Ende", "Menu Home", "Menu home", "Menu", "Ärger Öl  Übel", "Menu Home "]
    df = frame(spark, list(enumerate(texts)))
    got = [r.cap for r in df.orderBy("doc_id").select(F.col("text").rlike(quality_rules.CAPITALISED_HERE).alias("cap")).collect()]
    import duckdb

    c = duckdb.connect()
    assert got == [c.execute("SELECT regexp_matches(?, ?)", [t, quality_rules.CAPITALISED]).fetchone()[0] for t in texts]
    assert rows(quality_rules.judged(df).where("row.doc_id < 4").select("row.doc_id", "n_words", "kept_chars")) == [(0, 100_001, 0), (1, 100_001, 400_004), (2, 100_001, 400_005), (3, 100_002, 400_005)]


def test_quality_rules_edges(spark):
    """Nulls, repeated rows and ids, lines that repeat, a very long text; against the SQL."""
    good = "\n".join(" ".join(f"word{i}x{j}" for j in range(9)) + "." for i in range(10))
    docs = odd_rows(good) + [(1, good), (2, "The same line stands here again and again.\n" * 40), (3, "\n".join(f"Sentence{i} opens{i} and{i} goes{i} on{i} until{i} its{i} end{i}." for i in range(60_000)))]
    docs += [(10 + i, "\n".join(k for k in (LINES[True] * 2 + LINES[False])[i::3])) for i in range(3)] + [(20, good + "\n" + good)]
    df = frame(spark, docs)
    got = rows(quality_rules.judged(df).select("row.doc_id", "n_words", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_chars"))
    import duckdb

    c = duckdb.connect()
    documents = df.toPandas()
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    c.register("documents", documents)
    want = c.execute(f"SELECT doc_id, n_words, n_dup_lines, n_repeat_words, base_failed, kept, kept_chars FROM ({quality_rules.OP4_SQL})").fetchall()
    assert got == sorted(want, key=str)
    kept = {g[0]: g[5] for g in got}
    assert kept[1] and not kept[2] and kept[3] and not kept[20]


def test_line_dedup_rules(spark):
    lines = [(i, f"Own line {i} is longer than what repeats here.\nBoiler.\n\nShared {i // 4}.", f"s{i % 12}", 1) for i in range(24)]
    copies = [(100 + i, "The same text.\nOn every site.", f"s{i}", 1) for i in range(12)]
    docs = spark.createDataFrame([*lines, *copies, (200, None, "s1", None), (201, "Boiler.", None, 3)], "doc_id long, text string, source string, n_chars int")
    got = {r.doc_id: r for r in line_dedup.clean_lines(docs).collect()}
    assert got[3].text == "Own line 3 is longer than what repeats here.\n\nShared 0." and got[3].n_chars == len(got[3].text)
    assert got[105].text == "The same text.\nOn every site." and got[200].text is None and (got[201].text, got[201].n_chars) == ("", 0)


def test_line_dedup_against_plain(spark):
    """Nulls, repeated rows and ids, blank and very long texts, sites about the threshold; sent lines and joined ones."""
    r, docs = random.Random(11), []
    for i in range(400):
        own = [f"own {i} {j}" for j in range(r.randint(0, 2))]
        shared = [f"line {k}" for k in range(14) if r.random() < 0.3]
        docs.append((i, "\n".join(r.sample(own + shared + ["", "  "], len(own + shared) + 2)), f"s{r.randint(0, 1 + i % 14)}" if r.random() < 0.95 else None))
    docs += [docs[3], docs[3], (3, "other\nline 1", "s1"), (None, None, "s1"), (None, "line 1\nx", None), (900, "", "s2"), (901, "\n".join(f"long {i}" for i in range(60_000)) + "\nline 2", "s3")]
    docs += [(1000 + i, "copied line a\ncopied line b", f"s{i}") for i in range(13)]
    want = plain.without_boilerplate(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    for most in (line_dedup.LINES_SENT, 0):
        got = line_dedup.without_boilerplate(df, most_sent=most).selectExpr("row.doc_id", "n_lines", "n_removed", "kept")
        assert rows(got) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 300


def test_line_dedup_tells_copies_from_pages_of_boilerplate(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    pages = [(i, " ".join(word() for _ in range(5)) + "\nA long line of boilerplate that stands on the page of every site.", f"s{i % 12}") for i in range(24)]
    body = [" ".join(word() for _ in range(12)) for _ in range(20)]
    near = [(100 + i, "\n".join([*body, f"Copy {i}."]), f"s{i}") for i in range(12)]
    docs = spark.createDataFrame(pages + near, "doc_id long, text string, source string")
    got = {x.doc_id: x.text for x in line_dedup.clean_lines(docs).collect()}
    assert all(got[i] == t.split("\n")[0] for i, t, _ in pages)
    assert all(got[i] == t for i, t, _ in near)


CLASHING = "doc_id long, text string, row string, hits int, items int, source string, n_chars int, site int, t1 int, h1 int, fp int"


def test_clashing_columns_and_empty_tables(spark):
    full = spark.createDataFrame([(1, "some words here to keep", "r", 1, 2, "s", 23, 3, 4, 5, 6)], CLASHING)
    bench = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    forms = [
        suffix_dedup.repeated_bytes, token_counts.token_counts, simhash.near_duplicates, quality_rules.judged, packing.pack_along_curve, lambda d: quality_classifier.quality_scores(d, labels),
        lambda d: decontamination.benchmark_hits(d, bench), licenses.license_matches, secret_scan.secret_spans, line_dedup.without_boilerplate,
    ]
    for form in forms:
        assert form(full).count() >= 1
        assert form(full.limit(0)).count() == 0
    for form in (simhash.one_of_each, line_dedup.clean_lines, lambda d: decontamination.decontaminated(d, bench)):
        assert rows(form(full)) == rows(full)
        assert form(full.limit(0)).count() == 0

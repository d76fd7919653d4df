"""Near copies that share a vocabulary or a bucket with texts that are none: against all pairs, in both stages."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomchain.llm import line_dedup, rounds, simhash
from loomchain.llm.components import components


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similar_pairs(docs):
    sets = {i: shingles(t) for i, t in docs}
    return {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}


def triples(n):
    """Of three texts on one set of words two are near copies; the third has the words in another order, and the least id in a third of the groups."""
    r, docs = random.Random(6), []
    for g in range(n):
        base = [f"v{g}x{i}" for i in range(120)]
        other = r.sample(base, len(base))
        at = r.randrange(10, 100)
        copy = base[:at] + base[at : at + 2][::-1] + base[at + 2 :]
        texts = r.sample([base, copy, other], 3)
        docs += [(3 * g + k, " ".join(t)) for k, t in enumerate(texts)]
    return docs


def templates(n):
    """Texts of one template, each with words of its own, of which every tenth has a near copy: buckets of far over 48."""
    r, docs = random.Random(7), []
    common = [f"c{i}" for i in range(150)]
    for i in range(n):
        own = list(common)
        for _ in range(7):
            own[r.randrange(150)] = f"o{i}x{r.randint(0, 999)}"
        docs.append((10 * i, " ".join(own)))
        if i % 10 == 0:
            own[r.randrange(150)] = f"o{i}y"
            docs.append((10 * i + 1, " ".join(own)))
    return docs


def classes(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("docs", [triples(24), templates(200)], ids=["one vocabulary", "one template"])
def test_recall_in_both_stages(spark, docs):
    want = similar_pairs(docs)
    assert len(want) >= 18
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    keyed = frame.select(F.col("doc_id").alias("t1"), "text")
    found = {r.node: r.root for r in line_dedup.near_copies(keyed).collect()}
    assert sum(found.get(a, a) == found.get(b, b) for a, b in want) >= 0.9 * len(want)
    right = classes(want)
    assert all(right.get(n) is not None and right[n] == right.get(r) for n, r in found.items())
    nodes = frame.select("doc_id", F.col("text").cast("binary").alias("text"), F.col("doc_id").alias("t1"), F.lit(0).alias("t2")).mapInArrow(simhash._keyed_fingerprints, "doc_id long, fp long, t1 long, t2 int, keys array<long>")
    links = classes([(r.a, r.b) for r in simhash._near_copies(frame.select(F.col("doc_id").alias("t1"), F.col("text").cast("binary").alias("text")), nodes).collect()])
    assert sum(links.get(a, a) == links.get(b, -1) for a, b in want) >= 0.9 * len(want)
    assert all(right[a] == right[b] for a, b in links.items())
    kept = {r.doc_id for r in simhash.one_of_each(frame).collect()}
    assert sum(not {a, b} <= kept for a, b in want) >= 0.9 * len(want)


def test_a_group_of_copies_costs_its_size(spark):
    asked = []

    def verify(pairs):
        asked.append(pairs.count())
        return pairs

    buckets = spark.range(2000).select(F.explode(F.array(*(F.lit(k) for k in range(5)))).alias("key"), F.col("id").alias("t1"))
    found = rounds.verified_links(buckets, verify)
    assert len(set(classes([(r.a, r.b) for r in found.collect()]).values())) == 1 and sum(asked) <= 3 * 2000 + 5


def test_a_pair_in_many_buckets_is_asked_about_once(spark):
    """Members that are linked in one bucket leave only the buckets where they met whom they are linked to."""
    r = random.Random(4)
    members = {key: r.sample(range(90), 40) for key in range(12)}
    want = {(a, b) for m in members.values() for a in m for b in m if a > b and (a - b) % 7 == 0}
    asked = []

    def verify(pairs):
        asked.append([(x.a, x.b) for x in pairs.collect()])
        return pairs.where("(a - b) % 7 = 0")

    buckets = spark.createDataFrame([(k, x) for k, m in members.items() for x in m for _ in range(2)], "key int, t1 long").repartition(4)
    links = [(x.a, x.b) for x in rounds.verified_links(buckets, verify).collect()]
    assert all(len(set(a)) == len(a) for a in asked) and set(links) <= want
    got, right = classes(links), classes(want)
    assert all(got[a] == got[b] for a, b in want) and all(right[a] == right[b] for a, b in links)


def test_who_is_linked_to_a_representative_still_meets_the_others(spark):
    """A bucket of chains: each text is like its neighbours alone, so that most links are between members that are linked to someone else already."""
    n = 3000
    buckets = spark.range(n).select(F.lit(7).alias("key"), F.col("id").alias("t1"))
    asked = []

    def verify(pairs):
        asked.append(pairs.count())
        return pairs.where("a = b + 1 AND a % 30 <> 0")

    links = [(x.a, x.b) for x in rounds.verified_links(buckets, verify).collect()]
    got = classes(links)
    assert all(got[x] == got[x - 1] for x in range(n) if x % 30) and len(set(got.values())) == n // 30


def test_sketches_let_all_similar_pairs_pass(spark):
    """Of pairs at the bound itself, none is dropped by its sketch; most that are less similar are."""
    r = np.random.default_rng(3)
    for n, differ in ((90, 10), (450, 50), (4500, 500)):
        for _ in range(50):
            pool = np.unique(r.integers(0, 1 << 32, n + 2 * differ, dtype=np.uint32))
            r.shuffle(pool)
            sets = [pool[: n - differ], pool[: n - 2 * differ], pool[: n - differ][::-1][: n - 2 * differ], pool[differ:n]]
            sketch = np.array([simhash.sketched(np.sort(x)) for x in sets])
            numbers = np.arange(len(sets))
            passed = {(int(a), int(b)) for a, others in rounds.pairs_across(numbers, numbers, sketch, None, 0, 0.8) for b in others}
            for a in numbers:
                for b in numbers[:a]:
                    both = len(np.intersect1d(sets[a], sets[b]))
                    assert both < 0.8 * (len(sets[a]) + len(sets[b]) - both) or {(a, b), (b, a)} & passed
    strangers = np.array([simhash.sketched(np.unique(r.integers(0, 1 << 32, 300, dtype=np.uint32))) for _ in range(50)])
    assert not list(rounds.pairs_across(np.arange(50), np.arange(50), strangers, None, 0, 0.8))
    # The stage that has its sketches from Spark's functions makes the same of the same hashes.
    some = [int(x) for x in np.unique(r.integers(-(1 << 63), 1 << 63, 200))]
    assert [list(x) for x in spark.createDataFrame([(some,)], "shingles array<long>").select(*line_dedup.sketch("shingles")).collect()] == [simhash.sketched(simhash.compared(np.array(some).view(np.uint64)))]


def test_few_links_cost_few_tasks(spark):
    """What a driver keeps of its tasks grows with their number, which is set by the shuffles where links are few."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    buckets = spark.range(400).select((F.col("id") % 40).alias("key"), F.col("id").alias("t1"))
    context = spark.sparkContext
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        context.setJobGroup("few links", "few links")
        found, named = rounds.linked(buckets, lambda p: p.where("(a - b) % 80 = 0"))
        status = context.statusTracker()
        stages = {i for job in status.getJobIdsForGroup("few links") for i in status.getJobInfo(job).stageIds}
        tasks = sum(info.numCompletedTasks for i in stages if (info := status.getStageInfo(i)))
        context.setLocalProperty("spark.jobGroup.id", None)
        assert {r.node: r.root for r in named.collect()} == {x: x % 80 for x in range(400)}
        assert len(set(classes([(r.a, r.b) for r in found.collect()]).values())) == 80
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tasks < 45 * 40, tasks


def test_pairs_by_joins_are_those_of_python(spark):
    """The last round's pairs, and with representatives no other ones; line dedup, which takes them, runs no Python."""
    r = np.random.default_rng(8)
    base = np.unique(r.integers(0, 1 << 32, 200, dtype=np.uint32))
    rows = []
    for key in range(4):
        for t1 in r.choice(60, 25, replace=False).tolist():
            some = np.unique(np.concatenate([base[t1 % 12 :], r.integers(0, 1 << 32, t1 % 12, dtype=np.uint32)]))
            rows.append((key, t1, t1 % 9, *simhash.sketched(some)))
    placed = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in ["key", "t1", "root", *rounds.SKETCH]))
    want = {}
    for most in (None, 25, 3):
        want[most] = set()
        for key in range(4):
            own = np.array([x[1:] for x in rows if x[0] == key])
            want[most] |= {(max(int(one), int(x)), min(int(one), int(x))) for one, others in rounds.pairs_across(own[:, 0], own[:, 1], own[:, 2:], most, 1, 0.8) for x in others}
        got = rounds.pairs_by_joins(placed, most, 1, 0.8)
        assert "Arrow" not in got._jdf.queryExecution().toString() and "Python" not in got._jdf.queryExecution().toString()
        found = {(x.a, x.b) for x in got.collect()}
        assert found == want[most] if most != 3 else found and found <= want[None]
    assert 0 < len(want[None]) < len({(a, b) for a in range(60) for b in range(a)})


def test_components_by_either_join(spark, monkeypatch):
    """Links sent to the tasks and links joined by shuffles name the same components: chains, stars, trees, numbers below zero."""
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, -x) for x in range(1, 60)] + [(r.randrange(1000, 1300), r.randrange(1000, 1300)) for _ in range(200)] + [(7, 7)]
    found = []
    for most in (1 << 16, 10):
        monkeypatch.setattr("loomchain.llm.common.ROWS_SENT", most)
        rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert len({x.node for x in rows}) == len(rows)
        found.append({x.node: x.root for x in rows})
    right = classes([e for e in edges if e[0] != e[1]])
    least = {}
    for x, root in right.items():
        least[root] = min(x, least.get(root, x))
    assert found == [{x: least[root] for x, root in right.items()}] * 2


def test_nothing_to_link(spark):
    assert rounds.verified_links(spark.createDataFrame([], "key long, t1 long"), lambda p: p).count() == 0
    assert rounds.verified_links(spark.createDataFrame([(1, 1), (2, 2), (2, 3)], "key long, t1 long"), lambda p: p.where("false")).count() == 0

"""The corpus pipeline: what each stage keeps, against plain versions on its own input."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline
import plain
from compare import duck, rows_of_spark, rows_of_sql

from loomchain.llm.common import cut
from loomchain.llm.quality_classifier import quality_scores
from loomchain.llm.queries import ORACLES, QUERIES


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before, out = docs.collect(), cut(stage(spark, docs, sf))
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in before}
            assert sum(r.length for r in out.collect()) == sum({r.doc_id: r.doc_tokens for r in out.collect()}.values())
            break
        assert out.columns == docs.columns
        after = {r.doc_id: r for r in out.collect()}
        pairs = [(r.doc_id, r.text) for r in before]
        if name == "SimHash near-dedup":
            by_print, by_both = ({c for _, _, c in plain.components(pairs, 4, similar)} for similar in (False, True))
            assert by_both <= set(after) <= by_print and len(before) - len(after) >= 0.9 * (len(before) - len(by_both))
        elif name == "benchmark decontamination":
            assert set(after) == {h[0] for h in plain.hits(pairs, bench) if not h[5]}
        elif name == "line dedup":
            want = plain.clean_lines([(r.doc_id, r.text, r.source) for r in before])
            assert {r.doc_id: r.text for r in after.values()} == dict(want)
            assert all(r.n_chars == len(r.text) for r in after.values() if r.text != dict(pairs)[r.doc_id])
        else:
            # Scores of the operator's other form, which works on texts as numbers, decide alike.
            scores = quality_scores(docs, spark.read.parquet(f"{sf}/labels.parquet"))
            assert set(after) == {r.doc_id for r in scores.collect() if r.predicted} and 0.5 * len(before) < len(after) < len(before)
        docs = out


def _written(spark, sf, tmp_path, empty):
    for name in ("documents", "benchmark", "labels"):
        df = spark.read.parquet(f"{sf}/{name}.parquet")
        (df.limit(0) if name in empty else df).write.parquet(f"file://{tmp_path}/{name}.parquet")
    return f"file://{tmp_path}"


def test_empty_documents(spark, sf, tmp_path):
    assert corpus_pipeline.run(spark, _written(spark, sf, tmp_path, {"documents"})).count() == 0


def test_empty_benchmark_and_labels(spark, sf, tmp_path):
    """Nothing is contaminated, and nothing is known to be bad: a document of each class is packed."""
    at = _written(spark, sf, tmp_path, {"benchmark", "labels"})
    packed = {r.doc_id for r in corpus_pipeline.run(spark, at).collect()}
    assert 100 < len(packed) <= spark.read.parquet(f"{sf}/documents.parquet").count()


def test_stages_on_odd_rows(spark, sf):
    """Nulls in every column, repeated rows and ids, empty and very long texts, columns with the names that stages use inside."""
    words = "and so the words go on in a plain sentence that ends here. "
    long = words * 40_000
    odd = [(None, None, None, None), (None, words, "s1", 5), (1, words, "s1", 59), (1, words, "s1", 59), (1, "other words " * 9, None, None), (2, "", "s2", 0), (3, None, "s3", 0), (4, long, "s4", len(long)), (5, long, "s5", len(long))]
    docs = spark.createDataFrame([(*r, 1, 2, "x", 3, None) for r in odd], "doc_id long, text string, source string, n_chars long, fp int, site int, row string, left int, mark string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = cut(stage(spark, docs, sf))
        assert after.schema == docs.schema
        if name == "line dedup":
            assert sorted(map(str, after.collect())) == sorted(map(str, docs.collect()))
        if name == "SimHash near-dedup":
            kept = sorted((r.doc_id, (r.text or "")[:5]) for r in after.collect())
            assert kept == [(1, "and s"), (1, "other"), (2, ""), (4, "and s")]
        docs = after
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()} == {1, 2, 4}


def test_sql(spark, sf):
    connection = duck(sf)
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, sf)
        names, want = rows_of_sql(connection, sql)
        assert sorted(df.columns) == names and rows_of_spark(df) == want


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

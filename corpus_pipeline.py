"""A training corpus from the documents table, in five stages.

1. The quality classifier scores every document and rejects those under its threshold.
2. Cross-site boilerplate lines leave the texts.
3. One document of each group of near-duplicates stays.
4. Documents contaminated by the benchmark leave.
5. What is left is packed into training sequences.

Each stage takes the table that the stage before it wrote, and all but the last return the columns of documents, whatever other columns
there are.

Null and empty texts pass the stages as texts without words; as near-duplicates of each other, one of them stays.  Very long texts are
handled whole.  Rows with a null doc_id are judged like others, and one of them stays for a group only if no row of it has an id.  Rows
that repeat a doc_id are documents of their own, and of rows that repeat doc_id and text one stays.  Null labels and a null source say
nothing.  Without labels every document is accepted, without a benchmark none is contaminated, and without documents the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomchain.llm.common import cut, free, table
from loomchain.llm.decontamination import decontaminated
from loomchain.llm.line_dedup import clean_lines
from loomchain.llm.packing import pack_along_curve
from loomchain.llm.quality_classifier import accepted
from loomchain.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_along_curve(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: The classifier can't be expressed in SQL; the stages are tested against plain versions of their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table; each one's result is written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        last, docs = docs, cut(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        free(last)
    return STAGES[-1][1](spark, docs, sf_dir)

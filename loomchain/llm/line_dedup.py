"""Cross-site boilerplate: lines that stand on many distinct sites are removed.  DataFrame functions only.

Copies of a text count as one site, the least ``source`` among them: a text that many sites hold is a copy, not boilerplate.  A
HyperLogLog sketch of the sites is kept for each line hash and merged by aggregation, so a line that stands in every document is one
small row for each task.  Lines whose estimate is near the threshold get an exact distinct count; for the others the estimate decides.

Up to ``LINES_SENT`` lines found go to the tasks, which clean the texts in place; beyond that each text meets the lines found in it by
a join on the text's hash.  Both ways give the same rows.

``clean_lines``, which the pipeline runs, also tells near copies by what they are: of the texts that hold such a line, those that share a MinHash band
and whose five-word shingles have a similarity of ``SIMILARITY`` or more are linked, each class of near copies counts as one site, and only lines
that still stand on enough sites leave.  Whatever line leaves, leaves every text.

Null text: no lines.  Lines without anything but white space are neither counted nor removed.  A null source is no site.  What is
removed depends on the text alone, so repeated rows and null or repeated doc_ids are treated alike; a text of nothing but boilerplate
becomes empty.  A very long text is a row like any other, cleaned whole.  Other columns, whatever their names, are not read.  Empty
table: empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import cut, free, is_small, sent, table
from loomchain.llm.rounds import SKETCH, linked, needed

#: Distinct sites from which on a line is boilerplate.
SITES = 8
#: log2 of a sketch's registers; its relative error is about 1.04 / sqrt(256) = 6.5 %.
SKETCH_BITS = 8
#: Estimates within this share of the threshold are counted exactly: four times the error.
BAND = 0.26
#: Lines (two numbers each) that are sent to the tasks; more are joined.
LINES_SENT = 20_000
#: Words in a shingle of near copies; bands and rows of their MinHash.  Texts that share a band are linked if enough of their shingles are the same.
SHINGLE, BANDS, BAND_ROWS = 5, 20, 5
SIMILARITY = 0.8

_NOT_BLANK = "[^ \\t\\x0B\\f\\r]"


def _keys(text: Column) -> list[Column]:
    """96 bits of a string."""
    return [F.xxhash64(text), F.hash(text)]


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct("*").alias("row"), F.coalesce(docs["text"], F.lit("")).alias("text"), docs["source"].cast("string").alias("site"))


def text_lines(own: DataFrame) -> DataFrame:
    """(h1, h2: a line's hashes, t1, t2: its text's hashes, site) once for each line of a distinct text that is not blank."""
    t1, t2 = _keys(F.col("text"))
    split = own.select(t1.alias("t1"), t2.alias("t2"), "site", F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(_NOT_BLANK))
    h1, h2 = _keys(F.col("line"))
    # Neither a frequent line nor a frequent text is a hot key here: only copies meet, and each task has combined its own.
    return split.select("t1", "t2", "site", h1.alias("h1"), h2.alias("h2")).groupBy("h1", "h2", "t1", "t2").agg(F.min("site").alias("site"))


def boilerplate_lines(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """(h1, h2) of the lines of ``lines(h1, h2, site)`` that stand on at least so many distinct sites."""
    sketched = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("estimate"))
    likely = cut(sketched.where(F.col("estimate") >= sites * (1 - BAND)), "estimates")
    sure, near = likely.where(F.col("estimate") > sites * (1 + BAND)), likely.where(F.col("estimate") <= sites * (1 + BAND))
    # Distinct before the join, so that a line with very many texts on few sites is a few rows.
    return sure.select("h1", "h2").unionAll(_on_sites(lines.select("h1", "h2", "site").distinct().join(near.select("h1", "h2"), ["h1", "h2"]), sites))


def _on_sites(pairs: DataFrame, sites: int) -> DataFrame:
    counted = pairs.where(F.col("site").isNotNull()).select("h1", "h2", "site").distinct().groupBy("h1", "h2").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= sites).select("h1", "h2")


def _listed(held: list) -> Callable[[Column], Column]:
    """Whether a line is among those in ``held(h1, h2)``, as two look-ups in sets of numbers."""
    one, two = (sorted({r[i] for r in held}) for i in range(2))
    return lambda x: _keys(x)[0].isin(one) & _keys(x)[1].isin(two) if held else F.lit(False)


def _cleaned(own: DataFrame, lines: DataFrame, spread: DataFrame, most_sent: int = LINES_SENT) -> DataFrame:
    """``own`` with lines (all, as an array) and left (those not in ``spread(h1, h2)``)."""
    held = spread.limit(most_sent + 1).collect()
    split = F.split("text", "\n")
    if len(held) <= most_sent:
        found = _listed(held)
        return own.select("row", "text", split.alias("lines")).withColumn("left", F.filter("lines", lambda x: ~found(x)))
    marks = lines.join(spread, ["h1", "h2"], "left_semi").groupBy("t1", "t2").agg(F.collect_set(F.struct("h1", "h2")).alias("marks"))
    t1, t2 = _keys(F.col("text"))
    rows = own.select("row", "text", split.alias("lines"), t1.alias("t1"), t2.alias("t2")).join(marks, ["t1", "t2"], "left")
    in_marks = lambda x: F.array_contains("marks", F.struct(*(k.alias(n) for k, n in zip(_keys(x), ("h1", "h2")))))
    return rows.select("row", "text", "lines", F.when(F.col("marks").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~in_marks(x))).alias("left"))


def without_boilerplate(docs: DataFrame, sites: int = SITES, most_sent: int = LINES_SENT) -> DataFrame:
    """(row: all of ``docs`` as a struct, n_lines, n_removed, kept: the text that is left)."""
    own = _own(docs)
    lines = cut(text_lines(own), "lines")
    cleaned = _cleaned(own, lines, cut(boilerplate_lines(lines, sites), "boilerplate"), most_sent)
    n_lines = F.size(F.filter("lines", lambda x: x.rlike(_NOT_BLANK)))
    return cleaned.select("row", n_lines.cast("long").alias("n_lines"), (F.size("lines") - F.size("left")).cast("long").alias("n_removed"), F.array_join("left", "\n").alias("kept"))


def sketch(hashes: str) -> list[Column]:
    """The columns ``SKETCH`` of a column of hashes: for each bit of eight numbers, whether an odd number of the hashes name it by their upper bits."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(x, 55).bitwiseAND(F.lit(63)).cast("int"))
    odd = lambda i: F.aggregate(hashes, F.lit(0).cast("long"), lambda a, x: F.when(F.shiftrightunsigned(x, 61) == i, a.bitwiseXOR(bit(x))).otherwise(a))
    return [x.alias(c) for x, c in zip([F.size(hashes).cast("long"), *(odd(i) for i in range(len(SKETCH) - 1))], SKETCH)]


def near_copies(texts: DataFrame) -> DataFrame:
    """(node: t1, root) of the texts of ``texts(t1, text)`` that are near copies of others."""
    words = F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    shingled = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - SHINGLE + 1, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, SHINGLE)))
    # Written, so that each of the minima below reads the shingles instead of making them.
    shingles = cut(texts.select("t1", words.alias("words")).select("t1", F.array_distinct(shingled).alias("shingles")), "shingles")

    def least_of(k: int) -> Column:
        # Hashes are spread evenly, so that the one nearest to a point, by exclusive or, is any of them alike.
        return F.array_min(F.transform("shingles", lambda x: x.bitwiseXOR(F.xxhash64(F.lit(k)))))

    sketched = shingles.select("t1", F.array(*(least_of(k) for k in range(BANDS * BAND_ROWS))).alias("least"), *sketch("shingles"))
    bands = F.array(*(F.xxhash64(F.lit(b), F.slice("least", b * BAND_ROWS + 1, BAND_ROWS)) for b in range(BANDS)))
    buckets = cut(sketched.select("t1", *SKETCH, F.explode(bands).alias("key")), "bands")
    # Half of each hash is enough to compare two texts.
    halves = shingles.select("t1", F.transform("shingles", lambda x: F.shiftright(x, 32).cast("int")).alias("shingles"))

    def verify(pairs: DataFrame) -> DataFrame:
        own = needed(halves, pairs)
        side = lambda end, name: own.select(F.col("t1").alias(end), F.col("shingles").alias(name))
        both = F.size(F.array_intersect("one", "two"))
        joined = pairs.join(side("a", "one"), "a").join(side("b", "two"), "b")
        return joined.where(both >= SIMILARITY * (F.size("one") + F.size("two") - both)).select("a", "b")

    _, classes = linked(buckets, verify, SIMILARITY, native=True)
    free(buckets)
    free(shingles)
    return classes


def proven_boilerplate(own: DataFrame, lines: DataFrame, sites: int = SITES) -> DataFrame:
    """(h1, h2) of the lines that stand on so many sites when near copies of a text, too, count once."""
    spread = cut(boilerplate_lines(lines, sites), "boilerplate")
    found = cut(lines.join(spread, ["h1", "h2"], "left_semi"), "found")
    # Every text with such a line is looked at, once.
    t1, t2 = _keys(F.col("text"))
    holders = own.select(t1.alias("t1"), t2.alias("t2"), "text").join(found.select("t1", "t2").distinct(), ["t1", "t2"], "left_semi").dropDuplicates(["t1", "t2"])
    roots = near_copies(holders.select("t1", "text"))
    classed = found.join(sent(roots, is_small(roots)), F.col("t1") == F.col("node"), "left").select("h1", "h2", "site", F.coalesce("root", "t1").alias("class"))
    one = classed.groupBy("class").agg(F.min("site").alias("site"))
    return cut(_on_sites(classed.select("h1", "h2", "class").distinct().join(one, "class"), sites), "boilerplate")


def clean_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with cross-site boilerplate taken out of text, and n_chars, where there is one, following it."""
    own = _own(docs)
    lines = cut(text_lines(own), "lines")
    cleaned = _cleaned(own, lines, proven_boilerplate(own, lines)).withColumn("kept", F.array_join("left", "\n"))
    taken = F.size("left") < F.size("lines")
    columns = {"text": F.when(taken, F.col("kept")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(taken, F.length("kept")).otherwise(F.col("row.n_chars"))
    return cleaned.select(*(columns.get(f.name, F.col("row")[f.name]).cast(f.dataType).alias(f.name) for f in docs.schema))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = without_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed", F.length("kept").cast("long").alias("kept_chars"), F.md5("kept").alias("kept_md5"))


OP10_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source AS site, coalesce(text, '') AS text FROM documents
), texts AS (
  SELECT text, min(site) AS site FROM docs GROUP BY text
), spread AS (
  SELECT line FROM (SELECT site, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^ \\t\\x0B\\f\\r]') GROUP BY line HAVING count(DISTINCT site) >= {SITES}
), lines AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs
), judged AS (
  SELECT r, any_value(doc_id) AS doc_id, count(*) FILTER (WHERE regexp_matches(l.line, '[^ \\t\\x0B\\f\\r]')) AS n_lines,
         count(s.line) AS n_removed, coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE s.line IS NULL), '') AS kept
  FROM lines l LEFT JOIN spread s ON l.line = s.line GROUP BY r
)
SELECT doc_id, n_lines, n_removed, length(kept) AS kept_chars, md5(kept) AS kept_md5 FROM judged
"""

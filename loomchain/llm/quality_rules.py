"""Line-first quality rules.  DataFrame functions only, no shuffle.

Each line is judged alone, and passes if it breaks no rule:

* Punctuation: it ends with a terminal mark of any of several scripts, closing quotes and brackets after it allowed.  A line without one
  passes if it is a list item of some words, if it has marks of code (an indent alone is none), or if it is long, as lines of wrapped prose are.  No line may pile
  exclamation or question marks up, and each has a letter.
* Navigation: it is not cut up by separators, not mostly links, not dense with symbols, and, where it has no terminal mark, no run of
  capitalised words, as menus and breadcrumbs are.
* Boilerplate: a line of usual length has no notice of copyright and a year, and holds none of the phrases that pages repeat.  Very long lines are prose that may mention them.

Lines that fail go, as does a line that stands earlier in the text, and a document that loses more than ``MOST_LOST`` percent of its word
characters is rejected.  The base statistics of the whole text come first, and a document that fails by them is rejected in any case.

Repeated three-word windows are found by sorting the windows' 64-bit hashes of one document with their places; documents without an
equal pair skip the sort.

Null text: no words, all counts zero, base_failed.  A very long text is a row like any other, judged whole.  Rows are judged alone:
repeated rows, null and repeated doc_ids each give their row.  Other columns, whatever their names, are not read.  Empty table: empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.llm.common import table

# White space and symbols of the contract, and phrases that pages repeat.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
PHRASES = (
    "about us", "accept all cookies", "add to cart", "all rights reserved", "alle rechte vorbehalten", "back to top", "click here", "contact us", "cookie policy", "cookies to improve", "datenschutzerklärung",
    "enable javascript", "follow us on", "forgot your password", "leave a comment", "licensed under", "lorem ipsum", "mentions légales", "newsletter", "page links", "política de privacidad",
    "politique de confidentialité", "powered by wordpress", "privacy policy", "privacy settings", "read more", "released under the", "share this", "sign in to", "skip to content", "subscribe now", "terms and conditions",
    "terms of service", "terms of use", "todos los derechos reservados", "tous droits réservés",
)
MIN_WORDS = 50
MOST_REPEATED = 50  # percent of the words
MOST_LOST = 50  # percent of the word characters
SYMBOL_ONE_IN = 20
#: Exclamation and question marks in pairs, and separators, from which on a line fails.
PILES, SEPARATORS = 3, 2
#: Characters of a line up to which phrases count in it.
PHRASE_LINE = 200

#: At a line's end, without the white space behind it: a terminal mark, then closing marks.
TERMINAL = "[.!?…。！？؟।॥۔։။។፡።]([ \u00a0]?[\"')\\]}»”’」』])*\\z"
TAIL = 8
LIST_ITEM = "^[ \\t]*([*•‣·–-]|[0-9]{1,3}[.)])[ \\t]+([^ \\t]+[ \\t]+){2}[^ \\t]"
CODE = "[{};]\\z|^[ \\t]*(//|#include|def |class |return |import |from [a-z.]+ import )|^[ \\t]+.*([=(){}\\[\\];]|->|::|[a-z0-9]_[a-z0-9])"
LONG = "^([^ \\t]*[ \\t]+){11}[^ \\t]"
CAPITALISED = "^[ \\t]*(\\p{Lu}[^ \\t]*[ \\t]+)+\\p{Lu}[^ \\t]*\\z"
#: The same lines, for Java: its matcher calls itself for each repeat of a group, deeper than its stack on a long line, unless the repeats are never given back.
CAPITALISED_HERE = CAPITALISED.replace(")+", ")++")
NOTICE = "(?i)^[ \\t]*(copyright|©|\\(c\\))[^.]{0,20}[0-9]{4}"
LINK = "(https?://|www[.])[^ \\t]*"


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _times(line: Column, what: str) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit(what), F.lit("")))) / len(what)


def line_passes(line: Column) -> Column:
    end = F.rtrim(line, F.lit(" \t\x0b\x0c\r"))
    ended = F.right(end, F.lit(TAIL)).rlike(TERMINAL)
    open_ = ~end.rlike(CAPITALISED_HERE) & (end.rlike(LONG) | end.rlike(LIST_ITEM) | end.rlike(CODE))
    links = (F.contains(line, F.lit("://")) | F.contains(line, F.lit("www."))) & (2 * F.length(F.regexp_replace(line, LINK, "")) < F.length(line))
    separated = (_times(line, "|") >= SEPARATORS) | (_times(line, " › ") >= SEPARATORS) | (_times(line, " • ") >= SEPARATORS) | (_times(line, " > ") >= SEPARATORS)
    symbols = F.length(line) - F.length(_without(line, SYMBOLS))
    low = F.lower(line)
    phrases = F.lit(False)
    for phrase in PHRASES:
        phrases = phrases | F.contains(low, F.lit(phrase))
    piled = _times(line, "!!") + _times(line, "??") >= PILES
    return line.rlike("\\p{L}") & (ended | open_) & ~piled & ~separated & (SYMBOL_ONE_IN * symbols <= F.length(line)) & ~links & ~((F.length(line) <= PHRASE_LINE) & (phrases | line.rlike(NOTICE)))


def repeated_words(rows: DataFrame) -> DataFrame:
    """Adds n_repeat_words to rows with ``words``."""
    n = F.size("words")
    single = rows.withColumn("single", F.transform("words", lambda w: F.xxhash64(w)))
    hashed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("single", i), F.get("single", i + 1), F.get("single", i + 2)))
    grams = single.withColumn("grams", F.when(n >= 3, hashed).otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = grams.withColumn("placed", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), placed).otherwise(none))
    same = lambda x, k: F.coalesce(F.get("placed", k)["h"] == x["h"], F.lit(False))
    twice = F.sort_array(F.transform(F.filter("placed", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))
    found = ordered.withColumn("twice", F.when(F.size("placed") > 0, twice).otherwise(F.array().cast("array<int>")))
    covered = F.transform("twice", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("twice", k + 1) - p, F.lit(3))))
    return found.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)).drop("single", "grams", "placed", "twice")


def judged(docs: DataFrame) -> DataFrame:
    """(row: all of ``docs`` as a struct, the base statistics, base_failed, kept_chars, kept)."""
    own = docs.select(F.struct("*").alias("row"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    words = own.withColumn("words", F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != ""))
    counted = repeated_words(words)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t\\x0B\\f\\r]"))
    split = counted.withColumn("lines", lines).withColumn("once", F.array_distinct("lines"))
    base = split.select(
        "row", F.size("words").cast("long").alias("n_words"), F.length(_without(F.col("text"), WHITE)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size("once")).cast("long").alias("n_dup_lines"), "n_repeat_words",
        F.length(_without(F.array_join(F.filter("once", line_passes), ""), WHITE)).cast("long").alias("kept_chars"),
    )
    failed = base.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    return failed.withColumn("kept", ~F.col("base_failed") & (100 * (F.col("word_chars") - F.col("kept_chars")) <= MOST_LOST * F.col("word_chars")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_chars")


_quoted = lambda pattern: "'" + pattern.replace("'", "''") + "'"
_sql_times = lambda what: f"(length(line) - length(replace(line, '{what}', ''))) / {len(what)}"
_SQL_PHRASES = " OR ".join(f"contains(lower(line), {_quoted(p)})" for p in PHRASES)
_SQL_SEPARATED = " OR ".join(f"{_sql_times(x)} >= {SEPARATORS}" for x in ("|", " › ", " • ", " > "))
_SQL_PASSES = f"""regexp_matches(line, '\\p{{L}}')
  AND (regexp_matches(right(tail, {TAIL}), {_quoted(TERMINAL)}) OR (NOT regexp_matches(tail, {_quoted(CAPITALISED)})
       AND (regexp_matches(tail, {_quoted(LONG)}) OR regexp_matches(tail, {_quoted(LIST_ITEM)}) OR regexp_matches(tail, {_quoted(CODE)}))))
  AND {_sql_times("!!")} + {_sql_times("??")} < {PILES} AND NOT ({_SQL_SEPARATED})
  AND {SYMBOL_ONE_IN} * (length(line) - length(translate(line, '{SYMBOLS}', ''))) <= length(line)
  AND NOT ((contains(line, '://') OR contains(line, 'www.')) AND 2 * length(regexp_replace(line, {_quoted(LINK)}, '', 'g')) < length(line))
  AND NOT (length(line) <= {PHRASE_LINE} AND ({_SQL_PHRASES} OR regexp_matches(line, {_quoted(NOTICE)})))"""
OP4_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT r, w, row_number() OVER (PARTITION BY r ORDER BY pos) AS pos FROM (
    SELECT r, unnest(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+')) AS w,
           generate_subscripts(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+'), 1) AS pos FROM docs)
  WHERE w <> ''
), grams AS (
  SELECT r, pos, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS gram FROM words WINDOW o AS (PARTITION BY r ORDER BY pos)
), twice AS (
  SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, gram) AS n FROM grams WHERE gram IS NOT NULL) WHERE n >= 2
), repeated AS (
  SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, pos + unnest([0, 1, 2]) AS pos FROM twice) GROUP BY r
), lines AS (
  SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^ \\t\\x0B\\f\\r]')
), by_line AS (
  SELECT r, sum(n) - count(*) AS n_dup_lines, sum(CASE WHEN {_SQL_PASSES} THEN length(regexp_replace(line, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) ELSE 0 END) AS kept_chars
  FROM (SELECT r, line, count(*) AS n, rtrim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS tail FROM lines GROUP BY r, line) GROUP BY r
), counted AS (
  SELECT r, count(*) AS n_words FROM words GROUP BY r
), base AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, length(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) AS word_chars,
         length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
  FROM docs LEFT JOIN counted USING (r) LEFT JOIN by_line USING (r) LEFT JOIN repeated USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
         AND 100 * (word_chars - kept_chars) <= {MOST_LOST} * word_chars AS kept, kept_chars
FROM base
"""

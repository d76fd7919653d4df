"""Queries over heights, offsets and checkpoints."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.operators import bitmaps as B
from loomchain.operators import ranges as G
from loomchain.operators import relations as R
from loomchain.plans.registry import ALL_HEIGHTS, CHECKPOINTS, COMMIT, DONE, MESSAGES, MISSING, POSITIONS, query, with_
from loomchain.shipping import ship
from loomchain.sources import landed as L
from loomchain.sources import tables as T
from loomchain.streaming.ingest import map_heights as map_plan


def _window(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return L.height_bounds(spark, d), L.processed_heights(spark, d), L.inflight_heights(spark, d)


def _missing(spark: SparkSession, d: str) -> DataFrame:
    return G.missing_heights(*_window(spark, d))


@query(with_(POSITIONS, ALL_HEIGHTS, MISSING) + "SELECT h FROM missing")
def missing_heights(spark, d):
    return _missing(spark, d).select("h")


@query(with_(POSITIONS, ALL_HEIGHTS) + "SELECT h FROM heights WHERE h NOT IN (SELECT h FROM processed) AND h NOT IN (SELECT h FROM inflight)")
def unprocessed_set(spark, d):
    bounds, processed, inflight = _window(spark, d)
    return B.missing(bounds, B.united(B.bitmaps(processed), B.bitmaps(inflight))).select("h")


@query(with_(POSITIONS, ALL_HEIGHTS, MISSING) + "SELECT min(h) AS h FROM missing")
def next_height(spark, d):
    return _missing(spark, d).agg(F.min("h").alias("h"))


@query(with_(POSITIONS) + "SELECT DISTINCT o_orderkey * 2 AS h FROM orders, bounds WHERE o_orderkey * 2 BETWEEN lowest AND highest AND o_orderkey * 2 NOT IN (SELECT h FROM processed) AND o_orderkey * 2 NOT IN (SELECT h FROM inflight)")
def claimable_heights(spark, d):
    wanted = L.headers(spark, d).select(F.lit("all").alias("chain"), (F.col("block_number") * 2).alias("h"))
    return G.claimable(wanted, *_window(spark, d)).select("h")


@query(with_(POSITIONS) + """, w AS (SELECT o_orderkey - 100 + CASE WHEN o_orderkey % 2 = 0 THEN 200 ELSE 0 END AS h FROM orders), edge AS (SELECT lowest + 50 AS lo, highest - 50 AS hi FROM bounds)
SELECT CASE WHEN h < lo THEN 'below' WHEN h > hi THEN 'above' WHEN h IN (SELECT h FROM processed) THEN 'processed' ELSE 'pending' END AS state, count(*) AS n FROM w, edge GROUP BY 1""")
def height_state(spark, d):
    bounds, processed, _ = _window(spark, d)
    wanted = L.headers(spark, d).select(F.lit("all").alias("chain"), (F.col("block_number") - 100 + F.when(F.col("block_number") % 2 == 0, 200).otherwise(0)).alias("h"))
    inner = bounds.select("chain", (F.col("lowest") + 50).alias("lowest"), (F.col("highest") - 50).alias("highest"))
    return G.height_state(wanted, inner, processed).groupBy("state").agg(F.count("*").alias("n"))


_MARK = "mark AS (SELECT min(x) AS watermark FROM (SELECT lowest AS x FROM bounds WHERE lowest NOT IN (SELECT h FROM processed) UNION ALL SELECT h + 1 FROM processed WHERE h + 1 NOT IN (SELECT h FROM processed)))"
_LATE = "late AS (SELECT h FROM processed WHERE h >= 1), late_mark AS (SELECT min(h) AS first FROM late)"


@query(with_(POSITIONS, _MARK) + "SELECT watermark FROM mark")
def contiguous_watermark(spark, d):
    bounds, processed, _ = _window(spark, d)
    return G.contiguous_watermark(processed, bounds).select("watermark")


@query(with_(POSITIONS) + """, p AS (SELECT h, lead(h) OVER (ORDER BY h) AS nxt FROM (SELECT h FROM processed UNION ALL SELECT lowest - 1 FROM bounds UNION ALL SELECT highest + 1 FROM bounds))
SELECT h + 1 AS first, nxt - 1 AS last FROM p WHERE nxt > h + 1""")
def gap_ranges(spark, d):
    bounds, processed, _ = _window(spark, d)
    return G.gap_ranges(processed, bounds).select("first", "last")


@query(with_(POSITIONS, ALL_HEIGHTS, MISSING) + "SELECT h, (row_number() OVER (ORDER BY h) - 1) // 32 AS chunk FROM (SELECT h FROM missing ORDER BY h LIMIT 256)")
def backfill_plan(spark, d):
    bounds, processed, inflight = _window(spark, d)
    return G.backfill_plan(bounds, processed.unionAll(inflight), 256, 32).select("h", "chunk")


_OWN = """own AS (SELECT 'chain-' || CAST(o_orderkey % 3 AS VARCHAR) AS chain, o_orderkey // 3 AS h, o_orderstatus <> 'P' AS done FROM orders),
lacks AS (SELECT chain, h FROM own GROUP BY 1, 2 HAVING NOT bool_or(done))"""


@query(f"WITH {_OWN} SELECT chain, h, (row_number() OVER (PARTITION BY chain ORDER BY h) - 1) // 32 AS chunk FROM lacks QUALIFY row_number() OVER (PARTITION BY chain ORDER BY h) <= 100")
def backfill_by_chain(spark, d):
    """Three chains, each with the lowest heights that it lacks."""
    own = L.headers(spark, d).select(F.concat(F.lit("chain-"), (F.col("block_number") % 3).cast("string")).alias("chain"), F.floor(F.col("block_number") / 3).alias("h"), "status")
    bounds = own.groupBy("chain").agg(F.min("h").alias("lowest"), F.max("h").alias("highest"))
    return G.backfill_plan(bounds, own.where("status <> 'P'"), 100, 32)


@query(with_(POSITIONS, ALL_HEIGHTS, MISSING) + "SELECT h, h * h AS result FROM missing WHERE h % 10 <> 3 UNION ALL SELECT h, NULL FROM missing WHERE h % 10 = 3")
def map_heights(spark, d):
    """A user's worker over all missing heights; some fail and are reported."""
    ship(spark)

    def worker(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame({"h": p["h"], "result": (p["h"] * p["h"]).where(p["h"] % 10 != 3).astype("Int64")})

    return map_plan(_missing(spark, d), worker, "h long, result long", 8)


@query(with_(POSITIONS) + ", cut AS (SELECT lowest + 1000 AS c FROM bounds) SELECT h FROM processed, cut WHERE h >= c")
def reset_window(spark, d):
    bounds, processed, _ = _window(spark, d)
    wanted = bounds.select("chain", (F.col("lowest") + 1000).alias("new_lowest")).where("new_lowest > 0")
    return G.reset_window(processed, bounds.withColumn("highest", F.greatest("highest", F.col("lowest") + 1000)), wanted).select("h")


@query(with_(POSITIONS, _MARK) + "SELECT watermark AS lowest, highest, (SELECT count(*) FROM processed WHERE h >= watermark) AS pending FROM mark, bounds")
def window_snapshot(spark, d):
    bounds, processed, _ = _window(spark, d)
    return G.window_snapshot(processed, bounds).select("lowest", "highest", "pending")


@query(with_(POSITIONS, _MARK) + "SELECT watermark AS lowest, highest, CASE WHEN watermark > highest THEN 0 ELSE highest - watermark END AS gap, watermark > highest + 1 AS inconsistent, highest - watermark > 100 AS alert FROM mark, bounds")
def gap_report(spark, d):
    bounds, processed, _ = _window(spark, d)
    return G.gap_report(G.window_snapshot(processed, bounds), 100).drop("chain")


@query(with_(POSITIONS) + "SELECT max(h) AS highest, max(h) + 1 AS next_checkpoint FROM processed")
def max_height(spark, d):
    return L.processed_heights(spark, d).agg(F.max("h").alias("highest"), (F.max("h") + 1).alias("next_checkpoint"))


@query(with_(POSITIONS, MESSAGES) + "SELECT event_id AS h FROM messages WHERE event_id IN (SELECT h FROM processed)")
def seen_heights(spark, d):
    logged = L.message_log(spark, d).select(F.col("key").try_cast("bigint").alias("h"))
    return logged.intersect(L.processed_heights(spark, d).select("h"))


def _initial(spark: SparkSession, d: str, value: int = -1) -> DataFrame:
    return L.message_log(spark, d).select("partition").distinct().withColumn("committed", F.lit(value).cast("bigint"))


@query(with_(MESSAGES, DONE, COMMIT) + "SELECT c.partition, committed, count(o) AS pending FROM commits c LEFT JOIN done x ON x.partition = c.partition AND o > committed GROUP BY ALL")
def offset_commit(spark, d):
    return G.offset_commit(L.processed_offsets(spark, d), _initial(spark, d))


@query(with_(MESSAGES, DONE, COMMIT) + """SELECT c.partition, max("offset") + 1 AS high, committed + 1 - 10 AS consumed, max("offset") + 1 - (committed + 1) AS lag FROM commits c JOIN messages m ON m.partition = c.partition GROUP BY c.partition, committed""")
def partition_lag(spark, d):
    commits = G.offset_commit(L.processed_offsets(spark, d), _initial(spark, d)).select("partition", (F.col("committed") + 1).alias("committed"))
    return R.partition_lag(L.message_log(spark, d), commits, _initial(spark, d, 10).withColumnRenamed("committed", "initial"))


@query(with_(MESSAGES, DONE) + """SELECT DISTINCT partition, o AS "offset" FROM (SELECT partition, o FROM done UNION ALL SELECT partition, "offset" FROM messages WHERE "offset" % 3 = 0)""")
def merge_offsets(spark, d):
    sets = [B.bitmaps(o.select(F.col("partition").alias("chain"), F.col("offset").alias("h"))) for o in (L.processed_offsets(spark, d), L.message_log(spark, d).where("offset % 3 = 0"))]
    return B.members(B.united(*sets)).select(F.col("chain").alias("partition"), F.col("h").alias("offset"))


@query(with_(MESSAGES, DONE, COMMIT) + """SELECT c.partition, CASE WHEN c.partition <> 3 AND committed + 1 >= low THEN committed + 1 ELSE low END AS start, NOT (c.partition <> 3 AND committed + 1 >= low) AS reset
FROM commits c JOIN (SELECT partition, min("offset") + 20 AS low FROM messages GROUP BY 1) m USING (partition)""")
def start_offsets(spark, d):
    """Partition 3 has no commit; the log starts at its 20th message."""
    log = L.message_log(spark, d).groupBy("partition").agg((F.min("offset") + 20).alias("low"), (F.max("offset") + 1).alias("high"))
    commits = G.offset_commit(L.processed_offsets(spark, d), _initial(spark, d)).select("partition", (F.col("committed") + 1).alias("committed")).where("partition <> 3")
    return R.start_offsets(commits, log, "earliest")


_SEEN = """seen AS (SELECT user_id % 3 AS chain, event_id AS seq, event_id - CASE WHEN event_type = 'error' THEN 100 ELSE 0 END AS h FROM messages)"""


@query(with_(MESSAGES, _SEEN) + """, r AS (SELECT chain, seq, h, max(h) OVER (PARTITION BY chain ORDER BY seq ROWS UNBOUNDED PRECEDING) AS highest, max(h) OVER (PARTITION BY chain ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM seen)
SELECT chain, seq, highest, coalesce(h <= before, false) AS late FROM r""")
def head_progress(spark, d):
    heads = L.message_log(spark, d).select((F.col("user_id") % 3).alias("chain"), F.col("event_id").alias("seq"), (F.col("event_id") - F.when(F.col("event_type") == "error", 100).otherwise(0)).alias("h"))
    run = G.running(heads, ["chain"], F.floor(F.col("seq") / 1000), ["seq"], F.col("h"), "max", "highest")
    # Late: an earlier head reached as far.  The first head at each height is the one with the least sequence.
    first = run.groupBy("chain", "highest").agg(F.min("seq").alias("first_seq"))
    return run.join(first, ["chain", "highest"]).select("chain", "seq", "highest", (F.col("seq") > F.col("first_seq")).alias("late"))


_TRIES = "tries AS (SELECT event_id % 500 AS h, event_id AS seq, event_type <> 'error' AS ok FROM messages)"


@query(with_(MESSAGES, _TRIES) + ", last AS (SELECT h, max(seq) FILTER (WHERE ok) AS s FROM tries GROUP BY 1) SELECT t.h, count(*) AS failures, count(*) AS retry_seconds FROM tries t JOIN last USING (h) WHERE NOT ok AND (s IS NULL OR seq > s) GROUP BY t.h HAVING count(*) >= 2")
def failed_heights(spark, d):
    tries = L.message_log(spark, d).select((F.col("event_id") % 500).alias("h"), F.col("event_id").alias("seq"), (F.col("event_type") != "error").alias("ok"))
    return R.failed_heights(tries, 2)


@query(with_(CHECKPOINTS) + "SELECT c.chain_id, coalesce(m.lowest, 0) AS lowest, m.lowest IS NOT NULL AS exists FROM (SELECT DISTINCT chain_id FROM checkpoints UNION ALL SELECT 99) c LEFT JOIN (SELECT chain_id, arg_max(lowest_unprocessed_block, (timestamp, lowest_unprocessed_block)) AS lowest FROM checkpoints GROUP BY 1) m USING (chain_id)")
def latest_checkpoint(spark, d):
    c = L.checkpoints(spark, d)
    wanted = c.select("chain_id").distinct().unionByName(c.agg(F.max(F.lit(99)).cast("bigint").alias("chain_id")))
    return R.latest_checkpoint(c, wanted)


@query(with_(CHECKPOINTS) + "SELECT * FROM checkpoints ORDER BY timestamp DESC, lowest_unprocessed_block DESC LIMIT 1")
def newest_checkpoint(spark, d):
    return L.checkpoints(spark, d).orderBy(F.desc("timestamp"), F.desc("lowest_unprocessed_block")).limit(1)


@query(with_(CHECKPOINTS) + """, m AS (SELECT chain_id, arg_max(lowest_unprocessed_block, (timestamp, lowest_unprocessed_block)) AS lowest FROM checkpoints GROUP BY 1)
SELECT chain_id, least(CASE WHEN chain_id = 0 THEN 5 ELSE lowest END, CASE WHEN chain_id = 1 THEN 100 ELSE 1000000 END) AS start, CASE WHEN chain_id = 1 THEN 100 ELSE 1000000 END AS "end" FROM m""")
def resume_plan(spark, d):
    c = L.checkpoints(spark, d)
    chains = c.select("chain_id").distinct()
    wanted = chains.select("chain_id", F.when(F.col("chain_id") == 0, 5).cast("bigint").alias("explicit_start"), F.when(F.col("chain_id") == 1, 100).otherwise(1000000).cast("bigint").alias("end"))
    return R.resume_plan(wanted, R.latest_checkpoint(c, chains))


_BATCHES = "b AS (SELECT user_id % 3 AS chain, event_id // 1000 AS batch, max(event_id) AS lowest FROM messages GROUP BY ALL)"


@query(with_(MESSAGES, _BATCHES) + ", s AS (SELECT *, lowest - coalesce(lag(lowest) OVER (PARTITION BY chain ORDER BY batch), lowest) AS step FROM b) SELECT chain, sum(step) AS committed, count(*) FILTER (WHERE step > 0) AS advances, max(lowest) AS lowest FROM s GROUP BY 1")
def commit_progress(spark, d):
    marks = L.message_log(spark, d).groupBy((F.col("user_id") % 3).alias("chain"), F.floor(F.col("event_id") / 1000).alias("batch")).agg(F.max("event_id").alias("lowest"))
    return R.commit_progress(marks)


@query(with_(MESSAGES, DONE, COMMIT) + "SELECT CAST(partition AS BIGINT) AS chain_id, committed + 1 AS lowest_unprocessed_block, CAST(1700000000 AS BIGINT) AS timestamp FROM commits")
def write_checkpoint(spark, d):
    commits = G.offset_commit(L.processed_offsets(spark, d), _initial(spark, d))
    rows = commits.select(F.col("partition").cast("bigint").alias("chain_id"), (F.col("committed") + 1).alias("lowest_unprocessed_block"), F.lit(1700000000).cast("bigint").alias("timestamp"))
    return T.written(rows, "checkpoints")

"""Streaming queries: the landed messages as a directory of files that arrive one after another."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomchain.functions import codecs as C
from loomchain.operators import decode as D
from loomchain.operators import ranges as G
from loomchain.operators import relations as R
from loomchain.operators.ranges import numbered
from loomchain.plans.registry import COMMIT, DONE, MESSAGES, query, with_
from loomchain.sources import landed as L
from loomchain.sources import message_log as M
from loomchain.sources import schemas as S
from loomchain.sources import tables as T
from loomchain.sources.snapshots import SnapshotTable
from loomchain.streaming import ingest as I
from loomchain.streaming import positions as P

FILES = 4
#: Rows of a landed file at most, so that a batch of the stream does not grow with the log.
FILE_ROWS = 500_000


def _land(messages: DataFrame, name: str) -> str:
    """Writes messages into a few files in the order of their heights."""
    at = T.new_path(messages.sparkSession, name)
    columns = [f.name for f in S.struct_of(S.MESSAGES)]
    messages.withColumn("_h", F.col("key").try_cast("bigint")).repartitionByRange(FILES, "_h", "offset").select(*columns).write.option("maxRecordsPerFile", FILE_ROWS).parquet(at)
    return at


def _run(stream: DataFrame, root: str, write, mode: str = "append") -> None:
    P.start(stream, root, write, mode).awaitTermination()


def _collected(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All rows that a stream gave, with the number of their batch."""
    root = T.new_path(stream.sparkSession, name)
    _run(stream, root, lambda batch, n: batch.write.mode("overwrite").parquet(f"{root}/rows/batch_id={n}"), mode)
    return stream.sparkSession.read.parquet(f"{root}/rows")


def _stream(spark: SparkSession, d: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    return M.stream_files(spark, _land(L.message_log(spark, d), name), files_per_trigger)


#: Messages that a batch of a log's stream has at most.
PER_BATCH = 40_000


def _log_stream(spark: SparkSession, d: str, name: str, wanted: dict[int, int] | str = "earliest", most: int = PER_BATCH, at: str | None = None) -> DataFrame:
    """All rows of a log's stream, with their batch.  It runs for one batch, is stopped, and a second run goes on to the log's end."""
    if at is None:
        at = T.new_path(spark, f"{name}_log")
        M.write_files(L.messages(spark, d), at, "blocks")
    root = T.new_path(spark, name)
    stream = M.stream_log(spark, at, wanted, most, f"{root}/_admitted").select("partition", "offset", F.col("value").isNotNull().alias("full"))
    write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{root}/rows/batch_id={n}")
    _run(stream, root, write)
    again = P.start(stream, root, write, interval="0 seconds")
    again.processAllAvailable()
    again.stop()
    return spark.read.parquet(f"{root}/rows")


@query(with_(MESSAGES) + """SELECT partition, count(*) AS n, count(*) FILTER (WHERE error_class IS NULL OR error_class <> 'nil_message') AS n_values, max("offset") AS last FROM messages GROUP BY 1""")
def stream_scan(spark, d):
    rows = _log_stream(spark, d, "scan")
    return rows.groupBy("partition").agg(F.count("*").alias("n"), F.count_if("full").alias("n_values"), F.max("offset").alias("last"))


@query(with_(MESSAGES) + f"""SELECT count(*) AS n, (SELECT greatest(1, CAST(ceil(count(*) / {PER_BATCH}.0) AS BIGINT)) FROM messages) AS batches, least(count(*), {PER_BATCH}) AS largest FROM messages""")
def stream_admission(spark, d):
    """Batches of a log's stream and the largest one's messages: the limit holds across a restart."""
    sizes = _log_stream(spark, d, "admission").groupBy("batch_id").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("n"), F.count("*").alias("batches"), F.max("n").alias("largest"))


@query(with_(MESSAGES, DONE, COMMIT) + """, start AS (SELECT c.partition, CASE WHEN c.partition <> 3 AND committed + 1 >= low THEN committed + 1 ELSE low END AS o
  FROM commits c JOIN (SELECT partition, min("offset") AS low FROM messages GROUP BY 1) m USING (partition))
SELECT m.partition, count(*) AS n, min("offset") AS first, max("offset") AS last FROM messages m JOIN start s ON s.partition = m.partition AND "offset" >= o GROUP BY 1""")
def stream_from_offsets(spark, d):
    """A stream that starts behind each partition's commit; partition 3 has none and starts at the log's first offset."""
    at = T.new_path(spark, "resumed_log")
    M.write_files(L.messages(spark, d), at, "blocks")
    log = M.ends(spark, at)
    commits = G.offset_commit(L.processed_offsets(spark, d), log.select("partition", F.lit(-1).cast("bigint").alias("committed")))
    starts = R.start_offsets(commits.select("partition", (F.col("committed") + 1).alias("committed")).where("partition <> 3"), log, "earliest")
    wanted = {r["partition"]: r["start"] for r in starts.collect()}  # one row for each partition
    return _log_stream(spark, d, "resumed", wanted, at=at).groupBy("partition").agg(F.count("*").alias("n"), F.min("offset").alias("first"), F.max("offset").alias("last"))


_GOOD = """SELECT 'blocks' AS name, count(*) AS n FROM messages WHERE error_class IS NULL UNION ALL SELECT 'transactions', count(*) FROM messages WHERE error_class IS NULL AND event_id % 2 = 1
UNION ALL SELECT 'logs', count(*) FROM messages WHERE error_class IS NULL AND event_id % 2 = 1 UNION ALL SELECT 'dead_letters', count(*) FROM messages WHERE error_class IS NOT NULL"""


def _ingested(spark: SparkSession, d: str) -> str:
    root = T.new_path(spark, "ingest")
    I.start(_stream(spark, d, "ingest_messages", FILES // 2), root).awaitTermination()
    return root


@query(with_(MESSAGES) + _GOOD)
def stream_ingest(spark, d):
    root = _ingested(spark, d)
    counts = [I.table(spark, root, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in ("blocks", "transactions", "logs", "dead_letters")]
    return counts[0].unionAll(counts[1]).unionAll(counts[2]).unionAll(counts[3])


#: Seconds of block time in a span of the queries' snapshot tables, and files of a group from which on it is merged in the end.
SPAN, MOST_FILES = 5 * 86_400, 1


def _snapshots(spark: SparkSession, d: str, names: tuple[str, ...] = ("blocks", "transactions", "logs")) -> str:
    """The named tables filled by a stream of several batches, one of which is entered a second time, as after a failure.

    Groups of many files are merged meanwhile, the others once in the end: merged after each batch, a group would be written again as often as it gets rows.
    """
    root = T.new_path(spark, "snapshots")
    write = I.snapshot_writer(root, lambda classified: {k: rows for k, rows in I.chain_tables(classified).items() if k in (*names, "dead_letters")}, span=SPAN)

    def twice(batch: DataFrame, n: int) -> None:
        write(batch, n)
        if n == 1:
            write(batch, n)

    _run(_stream(spark, d, "snapshot_messages", FILES // 2), root, twice)
    for name in names:
        _snapshot(spark, root, name).compact(MOST_FILES)
    return root


def _snapshot(spark: SparkSession, root: str, name: str) -> SnapshotTable:
    return SnapshotTable(spark, root, name, SPAN)


@query(with_(MESSAGES) + """SELECT 'blocks' AS name, count(*) AS n, true AS bounded FROM messages WHERE error_class IS NULL UNION ALL SELECT unnest(['transactions', 'logs']), count(*), true FROM messages WHERE error_class IS NULL AND event_id % 2 = 1""")
def snapshot_ingest(spark, d):
    """Rows of the snapshot tables, and whether no (chain, span) has more files than it may have."""
    root, parts = _snapshots(spark, d), []
    for name in ("blocks", "transactions", "logs"):
        held = _snapshot(spark, root, name)
        files = held.files().groupBy("chain", "span").agg(F.count("*").alias("k")).agg((F.max("k") <= MOST_FILES).alias("bounded"))
        parts.append(held.read().agg(F.count("*").alias("n")).crossJoin(files).select(F.lit(name).alias("name"), "n", "bounded"))  # one row each
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query(with_(MESSAGES) + """, span AS (SELECT max(event_id) // 3 AS lo, max(event_id) // 3 + 99 AS hi FROM messages)
SELECT event_id AS block_number, 'chain-' || CAST(user_id % 3 AS VARCHAR) AS blockchain_id, '0x' || sha256(CAST(event_id AS VARCHAR)) AS hash FROM messages, span WHERE error_class IS NULL AND event_id BETWEEN lo AND hi""")
def lookup_by_height(spark, d):
    """A hundred heights of a snapshot table: files without any of them are not opened."""
    held = _snapshot(spark, _snapshots(spark, d, ("blocks",)), "blocks")
    low = L.messages(spark, d).agg(F.floor(F.max(F.col("key").cast("bigint")) / 3)).first()[0]
    return held.read(low=low, high=low + 99).select(F.col("block_number").cast("bigint").alias("block_number"), "blockchain_id", C.hex_text(F.col("hash")).alias("hash"))


@query(with_(MESSAGES) + """, span AS (SELECT max(event_id) // 3 AS lo, max(event_id) // 3 + 99 AS hi FROM messages)
SELECT '0x' || sha256(CAST(event_id + 1 AS VARCHAR)) AS hash, event_id AS block_number, user_id AS nonce FROM messages, span WHERE error_class IS NULL AND event_id % 2 = 1 AND event_id BETWEEN lo AND hi""")
def lookup_by_hash(spark, d):
    """Transactions by their hashes, from the row groups whose Bloom filters may have them."""
    held = _snapshot(spark, _snapshots(spark, d, ("transactions",)), "transactions")
    low = L.messages(spark, d).agg(F.floor(F.max(F.col("key").cast("bigint")) / 3)).first()[0]
    wanted = [hashlib.sha256(str(n + 1).encode()).digest() for n in range(low, low + 100)]
    return held.lookup(wanted).select(C.hex_text(F.col("hash")).alias("hash"), F.col("block_number").cast("bigint").alias("block_number"), F.col("nonce").cast("bigint").alias("nonce"))


@query(with_(MESSAGES) + "SELECT error_class, count(*) AS n FROM messages WHERE error_class IS NOT NULL GROUP BY 1")
def stream_dlq(spark, d):
    return I.table(spark, _ingested(spark, d), "dead_letters").groupBy("error_class").agg(F.count("*").alias("n"))


_CHAINS = """pos AS (SELECT CAST(user_id % 3 AS VARCHAR) AS chain, row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS h, event_type FROM messages),
kept AS (SELECT chain, h FROM pos WHERE event_type <> 'error' OR h < 50)"""
_STATE = """, edge AS (SELECT chain, min(x) AS lowest FROM (SELECT chain, 0 AS x FROM (SELECT DISTINCT chain FROM kept) c WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.chain = c.chain AND k.h = 0)
  UNION ALL SELECT chain, h + 1 FROM kept k WHERE NOT EXISTS (SELECT 1 FROM kept o WHERE o.chain = k.chain AND o.h = k.h + 1)) GROUP BY 1),
win AS (SELECT e.chain, lowest, max(h) AS highest, count(*) FILTER (WHERE h >= lowest) AS pending FROM edge e JOIN kept k ON k.chain = e.chain GROUP BY 1, 2)"""


def _chain_positions(spark: SparkSession, d: str) -> DataFrame:
    """Messages whose offset is the position in their chain, and whose topic is the chain."""
    m = L.message_log(spark, d).withColumn("chain", (F.col("user_id") % 3).cast("string")).drop("offset")
    placed = numbered(m, ["chain"], F.floor(F.col("event_id") / L.LOG_BUCKET), ["event_id"], "offset")
    return placed.where("event_type <> 'error' OR offset < 50").withColumn("topic", F.col("chain"))


def _window_stream(spark: SparkSession, d: str, name: str, interval: float | None = None, max_gap: int = 0) -> DataFrame:
    stream = M.stream_files(spark, _land(_chain_positions(spark, d), f"{name}_messages"))
    return P.stream_watermark(stream.select(F.col("topic").alias("chain"), F.col("offset").alias("h")), 0, interval, max_gap)


def _windows(spark: SparkSession, d: str, name: str) -> DataFrame:
    return _collected(_window_stream(spark, d, name), name, "update")


def _newest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("chain").agg(F.max_by(F.struct("lowest", "highest", "pending"), "batch_id").alias("w")).select("chain", "w.*")


@query(with_(MESSAGES, _CHAINS) + _STATE + " SELECT chain, lowest, highest, pending FROM win")
def stream_watermark(spark, d):
    return _newest(_windows(spark, d, "watermark"))


@query(with_(MESSAGES) + """, win AS (SELECT 'blocks/' || CAST(partition AS VARCHAR) AS chain, max("offset") + 1 AS lowest, max("offset") AS highest, CAST(0 AS BIGINT) AS pending FROM messages GROUP BY 1) SELECT * FROM win""")
def stream_offset_window(spark, d):
    return _newest(_collected(P.stream_offset_window(_stream(spark, d, "offset_messages")), "offset_window", "update"))


@query(with_(MESSAGES, _CHAINS) + _STATE + " SELECT chain, lowest AS lowest_unprocessed_block FROM win")
def stream_checkpoint(spark, d):
    root = T.new_path(spark, "stream_checkpoint")
    _run(_window_stream(spark, d, "checkpoint"), root, P.checkpoint_sink(f"{root}/rows", lambda n: 1700000000 + 60 * n), "update")
    rows = spark.read.parquet(f"{root}/rows")
    return rows.groupBy("chain").agg(F.max(F.struct("timestamp", "lowest_unprocessed_block")).alias("m")).select("chain", "m.lowest_unprocessed_block")


@query(with_(MESSAGES, _CHAINS) + _STATE + " SELECT chain, highest - lowest AS gap FROM win WHERE highest - lowest > 100")
def stream_gap_alerts(spark, d):
    """What the timers said once no message came any more; each key's newest alert counts."""
    root, windows, last, fired = T.new_path(spark, "gaps"), {}, {}, {}

    def write(batch: DataFrame, n: int) -> None:
        rows = batch.persist()
        for r in rows.select("chain", "lowest", "highest", "fired").collect():  # one row for each chain, or two
            if r["fired"]:
                fired[r["chain"]] = n
            else:
                windows[r["chain"]], last[r["chain"]] = r["highest"] - r["lowest"], n
        rows.where("fired").write.mode("overwrite").parquet(f"{root}/rows/batch_id={n}")
        rows.unpersist()

    query = P.start(_window_stream(spark, d, "gaps", 1.0, 100), root, write, "update", "250 milliseconds")
    silent = lambda: bool(windows) and P.arrived(query) == 0
    try:
        P.until(query, lambda: silent() and all(fired.get(c, -1) > last[c] for c, gap in windows.items() if gap > 100))
    finally:
        query.stop()
    said = spark.read.schema(P.RESULT + ", batch_id long").parquet(f"{root}/rows")
    return said.groupBy("chain").agg(F.max_by(F.col("highest") - F.col("lowest"), "batch_id").alias("gap"))


@query(with_(MESSAGES) + "SELECT 'chain-' || CAST(user_id % 3 AS VARCHAR) AS blockchain_id, count(*) AS n, 21000 * count(*) AS gas FROM messages WHERE error_class IS NULL AND event_id % 2 = 1 GROUP BY 1")
def custom_processor(spark, d):
    """A user's processor in the stream in place of the default one: gas for each chain, a table with rows of each batch."""

    def processor(classified: DataFrame) -> dict[str, DataFrame]:
        good, _ = D.split(classified)
        return {"gas": D.transaction_rows(good).groupBy("blockchain_id").agg(F.count("*").alias("n"), F.sum("gas").cast("bigint").alias("gas"))}

    root = T.new_path(spark, "processor")
    I.start(_stream(spark, d, "processor_messages", FILES // 2), root, processor).awaitTermination()
    return I.table(spark, root, "gas").groupBy("blockchain_id").agg(F.sum("n").alias("n"), F.sum("gas").alias("gas"))


@query(with_(MESSAGES) + "SELECT partition, count(*) AS n FROM messages GROUP BY 1")
def stream_dedup(spark, d):
    """Every message delivered twice, kept once."""
    m = L.message_log(spark, d)
    stream = M.stream_files(spark, _land(m.unionAll(m), "twice_messages"))
    return _collected(P.distinct_messages(stream, "60 days").select("partition", "offset"), "dedup").groupBy("partition").agg(F.count("*").alias("n"))


@query(with_(MESSAGES) + "SELECT CAST(user_id % 3 AS BIGINT) AS chain_id, max(event_id) AS lowest, true AS exists FROM messages GROUP BY 1")
def checkpoint_roundtrip(spark, d):
    """Checkpoints written through the default store and read back."""
    from loomchain.operators.checkpoints import TableCheckpoints

    store = TableCheckpoints(spark, T.new_path(spark, "checkpoints"))
    store.initialize()
    for at, part in ((1, "event_id % 2 = 0"), (2, "true")):
        newest = L.checkpoints(spark, d).withColumn("event_id", F.col("lowest_unprocessed_block")).where(part).groupBy("chain_id").agg(F.max("lowest_unprocessed_block").alias("lowest_unprocessed_block"))
        store.write(newest, at)
    return store.read(L.checkpoints(spark, d).select("chain_id").distinct())

"""The message log: bounded and unbounded reads, and writes, through the connector or through files with the same columns.

``log_source`` has the layout of a log in files and the data source that reads it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomchain.shipping import ship
from loomchain.sources import schemas as S
from loomchain.sources.log_source import NAME, MessageLog

INDEX = "partition int, first bigint, n bigint, file string"
#: Groups to which messages whose key is no number are dealt by hash.
UNNUMBERED = 64
_PUSHED = "spark.sql.python.filterPushdown.enabled"


def connector_options(servers: str, topic: str, starting: str = "earliest", ending: str | None = None, max_per_trigger: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "true"}
    if ending is not None:
        options["endingOffsets"] = ending
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def _as_messages(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", F.col("partition").cast("int"), F.col("offset").cast("bigint"), F.col("timestamp").cast("timestamp"))


def read_connector(spark: SparkSession, options: dict[str, str], stream: bool = False) -> DataFrame:
    """Through the message broker's connector, where it is on the class path."""
    return _as_messages((spark.readStream if stream else spark.read).format("kafka").options(**options).load())


def write_connector(messages: DataFrame, servers: str, topic: str) -> None:
    messages.select("key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("kafka.acks", "all").option("kafka.enable.idempotence", "true").save()


def _index(spark: SparkSession, path: str) -> DataFrame | None:
    """The runs of a log; None if nothing was appended yet, and any other trouble is an error."""
    try:
        return spark.read.schema(f"{INDEX}, append bigint").parquet(f"{path}/index")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def ends(spark: SparkSession, path: str) -> DataFrame:
    """(partition, low, high) of a log, from its index: the first offset and the next one."""
    index = _index(spark, path)
    if index is None:
        return spark.createDataFrame([], "partition int, low bigint, high bigint")
    return index.groupBy("partition").agg(F.min("first").alias("low"), F.max(F.col("first") + F.col("n")).alias("high"))


def _partition(columns: list[str], partitions: int) -> Column:
    """A message's own partition, or the one of its key's hash; messages without a key are spread by their value."""
    if "partition" in columns:
        return F.col("partition").cast("int")
    return F.pmod(F.when(F.col("key").isNull(), F.xxhash64("value")).otherwise(F.xxhash64("key")), F.lit(partitions)).cast("int")


def write_files(messages: DataFrame, path: str, topic: str, partitions: int = 4, span: int = 10_000, rows_per_file: int = 1_000_000, moved: bool = True) -> None:
    """Appends ``messages(key, value[, partition][, timestamp])`` to a log in files.  Offsets go on behind those that the log has and follow the keys as numbers.

    Bodies move once, to the task of their partition and key range, which writes them in the order of their keys.  What is numbered is files, by
    their counts.  Other appends at the same time make this one fail before anything of it is visible.

    Unless ``moved``, each task writes its own messages, as a producer sends them: bodies stay where they are, and offsets follow the keys within a task's alone.
    """
    spark = messages.sparkSession
    number = F.col("key").try_cast("bigint")
    # Behind all ranges of numbers come those of other keys, dealt by hash, so that no range grows with them.
    other = F.pmod(F.xxhash64("key", "value"), F.lit(UNNUMBERED))
    stamp = F.col("timestamp") if "timestamp" in messages.columns else F.current_timestamp()
    range_ = F.when(number.isNull(), other).otherwise(F.floor(number / span)) if moved else F.lit(0).cast("bigint")
    placed = messages.select(
        "key", "value", F.lit(topic).alias("topic"), stamp.cast("timestamp").alias("timestamp"), _partition(messages.columns, partitions).alias("partition"), number.alias("_h"),
        range_.alias("_range"), number.isNull().cast("int").alias("_other"))
    order = ["partition", "_other", "_range"]
    data = f"{path}/data/{uuid.uuid4().hex}"
    # The hash settles ties of keys without comparing bodies.
    sorted_ = (placed.repartition(*order) if moved else placed).sortWithinPartitions(*order, "_h", "key", F.xxhash64("value"))
    sorted_.drop("_h").write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy(*order).parquet(data)
    known = _index(spark, path)
    append, high = (0, {}) if known is None else ((known.agg(F.max("append")).first()[0] or 0) + 1, {r["partition"]: r["high"] for r in ends(spark, path).collect()})
    counts = spark.read.schema("partition int, _other int, _range bigint").parquet(data).groupBy(*order, F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
    # One row for each file: pieces of one range are numbered in the order in which they were written.
    before = Window.partitionBy("partition").orderBy("_other", "_range", "file").rowsBetween(Window.unboundedPreceding, -1)
    base = F.create_map(*(F.lit(x) for p, n in high.items() for x in (p, n))) if high else None
    first = F.coalesce(F.sum("n").over(before), F.lit(0)) + (F.coalesce(base[F.col("partition")], F.lit(0)) if base is not None else F.lit(0))
    runs = counts.select("partition", first.cast("bigint").alias("first"), "n", "file")
    # The folder of an append exists once: of two at the same time one fails.
    runs.coalesce(1).write.mode("errorifexists").parquet(f"{path}/index/append={append}")


def _source(spark: SparkSession, path: str, stream: bool, columns: list[str] | None, options: dict[str, str]) -> DataFrame:
    ship(spark)
    spark.dataSource.register(MessageLog)
    own = {"path": path, "pushFilters": spark.conf.get(_PUSHED, "false"), **options}
    if columns:
        own["columns"] = ",".join(columns)
    return (spark.readStream if stream else spark.read).format(NAME).options(**own).load()


def _offsets(offsets: dict[int, int] | str) -> str:
    return offsets if isinstance(offsets, str) else json.dumps({str(p): o for p, o in offsets.items()})


def read_files(spark: SparkSession, path: str, starting: dict[int, int] | str = "earliest", ending: dict[int, int] | str = "latest", columns: list[str] | None = None, split_rows: int | None = None) -> DataFrame:
    """Messages of a log in files, of all partitions or between offsets; only the files that hold these are opened.

    With spark.sql.python.filterPushdown.enabled, filters on offset and partition narrow what is read as well.
    """
    options = {} if split_rows is None else {"splitRows": str(split_rows)}
    named = {k: _offsets(v) for k, v in (("startingOffsets", starting), ("endingOffsets", ending)) if v not in ("earliest", "latest") or (k, v) in (("startingOffsets", "latest"), ("endingOffsets", "earliest"))}
    return _source(spark, path, False, columns, {**options, **named})


def stream_log(spark: SparkSession, path: str, starting: dict[int, int] | str = "earliest", max_per_trigger: int | None = None, admitted: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """A log in files as a stream, from ``starting`` on; a query that starts again goes on from its checkpoint.

    ``admitted`` is a folder beside that checkpoint; it keeps ``max_per_trigger`` for a query's first batch after a restart.
    """
    options = {"startingOffsets": _offsets(starting)}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if admitted is not None:
        options["admitted"] = admitted
    return _source(spark, path, True, columns, options)


def stream_files(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A directory of message files as a stream; new files are new messages."""
    return spark.readStream.schema(S.MESSAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def scan(log: DataFrame | str, bounds: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Messages from ``low`` to before ``high`` of each partition in ``bounds(partition, low, high)``; the height is the key as a number, NULL if it is none.

    Of a log in files, given by its path, the bounds (one row for each partition of a topic) are planned and nothing else is read.
    """
    if isinstance(log, str):
        held = {r["partition"]: (r["low"], r["high"]) for r in bounds.collect()}
        spark = bounds.sparkSession
        # Partitions without bounds are read nowhere.
        low = {r["partition"]: r["high"] for r in ends(spark, log).collect()} | {p: b[0] for p, b in held.items()}
        inside = read_files(spark, log, low, {p: b[1] for p, b in held.items()}, columns)
    else:
        inside = log.join(F.broadcast(bounds), "partition").where((F.col("offset") >= F.col("low")) & (F.col("offset") < F.col("high"))).drop("low", "high")
    return inside.withColumn("height", F.col("key").try_cast("bigint"))

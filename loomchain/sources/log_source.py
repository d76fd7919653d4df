"""The message log in files as a Spark data source, for batches and streams.

A log is a folder.  ``data`` has the messages, in files that each hold one run of a partition's offsets in their order; a file's rows have no
offsets of their own.  ``index`` says where each run begins: (partition, first, n, file), one small table for each append.  A reader sees what
the index lists, so that an append appears as a whole, and the log's ends are known from the index alone.

Planning takes the runs that the wanted offsets touch, cuts long ones at ``splitRows`` and puts short ones together, so that tasks get about
equal shares.  A task opens the files of its share and of these the row groups that it needs.

Options: ``path``; ``startingOffsets`` and ``endingOffsets`` ("earliest", "latest", or JSON from partition to offset; the end is exclusive, and a partition
that is not named starts at its first and ends at its last message); ``columns``; ``splitRows``; ``pushFilters``; for streams ``maxOffsetsPerTrigger`` and
``admitted``, a folder in which the source keeps how far batches have been planned, so that a restarted stream keeps to its limit at once.

Null keys and values are read as they are.  A log without appends has no rows.  Starting offsets behind the end give none.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from loomchain.sources import schemas as S

NAME = "message_log"
#: Messages that one task reads, about.
SPLIT_ROWS = 200_000
_ARROW = {"key": pa.string(), "value": pa.string(), "topic": pa.string(), "partition": pa.int32(), "offset": pa.int64(), "timestamp": pa.timestamp("us", "UTC")}


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def files_below(path: str) -> list[str]:
    """Parquet files below a folder, none if it does not exist."""
    fs, at = opened(path)
    found = fs.get_file_info(pyarrow.fs.FileSelector(at, allow_not_found=True, recursive=True))
    return sorted(f.path for f in found if f.is_file and f.base_name.endswith(".parquet"))


class Run:
    """A file's messages: offsets ``first`` to before ``first + n`` of a partition."""

    def __init__(self, partition: int, first: int, n: int, file: str):
        self.partition, self.first, self.n, self.file = partition, first, n, file


class Index:
    """The runs of a log.  Files of the index never change, so that each is read once."""

    def __init__(self, path: str):
        self.path, self.known, self.runs = path, set(), []

    def refresh(self) -> Index:
        fs, _ = opened(self.path)
        for file in files_below(f"{self.path}/index"):
            if file not in self.known:
                with fs.open_input_file(file) as f:
                    rows = pq.ParquetFile(f).read().to_pylist()
                self.runs += [Run(r["partition"], r["first"], r["n"], r["file"]) for r in rows]
                self.known.add(file)
        return self

    def bounds(self) -> dict[int, tuple[int, int]]:
        """First and next offset of each partition."""
        out: dict[int, tuple[int, int]] = {}
        for r in self.runs:
            low, high = out.get(r.partition, (r.first, r.first))
            out[r.partition] = min(low, r.first), max(high, r.first + r.n)
        return out

    def offsets(self, wanted: str) -> dict[int, int]:
        """Of each partition the offset that ``wanted`` names."""
        bounds = self.bounds()
        if wanted in ("earliest", "latest"):
            return {p: b[wanted == "latest"] for p, b in bounds.items()}
        return {int(p): int(o) for p, o in json.loads(wanted).items()}


class Share(InputPartition):
    """One task's pieces: (file, partition, first offset of the file, rows to pass over, rows to take)."""

    def __init__(self, pieces: list[tuple[str, int, int, int, int]]):
        super().__init__(len(pieces))
        self.pieces = pieces


def plan(runs: list[Run], low: dict[int, int], high: dict[int, int], split: int, partitions: set[int] | None = None) -> list[Share]:
    """Shares of about ``split`` messages from ``low`` to before ``high``."""
    shares: list[Share] = []
    held: list[tuple] = []
    size = 0
    for r in sorted(runs, key=lambda r: (r.partition, r.first)):
        if partitions is not None and r.partition not in partitions:
            continue
        a, z = max(r.first, low.get(r.partition, r.first)), min(r.first + r.n, high.get(r.partition, r.first + r.n))
        while a < z:
            take = min(z - a, split - size)
            held.append((r.file, r.partition, r.first, a - r.first, take))
            a, size = a + take, size + take
            if size == split:
                shares.append(Share(held))
                held, size = [], 0
    return shares + ([Share(held)] if held else [])


def read_pieces(share: Share, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    stored = [c for c in columns if c not in ("partition", "offset")]
    for file, partition, first, skip, take in share.pieces:
        fs, at = opened(file)
        with fs.open_input_file(at) as f:
            held, row = pq.ParquetFile(f), 0
            for group in range(held.num_row_groups):
                n = held.metadata.row_group(group).num_rows
                a, z = max(skip, row), min(skip + take, row + n)
                if a < z:
                    # Whole row groups are passed over; within one, rows before the first wanted one are cut off.
                    whole = held.read_row_group(group, columns=stored).slice(a - row, z - a) if stored else None
                    own = {"partition": pa.array([partition] * (z - a), pa.int32()), "offset": pa.array(range(first + a, first + z), pa.int64())}
                    yield from pa.table({c: own[c] if c in own else whole[c].cast(_ARROW[c]) for c in columns}).to_batches(max_chunksize=10_000)
                row += n


class _Reader:
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.columns, self.split = options["path"], columns, int(options.get("splitRows", SPLIT_ROWS))
        self.starting, self.ending = options.get("startingOffsets"), options.get("endingOffsets")

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return read_pieces(partition, self.columns)


class LogReader(_Reader, DataSourceReader):
    def partitions(self) -> list[Share]:
        return self.planned()

    def planned(self, least: int | None = None, most: int | None = None, wanted: set[int] | None = None) -> list[Share]:
        index = Index(self.path).refresh()
        ends = index.bounds()
        low = {p: b[0] for p, b in ends.items()} | (index.offsets(self.starting) if self.starting else {})
        high = {p: b[1] for p, b in ends.items()} | (index.offsets(self.ending) if self.ending else {})
        if least is not None:
            low = {p: max(o, least) for p, o in low.items()}
        if most is not None:
            high = {p: min(o, most + 1) for p, o in high.items()}
        # At least one share: a source without any has no tasks, which not every plan takes.
        return plan(index.runs, low, high, self.split, wanted) or [Share([])]


class PushingReader(LogReader):
    """Takes over comparisons of offset and partition with constants, and leaves the other filters to Spark."""

    def __init__(self, options: dict, columns: list[str]):
        super().__init__(options, columns)
        self.least, self.most, self.wanted = None, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self._taken(f):
                yield f

    def _taken(self, f: Filter) -> bool:
        column = getattr(f, "attribute", ())
        if column == ("offset",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.least = max(f.value + isinstance(f, GreaterThan), self.least if self.least is not None else 0)
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                most = f.value - isinstance(f, LessThan)
                self.most = most if self.most is None else min(most, self.most)
            return True
        if column == ("partition",) and isinstance(f, (EqualTo, In)):
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted = values if self.wanted is None else self.wanted & values
            return True
        return False

    def partitions(self) -> list[Share]:
        return self.planned(self.least, self.most, self.wanted)


class LogStream(_Reader, DataSourceStreamReader):
    """Offsets are the next one of each partition.  A batch goes on from the last one planned, by ``maxOffsetsPerTrigger`` messages at most."""

    def __init__(self, options: dict, columns: list[str]):
        super().__init__(options, columns)
        self.most, self.admitted = int(options.get("maxOffsetsPerTrigger", 0)), options.get("admitted")
        self.index, self.at = Index(self.path), None

    def _begin(self) -> dict[int, int]:
        bounds = self.index.refresh().bounds()
        return {p: b[0] for p, b in bounds.items()} | (self.index.offsets(self.starting) if self.starting else {})

    def initialOffset(self) -> dict:
        return {str(p): o for p, o in self._begin().items()}

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self._planned() or self._begin()
        ends = {p: b[1] for p, b in self.index.refresh().bounds().items()}
        return {str(p): o for p, o in admitted(self.at, ends, self.most).items()}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        low, high = ({int(p): int(o) for p, o in x.items()} for x in (start, end))
        self.at = high
        if self.admitted:
            fs, at = opened(self.admitted)
            fs.create_dir(at, recursive=True)
            with fs.open_output_stream(f"{at}/.next") as f:
                f.write(json.dumps(end).encode())
            fs.move(f"{at}/.next", f"{at}/planned.json")
        return plan(self.index.refresh().runs, low, {**{r.partition: 0 for r in self.index.runs}, **high}, self.split) or [Share([])]

    def _planned(self) -> dict[int, int] | None:
        if self.admitted:
            fs, at = opened(self.admitted)
            if fs.get_file_info(f"{at}/planned.json").is_file:
                with fs.open_input_file(f"{at}/planned.json") as f:
                    return {int(p): int(o) for p, o in json.loads(f.read()).items()}
        return None

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def admitted(at: dict[int, int], ends: dict[int, int], most: int) -> dict[int, int]:
    """How far the next batch goes: to the ends, or ``most`` messages further, shared among partitions by what they have."""
    open_ = {p: max(0, end - at.get(p, 0)) for p, end in ends.items()}
    total = sum(open_.values())
    if not most or total <= most:
        return {**at, **{p: at.get(p, 0) + n for p, n in open_.items()}}
    share = {p: n * most // total for p, n in open_.items()}
    left = most - sum(share.values())
    # What rounding leaves goes to the partitions with the most to read.
    for p in sorted(open_, key=lambda p: (share[p] - open_[p], p))[:left]:
        share[p] += 1
    return {**at, **{p: at.get(p, 0) + n for p, n in share.items()}}


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        # A name and a type each; there is no session where this runs.
        fields = S.MESSAGES.split(", ")
        wanted = self.options.get("columns")
        return ", ".join(f for f in fields if not wanted or f.split()[0] in wanted.split(","))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        kind = PushingReader if self.options.get("pushFilters", "false") == "true" else LogReader
        return kind(self.options, schema.names)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return LogStream(self.options, schema.names)

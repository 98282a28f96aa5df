"""The change log as a source of Spark's own: offsets are log positions.

The log lies in Parquet files whose rows carry a position. The driver reads file footers
only: each row group's lowest and highest position and its number of rows. From these it says how far
a batch goes and which row groups hold rows of a range of positions; tasks read those.
A range ends behind a position, so rows that share one are never parted.

Positions compare without sign. Rows without a position are no part of the log.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

NAME = "change_log"
UNSIGNED = (1 << 64) - 1
#: behind every position
END = 1 << 64


@dataclass(frozen=True)
class RowGroup:
    """A part of a file, and the positions of its rows."""

    file: str
    number: int
    rows: int
    low: int
    high: int


class Range(InputPartition):
    """Rows of one row group with ``start <= position < end``."""

    def __init__(self, file: str, group: int, start: int, end: int):
        self.file, self.group, self.start, self.end = file, group, start, end


class LogFiles:
    """Footers of the files below a path; a file is looked at once."""

    def __init__(self, path: str, position: str):
        self.fs, self.root = _filesystem(path)
        self.position = position
        self.seen: dict[str, list[RowGroup]] = {}

    def groups(self) -> list[RowGroup]:
        for info in self.fs.get_file_info(fs.FileSelector(self.root, recursive=True)):
            hidden = any(part.startswith(("_", ".")) for part in info.path[len(self.root) :].split("/"))
            if info.is_file and info.path.endswith(".parquet") and not hidden and info.path not in self.seen:
                self.seen[info.path] = self._footer(info.path)
        return [g for groups in self.seen.values() for g in groups]

    def _footer(self, path: str) -> list[RowGroup]:
        with self.fs.open_input_file(path) as source:
            file = pq.ParquetFile(source)
            meta, out = file.metadata, []
            column = next(i for i in range(meta.num_columns) if meta.schema.column(i).path == self.position)
            for n in range(meta.num_row_groups):
                group = meta.row_group(n)
                stats = group.column(column).statistics
                known = stats is not None and stats.has_min_max
                if known and not stats.min < 0 <= stats.max:
                    low, high = stats.min & UNSIGNED, stats.max & UNSIGNED
                else:
                    # no statistics, or the row group in which positions get their highest bit: its one column tells
                    values = file.read_row_group(n, [self.position]).column(0).drop_null().to_numpy()
                    if not len(values):
                        continue
                    places = values.astype(np.int64).view(np.uint64)
                    low, high = int(places.min()), int(places.max())
                out.append(RowGroup(path, n, group.num_rows, low, high))
            return out


def _filesystem(path: str):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def batch_end(groups: list[RowGroup], start: int, rows: int | None, stop: int) -> int:
    """Where a batch from ``start`` ends: behind the row group with which it has ``rows`` rows, or at ``stop``."""
    ahead = sorted((g for g in groups if g.high >= start and g.low < stop), key=lambda g: (g.high, g.low))
    if not ahead:
        return start
    if rows is None:
        return min(ahead[-1].high + 1, stop)
    total = 0
    for g in ahead:
        total += g.rows
        if total >= rows:
            return min(g.high + 1, stop)
    return min(ahead[-1].high + 1, stop)


def saved_offset(checkpoint: str) -> int | None:
    """The position up to which batches were planned, as a stream's checkpoint tells it."""
    files, root = _filesystem(checkpoint)
    folder = f"{root}/offsets"
    if files.get_file_info(folder).type != fs.FileType.Directory:
        return None
    names = [i.base_name for i in files.get_file_info(fs.FileSelector(folder)) if i.base_name.isdigit()]
    if not names:
        return None
    with files.open_input_stream(f"{folder}/{max(names, key=int)}") as file:
        lines = file.read().decode().splitlines()
    found = [json.loads(line) for line in lines if line.startswith("{")]
    return next((int(o["position"]) for o in reversed(found) if "position" in o), None)


class _Reader:
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.position = options.get("position", "lsn")
        self.path = options["path"]
        self.schema = to_arrow_schema(schema)
        after, stop = options.get("after"), options.get("stop")
        #: the first position, and the one behind the last
        self.first = 0 if after is None else (int(after) & UNSIGNED) + 1
        self.stop_at = END if stop is None else (int(stop) & UNSIGNED) + 1
        self.rows = int(options["rowsperbatch"]) if options.get("rowsperbatch") else None
        self.checkpoint = options.get("checkpoint")
        self._files = None

    def files(self) -> LogFiles:
        if self._files is None:
            self._files = LogFiles(self.path, self.position)
        return self._files

    def ranges(self, start: int, end: int) -> list[Range]:
        return [Range(g.file, g.number, start, end) for g in self.files().groups() if g.high >= start and g.low < end]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(self.path)
        with filesystem.open_input_file(partition.file) as source:
            file = pq.ParquetFile(source)
            for batch in file.iter_batches(row_groups=[partition.group], columns=self.schema.names):
                at = batch.column(batch.schema.get_field_index(self.position))
                place = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                mine = (place >= partition.start) & at.is_valid().to_numpy(zero_copy_only=False)
                if partition.end < END:
                    mine &= place < np.uint64(partition.end)
                kept = batch.filter(pa.array(mine))
                if kept.num_rows:
                    columns = [kept.column(kept.schema.get_field_index(f.name)).cast(f.type) for f in self.schema]
                    yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


class LogReader(_Reader, DataSourceReader):
    """The log, or a range of it, as a table."""

    def partitions(self):
        return self.ranges(self.first, self.stop_at)


class LogStreamReader(_Reader, DataSourceStreamReader):
    """The log as a stream. A batch has about ``rowsPerBatch`` rows.

    A stream that goes on finds its place in its checkpoint, whose folder it is told, as
    Spark names it only when a batch is planned.
    """

    def __init__(self, options, schema):
        super().__init__(options, schema)
        self.planned = None

    def initialOffset(self) -> dict:
        return {"position": str(self.first)}

    def latestOffset(self) -> dict:
        if self.planned is None:
            saved = saved_offset(self.checkpoint) if self.checkpoint else None
            self.planned = self.first if saved is None else saved
        start = self.planned
        return {"position": str(max(start, batch_end(self.files().groups(), start, self.rows, self.stop_at)))}

    def partitions(self, start: dict, end: dict):
        return self.ranges(int(start["position"]), int(end["position"]))

    def commit(self, end: dict) -> None:
        self.planned = max(self.planned or 0, int(end["position"]))


class ChangeLog(DataSource):
    """Options: ``path``; ``position`` (column, ``lsn``); ``after`` and ``stop`` (positions, the first
    left out, the second kept); ``rowsPerBatch`` and ``checkpoint`` for streams."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: T.StructType) -> LogReader:
        return LogReader(self.options, schema)

    def streamReader(self, schema: T.StructType) -> LogStreamReader:
        return LogStreamReader(self.options, schema)


def read_log(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """A range of the log as a table."""
    return _load(spark, spark.read, path, schema, options)


def stream_log(
    spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, rows_per_batch: int | None = None, **options
) -> DataFrame:
    """The log as a stream, to be written with the same ``checkpoint``."""
    given = {"checkpoint": checkpoint, "rowsPerBatch": rows_per_batch, **options}
    return _load(spark, spark.readStream, path, schema, given)


def _load(spark: SparkSession, reader, path: str, schema: T.StructType, options: dict) -> DataFrame:
    spark.dataSource.register(ChangeLog)
    given = {k: str(v) for k, v in options.items() if v is not None}
    return reader.format(NAME).schema(schema).options(path=path, **given).load()

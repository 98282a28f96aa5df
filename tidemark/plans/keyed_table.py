"""A keyed table kept as a base plus one folder of folded changes per batch.

A batch writes only what it changed, into a folder named by its stream and number, so
writing it twice gives the same table. It counts once it is in the manifest, which is
written last. Batch numbers are told apart by stream, as each new checkpoint counts
from 0. Reading folds the base and the batches finished after it; ``compact`` writes a new
base. Nothing is overwritten that a reader may be reading.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.operators.merge import fold_changes, from_folded, merge_folded

#: ``max_lsn`` of a base is the position its snapshot was taken at; ``columns`` the table's as of then
MANIFEST = (
    "kind string, batch long, folder string, version long, "
    "rows_in long, rows_out long, max_lsn long, stream string, covers long, columns string"
)
#: columns of a change that are none of the table's
CHANGE_COLUMNS = ("op", "_unchanged")
WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def ddl(shape: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shape)


def wider_type(old: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds the values of both exactly; an error if none does."""
    if old == new:
        return old
    if old in WHOLE and new in WHOLE:
        return max(old, new, key=WHOLE.index)
    small = {T.ByteType(), T.ShortType(), T.IntegerType(), T.FloatType()}
    for a, b in ((old, new), (new, old)):
        if isinstance(b, T.DoubleType) and a in small:
            return b
        if isinstance(b, T.FloatType) and a in (T.ByteType(), T.ShortType()):
            return b
        if isinstance(b, T.TimestampType) and isinstance(a, T.DateType):
            return b
    if all(isinstance(t, T.DecimalType) or t in WHOLE for t in (old, new)):
        scale = max(getattr(t, "scale", 0) for t in (old, new))
        digits = max(DIGITS.get(t) or t.precision - t.scale for t in (old, new))
        if digits + scale <= 38:
            return T.DecimalType(digits + scale, scale)
    raise ValueError(f"no type holds both {old.simpleString()} and {new.simpleString()}")


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` with the new columns of ``new`` added and shared ones made wide enough. No column goes."""
    types = {f.name: f.dataType for f in old}
    for f in new:
        types[f.name] = wider_type(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def fitted(rows: DataFrame, shape: T.StructType, more: list[str]) -> DataFrame:
    """``rows`` with the columns of ``shape``: wider types, null where a column was not there yet."""
    has = set(rows.columns)
    return rows.select(
        *[(F.col(f.name).cast(f.dataType) if f.name in has else F.lit(None).cast(f.dataType)).alias(f.name) for f in shape], *more
    )


def stream_name(stream: str) -> str:
    """A stream's name as part of a folder name."""
    return hashlib.sha256(stream.encode()).hexdigest()[:16]


@dataclass(frozen=True)
class KeyedTable:
    """Where a table lives and what its rows look like.

    ``schema`` is DDL for keys and columns; ``large`` lists the columns that changes may
    mark as unchanged. A table that ``evolves`` takes on columns that changes bring along and
    widens types where they need it; what was written before is read as the table is now.
    Columns that changes no longer have stay, and are null in new rows.
    """

    path: str
    schema: str
    keys: tuple[str, ...]
    large: tuple[str, ...] = ()
    seq: str = "seq"
    evolves: bool = False

    def shape(self, spark: SparkSession) -> T.StructType:
        """The table's columns and types as of its last batch."""
        shape = T.StructType.fromDDL(self.schema)
        if self.evolves:
            rows = self.manifest(spark).filter("columns IS NOT NULL").orderBy("version").select("columns").collect()
            for columns in dict.fromkeys(r[0] for r in rows):  # one per version of the columns
                shape = widened(shape, T.StructType.fromDDL(columns))
        return shape

    def names(self, spark: SparkSession) -> list[str]:
        return self.shape(spark).names

    def columns(self, spark: SparkSession) -> list[str]:
        return [c for c in self.names(spark) if c not in self.keys]

    def manifest(self, spark: SparkSession) -> DataFrame:
        """Finished batches and bases; also the record of progress."""
        try:
            return spark.read.schema(MANIFEST).json(f"{self.path}/manifest")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return spark.createDataFrame([], MANIFEST)

    def last_batch(self, spark: SparkSession, stream: str = "") -> int | None:
        """The last batch of a stream that is part of the table."""
        own = self.manifest(spark).filter(F.coalesce("stream", F.lit("")) == stream)
        return own.filter("kind = 'delta'").agg(F.max("batch")).first()[0]

    def _version(self, spark: SparkSession) -> int:
        """Version of the last manifest row."""
        return self.manifest(spark).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def write_batch(
        self,
        changes: DataFrame,
        batch: int,
        rows_in: int | None = None,
        max_lsn: int | None = None,
        stream: str = "",
        emptied: bool = False,
    ) -> None:
        """Fold the changes of a batch and add them, unless the table has this batch of this stream.

        With ``emptied`` the table holds nothing but these changes from then on.
        """
        spark = changes.sparkSession
        last = self.last_batch(spark, stream)
        if last is not None and batch <= last:
            return
        covers = self._version(spark) if emptied else None
        shape = self.shape(spark)
        if self.evolves:
            own = T.StructType([f for f in changes.schema if f.name not in (*CHANGE_COLUMNS, self.seq)])
            shape = widened(shape, own)
            changes = fitted(changes, shape, [self.seq, *CHANGE_COLUMNS])
        columns = [c for c in shape.names if c not in self.keys]
        folded = fold_changes(changes, list(self.keys), columns, self.seq, list(self.large))
        folder = f"{stream_name(stream)}-{batch}"
        folded.write.mode("overwrite").parquet(f"{self.path}/delta/{folder}")
        rows_out = spark.read.parquet(f"{self.path}/delta/{folder}").count()
        self._finish(spark, ("delta", batch, folder, rows_in, rows_out, max_lsn, stream, covers, ddl(shape)))

    def _finish(self, spark: SparkSession, entry: tuple) -> None:
        kind, batch, folder, *rest = entry
        row = [(kind, batch, folder, max(time.time_ns(), self._version(spark) + 1), *rest)]
        spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").json(
            f"{self.path}/manifest"
        )

    def _state(self, spark: SparkSession) -> tuple[tuple | None, dict[str | None, list[str]]]:
        """Folder and columns of the base; folders of the batches since, by their columns.

        There is a row for each batch since ``compact``.
        """
        rows = self.manifest(spark).filter("kind in ('base', 'delta')")
        start = rows.filter("covers is not null").agg(
            F.max("covers").alias("covers"), F.max_by(F.struct("kind", "folder", "columns"), "version").alias("at")
        ).first()
        since = rows.filter("kind = 'delta'")
        if start.covers is not None:
            since = since.filter(F.col("version") > start.covers)
        base = (start.at.folder, start.at.columns) if start.at is not None and start.at.kind == "base" else None
        folders: dict[str | None, list[str]] = {}
        for folder, columns in sorted(since.groupBy("folder").agg(F.max_by("columns", "version")).collect()):
            folders.setdefault(columns, []).append(folder)
        return base, folders

    def _deltas(self, spark: SparkSession, folders: dict[str | None, list[str]], shape: T.StructType) -> DataFrame:
        """The folded batches; each is read with the columns it was written with."""
        parts = []
        for columns, some in folders.items():
            schema = f"{columns or self.schema}, op string, `{self.seq}` long, _unchanged array<string>"
            rows = spark.read.schema(schema).parquet(*[f"{self.path}/delta/{f}" for f in some])
            parts.append(fitted(rows, shape, ["op", self.seq, "_unchanged"]))
        return reduce(DataFrame.unionByName, parts)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of its last finished batch."""
        base, folders = self._state(spark)
        shape, keys = self.shape(spark), list(self.keys)
        columns = [c for c in shape.names if c not in keys]
        old = None
        if base is not None:
            folder, written = base
            old = fitted(spark.read.schema(written or self.schema).parquet(f"{self.path}/base/{folder}"), shape, [])
        if not folders:
            return spark.createDataFrame([], shape) if old is None else old
        folded = fold_changes(
            self._deltas(spark, folders, shape), keys, columns, self.seq, list(self.large)
        )
        if old is None:
            return from_folded(folded, keys, columns)
        return merge_folded(old, folded, keys, columns)

    def begin_snapshot(self, spark: SparkSession) -> None:
        """Note that a snapshot was begun; it is complete once ``replace`` has run."""
        self._finish(spark, ("snapshot", *[None] * 8))

    def snapshot_lsn(self, spark: SparkSession) -> int | None:
        """The position of the snapshot that the table holds; changes up to it are part of it."""
        return self.manifest(spark).agg(F.max_by("max_lsn", F.when(F.col("kind") == "base", F.col("version")))).first()[0]

    def snapshot_state(self, spark: SparkSession) -> str:
        """``none``, ``unfinished`` or ``finished``: what an earlier run left behind."""
        begun = F.col("kind").isin("snapshot", "base")
        row = self.manifest(spark).agg(
            F.count(F.lit(1)).alias("entries"),
            F.max_by("kind", F.when(begun, F.col("version"))).alias("last"),
        ).first()
        if not row.entries:
            return "none"
        return "unfinished" if row.last == "snapshot" else "finished"

    def compact(self, spark: SparkSession) -> None:
        """Write the whole table as a new base; later reads start from it."""
        covers = self._version(spark)  # before the read, so a batch that ends meanwhile stays
        self.replace(self.read(spark), covers, self.snapshot_lsn(spark))

    def replace(self, rows: DataFrame, covers: int | None = None, lsn: int | None = None) -> None:
        """Make ``rows`` the whole table as of the last batch, e.g. a fresh snapshot taken at ``lsn``."""
        spark = rows.sparkSession
        covers = self._version(spark) if covers is None else covers
        folder = f"upto={covers}-{uuid.uuid4().hex}"
        shape = self.shape(spark)
        if self.evolves:
            shape = widened(shape, rows.schema)
            rows = fitted(rows, shape, [])
        rows.select(*shape.names).write.parquet(f"{self.path}/base/{folder}")
        self._finish(spark, ("base", None, folder, None, None, lsn, None, covers, ddl(shape)))

"""Starting and stopping at a log position.

``seq`` numbers the rows of the log in order; positions repeat (a BEGIN shares its
first change's) and compare without sign, so order is taken from ``seq`` only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import lsn as L


def resume_from(log: DataFrame, start: int | None, seq: str = "seq", lsn: str = "lsn") -> DataFrame:
    """Rows from the first occurrence of ``start``; all without one, none if never seen."""
    if start is None:
        return log
    first = log.filter(F.col(lsn) == F.lit(start)).agg(F.min(seq)).scalar()
    return log.filter(F.col(seq) >= first)


def stop_at(log: DataFrame, stop: int | None, seq: str = "seq", lsn: str = "lsn") -> DataFrame:
    """Rows up to and with the first that reaches ``stop``."""
    if stop is None:
        return log
    reached = L.rank(F.col(lsn)) >= L.rank(F.lit(stop).cast("long"))
    last = log.filter(reached).agg(F.min(seq)).scalar()
    return log.filter(F.coalesce(F.col(seq) <= last, F.lit(True)))


def resume_point(
    log: DataFrame,
    last_commit: int | None,
    last_event: int | None,
    seq: str = "seq",
    lsn: str = "lsn",
) -> DataFrame:
    """One row ``resume_lsn``: where to go on after a saved commit and event position.

    Without a saved commit it is the first position. Otherwise it is what comes first:
    the row behind the saved event, or a commit past the saved one, which leads back to
    the latest BEGIN before it (or the first row). Null if neither is in the log.
    Each step is an aggregate over two or three columns.
    """
    at, pos = F.col(seq), F.col(lsn)
    first = F.min_by(pos, at)
    if last_commit is None:
        return log.agg(first.alias("resume_lsn"))
    event = F.lit(last_event).cast("long")
    seen = log.filter(pos == event).agg(F.min(seq)).scalar()
    behind = log.filter((at > seen) & (pos != event)).agg(F.min(seq)).scalar()
    # behind the saved event the row after it decides, so only commits up to it count
    later = L.rank(pos) > L.rank(F.lit(last_commit).cast("long"))
    commit = (
        log.filter((F.col("op") == "commit") & later & F.coalesce(at <= seen, F.lit(True)))
        .agg(F.min(seq))
        .scalar()
    )
    begin = F.max_by(pos, F.when((F.col("op") == "begin") & (at <= commit), at))
    after_event = F.min_by(pos, F.when(at == behind, at))
    return log.agg(
        F.when(commit.isNotNull(), F.coalesce(begin, first))
        .when(behind.isNotNull(), after_event)
        .alias("resume_lsn")
    )


def keep_after(log: DataFrame, position: int, lsn: str = "lsn") -> DataFrame:
    """Rows whose position is behind ``position``, compared without sign."""
    return log.filter(L.rank(F.col(lsn)) > L.rank(F.lit(position).cast("long")))

"""Conversations: planned damage, and the cheapest repair of their role structure."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import arrow_map, stored
from tidemark.llm.mixing import SPACE
from tidemark.llm.role_grammar import MACHINE, Repair, edited_roles, finished, joined
from tidemark.plans.order import slice_count

#: Order of rows in a conversation. Rows of one turn go by role and digest of the text.
ORDER = ["conv_id", "timed", "turn", "role", "digest"]
#: Rows in an Arrow batch that goes back.
OUT_ROWS = 4096


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after planned damage, by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes out its full stops, exclamation and question
    marks, 3 repeats it (``copies`` 2), 4 makes the user its speaker. A null id or turn
    counts as one space in the key; a null role or text becomes one space.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    return conversations.filter(fate != 0).select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
        F.when(fate == 3, 2).otherwise(1).alias("copies"),
    )


def _timed() -> Column:
    return F.col("turn").isNotNull().alias("timed")


def facts(rows: DataFrame) -> DataFrame:
    """What the repair needs to know of a row, without its text."""
    text = F.col("text")
    return rows.select(
        "conv_id", _timed(), "turn", "role", F.unhex(F.sha2(text, 256)).alias("digest"), "copies",
        (~text.rlike(f"[^{SPACE}]")).alias("blank"),
        (~text.rlike(f"[.!?][{SPACE}]*\\z")).alias("truncated"),
    )


def with_repeats(rows: DataFrame) -> DataFrame:
    """Add ``repeated``: the same role and text have an earlier turn in the conversation.

    Within one turn equal rows are neighbours, which is seen when they are read in order.
    Only texts that occur more than once are joined, each by its first turn.
    """
    keys = ["conv_id", "role", "digest"]
    first = rows.groupBy(*keys).agg(F.min(F.struct("timed", "turn")).alias("first"), F.max(F.struct("timed", "turn")).alias("last"))
    several = first.filter(~F.col("first").eqNullSafe(F.col("last"))).select(*[F.col(k).alias(f"_{k}") for k in keys], "first")
    same = (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest")) & F.col("conv_id").eqNullSafe(F.col("_conv_id"))
    later = F.col("first").isNotNull() & ~F.struct("timed", "turn").eqNullSafe(F.col("first"))
    return rows.join(several, same, "left").select(*rows.columns, later.alias("repeated"))


PART = (
    "kind int, timed boolean, turn long, role string, digest binary, blank long, duplicate long, truncated long, illegal long, "
    "first_role string, last_role string, first_turn long, last_turn long, turns long, "
    "paths array<struct<start: int, stop: int, cost: long, audit: string>>"
)
LEGAL = {"su", "ua", "au"}


def _initial(role: str) -> str:
    return role[:1]


def _parts(schema: pa.Schema):
    """Per conversation and task: counts, border values, and the cheapest path between any two tops.

    Only a task's first conversation may have begun in another task, so only that one is
    followed from every top.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, fresh = [], None, False
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                conv, timed, turn, role, digest, copies, blank, truncated, repeated = row
                if now is None or now["conv_id"] != conv:
                    if now is not None:
                        out.append(_closed(now))
                        fresh = True
                        if len(out) >= OUT_ROWS:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out = []
                    now = dict(
                        conv_id=conv, kind=0, timed=timed, turn=turn, role=role, digest=digest, blank=0, duplicate=0, truncated=0, illegal=0,
                        first_role=_initial(role), last_role=None, first_turn=None, last_turn=None, turns=0, before=None,
                        parses=[Repair(s) for s in ([0] if fresh else range(MACHINE.tops))],
                    )
                initial = _initial(role)
                for _ in range(copies):
                    again = now["before"] == (turn, role, digest)
                    now["before"] = (turn, role, digest)
                    duplicate = not blank and (repeated or again)
                    now["blank"] += blank
                    now["duplicate"] += duplicate
                    late = truncated and not blank and not duplicate
                    now["truncated"] += late
                    if now["last_role"] is not None:
                        now["illegal"] += now["last_role"] + initial not in LEGAL
                    now["last_role"] = initial
                    for parse in now["parses"]:
                        parse.add(initial, blank or duplicate, late)
                if turn is not None and turn != now["last_turn"]:
                    now["turns"] += 1
                    now["first_turn"] = turn if now["first_turn"] is None else now["first_turn"]
                    now["last_turn"] = turn
        if now is not None:
            out.append(_closed(now))
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _closed(now: dict) -> dict:
    parses = now.pop("parses")
    now.pop("before")
    now["paths"] = [{"start": p.start, "stop": t, "cost": c, "audit": a} for p in parses for t, c, a in p.paths()]
    return now


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


class Conversation:
    """The parts of a conversation, joined in order, then its rows one by one."""

    def __init__(self, conv_id):
        self.conv_id, self.tops = conv_id, {0: (0, "")}
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.last_role = None
        self.edits = None

    def add(self, part: dict) -> None:
        if not part["paths"]:
            return
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + part[name])
        if self.last_role is not None:
            self.illegal += self.last_role + part["first_role"] not in LEGAL
        self.last_role = part["last_role"]
        if part["first_turn"] is not None:
            self.turns -= part["first_turn"] == self.last_turn
            self.first_turn = part["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = part["last_turn"]
        self.tops = joined(self.tops, [(p["start"], p["stop"], p["cost"], p["audit"]) for p in part["paths"]])

    def settle(self) -> None:
        self.cost, self.audit = finished(self.tops)
        self.own = []  # the role of the row that is next
        self.edits = edited_roles(self.audit, iter(self.own.pop, None))

    def report(self) -> dict:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return dict(conv_id=self.conv_id, gaps=gaps, blank=self.blank, duplicate=self.duplicate, truncated=self.truncated,
                    illegal=self.illegal, cost=self.cost, audit=self.audit)

    def take(self, role: str, text: str, copies: int):
        """(edit, role, text) of the rows that come before this one, and of this one."""
        for _ in range(copies):
            self.own.append(role)
            for edit, new in self.edits:
                yield edit, new, "" if edit == "I" else text
                if edit != "I":
                    break

    def rest(self):
        """Rows inserted at the end."""
        for edit, new in self.edits:
            yield edit, new, ""


def _read(batches: Iterator[pa.RecordBatch], consumer):
    """Feed each conversation's parts, then its rows in order, to ``consumer``."""
    now = None
    for batch in batches:
        names = batch.schema.names
        for values in zip(*[c.to_pylist() for c in batch.columns]):
            row = dict(zip(names, values))
            if now is None or now.conv_id != row["conv_id"]:
                if now is not None:
                    yield from consumer.close(now)
                now = Conversation(row["conv_id"])
            if row["kind"] == 0:
                now.add(row)
                continue
            if now.edits is None:
                now.settle()
            yield from consumer.rows(now, now.take(row["role"], row["text"], row["copies"]))
    if now is not None:
        yield from consumer.close(now)


class Digests:
    """One row per conversation: its report and the digest of the repaired ``role:text`` lines."""

    schema = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def __init__(self):
        self.hash, self.any = hashlib.sha256(), False

    def rows(self, conversation, edits):
        for edit, role, text in edits:
            if edit != "D":
                self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
                self.any = True
        return ()

    def close(self, conversation):
        if conversation.edits is None:
            conversation.settle()
        self.rows(conversation, conversation.rest())
        yield conversation.report() | {"repaired_sha256": self.hash.hexdigest()}
        self.__init__()


class Turns:
    """The repaired rows with their edits; deleted rows have no place."""

    schema = "place long, edit string, role string, text string"

    def __init__(self):
        self.place = 0

    def rows(self, conversation, edits):
        for edit, role, text in edits:
            yield {"conv_id": conversation.conv_id, "place": None if edit == "D" else self.place, "edit": edit, "role": role, "text": text}
            self.place += edit != "D"

    def close(self, conversation):
        if conversation.edits is None:
            conversation.settle()
        yield from self.rows(conversation, conversation.rest())
        self.__init__()


def _consume(schema: pa.Schema, kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for row in _read(batches, kind()):
            out.append(row)
            size += len(row.get("text", "")) + 100
            if len(out) >= OUT_ROWS or size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _repaired(rows: DataFrame, ids: DataFrame, kind) -> DataFrame:
    id_type = rows.schema["conv_id"].dataType.simpleString()
    part, out = (f"conv_id {id_type}, {more}" for more in (PART, kind.schema))
    narrow = with_repeats(stored(facts(rows), "turn-facts")).select(
        "conv_id", "timed", F.col("turn").cast("long").alias("turn"), "role", "digest", "copies", "blank", "truncated", "repeated"
    )
    narrow = stored(narrow, "turn-marks")
    # conversations are cut where the slices end, so a very long one is parsed in parts
    slices = narrow.repartitionByRange(slice_count(narrow), *ORDER).sortWithinPartitions(*ORDER)
    parts = arrow_map(slices, _parts(_arrow(part)), part)
    parts = parts.withColumns({"copies": F.lit(None).cast("int"), "text": F.lit(None).cast("string")})
    absent = ids.select("conv_id").distinct().withColumn("kind", F.lit(0)).withColumn("blank", F.lit(0).cast("long"))
    texts = rows.select("conv_id", F.lit(1).alias("kind"), _timed(), F.col("turn").cast("long").alias("turn"), "role",
                        F.unhex(F.sha2("text", 256)).alias("digest"), "copies", "text")
    every = parts.unionByName(absent, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    order = ["conv_id", "kind", "timed", "turn", "role", "digest"]
    every = every.repartition("conv_id").sortWithinPartitions(*order)
    return arrow_map(every, _consume(_arrow(out), kind), out)


def reports(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``ids``: faults of its ``rows`` and the cheapest repair.

    ``rows`` has ``conv_id, turn, role, text, copies`` without nulls in the last three.
    Returns ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. Rows go by turn, null turns first; rows of one turn by role, then by
    the SHA-256 of the text, so equal rows are neighbours. The rows with a null ``conv_id`` are one
    conversation. A conversation without rows has zeros and no edits. Roles count by
    their first character; a role that begins with none of s, u, a, or is empty, is never kept.
    Very long conversations are parsed in slices that are joined by their cheapest paths; only the
    digest reads all texts of a conversation one after another, a row at a time.
    """
    return _repaired(rows, ids, Digests)


def repair(conversations: DataFrame) -> DataFrame:
    """Repaired rows: ``conv_id, place, edit, role, text``.

    ``edit`` is K (kept), R (another role), I (inserted, empty text) or D (deleted: no place).
    Null roles and texts count as one space; otherwise as in ``reports``.
    """
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select("conv_id", "turn", one("role"), one("text"), F.lit(1).alias("copies"))
    return _repaired(rows, rows, Turns)

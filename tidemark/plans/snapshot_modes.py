"""Which of snapshot and stream a job runs, by mode and by what was saved."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Plan:
    snapshot: bool
    stream: bool
    #: take the snapshot at the position the log was opened at
    at_log_start: bool = False
    #: query per table, where the whole table is not wanted
    select: Callable[[str], str | None] | None = None


#: what is known of an earlier run: nothing, a snapshot cut short, or one that finished
NONE, UNFINISHED, FINISHED = "none", "unfinished", "finished"

MODES = {
    "initial": {NONE: Plan(True, True), UNFINISHED: Plan(True, True), FINISHED: Plan(False, True)},
    "always": {NONE: Plan(True, True), UNFINISHED: Plan(True, True), FINISHED: Plan(True, True)},
    "initial_only": {
        NONE: Plan(True, False), UNFINISHED: Plan(True, False), FINISHED: Plan(False, False),
    },
    "never": {NONE: Plan(False, True), FINISHED: Plan(False, True)},
    "exported": {
        NONE: Plan(True, True, True), UNFINISHED: Plan(True, True, True),
        FINISHED: Plan(False, True),
    },
}


def plan(mode: str, saved: str = NONE, custom: Callable[[str], Plan] | None = None) -> Plan:
    """The plan for a mode; ``custom`` asks the user's own rule."""
    if mode == "custom":
        if custom is None:
            raise ValueError("mode custom needs a rule")
        return custom(saved)
    if mode not in MODES:
        raise ValueError(f"unknown snapshot mode {mode}")
    if saved not in MODES[mode]:
        raise ValueError("a snapshot was cut short, so mode never cannot go on from it")
    return MODES[mode][saved]

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tidemark.llm import conversations as C
from tidemark.llm.role_grammar import MACHINE, Repair, Table, edited_roles, finished, joined

SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit string, kind string"
SPACE = " \t\n\x0b\x0c\r"
STEP = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "ua"}, "ua": {"u": "u"}}


def plain_repair(rows):
    """(cost, audit, lines) over all edits from right to left. ``rows``: (role, text, must go, truncated)."""

    @lru_cache(maxsize=None)
    def best(i, state, inserts):
        found = []
        if i == len(rows):
            if state in ("", "ua"):
                found.append((0, "", ()))
        else:
            role, text, must_go, truncated = rows[i]
            if (rest := best(i + 1, state, 0)) is not None:
                found.append((rest[0] + 4, "D" + rest[1], rest[2]))
            if not must_go:
                for new, cost, letter in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    after = STEP[state].get(new[:1])
                    if after is not None and (rest := best(i + 1, after, 0)) is not None:
                        found.append((rest[0] + cost + 3 * truncated, letter + rest[1], (f"{new}:{text}", *rest[2])))
        if inserts < 4:
            for new in ("user", "assistant"):
                after = STEP[state].get(new[0])
                if after is not None and (rest := best(i, after, inserts + 1)) is not None:
                    found.append((rest[0] + 3, "I" + rest[1], (f"{new}:", *rest[2])))
        return min(found) if found else None

    return best(0, "", 0)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def plain_report(rows, ids):
    groups = {c: [] for c in ids}
    for row in rows:
        groups[row[0]].append(row[1:])
    out = {}
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0], r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in turns:
            last = text.rstrip(SPACE)[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            judged.append((role, text, fault in (0, 1), fault == 2))
        known = [t for t, *_ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, lines = plain_repair(tuple(judged))
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversation(rng, conv, n):
    says = ["Yes.", "No", "What?", "", " \n", "Well!  ", "a\nb.", None, "é 漢。", "So. it"]
    roles = ["user", "assistant", "system", None, "", "tool", "unit", "Assistant"]
    rows = []
    for i in range(n):
        role = rng.choices(roles, [9, 9, 3, 1, 1, 1, 1, 1])[0]
        rows.append((conv, rng.choice([None, i, i, i, i + 2, max(0, i - 1)]), role, rng.choice(says) if rng.random() < 0.6 else f"Text {i}."))
    return rows


def some_rows(seed=4):
    rng = random.Random(seed)
    rows = [r for conv in [*range(150), None] for r in conversation(rng, conv, rng.randint(1, 14))]
    rows += [rows[0]] * 3
    rows += [(700, i, "user" if i % 2 else "assistant", f"Line {i % 50}.") for i in range(600)]
    rows += [(701, 0, "user", "word " * 50_000 + "."), (702, 5, "user", "same."), (703, None, "user", None)]
    return rows + [(704, 3, "user", "twice.")] * 40


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("slices", [None, 40])
def test_reports_equal_brute_force(spark, monkeypatch, slices):
    if slices:  # conversations are cut into many parts
        monkeypatch.setattr(C, "slice_count", lambda df: slices)
        monkeypatch.setattr(C, "OUT_ROWS", 7)
    rows = some_rows()
    df = frame(spark, rows)
    got = C.reports(C.damage(df), df).collect()
    want = plain_report(plain_damage(rows), {r[0] for r in rows})
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "And?"), (1, 2, "user", "And?"), (2, 0, "user", " ")]
    got = sorted(C.repair(frame(spark, rows)).collect(), key=lambda r: (r.conv_id, r.place is None, r.place))
    assert [tuple(r) for r in got if r.conv_id == 1] == [
        (1, 0, "I", "user", ""), (1, 1, "K", "assistant", "Hi."), (1, 2, "K", "user", "And?"),
        (1, 3, "I", "assistant", ""), (1, None, "D", "user", "And?"),
    ]
    assert [tuple(r) for r in got if r.conv_id == 2] == [(2, None, "D", "user", " ")]


def test_nothing_and_all_dropped(spark):
    assert C.reports(C.damage(frame(spark, []).limit(0)), frame(spark, [])).count() == 0
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    df = frame(spark, [(9, dropped, "user", "Hi.")])
    assert [tuple(r) for r in C.reports(C.damage(df), df).collect()] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_parts_join_to_the_whole():
    rng = random.Random(2)
    for _ in range(300):
        rows = [(rng.choice("suaat"), rng.random() < 0.15, rng.random() < 0.15) for _ in range(rng.randint(0, 12))]
        whole = Repair()
        for row in rows:
            whole.add(*row)
        tops = {0: (0, "")}
        cut = rng.randint(0, len(rows))
        for part in (rows[:cut], rows[cut:]):
            paths = []
            for start in range(MACHINE.tops):
                parse = Repair(start)
                for row in part:
                    parse.add(*row)
                paths += [(start, *p) for p in parse.paths()]
            tops = joined(tops, paths)
        cost, audit = finished(tops)
        assert (cost, audit) == finished({t: (c, a) for t, c, a in whole.paths()})
        assert (cost, audit) == plain_repair(tuple((r, "", g, t) for r, g, t in rows))[:2]
        roles = [new for edit, new in edited_roles(audit, iter([r for r, *_ in rows])) if edit != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in roles))


def test_grammar_with_a_conflict_is_refused():
    with pytest.raises(ValueError):
        Table((("C", "u"), ("C", "X"), ("X", "u")))

"""A small LR automaton over roles and the cheapest repair of a row of roles.

The grammar says which rows of role initials are legal. Its LR table is built from the
rules; a parse is a graph of stacks whose tops are table states. Rows may be kept,
deleted, given another role, and rows may be inserted. Of stacks with equal tops only the
cheapest (cost, audit) goes on, so the graph has at most one live node per state.
"""

from __future__ import annotations

from dataclasses import dataclass, field

#: Role initials ``(s?(ua)+)?``; H is a pair's first half, "$" the end.
ROLE_RULES = (("C", ""), ("C", "B"), ("B", "Ha"), ("H", "u"), ("H", "su"), ("H", "Bu"))

# ---- fixed values -------------------------------------------------------------------
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"s": "system", "u": "user", "a": "assistant"}
FREE = "ua"  # roles that an edit may write
# -------------------------------------------------------------------------------------

NO = 1 << 60


class Table:
    """SLR table of a grammar without conflicts: shifts, reductions, jumps."""

    def __init__(self, rules):
        self.rules = [("S", rules[0][0]), *rules]
        names = {left for left, _ in self.rules}
        follow = self._follow(names)
        start = self._closure({(0, 0)}, names)
        self.states, self.shift, self.reduce, todo = {start: 0}, {}, {}, [start]
        while todo:
            items = todo.pop()
            at = self.states[items]
            for rule, dot in items:
                left, right = self.rules[rule]
                if dot == len(right):
                    for ahead in follow[left]:
                        if self.reduce.setdefault((at, ahead), rule) != rule:
                            raise ValueError(f"the grammar has a conflict before {ahead!r}")
            for symbol in {self.rules[r][1][d] for r, d in items if d < len(self.rules[r][1])}:
                moved = {(r, d + 1) for r, d in items if self.rules[r][1][d : d + 1] == symbol}
                target = self._closure(moved, names)
                if target not in self.states:
                    self.states[target] = len(self.states)
                    todo.append(target)
                self.shift[at, symbol] = self.states[target]

    def _closure(self, items, names):
        items, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            after = self.rules[rule][1][dot : dot + 1]
            for new in [(i, 0) for i, (left, _) in enumerate(self.rules) if after in names and left == after]:
                if new not in items:
                    items.add(new)
                    todo.append(new)
        return frozenset(items)

    def _follow(self, names):
        empty = {left for left, right in self.rules if not right}
        first = {n: set() for n in names}
        follow = {n: set() for n in names} | {"S": {"$"}}
        size = -1
        while size != (size := sum(map(len, [*first.values(), *follow.values()]))):
            for left, right in self.rules:
                for i, symbol in enumerate(right):
                    ahead = first.get(symbol, {symbol})
                    if all(x in empty for x in right[:i]):
                        first[left] |= ahead
                    if symbol in names:
                        tail = right[i + 1 :]
                        follow[symbol] |= first.get(tail[0], {tail[0]}) if tail else follow[left]
        return follow

    def settle(self, stack: tuple, ahead: str) -> tuple | None:
        """The stack after all reductions that ``ahead`` asks for; None if it is an error."""
        while (stack[-1], ahead) in self.reduce:
            left, right = self.rules[self.reduce[stack[-1], ahead]]
            if left == "S":
                return stack if ahead == "$" else None
            stack = stack[: len(stack) - len(right)]
            stack = (*stack, self.shift[stack[-1], left])
        return stack if (stack[-1], ahead) in self.shift else None


class Machine:
    """Live tops of the stack graph and the cheapest inserts between them.

    For a grammar such as this a stack can be told by its reduced form, and there are few
    of them; each is a node of the graph. ``moves[top][initial]`` lists (inserts, next top).
    """

    def __init__(self, rules=ROLE_RULES, most=64):
        table = Table(rules)
        tokens = sorted({x for _, right in table.rules for x in right} - {left for left, _ in table.rules})

        def shifted(stack, token):
            ready = table.settle(stack, token)
            if ready is None:
                return None
            stack = (*ready, table.shift[ready[-1], token])
            # a reduction that every next token asks for is made at once, so that equal stacks meet
            while True:
                rules = {table.reduce.get((stack[-1], x)) for x in [*tokens, "$"]} - {None}
                if len(rules) != 1 or any((stack[-1], x) in table.shift for x in tokens):
                    return stack
                left, right = table.rules[rules.pop()]
                below = stack[: len(stack) - len(right)]
                if (below[-1], left) not in table.shift or left == table.rules[1][0]:
                    return stack
                stack = (*below, table.shift[below[-1], left])

        stacks, step = [(0,)], []
        for stack in stacks:  # grows while it is read
            step.append({})
            for token in tokens:
                if (new := shifted(stack, token)) is not None:
                    if new not in stacks:
                        stacks.append(new)
                    step[-1][token] = stacks.index(new)
            if len(stacks) > most:
                raise ValueError("the grammar nests: its stacks have no bound")
        self.tops = len(stacks)
        accepts = [table.settle(s, "$") is not None for s in stacks]
        inserted = []  # inserted[top] = fewest inserts to each top
        for top in range(self.tops):
            least, todo = {top: 0}, [top]
            for t in todo:
                for token in FREE:
                    n = step[t].get(token)
                    if n is not None and n not in least:
                        least[n] = least[t] + 1
                        todo.append(n)
            inserted.append(least)
        self.moves = []
        for top in range(self.tops):
            by_token = {}
            for token in tokens:
                best = {}
                for t, n in inserted[top].items():
                    if token in step[t]:
                        new = step[t][token]
                        best[new] = min(best.get(new, NO), n)
                by_token[token] = [(n, new) for new, n in best.items()]
            self.moves.append(by_token)
        #: fewest inserts that end the conversation
        self.finish = [min((n for t, n in inserted[top].items() if accepts[t]), default=None) for top in range(self.tops)]


MACHINE = Machine()


@dataclass
class Repair:
    """Cheapest edits of rows, from one top of the stack graph, row after row.

    Inserts stand right before the row they lead to, since an insert before a deletion
    gives the same rows and a later audit. So audits of live nodes end with the same row's
    letter: none is the beginning of another, and their order cannot change later. It
    is enough to keep their ranks, and one byte per row and node to trace them back.
    """

    start: int = 0
    machine: Machine = field(default_factory=lambda: MACHINE)

    def __post_init__(self):
        n = self.machine.tops
        self.base = 0
        self.live = tuple((0, 0) if t == self.start else (NO, 0) for t in range(n))
        self.trace = bytearray()
        self.memo: dict = _MEMO

    def add(self, initial: str, must_go: bool, truncated: bool) -> None:
        key = (self.live, initial, must_go, truncated)
        found = self.memo.get(key)
        if found is None:
            found = self.memo[key] = self._step(*key)
        self.live, more, trace = found
        self.base += more
        self.trace += trace

    def _step(self, live, initial, must_go, truncated):
        """Costs relative to the least, ranks, and for each top its predecessor and edit.

        An edit is a byte: predecessor * 16 + inserts * 4 + (0 delete, 1 keep, 2 rerole).
        """
        best = [(NO, 0, "", 0)] * len(live)
        late = TRUNCATED if truncated else 0
        for top, (cost, rank) in enumerate(live):
            if cost >= NO:
                continue
            options = [(cost + DELETE, rank, "D", top * 16, top)]
            if not must_go:
                for roles, price, letter, code in ((initial, KEEP, "K", 1), (FREE, REROLE, "R", 2)):
                    for role in roles:
                        for n, new in self.machine.moves[top].get(role, ()):
                            options.append((cost + price + late + n * INSERT, rank, "I" * n + letter, top * 16 + n * 4 + code, new))
            for *value, new in options:
                best[new] = min(best[new], tuple(value))
        least = min(b[0] for b in best)
        order = sorted({b[1:3] for b in best if b[0] < NO})
        after = tuple((b[0] - least, order.index(b[1:3])) if b[0] < NO else (NO, 0) for b in best)
        return after, least, bytes(b[3] for b in best)

    def paths(self) -> list[tuple[int, int, str]]:
        """(top, cost, audit) of the live nodes."""
        out = []
        n = self.machine.tops
        for top, (cost, _) in enumerate(self.live):
            if cost >= NO:
                continue
            letters, t = [], top
            for at in range(len(self.trace) - n, -1, -n):
                code = self.trace[at + t]
                letters.append("DKR"[code & 3])
                letters.append("I" * (code >> 2 & 3))
                t = code >> 4
            out.append((top, cost + self.base, "".join(letters)[::-1]))
        return out


#: steps seen so far; few, as relative costs are bounded
_MEMO: dict = {}


def joined(before: dict[int, tuple[int, str]], paths) -> dict[int, tuple[int, str]]:
    """Cheapest (cost, audit) per top after a further part of the rows."""
    out: dict[int, tuple[int, str]] = {}
    for start, end, cost, audit in paths:
        if start in before:
            value = (before[start][0] + cost, before[start][1] + audit)
            if end not in out or value < out[end]:
                out[end] = value
    return out


def finished(tops: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """Cheapest (cost, audit) of all, with the inserts that end it."""
    ends = [(cost + n * INSERT, audit + "I" * n) for top, (cost, audit) in tops.items() if (n := MACHINE.finish[top]) is not None]
    return min(ends)


def edited_roles(audit: str, roles):
    """(edit, role, takes a row) for each letter of an audit, in order.

    ``roles`` iterates over the rows' own roles. A kept system row can only come first; all others
    take turns, so the audit settles every written role.
    """
    place, roles = 0, iter(roles)
    for edit in audit:
        own = None if edit == "I" else next(roles)
        if edit == "D":
            yield edit, own
        elif edit == "K":
            place = 0 if own[:1] == "s" else place + 1
            yield edit, own
        else:
            place += 1
            yield edit, ROLES["ua"[(place - 1) % 2]]

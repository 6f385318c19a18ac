"""Least-cost repair of a sequence of roles by a graph-structured stack over the role grammar.

The grammar of role initials is ``(s?(ua)+)?``. Its parser has four stack tops: nothing read, a system turn
read, a user's turn open, a pair closed. Each row shifts from every live top by keep, rerole or delete, after
any inserts; stacks that reach equal tops merge, and the one with the least (cost, audit) stays.

Audits need not be compared as strings. Right after a row, the audits of two tops hold the same number of
letters for rows and end in one, so neither begins with the other: their order never changes, whatever is
appended, and a rank for each top is enough. From any top, one insert and one deletion (a system turn's) at
most, or two inserts, make up for having left the parse in another one, so tops that cost more than that
above the least one are dropped. Ranks and relative costs then take few values, and steps are computed once
for each (tops, kind of row) and looked up afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass, field

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
#: A top that costs more above the least one can no longer win.
SLACK = COST[INSERT] + COST[DELETE]
ROLES = {"u": "user", "a": "assistant"}
#: Tops of the stack and the roles that may follow each; the parse may end in ENDS.
EMPTY, SYSTEM, OPEN, CLOSED = range(4)
SHIFT = ({"s": SYSTEM, "u": OPEN}, {"u": OPEN}, {"a": CLOSED}, {"u": OPEN})
ENDS = (EMPTY, CLOSED)

#: Of each top that is alive: (cost above the least one, rank of its audit); None for others.
Tops = tuple[tuple[int, int] | None, ...]


def alone(top: int) -> Tops:
    return tuple((0, 0) if t == top else None for t in range(4))


def _inserts(top: int) -> list[tuple[int, str]]:
    """Tops that up to two inserted turns lead to; more would only close another pair."""
    found = [(top, "")]
    for n in (1, 2):
        found += [(SHIFT[t][r], INSERT * n) for t, letters in found if len(letters) == n - 1 for r in ROLES if r in SHIFT[t]]
    return found


def _shifts(top: int, initial: str, truncated: bool) -> list[tuple[int, int, str]]:
    """(next top, cost, letters) of every way to read one row. Inserts before a deleted row are left out:
    behind it they give the same turns for the same cost, and D comes before I."""
    ways = [(top, COST[DELETE], DELETE)]
    for t, letters in _inserts(top):
        for role, after in SHIFT[t].items():
            letter = KEEP if role == initial else REROLE if role in ROLES else None
            if letter:
                ways.append((after, len(letters) * COST[INSERT] + COST[letter] + truncated * TRUNCATED, letters + letter))
    return ways


@dataclass
class Parser:
    """Steps and ends of the graph-structured stack, each computed once."""

    steps: dict = field(default_factory=dict)
    ends: dict = field(default_factory=dict)

    def step(self, tops: Tops, initial: str, truncated: bool) -> tuple[Tops, int, tuple]:
        """Tops after a row, the cost by which their least one grew, and (top before, letters) of each."""
        key = tops, initial, truncated
        if key not in self.steps:
            best: dict[int, tuple] = {}
            for top, held in enumerate(tops):
                if held:
                    for after, cost, letters in _shifts(top, initial, truncated):
                        way = held[0] + cost, held[1], letters, top
                        if after not in best or way < best[after]:
                            best[after] = way
            least = min(w[0] for w in best.values())
            best = {t: w for t, w in best.items() if w[0] <= least + SLACK}
            order = {t: n for n, t in enumerate(sorted(best, key=lambda t: best[t][1:3]))}
            after = tuple((best[t][0] - least, order[t]) if t in best else None for t in range(4))
            self.steps[key] = after, least, tuple((best[t][3], best[t][2]) if t in best else None for t in range(4))
        return self.steps[key]

    def end(self, tops: Tops) -> tuple[int, int, int]:
        """(cost above the least top, last top, number of inserts behind it) of the best complete parse."""
        if tops not in self.ends:
            ways = [(held[0] + len(letters) * COST[INSERT], held[1], letters, top) for top, held in enumerate(tops) if held for t, letters in _inserts(top) if t in ENDS]
            cost, _, letters, top = min(ways)
            self.ends[tops] = cost, top, len(letters)
        return self.ends[tops]


@dataclass
class Row:
    """What the parser needs of a row: the initial of its role (another one than s, u, a can only be rerolled or
    deleted), whether it must be deleted, and whether its text is cut off."""

    initial: str
    delete: bool
    truncated: bool


class Stack:
    """The rows of a conversation, or of one segment, from one top on."""

    def __init__(self, parser: Parser, top: int = EMPTY):
        self.parser, self.tops, self.cost = parser, alone(top), 0
        self.back: list[tuple | None] = []

    def read(self, row: Row) -> None:
        if row.delete:  # appends D to every audit: tops and ranks stay
            self.cost += COST[DELETE]
            self.back.append(None)
            return
        self.tops, more, back = self.parser.step(self.tops, row.initial, row.truncated)
        self.cost += more
        self.back.append(back)

    def letters(self, top: int) -> list[str]:
        """Inserts and edit of each row on the way to a top."""
        found = []
        for back in reversed(self.back):
            if back is None:
                found.append(DELETE)
            else:
                top, letters = back[top]
                found.append(letters)
        return found[::-1]


def turns(letters: list[str], initials: list[str], top: int) -> list[list[str | None]]:
    """The new role of each letter of each row: None for a deleted or kept row."""
    out = []
    for own, initial in zip(letters, initials, strict=True):
        roles: list[str | None] = []
        for letter in own:
            if letter == DELETE:
                roles.append(None)
                continue
            role = initial if letter == KEEP else next(r for r in ROLES if r in SHIFT[top])
            roles.append(None if letter == KEEP else ROLES[role])
            top = SHIFT[top][role]
        out.append(roles)
    return out


def closing(top: int, inserts: int) -> list[str]:
    """Roles of the turns inserted behind the last row."""
    roles = []
    for _ in range(inserts):
        role = next(r for r in ROLES if r in SHIFT[top])
        roles.append(ROLES[role])
        top = SHIFT[top][role]
    return roles

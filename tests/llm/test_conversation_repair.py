"""Repair against a search that knows nothing of stacks, segments or ranks."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scorewright.llm.conversation_repair import damaged, repair_conversations, repair_digests
from scorewright.llm.queries import QUERIES, op11_of
from scorewright.llm.role_grammar import COST, EMPTY, Parser, Row, Stack

WHITE = " \t\n\x0b\x0c\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(rows):
    """(cost, audit, new initials) of rows (initial, must go, truncated), by trying everything from the end."""

    @lru_cache(None)
    def rest(i, last, inserted):
        ways = []
        if i == len(rows) and last in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 3:
            for r in "ua":
                if r in NEXT[last]:
                    cost, audit, roles = rest(i, r, inserted + 1)
                    ways.append((cost + 3, "I" + audit, ("+" + r, *roles)))
        if i < len(rows):
            initial, gone, cut = rows[i]
            cost, audit, roles = rest(i + 1, last, 0)
            ways.append((cost + 4, "D" + audit, ("-", *roles)))
            if not gone:
                for r in NEXT[last]:
                    if r == initial or r in "ua":
                        cost, audit, roles = rest(i + 1, r, 0)
                        kept = r == initial
                        ways.append((cost + (0 if kept else 3) + 3 * cut, "RK"[kept] + audit, ("=" if kept else r, *roles)))
        return min(ways, default=(10**9, "", ()))

    for i in range(len(rows), -1, -1):  # from the end, so that recursion stays shallow
        for last in NEXT:
            rest(i, last, 0)
    return rest(0, "", 0)


def slow(rows):
    """The result of one conversation whose rows (turn, role, text) are given, as the contract words it."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(WHITE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, roles = cheapest(tuple((r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults)))
    lines, it = [], iter(rows)
    for role in roles:
        if role[0] == "+":
            lines.append({"u": "user:", "a": "assistant:"}[role[1]])
            continue
        _, old, text = next(it)
        if role != "-":
            lines.append(f"{old if role == '=' else {'u': 'user', 'a': 'assistant'}[role]}:{text}")
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(dict.fromkeys(map(ord, ".!?")))
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def expected(rows, ids):
    return sorted(((i, *slow([r[1:] for r in rows if r[0] == i])) for i in ids), key=str)


kinds = st.tuples(st.sampled_from(["s", "u", "a", "x", ""]), st.booleans(), st.booleans())


@settings(max_examples=800, deadline=None)
@given(st.lists(kinds, max_size=9))
def test_stack_finds_the_cheapest_repair(rows):
    parser, (cost, audit, _) = Parser(), cheapest(tuple(rows))
    stack = Stack(parser)
    for r in rows:
        stack.read(Row(*r))
    more, top, inserts = parser.end(stack.tops)
    assert (stack.cost + more, "".join(stack.letters(top)) + "I" * inserts) == (cost, audit)


def test_steps_are_few():
    """The stack's steps are a finite table, so a conversation of any length costs a look-up a row."""
    random.seed(3)
    parser = Parser()
    for _ in range(300):
        stack = Stack(parser)
        for _ in range(200):
            stack.read(Row(random.choice("suax"), random.random() < 0.2, random.random() < 0.3))
    assert len(parser.steps) < 1500 and COST["D"] == 4 and EMPTY == 0


SCHEMA = "conv_id long, turn long, role string, text string, edit string, place long, n int"
ROLES, TEXTS = ["user", "assistant", "system", "tool", "", None], ["Hello.", "Well", "", " \n", None, "a b! ", "é中🙂?", "x" * 3000]


def rows(seed, n):
    random.seed(seed)
    return [(random.choice([None, *range(-2, 9)]), random.choice([None, *range(12), 40]), random.choice(ROLES), random.choice(TEXTS) if random.random() < 0.6 else f"text {random.random()}.") for _ in range(n)]


def frame(spark, made, partitions=3):
    return spark.createDataFrame([(*r, "e", 1, 2) for r in made], SCHEMA).repartition(partitions)


@pytest.mark.parametrize("large", [1 << 30, 3000, 0])
def test_odd_conversations(spark, large):
    """Whole, partly and all in segments, over several tasks."""
    made = rows(1, 150) + [(100, 5, "user", "same.")] * 300 + [(101, None, "user", f"q{i}?") for i in range(80)] + [(102, i, ("user", "assistant")[i % 2], f"t{i // 7}.") for i in range(60)]
    df = frame(spark, made)
    edits = repair_conversations(df, large=large)
    found = sorted((tuple(r) for r in repair_digests(edits, df).collect()), key=str)
    assert found == expected(made, {r[0] for r in made})


def test_operator_gives_edits(spark):
    made = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 2, "user", "So"), (1, 2, "user", "So"), (1, 9, "assistant", "Yes!")]
    found = repair_conversations(frame(spark, made)).orderBy("place", "step").collect()
    assert [(r.edit, r.role, r.text, r.fault, r.times) for r in found] == [
        ("K", "system", "Be kind.", None, 1), ("I", "user", "", None, 1), ("K", "assistant", "Hi.", None, 1), ("K", "user", "So", "truncated", 1),
        ("D", None, None, "duplicate", 1), ("K", "assistant", "Yes!", None, 1),
    ]
    assert sum(r.cost for r in found) == 3 + 3 + 4


def test_empty_table_and_dropped_conversations(spark):
    df = frame(spark, rows(1, 1)).limit(0)
    assert repair_conversations(df).count() == 0 and repair_digests(repair_conversations(df), df).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = frame(spark, [(gone, 0, "user", "Hi.")])
    assert [tuple(r) for r in op11_of(df).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_damage(spark):
    made = rows(2, 200)
    assert sorted(map(tuple, damaged(frame(spark, made)).collect()), key=str) == sorted(damage(made), key=str)


def test_query(spark, sf):
    made = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = sorted((tuple(r) for r in QUERIES["op11_conversation_repair"](spark, sf).collect()), key=str)
    assert found == expected(damage(made), {r[0] for r in made})

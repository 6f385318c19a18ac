"""Chat formatting: the fingerprint of a record's nested field paths selects how its turns are read.

A layout is declared, not programmed: which fields are texts of which role, or which list holds turns and
which of its fields are role and text. Its fingerprints are those of its required paths with any of its
optional ones. Canonical turns are written with markers; control strings inside texts get a backslash after
their first character (strings that already have some get one more), which reading back removes.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches, text_slices

START, STOP = "<|turn|>", "<|end|>"
#: Strings that must not appear unescaped inside a text: the markers, and those of templates in common use.
CONTROLS = (START, STOP, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_PLAIN = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROLS))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROLS))


@dataclass(frozen=True)
class Layout:
    """``texts``: (path, role) in order, neighbours of one role being one turn; or ``each``: the path of the list
    of turns, with the paths of ``role`` and ``text`` in a turn (of several texts the first that is there counts).

    Paths are nested field names, ``a.b``, and ``a[].b`` for all elements of a list. ``roles`` renames roles;
    ``optional`` names paths that a record may lack or hold null; ``unread`` those that may be there and say nothing.
    """

    name: str
    texts: tuple[tuple[str, str], ...] = ()
    each: str | None = None
    role: str = "role"
    text: str | tuple[str, ...] = "content"
    optional: tuple[str, ...] = ()
    unread: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def _said(self) -> tuple[str, ...]:
        return (self.text,) if isinstance(self.text, str) else self.text

    def paths(self) -> set[str]:
        found = {p for p, _ in self.texts} | {*self.unread}
        if self.each is None:
            return found if self.texts else found | {self.role, *self._said()}
        return found | {f"{self.each}[].{p}" for p in (self.role, *self._said())}

    def turns(self, record: dict) -> list[tuple[str, str]]:
        found: list[tuple[str, str]] = []
        for path, role in self.texts:
            said = walk(record, path)
            if said is not None:
                joins = found and found[-1][0] == role
                found[-1:] = [(role, f"{found[-1][1]}\n\n{_text(said)}")] if joins else [*found[-1:], (role, _text(said))]
        listed = walk(record, self.each) or [] if self.each else [] if self.texts else [record]
        return found + [(self._role(walk(t, self.role)), _text(next((x for p in self._said() if (x := walk(t, p)) is not None), None))) for t in listed]

    def _role(self, said: object) -> str:
        return self.roles.get(_text(said), _text(said))


def walk(value: object, path: str) -> object:
    """What lies at a nested path; the texts of all elements of a list, a line each, where the path goes through it."""
    head, _, rest = path.partition(".")
    name = head.removesuffix("[]")
    inner = value.get(name) if isinstance(value, dict) else None
    if name != head:
        if not isinstance(inner, list):
            return None
        found = [walk(x, rest) if rest else x for x in inner]
        return "\n".join(_text(x) for x in found if x is not None)
    return walk(inner, rest) if rest and inner is not None else inner


def _text(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


_NAMES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}
_PARTS = ("messages[].content", "messages[].content[].text", "messages[].content[].type")
LAYOUTS = (
    Layout("turn", text="text", optional=("role", "text")),
    Layout("prompt", (("system", "system"), ("prompt", "user"), ("completion", "assistant")), optional=("system", "completion")),
    Layout("prompt response", (("system", "system"), ("prompt", "user"), ("response", "assistant")), optional=("system",)),
    Layout("question", (("question", "user"), ("answer", "assistant")), optional=("answer",)),
    Layout("instruction", (("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")), optional=("system", "input", "output")),
    Layout("messages", (("system", "system"),), each="messages", text=("content[].text", "content"), optional=("system", *_PARTS), unread=_PARTS[2:]),
    Layout("conversations", (("system", "system"),), each="conversations", role="from", text="value", optional=("system", "conversations[].value"), roles=_NAMES),
    Layout("nested prompt", (("data.system", "system"), ("data.prompt", "user"), ("data.reply", "assistant")), optional=("data.system", "data.reply")),
)
#: Fields, and all below them, that say nothing about turns: they do not enter a fingerprint.
IGNORED = ("id", "uid", "source", "lang", "language", "model", "category", "timestamp", "meta", "metadata")


def field_paths(record: object, prefix: str = "") -> set[str]:
    """Paths of all fields that hold something; elements of lists share the path ``name[]``."""
    if isinstance(record, dict):
        return {p for k, v in record.items() if v is not None for p in field_paths(v, f"{prefix}.{k}" if prefix else k)}
    if isinstance(record, list):
        return {p for v in record for p in field_paths(v, f"{prefix}[]")} or {prefix + "[]"}
    return {prefix} if prefix else set()


def relevant(paths: set[str], ignored: tuple[str, ...] = IGNORED) -> set[str]:
    return {p for p in paths if re.split(r"[.\[]", p, maxsplit=1)[0] not in ignored}


def fingerprint(paths: set[str]) -> str:
    return hashlib.md5("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprints(layouts: tuple[Layout, ...]) -> dict[str, Layout]:
    """The layout of each fingerprint; where two layouts share one, the first is meant."""
    table: dict[str, Layout] = {}
    for layout in layouts:
        optional = [p for p in layout.paths() if p in layout.optional]
        for n in range(len(optional) + 1):
            for left_out in combinations(optional, n):
                table.setdefault(fingerprint(layout.paths() - {*left_out}), layout)
        if layout.each:
            table.setdefault(fingerprint({layout.each + "[]"}), layout)  # no turns
    return table


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: f"{m.group()[0]}\\{m.group()[1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[0] + m.group()[2:], text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where in it the text that counts for the loss begins and how long it is."""
    head = START + escape(role.replace("%", "%25").replace("\n", "%0A")) + "\n"
    body = escape(text)
    return f"{head}{body}{STOP}\n", len(head), len(body) if role == "assistant" else 0


def read_turn(piece: str) -> tuple[str, str]:
    role, _, rest = piece[len(START) :].partition("\n")
    return unescape(role).replace("%0A", "\n").replace("%25", "%"), unescape(rest[: -len(STOP) - 1])


def format_records(records: DataFrame, record: str, *, carry: tuple[str, ...], layouts: tuple[Layout, ...] = LAYOUTS, ignored: tuple[str, ...] = IGNORED) -> DataFrame:
    """``carry, layout, turn_no, piece, loss_start, loss_length``: one row per turn of each JSON record.

    Offsets are in code points of the piece; a record's formatted text is its pieces one after another. Top
    fields in ``ignored`` are not looked at. A record of no known layout (or no valid JSON object) is kept as
    one row with null layout and piece, so no text is lost unseen; one without turns as one row with its
    layout and a null piece. Repeated records give repeated rows; an empty table gives none; texts of any
    length are kept whole. Nothing is shuffled.
    """
    fields = {f.name: f.dataType.simpleString() for f in records.schema}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table = fingerprints(layouts)
        for batch in batches:
            for part, texts in text_slices(batch, record):
                rows: list[tuple] = []
                for i, text in enumerate(texts):
                    parsed = _object(text)
                    layout = None if parsed is None else table.get(fingerprint(relevant(field_paths(parsed), ignored)))
                    turns = layout.turns(parsed) if layout else []
                    name = layout.name if layout else None
                    rows += [(i, name, n, *write_turn(*turn)) for n, turn in enumerate(turns)] or [(i, name, 0, None, None, None)]
                taken, *columns = zip(*rows, strict=True)
                yield {c: part.column(c).take(pa.array(taken)) for c in carry} | dict(zip(("layout", "turn_no", "piece", "loss_start", "loss_length"), map(list, columns), strict=True))

    schema = ", ".join(f"`{c}` {fields[c]}" for c in carry) + ", layout string, turn_no int, piece string, loss_start long, loss_length long"
    return map_batches(records.select(*carry, record), work, schema)


def _object(text: str) -> dict | None:
    try:
        parsed = json.loads(text)
    except ValueError:
        return None
    return parsed if isinstance(parsed, dict) else None


def conversation_digests(pieces: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Read formatted pieces back: one row per ``key`` with counts and digests, see the README.

    Pieces of a key are read in ``order``, equal ones by piece, as a sorted stream, so a conversation of any
    length needs one piece of memory. Null keys are one conversation; repeated rows count again; an empty
    table gives no rows.
    """
    kind = pieces.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = (key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        now: list | None = None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in (key, "piece", "loss_start", "loss_length")]
            for k, piece, start, length in zip(*columns, strict=True):
                if now is None or now[0] != k:
                    if now is not None:
                        done.append(_closed(now))
                    now = [k, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if piece is None:
                    continue
                role, text = read_turn(piece)
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                learnt = unescape(piece[start : start + length])
                now[3] += len(learnt)
                now[4].update(learnt.encode())
                now[5] += len(piece)
            if done:
                yield dict(zip(names, map(list, zip(*done, strict=True)), strict=True))
        if now is not None:
            yield {n: [v] for n, v in zip(names, _closed(now), strict=True)}

    sorted_pieces = pieces.select(key, *order, "piece", "loss_start", "loss_length").repartition(key).sortWithinPartitions(key, *order, "piece")
    return map_batches(sorted_pieces, work, f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _closed(state: list) -> tuple:
    return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]


def format_turn_rows(conversations: DataFrame) -> DataFrame:
    """The pieces of a table ``conv_id, turn, role, text`` whose rows are records of one turn each."""
    records = conversations.select("conv_id", "turn", F.to_json(F.struct("role", "text")).alias("record"))
    return format_records(records, "record", carry=("conv_id", "turn"))

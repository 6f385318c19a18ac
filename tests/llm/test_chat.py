import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scorewright.llm.chat import (
    CONTROLS, Layout, conversation_digests, escape, field_paths, fingerprint, format_records, format_turn_rows, read_turn, unescape, write_turn,
)

pieces = st.lists(st.one_of(st.sampled_from([*CONTROLS, "\\", "<", "[", "|", "\n", "<\\/s>", "%0A"]), st.text(max_size=3)), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(pieces, pieces)
def test_turns_read_back(role, text):
    piece, start, length = write_turn(role, text)
    assert read_turn(piece) == (role, text)
    assert not any(c in escape(text) for c in CONTROLS)
    piece, start, length = write_turn("assistant", text)
    assert unescape(piece[start : start + length]) == text


def test_paths_and_fingerprints():
    assert field_paths({"a": 1, "b": None, "c": [{"d": 1}, {"e": [2]}], "f": []}) == {"a", "c[].d", "c[].e[]", "f[]"}
    assert fingerprint({"a", "b"}) == fingerprint({"b", "a"}) != fingerprint({"a.b"})


RECORDS = [
    ({"prompt": "hi", "completion": "yo"}, [("user", "hi"), ("assistant", "yo")]),
    ({"prompt": "hi"}, [("user", "hi")]),
    ({"system": "s", "prompt": "hi", "response": "yo"}, [("system", "s"), ("user", "hi"), ("assistant", "yo")]),
    ({"instruction": "do", "input": None, "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"system": "s", "instruction": "do", "input": "this", "output": "done"}, [("system", "s"), ("user", "do\n\nthis"), ("assistant", "done")]),
    ({"data": {"prompt": "hi", "reply": "yo"}}, [("user", "hi"), ("assistant", "yo")]),
    ({"id": 7, "meta": {"a": [1, {"b": 2}]}, "data": {"system": "s", "prompt": "hi"}, "source": "web"}, [("system", "s"), ("user", "hi")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}, {"role": "assistant", "content": "c"}]}, [("user", "a\nb"), ("assistant", "c")]),
    ({"id": "x", "messages": [{"role": "user", "content": "a"}]}, [("user", "a")]),
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, [("user", "a"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "</s>"}]}, [("user", "a"), ("assistant", "</s>")]),
    ({"question": "q", "answer": 4}, [("user", "q"), ("assistant", "4")]),
    ({"messages": []}, []),
]


def test_layouts(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(RECORDS)] + [(100, '{"strange": 1}'), (103, '{"prompt": "a", "context": "not to be lost"}'), (101, "no json"), (102, None), (None, "[1]")]
    found = format_records(spark.createDataFrame(rows, "id long, record string"), "record", carry=("id",)).orderBy("id", "turn_no").collect()
    for i, (_, wanted) in enumerate(RECORDS):
        own = [r for r in found if r.id == i]
        assert [read_turn(r.piece) for r in own if r.piece] == wanted and all(r.layout for r in own)
    assert all(r.layout is None and r.piece is None for r in found if r.id is None or r.id >= 100)
    assert len({r.id for r in found}) == len(rows)


def test_declared_nested_layouts(spark):
    """Any nesting of any list, as a layout declares it; no text is lost."""
    layout = Layout("deep", (("head.note", "system"),), each="body.turns", role="who.name", text="what.said", optional=("head.note",), roles={"me": "user"})
    record = {"head": {"note": "n"}, "body": {"turns": [{"who": {"name": "me"}, "what": {"said": "x"}}, {"who": {"name": "it"}, "what": {"said": ["y", 1]}}]}}
    assert layout.turns(record) == [("system", "n"), ("user", "x"), ("it", '["y", 1]')]
    df = spark.createDataFrame([(1, json.dumps(record))] * 2, "id long, record string")
    plain = {"head": {"note": "n"}, "body": {"turns": [{"who": {"name": "me"}, "what": {"said": "x"}}]}}
    df = df.union(spark.createDataFrame([(2, json.dumps(plain))], df.schema))
    found = format_records(df, "record", carry=("id",), layouts=(layout,)).collect()
    assert [read_turn(r.piece) for r in sorted((r for r in found if r.id == 2), key=lambda r: r.turn_no)] == [("system", "n"), ("user", "x")]
    assert [r.layout for r in found if r.id == 1] == [None, None]  # a list where a text was declared is another layout


def slow(rows):
    made = {}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        said = [(r[2] or "", r[3] or "") for r in own]
        learnt = "".join(t for role, t in said if role == "assistant")
        made[key] = (len(said), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), sum(len(write_turn(*s)[0]) for s in said))
    return made


@pytest.mark.parametrize("partitions", [1, 4])
def test_digests_of_odd_conversations(spark, partitions):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b é🙂"), (1, 1, "assistant", "b é🙂"), (2, None, None, None), (2, 5, "assistant", None), (None, 1, "user", "x"), (3, 0, "assistant", "</s>" * 3000)]
    rows += [(4, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(500)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, piece string").repartition(partitions)
    found = conversation_digests(format_turn_rows(df), "conv_id", ["turn"]).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == slow(rows) and len(found) == 5
    assert conversation_digests(format_turn_rows(df.limit(0)), "conv_id", ["turn"]).count() == 0

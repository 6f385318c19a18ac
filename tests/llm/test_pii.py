import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import documents

from scorewright.llm import pii
from scorewright.llm.pii import KINDS, base_spans, find_personal_data, luhn, redact, secret_spans, written

PATTERNS = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain(text):
    """The patterns as they stand, failing matches dropped."""
    tests = [
        lambda m: True,
        lambda m: all(int(p) <= 255 for p in m.split(".")),
        lambda m: 13 <= sum(map(str.isdigit, m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
        lambda m: 9 <= sum(map(str.isdigit, m)) <= 15,
    ]
    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text) if tests[k](m.group())]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1@.@1. -+()25_é\n", max_size=60))
def test_base_spans_are_the_patterns(text):
    assert base_spans(text) == plain(text)


@pytest.mark.parametrize("text", [
    "a@b.c@d.e", "a@b@c.d", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.255", "4111 1111-1111 1111", "+1 (319) 555-5132.",
    "000255.1.1.1", "4111111111111112", "12345678901234567890123", "+12345678", "é x@y.z",
])
def test_chosen_texts(text):
    assert base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "@" * 300_000])
def test_long_runs_take_linear_time(text):
    base_spans(text)


def test_odd_documents(spark):
    found = find_personal_data(documents(spark)).collect()
    assert len(found) == documents(spark).count()
    texts = {r.doc_id: r.text or "" for r in documents(spark).collect() if r.doc_id is not None}
    for r in found:
        if r.doc_id is not None:
            spans = plain(texts[r.doc_id])
            assert r.base_sha256 == hashlib.sha256(written(spans).encode()).hexdigest()
            assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == i for s in spans) for i in range(4)]
            assert set(written(spans).split(",")) <= set(r.spans.split(","))
    assert find_personal_data(documents(spark, [])).count() == 0


def test_contexts_discover_unseen_identifiers(spark):
    """Six of seven numbers after these words are cards, so the seventh, whose check digit is wrong, is found too."""
    cards = ["4111111111111111", "4242424242424242", "4012888888881881", "5555555555554444", "5105105105105100", "378282246310005", "6011111111111117", "3530111333300000"]
    rows = [(i, f"please charge card number {c} today", *[None] * 10) for i, c in enumerate(cards)]
    rows += [(100, "please charge card number 9999123412341234 today", *[None] * 10), (101, "room 9999123412349990 is free", *[None] * 10)]
    found = {r.doc_id: r for r in find_personal_data(documents(spark, rows)).collect()}
    assert found[100].spans == "card:26:42" and found[100].n_found == 1 and found[100].n_card == 0
    assert found[101].spans == "" and all(found[i].n_found == 0 for i in range(len(cards)))


def test_redaction(spark):
    docs = documents(spark)
    masked = {r.doc_id: r for r in redact(docs).collect()}
    assert masked[15].text == "mail <email> or <phone> at <ip>" and masked[0].text is None and masked[1].text == ""
    assert redact(docs).columns == docs.columns and redact(docs).count() == docs.count()


CARDS = ["4111111111111111", "4242424242424242", "4012888888881881", "5555555555554444", "5105105105105100", "378282246310005", "6011111111111117", "3530111333300000"]


def _texts(spark, texts):
    found = find_personal_data(documents(spark, [(i, t, *[None] * 10) for i, t in enumerate(texts)])).collect()
    return {texts[r.doc_id]: {texts[r.doc_id][p.start : p.end] for p in r.places} for r in found if r.n_found}


def test_identifiers_with_blanks_or_without_digits_are_found(spark):
    """As long as the seeds of their kind: emails without digits, cards in blocks, phones with blanks and brackets."""
    texts = [f"card number: {c}" for c in CARDS] + [f"write to mailbox: user{i}@example.com" for i in range(12)]
    texts += [f"my phone: +1 (319) 555-51{i:02}" for i in range(12)]
    new = {
        "write to mailbox: john.doe[at]example.com soon": "john.doe[at]example.com",
        "card number: 4111 1111 1111 1112 and more": "4111 1111 1111 1112",
        "my phone: 319 555 5132": "319 555 5132", "my phone: (319) 555-5133, or so": "(319) 555-5133",
        "my phone: 7": "7", "my phone:319-555-5134": "319-555-5134",
        "write to mailbox:" + "x" * 99: "x" * 99,
    }
    assert _texts(spark, texts + list(new)) == {t: {i} for t, i in new.items()}


def test_words_after_patterns_of_other_words_are_no_emails(spark):
    texts = [f"write to me: user{i}@example.com" for i in range(12)] + [f"write to me: {w}" for w in "soon never often at once here there".split()]
    assert _texts(spark, texts) == {}


@pytest.mark.parametrize("text", ["1 " * 150_000, "(" * 300_000, "1(" * 150_000, "a:" * 150_000, "1" + " " * 300_000, "(1" * 150_000])
def test_candidates_take_linear_time(text):
    list(pii._numbers(text, []))
    [list(pii._words(text, *m.span())) for m in pii._WORD.finditer(text)]


def test_rounds_go_on_until_nothing_is_added(spark):
    """Each pattern but the first is trusted only after the one before it revealed an instance of its own."""
    words = ["aa:", "bb:", "cc:", "dd:", "ee:", "ff:"]
    texts = [f"{w} +1 (319) 55{i}-51{k:02}" for i, w in enumerate(words) for k in range(12)]
    new = [f"{w} 70{i}{k}" for i, w in enumerate(words) for k in range(4)]
    new += [f"{w} 70{i - 1}0" for i, w in enumerate(words) if i]
    assert _texts(spark, texts + new) == {t: {t.split()[1]} for t in new}


def test_other_places_speak_against_an_instance(spark):
    """A number that once follows a trusted word, and several others too, is none of its kind; nor is such a word."""
    texts = [f"phone: +1 (319) 555-51{i:02}" for i in range(12)] + [f"mailbox: user{i}@example.com" for i in range(12)]
    clean = [f"{w} {x} is free" for w in ("room", "model", "invoice", "train") for x in ("5551234", "today")]
    new = {"phone: 5551235": "5551235", "mailbox: joe[at]example.com": "joe[at]example.com", "phone: 5551236": "5551236", "lobby 5551236": "5551236"}
    assert _texts(spark, [*texts, "phone: 5551234", "mailbox: today", *clean, *new]) == {t: {i} for t, i in new.items()}


def test_credentials_are_spans_but_no_base(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = [f'rti token = "{key}" end', f"API_KEY: {key}, mail ann@example.com", f"password={'a' * 30}", f"mytoken = {key}", "token = short1", f"tokens: {key}\nSECRET='{key[:20]}'", None, ""]
    docs = documents(spark, [(i, t, *[None] * 10) for i, t in enumerate(texts)])
    found = {r.doc_id: r for r in find_personal_data(docs).collect()}
    assert [found[i].n_secret for i in range(len(texts))] == [1, 1, 0, 0, 0, 2, 0, 0]
    assert found[0].spans == f"secret:13:{13 + len(key)}" and found[1].n_email == 1 and found[0].n_card == 0
    assert found[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    texts = {r.doc_id: r.text for r in redact(docs).collect()}
    assert texts[0] == 'rti token = "<secret>" end' and texts[1] == "API_KEY: <secret>, mail <email>" and texts[4] == "token = short1" and texts[6] is None


@pytest.mark.parametrize("text", ["token = " * 30_000, "secret:" + "x" * 300_000, "api_key" + " " * 300_000 + "=", "token=" * 50_000])
def test_credentials_take_linear_time(text):
    begin = time.time()
    secret_spans(text)
    assert time.time() - begin < 3

import hashlib
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import TEXTS, documents, prose
from tokenizers import Tokenizer

from scorewright.llm.packing import END, WINDOW, best_cuts, pack
from scorewright.llm.pieces import byte_tokenizer
from scorewright.llm.resync import spliced_ids
from scorewright.llm.token_counts import token_counts
from scorewright.llm.word_bpe import encode_decode, word_tokenizer

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
byte_library, word_library = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
odd_text = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'stremvldSTa1²٣é中あ!?-.́ΣİßK<|>\u0085  \x1c\x00"), st.characters(exclude_categories=["Cs"])), max_size=40)


def library_ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(odd_text, max_size=6))
def test_byte_ids_are_the_librarys(texts):
    tokenizer = byte_tokenizer(BYTES)
    wanted = [library_ids(byte_library, t) for t in texts]
    assert [x.tolist() for x in tokenizer.encode(texts)] == wanted
    assert tokenizer.counts(texts).tolist() == [len(x) for x in wanted]


@settings(max_examples=150, deadline=None)
@given(st.lists(odd_text, max_size=6))
def test_word_ids_and_texts_are_the_librarys(texts):
    for (ids, decoded), text in zip(word_tokenizer(WORDS).encode(texts), texts, strict=True):
        wanted = library_ids(word_library, text)
        assert ids.tolist() == wanted
        assert decoded == word_library.decode(wanted, skip_special_tokens=False)


def test_a_very_long_word_takes_linear_time():
    random.seed(2)
    tokenizer = word_tokenizer(WORDS)
    for letters, size in (("abcdefghijklmnopqrstuvwxyz", 100_000), ("etaoin", 1_000_000), ("a", 300_000)):
        word = "".join(random.choice(letters) for _ in range(size))
        begin = time.time()
        (ids, _), = tokenizer.encode([word])
        assert time.time() - begin < 10
        assert ids.tolist() == library_ids(word_library, word)


def test_words_that_greedy_matching_gets_wrong():
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 25))) for _ in range(4000)]
    tokenizer = word_tokenizer(WORDS)
    before = tokenizer.failed
    assert [x.tolist() for x, _ in tokenizer.encode(words)] == [library_ids(word_library, w) for w in words]
    assert 0 < tokenizer.failed - before < len(words)  # both ways were taken


@pytest.mark.parametrize("seed", range(60))
def test_spliced_chunks_equal_the_whole(seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("ab   \n\n' s.,1é中<|>") * rng.randint(1, rng.choice([3, 3, 60]))) for _ in range(rng.randint(0, 300))]
    text = "".join(p if rng.random() < 0.95 else "<|endoftext|>" for p in parts) + "x" * rng.choice([0, 700]) + " " * rng.choice([0, 300])
    found = np.concatenate([*spliced_ids(byte_tokenizer(BYTES), text, chunk=rng.choice([40, 64, 100]), overlap=rng.choice([8, 16, 32]))])
    assert found.tolist() == library_ids(byte_library, text)


def test_counts_of_odd_documents(spark):
    found = token_counts(documents(spark), BYTES, chunk=500)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    wanted = defaultdict(list)
    for r in documents(spark).collect():
        ids = library_ids(byte_library, r.text or "")
        wanted[r.doc_id].append((len((r.text or "").encode()), len(ids), len(ids) > 1024))
    got = defaultdict(list)
    for r in found.collect():
        got[r.doc_id].append((r.n_bytes, r.n_tokens, r.over_limit))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}
    assert token_counts(documents(spark, []), BYTES).count() == 0


def test_round_trip_of_odd_documents(spark):
    rows = encode_decode(documents(spark), WORDS).collect()
    assert len(rows) == documents(spark).count()
    for r in rows:
        assert r.decoded == word_library.decode(r.ids, skip_special_tokens=False) and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    by_id = {r.doc_id: r.ids for r in rows if r.doc_id is not None}
    assert all(by_id[i] == library_ids(word_library, t or "") for i, t in enumerate(TEXTS))
    assert encode_decode(documents(spark, []), WORDS, keep=False).count() == 0


def slow_cuts(places, costs, window):
    best = {0: (0, [0])}
    for j in range(1, len(places)):
        options = [(best[i][0] + window - (places[j] - places[i]) + costs[j], best[i][1] + [j]) for i in range(j) if places[j] - places[i] <= window]
        best[j] = min(options, key=lambda o: o[0])
    return best[len(places) - 1][0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 12)), min_size=1, max_size=25))
def test_cuts_cost_the_least(steps):
    places = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    costs = np.array([0, *[c for _, c in steps]])
    chain = best_cuts(places, costs, 10, whole=True)
    assert chain[0] == 0 and chain[-1] == len(places) - 1
    widths = np.diff(places[chain])
    assert (widths <= 10).all()
    assert (10 - widths).sum() + costs[chain[1:]].sum() == slow_cuts(places.tolist(), costs.tolist(), 10)


@pytest.mark.parametrize("segment", [1 << 20, 3000])
def test_pieces_hold_every_id_once(spark, segment, monkeypatch):
    from scorewright.llm import packing

    docs = documents(spark, [(i, prose(i, 5 + 37 * i % 900), *[None] * 10) for i in range(80)]).unionByName(documents(spark)).coalesce(2)
    if segment < 1 << 20:
        import pyspark.cloudpickle as cloudpickle

        monkeypatch.setattr(packing, "SEGMENT", segment)
        cloudpickle.register_pickle_by_value(packing)  # tasks must see the small segment
    try:
        pieces = pack(docs, BYTES).collect()
    finally:
        if segment < 1 << 20:
            cloudpickle.unregister_pickle_by_value(packing)
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= WINDOW
    wanted = defaultdict(list)
    for r in docs.collect():
        wanted[r.doc_id].append([*library_ids(byte_library, r.text or ""), END])
    by_doc = defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(wanted)
    for key, texts in wanted.items():
        assert sum(r.length for r in by_doc[key]) == sum(map(len, texts))
        if len(texts) == 1:
            ids, at = texts[0], 0
            for r in sorted(by_doc[key], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
                at += r.length
    tokens = sum(r.length for r in pieces)
    assert tokens >= 0.9 * WINDOW * (len(sequences) - 2)


def test_nothing_to_pack(spark):
    assert pack(documents(spark, []), BYTES).count() == 0

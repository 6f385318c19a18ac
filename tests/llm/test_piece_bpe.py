"""Pieces against the library: ids, decimal digests and decoded texts."""

import hashlib
import random
import time

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from odd import documents, prose, rows
from scorewright.llm import piece_bpe
from scorewright.llm.piece_bpe import MergeRanks, PieceTokenizer, encode_decode_pieces, marked, merge_long, merge_rounds
from scorewright.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
library = SentencePieceProcessor(model_file=PATH)
tokenizer = PieceTokenizer(PATH)


def check(texts):
    for text, (ids, shown, said) in zip(texts, tokenizer.encode([marked(t) for t in texts]), strict=True):
        wanted = library.encode(text)
        assert ids.tolist() == wanted
        assert shown.decode() == ",".join(map(str, wanted)) and said[1:].decode() == library.decode(wanted)


bits = st.sampled_from(["a", "b", "e", "th", "ing", " ", "  ", "▁", "\n", "\t", "é", "中", "🙂", "0", "12", "==", "(", "<s>", "<0x41>", "\x00", "�", "́"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(bits, max_size=40).map("".join), st.text(max_size=20)), min_size=1, max_size=5))
def test_texts_equal_the_library(texts):
    check([t.encode("utf-8", "ignore").decode() for t in texts])


def test_awkward_texts():
    check(["", " ", "  ", "▁", " a", "a ", "   hello    world \n\t x", "<s></s><unk>", " " * 100, "a" * 255, "a" * 300, "ab" * 200, prose(1, 2000)])
    random.seed(7)
    check(["".join(random.choice("etaoinshr") for _ in range(n)) for n in (255, 256, 257, 3000)] + [" " * n for n in (255, 257, 3000)])


def test_very_long_words_are_not_quadratic():
    random.seed(8)
    for text in ("".join(random.choice("etaoinshrdlucm") for _ in range(300_000)), " " * 300_000):
        begin = time.time()
        tokenizer.encode([marked(text)])
        assert time.time() - begin < 10
        check([text])


def slow_merges(symbols, pieces):
    """One pair at a time: the best score, the leftmost of equal ones."""
    symbols = list(symbols)
    while True:
        best = min(((-pieces[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in pieces), default=None)
        if best is None:
            return symbols
        i = best[1]
        symbols[i : i + 2] = ["".join(symbols[i : i + 2])]


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text("abc", min_size=2, max_size=5), st.integers(-6, 0).map(float), max_size=12), st.lists(st.text("abc", min_size=1, max_size=14), min_size=1, max_size=6))
def test_any_vocabulary_merges_as_one_by_one(scores, words):
    """Also vocabularies whose merges are out of order or share scores, where merging at once would be wrong."""
    import numpy as np

    scores = {"a": -9.0, "b": -9.0, "c": -9.0} | scores
    names = list(scores)
    ranks = MergeRanks({n: (i, scores[n]) for i, n in enumerate(names)}, len(names))
    symbols = np.array([names.index(c) for w in words for c in w])
    flat, sizes = merge_rounds(symbols, np.array([len(w) for w in words]), ranks)
    found = [[names[i] for i in part] for part in np.split(flat, np.cumsum(sizes)[:-1])]
    wanted = [slow_merges(w, scores) for w in words]
    assert found == wanted
    assert [[names[i] for i in merge_long([names.index(c) for c in w], ranks)] for w in words] == wanted


def digests(text):
    ids = library.encode(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("chunk", [piece_bpe.CHUNK, 100])
def test_odd_documents(spark, chunk, monkeypatch):
    found = encode_decode_pieces(documents(spark), PATH, chunk=chunk).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found), key=str) == sorted(((r[0], *digests(r[1])) for r in rows()), key=str)
    texts = {r[0]: r[1] or "" for r in rows() if r[0] is not None}
    assert all(r.ids == library.encode(texts[r.doc_id]) and r.decoded == texts[r.doc_id].replace("▁", " ") for r in found if r.doc_id is not None)
    assert encode_decode_pieces(documents(spark, []), PATH).count() == 0


@pytest.mark.parametrize("size", [1, 7, 100])
def test_long_texts_in_parts(size):
    for text in (prose(3, 400), "a" * 500, "中文" * 100, " x" * 200, ""):
        parts = list(tokenizer.chunks(marked(text), size))
        assert "".join(parts) == marked(text)
        assert [i for ids, _, _ in tokenizer.encode(parts) for i in ids] == library.encode(text)


def test_query(spark, sf):
    wanted = {r.doc_id: digests(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_sentencepiece"](spark, sf).collect()} == wanted

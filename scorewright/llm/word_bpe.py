"""Encoding and decoding with a word-level BPE vocabulary, by speculation and verification.

For each distinct word, greedy longest match proposes tokens. Merging would give exactly these if no merge
crosses the seam of any adjacent pair, which is tested for all pairs of a slice at once: walking down both
tokens' merge trees along the seam, from the latest merge to the earliest, no pair met on the way may have a
merge of its own that comes first. Only words with a failing pair are merged exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scorewright.llm.batches import map_batches, text_slices
from scorewright.llm.pieces import SPACE, Classes, Merger, byte_alphabet, distinct_pieces, lay_out, word_starts

_SUFFIX = "</w>"


class MergeTree:
    """Left and right parts of merged tokens, and the token of each mergeable pair. Ids grow with merge rank."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        size = max(vocabulary.values()) + 1
        self.size = size
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        triples = np.array([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges], np.int64).reshape(-1, 3)
        if len(triples) and (np.diff(triples[:, 2]) <= 0).any():
            raise ValueError("token ids do not grow with the rank of their merges")
        self.left[triples[:, 2]], self.right[triples[:, 2]] = triples[:, 0], triples[:, 1]
        keys = triples[:, 0] * size + triples[:, 1]
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], triples[order, 2]

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that merging ``a`` and ``b`` gives, or a number above all ids."""
        wanted = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.merged[at], self.size)

    def separate(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the seam of each pair, as long as only merges below ``limit`` count."""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), self.size, np.int64) if limit is None else limit.copy()
        fine = np.ones(len(a), bool)
        active = np.arange(len(a))
        while len(active):
            x, y = a[active], b[active]
            crossed = self.pair(x, y) < limit[active]
            fine[active[crossed]] = False
            base_x, base_y = self.left[x] < 0, self.left[y] < 0
            undo_x = ~base_x & ((x > y) | base_y)
            undo_y = ~base_y & ~undo_x
            limit[active] = np.where(undo_x, x, y + 1)  # of equal merges, the left one is first
            a[active] = np.where(undo_x, self.right[x], x)
            b[active] = np.where(undo_y, self.left[y], y)
            active = active[~crossed & (undo_x | undo_y)]
        return fine


class WordTokenizer:
    """Ids and decoded texts as the library gives them for a vocabulary whose words end in a suffix."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model["end_of_word_suffix"] != _SUFFIX:
            raise ValueError(f"words of the vocabulary must end in {_SUFFIX}")
        vocabulary = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.specials = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        self.names = np.full(max([*vocabulary.values(), *self.specials.values()]) + 1, "", object)
        for names in (vocabulary, self.specials):
            for name, i in names.items():
                self.names[i] = name
        self.normalize = library.normalizer.normalize_str
        self.classes = Classes(ByteLevel(add_prefix_space=False).pre_tokenize_str)
        self.tree = MergeTree(vocabulary, merges)
        own = np.flatnonzero(self.tree.left >= 0)
        reachable = np.ones(len(self.names), bool)
        reachable[own] = self.tree.separate(self.tree.left[own], self.tree.right[own], own)
        named = [(name, i) for name, i in vocabulary.items() if reachable[i] and i not in set(self.specials.values())]
        self.last = {name[: -len(_SUFFIX)]: i for name, i in named if name.endswith(_SUFFIX) and len(name) > len(_SUFFIX)}
        self.inner = {name: i for name, i in named if not name.endswith(_SUFFIX)}
        self.longest, self.longest_last = max(map(len, self.inner)), max(map(len, self.last))
        self.alphabet = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})
        self.exact = library.model.tokenize
        self.proposed = self.failed = 0
        self.merger = Merger(self._merge)

    def _propose(self, word: str) -> list[int]:
        """Longest matches from the left; nothing if the vocabulary lacks a character. A word's end is looked up
        only where a last token may reach it, so the work is linear in the word's length."""
        out, at, n = [], 0, len(word)
        last, inner, longest, near_end = self.last, self.inner, self.longest, len(word) - self.longest_last
        while True:
            if at >= near_end and (token := last.get(word[at:])) is not None:
                out.append(token)
                return out
            end = min(n - 1, at + longest)
            while end > at and (token := inner.get(word[at:end])) is None:
                end -= 1
            if end <= at:
                return []
            out.append(token)
            at = end

    def _merge(self, words: list[str]) -> list[list[int]]:
        shown = [w if w.isascii() and w.isalnum() else w.encode().decode("latin-1").translate(self.alphabet) for w in words]
        lists = [self._propose(w) for w in shown]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((t for ids in lists for t in ids), np.int64, int(sizes.sum()))
        of = np.repeat(np.arange(len(lists)), sizes)
        seams = np.flatnonzero(of[1:] == of[:-1])
        pairs, inverse = np.unique(flat[seams] * self.tree.size + flat[seams + 1], return_inverse=True)
        fine = self.tree.separate(pairs // self.tree.size, pairs % self.tree.size)[inverse]
        failing = np.union1d(of[seams[~fine]], np.flatnonzero(sizes == 0)).tolist()
        self.proposed += len(lists)
        self.failed += len(failing)
        for i in failing:
            lists[i] = [t.id for t in self.exact(shown[i])]
        return lists

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, str]]:
        """Ids and decoded text of each text."""
        parts, of = [], []
        for row, text in enumerate(texts):
            for part, special in split_specials(text, self.specials):
                parts.append(self.normalize(part) if part else "")
                of.append((row, special))
        layout = lay_out(parts)
        n = len(layout.codes)
        classes = self.classes.of(layout.codes) if n else np.zeros(0, np.uint8)
        starts = word_starts(layout, classes) if n else np.zeros(0, bool)
        pieces = distinct_pieces(layout, starts, classes != SPACE)
        table = self.merger.table(pieces)
        ids = table.of(pieces.forms)
        forms = table.of(np.arange(len(pieces.words)))
        names = self.names[forms].tolist()
        ends = np.cumsum(table.sizes).tolist()
        decoded = [" ".join(names[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
        lengths = np.bincount(pieces.rows, weights=table.sizes[pieces.forms], minlength=len(parts)).astype(np.int64)
        ends_of_ids = np.cumsum(lengths)
        cut = np.searchsorted(pieces.rows, np.arange(len(parts) + 1))
        all_forms = pieces.forms.tolist()
        found: list[tuple[list, list]] = [([], []) for _ in texts]
        for k, (row, special) in enumerate(of):
            some, said = found[row]
            if cut[k + 1] > cut[k]:
                some.append(ids[ends_of_ids[k] - lengths[k] : ends_of_ids[k]])
                said.append(" ".join([decoded[f] for f in all_forms[cut[k] : cut[k + 1]]]))
            if special >= 0:
                some.append(np.array([special], np.uint32))
                said.append(self.names[special])
        return [(np.concatenate(some) if some else np.zeros(0, np.uint32), " ".join(said)) for some, said in found]


def split_specials(text: str, specials: dict[str, int]) -> Iterator[tuple[str, int]]:
    """Parts of a text, each with the id of the special string that follows it, or -1."""
    found = [s for s in specials if s in text]
    at = 0
    while found:
        nexts = [(i, -len(s), s) for s in found if (i := text.find(s, at)) >= 0]
        if not nexts:
            break
        i, _, s = min(nexts)
        yield text[at:i], specials[s]
        at = i + len(s)
    yield text[at:], -1


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def encode_decode(documents: DataFrame, vocabulary: str, *, key: str = "doc_id", keep: bool = True) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of every row, and with ``keep`` also ``ids`` and ``decoded``.

    ``vocabulary`` is a BPE file of the tokenizers library whose words end in ``</w>``, readable on every
    executor. Digests are over ids as little-endian 32-bit integers and over the decoded text in UTF-8. There
    is no shuffle; a task holds one slice of texts. A null or empty text has no ids and decodes to an empty
    text; null keys and repeated rows are kept; an empty table gives no rows; other columns are not read. A text
    of any length is encoded whole, a word of any length in linear time but for the merges it needs.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokenizer = word_tokenizer(vocabulary)
        for batch in batches:
            for part, texts in text_slices(batch):
                found = tokenizer.encode(texts)
                out = {
                    key: part.column(key),
                    "n_tokens": [len(ids) for ids, _ in found],
                    "ids_sha256": [hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids, _ in found],
                    "decoded_sha256": [hashlib.sha256(said.encode()).hexdigest() for _, said in found],
                }
                if keep:
                    out |= {"ids": [ids.astype(np.int64) for ids, _ in found], "decoded": [said for _, said in found]}
                yield out

    kind = documents.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>, decoded string" * keep
    return map_batches(documents.select(key, "text"), work, schema)

"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Blanks become a visible mark and one mark is put before a text. Two characters that stand side by side in no
piece of the vocabulary can never be merged into one, so a text falls into words between such characters.
The distinct words of a slice are one flat array of symbols. In each round every word finds the least rank
of its adjacent pairs (a segmented minimum), merges all pairs of that rank at once, from the left, and the
array is compacted; words without a pair left drop out. Merging at once equals merging one by one unless
the merged symbol could at once take part in a pair of no higher rank; such symbols are known from the
vocabulary, and their words merge one pair a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scorewright.llm.batches import map_batches, text_slices
from scorewright.llm.pieces import Merger, distinct_pieces, lay_out

MARK = "▁"
#: Symbols of a word up to which it takes part in rounds, and characters of a text that are encoded at once.
ROUNDS, CHUNK = 256, 1 << 20
_NONE = np.int64(1) << 40


class MergeRanks:
    """Rank and result of each mergeable pair of pieces; a lower rank is merged first, equal ranks from the left."""

    def __init__(self, pieces: dict[str, tuple[int, float]], size: int):
        ranks = {score: i for i, score in enumerate(sorted({s for _, s in pieces.values()}, reverse=True))}
        rank = {i: ranks[score] for i, score in pieces.values()}
        self.size = size
        self.risky = np.zeros(size, bool)
        rows = []
        for piece, (made, _) in pieces.items():
            for k in range(1, len(piece)):
                left, right = pieces.get(piece[:k]), pieces.get(piece[k:])
                if left and right:
                    rows.append((left[0] * size + right[0], rank[made], made))
                    for part in (left[0], right[0]):
                        self.risky[part] |= rank[made] <= rank[part]
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.made = np.ascontiguousarray(table.T)
        self.single = {k: (r, m) for k, r, m in rows}

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``rank * size + merged piece`` of each pair, or a number above all; negative symbols never merge."""
        if not len(self.keys):
            return np.full(len(a), _NONE)
        wanted = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        fine = (self.keys[at] == wanted) & (a >= 0) & (b >= 0)
        return np.where(fine, self.ranks[at] * self.size + self.made[at], _NONE)


def merge_rounds(symbols: np.ndarray, sizes: np.ndarray, ranks: MergeRanks) -> tuple[np.ndarray, np.ndarray]:
    """Merge every word (none is empty) of a flat symbol array to its end: the symbols that are left, word by word, and their numbers."""
    done_symbols, done_words, done_sizes = [], [], []
    words = np.arange(len(sizes))
    symbols = symbols.astype(np.int64)
    pairs = np.full(len(symbols), _NONE)
    if len(symbols) > 1:
        pairs[:-1] = ranks.of(symbols[:-1], symbols[1:])
    ends = np.cumsum(sizes)
    pairs[ends - 1] = _NONE
    while len(words):
        starts = np.cumsum(sizes) - sizes
        least = np.minimum.reduceat(pairs, starts)
        over = least == _NONE
        if over.any():
            of = np.repeat(over, sizes)
            done_symbols.append(symbols[of])
            done_words.append(words[over])
            done_sizes.append(sizes[over])
            symbols, pairs, words, least, sizes = symbols[~of], pairs[~of], words[~over], least[~over], sizes[~over]
            if not len(words):
                break
            starts = np.cumsum(sizes) - sizes
        hit = pairs // ranks.size == np.repeat(least // ranks.size, sizes)
        at = np.flatnonzero(hit)
        fresh = np.ones(len(at), bool)
        fresh[1:] = np.diff(at) > 1
        place = np.arange(len(at))
        at = at[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
        made = pairs[at] % ranks.size
        if ranks.risky[made].any():
            own = np.searchsorted(starts, at, side="right") - 1
            alone = np.zeros(len(words), bool)
            alone[own[ranks.risky[made]]] = True
            first = np.ones(len(at), bool)
            first[1:] = np.diff(own) > 0
            at, made = (x[first | ~alone[own]] for x in (at, made))
        symbols[at] = made
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        sizes = np.add.reduceat(keep, starts)
        symbols, pairs, now = symbols[keep], pairs[keep], place[at]
        ends = np.cumsum(sizes)
        closing = np.zeros(len(symbols), bool)
        closing[ends - 1] = True
        changed = np.concatenate([now, now[now > 0] - 1])
        changed = changed[~closing[changed]]
        pairs[closing] = _NONE
        pairs[changed] = ranks.of(symbols[changed], symbols[changed + 1])
    order = np.argsort(np.concatenate(done_words) if done_words else np.zeros(0, np.int64))
    flat, sizes = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_symbols, done_sizes))
    starts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return flat[shift + np.arange(len(flat))], sizes


def merge_long(symbols: list[int], ranks: MergeRanks) -> list[int]:
    """The same for one long word, pair by pair from a heap: rounds would read the whole word for each rank."""
    n, size, single = len(symbols), ranks.size, ranks.single
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def look(i: int, j: int) -> tuple[int, int, int, int] | None:
        a, b = symbols[i], symbols[j]
        found = single.get(a * size + b) if a >= 0 and b >= 0 else None
        return found and (found[0], i, j, found[1])

    heap = [x for i in range(n - 1) if (x := look(i, i + 1))]
    heapify(heap)
    gone = -2
    while heap:
        _, i, j, made = heappop(heap)
        a, b = symbols[i], symbols[j]
        if a == gone or b == gone or after[i] != j or single.get(a * size + b, (0, gone))[1] != made:
            continue
        symbols[i], symbols[j] = made, gone
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if x := look(i, k):
                heappush(heap, x)
        if before[i] >= 0 and (x := look(before[i], i)):
            heappush(heap, x)
    return [s for s in symbols if s != gone]


class PieceTokenizer:
    """Ids and decoded texts as the sentencepiece library gives them for a BPE model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        if library.normalize(" a  Ａb  ") != f"{MARK}{MARK}a {MARK}Ａb{MARK}{MARK}":
            raise ValueError("the model must keep texts as they are but for blanks and one mark before them")
        names = [library.id_to_piece(i) for i in range(size)]
        own = [i for i in range(size) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        if any(library.is_unused(i) for i in own):
            raise ValueError("unused pieces are not supported")
        self.bytes = np.array([library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        if not all(library.is_byte(int(i)) for i in self.bytes):
            raise ValueError("the model must have a piece for every byte")
        self.said = [n.replace(MARK, " ").encode() for n in names]
        for b, i in enumerate(self.bytes.tolist()):
            self.said[i] = bytes([b])
        self.ranks = MergeRanks({names[i]: (i, library.get_score(i)) for i in own}, size)
        self.single = np.full(0x110000, -1, np.int32)
        beside = set()
        for i in own:
            if len(names[i]) == 1:
                self.single[ord(names[i])] = i
            beside |= {ord(a) << 21 | ord(b) for a, b in zip(names[i], names[i][1:], strict=False)}
        self.beside = np.array(sorted(beside), np.int64)
        self.merger = Merger(self._merge)

    def apart(self, codes: np.ndarray) -> np.ndarray:
        """Whether each code point but the last can never be merged with the next one."""
        pairs = codes[:-1].astype(np.int64) << 21 | codes[1:]
        if not len(self.beside):
            return np.ones(len(pairs), bool)
        return self.beside[np.minimum(np.searchsorted(self.beside, pairs), len(self.beside) - 1)] != pairs

    def _merge(self, words: list[str]) -> list[list[int]]:
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.single[codes].astype(np.int64)
        symbols = np.where(symbols < 0, -3 - codes.astype(np.int64), symbols)  # unknown characters stay themselves
        long = sizes > ROUNDS
        of = np.repeat(long, sizes)
        flat, counts = merge_rounds(symbols[~of], sizes[~long], self.ranks)
        cuts = np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []
        short = iter(cuts)
        ends = np.cumsum(sizes)
        lists = [merge_long(symbols[end - n : end].tolist(), self.ranks) if n > ROUNDS else next(short).tolist() for n, end in zip(sizes.tolist(), ends.tolist(), strict=True)]
        return [ids if min(ids, default=0) >= 0 else [x for i in ids for x in self._fallback(i)] for ids in lists]

    def _fallback(self, i: int) -> list[int]:
        return [i] if i >= 0 else self.bytes[list(chr(-3 - i).encode())].tolist()

    def chunks(self, text: str, size: int = CHUNK) -> Iterator[str]:
        """Parts of a marked text, cut between characters that cannot be merged."""
        at = 0
        while len(text) - at > size:
            reach = size
            while True:
                codes = np.frombuffer(text[at : at + reach + 1].encode("utf-32-le"), np.uint32)
                cuts = np.flatnonzero(self.apart(codes))
                if len(cuts) or at + reach + 1 >= len(text):
                    break
                reach *= 2
            if not len(cuts):
                break
            end = at + int(cuts[-1]) + 1
            yield text[at:end]
            at = end
        if at < len(text):
            yield text[at:]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bytes, bytes]]:
        """Of each marked text or part of one: ids, ids in decimal joined by commas, and decoded bytes."""
        layout = lay_out(texts)
        if not len(layout.codes):
            return [(np.zeros(0, np.int64), b"", b"") for _ in texts]
        starts = layout.first.copy()
        starts[1:] |= self.apart(layout.codes)
        pieces = distinct_pieces(layout, starts)
        table = self.merger.table(pieces)
        forms = table.of(np.arange(len(pieces.words))).tolist()
        ends = np.cumsum(table.sizes).tolist()
        shown = [",".join(map(str, forms[a:b])).encode() for a, b in zip([0, *ends], ends, strict=False)]
        said = [b"".join([self.said[i] for i in forms[a:b]]) for a, b in zip([0, *ends], ends, strict=False)]
        ids = table.of(pieces.forms)
        lengths = np.bincount(pieces.rows, weights=table.sizes[pieces.forms], minlength=len(texts)).astype(np.int64)
        ids_of = np.split(ids, np.cumsum(lengths)[:-1])
        cut = np.searchsorted(pieces.rows, np.arange(len(texts) + 1))
        all_forms = pieces.forms.tolist()
        out = []
        for k in range(len(texts)):
            own = all_forms[cut[k] : cut[k + 1]]
            out.append((ids_of[k], b",".join([shown[f] for f in own]), b"".join([said[f] for f in own])))
        return out


@lru_cache(maxsize=2)
def piece_tokenizer(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def encode_decode_pieces(documents: DataFrame, model: str, *, key: str = "doc_id", keep: bool = True, chunk: int = CHUNK) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` of every row, and with ``keep`` also ``ids`` and ``decoded``.

    ``model`` is a BPE model file of the sentencepiece library, readable on every executor. Digests are over
    decimal ids joined by commas and over the decoded text in UTF-8. There is no shuffle; a task holds one
    slice of texts, and a text of over ``chunk`` characters is encoded in parts of about that size, cut where
    nothing can be merged (a part without such a place is as long as it takes). A null or empty text has no
    ids and decodes to an empty text; ties of rank are merged from the left; null keys and repeated rows are
    kept, one result per row; an empty table gives no rows; other columns are not read.
    """

    def whole(tokenizer: PieceTokenizer, text: str) -> tuple:
        n, digest, said_digest, ids, said, first = 0, hashlib.sha256(), hashlib.sha256(), [], [], True
        for part in tokenizer.chunks(marked(text), chunk):
            (own, shown, own_said), = tokenizer.encode([part])
            n += len(own)
            digest.update(shown if first else b"," + shown)
            own_said = own_said[1:] if first else own_said
            said_digest.update(own_said)
            first = False
            if keep:
                ids.append(own)
                said.append(own_said)
        return n, digest.hexdigest(), said_digest.hexdigest(), np.concatenate(ids) if ids else [], b"".join(said).decode()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokenizer = piece_tokenizer(model)
        for batch in batches:
            for part, texts in text_slices(batch):
                encoded = tokenizer.encode(["" if len(t) > chunk else marked(t) for t in texts])
                found = [
                    whole(tokenizer, t) if len(t) > chunk
                    else (len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256(said[1:]).hexdigest(), ids, said[1:].decode() if keep else "")
                    for t, (ids, shown, said) in zip(texts, encoded, strict=True)
                ]
                n, ids_sha, said_sha, ids, said = zip(*found, strict=True)
                out = {key: part.column(key), "n_tokens": list(n), "ids_sha256": list(ids_sha), "decoded_sha256": list(said_sha)}
                if keep:
                    out |= {"ids": list(ids), "decoded": list(said)}
                yield out

    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>, decoded string" * keep
    return map_batches(documents.select(key, "text"), work, schema)

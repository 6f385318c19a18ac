"""Personal data: exact base patterns, and identifiers found by bootstrapped contextual extraction.

The base spans of all texts are the seeds; the words before a seed are its lexical patterns. What follows the
same words elsewhere is an instance too: for addresses, cards and phones a run of digits with blanks, hyphens,
dots and brackets or a word with digits, for emails any word. Runs are few and kept as a graph; words are looked
up in the texts, after patterns of emails only. Spark scores the graph of patterns and instances in rounds: a
pattern is trusted by the share of its distinct instances that are known to be of one kind. What follows a
trusted pattern is scored over all patterns it occurs with: each word before it counts once, by the odds that
the better of its patterns is followed by that kind, so words that others than this kind follow speak against
it. Instances that pass are known in the next round; after a round without new ones every occurrence of one
that no base pattern covers is a span of its own.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.batches import map_batches, text_slices
from scorewright.llm.filters import BITS, bitmap
from scorewright.storage import materialize

KINDS = ("email", "ip", "card", "phone")
#: All names of spans: credentials are marked, too, but as no part of the base.
NAMES = (*KINDS, "secret")
#: A trusted pattern's least number of known instances and least share; an instance's least score.
SUPPORT, SHARE, SCORE = 5, 0.7, 0.7
#: Share of the texts that patterns of emails are tried on before all texts are read for those that are left.
SOME = 1 / 16
#: Cells that limits of patterns are sent to tasks in; pairs that a task remembers as seen; a longer instance is named by its digest.
CELLS, SEEN, NAMED = 1 << 20, 1 << 19, 64

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_RUN = re.compile(r"\+?\(?[0-9](?:[\x20().-]*[0-9])*")
_SECRET = re.compile(r"(?i)(?<![A-Za-z0-9])(?:tokens?|secrets?|passwords?|passwd|api[_-]?keys?|access[_-]?keys?)[\"']?\s{0,4}[:=]\s{0,4}[\"']?([A-Za-z0-9+/_.~-]{16,})")
_WORD = re.compile(r"\S+")
_GAP = re.compile(r"\s{20}")
_EDGES = "\"'`()[]{}<>,.;:!?*"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Linear in the text: each at sign looks left no further than the one before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        left = at
        while left > done and text[left - 1] in _LOCAL:
            left -= 1
        if left < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield left, done
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time of each chain of numbers, so that long runs of digits are read once."""
    for chain in _CHAIN.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) << (i & 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    found = [(0, a, b) for a, b in _emails(text)]
    found += [(1, a, b) for a, b in _addresses(text)]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return found


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    """Credentials: what is assigned to a name of one, if it holds at least 16 characters, of them letters and digits."""
    if "=" not in text and ":" not in text:
        return []
    found = [(m.group(1), *m.span(1)) for m in _SECRET.finditer(text)]
    return [(len(KINDS), a, b) for said, a, b in found if any(map(str.isdigit, said)) and any(map(str.isalpha, said))]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{NAMES[k]}:{a}:{b}" for k, a, b in spans])


def _stripped(text: str, a: int, b: int) -> tuple[int, int]:
    """Without edges; a bracket that opens an area code stays."""
    while a < b and text[a] in _EDGES and not (text[a] == "(" and text[a + 1 : a + 2].isdigit() and ")" in text[a + 1 : b - 1]):
        a += 1
    while a < b and text[b - 1] in _EDGES:
        b -= 1
    return a, b


def _free(a: int, b: int, taken: list[tuple[int, int]], at: int) -> tuple[bool, int]:
    """Whether a place touches no base span, and the first span that may touch a later one."""
    while at < len(taken) and taken[at][1] <= a:
        at += 1
    return a < b and (at == len(taken) or taken[at][0] >= b), at


def _numbers(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of digits that touch no base span, with the rest of their first and last word, and the later words of a run."""
    shown = text
    if taken:  # a run ends where a base span begins
        parts, done = [], 0
        for a, b in taken:
            if b > done:
                parts += [text[done : max(a, done)], "\0" * (b - max(a, done))]
                done = b
        shown = "".join([*parts, text[done:]])
    done = at = 0
    for m in _RUN.finditer(shown):
        if m.end() <= done:
            continue
        a, b = max(done, m.start()), m.end()
        while a > done and not text[a - 1].isspace() and text[a - 1] not in "=:":
            a -= 1
        done = w.end() if (w := _WORD.match(text, b)) else b
        words = [x.span() for x in _WORD.finditer(text, a, done)]
        for place in [(a, done), *words[1:]]:
            x, y = _stripped(text, *place)
            free, at = _free(x, y, taken, at)
            if free:
                yield x, y


def _words(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The word at a place and what follows its last colon or equals sign, without edges."""
    a, b = _stripped(text, start, end)
    if a < b:
        yield a, b
        if (cut := max(text.rfind(":", a, b), text.rfind("=", a, b)) + 1) > 0:
            a, b = _stripped(text, cut, b)
            if a < b:
                yield a, b


def _named(kind: str, text: str) -> str:
    low = text.lower()
    return kind + (low if len(low) <= NAMED else "#" + hashlib.sha256(low.encode()).hexdigest())


def _cell(text: str, cells: int) -> int:
    return zlib.crc32(text.encode()) % cells


def _even(word: str) -> str:
    """In small letters, with digits made equal."""
    low = word.lower()
    return low if low.isalpha() else re.sub(r"[0-9]+", "0", low)


def _patterns(words: list[str]) -> list[str]:
    return ["1 " + "".join(words[-1:]), "2 " + " ".join(words)][: len(words)]


def _context(text: str, start: int) -> list[str]:
    """The lexical patterns of a place: one and two words before it, with digits made equal."""
    return _patterns([_even(w) for w in text[max(0, start - 96) : start].split()[-2:]])


def _scan(key: str, extra: list[str], words: bytes | None = None):
    """Base spans and runs of digits of each text; of its words those that are marked in ``words``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part, texts in text_slices(batch):
                base, secrets = [base_spans(t) for t in texts], [secret_spans(t) for t in texts]
                instances = []
                for text, spans, hidden in zip(texts, base, secrets, strict=True):
                    taken = sorted((a, b) for _, a, b in [*spans, *hidden])
                    own = [(k, a, b, "s") for k, a, b in spans] + [(-1, a, b, "n") for a, b in _numbers(text, taken)]
                    if words is not None:
                        own += [(-1, a, b, "w") for a, b in _marked_words(text, taken, words)]
                    marked = [{"kind": k, "start": a, "end": b, "instance": _named(c, text[a:b]), "patterns": _context(text, a)} for k, a, b, c in own]
                    instances.append(marked + [{"kind": k, "start": a, "end": b, "instance": None, "patterns": []} for k, a, b in hidden])
                yield {c: part.column(c) for c in (key, "uid", *extra)} | {
                    **{f"n_{name}": [sum(s[0] == k for s in spans) for spans in base] for k, name in enumerate(KINDS)},
                    "n_secret": list(map(len, secrets)),
                    "base_sha256": [hashlib.sha256(written(spans).encode()).hexdigest() for spans in base],
                    "instances": instances,
                }

    return work


def _marked_words(text: str, taken: list[tuple[int, int]], bits: bytes) -> Iterator[tuple[int, int]]:
    at = 0
    for m in _WORD.finditer(text):
        for a, b in _words(text, *m.span()):
            cell = _cell(_named("w", text[a:b]), BITS)
            if bits[cell >> 3] >> (cell & 7) & 1:
                free, at = _free(a, b, taken, at)
                if free:
                    yield a, b


def _pairs_of_words(bits: bytes):
    """Distinct pairs of a pattern and a word marked in ``bits``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: set[tuple[str, str]] = set()
        for batch in batches:
            for _, texts in text_slices(batch):
                found = set()
                for text in filter(None, texts):
                    taken = sorted((a, b) for _, a, b in base_spans(text))
                    found |= {(p, _named("w", text[a:b])) for a, b in _marked_words(text, taken, bits) for p in _context(text, a)}
                found -= seen
                if len(seen) >= SEEN:
                    seen.clear()
                seen |= found
                yield {"pattern": [p for p, _ in found], "instance": [i for _, i in found]}

    return work


def _pairs_of_patterns(last: np.ndarray, limits: np.ndarray):
    """Distinct pairs of a pattern with a limit and a word that follows it, of each pattern no more than just over the limit in a task."""

    ends_at = last.astype(np.uint8).tobytes()

    class Ends(dict):
        """Of a word: 1 if it may end a pattern, 2 if a place within it may follow one."""

        def __missing__(self, word: str) -> int:
            if len(self) >= SEEN:
                self.clear()
            found = int(ending(word))
            if not word.isalpha() and (word[0] in _EDGES or ":" in word or "=" in word):
                found |= 2 * any(ending(word[:a]) for a, _ in _words(word, 0, len(word)) if a)
            self[word] = found
            return found

    def ending(word: str) -> bool:  # a context cuts words that are far back
        return len(word) > 24 or ends_at[zlib.crc32(_even(word).encode()) % CELLS] > 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        ends, seen, held = Ends(), {}, 0
        over: set[tuple[str, ...]] = set()  # words before a place whose patterns have no limit, or are over it here

        def wanted(before: tuple[str, ...]) -> bool:
            if before in over:
                return False
            if any((n := limits[_cell(p, CELLS)]) and len(seen.get(p, ())) <= n for p in _patterns(list(map(_even, before)))):
                return True
            over.add(before)
            return False

        for batch in batches:
            for _, texts in text_slices(batch):
                pairs: list[tuple[str, str]] = []
                for text in filter(None, texts):
                    words = text.split()
                    if _GAP.search(text):
                        places = range(len(words))
                    else:
                        flags = list(map(ends.__getitem__, words))
                        marked = [k for k, f in enumerate(flags) if f]
                        places = [(k, False) for k in marked if flags[k] & 2]
                        places += [(k + 1, len(words[k]) <= 24 and (not k or len(words[k - 1]) <= 24)) for k in marked if flags[k] & 1 and k + 1 < len(words) and not flags[k + 1] & 2]
                        places = [k for k, short in places if not short or wanted(tuple(words[max(0, k - 2) : k]))]
                    if not places:
                        continue
                    spans, taken, at = [m.span() for m in _WORD.finditer(text)], None, 0
                    for k in sorted(places):
                        for a, b in _words(text, *spans[k]):
                            for p in _context(text, a):
                                limit = int(limits[_cell(p, CELLS)])
                                if not limit or len(own := seen.setdefault(p, set())) > limit:
                                    continue
                                if taken is None:
                                    taken = sorted((x, y) for _, x, y in base_spans(text))
                                free, at = _free(a, b, taken, at)
                                if free and (name := _named("w", text[a:b])) not in own:
                                    own.add(name)
                                    held += 1
                                    pairs.append((p, name))
                yield {"pattern": [p for p, _ in pairs], "instance": [i for _, i in pairs]}
                if held >= SEEN:
                    seen, held = {}, 0
                if len(over) >= SEEN or not seen:
                    over.clear()

    return work


def _limits(patterns: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In cells of a fixed number: whether a word ends a pattern, and the largest limit of the patterns there."""
    found = []
    for text in (F.substring_index("pattern", " ", -1), F.col("pattern")):
        cells = patterns.groupBy(F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(CELLS)).alias("cell")).agg(F.max("limit").alias("limit")).toArrow()
        found.append(np.zeros(CELLS, np.int64))
        found[-1][cells.column("cell").to_numpy()] = cells.column("limit").to_numpy()
    return found[0] > 0, found[1]


def _bits(instances: DataFrame) -> bytes:
    return bitmap(instances.select(F.crc32(F.encode("instance", "UTF-8")).alias("cell")), "cell").tobytes()


def find_personal_data(documents: DataFrame, *, key: str = "doc_id", carry: tuple[str, ...] = (), rounds: int | None = None, support: int = SUPPORT, share: float = SHARE, score: float = SCORE) -> DataFrame:
    """``key, n_email, n_ip, n_card, n_phone, n_secret, base_sha256, spans, n_found, places`` of every row.

    Counts and digest are of the base spans; ``spans`` writes all of them as ``kind:start:end`` and
    ``places`` holds them as an array, ``n_found`` counts those that the method added. ``n_secret`` counts
    credentials (:func:`secret_spans`), which are spans but neither base nor seeds. Columns named in
    ``carry`` are returned unchanged. The scan's result, far smaller than the texts, is stored once in the
    shared folder; scoring works on distinct pairs of pattern and instance. The texts are read again for the
    words after patterns of emails, as long as there are new ones. Rounds go on until one adds no instance, or
    to ``rounds``. A null or empty text has no spans; null keys
    and repeated rows are kept, one result per row; an empty table gives no rows; other columns are not read.
    Texts of any length are read whole, and of overlapping spans all stay.
    """
    fields = {f.name: f.dataType.simpleString() for f in documents.schema}
    carried = [c for c in carry if c != key]
    taken = documents.select(key, "text", *[c for c in carried if c != "text"], F.monotonically_increasing_id().alias("uid"))
    schema = f"`{key}` {fields[key]}, uid long, " + "".join(f"`{c}` {fields[c]}, " for c in carried)
    schema += ", ".join(f"n_{k} long" for k in KINDS) + ", n_secret long, base_sha256 string, instances array<struct<kind:int,start:int,end:int,instance:string,patterns:array<string>>>"
    scanned = materialize(map_batches(taken, _scan(key, carried), schema))
    texts, pairs = documents.select("text"), "pattern string, instance string"

    edges = (
        scanned.select(F.explode("instances").alias("i")).select("i.kind", "i.instance", F.explode("i.patterns").alias("pattern"))
        .groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    )
    labelled = materialize(edges)
    new_words = True
    for _ in count() if rounds is None else range(rounds):  # what is known only grows, so it ends
        counts = [F.count_if(F.col("kind") == k).alias(f"k{k}") for k in range(len(KINDS))]
        most = F.greatest(*[f"k{k}" for k in range(1, len(KINDS))])
        counted = labelled.groupBy("pattern").agg(F.count("*").alias("n"), F.count_if(F.col("kind") >= 0).alias("known"), *counts)
        patterns = (
            counted.select("pattern", "n", most.alias("most"), (most / (F.col("n") + 1)).alias("trust"), F.coalesce(*[F.when(F.col(f"k{k}") == most, k) for k in range(1, len(KINDS))]).alias("pattern_kind"))
            .where((F.col("most") >= support) & (F.col("trust") >= share) & (F.col("most") < F.col("n")))
        )
        candidates = labelled.where("kind < 0").join(patterns.select("pattern", "trust", "pattern_kind"), "pattern")
        mails = words = None
        if new_words:  # nothing else changes what is known of a pattern of emails
            mails = materialize(counted.where(F.col("k0") >= support).where(F.col("k0") / (F.col("known") + 1) >= share).select("pattern", "known", "k0", F.floor(F.col("k0") / share).alias("limit")))
            new_words = False
        for some in (texts.sample(SOME, seed=0), texts) if mails is not None else ():  # what follows in some texts rejects most patterns
            if mails.isEmpty():
                mails = None
                break
            after = map_batches(some, _pairs_of_patterns(*_limits(mails)), pairs).join(mails, "pattern", "left_semi").distinct()
            unknown = materialize(after.join(labelled.where("kind >= 0").select("pattern", "instance"), ["pattern", "instance"], "left_anti"))
            followed = mails.join(unknown.groupBy("pattern").agg(F.count("*").alias("n")), "pattern", "left")
            mails = materialize(followed.withColumn("trust", F.col("k0") / (F.coalesce("n", F.lit(0)) + F.col("known") + 1)).where(F.col("trust") >= share).select(*mails.columns[:4], "trust"))
        if mails is not None:
            words = materialize(unknown.join(mails, "pattern").select("pattern", "instance", F.lit(-1).alias("kind"), "trust", F.lit(0).alias("pattern_kind")))
            candidates = candidates.unionByName(words)
        chosen = materialize(candidates.groupBy("instance").agg(F.max_by("pattern_kind", "trust").alias("found_kind")))
        kind_known = F.get(F.array(*[f"k{k}" for k in range(len(KINDS))]), F.col("found_kind"))
        evidence = labelled.where("kind < 0").join(chosen, "instance").join(counted, "pattern").select("pattern", "instance", "found_kind", "n", kind_known.alias("k"))
        everywhere = None
        if words is not None and not words.isEmpty():
            chosen_words = chosen.where(F.col("instance").startswith("w"))
            everywhere = materialize(map_batches(texts, _pairs_of_words(_bits(chosen_words)), pairs).distinct().join(chosen_words, "instance"))
            followers = everywhere.groupBy("pattern").agg(F.count("*").alias("n"))  # of other patterns than trusted ones, the least number
            evidence = evidence.unionByName(
                everywhere.join(followers, "pattern").join(counted.select("pattern", "known", "k0"), "pattern", "left")
                .select("pattern", "instance", "found_kind", (F.col("n") + F.coalesce("known", F.lit(0))).alias("n"), F.coalesce("k0", F.lit(0)).alias("k"))
            )
        known = materialize(
            evidence.groupBy("instance", "found_kind", F.substring_index("pattern", " ", -1).alias("last")).agg(F.max(F.log((F.col("k") + 1) / (F.col("n") - F.col("k") + 1))).alias("odds"))
            .groupBy("instance", "found_kind").agg(F.sum("odds").alias("odds")).where(1 / (1 + F.exp(-F.col("odds"))) >= score).select("instance", "found_kind")
        )
        if known.isEmpty():
            break
        grown = labelled.join(known, "instance", "left").select("pattern", "instance", F.when(F.col("kind") < 0, F.coalesce("found_kind", F.lit(-1))).otherwise(F.col("kind")).alias("kind"))
        found_words = known.where(F.col("instance").startswith("w"))
        if everywhere is not None and not found_words.isEmpty():
            new_words = True
            grown = grown.unionByName(everywhere.join(found_words, "instance", "left_semi").select("pattern", "instance", F.lit(0).alias("kind")))
        labelled = materialize(grown)
    found = materialize(labelled.where("kind >= 0 and instance not like 's%'").groupBy("instance").agg(F.max("kind").alias("found_kind")))
    found_words = found.where(F.col("instance").startswith("w"))
    if not found_words.isEmpty():
        scanned = materialize(map_batches(taken, _scan(key, carried, _bits(found_words)), schema))
    places = scanned.select("uid", F.explode("instances").alias("i")).select("uid", "i.*")
    added = materialize(
        places.where("kind < 0").join(found, "instance")
        .groupBy("uid").agg(F.array_distinct(F.collect_list(F.struct(F.col("found_kind").alias("kind"), "start", "end"))).alias("added"))
    )
    spans = F.array_sort(F.concat(
        F.transform(F.filter("instances", lambda i: i.kind >= 0), lambda i: F.struct(i.kind.alias("kind"), i.start.alias("start"), i.end.alias("end"))),
        F.coalesce("added", F.array().cast("array<struct<kind:int,start:int,end:int>>")),
    ))
    names = F.array(*map(F.lit, NAMES))
    text = F.array_join(F.transform("places", lambda p: F.concat_ws(":", F.get(names, p.kind), p.start, p.end)), ",")
    return (
        scanned.join(added, "uid", "left").withColumn("places", spans)
        .select(key, *carried, *[f"n_{k}" for k in NAMES], "base_sha256", text.alias("spans"), F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_found"), "places")
    )


def redact(documents: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """``documents`` with every span of :func:`find_personal_data` replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. A null text stays null.
    """
    others = [F.col(f"`{c}`") for c in documents.columns if c not in (key, "text")]
    folded = documents.select(key, "text", F.struct(F.lit(0).alias(key), *others).alias("others"))
    found = find_personal_data(folded, key=key, carry=("text", "others"))
    fields = {f.name: f.dataType.simpleString() for f in folded.schema}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            places = batch.column("places").to_pylist()
            texts = batch.column("text").to_pylist()
            yield {c: batch.column(c) for c in (key, "others")} | {"text": [t and _masked(t, p) for t, p in zip(texts, places, strict=True)]}

    masked = map_batches(found.select(key, "text", "others", "places"), work, ", ".join(f"`{c}` {fields[c]}" for c in folded.columns))
    return masked.select(*[F.col(c if c in (key, "text") else f"others.`{c}`").alias(c) for c in documents.columns])


def _masked(text: str, places: list[dict]) -> str:
    out, done = [], 0
    for p in sorted(places, key=lambda p: (p["start"], -p["end"])):
        if p["start"] >= done:
            out += [text[done : p["start"]], f"<{NAMES[p['kind']]}>"]
        done = max(done, p["end"])
    return "".join([*out, text[done:]])

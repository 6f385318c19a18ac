"""Awkward documents that every operator must stand."""

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix bold potions near quiet harbours at dawn".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 2654435761 % 2**32
    for _ in range(n):
        x = (x * 1664525 + 1013904223) % 2**32
        out.append(WORDS[x >> 16 & 0xFFFF and (x >> 16) % len(WORDS)] + (str(x % 97) if x % 5 == 0 else ""))
    return " ".join(out)


PASSAGE = prose(99, 70)
TEXTS = [
    None, "", " \n\t ", "one", "one two three four", "a" * 1000, "é中🙂 \u0085x y", "x\x00y <|endoftext|> z<|startoftext|>",
    prose(1, 60), prose(1, 60), prose(1, 59) + " other", prose(2, 300), prose(2, 300) + " tail end here", prose(3, 50) + "\n" + PASSAGE,
    PASSAGE + " " + prose(4, 40), "mail ann@example.com or +1 (319) 555-5132 at 10.1.2.3", prose(5, 3000), PASSAGE.upper(),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, own string, spans int, component_id string, uid string, score string, others int, part string"


def rows() -> list[tuple]:
    made = [(i, t, None if i % 3 else "en", "s", None if t is None else len(t), "own", i, "c", "u", "x", 7, "p") for i, t in enumerate(TEXTS)]
    return [*made, made[8], made[8], (None, prose(1, 60), None, None, None, None, None, None, None, None, None, None), (None, None, *[None] * 10)]


def documents(spark, some=None):
    """Awkward rows, over several partitions; columns clash with names that operators use inside."""
    return spark.createDataFrame(rows() if some is None else some, SCHEMA).repartition(3)

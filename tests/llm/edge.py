"""Edge rows shared by the operator tests: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Columns beside those of ``documents``, named like columns that operators make.
CLASHING = ("n_words", "size", "shard", "slot", "node", "quality", "rule", "start", "kept", "row_key", "t", "w", "id",
            "before", "target", "source_size", "firsts", "block_words", "first", "vslot", "place", "low", "n", "rank", "block",
            "words", "total", "weight", "cap", "copy", "draws", "__q_t", "__row_key", "base", "terms", "spans", "items", "band")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"{c} string" for c in CLASHING))


def lower(text: str | None) -> str:
    return (text or "").encode("utf-8").lower().decode("utf-8")


def prose(rng: random.Random, words: int, vocab: int = 400) -> str:
    out = []
    for i in range(words):
        w = "".join(rng.choice(["an", "the", "or", "ti", "ou", "re", "é", "st"]) for _ in range(rng.randint(1, 4)))
        out.append(f"{w}{rng.randint(0, vocab)}" if rng.random() < 0.5 else w)
        if i % 9 == 8:
            out[-1] += "."
        if i % 23 == 22:
            out[-1] += "\n"
    return " ".join(out)


def texts(seed: int = 3) -> list[str | None]:
    rng = random.Random(seed)
    base = [prose(rng, n) for n in (60, 120, 300, 75, 200)]
    near = base[2].split(" ")
    near[10] = "changed"
    far = base[2].split(" ")
    for i in range(0, len(far), 12):
        far[i] = "other"
    return [None, "", "   \n\t ", "one", "One", "two words", "a b c d", "A B C D", *base, base[1], base[1].upper(),
            " ".join(near), " ".join(far), prose(rng, 6000), "x" * 50_000, "   \x1c\x85 non ascii blanks 　",
            "same line.\nsame line.\n\nsame line.\n" * 20, "&&& word### other$$$ " * 40, "home | news | about | contact\n" * 5]


def documents(spark, extra: list[tuple] = (), rows: list[str | None] | None = None):
    """The edge texts as documents; the last two rows repeat, one id is null, one id has two texts."""
    listed = texts() if rows is None else rows
    ids = [(i, t) for i, t in enumerate(listed)] + ([(None, "no id at all"), (5, "another text of id five"),
                                                    (3, listed[3]), (3, listed[3])] if rows is None else [])
    made = [(i, t, "en", None if n % 7 == 0 else f"src{n % 3}", None if t is None else len(t), *["clash"] * len(CLASHING))
            for n, (i, t) in enumerate([*ids, *extra])]
    return spark.createDataFrame(made, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                                                for x in r))

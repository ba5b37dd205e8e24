"""Small tables with every awkward case, and brute-force versions to hold operators against."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    """A-Z lower-cased, nothing else."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def prose(seed: int, n: int, vocabulary: int = 300) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{int(draw.expovariate(8) * vocabulary)}" for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, odd letters, repeated rows."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r", "en", "a", 6),
        (4, "one", "en", "b", 3),
        (5, "Éclair naïve \U0001f600 ΣΑΣ ſecret Key", "fr", "é", 30),
        (6, prose(6, 30_000), "en", "b", None),
        (7, "x" * 200_000, "en", "b", None),
        (8, "7" * 60_000 + " " + "a@" * 30_000, "en", None, None),
    ]
    copy = prose(9, 120)
    rows += [(i, copy, "en", "b", len(copy)) for i in (9, 10, 11)]
    rows += [(11, copy, "en", "b", len(copy))] * 2
    return rows


def corpus(n: int = 60) -> list[tuple]:
    """Awkward rows and ordinary ones, some near copies of others."""
    draw = random.Random(5)
    rows = awkward_rows()
    for i in range(100, 100 + n):
        text = prose(i, draw.randint(3, 200))
        rows.append((i, text, "en", draw.choice("abc"), len(text)))
        parts = text.split(" ")
        for k in range(draw.choice([0, 0, 1, 3])):
            changed = list(parts)
            for _ in range(max(1, len(parts) // 60)):
                changed[draw.randrange(len(changed))] = f"new{k}"
            rows.append((1000 * (k + 1) + i, " ".join(changed), "en", "c", None))
    return rows

"""Hand-made documents with the awkward cases every operator must handle, and brute-force pieces."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, size int, shard string, row int"


def words(seed: int, n: int, stock: int = 400) -> list[str]:
    r = random.Random(seed)
    return ["w" + "".join(r.choice("abcdefghij") for _ in range(3 + r.randrange(stock) % 4)) for _ in range(n)]


def prose(seed: int, n: int) -> str:
    w = words(seed, n)
    return "\n".join(" ".join(w[i:i + 17]) for i in range(0, n, 17))


def changed(text: str, every: int) -> str:
    """One word in ``every`` replaced."""
    parts = re.split(r"(\s+)", text)
    return "".join(f"x{i}" if i % (2 * every) == 2 * every - 2 else p for i, p in enumerate(parts))


def awkward_docs(spark, extra=()):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long_text = prose(99, 30_000)
    rows = [
        (1, prose(1, 300), "en", "a"), (2, prose(1, 300), "en", "a"), (3, changed(prose(1, 300), 60), "en", "b"),
        (4, prose(4, 200), "de", "b"), (4, prose(4, 200), "de", "b"), (5, None, "en", "a"), (6, "", None, None),
        (7, " \t\n", "fr", "c"), (None, prose(8, 120), None, "c"), (None, None, None, None), (9, long_text, "es", None),
        (10, "one two", "en", "d"), (11, prose(11, 80), "en", "é"), *extra,
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "k", i, "s", None) for i, r in enumerate(rows)], DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def tokens(text: str | None) -> list[str]:
    return re.findall(r"[^ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingles(w: list[str]) -> set:
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

"""Small documents with everything that goes wrong, and plain versions of the operators' rules."""

from __future__ import annotations

import itertools
import random
import re

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, n_words string"


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdeéou") for _ in range(1 + v % 7)) + str(v % 3 or "") for v in (draw.randrange(vocabulary) for _ in range(n))]


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    base = words(1, 120)
    near = base.copy()
    near[60] = "changed"
    long = words(2, 20_000)
    texts = [
        " ".join(base), " ".join(near), " ".join(base), None, "", " \t\n", "one", "two words", " ".join(long),
        "\n".join(["same line again"] * 30), "İß   non blank   blanks", " ".join(words(3, 60)) + "\n" + " ".join(base[20:60]),
        "mail a.b@c.example.org ip 10.0.0.1 card 4111 1111 1111 1111 call +1 (555) 555-0100", "Released under the MIT License.\nMIT license mit LICENSE",
    ]
    rows = [(i, t, "en" if i % 2 else "de", f"src{i % 3}", len(t or ""), 0.5, i, "x") for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[0], None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (99, texts[0], "en", None, 1, None, None, None)]
    return spark.createDataFrame(rows, ODD_SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


def blank_words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lowered(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None) -> set[tuple[str, ...]]:
    split = blank_words(lowered(text or ""))
    if not split:
        return set()
    return {tuple(split[i:i + 5]) for i in range(max(1, len(split) - 4))}


def near_components(documents: list[tuple[int, str | None]], percent: int = 75) -> dict[int, int]:
    """Least reachable id per id, from all pairs."""
    sets = {i: shingles(t) for i, t in documents}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((top(a), top(b)))
            label[q] = p
    return {i: top(i) for i in sets}

"""Small documents with everything that may go wrong in them."""

from __future__ import annotations

import random
import re

LOWER = {i: i + 32 for i in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, toxicity string, _key string, digest string"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    words = [f"{rng.choice('abcdéßñ')}{rng.randrange(vocabulary):x}{rng.choice(['', 'A', 'ou', '.'])}" for _ in range(n)]
    lines, at = [], 0
    while at < n:
        step = rng.randrange(5, 40)
        lines.append(" ".join(words[at : at + step]))
        at += step
    return "\n".join(lines)


def texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Originals, exact and near copies, chains of edits, odd texts, ties and repeated rows."""
    rng = random.Random(seed)
    out: list[tuple[int | None, str | None]] = []
    base = [prose(rng, rng.randrange(60, 300)) for _ in range(12)]
    base[1] = prose(rng, 300)
    out += list(enumerate(base))
    out += [(100 + i, base[0]) for i in range(90)]  # more than one block of copies
    words = base[1].split(" ")
    for i in range(130):  # a near group larger than a block, with outliers
        w = list(words)
        for _ in range(i % 14):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        out.append((300 + i, " ".join(w)))
    w = base[2].split(" ")
    for i in range(8):  # a chain: each like the one before it
        for _ in range(2):
            w[rng.randrange(len(w))] = f"chain{rng.randrange(10**6)}"
        out.append((500 + i, " ".join(w)))
    out += [(600, None), (601, ""), (602, " \t\n\x0b"), (603, "one"), (604, "ONE"), (605, "two words"), (606, "Two  Words\n")]
    out += [(607, "\x00 \x7f| ... !!"), (608, prose(rng, 30_000, 20_000)), (609, "x" * 200_000), (610, base[3].upper())]
    out += [(700, base[4]), (700, base[4]), (None, base[5]), (None, None)]
    return out


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    made = [(i, t, "en", f"s{(i or 0) % 3}" if i != 3 else None, len(t or ""), -1, "x", "k", "d") for i, t in rows]
    return spark.createDataFrame(made, SCHEMA).repartition(3)


def lower(text: str | None) -> str:
    return (text or "").translate(LOWER)


def shingles(text: str | None, width: int) -> frozenset:
    w = SPACED.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))

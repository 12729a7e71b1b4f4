"""Plain single-machine versions of the text operators, and rows that are odd on purpose."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Names that the operators use inside.
EXTRA = "mark long, doc long, h string, score string, kept0 string, drops string, p int, `row` int"

LONG = "\n".join(f"line {i} of a very long text that goes on and on without an end" for i in range(3000))
SHARED = "A line of more than forty characters that a number of documents share."
POEM = " ".join(f"word{i}" for i in range(60))
ODD: list[tuple[int | None, str | None]] = [
    (1, None), (2, ""), (3, "one"), (4, LONG), (5, POEM), (6, POEM), (7, POEM + " more"),
    (7, POEM + " more"), (8, f"{SHARED}\nfirst"), (9, f"  {SHARED.upper()}\t\nsecond"),
    (10, f"{SHARED}\n{SHARED}"), (11, f"third\n{SHARED}\n"), (12, SHARED), (None, POEM),
    (None, SHARED), (None, None), (13, " \n\t "), (14, "Straße ÉTÉ 日本語 😀 <|endoftext|> it's"),
    (15, "x" * 5000), (16, "\x00\x1c\x85"), (17, "a b c d e f g h " * 200),
]


def documents(spark: SparkSession, rows=ODD) -> DataFrame:
    """Documents with extra columns, some of names that the operators use inside."""
    full = [(i, t, 1, 2, "h", "s", "k", "d", 3, 4) for i, t in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, {EXTRA}")


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(LOWER))


def shingle_set(text: str | None, k: int = 5) -> frozenset:
    w = words(text)
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def components(sets: dict[int, frozenset], percent: int) -> dict[int, int]:
    parent = {i: i for i in sets}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def covered(texts: list[bytes], length: int) -> list[list[bool]]:
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


def runs(flags: list[bool]) -> int:
    return sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))


def kept_lines(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """(id, lines, dropped, digest) of each row."""

    def key(line: str) -> str:
        return line.strip(" \t\n\x0b\x0c\r").encode().translate(LOWER).decode()

    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 40:
                    holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [
            x for x in lines
            if i is None or len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == i
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((i, len(lines), len(lines) - len(kept), digest))
    return out

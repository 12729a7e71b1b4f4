"""Vocabulary files of byte-level BPE and the splitting of text into pre-tokens.

A vocabulary is read once on the driver and sent to the workers; its size does not depend on the
data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import lru_cache

import regex

#: White space as the vocabularies' splitting patterns mean it (fixed values).
SPACE = r"\t-\r \x85\xa0  -     　"

#: Pre-tokens of the byte-level and of the word-end vocabulary (fixed patterns of their files).
BYTE_LEVEL = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
WORD_END = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in names)
    names |= {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """Ids of tokens, merges in order of rank, added tokens by their text, the word-end suffix."""

    ids: dict[str, int]
    merges: list[tuple[str, str]]
    added: dict[str, int]
    suffix: str


@lru_cache(maxsize=4)
def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        parsed = json.load(file)
    model = parsed["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    added = {t["content"]: t["id"] for t in parsed["added_tokens"]}
    return Vocabulary(model["vocab"], merges, added, model.get("end_of_word_suffix") or "")


def added_pattern(vocabulary: Vocabulary) -> regex.Pattern:
    """Matches the added tokens, which are cut out of a text before anything else."""
    names = sorted(vocabulary.added, key=len, reverse=True)
    return regex.compile("(" + "|".join(map(regex.escape, names)) + ")" if names else "(?!)()")

"""Texts of an Arrow batch as flat numpy arrays: bytes, words, word hashes, shingles.

A word is a run of bytes other than space and the ASCII controls 9 to 13. Hashes are 64 bits
wide, depend on nothing but the bytes, and are the same on every machine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = (9, 10, 11, 12, 13, 32)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Words longer than this many bytes are hashed one by one.
LONG_WORD = 2048

M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def times(n: int, m: np.uint64) -> np.uint64:
    """The product modulo 2**64."""
    return np.uint64(n * int(m) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def strings(column: pa.Array | pa.ChunkedArray) -> pa.LargeStringArray:
    """The column without nulls (they become empty), as one array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "").cast(pa.large_string())


def flat(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts behind each other, and where each starts; the last entry is the end."""
    _, places, data = texts.buffers()
    at = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts have at most ``most`` bytes, or are one text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(size.tolist()):
            if total + n > most and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def eight(data: np.ndarray) -> np.ndarray:
    """View of the eight bytes from each position on as one number; ``data`` is padded by 8."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, with eight bytes of padding."""
    out = np.zeros(len(data) + 8, np.uint8)
    np.take(LOWER, data, out=out[: len(data)])
    return out


def word_bounds(
    data: np.ndarray, at: np.ndarray, between: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word and the byte behind it; words never cross texts.

    ``between`` tells of each byte whether it stands between words.
    """
    n = int(at[-1])
    inside = np.zeros(n + 2, bool)
    np.logical_not(between[data[:n]], out=inside[1:-1])
    fresh = np.zeros(n + 1, bool)
    fresh[at] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | fresh))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | fresh))
    return starts, ends


def span_hashes(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * M1 + M3)
    view = eight(padded)
    todo = np.flatnonzero((size > 0) & (size <= LONG_WORD))
    step = 0
    while len(todo):
        left = size[todo] - step
        lane = view[starts[todo] + step]
        short = left < 8
        drop = (np.uint64(64) - (left[short].astype(np.uint64) << np.uint64(3)))
        lane[short] = (lane[short] << drop) >> drop
        h[todo] = mix(h[todo] * M1 + lane)
        todo = todo[left > 8]
        step += 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        whole = hashlib.blake2b(padded[starts[i] : ends[i]].tobytes(), digest_size=8)
        h[i] = np.frombuffer(whole.digest(), np.uint64)[0]
    return h


class Words:
    """The words of some texts: hash, text number and bounds of each, in order."""

    def __init__(self, texts: pa.LargeStringArray, lower: bool = True) -> None:
        data, self.at = flat(texts)
        self.padded = lowered(data) if lower else np.concatenate([data, np.zeros(8, np.uint8)])
        self.starts, self.ends = word_bounds(self.padded, self.at)
        self.hashes = span_hashes(self.padded, self.starts, self.ends)
        self.first = np.searchsorted(self.starts, self.at)
        self.counts = np.diff(self.first)
        self.texts = np.repeat(np.arange(len(self.counts)), self.counts)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and first word of every run of ``k`` words.

    A text of fewer words, but at least one, is one run.
    """
    n = len(words.hashes)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    run = max(n - k + 1, 0)
    h = np.zeros(run, np.uint64)
    for i in range(k):
        h = h * M2 + words.hashes[i : i + run]
    whole = np.flatnonzero(words.texts[:run] == words.texts[k - 1 : k - 1 + run])
    h = mix(h[whole] + times(k, M1))
    small = np.flatnonzero((words.counts > 0) & (words.counts < k))
    rest = []
    for i in small.tolist():
        own = words.hashes[words.first[i] : words.first[i + 1]]
        x = np.zeros(1, np.uint64)
        for w in own:
            x = x * M2 + w
        rest.append(mix(x + times(len(own), M1))[0])
    h = np.concatenate([h, np.array(rest, np.uint64)])
    text = np.concatenate([words.texts[:run][whole], small])
    start = np.concatenate([whole, words.first[:-1][small]])
    return h, text, start


def distinct(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, hash) pairs, ordered by text, then hash."""
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], text[new]

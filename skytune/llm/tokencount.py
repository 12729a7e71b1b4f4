"""Token counts: merges of byte-level BPE applied to many pre-tokens at once.

The distinct pre-tokens of a batch lie behind each other in flat arrays. In every round each
sequence merges its pair of lowest rank, wherever it occurs in it; sequences without a known pair
leave with the symbols that survive. Only ranks beside a merge are looked up again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytune.llm.pretokens import (
    BYTE_LEVEL,
    Vocabulary,
    added_pattern,
    byte_symbols,
    read_vocabulary,
)
from skytune.llm.ragged import slices, strings

NONE = np.int64(1 << 40)
SPACE_AFTER_SPACE = re.compile(r"\s ").search
CHUNK = 1 << 20
#: Counts of so many pre-tokens are kept by a worker before it forgets them.
KEPT = 400_000


class MergeTable:
    """Symbols of bytes, and rank and result of each known pair."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        ids = vocabulary.ids
        self.symbols = np.array([ids[c] for c in byte_symbols()], np.int64)
        keys = np.array([ids[a] << 32 | ids[b] for a, b in vocabulary.merges], np.int64)
        made = np.array([ids[a + b] for a, b in vocabulary.merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left << np.int64(32) | right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.ranks[place], NONE)

    def lengths(self, words: list[bytes]) -> np.ndarray:
        """How many symbols each non-empty word has after all merges."""
        out = np.zeros(len(words), np.int64)
        size = np.array([len(w) for w in words], np.int64)
        sym = self.symbols[np.frombuffer(b"".join(words), np.uint8)]
        word = np.arange(len(words))
        at = np.cumsum(size) - size
        rank = np.full(len(sym), NONE)
        if len(sym) > 1:
            rank[:-1] = self.rank(sym[:-1], sym[1:])
            rank[at[1:] - 1] = NONE
        while len(word):
            low = np.minimum.reduceat(rank, at)
            done = low == NONE
            if done.any():
                out[word[done]] = size[done]
                live = np.repeat(~done, size)
                sym, rank = sym[live], rank[live]
                word, size, low = word[~done], size[~done], low[~done]
                at = np.cumsum(size) - size
                continue
            hit = np.flatnonzero(rank == np.repeat(low, size))
            # of overlapping hits (a a a) every second one goes, from the left
            if len(hit) > 1:
                fresh = np.ones(len(hit), bool)
                fresh[1:] = hit[1:] != hit[:-1] + 1
                run = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            lost = np.add.reduceat(~stay, at, dtype=np.int64)
            moved = np.cumsum(stay) - 1
            touched = moved[hit]
            rank[hit] = rank[hit + 1]  # tells below whether a symbol follows in the same word
            sym, size = sym[stay], size - lost
            rank = rank[stay]
            at = np.cumsum(size) - size
            last = np.zeros(len(sym), bool)
            last[at + size - 1] = True
            first = np.zeros(len(sym), bool)
            first[at] = True
            after = touched[~last[touched]]
            before = touched[~first[touched]] - 1
            rank[touched] = NONE
            rank[after] = self.rank(sym[after], sym[after + 1])
            rank[before] = self.rank(sym[before], sym[before + 1])
        return out


class Counter:
    """Tokens of whole texts; remembers pre-tokens and stretches between spaces it has met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.table = MergeTable(vocabulary)
        self.added = added_pattern(vocabulary)
        self.names = tuple(vocabulary.added)
        self.known: dict[str, int] = {}
        self.stretches: dict[str, int] = {}

    def cut(self, text: str) -> tuple[list[str], list[str], int]:
        """Stretches that follow a space, other pre-tokens, and the number of added tokens.

        A pre-token begins at every space that has no white space before it, so there a text
        may be cut and each stretch be counted by itself.
        """
        if any(name in text for name in self.names):
            parts = self.added.split(text)
            rest = [w for part in parts[::2] for w in BYTE_LEVEL.findall(part)]
            return [], rest, len(parts) // 2
        if SPACE_AFTER_SPACE(text):
            return [], BYTE_LEVEL.findall(text), 0
        first, *stretches = text.split(" ")
        return stretches, BYTE_LEVEL.findall(first), 0

    def counts(self, texts: list[str]) -> list[int]:
        cut = [self.cut(t) for t in texts]
        for memory in (self.known, self.stretches):
            if len(memory) > KEPT:
                memory.clear()
        fresh = list(set().union(*(s for s, _, _ in cut)) - self.stretches.keys())
        inside = [BYTE_LEVEL.findall(" " + s) for s in fresh]
        words = list(set().union(*inside, *(w for _, w, _ in cut)) - self.known.keys())
        if words:
            made = self.table.lengths([w.encode() for w in words])
            self.known.update(zip(words, made.tolist(), strict=True))
        count = self.known.__getitem__
        self.stretches.update((s, sum(map(count, w))) for s, w in zip(fresh, inside, strict=True))
        stretch = self.stretches.__getitem__
        return [sum(map(stretch, s)) + sum(map(count, w)) + more for s, w, more in cut]


#: One counter per vocabulary in each worker, kept from task to task.
COUNTERS: dict[str, Counter] = {}


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    limit: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: (doc_id, n_bytes, n_tokens, over_limit).

    ``vocabulary`` is the path of a byte-level BPE file, read by the driver. Null and empty texts
    have no tokens. Rows and ids may repeat, ids may be null; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = COUNTERS.get(vocabulary) or COUNTERS.setdefault(vocabulary, Counter(shared.value))
        for batch in slices(batches, 1, CHUNK):
            texts = strings(batch.column(1))
            n = np.array(counter.counts(texts.to_pylist()), np.int64)
            size = pc.binary_length(texts).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), size, pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

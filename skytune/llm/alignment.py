"""Alignment of two tokenizers of the same text, and corpus-wide counts of their links.

Side A is a byte-level BPE vocabulary, side B a sentencepiece model that puts a space before the
text, so A encodes the text behind a space. Tokens of a batch lie behind each other by byte offset.
``pandas.merge_asof``, keyed by document, finds for the start of each A token the B token that covers
it, and the other way round. Two tokens overlap if one covers the other's start, so the union of
both directions holds every link. Where tokens of both sides end at the same byte, a group ends.

A link of two ids is written as one number, the A id times the size of B's vocabulary plus the B id.
How many documents hold a link is counted by Spark. The counts go to the documents in bounded
portions of links, one round each: links are pairs of vocabulary entries, so their number levels off
while the corpus grows.
"""

from __future__ import annotations

import math
import re
import struct
from collections.abc import Callable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from skytune.llm.pretokens import BYTE_LEVEL, byte_symbols
from skytune.llm.ragged import slices, strings
from skytune.llm.stretches import cut, spread
from skytune.llm.tokencount import SPACE_AFTER_SPACE
from skytune.session import written

#: Bytes of text that are aligned at once, and links that are looked up at once.
CHUNK, LOOKED_UP = 1 << 20, 1 << 18
#: Ids of so many stretches and of so many words are kept by a worker before it forgets them.
KEPT, KEPT_WORDS = 300_000, 150_000
#: Links whose counts a worker holds at once (13 bytes each).
PORTION = 2_000_000

#: What no ids spell: the empty text is aligned with nothing.
NEVER = b"\xff"
#: What stands for a space in a piece.
GAP = "\u2581"
#: Texts of more characters are not cut into words here.
LONG = 1000
#: Characters that the library splits into words; which are letters changes with Unicode.
BEYOND_LATIN = re.compile(r"[^\x00-\u024f]").search

#: A side and a B side end, more tokens follow on the same side, or the text is over.
SEPARATORS = (",", "|", ";", "")

SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "links array<int>"
)


class ByteSide:
    """Side A: ids by the public library; words of Latin characters go straight to its merges."""

    def __init__(self, vocabulary: str) -> None:
        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        self.merges = self.library.model.tokenize
        symbols = byte_symbols()
        self.symbols = dict(enumerate(symbols))
        byte = {c: b for b, c in enumerate(symbols)}
        names = [self.library.id_to_token(i) or "" for i in range(self.library.get_vocab_size())]
        self.bytes = [
            bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode() for t in names
        ]
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and each text."""
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        return [self.learn(" " + t) for t in texts]

    def learn(self, text: str) -> list[int]:
        if len(text) > LONG or BEYOND_LATIN(text):
            return self.library.encode(text, add_special_tokens=False).ids
        found: list[int] = []
        if text[1:].isalpha():
            words = [text]
        elif text[1:-1].isalpha() and text[-1] in ".,":
            words = [text[:-1], text[-1]]
        else:
            words = BYTE_LEVEL.findall(text)
        for word in words:
            ids = self.known.get(word)
            if ids is None:
                spelled = word.encode().decode("latin-1").translate(self.symbols)
                ids = self.known[word] = [t.id for t in self.merges(spelled)]
            found += ids
        return found


class PieceSide:
    """Side B: ids by the public library."""

    def __init__(self, model: bytes) -> None:
        self.library = SentencePieceProcessor(model_proto=model)
        names = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        self.bytes = [
            bytes([int(t[3:-1], 16)]) if self.library.is_byte(i) else t.replace(GAP, " ").encode()
            for i, t in enumerate(names)
        ]
        #: Whether no piece goes on after a space inside it.
        self.separable = all(GAP not in t.lstrip(GAP) for t in names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


FORMATS = [struct.Struct(f"<{n}I") for n in range(16)]


def packed(ids: list[int]) -> bytes:
    return FORMATS[len(ids)].pack(*ids) if len(ids) < 16 else struct.pack(f"<{len(ids)}I", *ids)


class Aligner:
    """Both sides of a batch of texts, their links and groups."""

    def __init__(self, vocabulary: str, model: bytes) -> None:
        self.a, self.b = ByteSide(vocabulary), PieceSide(model)
        self.sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        self.width = max(map(len, self.sizes))
        self.spelled = [f"{i}{mark}" for mark in SEPARATORS for i in range(self.width)]
        #: Ids of stretches on both sides, and stretches that a side does not give back.
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.lost: set[str] = set()

    def plain(self, text: str) -> bool:
        """Whether both sides may be cut at every space: none follows white space or ends the text.

        A pre-token and a piece begin at each space then, and depend on nothing before it.
        """
        return not (text.endswith(" ") or SPACE_AFTER_SPACE(" " + text))

    def checked(self, texts: list[str]) -> tuple[list[bytes], list[bytes], set[int]]:
        """Ids of both sides of each text, and the places where a side does not give back its text."""
        wanted = [b" " + t.encode() if t else NEVER for t in texts]
        both = self.a.encode(texts), self.b.encode(texts)
        whole, lengths = b"".join(wanted), list(map(len, wanted))
        sound = True
        for side, size, ids in zip((self.a, self.b), self.sizes, both, strict=True):
            flat = list(chain.from_iterable(ids))
            stops = np.cumsum(list(map(len, ids)), dtype=np.int64)
            spelled = np.cumsum(size[np.array(flat, np.int64)])
            ends = np.concatenate([np.zeros(1, np.int64), spelled])[stops]
            sound = sound and b"".join(map(side.bytes.__getitem__, flat)) == whole
            sound = sound and np.array_equal(ends, np.cumsum(lengths, dtype=np.int64))
        lost = set()
        if not sound:
            rows = enumerate(zip(*both, wanted, strict=True))
            lost = {i for i, (a, b, want) in rows if not self.same(a, b, want)}
        return list(map(packed, both[0])), list(map(packed, both[1])), lost

    def same(self, a: list[int], b: list[int], want: bytes) -> bool:
        """Whether both lists of ids spell the same bytes."""
        spelled = (b"".join(map(s.bytes.__getitem__, x)) for s, x in ((self.a, a), (self.b, b)))
        return all(x == want for x in spelled)

    def sides(self, texts: pa.LargeStringArray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per side the ids of all texts behind each other, and how many each text has.

        Distinct stretches between spaces are encoded once, and remembered.
        """
        if len(self.known) > KEPT:
            self.known.clear()
            self.lost.clear()
        known = self.known
        known[""] = b"", b""  # the only stretch of an empty text
        whole = np.array([not self.plain(t) for t in texts.to_pylist()], bool)
        distinct, uncut, places, begins = cut(texts, whole | (not self.b.separable))
        fresh = [s for s in distinct if s not in known]
        *found, lost = self.checked(fresh)
        known.update(zip(fresh, zip(*found, strict=True), strict=True))
        self.lost.update(fresh[i] for i in lost)
        *found, lost = self.checked(uncut)
        gone = np.zeros(len(distinct) + len(uncut), bool)
        gone[[len(distinct) + i for i in lost]] = True
        if self.lost:
            gone[: len(distinct)] = [s in self.lost for s in distinct]
        pairs = list(map(known.__getitem__, distinct))
        return [
            spread([*(p[k] for p in pairs), *found[k]], places, begins, gone) for k in (0, 1)
        ]

    def align(self, texts: pa.LargeStringArray) -> list[pa.Array]:
        """Columns of ``SCHEMA`` behind the document id."""
        (ids_a, n_a), (ids_b, n_b) = self.sides(texts)
        ids, n = [ids_a.astype(np.int64), ids_b.astype(np.int64)], [n_a, n_b]
        ends = [np.cumsum(size[x]) for size, x in zip(self.sizes, ids, strict=True)]
        frames = [
            pd.DataFrame(
                {"start": end - size[x], "doc": np.repeat(np.arange(len(texts)), m), name: np.arange(len(x))}
            )
            for name, end, size, x, m in zip("ab", ends, self.sizes, ids, n, strict=True)
        ]
        a, b = linked(*frames)
        n_links = np.bincount(frames[0]["doc"].to_numpy()[a], minlength=len(texts))
        codes = ids[0][a] * len(self.b.bytes) + ids[1][b]
        last = shared(ends)
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(last[0])])[np.cumsum(n[0])]
        return [
            pa.array(n[0]), pa.array(n[1]), pa.array(np.diff(upto, prepend=0)),
            pa.array(n_links.astype(np.int64)),
            pa.array(self.notation(ids, last, n), pa.large_string()).cast(pa.string()),
            pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(n_links)]).astype(np.int32)),
                pa.array(codes.astype(np.int32)),
            ),
        ]

    def notation(
        self, ids: list[np.ndarray], last: list[np.ndarray], n: list[np.ndarray]
    ) -> list[str]:
        """Per text ``a1,a2|b1;a3|b2,b3``: ids of both sides, group by group.

        ``last`` tells of each token whether it ends a group.
        """
        group = [np.cumsum(x) - x for x in last]
        ended = [np.flatnonzero(x) + 1 for x in last]
        before = np.concatenate([np.zeros(1, np.int64), ended[1]])[group[0]]
        places = [before + np.arange(len(before)), ended[0][group[1]] + np.arange(len(group[1]))]
        marks = [last[0] * 1, last[1] * 2]
        marks[1][np.cumsum(n[1])[n[1] > 0] - 1] = 3
        every = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        for k in (0, 1):
            every[places[k]] = marks[k] * self.width + ids[k]
        spelled = list(map(self.spelled.__getitem__, every.tolist()))
        out, start = [], 0
        for stop in np.cumsum(n[0] + n[1]).tolist():
            out.append("".join(spelled[start:stop]))
            start = stop
        return out


def shared(ends: list[np.ndarray]) -> list[np.ndarray]:
    """Per side, of each token's end whether a token of the other side ends there too."""
    at = [np.zeros(int(end[-1]) + 1 if len(end) else 1, bool) for end in ends]
    for mark, end in zip(at, ends, strict=True):
        mark[end] = True
    return [at[1][ends[0]], at[0][ends[1]]]


def linked(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of A and B tokens that overlap, in order of the text.

    Each frame has the tokens in order: byte ``start``, ``doc`` and place (``a`` or ``b``).
    """
    over_a = pd.merge_asof(a, b, on="start", by="doc")
    over_b = pd.merge_asof(b, a.assign(at=a["start"]), on="start", by="doc")
    # tokens that start together are found from both sides
    later = over_b["at"].to_numpy() < over_b["start"].to_numpy()
    left = np.concatenate([over_a["a"].to_numpy(), over_b["a"].to_numpy()[later]])
    right = np.concatenate([over_a["b"].to_numpy(), over_b["b"].to_numpy()[later]])
    left, right = left.astype(np.int64), right.astype(np.int64)
    # along a text every link is one step further on one side or on both
    order = np.argsort(left + right, kind="stable")
    return left[order], right[order]


#: One aligner per pair of vocabularies in each worker, kept from task to task.
ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner_for(key: tuple[str, str], shared: Broadcast) -> Aligner:
    """This worker's aligner of the two files, whose contents were sent to it.

    A function of the module, as functions sent to workers bring their own copies of variables.
    """
    if key not in ALIGNERS:
        ALIGNERS[key] = Aligner(*shared.value)
    return ALIGNERS[key]


def forget_aligners() -> None:
    ALIGNERS.clear()


def alignments(
    docs: DataFrame,
    vocabulary: str,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: (doc_id, n_a, n_b, n_groups, n_links, groups, links).

    ``vocabulary`` and ``model`` are the paths of a byte-level BPE file and a sentencepiece model,
    read by the driver. ``groups`` lists the ids of both sides, ``a1,a2|b1;a3|b2,b3``; ``links`` has a
    number for each pair of tokens that overlap, in order of the text. The sizes of both vocabularies
    may multiply to 2 ** 31 at most.

    Special tokens are plain text. Null and empty texts, and texts that one of the sides does not
    give back byte for byte, have no tokens: zeros, an empty text and no links. Rows and ids may
    repeat, each row is a document of its own; ids may be null; other columns are not read.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((Path(vocabulary).read_text("utf-8"), Path(model).read_bytes()))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    key = vocabulary, model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_for(key, shared)
        for batch in slices(batches, 1, CHUNK):
            columns = aligner.align(strings(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    own = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    return own.mapInArrow(run, SCHEMA)


def vocabulary_size(model: str) -> int:
    """How many ids a sentencepiece model has."""
    return SentencePieceProcessor(model_file=model).vocab_size()


def link_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """Per link of the corpus: (link, a_id, b_id, n_docs, best).

    ``n_docs`` is how many rows hold the link, ``best`` whether no link of the same A id is held by
    more. ``size_b`` is the size of B's vocabulary.
    """
    held = aligned.select(F.explode(F.array_distinct("links")).alias("link"))
    counted = held.groupBy("link").agg(F.count(F.lit(1)).alias("n_docs")).select(
        "link",
        F.floor(F.col("link") / size_b).cast("int").alias("a_id"),
        (F.col("link") % size_b).cast("int").alias("b_id"),
        "n_docs",
    )
    counted = written(counted, "links")
    most = counted.groupBy("a_id").agg(F.max("n_docs").alias("_most"))
    return counted.join(most, "a_id").select(
        "link", "a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("_most")).alias("best")
    )


def with_link_counts(aligned: DataFrame, counts: DataFrame, portion: int = PORTION) -> DataFrame:
    """``aligned`` without its links but with (n_best, count_sum).

    Over the links of a row: how many are the ``best`` of their A id, and the sum of ``n_docs``.
    ``counts`` is a written result of ``link_counts``; workers hold about ``portion`` of its rows
    at a time. Rows in between rounds are written to the shared folder.
    """
    spark = aligned.sparkSession
    rounds = max(1, math.ceil(counts.count() / portion))
    frame = aligned.withColumns({c: F.lit(0).cast("long") for c in ("n_best", "count_sum")})
    for k in range(rounds):
        mine = counts.where(F.pmod(F.xxhash64("link"), F.lit(rounds)) == k).orderBy("link")
        found = mine.select("link", "n_docs", "best").toArrow()
        table = spark.sparkContext.broadcast([c.to_numpy() for c in found.columns])
        frame = frame.mapInArrow(_adding(table), frame.schema)
        if k + 1 < rounds:
            frame = written(frame, "link-counts")
    return frame.drop("links")


def _adding(table) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A round: adds what the links of each row find in the broadcast table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_aligners()
        keys, n_docs, best = table.value
        values = {"n_best": best, "count_sum": n_docs}
        for batch in _portions(batches):
            lists = batch.column("links")
            size = np.diff(lists.offsets.to_numpy())
            distinct, place = np.unique(lists.flatten().to_numpy(), return_inverse=True)
            at = np.minimum(np.searchsorted(keys, distinct), max(len(keys) - 1, 0))
            hit = keys[at] == distinct if len(keys) else np.zeros(len(distinct), bool)
            stops = np.cumsum(size)
            for name, column in values.items():
                mine = np.zeros(len(distinct), np.int64)
                mine[hit] = column[at[hit]]
                running = np.concatenate([np.zeros(1, np.int64), np.cumsum(mine[place])])
                total = batch.column(name).to_numpy() + running[stops] - running[stops - size]
                batch = batch.set_column(batch.schema.get_field_index(name), name, pa.array(total))
            yield batch

    return run


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their rows have at most ``LOOKED_UP`` links, or are one row."""
    for batch in batches:
        start, total = 0, 0
        for i, n in enumerate(batch.column("n_links").to_pylist()):
            if total + n > LOOKED_UP and i > start:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)

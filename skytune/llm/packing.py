"""Cost-balanced packing of documents into token sequences of bounded length.

A piece of L tokens costs ``linear * L + quadratic * L * L``, as attention inside it does. Documents
are packed in groups of about a million tokens, each inside the task that reads them, so nothing is
shuffled. A document longer than a sequence fills whole sequences with its beginning. What remains
of the documents is taken in order of falling cost, and each goes to the sequence of lowest cost
that has room for it. Where none has, it is cut: the sequence of lowest cost that has room at all
takes what fits.

The sequences of a group have room for exactly its tokens. Those that do not fill a sequence of
full length fill shorter ones, each a power of two long, so no sequence needs padding.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skytune.llm.bpe import split
from skytune.llm.pretokens import WORD_END, byte_symbols
from skytune.llm.ragged import slices, strings

#: Bytes of text that are encoded at once.
CHUNK = 1 << 20
#: Of so many words and stretches ids are kept by a worker, and as many of those met before them.
KEPT = 400_000
#: A sequence id is the number of the task times this, plus a count inside the task.
PER_TASK = 1 << 33

#: Pre-tokens, and what stands between stretches.
WORD_OR_BREAK = regex.compile(WORD_END.pattern + r"|\n")

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long, cost double"
)


class LibraryIds:
    """Ids that the public library gives, with a memory of stretches it has met.

    Pre-tokens of a word-end vocabulary never cross white space, so the library sees each distinct
    stretch between white space once. Words of Latin-1 characters go straight to its merges. A word
    has the ids of the stretch that is this word alone, so one memory holds both. When it is full, it
    becomes the older one; what is met again there is taken over, the rest goes with the next change.
    """

    def __init__(self, vocabulary: str) -> None:
        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        self.merges = self.library.model.tokenize
        self.added = [t["content"] for t in json.loads(vocabulary)["added_tokens"]]
        self.symbols = dict(enumerate(byte_symbols()))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                plain = word.isascii() and word.isprintable()  # such bytes are their own symbols
                spelled = word if plain else word.encode().decode("latin-1").translate(self.symbols)
                ids = packed([t.id for t in self.merges(spelled)])
            self.known[word] = ids
        return ids

    def learn(self, stretches: list[str]) -> None:
        """Remember the ids of new stretches; words of all of them are found at once."""
        text = "\n".join(stretches)
        if not latin(text):
            for s in stretches:
                if not latin(s):
                    self.known[s] = self.whole(s)
            stretches = [s for s in stretches if latin(s)]
            text = "\n".join(stretches)
        if not stretches:
            return
        words = WORD_OR_BREAK.findall(text.lower() + "\n")
        ids_of = {w: self.word(w) for w in set(words) - {"\n"}} | {"\n": b""}
        found = [ids_of[w] for w in words]
        size = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(size)[size == 0].tolist()
        ids = b"".join(found)
        cuts = zip([0, *ends], ends, strict=False)
        self.known.update(zip(stretches, [ids[a:b] for a, b in cuts], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if len(self.known) > KEPT:
            self.known, self.older = {}, self.known
        cut = [
            None if any(name in t for name in self.added) else split(t.lower() if latin(t) else t)
            for t in texts
        ]
        known, older = self.known, self.older
        fresh = set().union(*filter(None, cut)).difference(known)  # ``-`` would visit all of the memory
        again = {s: older[s] for s in fresh if s in older}
        known.update(again)
        self.learn(list(fresh.difference(again)))
        return [
            self.whole(t) if c is None else b"".join(map(known.__getitem__, c))
            for t, c in zip(texts, cut, strict=True)
        ]


def latin(text: str) -> bool:
    """Whether all characters are Latin-1; others have composed forms and classes that the library
    settles."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


#: One encoder per vocabulary in each worker, kept from task to task.
ENCODERS: dict[str, LibraryIds] = {}


def encoder_for(path: str, shared: Broadcast) -> LibraryIds:
    """This worker's encoder of the vocabulary file, whose content was sent to it.

    A function of the module, as functions sent to workers bring their own copies of variables.
    """
    if path not in ENCODERS:
        ENCODERS[path] = LibraryIds(shared.value)
    return ENCODERS[path]


def room_for(tokens: int, capacity: int) -> list[int]:
    """Lengths of sequences that hold ``tokens`` exactly: full ones, then falling powers of two."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [
        1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1
    ]


def balanced(
    lengths: list[int], capacity: int, linear: float, quadratic: float
) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths.

    Empty documents get no piece. Equal lengths are taken in the order given.
    """
    sequence, rests = 0, []
    for doc, length in enumerate(lengths):
        whole = length // capacity
        for i in range(whole):
            yield doc, i * capacity, capacity, sequence + i, 0
        sequence += whole
        if length % capacity:
            rests.append((doc, whole * capacity, length - whole * capacity))
    size = room_for(sum(n for *_, n in rests), capacity)
    room = np.array(size, np.int64)
    cost = np.zeros(len(size))
    for doc, start, left in sorted(rests, key=lambda r: -r[2]):
        while left:
            fits = room >= left
            at = int(np.where(fits if fits.any() else room > 0, cost, np.inf).argmin())
            taken = min(left, int(room[at]))
            yield doc, start, taken, sequence + at, size[at] - int(room[at])
            room[at] -= taken
            cost[at] += linear * taken + quadratic * taken * taken
            start, left = start + taken, left - taken


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int = 2048,
    linear: float = 1.0,
    quadratic: float = 1 / 1024,
    group_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: (doc_id, start, length, ids, doc_tokens, sequence_id, offset, cost).

    The ids of a document are those of its whole text, then ``end_id``; ``ids`` has those of the
    piece as little-endian 32-bit numbers. ``vocabulary`` is the path of a word-end BPE file, read
    by the driver; ``capacity`` is a power of two. A group ends with the document that brings it to
    ``group_tokens`` tokens, or with the task, so memory is bounded by that and the longest text.

    Null and empty texts are the end id alone. Rows and ids may repeat, each row is a document of
    its own; ids may be null; other columns are not read. An empty table gives no pieces.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"capacity must be a power of two, not {capacity}")
    with open(vocabulary, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    end = packed([end_id])

    def pieces(doc_ids: list, ids: list[bytes], first: int) -> tuple[pa.RecordBatch, int]:
        lengths = [len(x) // 4 for x in ids]
        rows = list(balanced(lengths, capacity, linear, quadratic))
        doc, start, length, sequence, offset = np.array(rows, np.int64).T
        cost = linear * length + quadratic * length.astype(float) ** 2
        cut = [ids[d][4 * s : 4 * (s + n)] for d, s, n, *_ in rows]
        columns = [
            pa.array([doc_ids[d] for d in doc.tolist()], pa.int64()), pa.array(start),
            pa.array(length), pa.array(cut, pa.binary()),
            pa.array(np.array(lengths, np.int64)[doc]), pa.array(sequence + first),
            pa.array(offset), pa.array(cost),
        ]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names=names), int(sequence.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(vocabulary, shared)
        fresh = TaskContext.get().partitionId() * PER_TASK
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        size = 0
        for batch in slices(batches, 1, CHUNK):
            listed = batch.column(0).to_pylist()
            coded = encoder.encode(strings(batch.column(1)).to_pylist())
            for doc_id, found in zip(listed, coded, strict=True):
                doc_ids.append(doc_id)
                ids.append(found + end)
                size += len(found) // 4 + 1
                if size >= group_tokens:
                    made, used = pieces(doc_ids, ids, fresh)
                    yield made
                    fresh += used
                    doc_ids, ids, size = [], [], 0
        if ids:
            yield pieces(doc_ids, ids, fresh)[0]

    own = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    return own.mapInArrow(run, SCHEMA)

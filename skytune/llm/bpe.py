"""BPE encoding in linear time with exact merges, and decoding by an offset table.

Encoding takes the longest token at each place (an Aho-Corasick automaton over reversed tokens
finds all of them in one pass) and steps back to shorter ones where two neighbours could not have
come out of the merges side by side. Whether they could is a property of the pair alone, looked up
in a table that fills as pairs occur.
"""

from __future__ import annotations

import hashlib
import re
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytune.llm.pretokens import (
    SPACE,
    WORD_END,
    Vocabulary,
    added_pattern,
    byte_symbols,
    read_vocabulary,
)
from skytune.llm.ragged import slices, strings

CHUNK = 1 << 20
#: Ids of so many words are kept by a worker before it forgets them.
KEPT = 400_000
#: Symbols of bytes inside and at the end of a word, and what stands between words.
AT_END, GAP = 0x100, chr(0x200)
SPACES = re.compile(f"[{SPACE}]+")
#: str.split takes these for white space, the vocabulary does not.
CONTROLS = re.compile("[\x1c-\x1f]").search
ALWAYS = 1 << 40


class Encoder:
    """Ids of words and whole texts, as the merges of a word-end vocabulary give them."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        ids = vocabulary.ids
        self.added, self.names = vocabulary.added, added_pattern(vocabulary)
        spelled: dict[int, str] = {}
        for b, c in enumerate(byte_symbols()):
            spelled[ids[c]] = chr(b)
            spelled[ids[c + vocabulary.suffix]] = chr(AT_END + b)
        base = set(spelled)
        self.split: dict[int, tuple[int, int]] = {}
        self.pair: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = dict.fromkeys(base, -1)
        for rank, (a, b) in enumerate(vocabulary.merges):
            left, right, made = ids[a], ids[b], ids[a + b]
            self.pair.setdefault((left, right), rank)
            if made not in spelled:
                spelled[made] = spelled[left] + spelled[right]
                self.split[made], self.rank[made] = (left, right), rank
        self.fits: dict[int, bool] = {}
        # tokens that the merges themselves can never produce are left out
        usable = set(base)
        for made, (left, right) in self.split.items():
            if left in usable and right in usable and self.side_by_side(left, right, self.rank[made]):
                usable.add(made)
        self.length = [len(spelled.get(t, "")) for t in range(max(spelled) + 1)]
        by_text = {spelled[t]: t for t in usable}
        self.shorter: dict[int, int | None] = {}
        self.automaton = ahocorasick.Automaton()
        for text, t in by_text.items():
            cuts = (by_text.get(text[:n]) for n in range(len(text) - 1, 0, -1))
            self.shorter[t] = next((x for x in cuts if x is not None), None)
            self.automaton.add_word(text[::-1], t)
        self.automaton.make_automaton()
        self.known: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}

    def spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The token and its parts at one edge, each with the rank of the merge that ends it."""
        found, until = [], ALWAYS
        while True:
            found.append((token, until))
            if token not in self.split:
                return found
            until = self.rank[token]
            token = self.split[token][side]

    def side_by_side(self, left: int, right: int, before: int = ALWAYS) -> bool:
        """Whether no merge of a rank below ``before`` joins parts across the border.

        Parts x and y at the border are joined by a merge of rank q if both still stand then.
        The merge that ends x lies further left and so goes first at equal rank, that of y second.
        """
        for x, x_until in self.spine(left, 1):
            for y, y_until in self.spine(right, 0):
                q = self.pair.get((x, y))
                if q is not None and q < before and q < x_until and q <= y_until:
                    return False
        return True

    def fit(self, left: int, right: int) -> bool:
        """Fill the table of compatible pairs."""
        if len(self.fits) > KEPT:
            self.fits.clear()
        known = self.fits[left << 32 | right] = self.side_by_side(left, right)
        return known

    def walk(self, longest: dict[int, int], last_place: int, size: int) -> list[int]:
        """Tokens of a word of ``size`` symbols.

        ``longest`` has the longest token at each place, counted from the right end of the text;
        ``last_place`` is where the word starts in it.
        """
        length, shorter, fits, fit = self.length, self.shorter, self.fits, self.fit
        token = longest[last_place]
        if length[token] == size:
            return [token]
        out: list[int] = []
        dead: set[int] = set()
        place, left = 0, -1
        while True:
            found: int | None = token
            while found is not None:
                end = place + length[found]
                if end not in dead:
                    if left < 0:
                        break
                    ok = fits.get(left << 32 | found)
                    if ok or (ok is None and fit(left, found)):
                        break
                found = shorter[found]
            if found is None:  # nothing fits here: the token before must be a shorter one
                dead.add(place)
                token = out.pop()
                place -= length[token]
                left = out[-1] if out else -1
                continue
            out.append(found)
            if end == size:
                return out
            place, left = end, found
            token = longest[last_place - place]

    def learn(self, words: list[str]) -> None:
        """Encode words and remember their ids."""
        spelled = [(raw := w.encode())[:-1].decode("latin-1") + chr(AT_END + raw[-1]) for w in words]
        text = GAP.join(spelled)
        # of the tokens at one place the automaton gives the longest first, so it overwrites others
        longest = dict(reversed(list(self.automaton.iter(text[::-1]))))
        place = len(text) - 1
        for word, symbols in zip(words, spelled, strict=True):
            ids = self.walk(longest, place, len(symbols))
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
            place -= len(symbols) + 1

    def cut(self, text: str) -> list[str]:
        """Stretches without white space; added tokens stay whole.

        Pre-tokens never cross white space, so each stretch is encoded by itself.
        """
        if any(name in text for name in self.added):
            parts = self.names.split(text)
            return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else split(normal(p)))]
        return split(normal(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        cut = [self.cut(t) for t in texts]
        for memory in (self.known, self.stretches):
            if len(memory) > KEPT:
                memory.clear()
        for name, i in self.added.items():
            self.stretches[name] = np.array([i], "<u4").tobytes()
        fresh = list(set().union(*cut) - self.stretches.keys())
        inside = [WORD_END.findall(s) for s in fresh]
        words = list(set().union(*inside) - self.known.keys())
        if words:
            self.learn(words)
        word = self.known.__getitem__
        self.stretches.update((s, b"".join(map(word, w))) for s, w in zip(fresh, inside, strict=True))
        stretch = self.stretches.__getitem__
        return [b"".join(map(stretch, s)) for s in cut]


#: One encoder per vocabulary in each worker, kept from task to task.
ENCODERS: dict[str, Encoder] = {}


def split(text: str) -> list[str]:
    """The stretches of a text between white space."""
    return SPACES.split(text) if CONTROLS(text) else text.split()


def normal(text: str) -> str:
    """Composed form in lower case, letter by letter."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


class Decoder:
    """Texts of ids: one run of bytes holds all tokens, a table tells where each starts."""

    def __init__(self, vocabulary: Vocabulary, glue: bytes = b" ") -> None:
        names = {i: t for t, i in (vocabulary.ids | vocabulary.added).items()}
        raw = [(names.get(i, "").encode() + glue) for i in range(max(names, default=-1) + 1)]
        self.cut = len(glue)
        size = np.array([len(x) for x in raw], np.int64)
        self.at = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        self.size = size
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """UTF-8 of each text; tokens are set apart by the glue."""
        every = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        size = self.size[every]
        end = np.cumsum(size)
        place = np.repeat(self.at[every] - (end - size), size)
        place += np.arange(len(place))
        flat = self.bytes[place].tobytes()
        ends = np.concatenate([np.zeros(1, np.int64), end])
        stops = ends[np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)].tolist()
        out, start = [], 0
        for stop in stops:
            out.append(flat[start : max(start, stop - self.cut)])
            start = stop
        return out


def round_trip(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: (doc_id, ids, decoded), ids as a list of integers.

    ``vocabulary`` is the path of a word-end BPE file, read by the driver. Null and empty texts
    have no ids and decode to the empty text. Rows and ids may repeat, doc ids may be null.
    """

    def columns(ids: list[bytes], texts: list[bytes]) -> list[pa.Array]:
        places = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
        return [
            pa.ListArray.from_arrays(pa.array(places), values),
            pa.array([t.decode() for t in texts], pa.string()),
        ]

    schema = "doc_id long, ids array<int>, decoded string"
    return _coded(docs, vocabulary, id_col, text_col, schema, columns)


def coding_report(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: token count, digest of the ids, digest of the decoded text."""

    def columns(ids: list[bytes], texts: list[bytes]) -> list[pa.Array]:
        return [
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
            pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
        ]

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _coded(docs, vocabulary, "doc_id", "text", schema, columns)


def _coded(docs, vocabulary, id_col, text_col, schema, columns) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ENCODERS.get(vocabulary) or ENCODERS.setdefault(vocabulary, Encoder(shared.value))
        decoder = Decoder(shared.value)
        for batch in slices(batches, 1, CHUNK):
            ids = encoder.encode(strings(batch.column(1)).to_pylist())
            made = columns(ids, decoder.decode(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=names)

    own = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    return own.mapInArrow(run, schema)

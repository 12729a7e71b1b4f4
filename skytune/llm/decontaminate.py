"""Benchmark items in documents, re-parameterised ones included.

Tokens are stretches between white space without the marks at their ends, in lower case (ASCII and
Latin-1 letters). In a template, a token that starts with a digit is a number, a unit of measure
behind a number a unit, and a capitalised token inside a sentence a name. Windows are runs of five
template tokens; a window with fewer than two plain words keeps the literal tokens instead. An item of
fewer tokens is too short for a template: it is one window of literal tokens, and is looked for
among all such windows of its size.

Capitals tell names apart only in part: a name may open a sentence, and a copy may be in other
case. So every text is read in four ways, and the best share of an item counts: with names inside
sentences, with all capitalised tokens as names, without names, and with literal tokens only.

A document holds an item if it holds at least 80 percent of the item's different windows, with
slots that fit: in the windows that match, equal slot values of the item stand for equal values of
the document, and different names for different names. All places of an item's windows in the
document are tried, each with slots of its own.

To hold 80 percent of n windows, a document must hold one of the item's rarest n - ceil(0.8 n) + 1.
Only those are joined with the windows of documents, by hash, so phrases that many items share
pair nothing. A bitmap of bounded size drops most other windows of documents before the shuffle;
it never drops a match.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytune.llm.ragged import (
    LOWER,
    M1,
    M2,
    M3,
    distinct,
    flat,
    mix,
    shingles,
    slices,
    span_hashes,
    strings,
    word_bounds,
)
from skytune.session import written

WINDOW, SHARE = 5, 0.8
#: The bitmap has at most this many bits, so at most half a megabyte is sent to the workers.
BITS = 1 << 22
CHUNK = 1 << 20

#: Units of measure (fixed values).
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yards mile miles mg g kg t oz lb lbs ml cl l liter "
    "liters litre litres s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years mph kmh km/h m/s hz khz mhz ghz b kb mb gb tb w kw v a j kj "
    "cal kcal n pa kpa c f k degrees degree percent % usd eur dollars dollar euros euro cents cent"
).split()

SOLID = np.zeros(256, bool)
SOLID[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
STOPS = np.zeros(256, bool)
STOPS[list(b".!?:")] = True
NUMBER, NAME, UNIT = mix(np.array([M1, M2, M3], np.uint64))


def _hash(text: str) -> int:
    raw = np.frombuffer(text.encode() + bytes(8), np.uint8)
    return span_hashes(raw, np.array([0]), np.array([len(raw) - 8]))[0]


UNIT_HASHES = np.sort(np.array([_hash(u) for u in UNITS], np.uint64))


class Templates:
    """Tokens of some texts: literal and template hashes, kinds, and counts as ``Words`` has."""

    def __init__(self, texts: pa.LargeStringArray) -> None:
        data, at = flat(texts)
        n = len(data)
        padded = np.zeros(n + 8, np.uint8)
        padded[:n] = data
        starts, ends = word_bounds(padded, at)
        solid = np.zeros(n + 2, np.int8)
        solid[1 : n + 1] = SOLID[data]
        edge = np.diff(solid)
        on, off = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        text = np.searchsorted(at, starts, "right") - 1
        a, b = np.searchsorted(off, starts, "right"), np.searchsorted(on, ends, "left") - 1
        real = a <= b
        begin = np.maximum(on[np.minimum(a, max(len(on) - 1, 0))] if len(on) else starts, starts)
        finish = np.minimum(off[np.maximum(b, 0)] if len(on) else ends, ends)
        lines = np.concatenate([np.zeros(1, np.int64), np.cumsum(data == 10)])
        fresh = np.ones(len(starts), bool)  # first of a text, a line or a sentence
        fresh[1:] = (
            (text[1:] != text[:-1])
            | (lines[starts[1:]] != lines[ends[:-1]])
            | STOPS[padded[ends[:-1] - 1]]
        )
        begin, finish, text, fresh = begin[real], finish[real], text[real], fresh[real]
        first, second, third = (padded[np.minimum(begin + i, n)] for i in range(3))
        wide = (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
        capital = ((first >= 65) & (first <= 90)) | wide
        after = np.where(wide, third, second)
        small = ((after >= 97) & (after <= 122)) | (after >= 128)
        lower = LOWER[padded]
        up = (padded[:-1] == 0xC3) & (padded[1:] >= 0x80) & (padded[1:] <= 0x9E) & (padded[1:] != 0x97)
        lower[1:][up] += 32
        self.literal = span_hashes(lower, begin, finish)
        number = (first >= 48) & (first <= 57)
        near = np.minimum(np.searchsorted(UNIT_HASHES, self.literal), len(UNIT_HASHES) - 1)
        unit = UNIT_HASHES[near] == self.literal
        unit[1:] &= number[:-1] & (text[1:] == text[:-1])
        unit[:1] = False
        proper = capital & small & ~number & ~unit & (finish - begin > 1)
        name, self.opening = proper & ~fresh, proper & fresh
        self.set_kinds(np.select([number, unit, name], [1, 2, 3], 0))
        self.texts = text
        self.counts = np.bincount(text, minlength=len(at) - 1)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def set_kinds(self, kind: np.ndarray) -> None:
        self.kind = kind
        self.hashes = np.choose(kind, [self.literal, NUMBER, UNIT, NAME])

    def readings(self) -> list[Templates]:
        """Names inside sentences, all capitalised tokens as names, no names, literal tokens."""
        out = [self]
        for kind in (
            np.where(self.opening, 3, self.kind),
            np.where(self.kind == 3, 0, self.kind),
            np.zeros_like(self.kind),
        ):
            other = copy(self)
            other.set_kinds(kind)
            out.append(other)
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text and first token of each window; a shorter text is one literal window."""
        h, text, start = shingles(self, WINDOW)
        plain = np.concatenate([[0], np.cumsum(self.kind == 0)])
        size = np.minimum(WINDOW, self.counts[text])
        few = (size < WINDOW) | (plain[start + size] - plain[start] < 2)
        if few.any():
            h = np.where(few, self.literal_windows(WINDOW)[0], h)
        return h, text, start

    def literal_windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of each run of ``size`` literal tokens."""
        made, self.hashes = self.hashes, self.literal
        h, text, start = shingles(self, size)
        self.hashes = made
        return mix(h ^ M3), text, start


def window_rows(
    texts: DataFrame, bitmap: np.ndarray | None, short: Sequence[int] = ()
) -> DataFrame:
    """(id, mark, h): the different windows of each row of (id, mark, text) that the bitmap lets by.

    Literal windows of the sizes in ``short`` are among them. Without a bitmap they are
    (id, mark, reading, h), told apart by reading.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, CHUNK):
            templates = Templates(strings(batch.column(2)))
            made = [t.windows()[:2] for t in templates.readings()]
            made += [templates.literal_windows(size)[:2] for size in short]
            if bitmap is None:
                made = [distinct(h, text) for h, text in made]
            else:
                h, text = (np.concatenate(x) for x in zip(*made, strict=True))
                bit = (h & np.uint64(len(bitmap) * 64 - 1)).astype(np.int64)
                passed = (bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
                made = [distinct(h[passed], text[passed])]
            for reading, (h, text) in enumerate(made):
                rows = pa.array(text)
                columns = [batch.column(0).take(rows), batch.column(1).take(rows)]
                names = ["id", "mark", "h"]
                if bitmap is None:
                    columns.append(pa.array(np.full(len(h), reading, np.int32)))
                    names.insert(2, "reading")
                columns.append(pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    told = "" if bitmap is not None else "reading int, "
    return texts.mapInArrow(run, f"id long, mark long, {told}h long")


def short_sizes(items: DataFrame) -> list[int]:
    """Numbers of tokens of the items that are shorter than a window; at most four."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, CHUNK):
            counts = np.unique(Templates(strings(batch.column(2))).counts)
            few = counts[(counts > 0) & (counts < WINDOW)]
            yield pa.RecordBatch.from_arrays([pa.array(few, pa.int64())], names=["size"])

    return sorted(r[0] for r in items.mapInArrow(run, "size long").distinct().collect())


def rare_windows(items: DataFrame, share: float) -> DataFrame:
    """(item, h): of each item the rarest windows of each reading, one of which a match must hold."""
    every = window_rows(items, None).select(F.col("id").alias("item"), "reading", "h").distinct()
    often = every.groupBy("h").agg(F.countDistinct("item").alias("items"))
    sized = every.groupBy("item", "reading").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("item", "reading").orderBy("items", "h")
    spare = F.col("n") - F.ceil(F.col("n") * share - 1e-9) + 1
    return (
        every.join(often, "h").join(sized, ["item", "reading"])
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= spare)
        .select("item", "h").distinct()
    )


def bitmap_of(windows: DataFrame) -> np.ndarray:
    """One bit for each window, by the low bits of its hash."""
    n = windows.select("h").distinct().count()
    bits = 1024
    while bits < BITS and bits < 64 * n:
        bits *= 2
    bit = F.col("h").bitwiseAND(bits - 1)
    words = windows.select(
        F.shiftright(bit, 6).alias("word"),
        F.expr(f"shiftleft(1L, cast((h & {bits - 1}) % 64 as int))").alias("value"),
    ).groupBy("word").agg(F.bit_or("value").alias("value"))
    out = np.zeros(bits // 64, np.int64)
    for r in words.collect():  # at most BITS / 64 short rows
        out[r["word"]] = r["value"]
    return out.view(np.uint64)


class Slots:
    """What the slot values of an item stand for in a document."""

    def __init__(self, doc: Templates, item: Templates) -> None:
        self.doc, self.item = doc, item
        self.values: dict[tuple[int, int], int] = {}
        self.back: dict[int, int] = {}

    def take(self, start: int, place: int) -> bool:
        """Bind the slots of the window at ``start`` to its place if they fit what is bound."""
        fresh: dict[tuple[int, int], int] = {}
        names: dict[int, int] = {}
        for k in range(min(WINDOW, len(self.item.kind) - start)):
            kind = int(self.item.kind[start + k])
            if not kind:
                continue
            key = (kind, int(self.item.literal[start + k]))
            value = int(self.doc.literal[place + k])
            if self.values.get(key, fresh.get(key, value)) != value:
                return False
            if kind == 3 and self.back.get(value, names.get(value, key[1])) != key[1]:
                return False
            fresh[key] = value
            if kind == 3:
                names[value] = key[1]
        self.values.update(fresh)
        self.back.update(names)
        return True


def fitting_share(doc: Templates, item: Templates, least: float = 0.0) -> float:
    """Share of the item's different windows that the document holds with slots that fit.

    Every alignment, place minus start of some matching window, is tried with slots of its own and
    the best counts. Windows that an alignment leaves out are then looked for next to it, as words
    may be put in or left out inside a copy. A share below ``least`` may be given as zero.
    """
    want, _, at = item.windows()
    own = len(item.kind)
    have, _, place = doc.literal_windows(own) if 0 < own < WINDOW else doc.windows()
    order = np.lexsort((place, have))
    have, place = have[order], place[order]
    low, high = np.searchsorted(have, want), np.searchsorted(have, want, "right")
    met = np.flatnonzero(high > low)
    total, most = max(len(set(want.tolist())), 1), len(set(want[met].tolist()))
    if not most or most / total < least - 1e-9:
        return 0.0
    windows = [(int(want[i]), int(at[i]), place[low[i] : high[i]].tolist()) for i in met.tolist()]
    aligned: dict[int, list[int]] = {}
    for w, (_, start, places) in enumerate(windows):
        for p in places:
            aligned.setdefault(p - start, []).append(w)
    best = 0
    for shift, held in sorted(aligned.items(), key=lambda x: (-len(x[1]), x[0])):
        slots = Slots(doc, item)
        taken = [w for w in held if slots.take(windows[w][1], windows[w][1] + shift)]
        good, known = {windows[w][0] for w in taken}, set(taken)
        own = shift
        for w, (h, start, places) in enumerate(windows):
            if w in known:
                own = shift
            elif h not in good:
                at_least = bisect_left(places, start + own)
                for p in sorted(places[max(at_least - 1, 0) : at_least + 2], key=lambda p: abs(p - start - own)):
                    if slots.take(start, p):
                        good.add(h)
                        own = p - start
                        break
        best = max(best, len(good))
        if best == most:
            break
    return best / total


def held_share(doc: Templates, item: Templates, least: float = 0.0) -> float:
    """The best share of the item over all readings; one below ``least`` may be given as zero."""
    best = 0.0
    for own, other in zip(doc.readings(), item.readings(), strict=True):
        best = max(best, fitting_share(own, other, max(least, best)))
        if best >= 1:
            break
    return best


def found_items(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc, mark, item, share) of every document of (doc, mark, text) that holds an item."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("id"), F.lit(0).cast("long").alias("mark"), "text"
    )
    rare = written(rare_windows(items, share), "windows")
    named = docs.select(F.col("doc").alias("id"), "mark", "text")
    seen = window_rows(named, bitmap_of(rare), short_sizes(items))
    pairs = written(
        seen.join(rare, "h").select(F.col("id").alias("doc"), "mark", "item").distinct(), "pairs"
    )
    held = docs.join(
        pairs.withColumnsRenamed({"doc": "_doc", "mark": "_mark"}),
        F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark")),
    ).select("doc", "mark", "item", "text")
    both = held.join(
        items.select(F.col("id").alias("item"), F.col("text").alias("item_text")), "item"
    ).select("doc", "mark", "item", "text", "item_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, others = strings(batch.column(3)), strings(batch.column(4))
            got = np.array([
                held_share(Templates(texts.slice(i, 1)), Templates(others.slice(i, 1)), share)
                for i in range(batch.num_rows)
            ], np.float64)
            rows = pa.array(np.flatnonzero(got >= share - 1e-9))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(rows) for i in range(3)), pa.array(got).take(rows)],
                names=["doc", "mark", "item", "share"],
            )

    return both.mapInArrow(run, "doc long, mark long, item long, share double")


def contamination(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """Per row: (doc_id, contaminated, items, share, mark).

    ``items`` has the ids of the items held, in order, ``share`` the largest share of windows.
    Null and empty texts hold nothing. Rows and ids may repeat, ids may be null. Items without
    an id or without tokens are found nowhere; of several rows of one item each is looked for.
    """
    text = F.coalesce("text", F.lit(""))
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text")
    )
    hits = found_items(own, benchmark, share).groupBy("doc", "mark").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.max("share").alias("share")
    ).withColumnsRenamed({"doc": "_doc", "mark": "_mark"})
    met = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark"))
    return own.select("doc", "mark").join(hits, met, "left").select(
        F.col("doc").alias("doc_id"),
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
        "mark",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` with the same columns, without documents that hold an item."""
    gone = contamination(docs, benchmark, share).where("contaminated").select(
        F.col("doc_id").alias("_gone"), F.col("mark").alias("_mark")
    )
    met = docs["doc_id"].eqNullSafe(gone["_gone"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["_mark"]
    )
    return docs.join(gone, met, "left_anti")

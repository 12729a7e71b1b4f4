"""Long repeats: bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere.

The windows of ``LENGTH`` bytes of a text are dealt by content. Each window has an anchor, its
32-byte string of least hash, so equal windows have equal anchors at equal offsets. Windows of one
anchor whose offsets fall into the same stretch of ``STRETCH`` form a context: the bytes they
cover together. All windows of a context share its core, the bytes common to that stretch of
offsets. So, by counting hashes alone,

* a context whose core is found nowhere else holds no repeated window;
* if the whole context is found elsewhere, all of its windows repeat.

What is left are contexts at the borders of repeats. The different contexts of each core go to one
shard, which sorts their suffixes into a run-length Burrows-Wheeler transform. Longest matches
with the neighbouring suffix are compared byte by byte at run ends only; in between, a match is one
byte shorter than at the place before, so streaming over the text gives the length of the longest
match that starts at each byte. Cores with more contexts than a shard may hold are split further:
their windows are dealt by hash. Windows count as equal there if their cores agree, and the hashes
of the whole window and of both its halves: windows that differ, differ in a half, so at least two
64-bit hashes besides the core's tell them apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytune.llm.ragged import M1, M2, M3, eight, flat, mix, slices, span_hashes, strings
from skytune.session import release, written

LENGTH, GRAM, STRETCH = 400, 32, 96
#: Different contexts of one core that a shard sorts together; bytes of a shard.
MOST, SHARD = 2048, 2 << 20
CHUNK = 1 << 20
#: Texts beyond this size are searched in tiles; a place in a tile takes 26 bits.
TILE = 1 << 25
PLACE = np.uint64((1 << 26) - 1)


def gram_hashes(padded: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each of the first ``n`` places on."""
    view = eight(padded)
    h = view[:n].copy()
    for skip in range(8, GRAM, 8):
        h = (h ^ (h >> np.uint64(29))) * M1 + view[skip : skip + n]
    return mix(h)


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks both ways."""
    n = len(v)
    blocks = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[:n] = v
    blocks = blocks.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def contexts(
    data: np.ndarray, at: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first window, number of windows, core hash and whole hash of each context.

    The first window counts from the start of the flat bytes.
    """
    if at[-1] > TILE:  # one long text
        step = TILE - length
        parts = []
        for start in range(0, int(at[-1]) - length + 1, step):
            piece = data[start : start + step + length - 1]
            got = contexts(piece, np.array([0, len(piece)]), length)
            parts.append((got[0], got[1] + start, *got[2:]))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    n = int(at[-1])
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    padded = np.concatenate([data, np.zeros(GRAM + 8, np.uint8)])
    h = gram_hashes(padded, n - GRAM + 1)
    v = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_least(v, length - GRAM + 1) & PLACE).astype(np.int64)
    size = np.diff(at)
    fits = np.maximum(size - length + 1, 0)
    window = np.repeat(at[:-1] - (np.cumsum(fits) - fits), fits) + np.arange(int(fits.sum()))
    if not len(window):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    text = np.repeat(np.arange(len(size)), fits)
    anchor = anchor[window]
    stretch = (anchor - window) // STRETCH
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (stretch[1:] != stretch[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(window)))
    start, anchor, stretch, text = window[first], anchor[first], stretch[first], text[first]
    # offsets of this stretch are low to high: all windows hold anchor - low to anchor - high + length
    low = stretch * STRETCH
    high = np.minimum(low + STRETCH - 1, length - GRAM)
    core = span_hashes(padded, anchor - low, anchor - high + length)
    core = mix(core ^ (stretch.astype(np.uint64) * M2))
    whole = span_hashes(padded, start, start + count - 1 + length)
    whole = mix(whole ^ ((anchor - start).astype(np.uint64) * M3))
    return text, start, count, core, whole


def suffix_order(sym: np.ndarray, owner: np.ndarray, longest: int) -> np.ndarray:
    """Places of ``sym`` in order of their suffixes, by doubling the sorted length.

    Symbol 0 ends each string and sorts by the string it ends. ``longest`` is the length of the
    longest string with its end.
    """
    n = len(sym)
    padded = np.concatenate([sym, np.zeros(8, np.uint8)])
    key = eight(padded)[:n].byteswap()
    # nothing behind an end counts
    ends = np.flatnonzero(sym == 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    near = left < 8
    drop = (np.uint64(64) - (left[near].astype(np.uint64) << np.uint64(3)))
    small = key[near]
    key[near] = np.where(drop < 64, (small >> drop) << drop, np.uint64(0))
    tie = np.where(near, owner + 1, 0)
    order = np.lexsort((tie, key))
    k, t = key[order], tie[order]
    new = np.ones(n, bool)
    new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    first = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    done = 8
    while done < longest:
        shared = np.zeros(n, bool)
        shared[1:] |= ~new[1:]
        shared[:-1] |= ~new[1:]
        slots = np.flatnonzero(shared)
        if not len(slots):
            break
        places = order[slots]
        # a suffix that is not told apart yet does not end within the sorted length
        pair = rank[places] * n + rank[places + done]
        by = np.argsort(pair)
        places, pair = places[by], pair[by]
        order[slots] = places
        fresh = np.ones(len(slots), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        new[slots] = fresh
        first = np.flatnonzero(fresh)
        rank[places] = np.repeat(slots[first], np.diff(np.append(first, len(slots))))
        done *= 2
    return order


def common_prefix(padded: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Bytes that two suffixes share, at most ``most``; an end matches nothing."""
    view = eight(padded)
    out = np.zeros(len(x), np.int64)
    todo = np.arange(len(x))
    step = 0
    while len(todo) and step < most:
        a, b = view[x[todo] + step], view[y[todo] + step]
        ends = (a - np.uint64(0x0101010101010101)) & ~a & np.uint64(0x8080808080808080)
        stop = (a ^ b) | ends
        same = stop == 0
        half = todo[~same]
        bit = stop[~same]
        lowest = bit & (~bit + np.uint64(1))
        out[half] = step + (np.log2(lowest.astype(np.float64)).astype(np.int64) >> 3)
        todo = todo[same]
        step += 8
    out[todo] = most
    return np.minimum(out, most)


def longest_matches(strings_: list[bytes], most: int) -> np.ndarray:
    """At each byte of the joined strings, the longest match with any other place, up to ``most``.

    Each string is followed by one end symbol.
    """
    sizes = np.array([len(s) + 1 for s in strings_])
    raw = np.frombuffer(b"".join(s + b"\xff" for s in strings_), np.uint8)
    sym = raw + np.uint8(1)  # no UTF-8 text has byte 255: the end becomes 0
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = suffix_order(sym, owner, int(sizes.max()))
    n = len(sym)
    padded = np.concatenate([sym, np.zeros(most + 16, np.uint8)])
    # the transform: the symbol before each suffix; ends differ from all others
    before = sym[order - 1].astype(np.int64)
    end = before == 0
    before[end] = 256 + np.arange(int(end.sum()))
    border = np.flatnonzero(before[1:] != before[:-1]) + 1  # runs begin here
    best = np.zeros(n, np.int64)
    for place, other in ((order[border], order[border - 1]), (order[border - 1], order[border])):
        known = np.full(n, -1, np.int64)
        known[place] = common_prefix(padded, place, other, 1 << 20 if most < 0 else most + STRETCH)
        where = np.where(known >= 0, np.arange(n), -1)
        where = np.maximum.accumulate(where)
        length = np.where(where >= 0, known[where] - (np.arange(n) - where), 0)
        best = np.maximum(best, length)
    return best


def shard_task(length: int):
    """Of a shard's contexts, the runs of repeated windows of those that are not settled yet."""

    def run(table: pa.Table) -> pa.Table:
        bodies = [b.as_py() for b in table.column("body")]
        best = longest_matches(bodies, length)
        repeated = best >= length
        sizes = np.array([len(b) + 1 for b in bodies])
        at = np.cumsum(sizes) - sizes
        own, start, count = [], [], []
        for i in np.flatnonzero(table.column("single").to_numpy(zero_copy_only=False)).tolist():
            for s, c in true_runs(repeated[at[i] : at[i] + sizes[i]]):
                own.append(i)
                start.append(s)
                count.append(c)
        rows = pa.array(own, pa.int64())
        first = table.column("start").take(rows).to_numpy() + np.array(start, np.int64)
        return pa.Table.from_arrays(
            [table.column("doc").take(rows), table.column("mark").take(rows),
             pa.array(first), pa.array(np.array(count, np.int64))],
            names=["doc", "mark", "start", "count"],
        )

    return run


def true_runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist(), strict=True))


CONTEXT = "doc long, mark long, start long, count long, core long, whole long"
FOUND = "doc long, mark long, start long, count long"


def text_contexts(docs: DataFrame, length: int) -> DataFrame:
    """The contexts of every row of (doc, mark, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, CHUNK):
            data, at = flat(strings(batch.column(2)))
            text, start, count, core, whole = contexts(data, at, length)
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array(start - at[text]), pa.array(count),
                 pa.array(core.view(np.int64)), pa.array(whole.view(np.int64))],
                names=["doc", "mark", "start", "count", "core", "whole"],
            )

    return docs.mapInArrow(run, CONTEXT)


def per_text(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per text with a list of what the rows say of it."""
    return rows.groupBy("doc", "mark").agg(F.collect_list(F.struct(*columns)).alias("items"))


def with_items(docs: DataFrame, items: DataFrame, how: str) -> DataFrame:
    met = docs["doc"].eqNullSafe(items["doc"]) & (docs["mark"] == items["mark"])
    return docs.join(items, met, how).select(docs["doc"], docs["mark"], "text", "items")


def context_bytes(listed: DataFrame, length: int) -> DataFrame:
    """(doc, mark, start, core, single, body) of listed contexts."""
    schema = "doc long, mark long, start long, core long, single boolean, body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, CHUNK):
            rows, bodies = [], []
            for i in range(batch.num_rows):
                raw = strings(batch.column(2).slice(i, 1))[0].as_buffer().to_pybytes()
                for item in batch.column(3)[i].as_py():
                    rows.append((i, item["start"], item["core"], item["single"]))
                    bodies.append(raw[item["start"] : item["start"] + item["count"] - 1 + length])
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at),
                 *(pa.array([r[j] for r in rows], k)
                   for j, k in ((1, pa.int64()), (2, pa.int64()), (3, pa.bool_()))),
                 pa.array(bodies, pa.binary())],
                names=[x.split()[0] for x in schema.split(", ")],
            )

    return listed.mapInArrow(run, schema)


def window_hashes(listed: DataFrame, length: int) -> DataFrame:
    """(doc, mark, start, core, h, h1, h2, single) of each window of the listed contexts.

    ``h`` is the hash of the window, ``h1`` and ``h2`` are those of its halves.
    """
    schema = "doc long, mark long, start long, core long, h long, h1 long, h2 long, single boolean"
    half = length // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, CHUNK):
            data, at = flat(strings(batch.column(2)))
            padded = np.concatenate([data, np.zeros(8, np.uint8)])
            items = batch.column(3)
            text = np.repeat(np.arange(batch.num_rows), np.diff(items.offsets.to_numpy()))
            part = items.flatten()
            start, count, core = (part.field(f).to_numpy() for f in ("start", "count", "core"))
            single = part.field("single").to_numpy(zero_copy_only=False)
            every = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())
            text, single, core = (np.repeat(x, count) for x in (text, single, core))
            here = at[text] + every
            rows = pa.array(text)
            spans = ((here, here + length), (here, here + half), (here + half, here + length))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(every),
                 pa.array(core),
                 *(pa.array(span_hashes(padded, a, b).view(np.int64)) for a, b in spans),
                 pa.array(single)],
                names=[x.split()[0] for x in schema.split(", ")],
            )

    return listed.mapInArrow(run, schema)


def repeated_windows(docs: DataFrame, length: int) -> DataFrame:
    """Runs (doc, mark, start, count) of windows of (doc, mark, text) that repeat."""
    found = written(text_contexts(docs, length), "contexts")
    whole = found.groupBy("core", "whole", "count").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.xxhash64("doc", "mark", "start")).alias("first"),
    )
    classes = written(whole, "classes")
    cores = classes.groupBy("core").agg(
        F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"),
        F.sum((F.col("n") == 1).cast("int")).alias("singles"),
    ).where(F.col("all") > 1)
    known = classes.join(cores, "core").select(
        "core", "whole", "count", "n", "first", "kinds", (F.col("singles") > 0).alias("open")
    )
    told = written(
        found.join(known, ["core", "whole", "count"]).select(
            "doc", "mark", "start", "count", "core", "kinds",
            (F.col("n") == 1).alias("single"),
            (F.col("open") & (F.col("first") == F.xxhash64("doc", "mark", "start"))).alias("sent"),
        ),
        "told",
    )
    release(found, classes)
    sent = told.where("sent")
    columns = ("start", "count", "core", "single")
    bodies = written(
        context_bytes(with_items(docs, per_text(sent.where(F.col("kinds") <= MOST), *columns), "inner"), length),
        "bodies",
    )
    size = bodies.agg(F.sum(F.length("body"))).first()[0] or 0
    shards = max(1, -(-size // SHARD))
    sorted_ = written(
        bodies.withColumn("shard", F.pmod(F.xxhash64("core"), F.lit(shards)))
        .groupBy("shard").applyInArrow(shard_task(length), FOUND),
        "matches",
    )
    release(bodies)
    windows = written(
        window_hashes(with_items(docs, per_text(sent.where(F.col("kinds") > MOST), *columns), "inner"), length),
        "windows",
    )
    same = ["core", "h", "h1", "h2"]
    common = windows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    dealt = windows.where("single").join(common, same).select(
        "doc", "mark", "start", F.lit(1).cast("long").alias("count")
    )
    settled = told.where(~F.col("single")).select("doc", "mark", "start", "count")
    return settled.unionByName(sorted_).unionByName(dealt)


def covered(items: np.ndarray, n: int, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under the windows (start, count)."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, items[:, 0], 1)
    np.add.at(change, items[:, 0] + items[:, 1] - 1 + length, -1)
    return true_runs(np.cumsum(change[:-1]) > 0)


def repeat_spans(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: (doc_id, text, spans), spans the runs (start, length) of repeated bytes.

    Texts are UTF-8 bytes; null is empty. Every row is a text of its own, so a repeated row makes
    all its windows repeat. Ids may be null or repeat. Texts shorter than ``length`` bytes have no
    span, nor has an empty table any row.
    """
    docs = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).select("doc", F.xxhash64("text").alias("mark"), "text")
    found = per_text(repeated_windows(docs, length), "start", "count")
    schema = "doc_id long, text string, spans array<struct<start: bigint, length: bigint>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, CHUNK):
            texts = strings(batch.column(2))
            sizes = np.diff(flat(texts)[1]).tolist()
            spans = []
            for n, items in zip(sizes, batch.column(3), strict=True):
                if not items.is_valid:
                    spans.append([])
                    continue
                part = items.values
                pairs = np.stack([part.field(f).to_numpy() for f in ("start", "count")], axis=1)
                spans.append([{"start": s, "length": c} for s, c in covered(pairs, n, length)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), texts.cast(pa.string()), pa.array(spans, kind)],
                names=["doc_id", "text", "spans"],
            )

    return with_items(docs, found, "left").mapInArrow(run, schema)


def repeat_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: bytes, removed bytes, removed runs and the digest of the rest."""
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_buffer().to_pybytes()
                digest, place, gone = hashlib.sha256(), 0, 0
                for s in spans.as_py():
                    digest.update(raw[place : s["start"]])
                    place = s["start"] + s["length"]
                    gone += s["length"]
                digest.update(raw[place:])
                rows.append((len(raw), gone, len(spans), digest.hexdigest()))
            columns = zip(*rows, strict=True) if rows else ([], [], [], [])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=[x.split()[0] for x in schema.split(", ")],
            )

    return repeat_spans(docs, length).mapInArrow(run, schema)

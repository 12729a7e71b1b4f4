"""Fingerprints of documents as multisets of paragraphs, added up modulo powers of two.

Every paragraph (line) hashes to a wide vector; the fingerprint of a document is the sum of its
paragraphs' vectors. Sums do not depend on order, and a paragraph is inserted or deleted by adding
or subtracting its vector. The vector has two parts:

* ``EXACT`` lanes of 64 bits, hashed from the whole paragraph, summed modulo 2**64. Two documents
  agree in them only if they hold the same paragraphs equally often (but for hash collisions).
* ``NEAR`` lanes of 32 bits. Every run of eight bytes of the paragraph adds plus or minus one to
  one lane that its hash names, modulo 2**32, which no text that fits into a row wraps. Differences of such sums estimate how far two
  multisets are apart, so this part tells likeness.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from skytune.llm.ragged import M1, eight, flat, mix, slices, span_hashes, strings, times

EXACT, NEAR, GRAM = 4, 256, 8
BYTES = EXACT * 8 + NEAR * 4
CHUNK = 1 << 20


def paragraph_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every line; an empty text has one empty line."""
    cut = np.flatnonzero(data == 10)
    starts = np.concatenate([at[:-1], cut + 1])
    text = np.concatenate([np.arange(len(at) - 1), np.searchsorted(at, cut, "right") - 1])
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    last = np.ones(len(starts), bool)
    last[:-1] = text[1:] != text[:-1]
    ends[last] = at[1:][text[last]]
    return starts, ends, text


def vectors(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Exact lanes (uint64) and near lanes (uint32) of each text."""
    n = len(texts)
    data, at = flat(texts)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    starts, ends, text = paragraph_bounds(data, at)
    exact = np.zeros((n, EXACT), np.uint64)
    h = span_hashes(padded, starts, ends)
    for lane in range(EXACT):
        np.add.at(exact[:, lane], text, mix(h + times(lane + 1, M1)))
    # windows of GRAM bytes inside a paragraph; a shorter paragraph is one window
    size = ends - starts
    windows = np.maximum(size - GRAM + 1, (size > 0).astype(np.int64))
    total = int(windows.sum())
    owner = np.repeat(text, windows)
    place = np.repeat(starts - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
    place += np.arange(total)
    word = eight(padded)[place]
    short = np.repeat(size < GRAM, windows)
    if short.any():
        drop = np.uint64(64) - (np.repeat(size, windows)[short].astype(np.uint64) << np.uint64(3))
        word[short] = (word[short] << drop) >> drop
    g = mix(word + M1)
    lane = (g & np.uint64(NEAR - 1)).astype(np.int64)
    sign = 1.0 - 2.0 * ((g >> np.uint64(32)) & np.uint64(1)).astype(np.float64)
    near = np.bincount(owner * NEAR + lane, sign, minlength=n * NEAR).astype(np.int64)
    return exact, near.astype(np.uint32).reshape(n, NEAR)


def add(one: bytes, other: bytes, sign: int = 1) -> bytes:
    """Fingerprint of the union (or, with -1, the difference) of two paragraph multisets."""
    a, b = parts(one), parts(other)
    pick = np.add if sign > 0 else np.subtract
    return pick(a[0], b[0]).tobytes() + pick(a[1], b[1]).tobytes()


def parts(value: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(value[: EXACT * 8], "<u8"), np.frombuffer(value[EXACT * 8 :], "<u4")


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row by row, 0 to 1: the estimated share that two multisets have in common.

    The squared length of a sum of signs estimates the squared length of the multiset. With a, b
    and d the squared lengths of both and of their difference, the value is
    (a + b - d) / (a + b + d), which for sets without repeats is the Jaccard likeness.
    """
    a, b = one.astype(np.int32).astype(np.float64), other.astype(np.int32).astype(np.float64)
    d = (one - other).astype(np.int32).astype(np.float64)
    aa, bb, dd = ((x * x).sum(axis=1) for x in (a, b, d))
    total = aa + bb + dd
    value = np.divide(aa + bb - dd, total, out=np.ones_like(total), where=total > 0)
    return np.clip(value, 0.0, 1.0)


def printed(exact: np.ndarray, near: np.ndarray) -> list[str]:
    """The fingerprints as text."""
    raw = np.concatenate(
        [np.ascontiguousarray(exact.astype("<u8")).view(np.uint8).reshape(len(exact), -1),
         np.ascontiguousarray(near.astype("<u4")).view(np.uint8).reshape(len(near), -1)], axis=1
    )
    return [base64.b85encode(row.tobytes()).decode() for row in raw]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; null texts count as empty. Rows and ids may repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, CHUNK):
            made = printed(*vectors(strings(batch.column(1))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made)], names=["doc_id", "fingerprint"]
            )

    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return own.mapInArrow(run, "doc_id long, fingerprint string")


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def id_bounds(docs: DataFrame, n: int) -> list[int]:
    """At most n - 1 ids that cut the documents into about equal parts."""
    if n < 2:
        return []
    cuts = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx("doc_id", cuts, 20 * n)).first()[0]
    return sorted(set(found or []))


def edit_report(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every text against its edited form and against the next document, by descending id.

    The last third (rounded down) of the code points is replaced by as many of the next document's
    first ones, or all it has; the last document is followed by the first. Documents are dealt by
    ranges of their id. Each range also gets a copy of the first document of the range below, so
    each text moves once and no task needs another's rows. Rows with equal ids follow each other by
    the digest of their texts. Rows without an id come last, ordered likewise.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc_id"),
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    bounds = id_bounds(own.select("doc_id"), n)
    places = np.array(bounds, np.int64)

    @pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        above = len(places) - np.searchsorted(places, ids.to_numpy(np.int64), "left")
        return pd.Series(above.astype(np.int32))

    # one number per range: the largest id it holds
    heads = own.select("doc_id").withColumn("part", part("doc_id")).groupBy("part").agg(
        F.max("doc_id").alias("head")
    ).collect()
    order = sorted((r["part"], r["head"]) for r in heads)
    if not order:
        return spark.createDataFrame([], RESULT)
    # The largest id of each range also goes to the range above; that of the first wraps round.
    guests = spark.createDataFrame(
        [(head, order[i - 1][0]) for i, (_, head) in enumerate(order)], "head long, above int"
    )
    at_home = F.struct(F.col("part").alias("p"), F.lit(0).alias("guest"))
    as_guest = F.struct(F.col("above").alias("p"), F.lit(1).alias("guest"))
    moved = (
        own.withColumn("part", part("doc_id"))
        .join(F.broadcast(guests), F.col("doc_id") == F.col("head"), "left")
        .withColumn(
            "to",
            F.explode(
                F.when(F.col("head").isNull(), F.array(at_home)).otherwise(
                    F.array(at_home, as_guest)
                )
            ),
        )
        .select("to.p", "to.guest", "doc_id", "no_id", "text", F.sha2("text", 256).alias("digest"))
        .repartitionById(order[-1][0] + 1, "p")
        .sortWithinPartitions("p", "guest", F.col("doc_id").desc(), "digest")
        .select("p", "guest", "doc_id", "no_id", "text")
    )
    return moved.mapInArrow(_edit, RESULT)


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order; the first guest row ends the range."""
    held: pa.RecordBatch | None = None
    for batch in slices(batches, 4, CHUNK):
        rows = batch if held is None else _joined(held, batch)
        yield from _pairs(rows)
        held = rows.slice(rows.num_rows - 1)


def _joined(one: pa.RecordBatch, other: pa.RecordBatch) -> pa.RecordBatch:
    return pa.Table.from_batches([one, other]).combine_chunks().to_batches()[0]


def _pairs(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The result for each row but the last, whose successor the caller brings."""
    p, guest = (rows.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    live = np.flatnonzero((guest[:-1] == 0) & (p[:-1] == p[1:]))
    if not len(live):
        return
    texts = strings(rows.column(4))
    raw = texts.to_pylist()
    edited = []
    sizes = []
    for i in live.tolist():
        text = raw[i]
        size, third = len(text), len(text) // 3
        sizes.append(size)
        edited.append(text[: size - third] + raw[i + 1][:third])
    exact, near = vectors(texts)
    edited_exact, edited_near = vectors(pa.array(edited, pa.large_string()))
    marks = printed(exact[live], near[live])
    ids = rows.column(2)
    ids = pc.if_else(rows.column(3), pa.scalar(None, pa.int64()), ids).take(pa.array(live))
    yield pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(sizes, pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array(marks),
            pa.array(printed(edited_exact, edited_near)),
            pa.array(likeness(near[live], edited_near)),
            pa.array(likeness(near[live], near[live + 1])),
        ],
        names=[x.split()[0] for x in RESULT.split(", ")],
    )

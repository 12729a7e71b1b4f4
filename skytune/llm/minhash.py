"""Near copies: SuperMinHash signatures, bands, exact checks on full sets, union-find groups.

A document is the set of its word shingles. Equal sets become one class. Classes that share a band
of their signatures meet in a bucket. In each bucket a few pivots are compared with all other
members, then more, until whatever is left of a bucket is one group already. Only members of
different groups are compared, once even if they share many buckets: by size and by the bits of
longer signatures first, and on their full sets where those leave a link possible.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytune.llm.ragged import M1, M2, M3, Words, distinct, mix, shingles, slices, strings, times
from skytune.session import release, written

CHUNK = 1 << 20
UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bits of the sketches that tell unlike pairs before their sets are compared.
BITS = 1024
SKETCH = tuple(f"b{i}" for i in range(BITS // 64))
#: Edges that a union-find task takes.
EDGES = 500_000
#: Members that one copy of a pivot's set is compared with.
PER_PIVOT = 256
#: Rows that are worth a task of their own.
ROWS = 10_000
#: Bitmaps of candidate ids, and the bits of one (what the bitmap functions use).
BITMAPS, BITMAP_BITS = 128, 32768


def superminhash(h: np.ndarray, text: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures of ``m`` registers of ``n`` sets, given as (element hash, set) pairs.

    Each element walks through a random permutation of the registers of its own. In step j it
    offers j plus a random fraction to the next register, so no register gets two offers of one
    step from one element. A set stops once no later step can lower any of its registers.
    """
    registers = np.full(n * m, UNSET, np.uint64)
    walk: np.ndarray | None = None
    for j in range(m):
        if j:
            limit = np.uint64(j) << np.uint64(32)
            open_sets = (registers.reshape(n, m) >= limit).any(axis=1)
            live = open_sets[text]
            if not live.any():
                break
            if walk is None:
                first = (mix(h[live] + M3) & np.uint64(0xFFFFFFFF)) % np.uint64(m)
                h, text = h[live], text[live]
                walk = np.broadcast_to(np.arange(m, dtype=np.uint16), (len(h), m)).copy()
                rows = np.arange(len(h))
                walk[rows, first.astype(np.int64)] = 0
                walk[:, 0] = first
            elif not live.all():
                h, text, walk = h[live], text[live], walk[live]
        r = mix(h + times(j, M1) + M3)
        pick = ((r & np.uint64(0xFFFFFFFF)) % np.uint64(m - j)).astype(np.int64) + j
        if walk is None:
            place = pick
        else:
            rows = np.arange(len(h))
            place = walk[rows, pick].astype(np.int64)
            walk[rows, pick] = walk[:, j]
            walk[:, j] = place
        offer = (np.uint64(j) << np.uint64(32)) | (r >> np.uint64(32))
        np.minimum.at(registers, text * m + place, offer)
    return registers.reshape(n, m)


def in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as few tasks as ``rows`` rows need, but one for each core.

    Partitions are put together whole and one after the other, so rows dealt to the same one stay
    next to each other, in order.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS)))


def set_digests(h: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over hashed elements that tell sets apart."""
    out = []
    for salt in (M1, M2):
        total = np.zeros(n, np.uint64)
        np.add.at(total, text, mix(h ^ salt))
        out.append(total)
    return out[0], out[1]


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, keys, mark) of every row of (doc_id, text, mark).

    ``keys`` has one hash per band, none for a document without words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, CHUNK):
            n = batch.num_rows
            h, text, _ = shingles(Words(strings(batch.column(1))), k)
            h, text = distinct(h, text)
            size = np.bincount(text, minlength=n)
            d1, d2 = set_digests(h, text, n)
            marks = superminhash(h, text, n, bands * rows).reshape(n, bands, rows)
            key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * M2, (n, bands)).copy()
            for r in range(rows):
                key = mix(key * M1 + marks[:, :, r])
            full = size > 0
            places = np.concatenate([[0], np.cumsum(np.where(full, bands, 0))]).astype(np.int32)
            values = pa.array(key[full].reshape(-1).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size, pa.int64()),
                    pa.array(d1.view(np.int64)),
                    pa.array(d2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(places), values),
                    batch.column(2),
                ],
                names=[x.split()[0] for x in schema.split(", ")],
            )

    schema = "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>, mark long"
    return docs.mapInArrow(run, schema)


def set_bytes(docs: DataFrame, k: int) -> DataFrame:
    """(id, shingle_set, b0 to b15) of rows of (id, text).

    The set is its sorted distinct hashes as bytes. The 1024 bits are one of each register of a
    signature; two sets of likeness J agree in a share of (1 + J) / 2 of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, CHUNK // 8):
            n = batch.num_rows
            h, text, _ = shingles(Words(strings(batch.column(1))), k)
            h, text = distinct(h, text)
            ends = np.cumsum(np.bincount(text, minlength=n)) * 8
            places = np.concatenate([[0], ends]).astype(np.int32)
            made = pa.Array.from_buffers(
                pa.binary(), n, [None, pa.py_buffer(places), pa.py_buffer(h.tobytes())]
            )
            bits = (mix(superminhash(h, text, n, BITS)) & np.uint64(1)).astype(np.uint8)
            packed = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), made, *(pa.array(packed[:, i].copy()) for i in range(BITS // 64))],
                names=["id", "shingle_set", *SKETCH],
            )

    columns = "".join(f", {b} long" for b in SKETCH)
    return docs.mapInArrow(run, f"id long, shingle_set binary{columns}")


def likely(percent: int) -> Column:
    """Whether the sketches of a pivot and a member leave it possible that they are linked.

    Sets of exactly the likeness asked for fail by chance once in 100,000 pairs.
    """
    share = (1 + percent / 100) / 2
    least = math.floor(BITS * share - 4.3 * math.sqrt(BITS * share * (1 - share)))
    apart = reduce(
        add, (F.bit_count(F.col(b).bitwiseXOR(F.col(f"{b}_a"))) for b in SKETCH)
    )
    return apart <= BITS - least


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough.

    The sets of all b meet that of their a: rows are dealt by (a, part), a part holding about
    ``PER_PIVOT`` of them, and streamed behind a copy of the set of a.
    """
    sized = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PER_PIVOT).cast("int").alias("parts"))
    pivots = (
        sets.join(sized, sets["id"] == sized["a"])
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("a", "part", F.lit(None).cast("long").alias("b"), "shingle_set")
    )
    members = (
        pairs.join(sized, "a")
        .withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
        .join(sets, F.col("b") == sets["id"])
        .select("a", "part", "b", "shingle_set")
    )
    dealt = pivots.unionByName(members).repartition("a", "part").sortWithinPartitions(
        "a", "part", F.col("b").asc_nulls_first()
    )
    dealt = in_tasks(dealt, pairs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = np.zeros(0, np.uint64)
        for batch in batches:
            a, b, found = batch.column(0), batch.column(2), []
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                if not b[i].is_valid:
                    pivot = own.copy()
                    continue
                place = np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)
                common = int((pivot[place] == own).sum())
                if 100 * common >= percent * (len(pivot) + len(own) - common):
                    found.append(i)
            rows = pa.array(found, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(rows), b.take(rows)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of a task: every node points to the least of its tree."""
    table = pa.Table.from_batches(list(batches), pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    for first in range(0, table.num_rows, 2 * EDGES):
        part = table.slice(first, 2 * EDGES)
        ends = [part.column(i).to_numpy() for i in (0, 1)]
        nodes, place = np.unique(np.concatenate(ends), return_inverse=True)
        parent = list(range(len(nodes)))

        def root(i: int, parent: list[int] = parent) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        half = part.num_rows
        for x, y in zip(place[:half].tolist(), place[half:].tolist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        roots = np.array([root(i) for i in range(len(nodes))])
        moved = roots != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[moved]), pa.array(nodes[roots[moved]])], names=["a", "b"]
        )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or the not larger) neighbours of each node on its least neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = both.join(least, "u")
    if large:
        hung = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hung = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return hung.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); the component is its least node.

    Tasks of about ``EDGES`` edges shrink them to trees by union-find. If there is one such task,
    that is all. Otherwise nodes then hang on ever smaller neighbours, large and small ones in
    turn, until each hangs on the least node of its component. No task sees a whole component of
    more edges.
    """
    flip = F.when(F.col("a") > F.col("b"), F.struct("a", "b")).otherwise(
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    start = edges.where(F.col("a") != F.col("b")).select(flip.alias("e")).select("e.a", "e.b")
    tasks = -(-start.count() // EDGES)
    now = written(start.coalesce(max(1, tasks)).mapInArrow(_forest, "a long, b long"), "edges")
    mark = _mark(now) if tasks > 1 else None
    while tasks > 1:
        after = written(_star(_star(now, True), False), "edges")
        release(now)
        now, before = after, mark
        mark = _mark(now)
        if mark == before:
            break
    return _named(now)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _named(stars: DataFrame) -> DataFrame:
    named = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    named._written_to = getattr(stars, "_written_to", None)
    return named


def near_groups(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    bands: int = 16,
    rows: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: (doc_id, n_shingles, component_id, kept, mark).

    Documents are linked whose shingle sets have a Jaccard likeness of ``percent`` or more. With
    16 bands of 3 registers a pair of likeness 0.8 shares no band once in 96,000 pairs, with bands
    of 4 one of 0.85 once in 130,000; all other steps are exact. A text without words is linked with nothing. A row without an id is
    linked with nothing, has no component and is kept. Equal ids with different texts each follow
    their own text; ``mark``, a hash of the text, tells them apart. An empty table gives no row.
    """
    text = F.col(f"`{text_col}`")
    own = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark"),
    )
    signed = written(signatures(own, k, bands, rows), "signatures")
    with_words = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    digest = ["d1", "d2", "n_shingles"]
    met = with_words.groupBy(*digest).agg(F.min("doc_id").alias("rep"))
    classes = written(in_tasks(met, signed.count()), "classes")
    first = with_words.withColumn("rep", F.col("doc_id")).join(classes, [*digest, "rep"])
    labels = _links(own, first, k, percent, classes.count() * bands)
    named = classes.join(labels, classes["rep"] == labels["node"], "left").select(
        *digest, F.coalesce("component", "rep").alias("_component")
    )
    found = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    return signed.join(named, digest, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), found).alias("component_id"),
        F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept"),
        "mark",
    )


def maybe_among(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``rows`` whose id may be among ``ids`` (id); none of those that are is left out.

    Each id sets one bit of ``BITMAPS`` bitmaps of fixed size, so at most half a megabyte is
    broadcast however many ids there are, and texts of most other rows are not shuffled.
    """
    def place(name: str) -> tuple[Column, Column]:
        h = F.xxhash64(name)
        return F.pmod(h, F.lit(BITMAPS)), F.pmod(F.shiftrightunsigned(h, 20), F.lit(BITMAP_BITS))

    group, bit = place("id")
    bits = ids.select(group.alias("_group"), bit.alias("_bit")).groupBy("_group").agg(
        F.bitmap_construct_agg("_bit").alias("_bits")
    )
    group, bit = place(column)
    byte = F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1)))
    is_set = F.getbit(F.conv(byte, 16, 10).cast("int"), (bit % 8).cast("int")) == 1
    met = rows.withColumn("_group", group).join(F.broadcast(bits), "_group").where(is_set)
    return met.select(*(F.col(f"`{c}`") for c in rows.columns))


def pivots_of(members: DataFrame, each: int) -> DataFrame:
    """The first members of each bucket, columns named ``_a``, and all buckets they are pivots in."""
    order = Window.partitionBy("bucket").orderBy("rep")
    first = members.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    every = F.collect_list("bucket").over(Window.partitionBy("rep"))
    return first.select(
        "bucket", every.alias("buckets_a"),
        *(F.col(c).alias(f"{c}_a") for c in ("rep", "n", "label", *SKETCH)),
    )


def meetings(pivots: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(a, b) of pivots and members that may be linked; each pair once.

    Likely pairs share many buckets. They are paired in the first one that has the pivot as a pivot.
    No condition has a lambda, which Spark would not compile, and with it the loop over all pairs.
    """
    close = 100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")
    first = F.get(F.array_intersect("buckets_a", "keys"), F.lit(0))
    return (
        pivots.join(members, "bucket")
        .where((F.col("rep_a") < F.col("rep")) & (F.col("label_a") != F.col("label")))
        .where(close & likely(percent))
        .where(first == F.col("bucket"))
        .select(F.col("rep_a").alias("a"), F.col("rep").alias("b"))
    )


def _links(own: DataFrame, first: DataFrame, k: int, percent: int, rows: int) -> DataFrame:
    """(node, component) of class representatives that are linked with others.

    ``rows`` is the number of their places in buckets.
    """
    keyed = first.select(
        "rep", F.col("n_shingles").alias("n"), F.col("rep").alias("label"),
        "keys", F.posexplode("keys").alias("band", "bucket"),
    ).distinct()
    shared = written(in_tasks(_mixed(keyed), rows), "buckets")
    rows = shared.count()
    ids = shared.select(F.col("rep").alias("id")).distinct()
    near = maybe_among(own, "doc_id", ids)
    texts = near.join(ids, near["doc_id"] == ids["id"]).select("id", "text")
    sets = written(set_bytes(texts, k), "sets")
    sketches = sets.select(F.col("id").alias("rep"), *SKETCH)
    left = written(in_tasks(shared.join(sketches, "rep"), rows), "buckets")
    release(shared)
    links: DataFrame | None = None
    labels: DataFrame | None = None
    pivots_each = 1
    while True:
        pivots = pivots_of(left, pivots_each)
        pairs = written(in_tasks(meetings(pivots, left, percent), rows), "pairs")
        found = written(linked(pairs, sets, percent), "links")
        links = found if links is None else links.unionByName(found)
        release(pairs, labels)
        labels = components(links)
        # pivots have met all of their bucket; a bucket is done when the rest is one group
        rest = (
            left.join(
                pivots.select("bucket", F.col("rep_a").alias("rep")), ["bucket", "rep"], "left_anti"
            )
            .join(labels, F.col("rep") == F.col("node"), "left")
            .select(
                "rep", "n", F.coalesce("component", "rep").alias("label"), "keys", "band", "bucket",
                *SKETCH,
            )
        )
        after = written(in_tasks(_mixed(rest), rows), "buckets")
        release(left)
        left, rows = after, after.count()
        if not rows:
            release(left, sets)
            return labels
        pivots_each *= 64


def _mixed(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one label."""
    ends = members.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = ends.where(F.col("lo") < F.col("hi")).select("bucket")
    return members.join(mixed, "bucket").select(*members.columns)


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the same columns and one document of each group: that of the least id.

    Repeated rows of that document stay together; rows without an id stay.
    """
    gone = near_groups(docs, **options).where(~F.col("kept")).select(
        F.col("doc_id").alias("_gone"), F.col("mark").alias("_mark")
    ).distinct()
    met = (docs["doc_id"] == gone["_gone"]) & (
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["_mark"]
    )
    return docs.join(gone, met, "left_anti")

"""Toxicity by the nearest labelled examples, by exact cosine of TF-IDF vectors.

Terms are all lower-case words of letters. A term weighs its logarithmic count, times its inverse
document frequency over all documents, times one plus its likelihood ratio if labelled toxic texts
hold it more often than others. Examples become entries of a block-max inverted index: postings by
term, with the largest weight of each term and block of entries. Terms of many entries are a dense
matrix, multiplied for some texts at once; with that part known, a text visits its best block, then
all blocks whose bound reaches its k-th neighbour so far. Where bounds spare few blocks, the next
texts visit all of them at once. Neighbours vote with the fourth power of their cosine.

``EXAMPLES`` and ``EXAMPLE_BYTES`` bound the labelled rows that are learned from, and so the index,
however large the corpus is. Documents are counted in whole, and every one is scored whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytune.llm.ragged import flat, slices, span_hashes, strings, word_bounds
from skytune.session import give_back, release, sent, written

EXAMPLES, EXAMPLE_BYTES, NEIGHBOURS = 20_000, 64 << 20, 25
#: A vote for the prior weighs as much as a neighbour of cosine 0.38.
PRIOR_VOTE = 0.02
BLOCK = 512
#: At most so many terms, each in one of 32 entries or more, are kept dense.
HEADS, HEAD_SHARE = 256, 32
#: Texts multiplied with the dense part at once.
ROWS = 128
#: Groups that a block is cut into; their best entries tell how near the k-th is at least.
GROUPS = 8
#: Bounds cost about as much as a third of the postings. After a text where they spare less than a
#: third of the blocks, so many texts go without.
UNBOUND = 31
#: Cosines come from single precision first; so far below the k-th, entries are looked at again.
SLACK = 1e-5
CHUNK = 1 << 20
#: Examples whose weights are made at once.
PART = 1000
#: Scores of so many different texts are kept by a task.
KEPT = 5_000

NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from: a quarter, by the checksum of their id."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def term_counts(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of the different words of every text, ordered by both."""
    data, at = flat(strings(pc.utf8_lower(texts)))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    starts, ends = word_bounds(padded, at, NO_LETTER)
    h = span_hashes(padded, starts, ends)
    cuts = np.searchsorted(starts, at)
    text = np.repeat(np.arange(len(texts)), np.diff(cuts))
    for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):  # many short sorts cost least
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return text[first], h[first], np.diff(np.append(first, len(h)))


def places(h: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes the sorted vocabulary holds, and their places there."""
    if not len(vocabulary):
        return np.zeros(len(h), bool), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    known = vocabulary[place] == h
    return known, place[known]


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start up to before its end, behind each other."""
    size = np.maximum(ends - starts, 0)
    out = np.repeat(starts - (np.cumsum(size) - size), size)
    out += np.arange(len(out))
    return out


def kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value, zero if there are fewer."""
    return float(np.partition(values, -k)[-k]) if len(values) >= k else 0.0


def likelihood_ratio(n: np.ndarray, bad: np.ndarray, texts: int, toxic: int) -> np.ndarray:
    """Of terms in ``n`` texts, ``bad`` of them toxic: the ratio where that is above chance."""
    if not 0 < toxic < texts:
        return np.zeros(len(n))

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-300)), 0)

    share = toxic / texts
    ratio = 2 * (
        part(bad, n * share)
        + part(n - bad, n * (1 - share))
        + part(toxic - bad, (texts - n) * share)
        + part(texts - n - toxic + bad, (texts - n) * (1 - share))
    )
    return np.where(bad > n * share, np.maximum(ratio, 0), 0)


@dataclass
class Index:
    """Block-max inverted index over the vectors of examples.

    ``worth`` is the weight of a term besides its count. Term t is in the entries between ``at[t]``
    and ``at[t + 1]``, with those weights; entry i is the example ``ids[i]``, toxic or not, and its
    weights are of length one together. What is derived is made once in a task, in little memory, and
    goes with it, as an idle worker keeps its broadcasts.
    """

    vocabulary: np.ndarray
    worth: np.ndarray
    at: np.ndarray
    entry: np.ndarray
    weight: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    prior: float

    @cached_property
    def blocks(self) -> int:
        return -(-len(self.ids) // BLOCK)

    @cached_property
    def head_of(self) -> np.ndarray:
        """Of each term its column in the dense part, -1 for others."""
        df = np.diff(self.at)
        often = np.argsort(-df, kind="stable")[:HEADS]
        often = np.sort(often[df[often] * HEAD_SHARE >= max(len(self.ids), HEAD_SHARE + 1)])
        column = np.full(len(self.vocabulary), -1, np.int32)
        column[often] = np.arange(len(often))
        return column

    @cached_property
    def dense(self) -> np.ndarray:
        """Frequent terms by entries, which are padded to whole blocks."""
        out = np.zeros((int(self.head_of.max(initial=-1)) + 1, self.blocks * BLOCK), np.float32)
        for t in np.flatnonzero(self.head_of >= 0).tolist():
            own = slice(self.at[t], self.at[t + 1])
            out[self.head_of[t], self.entry[own]] = self.weight[own]
        return out

    @cached_property
    def pairs(self) -> tuple[np.ndarray, ...]:
        """Of the pairs (term, block): first of each term, block, largest weight, first posting."""
        block = (self.entry // BLOCK).astype(np.int32)
        new = np.ones(len(block), bool)
        new[1:] = block[1:] != block[:-1]
        new[self.at[:-1]] = True
        first = np.flatnonzero(new).astype(np.int32)
        top = np.maximum.reduceat(self.weight, first) if len(first) else self.weight
        return np.searchsorted(first, self.at), block[first], top, np.append(first, len(block))

    def forget(self) -> None:
        """Drop what is derived; it is made again when it is needed."""
        for name in ("blocks", "head_of", "dense", "pairs"):
            vars(self).pop(name, None)

    def vectors(self, texts: pa.LargeStringArray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Known terms of each text and their weights, of length one together."""
        text, h, count = term_counts(texts)
        known, term = places(h, self.vocabulary)
        text = text[known]
        weight = (1 + np.log(count[known])) * self.worth[term]
        size = np.sqrt(np.bincount(text, weight * weight, len(texts)))
        weight = weight / size[text]
        cuts = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
        return [(term[a:b], weight[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def nearest(
        self, queries: list[tuple[np.ndarray, np.ndarray]], k: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of each vector the entries and cosines of its ``k`` nearest examples, falling, and of
        all others just as near. Entries that share no term are never near."""
        unbound = 0
        for start in range(0, len(queries), ROWS):
            part = queries[start : start + ROWS]
            often = np.zeros((len(part), len(self.dense)), np.float32)
            for i, (term, weight) in enumerate(part):
                column = self.head_of[term]
                often[i, column[column >= 0]] = weight[column >= 0]
            known = often @ self.dense
            for i, (term, weight) in enumerate(part):
                column = self.head_of[term]
                rare = column < 0
                head, heavy = column[~rare], weight[~rare]
                term, weight = term[rare], weight[rare]
                if unbound:
                    unbound -= 1
                    found = self._visit_all(term, weight, known[i], k)
                else:
                    found, spared = self._visit_bounded(term, weight, known[i], k)
                    unbound = 0 if 3 * spared > self.blocks else UNBOUND
                yield self._best(*found, head, heavy, k)

    def _visit_all(
        self, term: np.ndarray, weight: np.ndarray, known: np.ndarray, k: int
    ) -> tuple[np.ndarray, ...]:
        """Entries that may be near, their cosines, and the part of rare terms in them.

        The k-th best of the bests of groups is no better than the k-th of all.
        """
        a, b = self.at[term], self.at[term + 1]
        at = ranges(a, b)
        share = np.repeat(weight, b - a)
        share *= self.weight.take(at)
        rare = np.bincount(self.entry.take(at), share, len(known))
        cosine = known + rare
        least = kth(cosine.reshape(GROUPS * self.blocks, BLOCK // GROUPS).max(1), k)
        near = np.flatnonzero(cosine >= max(least - SLACK, 1e-12))
        return near, cosine[near], rare[near]

    def _visit_bounded(
        self, term: np.ndarray, weight: np.ndarray, known: np.ndarray, k: int
    ) -> tuple[tuple[np.ndarray, ...], int]:
        """The same from blocks whose bounds reach the k-th, and how many blocks that spares."""
        pair_at, pair_block, pair_top, first = self.pairs
        size = pair_at[term + 1] - pair_at[term]
        pair = ranges(pair_at[term], pair_at[term + 1])
        factor = np.repeat(weight, size)
        blocks = known.reshape(self.blocks, BLOCK)
        bound = blocks.max(1, initial=0) + np.bincount(
            pair_block[pair], factor * pair_top[pair], self.blocks
        )

        def visit(these: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
            some = these[pair_block[pair]]
            a, b = first[pair[some]], first[pair[some] + 1]
            at = ranges(a, b)
            slot = self.entry[at]
            slot = (np.cumsum(these) - 1)[slot // BLOCK] * BLOCK + slot % BLOCK
            cosine = blocks[these].ravel()
            rare = np.bincount(slot, np.repeat(factor[some], b - a) * self.weight[at], len(cosine))
            cosine = cosine + rare
            near = np.flatnonzero(cosine >= max(least - SLACK, 1e-12))
            where = np.flatnonzero(these)[near // BLOCK] * BLOCK + near % BLOCK
            return where, cosine[near], rare[near]

        if not self.blocks:
            return (np.zeros(0, np.int64), np.zeros(0), np.zeros(0)), 0
        best = np.zeros(self.blocks, bool)
        best[bound.argmax()] = True
        found = visit(best, 0.0)
        least = kth(found[1], k)
        rest = (bound > 0) & (bound >= least - SLACK) & ~best
        spared = self.blocks - 1 - int(rest.sum())
        if 2 * rest.sum() >= self.blocks:  # all of them at once cost less
            found = self._visit_all(term, weight, known, k)
        elif rest.any():
            both = zip(found, visit(rest, least), strict=True)
            found = tuple(np.concatenate(x) for x in both)
        return found, spared

    def _best(
        self,
        near: np.ndarray,
        cosine: np.ndarray,
        rare: np.ndarray,
        head: np.ndarray,
        heavy: np.ndarray,
        k: int,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of entries that may be near those that are, and their cosines in double precision."""
        least = kth(cosine, k)
        own = cosine >= least - SLACK
        near, rare = near[own], rare[own]
        exact = rare + (self.dense[head[:, None], near].astype(float) * heavy[:, None]).sum(0)
        order = np.lexsort((near, -exact))
        near, exact = near[order], exact[order]
        if len(near) > k:
            near, exact = near[exact >= exact[k - 1] - 1e-9], exact[exact >= exact[k - 1] - 1e-9]
        return near, np.minimum(exact, 1.0)

    def score(self, texts: pa.LargeStringArray, k: int) -> Iterator[tuple[float, list[dict]]]:
        """Of each text its share of toxic votes, and the nearest examples as evidence."""
        for entries, cosines in self.nearest(self.vectors(texts), k):
            votes = cosines**4
            yes = float(votes @ self.toxic[entries]) + PRIOR_VOTE * self.prior
            best = np.lexsort((self.ids[entries], -cosines))[:3]
            yield yes / (float(votes.sum()) + PRIOR_VOTE), [
                {"doc_id": int(self.ids[e]), "cosine": float(c), "toxic": float(self.toxic[e])}
                for e, c in zip(entries[best], cosines[best], strict=True)
            ]


def build_index(
    ids: np.ndarray,
    toxic: np.ndarray,
    at: np.ndarray,
    term: np.ndarray,
    count: np.ndarray,
    vocabulary: np.ndarray,
    documents: int,
    df: np.ndarray,
) -> Index:
    """The index of examples whose terms and counts lie between ``at[i]`` and ``at[i + 1]``.

    ``df`` tells how many of all ``documents`` hold each term of the vocabulary.
    """
    size = np.diff(at)
    owner = np.repeat(np.arange(len(ids), dtype=np.int32), size)
    n = np.bincount(term, minlength=len(vocabulary))
    bad = np.bincount(term[toxic[owner] == 1], minlength=len(vocabulary))
    idf = np.log((1 + documents) / (1 + df)) + 1
    worth = idf * (1 + likelihood_ratio(n, bad, len(ids), int(toxic.sum())))
    plain = size == 0
    prior = (toxic[plain].sum() + toxic.sum() / max(len(ids), 1)) / (plain.sum() + 1)
    weight = (1 + np.log(count, dtype=np.float32)) * worth.astype(np.float32)[term]
    for first in range(0, len(ids), PART):
        own = slice(at[first], at[min(first + PART, len(ids))])
        each = owner[own] - first
        weight[own] /= np.sqrt(np.bincount(each, np.square(weight[own]))).astype(np.float32)[each]
    # Entries with the same weightiest term lie together, so that whole blocks are unlike a text.
    lead = np.full(len(ids), len(vocabulary))
    if len(weight):
        most = np.zeros(len(ids), np.float32)
        most[~plain] = np.maximum.reduceat(weight, at[:-1][~plain])
        best = np.flatnonzero(weight == most[owner])[::-1]
        lead[owner[best]] = term[best]
    kept = np.lexsort((ids, lead))
    kept = kept[~plain[kept]]
    rank = np.full(len(ids), -1, np.int32)
    rank[kept] = np.arange(len(kept), dtype=np.int32)
    entry = rank[owner]
    del owner
    ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    placed, heavy = np.empty_like(entry), np.empty_like(weight)
    share = len(term) // 8 + 1  # sorted by parts, which takes an eighth of the memory
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, len(term), share)), len(n)))
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        some = np.flatnonzero((term >= lo) & (term < hi))
        some = some[np.lexsort((entry[some], term[some]))]
        own = slice(ends[lo], ends[hi])
        placed[own], heavy[own] = entry[some], weight[some]
    return Index(
        vocabulary, worth, ends, placed, heavy, ids[kept], toxic[kept].astype(float), float(prior)
    )


def examples_of(
    docs: DataFrame, labels: DataFrame, train: Column, most: int, most_bytes: int
) -> DataFrame:
    """(doc_id, toxic, text) of the labelled texts to learn from, written once."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
    )
    chosen = (
        usable.where(train)
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.desc("toxic"))
        .limit(most)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), "doc_id")
    shown = written(
        own.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")),
        "examples",
    )
    place = F.xxhash64("doc_id")
    sizes = shown.select(place.alias("place"), F.octet_length("text").alias("size")).toArrow()
    rank, size = (sizes.column(i).to_numpy() for i in range(2))  # at most ``most`` rows
    rank, size = np.sort(rank), size[np.argsort(rank)]
    fitting = int(np.searchsorted(np.cumsum(size, dtype=np.int64), most_bytes, "right"))
    if fitting == len(rank):
        return shown
    cut = shown.where(place < F.lit(int(rank[fitting])))
    cut._written_to = shown._written_to
    return cut


def document_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of all documents, and of those that hold each term of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        found, rows = np.zeros(len(known), np.int64), 0
        for batch in slices(batches, 0, CHUNK):
            rows += batch.num_rows
            _, h, _ = term_counts(strings(batch.column(0)))
            found += np.bincount(places(np.sort(h), known)[1], minlength=len(known))  # near lookups
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, -1)), pa.array(np.append(found[held], rows))],
            names=["place", "n"],
        )

    counts = docs.select("text").mapInArrow(run, "place long, n long")
    rows = counts.groupBy("place").agg(F.sum("n").alias("n")).toArrow()  # a row for each term
    place, n = (rows.column(i).to_numpy() for i in range(2))
    df = np.zeros(len(vocabulary), np.int64)
    df[place[place >= 0]] = n[place >= 0]
    return int(n[place < 0].sum()), df


def learn(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    examples: int = EXAMPLES,
    example_bytes: int = EXAMPLE_BYTES,
) -> Index:
    """Index of labelled documents for which ``train`` holds, with counts of all documents.

    They are at most ``examples`` rows of at most ``example_bytes`` bytes of text, those of the
    least hashes of their ids. Equal texts count once, as toxic if any is. Labels without an id,
    a value or a document are not used.
    """
    shown = examples_of(docs, labels, train, examples, example_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, CHUNK):
            text, h, count = term_counts(strings(batch.column(2)))
            at = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(at, pa.array(h.view(np.int64))),
                 pa.ListArray.from_arrays(at, pa.array(count.astype(np.int32)))],
                names=["doc_id", "toxic", "terms", "counts"],
            )

    rows = shown.select(F.col("doc_id").cast("long"), "toxic", "text").mapInArrow(
        run, "doc_id long, toxic int, terms array<long>, counts array<int>"
    ).toArrow()  # words of bounded texts
    release(shown)
    ids, toxic = (rows.column(i).to_numpy().copy() for i in range(2))
    size = pc.list_value_length(rows.column(2)).to_numpy()
    hashes = [part.flatten().to_numpy().view(np.uint64) for part in rows.column(2).chunks]
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *map(np.unique, hashes)]))
    term, count = np.empty(int(size.sum()), np.int32), np.empty(int(size.sum()), np.int32)
    cut = 0
    for part, n in zip(hashes, rows.column(3).chunks, strict=True):
        term[cut : cut + len(part)] = np.searchsorted(vocabulary, part)
        count[cut : cut + len(part)] = n.flatten().to_numpy()
        cut += len(part)
    rows = hashes = part = n = None
    give_back()
    at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    total, df = document_counts(docs, vocabulary) if len(ids) else (0, np.zeros(0, np.int64))
    return build_index(ids, toxic, at, term, count, vocabulary, total, df)


def scores(docs: DataFrame, labels: DataFrame, train: Column, **options: int) -> DataFrame:
    """Per row: (doc_id, score, evidence).

    ``labels`` has (doc_id, toxic); ``train`` picks those to learn from. Nothing but the text goes
    into a score. Texts without a word of any example, null and empty ones too, get the prior, as
    do all texts if there is nothing to learn from (it is zero then). Rows and ids may repeat, ids
    may be null. Very long texts are scored whole. An empty table gives no row.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _scored(own, docs, labels, train, **options).select(
        F.col("kept0").alias("doc_id"), "score", "evidence"
    )


def drop_toxic(
    docs: DataFrame, labels: DataFrame, train: Column, threshold: float = 0.3, **options: int
) -> DataFrame:
    """``docs`` with the same columns, without rows that score ``threshold`` or more.

    An empty table stays empty; see ``scores`` for other odd rows.
    """
    scored = _scored(docs, docs, labels, train, **options).where(F.col("score") < threshold)
    return scored.select(*(F.col(f"kept{i}").alias(c) for i, c in enumerate(docs.columns)))


def _scored(
    rows: DataFrame,
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    neighbours: int = NEIGHBOURS,
    **bounds: int,
) -> DataFrame:
    """The columns of ``rows`` as kept0, kept1 and so on, with score and evidence of ``text``."""
    index = sent(docs.sparkSession, learn(docs, labels, train, **bounds))
    give_back()
    kind = pa.list_(
        pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.float64())])
    )

    kept = [f"kept{i}" for i in range(len(rows.columns))]
    place = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[float, list[dict]]] = {}
        try:
            for batch in slices(batches, place, CHUNK):
                texts = strings(batch.column(place))
                keys = [hashlib.blake2b(t.as_buffer() or b"", digest_size=16).digest() for t in texts]
                if len(seen) > KEPT:
                    seen.clear()
                fresh = {key: i for i, key in enumerate(keys) if key not in seen}
                some = texts.take(pa.array(list(fresh.values()), pa.int64()))
                seen.update(zip(fresh, index.value.score(some, neighbours), strict=True))
                made = [seen[key] for key in keys]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array([s for s, _ in made], pa.float64()),
                     pa.array([e for _, e in made], kind)],
                    names=[*kept, "score", "evidence"],
                )
        finally:
            index.value.forget()
            give_back()

    schema = T.StructType(
        [T.StructField(k, f.dataType) for k, f in zip(kept, rows.schema.fields, strict=True)]
    )
    schema.add("score", T.DoubleType())
    shown = T.StructType().add("doc_id", T.LongType()).add("cosine", T.DoubleType())
    schema.add("evidence", T.ArrayType(shown.add("toxic", T.DoubleType())))
    return rows.mapInArrow(run, schema)

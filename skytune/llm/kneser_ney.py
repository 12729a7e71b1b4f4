"""Interpolated modified Kneser-Ney model of word pairs, counted in Spark, and text scores by it.

Words are 64-bit hashes. Each map task turns a slice of the texts into its distinct pairs (previous
word, word) with training counts, and deals them by the second word; words frequent enough to fill
a task are dealt by the whole pair. A count task merges what it gets into sorted arrays, writes
them, and reports to the task in charge of each word what its part of the corpus says of that
word. Totals go back to those who asked. To score, the pairs are dealt again, now with the
documents that hold them; score tasks map the arrays of their part into memory, look the pairs up
and add log probabilities by document. Documents are scored in ``ROUNDS`` rounds, so that the
dealt pairs of one round at a time take up disk. The model is as large as the corpus needs, and no
task or driver ever holds all of it.

With c(u w) the training count of a pair, C(u) that of all pairs after u, N1, N2, N3 the number of
different words seen once, twice, more often after u, and K(w) the number of different words
before w:

    p(w)     = max(K(w) - D'(K(w)), 0) / sum K  +  lambda / (V + 1)
    p(w | u) = max(c(u w) - D(c), 0) / C(u)  +  (D1 N1 + D2 N2 + D3 N3) / C(u) * p(w)

D and D' are the usual estimates from counts of counts; lambda is what D' takes away, and V + 1
counts the training words and one unknown word, so probabilities sum to one.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytune.llm.ragged import M1, M2, M3, Words, mix, slices, strings
from skytune.session import delete, release, written

CHUNK = 6 << 20
START, END = mix(np.array([M2, M3], np.uint64))
#: Kinds of rows: what is known of a batch of documents, its pairs, a part's arrays, a report on
#: words.
BATCH, PAIRS, ARRAYS, REPORT = range(4)
#: Rounds of scoring.
ROUNDS = 4
STATS = 6  # C, N1, N2, N3 of a word as context; count and K of it as second word

DEALT = "p int, batch long, kind int, body binary"
COUNTED = "kind int, p int, q int, body binary, n array<long>"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, whole numbers in the narrowest type that holds them."""
    out = []
    for a in arrays:
        if a.dtype.kind in "iu" and a.dtype != np.uint64:
            top = int(a.max(initial=0))
            a = a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16
                         else np.uint32 if top < 1 << 32 else np.int64)
        out.append(a)
    return pickle.dumps(out, protocol=5)


def unpack(body: pa.Scalar) -> list[np.ndarray]:
    return pickle.loads(body.as_buffer())


def pairs_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous word, word, text) of every token; each text ends with an end token."""
    n = len(words.counts)
    tokens = len(words.hashes) + n
    place = np.arange(len(words.hashes)) + words.texts
    target = np.empty(tokens, np.uint64)
    target[words.first[1:] + np.arange(n)] = END
    target[place] = words.hashes
    context = np.empty(tokens, np.uint64)
    context[words.first[:-1] + np.arange(n)] = START
    context[place + 1] = words.hashes
    return context, target, np.repeat(np.arange(n), words.counts + 1)


def heavy_words(docs: DataFrame, parts: int) -> np.ndarray:
    """Words that make up a quarter of a task's share or more: at most 4 for each task."""
    if parts < 2:
        return np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, CHUNK):
            words = Words(strings(batch.column(0)))
            h, n = np.unique(words.hashes, return_counts=True)
            often = n * 8 * parts >= len(words.hashes)  # a word can be rarer than its mean here
            word = pa.array([None, *h[often].view(np.int64).tolist()], pa.int64())
            n = pa.array([len(words.hashes), *n[often].tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([word, n], names=["word", "n"])

    counts = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word")
    counts = written(counts.agg(F.sum("n").alias("n")), "often")
    total = counts.where(F.col("word").isNull()).agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("word").isNotNull() & (F.col("n") * 4 * parts >= total)).collect()
    release(counts)
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(np.uint64))


def deal(docs: DataFrame, parts: int, heavy: np.ndarray, scoring: bool) -> DataFrame:
    """Rows of (doc_id, text, train) as packed pairs by part.

    To count, pairs come with their training counts; for scoring with the texts that hold them,
    and with one more row about each batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        batch_id = TaskContext.get().partitionId() << 32
        for batch in slices(batches, 1, CHUNK):
            batch_id += 1
            train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            u, w, text = pairs_of(Words(strings(batch.column(1))))
            rows = []
            if scoring:
                ids = batch.column(0)
                rows.append((batch_id % parts, BATCH, pack(
                    np.asarray(ids.is_valid()), ids.fill_null(0).to_numpy(), train,
                    np.bincount(text, minlength=batch.num_rows),
                )))
            g = mix(mix(u + M1) + w)
            order = np.argsort(g, kind="stable")
            g, text = g[order], text[order]
            new = np.ones(len(g), bool)
            new[1:] = g[1:] != g[:-1]
            held = new.copy()
            held[1:] |= text[1:] != text[:-1]
            first, entry = np.flatnonzero(new), np.flatnonzero(held)
            counts = np.add.reduceat(train[text].astype(np.int64), first)
            times = np.diff(np.append(entry, len(g)))
            per_pair = np.add.reduceat(held.astype(np.int64), first)
            at = np.cumsum(per_pair) - per_pair
            e_text = text[entry]
            u, w = u[order[first]], w[order[first]]
            part = (w % np.uint64(parts)).astype(np.int64)
            if len(heavy):
                near = np.minimum(np.searchsorted(heavy, w), len(heavy) - 1)
                hot = heavy[near] == w
                part[hot] = (g[first][hot] % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((w, part))
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            for p in range(parts):
                own = order[cuts[p] : cuts[p + 1]]
                if not len(own):
                    continue
                both = np.concatenate([u[own], w[own]])
                words, place = np.unique(both, return_inverse=True)
                pairs = words, place[: len(own)], place[len(own) :]
                if scoring:
                    size = per_pair[own]
                    entries = np.repeat(at[own] - (np.cumsum(size) - size), size)
                    entries += np.arange(len(entries))
                    body = pack(*pairs, size, e_text[entries], times[entries])
                else:
                    body = pack(*pairs, counts[own])
                rows.append((p, PAIRS, body))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([batch_id] * len(rows), pa.int64()),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], pa.binary()),
                ],
                names=["p", "batch", "kind", "body"],
            )

    return docs.mapInArrow(run, DEALT)


def count_counts(values: np.ndarray) -> list[int]:
    """How many values are 1, 2, 3, 4, and above zero."""
    return [int((values == i).sum()) for i in range(1, 5)] + [int((values > 0).sum())]


def count_task(parts: int):
    """Merge the pairs of a part into sorted arrays, and report on its words."""

    def run(table: pa.Table) -> pa.Table:
        p = table.column("p")[0].as_py()
        got = [unpack(b) for b in table.column("body")]
        words = np.unique(np.concatenate([x[0] for x in got]))
        n = len(words)
        keys = []
        for x in got:
            place = np.searchsorted(words, x[0])
            keys.append(place[x[2]] * n + place[x[1]])
        counts = np.concatenate([x[3] for x in got])
        del got
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        c = np.bincount(place, counts, len(key)).astype(np.int64)
        del place, counts
        w, u = np.divmod(key, n)
        stats = np.stack([
            np.bincount(u, c, n), np.bincount(u, c == 1, n), np.bincount(u, c == 2, n),
            np.bincount(u, c > 2, n), np.bincount(w, c, n), np.bincount(w, c > 0, n),
        ]).astype(np.int64)
        seen = c > 0
        out = [(ARRAYS, p, 0, pack(words, np.diff(key[seen], prepend=0), c[seen]), count_counts(c))]
        out += [
            (REPORT, p, q, pack(words[own], *stats[:, own]), None) for q, own in by_owner(words, parts)
        ]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
            names=["kind", "p", "q", "body", "n"],
        )

    return run


def by_owner(words: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """The part in charge of each word, with the places of its words, in order."""
    owner = (mix(words) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(parts + 1))
    for q in range(parts):
        if cuts[q] < cuts[q + 1]:
            yield q, order[cuts[q] : cuts[q + 1]]


def total_task(table: pa.Table) -> pa.Table:
    """Add the reports on each word and send the totals back; count counts of K."""
    got = [unpack(b) for b in table.column("body")]
    words, place = np.unique(np.concatenate([x[0] for x in got]), return_inverse=True)
    totals = [
        np.bincount(place, np.concatenate([x[1 + s] for x in got]), len(words)).astype(np.int64)
        for s in range(STATS)
    ]
    bodies, start = [], 0
    for x in got:
        own = place[start : start + len(x[0])]
        start += len(x[0])
        bodies.append(pack(*(t[own] for t in totals)))
    extra = [
        *count_counts(totals[5]), int((totals[4] > 0).sum()), int(totals[4].sum()),
        int(totals[5].sum()),
    ]
    n = [extra] + [None] * (len(bodies) - 1)
    return pa.Table.from_arrays(
        [table.column("p"), table.column("q"), pa.array(bodies, pa.binary()),
         pa.array(n, pa.list_(pa.int64()))],
        names=["p", "q", "body", "n"],
    )


def discounts(n: list[int]) -> np.ndarray:
    """D1, D2, D3 from the counts of counts 1 to 4; half, three quarters and one if one is zero."""
    n1, n2, n3, n4 = n[:4]
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 0.75, 1.0])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, [0, 0.01, 0.01, 0.01], [0, 0.99, 1.99, 2.99])


def mapped(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays, mapped from a file that goes with the mapping."""
    out = []
    with tempfile.TemporaryFile() as file:
        for a in arrays:
            place = file.seek(0, 2)
            file.write(bytes(-place % 8))
            place += -place % 8
            a.tofile(file)
            file.flush()
            out.append(np.memmap(file, a.dtype, "r", place, a.shape) if a.size else a)
    return out


def score_task(pair_n: list[int], word_n: list[int], parts: int):
    """Add log probabilities of a part's pairs by document."""
    d, dk = discounts(pair_n), discounts(word_n)
    m1, m2, m3, m4, seen, distinct, total, sum_k = word_n
    taken = dk[1] * m1 + dk[2] * m2 + dk[3] * (seen - m1 - m2)
    rest = taken / sum_k if sum_k else 1.0

    def run(asked: pa.Table, state: pa.Table) -> pa.Table:
        """Rows dealt for scoring; arrays of the part, and the totals of its words by part q."""
        batches, kinds = asked.column("batch").to_pylist(), asked.column("kind").to_pylist()
        bodies = asked.column("body")
        rows = [
            (batch, BATCH, bodies[i].as_py())
            for i, (batch, kind) in enumerate(zip(batches, kinds, strict=True)) if kind == BATCH
        ]
        told, arrays = {}, None
        for kind, q, body in zip(
            state.column("kind").to_pylist(), state.column("q").to_pylist(), state.column("body"),
            strict=True,
        ):
            if kind == ARRAYS:
                arrays = unpack(body)
            else:
                told[q] = unpack(body)
        if arrays is not None:
            words, key, c = mapped(arrays[0], np.cumsum(arrays[1], dtype=np.int64), arrays[2])
            stats = np.zeros((STATS, len(words)))
            for q, own in by_owner(np.asarray(words), parts):
                stats[:, own] = told[q]
            del told, arrays
            after, n1, n2, n3, count, k = stats
            low = np.maximum(k - dk[np.minimum(k, 3).astype(int)], 0) / max(sum_k, 1)
            low += rest / (distinct + 1)
            base = np.log10((count + 0.1) / (total + 0.1 * (distinct + 1)))
            spare = d[1] * n1 + d[2] * n2 + d[3] * n3
            for i, kind in enumerate(kinds):
                if kind != PAIRS:
                    continue
                own, u, w, size, text, times = unpack(bodies[i])
                place = np.searchsorted(words, own)
                u, w = place[u], place[w]
                pair = w * len(words) + u
                near = np.minimum(np.searchsorted(key, pair), max(len(key) - 1, 0))
                held = np.zeros(len(pair), np.int64)
                if len(key):
                    held = np.where(key[near] == pair, c[near], 0)
                high = np.maximum(held - d[np.minimum(held, 3)], 0)
                after_u = after[u]
                p = np.where(
                    after_u > 0, (high + spare[u] * low[w]) / np.maximum(after_u, 1), low[w]
                )
                of = np.repeat(np.arange(len(pair)), size)
                texts = int(text.max()) + 1
                score = np.bincount(text, np.log10(p)[of] * times, texts)
                plain = np.bincount(text, base[w][of] * times, texts)
                met = np.bincount(text, (count[w] > 0)[of] * times, texts).astype(np.int64)
                text = np.unique(text)
                rows.append((batches[i], PAIRS, pack(text, score[text], plain[text], met[text])))
        kinds = [pa.int64(), pa.int32(), pa.binary()]
        return pa.Table.from_arrays(
            [pa.array([r[j] for r in rows], kinds[j]) for j in range(3)],
            names=["batch", "kind", "body"],
        )

    return run


RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def finish_task(total: int):
    """Add the parts' sums of each document of a batch."""

    def run(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_pylist()
        body = table.column("body")
        valid, ids, train, tokens = unpack(body[kinds.index(BATCH)])
        score, base, known = (np.zeros(len(ids)) for _ in range(3))
        for i, kind in enumerate(kinds):
            if kind != BATCH:
                own, s, b, k = unpack(body[i])
                score[own] += s
                base[own] += b
                known[own] += k
        return pa.Table.from_arrays(
            [
                pa.array(ids.astype(np.int64), mask=~valid), pa.array(~train),
                pa.array(tokens.astype(np.int64)), pa.array(known.astype(np.int64)),
                pa.array(np.full(len(ids), total)), pa.array(base), pa.array(score),
            ],
            names=[x.split()[0] for x in RESULT.split(", ")],
        )

    return run


def parts_for(docs: DataFrame, mb: int = 10) -> int:
    """Parts of about ``mb`` MB of stored input; the session's number if its size is not known."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= 1 << 60:  # what Spark assumes of frames that are not read from files
        return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // (mb << 20)))


def language_scores(docs: DataFrame, train: Column, parts: int | None = None) -> DataFrame:
    """Per row: token counts, base score and model score, learning from rows where ``train`` holds.

    A-Z count as a-z. Null and empty texts are one end token. Rows for which ``train`` is null are
    not learned from. Ids may repeat or be null: every row is a text of its own. With nothing to
    learn from, all words share one probability. An empty table gives no row.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    parts = parts or parts_for(docs)
    heavy = heavy_words(own, parts)
    dealt = deal(own, parts, heavy, scoring=False).repartitionById(parts, "p")
    counted = written(
        dealt.groupBy("p").applyInArrow(count_task(parts), COUNTED), "counts", ["kind"]
    )
    reports = counted.where(F.col("kind") == REPORT).select("p", "q", "body")
    totals = written(
        reports.groupBy("q").applyInArrow(total_task, "p int, q int, body binary, n array<long>"),
        "totals",
    )
    delete(docs.sparkSession, f"{counted._written_to}/kind={REPORT}")
    arrays = counted.where(F.col("kind") == ARRAYS)
    pair_n, word_n = _sums(arrays, 5), _sums(totals, 8)
    state = arrays.select("p", "kind", "q", "body").unionByName(
        totals.select("p", F.lit(REPORT).alias("kind"), "q", "body")
    )
    task = score_task(pair_n, word_n, parts)
    slot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    result: DataFrame | None = None
    for turn in range(ROUNDS):
        asked = deal(own.where(slot == turn), parts, heavy, scoring=True)
        scored = asked.groupBy("p").cogroup(state.groupBy("p")).applyInArrow(
            task, "batch long, kind int, body binary"
        )
        sums = written(scored, "sums")
        done = written(
            sums.groupBy("batch").applyInArrow(finish_task(word_n[6]), RESULT), "scores"
        )
        release(sums)
        result = done if result is None else result.unionByName(done)
    release(counted, totals)
    return result


def _sums(rows: DataFrame, n: int) -> list[int]:
    """The sums of the arrays in column n."""
    found = rows.agg(*(F.sum(F.col("n")[i]).alias(f"n{i}") for i in range(n))).first()
    return [int(x or 0) for x in found]


def in_training(doc_id: Column) -> Column:
    """Documents to learn from: nine tenths, by the checksum of their id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 10 != 0

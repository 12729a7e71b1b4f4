"""Packing, tokenizer alignment and whitening against plain versions and the public libraries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from brute import ODD, documents
from conftest import TABLES
from sentencepiece import SentencePieceProcessor
from test_coding import TRICKY, samples
from tokenizers import Tokenizer

from skytune.llm import alignment, packing, queries, whitening
from skytune.llm.queries import BYTE_VOCABULARY, PIECE_MODEL, WORD_VOCABULARY
from skytune.session import ship_package, written

UNASSIGNED = ["͸͹ x", "a\U000e0fffb", "⿠ ﷐"]


def table_texts(spark) -> list[tuple[int, str | None]]:
    rows = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


# --- packing ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_of_the_library(word_library):
    encoder = packing.LibraryIds(Path(WORD_VOCABULARY).read_text("utf-8"))
    texts = samples(1500) + UNASSIGNED
    want = [e.ids for e in word_library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def test_words_met_again_are_not_forgotten(word_library, monkeypatch):
    monkeypatch.setattr(packing, "KEPT", 10)
    encoder = packing.LibraryIds(Path(WORD_VOCABULARY).read_text("utf-8"))
    asked = Counter()
    plain = encoder.merges

    def noted(word):
        asked[word] += 1
        return plain(word)

    encoder.merges = noted
    for i in range(9):
        text = "river Stone bridge, " + " ".join(f"{a}q{'x' * i}" for a in "abcdefgh")
        want = word_library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == want
        assert len(encoder.known) + len(encoder.older) < 60
    assert asked["river"] == asked["stone"] == asked["bridge"] == 1


def test_stretches_are_learned_at_once_and_in_lower_case(word_library):
    encoder = packing.LibraryIds(Path(WORD_VOCABULARY).read_text("utf-8"))
    texts = [
        "Ärger ärger ÄRGER, it's\x85IT'S\x1fx9 x9,ª µ\x00\x7f 's' <|ENDOFTEXT|>",
        "Ärger Ωmega ωΣ, e\u0301Ä ÄRGER,",
        "", " \n", "ÿ <|endoftext|> ÿ",
    ]
    want = [e.ids for e in word_library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts[:1])] == want[:1]
    assert "ärger" in encoder.known and not {"Ärger", "ÄRGER", "ÄRGER,"} & encoder.known.keys()
    # a second batch of known and new stretches, some of which the library settles
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def check_pieces(rows, documents, library, capacity: int) -> None:
    """Every id lies in one piece; sequences are gapless and need no padding."""
    ids_of = defaultdict(list)
    for i, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        ids_of[i].append([*ids, 1])
    # pieces of repeated ids cannot be told apart, so ids are compared as a whole
    want, got = Counter(), Counter()
    for i, found in ids_of.items():
        for ids in found:
            want.update((i, len(ids), at, x) for at, x in enumerate(ids))
    sequences = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] > 0
        got.update((r["doc_id"], r["doc_tokens"], r["start"] + at, x) for at, x in enumerate(ids))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for pieces in sequences.values():
        pieces.sort()
        ends = np.cumsum([n for _, n in pieces])
        assert [at for at, _ in pieces] == [0, *ends[:-1].tolist()]
        size = int(ends[-1])
        assert size <= capacity and size & (size - 1) == 0


@pytest.mark.parametrize("group", [1, 5000, 1 << 20])
def test_odd_documents_are_packed_whole(spark, word_library, group):
    docs = documents(ship_package(spark)).repartition(3)
    rows = packing.pack(docs, WORD_VOCABULARY, 1, group_tokens=group).collect()
    check_pieces(rows, ODD, word_library, 2048)


def test_packing_query(spark, word_library):
    texts = table_texts(spark)
    docs = ship_package(spark).createDataFrame(texts, "doc_id long, text string")
    rows = packing.pack(docs, WORD_VOCABULARY, 1).collect()
    check_pieces(rows, texts, word_library, 2048)
    ids = dict(
        (i, [*word_library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in texts
    )
    for r in queries.QUERIES["op11_packing"](spark, TABLES).collect():
        cut = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(cut, "<u4").tobytes())


def test_greedy_choice_and_balance():
    # 9 + 7 + 6 + 2 = 24 tokens: 8 of them fill a full sequence, the rest two of 8
    pieces = list(packing.balanced([9, 7, 6, 2, 0], 8, 1.0, 0.5))
    assert pieces[0] == (0, 0, 8, 0, 0)
    assert (1, 0, 7, 1, 0) in pieces and (2, 0, 6, 2, 0) in pieces
    assert (3, 0, 2, 2, 6) in pieces and (0, 8, 1, 1, 7) in pieces
    assert packing.room_for(8 * 3 + 5, 8) == [8, 8, 8, 4, 1]
    rnd = random.Random(3)
    lengths = [rnd.randint(1, 60) for _ in range(400)]
    cost = Counter()
    for _, _, n, sequence, _ in packing.balanced(lengths, 256, 1.0, 1 / 64):
        cost[sequence] += n + n * n / 64
    full = [cost[s] for s in range(sum(lengths) // 256)]
    assert max(full) < 1.25 * min(full)


def test_no_documents_and_wrong_capacity(spark):
    docs = documents(ship_package(spark), [])
    assert packing.pack(docs, WORD_VOCABULARY, 1).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(docs, WORD_VOCABULARY, 1, capacity=1000)


# --- alignment -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def libraries():
    byte = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    byte.encode_special_tokens = True
    return byte, SentencePieceProcessor(model_file=PIECE_MODEL)


def plain_alignments(texts: list[str | None], libraries) -> list[dict]:
    """Each text by itself: spans, every pair compared, groups closed one token at a time."""
    byte, piece = libraries
    side = alignment.ByteSide(Path(BYTE_VOCABULARY).read_text("utf-8"))
    out = []
    for text in texts:
        a = byte.encode(" " + (text or ""), add_special_tokens=False).ids
        b = piece.encode(text or "")
        raw = [side.bytes[i] for i in a]
        spelled = []
        for i in b:
            name = piece.id_to_piece(i)
            is_byte = len(name) == 6 and name.startswith("<0x")
            spelled.append(bytes.fromhex(name[3:5]) if is_byte else name.replace("▁", " ").encode())
        want = (" " + (text or "")).encode()
        if not text or b"".join(raw) != want or b"".join(spelled) != want:
            a, b, raw, spelled = [], [], [], []
        ea, eb = np.cumsum([len(x) for x in raw]), np.cumsum([len(x) for x in spelled])
        sa, sb = ea - [len(x) for x in raw], eb - [len(x) for x in spelled]
        links = [
            (a[i], b[j])
            for i in range(len(a))
            for j in range(np.searchsorted(eb, sa[i], "right"), np.searchsorted(sb, ea[i], "left"))
        ]
        groups, i, j = [], 0, 0
        for end in sorted(set(ea.tolist()) & set(eb.tolist())):
            first, second = [], []
            while i < len(a) and ea[i] <= end:
                first.append(a[i])
                i += 1
            while j < len(b) and eb[j] <= end:
                second.append(b[j])
                j += 1
            groups.append(f"{','.join(map(str, first))}|{','.join(map(str, second))}")
        out.append(dict(n_a=len(a), n_b=len(b), n_groups=len(groups), links=links, groups=";".join(groups)))
    counts = Counter(pair for x in out for pair in set(x["links"]))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    for x in out:
        x["n_best"] = sum(counts[p] == most[p[0]] for p in x["links"])
        x["count_sum"] = sum(counts[p] for p in x["links"])
    return out


def key(doc_id, *rest):
    return (doc_id is None, doc_id or 0, *rest)


@pytest.mark.parametrize("portion", [alignment.PORTION, 700])
def test_alignment_of_odd_documents(spark, libraries, portion):
    rnd = random.Random(5)
    made = ["".join(rnd.choice(TRICKY) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    texts = [*ODD, *enumerate([*made, *UNASSIGNED, " x", "x ", "  ", " \n y", "a  b"], 100)]
    docs = documents(ship_package(spark), texts).repartition(3)
    found = written(alignment.alignments(docs, BYTE_VOCABULARY, PIECE_MODEL), "test-aligned")
    size = alignment.vocabulary_size(PIECE_MODEL)
    counts = written(alignment.link_counts(found, size), "test-counts")
    rows = alignment.with_link_counts(found, counts, portion).collect()
    names = ("n_a", "n_b", "n_groups", "groups", "n_best", "count_sum")
    want = plain_alignments([t for _, t in texts], libraries)
    expected = sorted(
        key(i, *(x[n] for n in names), len(x["links"])) for (i, _), x in zip(texts, want, strict=True)
    )
    assert sorted(key(r.doc_id, *(r[n] for n in names), r.n_links) for r in rows) == expected
    for r in found.where("doc_id = 14").collect():
        pairs = [divmod(link, size) for link in r.links]
        assert pairs == [x["links"] for (i, _), x in zip(texts, want, strict=True) if i == 14][0]
    assert counts.where("link <> a_id * 32000 + b_id").isEmpty()


def test_alignment_query(spark, libraries):
    texts = table_texts(spark)
    want = plain_alignments([t for _, t in texts], libraries)
    rows = {r.doc_id: r for r in queries.QUERIES["op12_tokenizer_alignment"](spark, TABLES).collect()}
    assert len(rows) == len(texts)
    for (i, _), x in zip(texts, want, strict=True):
        digest = hashlib.sha256(x["groups"].encode()).hexdigest() if x["groups"] else ""
        assert rows[i].groups_sha256 == digest
        assert rows[i].n_links == len(x["links"])
        assert (rows[i].n_best, rows[i].count_sum) == (x["n_best"], x["count_sum"])


def test_alignment_of_nothing(spark):
    for rows in ([], [(1, None), (2, "")]):
        docs = documents(ship_package(spark), rows)
        found = written(alignment.alignments(docs, BYTE_VOCABULARY, PIECE_MODEL), "test-nothing")
        counts = written(alignment.link_counts(found, 32000), "test-nothing")
        got = alignment.with_link_counts(found, counts).orderBy("doc_id").collect()
        assert [(r.doc_id, r.n_a, r.n_links, r.groups, r.n_best, r.count_sum) for r in got] == [
            (i, 0, 0, "", 0, 0) for i, _ in rows]


# --- whitening -------------------------------------------------------------------------


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, n string, component string, `index` int, x int"
    return spark.createDataFrame([(i, v, "n", "c", 1, 2) for i, v in rows], schema)


def plain_whitening(rows, most: int = 16):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = [tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v) for _, v in kept]
    once = np.array(sorted(set(x)), dtype=object)
    n, sums = len(once), [sum(c) for c in once.T]
    away = np.array([[n * c - s for c, s in zip(v, sums, strict=True)] for v in x], dtype=object)
    mean = np.array([[float(n * c - s) / n for c, s in zip(v, sums, strict=True)] for v in once])
    covariance = mean.T @ mean / n
    e, vec = np.linalg.eigh(covariance)
    e, vec = e[::-1], vec[:, ::-1]
    places = (away.astype(float) / n) @ vec[:, :most] / np.sqrt(e[:most])
    deviation = [sum(c * c for c in v) for v in away]
    return [i for i, _ in kept], n, deviation, places, e[:most] / np.trace(covariance)


@pytest.mark.parametrize("slab_blocks", [whitening.SLAB_BLOCKS, 1])
def test_whitening(spark, slab_blocks, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    monkeypatch.setattr(whitening, "TOGETHER", 2)
    rng = np.random.default_rng(4)
    scale = np.linspace(3, 0.3, 20)
    made = [(i, (rng.normal(size=20) * scale).tolist()) for i in range(500)]
    odd = [(7, None), (8, [None, *made[0][1][1:]]), (9, [float("nan"), *made[0][1][1:]]),
           (10, [float("inf"), *made[0][1][1:]]), (None, made[3][1]), (3, made[3][1])]
    rows = [*made, *odd, *[(1000 + i, made[5][1]) for i in range(300)]]
    got = whitening.whitened(vectors(spark, rows).repartition(7), slab_blocks=slab_blocks).collect()
    ids, n, deviation, places, shares = plain_whitening(rows)
    assert n == 500 and len(got) == len(ids) * 16
    assert {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    sign = {}
    want = defaultdict(list)
    for i, d, p in zip(ids, deviation, places, strict=True):
        want[i, d].append(p)
    for r in got:
        plain = want[r.vec_id, r.deviation][0][r.component - 1]
        sign.setdefault(r.component, 1 if plain * r.whitened > 0 else -1)
        assert abs(sign[r.component] * r.whitened - plain) < 1e-8
        assert abs(r.explained - shares[r.component - 1]) < 1e-12


def test_whitening_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TABLES}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    got = queries.QUERIES["op13_whitening"](spark, TABLES).collect()
    ids, n, deviation, places, shares = plain_whitening(rows)
    assert len(got) == 16 * len(ids) and {r.n for r in got} == {n}
    found = np.zeros((len(ids), 16))
    place = {i: k for k, i in enumerate(ids)}
    for r in got:
        found[place[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[place[r.vec_id]]
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-9
    sign = np.sign((found * places).sum(0))
    assert np.abs(found * sign - places).max() < 1e-6


def test_whitening_of_little(spark):
    assert whitening.whitened(vectors(spark, [])).collect() == []
    assert whitening.whitened(vectors(spark, [(1, None), (2, [None])])).collect() == []
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whitened(vectors(spark, [(1, []), (2, [])])).collect() == []
    # one direction only: the second component has no variance
    line = [(i, [float(i), 2.0 * i]) for i in range(9)]
    got = whitening.whitened(vectors(spark, line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 9
    assert got[0].explained == pytest.approx(1)
    with pytest.raises(ValueError, match="entries"):
        whitening.whitened(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))

"""License scan, toxicity, decontamination, language model and the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import ODD, documents, shingle_set, words
from pyspark.sql import functions as F

import corpus_pipeline
from skytune.llm import bpe, decontaminate, kneser_ney, licenses, queries, toxicity
from skytune.session import ship_package

TABLES = "/root/testdata/sf0.001"


def array(*texts: str) -> pa.Array:
    return pa.array(texts, pa.large_string())


# --- licenses ------------------------------------------------------------------------


def held_notices(text: str | None, share: float = 0.8) -> set[int]:
    found = set()
    for t, (_, notice) in enumerate(licenses.NOTICES):
        k = min(5, len(words(notice)))
        want = shingle_set(notice, k)
        if words(text) and len(want & shingle_set(text, k)) >= share * len(want) - 1e-9:
            found.add(t)
    return found


def license_texts() -> list[str]:
    rnd = random.Random(8)
    filler = lambda n: " ".join(f"f{rnd.randint(0, 99999)}" for _ in range(n))
    out = ["", "All rights reserved.", filler(300)]
    for _, notice in licenses.NOTICES:
        own = notice.split(" ")
        for cut in range(4):
            changed = list(own)
            for _ in range(cut):
                changed[rnd.randrange(len(changed))] = "changed"
            out.append(f"{filler(rnd.randint(0, 90))} {' '.join(changed).upper()}\n{filler(rnd.randint(0, 90))}")
    return out


def test_notices_equal_exact_containment():
    texts = license_texts()
    found = defaultdict(set)
    groups = licenses.groups_of(licenses.NOTICES)
    for text, t, start, end, share in licenses.scan(array(*texts), groups, 0.8):
        found[text].add(t)
        part = texts[text].encode()[start:end].decode()
        assert t in held_notices(part) and share >= 0.8
    for i, text in enumerate(texts):
        assert found[i] == held_notices(text), text


def test_two_copies_are_two_notices():
    notice = licenses.NOTICES[0][1]
    text = f"{notice} {'filler ' * 30} {notice}"
    groups = licenses.groups_of(licenses.NOTICES)
    assert [x[1] for x in licenses.scan(array(text), groups, 0.8)].count(0) == 2


def test_notices_of_odd_rows(spark, monkeypatch):
    rows = [*ODD, (None, "All rights reserved."), (30, "x All RIGHTS reserved. y")]
    docs = documents(ship_package(spark), rows)
    got = licenses.license_notices(docs).collect()
    assert len(got) == len(rows)
    assert [r.notices[0].license for r in got if r.notices] == ["All-rights-reserved"] * 2
    assert licenses.license_notices(docs, []).where("size(notices) > 0").count() == 0
    monkeypatch.setattr(licenses, "PER_PASS", 2)
    again = licenses.license_notices(docs).where("size(notices) > 0").collect()
    assert {r.doc_id for r in again} == {None, 30}


def commented(text: str, mark: str, width: int = 9) -> str:
    own = text.split()
    return "\n".join(f"{mark} {' '.join(own[i : i + width])}" for i in range(0, len(own), width))


def test_common_licenses_are_told_apart(spark):
    every = licenses.templates()
    names = {n for n, _ in every}
    assert {"GPL-2.0", "LGPL-2.1", "AGPL-3.0-or-later", "MPL-2.0", "ISC", "BSD-2-Clause", "Apache-2.0"} <= names
    texts = [f"First some words.\n{commented(text, mark)}\n{mark} Last." for _, text in every for mark in ("#", " *", "")]
    texts += [text.upper().replace('"', "\u201c") for _, text in every]
    want = [name for name, _ in every for _ in range(3)] + [name for name, _ in every]
    rows = list(enumerate(texts)) + [(len(texts), "(c) X. All rights reserved"), (len(texts) + 1, "words only")]
    got = licenses.license_notices(documents(ship_package(spark), rows)).collect()
    held = {r.doc_id: {n.license for n in r.notices} for r in got}
    assert held.pop(len(texts)) == {"All-rights-reserved"} and not held.pop(len(texts) + 1)
    for i, name in enumerate(want):
        assert held[i] == {name}, (name, held[i])


def test_neighbours_and_half_copies(spark):
    gpl, agpl, mit = (next(t for n, t in licenses.templates() if n == x) for x in ("GPL-3.0-or-later", "AGPL-3.0-or-later", "MIT"))
    full = next(t for n, t in licenses.templates() if n == "GPL-2.0")
    own = full.split()
    rows = [(1, f"{gpl}\n{agpl}\n{mit} All rights reserved."), (2, " ".join(own[: len(own) // 2])),
            (3, " ".join(own[: len(own) * 9 // 10])), (4, f"{mit} {'filler ' * 30} {mit}")]
    got = {r.doc_id: [n.license for n in r.notices] for r in licenses.license_notices(documents(ship_package(spark), rows)).collect()}
    assert sorted(got[1]) == ["AGPL-3.0-or-later", "All-rights-reserved", "GPL-3.0-or-later", "MIT"]
    assert got[2] == [] and got[3] == ["GPL-2.0"] and got[4] == ["MIT", "MIT"]


# --- toxicity ------------------------------------------------------------------------


def plain_index(texts: list[str], toxic: list[int], corpus: list[str]) -> tuple[dict, list[dict]]:
    """Worth of every term and the unit vectors of the texts, by counting one by one."""
    found = [Counter(re.findall(r"[a-z]+", t)) for t in texts]
    everywhere = Counter(w for t in corpus for w in set(re.findall(r"[a-z]+", t)))
    total, bad = len(texts), sum(toxic)
    worth = {}
    for w in {w for f in found for w in f}:
        cells = [[0, 0], [0, 0]]
        for f, y in zip(found, toxic, strict=True):
            cells[w in f][y] += 1
        ratio = 0.0
        if cells[1][1] * total > sum(cells[1]) * bad:
            for has in (0, 1):
                for y in (0, 1):
                    expected = sum(cells[has]) * (bad if y else total - bad) / total
                    if cells[has][y]:
                        ratio += 2 * cells[has][y] * math.log(cells[has][y] / expected)
        worth[w] = (math.log((1 + len(corpus)) / (1 + everywhere[w])) + 1) * (1 + ratio)
    return worth, [plain_vector(t, worth) for t in texts]


def plain_vector(text: str, worth: dict) -> dict:
    own = {w: (1 + math.log(c)) * worth[w]
           for w, c in Counter(re.findall(r"[a-z]+", text)).items() if w in worth}
    size = math.sqrt(sum(x * x for x in own.values()))
    return {w: x / size for w, x in own.items()}


@pytest.mark.parametrize("heads", [0, 8, 1024])
def test_nearest_equals_all_cosines(spark, monkeypatch, heads):
    monkeypatch.setattr(toxicity, "HEADS", heads)
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    monkeypatch.setattr(toxicity, "ROWS", 7)
    rnd = random.Random(3)
    names = ["".join(rnd.choices("abcdefgh", k=rnd.randint(1, 5))) for _ in range(300)]
    texts = [" ".join(rnd.choices(names[: rnd.choice([9, 300])], k=rnd.randint(1, 40))) for _ in range(400)]
    texts = list(dict.fromkeys(texts))
    toxic = [int(names[5] in t.split() or rnd.random() < 0.1) for t in texts]
    corpus = texts + [" ".join(rnd.choices(names, k=9)) for _ in range(100)]
    worth, vectors = plain_index(texts, toxic, corpus)
    docs = documents(ship_package(spark), list(enumerate(corpus)))
    marked = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic long")
    index = toxicity.learn(docs, marked, F.lit(True))
    queries = [*corpus[-60:], *texts[:40], "nothing-known 123 xyz", ""]
    for query, (entries, cosines) in zip(
        queries, index.nearest(index.vectors(array(*queries)), 25), strict=True
    ):
        q = plain_vector(query, worth) if set(re.findall("[a-z]+", query)) & set(worth) else {}
        every = {i: sum(x * v.get(w, 0.0) for w, x in q.items()) for i, v in enumerate(vectors)}
        shared = sorted((c for c in every.values() if c > 0), reverse=True)
        least = shared[24] if len(shared) >= 25 else 0.0
        got = dict(zip(index.ids[entries].tolist(), cosines.tolist(), strict=True))
        assert {i for i, c in every.items() if c > least + 1e-6} <= set(got)
        assert all(every[i] > max(0, least - 1e-6) and abs(every[i] - c) < 1e-6 for i, c in got.items())


def made_index(texts: int, words: int, each: int, seed: int = 5) -> toxicity.Index:
    """An index of texts of ``each`` different words of ``words``, built without Spark."""
    rnd = np.random.default_rng(seed)
    term = np.sort(rnd.random((texts, words)).argpartition(each)[:, :each], axis=1).ravel().astype(np.int32)
    vocabulary, term = np.unique(term, return_inverse=True)
    return toxicity.build_index(
        np.arange(texts), rnd.integers(0, 2, texts).astype(np.int32), np.arange(0, texts * each + 1, each),
        term.astype(np.int32), rnd.integers(1, 9, len(term)).astype(np.int32),
        vocabulary.astype(np.uint64), texts, np.bincount(term),
    )


def test_texts_go_without_bounds_that_spare_nothing(monkeypatch):
    monkeypatch.setattr(toxicity, "HEADS", 4)
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    index = made_index(500, 60, 20)
    rnd = np.random.default_rng(6)
    queries = [(np.sort(rnd.choice(60, 20, False)), np.full(20, 20**-0.5)) for _ in range(64)]
    bounded = []
    plain = toxicity.Index._visit_bounded
    monkeypatch.setattr(toxicity.Index, "_visit_bounded", lambda *a: bounded.append(1) or plain(*a))
    found = list(index.nearest(queries, 25))
    assert len(bounded) == 2  # one text of 32
    monkeypatch.setattr(toxicity, "UNBOUND", 0)
    for (a, x), (b, y) in zip(found, index.nearest(queries, 25), strict=True):
        assert a.tolist() == b.tolist() and np.allclose(x, y, rtol=0, atol=1e-12)
    assert len(bounded) == 2 + 64


def test_index_is_built_in_bounded_memory():
    plain, sorted_at_once = np.lexsort, []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(np, "lexsort", lambda keys: sorted_at_once.append(len(keys[0])) or plain(keys))
        index = made_index(2000, 500, 100)
    assert len(index.entry) == 200_000
    assert max(sorted_at_once) <= 40_000  # postings are sorted by parts, not all at once
    for t in range(len(index.vocabulary)):
        assert (np.diff(index.entry[index.at[t] : index.at[t + 1]]) > 0).all()
    sizes = np.bincount(index.entry, index.weight.astype(float) ** 2)
    assert np.allclose(sizes, 1, atol=1e-5)


def test_learned_texts_are_bounded_in_bytes(spark):
    docs, labels = toxic_rows(300)
    frame = documents(ship_package(spark), docs)
    marked = spark.createDataFrame(labels, "doc_id long, toxic long")
    size = sum(len(t) for _, t in docs)
    assert len(toxicity.learn(frame, marked, F.lit(True)).ids) == 300
    some = toxicity.learn(frame, marked, F.lit(True), example_bytes=size // 2)
    assert 140 <= len(some.ids) <= 150
    assert len(toxicity.learn(frame, marked, F.lit(True), examples=40).ids) == 40
    assert len(toxicity.learn(frame, marked, F.lit(True), example_bytes=5).ids) == 0


def test_copies_of_toxic_examples_are_their_evidence(spark):
    """Also of examples whose words tell nothing by themselves."""
    docs, labels = toxic_rows(200)
    rnd = random.Random(6)
    own = " ".join("".join(rnd.choices("klmno", k=6)) for _ in range(30))
    docs = [*docs, (1000, own), (1001, own.upper()), (1002, f"{own} more"), *((2000 + i, "") for i in range(3))]
    marked = spark.createDataFrame([*labels, (1000, 1)], "doc_id long, toxic long")
    rows = toxicity.scores(documents(ship_package(spark), docs), marked, F.col("doc_id") != 7).collect()
    got = {r.doc_id: r for r in rows}
    for i in (1000, 1001, 1002):
        assert got[i].evidence[0].doc_id == 1000 and got[i].evidence[0].cosine > 0.9
        assert got[i].score > 0.8
    assert got[2000].evidence == [] and got[2000].score < 0.3


def test_toxicity_of_empty_tables(spark):
    frame = documents(ship_package(spark), toxic_rows(30)[0])
    marked = spark.createDataFrame(toxic_rows(30)[1], "doc_id long, toxic long")
    assert toxicity.scores(frame.where("false"), marked, F.lit(True)).count() == 0
    left = toxicity.drop_toxic(frame.where("false"), marked, F.lit(True))
    assert left.columns == frame.columns and left.count() == 0
    assert toxicity.drop_toxic(frame, marked.where("false"), F.lit(True)).count() == 30


def toxic_rows(n: int = 400) -> tuple[list, list]:
    rnd = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        own = [f"w{chr(97 + rnd.randint(0, 25))}{chr(97 + rnd.randint(0, 25))}" for _ in range(30)]
        bad = int(rnd.random() < 0.2)
        if bad:
            own[rnd.randrange(30)] = rnd.choice(["Grobian,", "lump!!", "FLEGEL"])
        docs.append((i, " ".join(own)))
        labels.append((i, bad))
    return docs, labels


def test_held_out_labels_are_told(spark):
    docs, labels = toxic_rows()
    frame = documents(ship_package(spark), docs)
    marked = spark.createDataFrame(labels, "doc_id long, toxic long")
    rows = toxicity.scores(frame, marked, ~toxicity.held_out(F.col("doc_id"))).collect()
    truth = dict(labels)
    for r in rows:
        assert 0 <= r.score <= 1
        if zlib.crc32(str(r.doc_id).encode()) % 4 == 2:
            assert (r.score >= 0.3) == bool(truth[r.doc_id])
            assert r.evidence[0].toxic == truth[r.doc_id]


def test_toxicity_of_odd_rows_and_labels(spark):
    docs, labels = toxic_rows(200)
    frame = documents(ship_package(spark), [*docs, *((1000 + (i or 0), t) for i, t in ODD), (None, None)])
    odd = [*labels, (None, 1), (5, None), (9999, 1), (3, 7), (labels[0][0], labels[0][1])]
    marked = spark.createDataFrame(odd, "doc_id long, toxic long")
    train = ~toxicity.held_out(F.col("doc_id"))
    rows = toxicity.scores(frame, marked, train).collect()
    assert len(rows) == len(docs) + len(ODD) + 1 and sum(r.doc_id is None for r in rows) == 1
    prior = {r.score for r in rows if r.doc_id is None or r.doc_id in (1001, 1002, 1013)}
    assert len(prior) == 1 and prior.pop() < 0.3
    left = toxicity.drop_toxic(frame, marked, train)
    assert left.columns == frame.columns
    assert left.count() == sum(r.score < 0.3 for r in rows)
    none = toxicity.scores(frame, marked.where("false"), train)
    assert {r.score for r in none.collect()} == {0.0}


# --- benchmark -----------------------------------------------------------------------

ITEM = (
    "Alice gave Tom 3 apples and 4 kg of pears. Then Tom ate 2 apples while Alice slept for 5 "
    "hours. How many apples does Tom have?"
)
SAME = ITEM.replace("Tom", "Peter").replace("3", "13").replace("kg", "lb").replace("hours", "minutes")
MIXED = ITEM.replace("Then Tom", "Then John").replace("while Alice", "while Mary").replace("does Tom", "does Karl")


def share(doc: str, item: str = ITEM) -> float:
    return decontaminate.fitting_share(decontaminate.Templates(array(doc)), decontaminate.Templates(array(item)))


def test_slots_must_fit():
    assert share(f"Some text before. {ITEM} And after.") >= 0.9
    assert share(f"Some text before.\n{SAME} And after.") >= 0.9
    assert share(MIXED) < 0.8
    assert share(ITEM.upper()) < 0.8 and share("") == 0.0 and share(ITEM, "") == 0.0


TWO = "Tom has 3 apples. Anna has 4 apples. How many apples do they have together?"
OTHER = TWO.replace("Tom", "Mary").replace("Anna", "Peter").replace("3", "12").replace("4", "7")


def test_names_at_openings_and_copies_in_other_case(spark):
    docs = [
        (1, f"Intro text. {OTHER} The end."), (2, OTHER.upper()), (3, TWO.lower()), (4, ITEM.upper()),
        (5, f"so it goes, {ITEM.lower()}"), (6, ITEM.replace("gave Tom", "gave\nTom")), (7, MIXED),
        (8, MIXED.upper()), (9, TWO.replace("Tom", "Mary").replace("apples.", "pears.")), (10, SAME),
        (11, ITEM.upper().replace("3 APPLES", "5 APPLES")), (12, TWO), (13, "Mary slept. Peter did not."),
    ]
    benchmark = spark.createDataFrame([(100, ITEM), (101, TWO)], "item_id long, text string")
    got = decontaminate.contamination(documents(ship_package(spark), docs), benchmark).collect()
    held = {r.doc_id: list(r["items"]) for r in got}
    assert sorted(i for i, x in held.items() if x == [100]) == [4, 5, 6, 10, 11]
    assert sorted(i for i, x in held.items() if x == [101]) == [1, 3, 12]
    assert all(not held[i] for i in (2, 7, 8, 9, 13))


def best_alignment(doc: str, item: str) -> float:
    """The share of every single alignment on its own, in plain Python, and the best of them."""
    d, i = decontaminate.Templates(array(doc)), decontaminate.Templates(array(item))
    have, want = (list(zip(h.tolist(), at.tolist(), strict=True)) for h, _, at in (d.windows(), i.windows()))
    best = 0
    for shift in {place - start for h, place in have for g, start in want if h == g}:
        pairs, held = set(), set()
        for h, start in want:
            if (h, start + shift) not in have:
                continue
            own = {
                (int(i.kind[k]), int(i.literal[k]), int(d.literal[k + shift]))
                for k in range(start, min(start + 5, len(i.kind)))
                if i.kind[k]
            }
            every = pairs | own
            equal = len({x[:2] for x in every}) == len(every)
            names = [x for x in every if x[0] == 3]
            if equal and len({x[2] for x in names}) == len(names):
                pairs, held = every, held | {h}
        best = max(best, len(held))
    return best / max(len({h for h, _ in want}), 1)


def test_every_alignment_is_tried():
    rnd = random.Random(12)
    train = "A train travels 80 km in 2 hours. Then it stops for 15 minutes and Tom leaves it with 3 bags. How far did it go?"
    opening = "A train travels 95 km to the sea."
    torn = MIXED.replace("3 apples", "8 apples")
    for item, early in ((train, [opening, train.replace("80", "70").replace("15", "2")]), (ITEM, [MIXED, torn])):
        for n in range(1, 6):
            before = " ".join(rnd.choice(early) + " Filler words here." for _ in range(n))
            for copy in (item, item.replace("Tom", "Peter").replace("3", "44")):
                for doc in (f"{before} {copy} The end.", f"{copy} {before}", f"{before}\n{copy}\n{before}"):
                    assert best_alignment(doc, item) >= 0.8
                    assert share(doc, item) >= best_alignment(doc, item) - 1e-9
    for text in (MIXED, torn, f"{torn} {MIXED} {opening}"):
        assert share(text) < 0.8
    # a word put in or left out inside a copy, behind an opening with other numbers
    for copy in (train.replace("stops", "slowly stops"), train.replace("and Tom", "Tom")):
        assert best_alignment(copy, train) < 0.8 or share(copy, train) >= 0.8
        assert share(f"{opening} {copy}", train) == share(copy, train)


def test_a_copy_behind_a_variant_goes(spark):
    variant = ITEM.replace("3", "5").replace("2", "9")
    torn = MIXED.replace("3 apples", "8 apples")
    docs = [(1, f"{torn} And again: {ITEM}"), (2, f"{variant} {torn}"), (3, torn), (4, f"{MIXED} {torn}")]
    benchmark = spark.createDataFrame([(100, ITEM)], "item_id long, text string")
    got = decontaminate.contamination(documents(ship_package(spark), docs), benchmark).collect()
    assert {r.doc_id for r in got if r.contaminated} == {1, 2}


def test_short_items_are_found_inside_documents(spark):
    rnd = random.Random(21)
    word = lambda: rnd.choice(["Paris", "of", "france.", "CAPITAL", "(the)", "5", "km", "12", "Élan", "x"])
    items = [(i, " ".join(word() for _ in range(1 + i % 4))) for i in range(24)]
    items += [(90, "capital of France"), (91, "..."), (92, ITEM)]
    docs = [*ODD, (900, "What is the capital of France? Nobody knows."), (901, f"x {ITEM}"), (902, "capital of Spain")]
    docs += [(1000 + i, " ".join(word() for _ in range(rnd.randint(0, 9)))) for i in range(60)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(documents(ship_package(spark), docs), benchmark).collect()

    def tokens(text):
        cut = (re.sub(r"^[^0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff]+$", "", w) for w in re.split(r"[ \t-\r]+", text or ""))
        return [w.lower() for w in cut if w]

    def holds(text, item):
        have, want = tokens(text), tokens(item)
        return bool(want) and any(have[i : i + len(want)] == want for i in range(len(have)))

    short = [(j, t) for j, t in items if j != 92]
    want = Counter((i, tuple(sorted(j for j, t in short if holds(text, t)))) for i, text in docs)
    assert Counter((r.doc_id, tuple(j for j in r["items"] if j != 92)) for r in got) == want
    held = {r.doc_id: list(r["items"]) for r in got}
    assert 90 in held[900] and 92 in held[901] and 90 not in held[902]


@pytest.mark.parametrize("bits", [1 << 22, 1024])
def test_contamination_equals_all_pairs(spark, monkeypatch, bits):
    monkeypatch.setattr(decontaminate, "BITS", bits)
    rnd = random.Random(4)
    items = [(i, " ".join(f"q{rnd.randint(0, 30)}" for _ in range(rnd.randint(3, 30)))) for i in range(20)]
    items += [(100, ITEM), (None, ITEM), (101, ""), (102, None), (103, "3 4 5 6 7 8")]
    docs = list(ODD)
    for i in range(40):
        text = rnd.choice(items)[1] or ""
        cut = text.split(" ")[rnd.randint(0, 2) :]
        docs.append((50 + i, f"before it {' '.join(cut)} after it"))
    docs += [(200, f"Intro.\n{SAME}"), (201, MIXED), (202, "3 4 5 6 7 8"), (203, "9 9 9 9 9 9")]
    benchmark = spark.createDataFrame(
        [(i, t, "x") for i, t in items], "item_id long, text string, mark string"
    )
    got = decontaminate.contamination(documents(ship_package(spark), docs), benchmark).collect()
    assert len(got) == len(docs)
    want = Counter(
        (i, tuple(sorted({j for j, t in items if j is not None and share(text or "", t or "") >= 0.8})))
        for i, text in docs
    )
    assert Counter((r.doc_id, tuple(r["items"])) for r in got) == want
    assert all(r.contaminated == bool(r["items"]) for r in got)
    held = {r.doc_id: list(r["items"]) for r in got}
    assert held[200] == [100] and held[201] == [] and held[202] == [103] and held[203] == []
    left = decontaminate.drop_contaminated(documents(spark, docs), benchmark)
    assert left.columns == documents(spark, []).columns
    assert left.count() == sum(not r.contaminated for r in got)


# --- language model ------------------------------------------------------------------


def plain_model(docs, train):
    rows = [(i, words(t) + [b""]) for i, t in docs]
    one, two = Counter(), Counter()
    for i, w in rows:
        if train(i):
            one.update(w)
            two.update(zip([b"^ "] + w[:-1], w, strict=True))
    n, v = sum(one.values()), len(one)
    after, kinds, k = Counter(), defaultdict(lambda: [0] * 4), Counter()
    for (u, w), c in two.items():
        after[u] += c
        kinds[u][min(c, 3)] += 1
        k[w] += 1
    of = lambda values: kneser_ney.discounts([list(values).count(i) for i in (1, 2, 3, 4)])
    d, dk, total = of(two.values()), of(k.values()), sum(k.values())
    rest = sum(dk[min(x, 3)] for x in k.values()) / total if total else 1.0

    def low(w):
        return max(k[w] - dk[min(k[w], 3)], 0) / max(total, 1) + rest / (v + 1)

    def p(u, w):
        if not after[u]:
            return low(w)
        spare = sum(d[i] * kinds[u][i] for i in (1, 2, 3))
        return (max(two[u, w] - d[min(two[u, w], 3)], 0) + spare * low(w)) / after[u]

    out = []
    for i, w in rows:
        base = sum(math.log10((one[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        score = sum(math.log10(p(u, x)) for u, x in zip([b"^ "] + w[:-1], w, strict=True))
        out.append((i, len(w), sum(one[x] > 0 for x in w), n, base, score))
    return out, p, one


@pytest.mark.parametrize("parts", [4])
def test_scores_equal_the_plain_model(spark, parts):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choice("The the cat dog, runs SAT on a mat".split()) for _ in range(rnd.randint(0, 40))))
            for i in range(80)] + list(ODD)
    train = lambda i: i is not None and i % 3 != 0
    got = kneser_ney.language_scores(
        documents(ship_package(spark), docs), F.col("doc_id") % 3 != 0, parts
    ).collect()
    want, p, one = plain_model(docs, train)
    key = lambda r: (r[0] is None, r[0] or 0, *(round(x, 6) for x in r[1:]))
    mine = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got]
    for a, b in zip(sorted(mine, key=key), sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and np.allclose(a[4:], b[4:])
    # the probabilities of all words and of one unknown word add up to one
    assert abs(sum(p(b"the", w) for w in one) + p(b"the", b"unheard") - 1) < 1e-9


def test_nothing_to_learn_and_nothing_to_score(spark):
    docs = documents(ship_package(spark), [(1, "a b"), (2, None)])
    rows = {r.doc_id: r for r in kneser_ney.language_scores(docs, F.lit(False)).collect()}
    assert rows[1].n_tokens == 3 and rows[2].n_tokens == 1 and rows[1].train_tokens == 0
    assert rows[1].held_out and rows[1].score == 0.0
    assert kneser_ney.language_scores(documents(spark, []), F.lit(True)).collect() == []


def test_model_beats_the_base_on_held_out_documents(spark):
    docs = queries.table(ship_package(spark), TABLES, "documents")
    rows = kneser_ney.language_scores(docs, kneser_ney.in_training(F.col("doc_id"))).collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


# --- queries and pipeline ------------------------------------------------------------


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_equals_its_plain_stages(spark):
    """Every stage's decisions, recomputed on what the stage before it kept."""
    docs = queries.table(ship_package(spark), TABLES, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe_coding"]
    columns = docs.columns
    from brute import components, kept_lines

    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.written(stage(spark, docs, TABLES), name)
        rows = docs.collect()
        after = {r.doc_id: r for r in rows}
        if name != "bpe_coding":
            assert docs.columns == columns
        if name == "line_dedup":
            lost = {i: d for i, _, d, _ in kept_lines(list(before.items()))}
            assert set(after) == set(before)
            assert all((after[i].text == before[i]) == (not lost[i]) for i in before)
            assert all(after[i].n_chars == len(after[i].text) for i in before)
        elif name == "near_dedup":
            groups = components({i: shingle_set(t) for i, t in before.items() if words(t)}, 80)
            assert set(after) == {i for i in before if groups.get(i, i) == i}
        elif name == "decontamination":
            items = [decontaminate.Templates(array(r.text)) for r in queries.table(spark, TABLES, "benchmark").collect()]
            for i, text in before.items():
                own = decontaminate.Templates(array(text))
                held = any(decontaminate.fitting_share(own, t) >= 0.8 for t in items)
                assert (i in after) == (not held)
        elif name == "bpe_coding":
            assert set(after) == set(before)
            want = bpe.Encoder(bpe.read_vocabulary(queries.WORD_VOCABULARY)).encode(
                [before[r.doc_id] for r in rows]
            )
            assert [r.ids for r in rows] == [np.frombuffer(x, "<u4").tolist() for x in want]
    assert after


def test_run_chains_the_stages(spark, monkeypatch):
    halves = [(n, lambda _, docs, __, k=k: docs.where(F.col("doc_id") % k != 0)) for n, k in (("a", 2), ("b", 3))]
    monkeypatch.setattr(corpus_pipeline, "STAGES", halves)
    rows = corpus_pipeline.run(spark, TABLES).collect()
    assert {r.doc_id for r in rows} == {i for i in range(200) if i % 2 and i % 3}


def test_words_are_counted_without_one_sort_of_all_texts(monkeypatch):
    texts = ["", "b a B", "", "Ünter a a", "a", "", "x1y x-x ."]
    want = []
    for i, t in enumerate(texts):
        words = re.findall(r"[a-z\x80-\U0010ffff]+", t.lower())
        data = [np.frombuffer(w.encode() + bytes(8), np.uint8) for w in words]
        hashes = [
            int(toxicity.span_hashes(d, np.array([0]), np.array([len(d) - 8]))[0]) for d in data
        ]
        want += [(i, h, n) for h, n in sorted(Counter(hashes).items())]
    monkeypatch.delattr(np, "lexsort")
    found = toxicity.term_counts(pa.array(texts, pa.large_string()))
    assert list(zip(*(x.tolist() for x in found), strict=True)) == want
    text, h, count = toxicity.term_counts(pa.array(["", " "], pa.large_string()))
    assert len(text) == len(h) == len(count) == 0
    starts, ends = np.array([5, 3, 9, 0]), np.array([7, 3, 4, 2])
    assert toxicity.ranges(starts, ends).tolist() == [5, 6, 0, 1]
    assert toxicity.ranges(starts[:0], ends[:0]).tolist() == []

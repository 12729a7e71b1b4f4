"""Near copies, repeated lines, long repeats and fingerprints against plain versions."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from brute import ODD, components, covered, documents, kept_lines, runs, shingle_set

from skytune.llm import fingerprint, lines, minhash, repeats
from skytune.llm.queries import ORACLES, QUERIES
from skytune.llm.ragged import Words, distinct, shingles
from skytune.session import ship_package


def array(*texts: str) -> pa.Array:
    return pa.array(texts, pa.large_string())


def family(n: int, size: int = 80, seed: int = 5) -> list[tuple[int, str]]:
    """Copies of three texts with a few words changed, so that likeness spreads around 0.85."""
    rnd = random.Random(seed)
    bases = [[f"w{rnd.randint(0, 9999)}" for _ in range(size)] for _ in range(3)]
    out = []
    for i in range(n):
        own = list(rnd.choice(bases))
        for _ in range(rnd.randint(0, 3)):
            own[rnd.randrange(size)] = f"x{rnd.randint(0, 99)}"
        out.append((i, " ".join(own)))
    return out


def test_signatures_estimate_likeness():
    rnd = random.Random(1)
    base = [f"w{i}" for i in range(400)]
    other = base[:]
    for i in rnd.sample(range(400), 20):
        other[i] = "z"
    texts = " ".join(base), " ".join(other)
    h, text = distinct(*shingles(Words(array(*texts)), 5)[:2])
    marks = minhash.superminhash(h, text, 2, 512)
    a, b = map(shingle_set, texts)
    assert abs((marks[0] == marks[1]).mean() - len(a & b) / len(a | b)) < 0.07
    assert (marks < minhash.UNSET).all()


def test_one_element_fills_all_registers_in_random_order():
    h, text = np.array([12345], np.uint64), np.array([0])
    marks = minhash.superminhash(h, text, 1, 64)[0]
    assert sorted((marks >> np.uint64(32)).tolist()) == list(range(64))


@pytest.mark.parametrize("percent,rows", [(85, 4), (80, 3)])
def test_groups_equal_all_pairs(spark, percent, rows):
    docs = family(90)
    spark = ship_package(spark)
    got = minhash.near_groups(documents(spark, docs), percent=percent, rows=rows).collect()
    want = components({i: shingle_set(t) for i, t in docs}, percent)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(shingle_set(dict(docs)[r.doc_id])) for r in got)
    assert all(r.kept == (r.doc_id == want[r.doc_id]) for r in got)


def test_a_hot_pivot_is_split(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PER_PIVOT", 4)
    docs = family(60, seed=9)
    got = minhash.near_groups(documents(ship_package(spark), docs), percent=85, rows=4).collect()
    assert {r.doc_id: r.component_id for r in got} == components(
        {i: shingle_set(t) for i, t in docs}, 85
    )


def test_a_pair_meets_once_however_many_buckets_it_shares(spark):
    sketch = ", ".join(f"0L as {b}" for b in minhash.SKETCH)
    members = spark.range(5).selectExpr(
        "id as rep", "10L as n", "id as label", "array(1L, 2L, 3L + (id + 1) div 3, 9L) as keys",
        *sketch.split(", "),
    ).selectExpr("*", "posexplode(keys) as (band, bucket)")
    for each in (1, 2, 5):
        pairs = minhash.meetings(minhash.pivots_of(members, each), members, 85).collect()
        got = {(r.a, r.b) for r in pairs}
        assert len(pairs) == len(got)
        assert got >= {(a, b) for a in range(each) for b in range(a + 1, 5)}


def test_few_rows_take_few_tasks_and_compiled_conditions(spark, monkeypatch):
    spark = ship_package(spark)
    cores = spark.sparkContext.defaultParallelism
    assert minhash.in_tasks(spark.range(0, 90, 1, 50), 90).rdd.getNumPartitions() == min(cores, 50)
    assert minhash.in_tasks(spark.range(0, 90, 1, 50), 10**9).rdd.getNumPartitions() == 50
    tasks, plans = [], []

    def noted(df, purpose, plain=minhash.written):
        if purpose == "pairs":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        if purpose in ("classes", "buckets", "pairs", "links"):
            tasks.append(df.rdd.getNumPartitions())
        return plain(df, purpose)

    monkeypatch.setattr(minhash, "written", noted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(3 * cores))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = family(60, seed=9)
        minhash.near_groups(documents(spark, docs), percent=85, rows=4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert max(tasks) <= cores
    assert plans and not any("lambda" in plan for plan in plans)


@pytest.mark.parametrize("most", [500_000, 9])
def test_long_chains_are_one_component(spark, monkeypatch, most):
    monkeypatch.setattr(minhash, "EDGES", most)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)]
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    got = dict(minhash.components(edges).collect())
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_the_bitmap_of_ids_loses_none(spark):
    rows = spark.range(20000).selectExpr("id - 500 as doc_id", "'t' as text")
    ids = spark.range(20000).where("id % 40 = 7").selectExpr("id - 500 as id")
    got = {r[0] for r in minhash.maybe_among(rows, "doc_id", ids).collect()}
    want = {r[0] for r in ids.collect()}
    assert want <= got and len(got) < 2 * len(want)
    assert minhash.maybe_among(rows, "doc_id", ids.limit(0)).count() == 0


def test_near_groups_of_odd_rows(spark):
    docs = documents(ship_package(spark))
    rows = minhash.near_groups(docs).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[5].component_id == by_id[6].component_id == by_id[7].component_id == 5
    assert not by_id[7].kept and by_id[5].kept
    assert by_id[1].n_shingles == by_id[13].n_shingles == 0 and by_id[13].component_id == 13
    nameless = [r for r in rows if r.doc_id is None]
    assert all(r.component_id is None and r.kept for r in nameless) and len(nameless) == 3
    left = minhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id in (5, 6, 7)) == [5]


def test_lines_equal_the_plain_version(spark):
    docs = documents(spark)
    got = lines.line_report(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(kept_lines(ODD), key=key)


@pytest.mark.parametrize("share", [1, 3, 40])
def test_lines_of_frequent_keys_equal_the_plain_version(spark, share):
    rnd = random.Random(share)
    own = [f"Line {i} that is long enough to count as one, of {i % 3} kinds" for i in range(12)]
    weights = [200, 60, *[3] * 10]
    rows = [(i % 150, "\n".join(rnd.choices([*own, "short"], [*weights, 9], k=rnd.randint(0, 9)))) for i in range(150)]
    rows += [(500, "\n".join([own[3]] * 90)), (None, own[0])]
    got = lines.line_report(documents(spark, rows), share=share, partitions=5).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(kept_lines(rows), key=key)


def test_lines_meet_by_range_alone(spark):
    """No line key is hash-partitioned but in its counts, and no Python runs."""
    plan = lines.line_drops(documents(spark), partitions=4)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in plan and "Python" not in plan and "Arrow" not in plan
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_lines_equal_the_sql_twin(spark):
    tables = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet'")
    want = db.execute(ORACLES["op8_line_dedup"]).fetchall()
    got = QUERIES["op8_line_dedup"](spark, tables)
    assert got.columns == [d[0] for d in db.description]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_dropped_lines_leave_the_other_columns(spark):
    docs = documents(spark)
    left = lines.drop_lines(docs)
    assert left.columns == docs.columns and left.count() == len(ODD)
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[8] == "first" and texts[12].startswith("A line") and texts[1] is None


def test_bitmap_runs(spark):
    frame = spark.createDataFrame([([0, 1, 4, 6, 7],), ([],), ([3],)], "a array<int>")
    got = [[tuple(x) for x in r[0]] for r in frame.select(lines.runs_of(frame.a)).collect()]
    assert got == [[(0, 2), (4, 1), (6, 2)], [], [(3, 1)]]


def noisy(n: int, seed: int = 3) -> list[tuple[int, str]]:
    rnd = random.Random(seed)
    base = "".join(rnd.choice("abcde é\n") for _ in range(400))
    out = []
    for i in range(n):
        cut = rnd.randint(0, 300)
        own = list(base[cut : cut + rnd.randint(10, 300)])
        for _ in range(rnd.randint(0, 2)):
            own[rnd.randrange(len(own))] = "Z"
        out.append((i, "".join(own) + "".join(rnd.choice("vwxyz") for _ in range(rnd.randint(0, 80)))))
    return out


@pytest.mark.parametrize("most", [2048, 3, 0])
@pytest.mark.parametrize("length", [64, 150])
def test_repeats_equal_all_windows(spark, monkeypatch, most, length):
    monkeypatch.setattr(repeats, "MOST", most)
    docs = noisy(40)
    got = {r.doc_id: r for r in repeats.repeat_report(documents(ship_package(spark), docs), length).collect()}
    raw = [t.encode() for _, t in docs]
    for (i, _), text, gone in zip(docs, raw, covered(raw, length), strict=True):
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(text), sum(gone), runs(gone))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeats_of_odd_rows(spark):
    rows = repeats.repeat_report(documents(ship_package(spark))).collect()
    texts = [(t or "").encode() for _, t in ODD]
    want = sorted(
        (i or -1, len(t), sum(g), runs(g)) for (i, _), t, g in zip(ODD, texts, covered(texts, 400), strict=True)
    )
    assert sorted((r[0] if r[0] is not None else -1, *r[1:4]) for r in rows) == want


def test_one_long_text_is_read_in_tiles(monkeypatch):
    rnd = random.Random(2)
    part = "".join(rnd.choice("abcdefgh") for _ in range(700))
    data = np.frombuffer((part + "x" + part).encode(), np.uint8)
    whole = repeats.contexts(data, np.array([0, len(data)]), 100)
    monkeypatch.setattr(repeats, "TILE", 512)
    tiled = repeats.contexts(data, np.array([0, len(data)]), 100)
    assert whole[2].sum() == tiled[2].sum() == len(data) - 99


def test_longest_matches_equal_a_search():
    rnd = random.Random(4)
    for _ in range(60):
        base = bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 25)))
        texts = [base[rnd.randint(0, len(base) - 1) :] for _ in range(rnd.randint(1, 5))]
        got, at = repeats.longest_matches(texts, 1000), 0
        for a, s in enumerate(texts):
            for i in range(len(s)):
                best = 0
                for b, t in enumerate(texts):
                    for j in range(len(t)):
                        if (a, i) != (b, j):
                            k = 0
                            while i + k < len(s) and j + k < len(t) and s[i + k] == t[j + k]:
                                k += 1
                            best = max(best, k)
                assert got[at + i] == best
            at += len(s) + 1


def test_likeness_of_long_runs():
    made = ["a" * 65_543, "", "a" * 40_000 + "b" * 25_543, "a" * 65_543]
    near = fingerprint.vectors(pa.array(made, pa.large_string()))[1]
    empty, edited, same = fingerprint.likeness(near[[0, 0, 0]], near[1:])
    assert empty == 0 and 0.6 < edited < 0.7 and same == 1


def test_fingerprints_add_up():
    def of(text: str) -> bytes:
        exact, near = fingerprint.vectors(array(text))
        return exact.astype("<u8").tobytes() + near.astype("<u2").tobytes()

    assert fingerprint.add(of("first one"), of("the second")) == of("the second\nfirst one")
    assert fingerprint.add(of("a\nb b\nc"), of("b b"), -1) == of("c\na")
    assert of("a\na") != of("a") and of("") == of("")


def test_likeness_follows_what_is_shared():
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    text = " ".join(word() for _ in range(400))
    other = " ".join(word() for _ in range(400))
    made = [text, text, text[: len(text) // 2] + other[: len(text) // 2], other]
    near = fingerprint.vectors(array(*made))[1]
    same, half, none = fingerprint.likeness(near[[0, 0, 0]], near[1:])
    assert same == 1.0 and 0.2 < half < 0.5 and none < 0.1


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_edits_equal_the_plain_version(spark, parts):
    rows = [(i, t) for i, t in ODD if i is not None and i != 7] + [(20 + i, f"text {i}" * i) for i in range(30)]
    got = {r.doc_id: r for r in fingerprint.edit_report(documents(ship_package(spark), rows), parts).collect()}
    texts = {i: t or "" for i, t in rows}
    order = sorted(texts, reverse=True)
    for n, i in enumerate(order):
        text, after = texts[i], texts[order[(n + 1) % len(order)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        assert (got[i].fingerprint == got[i].edited_fingerprint) >= (text == edited)


def test_edits_of_odd_rows(spark):
    rows = fingerprint.edit_report(documents(ship_package(spark)), 3).collect()
    assert len(rows) == len(ODD) and sum(r.doc_id is None for r in rows) == 3
    by_text = {}
    for r in fingerprint.fingerprints(documents(spark)).collect():
        by_text.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert by_text[5] == by_text[6] and by_text[1] == by_text[2] and by_text[3] != by_text[2]


def test_empty_tables(spark):
    docs = documents(ship_package(spark), [])
    assert minhash.near_groups(docs).collect() == []
    assert minhash.drop_near_copies(docs).collect() == []
    assert lines.line_report(docs).collect() == []
    assert repeats.repeat_report(docs).collect() == []
    assert fingerprint.edit_report(docs).collect() == []

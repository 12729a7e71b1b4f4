"""BPE coding and token counts against the public tokenizer library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import ODD, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skytune.llm import bpe, pretokens, tokencount
from skytune.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY
from skytune.session import free_workers, sent, ship_package

TRICKY = "abcABC 's'll  \n\t\r\x0b\x1c\x1f\x85\xa0  　​́eéÉßΣσς漢字ÅÅİ😀👍🏽½²0123<|endoftext|><|startoftext|>!?.,-_\"\x00"


@pytest.fixture(scope="module")
def libraries():
    return [Tokenizer.from_file(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(pretokens.read_vocabulary(WORD_VOCABULARY))


@pytest.fixture(scope="module")
def counter():
    return tokencount.Counter(pretokens.read_vocabulary(BYTE_VOCABULARY))


def samples(n: int) -> list[str]:
    rnd = random.Random(7)
    made = ["".join(rnd.choice(TRICKY) for _ in range(rnd.randint(0, 80))) for _ in range(n)]
    return [*made, "a" * 3000, " " * 70, "  \n \n  x", "it's they'LL", *(t or "" for _, t in ODD)]


def test_ids_are_those_of_the_library(libraries, encoder):
    texts = samples(1500)
    want = [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def test_decoding_is_that_of_the_library(libraries, encoder):
    texts = samples(300)
    decoder = bpe.Decoder(pretokens.read_vocabulary(WORD_VOCABULARY))
    ids = encoder.encode(texts)
    want = [
        libraries[0].decode(np.frombuffer(x, "<u4").tolist(), skip_special_tokens=False) for x in ids
    ]
    assert [x.decode() for x in decoder.decode(ids)] == want
    assert decoder.decode([]) == [] and decoder.decode([b""]) == [b""]


def test_counts_are_those_of_the_library(libraries, counter):
    texts = samples(1500)
    want = [len(e.ids) for e in libraries[1].encode_batch(texts, add_special_tokens=False)]
    assert counter.counts(texts) == want


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cn", "Co", "Cs")), max_size=60))
def test_any_text(libraries, encoder, counter, text):
    ids = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
    assert ids == libraries[0].encode(text, add_special_tokens=False).ids
    assert counter.counts([text]) == [len(libraries[1].encode(text, add_special_tokens=False).ids)]


def test_memory_of_words_is_bounded(encoder, counter, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    monkeypatch.setattr(tokencount, "KEPT", 3)
    text = " ".join(f"some{i}thing" for i in range(50))
    first = encoder.encode([text]), counter.counts([text])
    assert (encoder.encode([text]), counter.counts([text])) == first


def test_reports_on_odd_rows(spark, libraries):
    docs = documents(ship_package(spark))
    coded = {(r[0], r[2]): r for r in bpe.coding_report(docs, WORD_VOCABULARY).collect()}
    rows = tokencount.token_counts(docs, BYTE_VOCABULARY).collect()
    assert len(rows) == len(ODD)
    counted = sorted(((r[0] or -1), *r[1:]) for r in rows)
    want = []
    for i, text in ODD:
        e = libraries[0].encode(text or "", add_special_tokens=False)
        digest = hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest()
        row = coded[i, digest]
        decoded = libraries[0].decode(e.ids, skip_special_tokens=False)
        assert row.n_tokens == len(e.ids)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        n = len(libraries[1].encode(text or "", add_special_tokens=False).ids)
        want.append((i or -1, len((text or "").encode()), n, n > 1024))
    assert counted == sorted(want)


def test_empty_table(spark):
    docs = documents(ship_package(spark), [])
    assert bpe.round_trip(docs, WORD_VOCABULARY).collect() == []
    assert tokencount.token_counts(docs, BYTE_VOCABULARY).collect() == []


def test_round_trip_columns(spark):
    row = bpe.round_trip(documents(ship_package(spark), [(1, "Hello hello")]), WORD_VOCABULARY).first()
    assert row.decoded == "hello</w> hello</w>" and row.ids[0] == row.ids[1]


def test_few_whole_texts_go_to_a_worker_at_once(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    rows = ship_package(spark).range(0, 9000, 1, 1).mapInArrow(sizes, "n long").collect()
    assert sum(r.n for r in rows) == 9000 and max(r.n for r in rows) <= 2000


def test_line_dedup_frees_the_workers_first(spark, monkeypatch):
    import corpus_pipeline

    freed = []

    def noted(session, plain=corpus_pipeline.free_workers):
        freed.append(plain(session))

    monkeypatch.setattr(corpus_pipeline, "free_workers", noted)
    docs = documents(ship_package(spark), [(1, "a"), (2, None)])
    assert corpus_pipeline.line_dedup(spark, docs, "").count() == 2 and len(freed) == 1


def test_line_dedup_runs_no_python(spark, monkeypatch):
    import corpus_pipeline

    docs = documents(ship_package(spark), [(1, "a"), (2, None)])

    def refused(*args):
        raise AssertionError("Python on the executors")

    with monkeypatch.context() as held:
        held.setattr(type(docs), "mapInArrow", refused)
        assert corpus_pipeline.line_dedup(spark, docs, "").count() == 2
    value = sent(spark, [1, 2])
    free_workers(spark)
    got = spark.range(2).rdd.map(lambda r: value.value[r.id]).collect()
    assert got == [1, 2]  # a job that still needs it gets it again

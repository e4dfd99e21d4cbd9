"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every dealt operator."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, fp long, bucket int, block int"
LONG = "word " * 40_000
ROWS = [
    (1, None, None, None, 0, 1, 1, 1, 1), (2, "", "en", "", 0, 1, 1, 1, 1), (3, "a", "en", "s", 1, 1, 1, 1, 1), (3, "a", "en", "s", 1, 1, 1, 1, 1),
    (None, "the same words again and again here", None, None, 5, 1, 1, 1, 1), (5, LONG, "en", "t", 9, 1, 1, 1, 1), (6, "  \n\t ", "fr", "t", 2, 1, 1, 1, 1),
    (7, "x" * 300, "en", "t", 300, 1, 1, 1, 1), (8, "x" * 300, "de", "u", 300, 1, 1, 1, 1), (9, "<|endoftext|> é 中 ﷽  two  spaces", "de", "u", 3, 1, 1, 1, 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def run(name, df):
    from corpusmill.llm import language_id, lm_scoring, mixing, packing, pii, quality, simhash, suffix_dedup, syncmers

    labels = df.sparkSession.createDataFrame([(3, 1), (5, 0), (None, 1), (7, None)], "doc_id long, quality int")
    return {
        "lm": lambda: lm_scoring.score(df, PATH), "language": lambda: language_id.identify(df), "pii": lambda: pii.personal_data(df), "suffix": lambda: suffix_dedup.repeated_bytes(df),
        "quality": lambda: quality.quality(df, labels), "mixing": lambda: mixing.mix(df), "packing": lambda: packing.pack(df, PATH), "simhash": lambda: simhash.near_duplicates(df), "syncmers": lambda: syncmers.fingerprinted(df),
    }[name]()


NAMES = ["lm", "language", "pii", "suffix", "quality", "mixing", "packing", "simhash", "syncmers"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(docs, name):
    out = run(name, docs).collect()
    if name == "packing":
        by = {}
        for r in out:
            by[r.doc_id] = by.get(r.doc_id, 0) + r.length
        assert by[1] == by[2] == 1 and by[3] == 4 and sum(by.values()) == sum(r.length for r in out)
    else:
        assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(none, name):
    assert run(name, none).collect() == []


def test_suffix_counts_repeated_rows(docs):
    by = {r.doc_id: r for r in run("suffix", docs).collect()}
    assert len(by[7].kept) == len(by[8].kept) == len(by[5].kept) == 0 and bytes(by[3].kept) == b"a"


def test_syncmers_of_equal_texts(docs):
    out = run("syncmers", docs).collect()
    by = {r.doc_id: r for r in out}
    assert by[7].fingerprint == by[8].fingerprint and by[9].near_next == 0.0
    assert by[2].edited_sha256 == hashlib.sha256(b"").hexdigest()


def test_language_without_letters(docs):
    by = {r.doc_id: r for r in run("language", docs).collect()}
    assert by[1].lang_pred == by[6].lang_pred == "und" and by[2].score == 0.0


def test_mixing_targets(docs):
    out = run("mixing", docs).collect()
    assert all(r.taken <= 3 * r.size for r in out)
    assert out == [] or abs(sum({r.source: r.target for r in out}.values()) - sum(r.size for r in out)) < 1e-6


def test_embeddings(spark):
    from corpusmill.llm.embedding_join import near_duplicates

    schema = "vec_id long, embedding array<float>, label int"
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [2.0, 0.01], 1), (4, [2.0, 0.01], 2), (5, [float("nan"), 1.0], 1), (6, [1.0, None], 1), (7, [], 1), (8, [1.0, 0.0, 0.0], 1), (9, [0.0, 1.0], 1)]
    by = {(r.vec_id): r for r in near_duplicates(spark.createDataFrame(rows, schema)).collect()}
    assert by[3].n_links == 2 and by[4].n_links == 2 and by[4].component_id == 3 and not by[4].kept
    assert all(by[i].n_links == 0 and by[i].kept for i in (1, 2, 5, 6, 7, 8, 9))
    assert near_duplicates(spark.createDataFrame([], schema)).collect() == []


def test_covering_masks():
    import itertools

    from corpusmill.llm.simhash import covering_masks

    masks = [m % 2**64 for m in covering_masks()]
    assert all(any(not sum(1 << i for i in c) & m for m in masks) for c in itertools.combinations(range(64), 3))
    assert F is not None

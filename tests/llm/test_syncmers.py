"""Fingerprints and likeness against plain Python, which reads them from the strings alone."""

import random
import re

import pytest

from corpusmill.llm import queries as llm
from corpusmill.llm.syncmers import K, S, UNIT, fingerprinted

SCHEMA = "doc_id long, text string"


def run(spark, rows):
    return fingerprinted(spark.createDataFrame(rows, SCHEMA)).collect()


def anchors(fingerprint):
    """(hash and distance, offset) of each anchor of a spelled fingerprint."""
    out, at = [], 1
    for i in range(0, len(fingerprint), 10):
        at += int(fingerprint[i + 9], 16)
        out.append((fingerprint[i : i + 10], at))
    return out


def alike(a, b):
    a, b = anchors(a), anchors(b)
    if not a and not b:
        return 1.0
    x, y = ({v for v, _ in s} for s in (a, b))
    return max(len(x & y) / max(len(x), len(y), 1), len(set(a) & set(b)) / max(len(a), len(b), 1))


def test_likeness_is_that_of_the_fingerprints(spark, sf):
    out = sorted(llm.queries()["op10_syncmers"](spark, sf).collect(), key=lambda r: -r.doc_id)
    for r, following in zip(out, [*out[1:], out[0]]):
        assert r.near_edited == pytest.approx(alike(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(alike(r.fingerprint, following.fingerprint))


def test_anchors_are_closed_and_free_of_context(spark):
    """Which k-mers are anchors, by the s-mers' order: it must not depend on what stands around them."""
    rng = random.Random(3)
    words = [f"w{rng.randrange(40)}" for _ in range(300)]
    middle = " ".join(words)
    texts = [middle, "x " * 7 + middle, middle + " y" * 9, "p q " + middle + " r s t"]
    # rows of ids by which no text follows another it is like
    got = {r.doc_id: anchors(r.fingerprint) for r in run(spark, list(enumerate(texts)))}
    inside = lambda a, lo, hi: [(v[:9], at - lo) for v, at in a if lo + K <= at < hi]
    shift = [0, 7, 0, 2]
    want = inside(got[0], 0, 300)
    assert want and all(inside(got[i], d, 300 + d) == want for i, d in enumerate(shift))
    for a in got.values():
        assert all(0 <= int(v[9], 16) <= K - S for v, _ in a)


def test_a_text_within_a_longer_one(spark):
    rng = random.Random(5)
    long = [f"word{rng.randrange(10_000)}" for _ in range(200)]
    by = {r.doc_id: r for r in run(spark, [(2, " ".join(long[90:110])), (1, " ".join(long))])}
    assert by[2].near_next > 0


def test_one_word_more_moves_anchors_only(spark):
    rng = random.Random(6)
    a = [f"word{rng.randrange(10_000)}" for _ in range(120)]
    by = {r.doc_id: r for r in run(spark, [(2, " ".join(a)), (1, " ".join(["more", *a]))])}
    assert by[2].near_next > 0.9


def test_texts_of_few_units(spark):
    rows = [(5, "a"), (4, "one two three"), (3, ""), (2, None), (1, "ab" * 20)]
    by = {r.doc_id: r for r in run(spark, rows)}
    assert by[3].fingerprint == by[2].fingerprint == "" and by[3].near_next == 1.0 and by[5].near_next == 0.0
    assert by[5].fingerprint and by[4].near_edited > 0 and by[1].near_edited > 0
    assert len(re.findall(UNIT, "ab" * 20)) == 5


def test_next_of_repeated_and_null_ids(spark):
    rows = [(None, f"null {i}") for i in range(40)] + [(7, f"seven {i % 30}") for i in range(60)] + [(i, f"own {i}") for i in range(8, 900)]
    out = fingerprinted(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(k) for k, _ in rows)
    from corpusmill.llm.syncmers import with_next

    texts = with_next(spark.createDataFrame(rows, SCHEMA), bucket_rows=16).select("doc_id", "text", "next_text").collect()
    # one round through all rows: every text follows as often as it stands
    assert sorted(r.next_text for r in texts) == sorted(t for _, t in rows)
    follows = {(r.doc_id, r.text): r.next_text for r in texts}
    assert all(follows[i, f"own {i}"] == f"own {i - 1}" for i in range(9, 900)) and follows[8, "own 8"].startswith("seven")
    assert sum(t.startswith("null") for (k, _), t in follows.items() if k == 7) == 1

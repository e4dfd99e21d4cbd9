"""Removal of repeated bytes against brute force: many equal rows, long texts, keys that equal splitters."""

import random
from collections import Counter

import numpy as np
import pytest

from corpusmill.llm import suffix_dedup as S


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + 200] for t in raw for i in range(len(t) - 199))
    out = []
    for t in raw:
        cut = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                cut[i : i + 200] = 1
        out.append(bytes(np.frombuffer(t, np.uint8)[cut[:-1] == 0]))
    return out


def word(rng):
    return "".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 9)))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    make = lambda n: " ".join(word(rng) for _ in range(n))
    shared = [make(n) for n in (30, 45, 60, 200)]
    out = [make(20) + rng.choice(shared) + make(rng.randint(0, 30)) + rng.choice([*shared, ""]) for _ in range(120)]
    out += [shared[3]] * 400 + [None, "", "short", "x" * 700, make(40) * 30]
    long = make(60_000)
    return out + [long, long[100_000:180_000] + make(50)]


@pytest.mark.parametrize("block", [4096, 4 << 20])
def test_equals_brute_force(spark, texts, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK_BYTES", block)
    monkeypatch.setattr(S, "n_blocks", lambda df, size: 24 if size < 1 << 20 else 4)
    monkeypatch.setattr(S, "PORTION", 3000)
    assert max(len(t or "") for t in texts) > S.CHUNK
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: bytes(r.kept) for r in S.repeated_bytes(rows).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_keys_on_a_boundary_count_on_both_sides():
    first, second = np.array([1, 5, 5, 9], np.uint64), np.array([3, 2, 7, 4], np.uint64)
    at = S.Splitters(np.array([5], np.uint64), np.array([7], np.uint64))
    rows = [r for block in (0, 1) for r in S._sent(block, 0, at, first, second, np.ones(4, np.uint8))]
    flags: dict = {}
    for bucket in (0, 1):
        own = [r for r in rows if r["bucket"] == bucket]
        keys = [np.concatenate([np.frombuffer(r[c], np.uint64) for r in own]) for c in ("first", "second")]
        assert at.holds(bucket, *keys)
        times = np.concatenate([np.frombuffer(r["times"], np.uint8) for r in own])
        judged = np.split(S.judge_suffixes(*keys, times), np.cumsum([len(r["times"]) for r in own])[:-1])
        for r, f in zip(own, judged):
            flags.setdefault(r["block"], []).append((bucket, f.tobytes()))
    for block in (0, 1):
        assert S._answers({(1, 0): flags[block]}, 1, 0, at, first, second).tolist() == [2, 2, 2, 2]
    # each side alone saw the key on the boundary once
    assert all(f[-1] == 1 if bucket == 0 else f[0] == 1 for block in (0, 1) for bucket, f in flags[block])


def test_order_is_that_of_the_bytes():
    data = np.frombuffer(b"the order of suffixes is that of their bytes " * 8, np.uint8)
    start = np.arange(len(data) - 199)
    lead, fp = S.Chunk.tokens(data, start)
    order, _, _ = S.multikey_order(lead, fp)
    heads = [bytes(data[i : i + 8]) for i in order]
    assert heads == sorted(heads)

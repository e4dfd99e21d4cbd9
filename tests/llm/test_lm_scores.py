"""Scores by the language model against plain loops, and what training may depend on."""

import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from corpusmill.llm import attention, queries as llm
from corpusmill.llm.lm_scoring import END, STRETCH, Corpus, Words, _stretches, score, scores, subwords_of
from corpusmill.llm.tokens import tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def corpus_of(masses, once=3, tokens=50):
    return Corpus(masses, tokenizer(PATH).begin_with_space(END + 1) | (np.arange(END + 1) == END), once, tokens)


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 9, END + 1).astype(float)
    return attention.Attention.new(counts, rng, rng.integers(0, 5, END + 1)), counts + 0.5


def scored(model, corpus, texts, counts):
    w = Words(pa.array(texts))
    ids, begin, size = subwords_of(w.distinct, tokenizer(PATH))
    return scores(model, corpus, w.starts, w.number, np.array([float(counts.get(x, 0)) for x in w.distinct.to_pylist()]), ids, begin, size)


def test_scores_equal_plain_loops(model):
    net, masses = model
    corpus, texts = corpus_of(masses), ["the cat sat on a mat", "", "unseen quixotically the the", "one " * 60, "中文 ½ x"]
    counts = {"the": 9, "cat": 2, "one": 4, "a": 1}
    whole = np.bincount(net.cls, masses, minlength=attention.CLASSES)
    bpe, L = tokenizer(PATH), 1 - (3 + 1) / (50 + 2)
    for text, got in zip(texts, scored(net, corpus, texts, counts)):
        words = [np.array(bpe.plain(" " + w)) for w in text.split()] + [np.array([END])]
        ids = np.concatenate(words)
        # the class distribution at each place, from the window that scores it
        p = np.zeros((len(ids), attention.CLASSES))
        k = 0
        while True:
            lo = k * attention.STRIDE
            before = np.r_[END, ids][lo : lo + attention.WINDOW]
            logits = net.forward(before[None, :])["logits"][0].astype(float)
            new = range(0 if k == 0 else attention.WINDOW - attention.STRIDE, len(before))
            for i in new:
                if lo + i < len(ids):
                    p[lo + i] = np.exp(logits[i]) / np.exp(logits[i]).sum()
            if lo + attention.WINDOW >= len(ids):
                break
            k += 1
        one = lambda at, i: p[at, net.cls[i]] * math.exp(net.log_share[i])  # noqa: E731, B023
        begins = [sum(p[at, net.cls[i]] * masses[i] / whole[net.cls[i]] for i in np.flatnonzero(corpus.starters)) for at in range(len(ids))]
        total, at = 0.0, 0
        for w, own in zip([*text.split(), None], words):
            if w is None:
                total += math.log10(one(at, END) / begins[at])
                break
            seen = p[at, net.cls[own[0]]] * counts.get(w, 0) / whole[net.cls[own[0]]]
            spelled = np.prod([one(at + i, x) for i, x in enumerate(own)]) * begins[at + len(own)]
            total += math.log10((L * seen + (1 - L) * spelled) / begins[at])
            at += len(own)
        assert got == pytest.approx(total, rel=1e-4)


def test_words_have_at_most_all_probability(model):
    """Over all words the corpus shares of a context sum to the probability that a word begins."""
    net, masses = model
    corpus = corpus_of(masses)
    ids = np.array([[END, 262, 3797, 3332]])
    p = np.exp(net.forward(ids)["logits"][0].astype(float))
    p /= p.sum(1, keepdims=True)
    share = corpus.begins(net)
    first = np.bincount(net.cls, masses * corpus.starters, minlength=attention.CLASSES) / np.maximum(np.bincount(net.cls, masses, minlength=attention.CLASSES), 1e-300)
    _, begins = net.log_prob(ids, ids, share)
    assert np.allclose(np.exp(begins), p @ first, rtol=1e-4) and (np.exp(begins) <= 1).all()


def test_long_words_have_no_floor(model):
    net, masses = model
    texts = ["".join(chr(0x4E00 + i * 37 % 20000) for i in range(n)) for n in (200, 400)]
    got = scored(net, corpus_of(masses), texts, {})
    assert got[1] < 1.5 * got[0] < -450


def test_every_position_has_context():
    ids = np.arange(300)
    inputs, targets, own = attention.windows(ids, np.array([0, 100, 300]), 999)
    before = {}
    for x, row, o in zip(inputs, targets, own):
        for at in np.flatnonzero(o):
            before[int(row[at])] = int((x[: at + 1] != 999).sum())
    assert all(before[i] >= min(i - (100 if i >= 100 else 0), 16) for i in range(300))


def test_gradient():
    rng = np.random.default_rng(1)
    net = attention.Attention.new(np.ones(200), rng)
    for x in attention.TRAINED:
        setattr(net, x, getattr(net, x).astype(np.float64))
    ids, target, weight = rng.integers(0, 200, (3, 9)), rng.integers(0, 200, (3, 9)), rng.random((3, 9))
    _, grad = net.step(ids, target, weight)
    for x in attention.TRAINED:
        own = getattr(net, x)
        at = tuple(rng.integers(0, n) for n in own.shape) if x != "e" else (net.row[ids[0, 0]], 3)
        if x == "p":
            at = (2, 5)
        old, step, losses = own[at], 1e-4, []
        for d in (step, -step):
            own[at] = old + d
            losses.append(net.step(ids, target, weight)[0])
        own[at] = old
        assert grad[x][at] == pytest.approx((losses[0] - losses[1]) / (2 * step), rel=2e-2, abs=2e-5), x


def test_windows_come_from_the_whole_text():
    text = "word " * 4000
    places = [at for at, _ in _stretches(text, 7)]
    assert len(places) == math.ceil(len(text) / STRETCH) and max(places) > len(text) - 2 * STRETCH and places != [at for at, _ in _stretches(text, 8)]


def test_order_of_rows_makes_no_difference(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    a = {r.doc_id: r for r in llm.queries()["op1_lm_scoring"](spark, sf).collect()}
    b = {r.doc_id: r for r in score(docs.orderBy(docs.doc_id.desc()).repartition(5), PATH).collect()}
    assert all(a[k].score == pytest.approx(b[k].score, rel=1e-5) for k in a)
    taught = [r for r in a.values() if not r.held_out]
    assert sum(r.score for r in taught) > sum(r.base_score for r in taught)


def test_every_id_is_learnt_from_once():
    ids, starts = np.arange(300), np.array([0, 0, 1, 100, 132, 300])
    rows, text = attention.whole_windows(ids, starts, 999)
    assert sorted(rows[:, 1:][rows[:, 1:] >= 0].tolist()) == ids.tolist()
    for row, t in zip(rows, text):
        own = row[1:][row[1:] >= 0]
        assert (np.diff(own) == 1).all() and starts[t] <= own[0] and own[-1] < starts[t + 1]
        assert row[0] == (999 if own[0] == starts[t] else own[0] - 1)
    assert len(attention.whole_windows(ids[:0], np.array([0]), 999)[0]) == 0


def test_training_goes_over_all_documents(spark, monkeypatch):
    """The rounds' windows and the mixture's texts are those of all training documents, in full, however long they are."""
    from corpusmill.llm import lm_scoring

    bpe = tokenizer(PATH)
    texts = ["one two three four five six seven " * (400 if i % 9 == 0 else 1 + i) for i in range(60)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    learn = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 != 2]
    n = {i: sum(len(bpe.plain(" " + w)) for w in (texts[i] or "").split()) + 1 for i in learn}
    seen, summed = [], lm_scoring._summed
    monkeypatch.setattr(lm_scoring, "_summed", lambda *a: seen.append(summed(*a)) or seen[-1])
    monkeypatch.setattr(lm_scoring, "SEED_DOCS", 20)
    score(docs, PATH).count()
    masses, mixture, *rounds = seen
    assert masses[0].sum() == sum(n.values())
    assert sum(r[0][-1] for r in rounds) == sum(-(-x // attention.WINDOW) for x in n.values())
    assert mixture[0][: attention.COMPONENTS].sum() == pytest.approx(sum(x >= 20 for x in n.values()))


def test_uneven_groups_go_over_their_windows_once(spark, monkeypatch):
    """Groups hold as many windows as their least steps take, and a quarter more: one that is a little short would go over all twice."""
    from corpusmill.llm import lm_scoring

    assert lm_scoring.GROUP_WINDOWS >= 1.25 * attention.STEPS * attention.ROUND_BATCH
    groups, summed = [], lm_scoring._summed
    monkeypatch.setattr(lm_scoring, "_summed", lambda parts, n: groups.append(parts.select("pid").distinct().count()) or summed(parts, n))
    monkeypatch.setattr(lm_scoring, "GROUP_WINDOWS", 20)
    # 32 texts of about 43 ids: about 43 windows, of which a round has half, a little more than a group's
    docs = spark.createDataFrame([(i, f"w{i} " + "one two three four " * 10) for i in range(50) if zlib.crc32(str(i).encode()) % 7 != 2][:32], "doc_id long, text string")
    score(docs, PATH).count()
    assert groups[-lm_scoring.ROUNDS :] == [1] * lm_scoring.ROUNDS


def test_gradient_over_portions_and_large_logits():
    """Portions of windows add up, and logits beyond the range of 32-bit exponentials change nothing."""
    rng = np.random.default_rng(4)
    net = attention.Attention.new(np.arange(200.0), rng)
    shape = 2 * attention.STEPPED + 3, 9
    ids, target, weight = rng.integers(0, 200, shape), rng.integers(0, 200, shape), rng.random(shape)
    for raised in (0, 150, -150):
        for far in (0, raised):
            net.b[:] += np.float32(far)
            loss, grad = net.step(ids, target, weight)
            logits = net.forward(ids)["logits"].astype(float)
            p = np.exp(logits - logits.max(-1, keepdims=True))
            p /= p.sum(-1, keepdims=True)
            own = np.take_along_axis(p, net.cls[target][..., None], -1)[..., 0]
            assert loss == pytest.approx(-(np.log(own + 1e-12) * weight).sum() / weight.sum(), rel=1e-4)
            g = p * weight[..., None]
            np.put_along_axis(g, net.cls[target][..., None], ((own - 1) * weight)[..., None], -1)
            assert np.allclose(grad["b"], g.sum((0, 1)) / weight.sum(), atol=1e-6)
            found, _ = net.log_prob(ids, target, np.ones(attention.CLASSES))
            assert np.allclose(found, np.log(np.maximum(own, 1e-300)).ravel(), rtol=1e-4, atol=1e-3)
            net.b[:] -= np.float32(far)
        net.u[:] *= 30  # logits far apart within a row


def test_the_table_of_ids_holds_every_training_text(spark):
    """The table of ids, from which the mixture and both rounds learn, has each training row's ids once."""
    from corpusmill.llm import lm_scoring

    bpe = tokenizer(PATH)
    texts = ["one two  three", "", None, "a" * 5000, "x y " * 3000, "x y " * 3000]
    rows = spark.createDataFrame([(i, t, i != 3) for i, t in enumerate(texts)], "doc_id long, text string, learn boolean")
    got = sorted(lm_scoring._held([r.ids])[0].tolist() for r in lm_scoring._encoded(rows, PATH).collect())
    assert got == sorted([x for w in (t or "").split() for x in bpe.plain(" " + w)] + [END] for i, t in enumerate(texts) if i != 3)


def test_words_are_dealt_by_their_bytes():
    from corpusmill.llm.lm_scoring import hashed

    words = ["a", "b", "ab", "ba", "中文", "\x00", "\x00\x00", "x" * 70_000, *(f"w{i}" for i in range(20_000))]
    each = hashed(pa.array(words))
    assert len(set(each.tolist())) > len(words) - 10
    assert (hashed(pa.array(words[::-1], pa.large_string()))[::-1] == each).all() and (hashed(pa.array(words).slice(3, 50)) == each[3:53]).all()
    assert np.bincount(each % 12).max() < 1.1 * len(words) / 12
    assert len(hashed(pa.array([], pa.string()))) == 0

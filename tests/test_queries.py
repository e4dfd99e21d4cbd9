"""Every query against its SQL; those without SQL against plain Python."""

import hashlib
import json
from collections import Counter

import pytest
from oracle import connect, same

from corpusmill.functions import patterns as P
from corpusmill.plans import queries as own


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.fixture(scope="module")
def docs(con):
    return con.sql("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


def got(spark, sf, name):
    return own.queries()[name](spark, sf).collect()


@pytest.mark.parametrize("name", sorted(own.oracle_sql()))
def test_equals_sql(spark, sf, con, name):
    same(own.queries()[name](spark, sf), con, own.oracle_sql()[name])


def test_every_query_is_tested():
    assert set(own.queries()) - set(own.oracle_sql()) == {f.__name__ for f in own.NO_SQL} == {n[5:] for n in globals() if n[:5] == "test_" and n[5:] in own.queries()}


def shingles(text):
    w = text.split()
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 6 else set()


def test_min_hash_signatures(spark, sf, docs):
    want = {}
    for k, text, *_ in docs:
        if s := shingles(text):
            least = [min(int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8, key=r.to_bytes(4, "little")).digest(), "little") for x in s) for r in range(P.LSH_ROWS)]
            want[k] = ",".join(f"{n:016x}" for n in least)
    assert {r.doc_id: r.signature for r in got(spark, sf, "min_hash_signatures")} == want


def test_holdout_blake2b(spark, sf, docs):
    held = lambda k: int.from_bytes(hashlib.blake2b(f"42:{k}".encode(), digest_size=8).digest(), "big") % 10_000 < 200
    assert {r.doc_id: r.held for r in got(spark, sf, "holdout_blake2b")} == {k: held(k) for k, *_ in docs}


def test_anchors_blake2b(spark, sf, docs):
    want = Counter()
    for k, text, lang, _ in docs:
        if lang not in ("es", "de"):
            fields = [text.strip(), "Adult", P.MULTI_SPEAKER if k % 7 == 0 else "Male", f" {lang.upper()}", str(k % 7 == 0)]
            want[hashlib.blake2b("\n".join(fields).encode(), digest_size=16).hexdigest(), fields[3]] += 1
    assert Counter((r.anchor, r.speaker_dialect) for r in got(spark, sf, "anchors_blake2b")) == want


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_turn_error_rates(spark, sf, con):
    pairs = con.sql(f'SELECT "user", assistant FROM {own._PAIRS} p').fetchall()
    r = got(spark, sf, "turn_error_rates")[0]
    chars, words = sum(len(a) for a, _ in pairs), sum(len(a.split()) for a, _ in pairs)
    errors, wrong = sum(distance(a, b) for a, b in pairs), sum(distance(a.split(), b.split()) for a, b in pairs)
    assert (r.char_errors, r.chars, r.word_errors, r.words) == (errors, chars, wrong, words)
    assert (r.cer, r.wer) == (pytest.approx(errors / chars), pytest.approx(wrong / words))


def test_purge_report(spark, sf, docs):
    import re

    drift = re.compile(r"(^|\s)(with|avec|mit|para)(\s|[.,!?]|$)")
    clean = [t for _, t, *_ in docs if not drift.search(t)]
    seen, kept = set(), []
    for t in clean:
        key = " ".join(t.split())
        if key not in seen:
            seen.add(key)
            s = shingles(t)
            if not s or not any(len(s & o) / len(s | o) >= P.JACCARD for o in kept):
                kept.append(s)
    r = got(spark, sf, "purge_report")[0]
    assert (r.total, r.drift, r.exact, r.near, r.purged, r.kept) == (len(docs), len(docs) - len(clean), len(clean) - len(seen), len(seen) - len(kept), len(docs) - len(kept), len(kept))


def test_distill_canned(spark, sf):
    from corpusmill.sources import corpus

    seen, want = set(), {}
    for i, r in enumerate(corpus.metadata_fixture(spark).collect()):
        several = P.MULTI_SPEAKER in (r.speaker_age, r.speaker_gender, r.speaker_dialect)
        if (several or r.speaker_dialect in ("Najdi", "Hijazi")) and r.text not in seen:
            seen.add(r.text)
            want[i] = (r.text, f"{r.text} طيب", "hijazi" if r.speaker_dialect == "Hijazi" else "najdi")
    assert {r.seq: (r.user, r.assistant, r.dialect) for r in got(spark, sf, "distill_canned")} == want and want


def test_tokenizer_metrics(spark, sf, docs):
    import unicodedata

    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        bpe = Tokenizer.from_str(json.dumps(json.load(f)))
    texts = {k: unicodedata.normalize("NFC", t) for k, t, *_ in docs}
    texts = {k: " ".join("".join(c for c in t if c in " \t\n\r\f\v" or unicodedata.category(c) != "Cc").split()) for k, t in texts.items()}
    ids = {k: bpe.encode(t, add_special_tokens=False).ids for k, t in texts.items() if t}
    token = {i: t for t, i in bpe.get_vocab().items()}
    counts = Counter(i for x in ids.values() for i in x)
    rare, size = sum(n < 50 for n in counts.values()), bpe.get_vocab_size()
    held = [k for k in ids if int.from_bytes(hashlib.blake2b(f"42:{k}".encode(), digest_size=8).digest(), "big") % 10_000 < 200]
    own_ids = [i for k in held for i in ids[k]]
    words = sum(len(texts[k].split()) for k in held)
    single = sum(len(token[i]) == 1 and not token[i].isspace() and token[i] not in P.CLITICS for i in own_ids)
    r = got(spark, sf, "tokenizer_metrics")[0]
    assert (r.vocab_size, r.lines, r.words, r.content_tokens, r.rare_tokens) == (size, len(held), words, len(own_ids), rare)
    share = lambda a, b: a / b if b else 0.0
    assert r.fertility == pytest.approx(share(len(own_ids), words)) and r.r_char == pytest.approx(100 * share(single, len(own_ids)))
    assert r.l_avg == pytest.approx(share(sum(len(token[i]) for i in own_ids), len(own_ids))) and r.dead_pct == pytest.approx(100 * rare / size)
    assert r.unused_pct == pytest.approx(100 * (size - len(counts)) / size) and r.morph_f1 is None

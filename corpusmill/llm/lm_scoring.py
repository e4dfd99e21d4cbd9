"""Scores of texts by a causal self-attention model over subword ids whose word shares come from the whole corpus.

First, words are counted over all training documents. Documents are dealt in blocks; each block sends its distinct
words, parted by hash, and gets back their corpus counts and subwords, so a word that stands in every document is a row per
block. The same counts give those of all subwords.

The attention is trained in numpy on every id of every training document. Its classes come from a mixture of unigrams: a
bounded draw gives the point to start from, then come steps over all training documents, whose sums are exact. Its
weights start at random; then come rounds in which documents are dealt in groups by hash, each group goes over all windows of its
documents from the common weights, and the groups' weights are averaged by the windows they saw. Each document is
in one round. Nothing depends on the order of rows.

Then every block scores its texts in overlapping windows, each id once. A word w with subwords s1..sm, read after its
context, has the probability

    (L * P(class of s1) * count(w) / count(class of s1) + (1 - L) * P(s1) ... P(sm) * P(a word begins after sm)) / P(a word begins)

where P is the attention's, given all before: corpus counts share out the class that the attention predicts, and the
subwords spell words that the corpus does not have; a word ends where the next begins, so this is a distribution over words.
1 - L is the corpus's share of words that occur once (Good and Turing's estimate of unseen ones).
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm import attention
from corpusmill.llm.attention import WINDOW, Attention
from corpusmill.llm.common import forget, in_training, n_blocks, saved, short_batches
from corpusmill.llm.quality import _summed
from corpusmill.llm.tokens import gathered, tokenizer

#: Where the mixture's steps over all texts begin: so many training documents, and characters of each, in stretches of WINDOW_CHARS
#: from each STRETCH characters.
SEED_DOCS, SEED_CHARS, STRETCH, WINDOW_CHARS = 1200, 8000, 1280, 200
#: Steps of the mixture over all training documents, and the texts whose bags are held at a time.
MIXTURE_STEPS, BAGS = 1, 64
#: Windows that a group has at least, where there are so many, and rounds. A quarter more than a group's least steps take: else
#: uneven groups that just miss them would go over all their windows twice.
GROUP_WINDOWS, ROUNDS = attention.STEPS * attention.ROUND_BATCH * 5 // 4, 2
#: Bytes of text that a block scores at a time.
SCORED_BYTES = 3 << 20
#: Bytes of text whose words a block counts at a time.
COUNTED_BYTES = 12 << 20
BLOCKS_PER_BUCKET = 4
END = 50256

_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])
_BACK = pa.schema([
    ("block", pa.int32()), ("bucket", pa.int32()), ("words", pa.binary()), ("counts", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary()),
    ("types", pa.int64()), ("once", pa.int64()), ("tokens", pa.int64()), ("subwords", pa.list_(pa.float64())),
])
_BACK_DDL = "block int, bucket int, words binary, counts binary, sizes binary, ids binary, types long, once long, tokens long, subwords array<double>"


class Words:
    """The words of texts: A-Z in lower case, parted at ASCII white space; each distinct word has a number."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        real = pc.greater(pc.binary_length(flat), 0)
        self.starts = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))][offsets - offsets[0]]
        coded = flat.filter(real).dictionary_encode()
        self.distinct, self.number = coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def subwords_of(words: pa.Array, bpe) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, begin, count): each word's ids, read after a space, as a stretch of one array."""
    size = pc.binary_length(words).to_numpy().astype(np.int64)
    odd = pc.binary_length(pc.utf8_trim_whitespace(words)).to_numpy() != size
    plain, alone = np.flatnonzero(~odd), np.flatnonzero(odd)
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), words.filter(pa.array(~odd)).cast(pa.string())), " ")[0].as_py()
    ids = np.array(bpe.plain(" " + text if len(plain) else ""), np.int64)
    ends = np.searchsorted(np.cumsum(bpe.sizes[ids]), np.cumsum(size[plain] + 1)) + 1
    begin, count = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    begin[plain], count[plain] = np.r_[0, ends[:-1]] if len(ends) else ends, np.diff(ends, prepend=0)
    texts = dict(zip(alone.tolist(), words.filter(pa.array(odd)).to_pylist()))
    parts, at = [ids], len(ids)
    for i in alone:  # words with other white space inside or at an end
        parts.append(np.array(bpe.plain(" " + texts[i]), np.int64))
        begin[i], count[i] = at, len(parts[-1])
        at += count[i]
    return np.concatenate(parts), begin, count


@functools.lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number, and of what undoes it, in 32 bits."""
    made = []
    for x in (0x01000193, pow(0x01000193, -1, 1 << 32)):
        row = np.full(1 << bits, x, np.uint32)
        row[0] = 1
        made.append(np.cumprod(row, dtype=np.uint32, out=row))
    return made[0], made[1]


def hashed(words: pa.Array) -> np.ndarray:
    """A number of 31 bits for each word, by its bytes alone, to deal words out by."""
    words = words.cast(pa.large_binary())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    first, n = int(at[0]), int(at[-1] - at[0])
    data = np.frombuffer(words.buffers()[2], np.uint8)[first : first + n] if n else np.zeros(0, np.uint8)
    # a polynomial of a word's bytes is a difference of two sums over all, divided by the power at which it begins
    power, back = _powers(max(n, 1 << 20).bit_length())
    sums = np.zeros(n + 1, np.uint32)
    np.cumsum((data + np.uint32(1)) * power[:n], out=sums[1:])
    out = (sums[at[1:] - first] - sums[at[:-1] - first]) * back[at[:-1] - first]
    for by in (0x85EBCA6B, 0xC2B2AE35):
        out = (out ^ out >> np.uint32(15)) * np.uint32(by)
    return (out >> np.uint32(1)).astype(np.int64)


def stretched(ids: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches ``ids[begin : begin + count]`` one after the other."""
    at = np.cumsum(count) - count
    return ids[np.arange(int(count.sum())) + np.repeat(begin - at, count)] if len(count) else np.zeros(0, np.int64)


class Corpus:
    """What scoring needs of the training words: the masses of subwords, and the share of words that occur once."""

    def __init__(self, masses: np.ndarray, starters: np.ndarray, once: int, tokens: int):
        self.masses, self.starters = masses, starters
        self.unseen = (once + 1) / (tokens + 2)

    def begins(self, model: Attention) -> np.ndarray:
        """The share of each class that begins a word, or ends the text."""
        whole = np.bincount(model.cls, self.masses, minlength=attention.CLASSES)
        return np.bincount(model.cls, self.masses * self.starters, minlength=attention.CLASSES) / np.maximum(whole, 1e-300)


def scores(model: Attention, corpus: Corpus, starts: np.ndarray, number: np.ndarray, counts: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """log10-probability of each text with its end.

    Texts are words by ``number``, those of text i at starts[i] : starts[i + 1]; words have corpus ``counts`` and ids.
    """
    n = np.diff(starts) + 1
    last = np.cumsum(n) - 1
    each = np.empty(int(n.sum()), np.int64)
    is_word = np.ones(len(each), bool)
    is_word[last] = False
    each[is_word], each[last] = number, len(counts)
    ids, begin, size = np.r_[ids, END], np.r_[begin, len(ids)], np.r_[size, 1]
    length = size[each]
    at = np.cumsum(length) - length
    stream = stretched(ids, begin[each], length)
    cls, begins = model.score(stream, np.r_[0, np.cumsum(length)[last]], END, corpus.begins(model))
    whole = np.bincount(model.cls, corpus.masses, minlength=attention.CLASSES)
    with np.errstate(divide="ignore"):
        seen = cls[at] + np.log(np.r_[counts, 0.0])[each] - np.log(whole)[model.cls[stream[at]]] + np.log1p(-corpus.unseen)
    spelled = np.add.reduceat(cls + model.log_share[stream], at) + np.log(corpus.unseen)
    after = np.r_[begins[at[1:]], 0.0]
    after[last] = 0.0
    word = np.logaddexp(seen, spelled + after)
    # the end is one event, by its class and share
    word[last] = cls[at[last]] + model.log_share[END]
    return np.add.reduceat(word - begins[at], np.r_[0, last[:-1] + 1]) / np.log(10.0)


def score(docs: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text", modulus: int = 7, held: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Tokens are words between ASCII white space, A-Z in lower case, then one end. Learns from all rows whose
    crc32(doc_id) mod ``modulus`` is not ``held`` (a null id reads as ''). Null and empty texts are an end alone. Repeated
    rows count and are scored each. With no training rows nothing is known and the attention stays untrained.
    """
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), in_training(doc_id, modulus, held).alias("learn"))
    n = n_blocks(docs)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCKS_PER_BUCKET))
    # repeated rows are no hot block: their places in the scan differ; no result depends on them
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.monotonically_increasing_id()), F.lit(n)).cast("int")).repartition(n, "block")

    def counted(t: pa.Table) -> pa.Table:
        words, counts = [], []
        for texts, learn in _portions(t, COUNTED_BYTES):
            w = Words(texts)
            words.append(w.distinct)
            counts.append(np.bincount(w.number, np.repeat(learn, np.diff(w.starts)), minlength=len(w.distinct)))
        seen = pa.concat_arrays(words).dictionary_encode()
        total = np.bincount(seen.indices.to_numpy(), np.concatenate(counts), minlength=len(seen.dictionary)).astype(np.int64)
        bucket = hashed(seen.dictionary) % buckets
        order = np.argsort(bucket, kind="stable")
        used, first = np.unique(bucket[order], return_index=True)
        cuts = np.r_[first, len(order)]
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), seen.dictionary.take(pa.array(order)).cast(pa.string()))
        block, total = t.column("block")[0].as_py(), total[order]
        return pa.table({"bucket": pa.array(used, pa.int32()), "block": pa.array([block] * len(used), pa.int32()), "words": pc.binary_join(lists, " ").cast(pa.binary()), "counts": pa.array([total[a:z].tobytes() for a, z in zip(cuts[:-1], cuts[1:])], pa.binary())}, schema=_SENT)

    def totalled(t: pa.Table) -> pa.Table:
        lists = pc.split_pattern(t.column("words").cast(pa.large_string()).combine_chunks(), " ")
        cuts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        seen = lists.flatten().dictionary_encode()
        own = seen.indices.to_numpy()
        total = np.bincount(own, np.frombuffer(b"".join(t.column("counts").to_pylist()), np.int64), minlength=len(seen.dictionary)).astype(np.int64)
        bpe = tokenizer(tokenizer_path)
        ids, begin, size = subwords_of(seen.dictionary, bpe)
        bucket = t.column("bucket")[0].as_py()
        back = []
        for block, words, a, z in zip(t.column("block").to_pylist(), t.column("words").to_pylist(), cuts[:-1], cuts[1:]):
            at = own[a:z]
            back.append({"block": block, "bucket": bucket, "words": words, "counts": total[at].tobytes(), "sizes": size[at].astype("<u4").tobytes(), "ids": stretched(ids, begin[at], size[at]).astype("<u2").tobytes()})
        sub = np.bincount(stretched(ids, begin, size), np.repeat(total, size), minlength=END + 1)
        back.append({"block": -1, "bucket": bucket, "types": int((total > 0).sum()), "once": int((total == 1).sum()), "tokens": int(total.sum()), "subwords": sub})
        return pa.Table.from_pylist(back, schema=_BACK)

    back = dealt.groupBy("block").applyInArrow(counted, "bucket int, block int, words binary, counts binary")
    back = saved(back.groupBy("bucket").applyInArrow(totalled, _BACK_DDL))
    sums = back.where("block = -1")
    types, once, tokens = (int(x or 0) for x in sums.agg(F.sum("types"), F.sum("once"), F.sum("tokens")).first())
    n_rows, ends = (int(x or 0) for x in rows.agg(F.count("*"), F.sum(F.col("learn").cast("long"))).first())
    types, tokens = types + (ends > 0), tokens + ends
    masses = _summed(sums.select(F.lit(0).alias("i"), F.col("bucket").cast("long").alias("pid"), F.col("subwords").alias("v")), END + 1)
    masses = masses[0] if len(masses) else np.zeros(END + 1)
    masses[END] = ends
    bpe = tokenizer(tokenizer_path)
    corpus = Corpus(masses + 0.5, bpe.begin_with_space(END + 1) | (np.arange(END + 1) == END), once, tokens)
    encoded = _encoded(rows, tokenizer_path)
    model = _trained(encoded, masses, _mixture(rows, encoded, tokenizer_path, masses, n_rows))
    forget(encoded)
    # a model of fixed size
    shared = spark.sparkContext.broadcast((model.dumps(), corpus))
    floor = math.log10(tokens + types + 1)

    def scored(t: pa.Table, back: pa.Table) -> pa.Table:
        if not t.num_rows:
            return pa.table({k: pa.array([], v) for k, v in (("doc_id", t.schema.field("doc_id").type), ("held_out", pa.bool_()), *((c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")), ("base_score", pa.float64()), ("score", pa.float64()))})
        net, corpus = Attention.loads(shared.value[0]), shared.value[1]
        known = pc.split_pattern(pa.array([b" ".join(back.column("words").to_pylist()).decode()], pa.large_string()), " ").flatten()
        joined = lambda c, kind: np.frombuffer(b"".join(back.column(c).to_pylist()), kind).astype(np.int64)
        count, size, ids = joined("counts", np.int64), joined("sizes", "<u4"), joined("ids", "<u2")
        begin = np.cumsum(size) - size
        n_tokens, n_known, base, score = [], [], [], []
        for texts, _ in _portions(t):
            w = Words(texts)
            own = pc.index_in(w.distinct.cast(pa.large_string()), value_set=known).to_numpy()
            c = count[own]
            each = c[w.number]
            sums = lambda v: np.diff(np.r_[0, np.cumsum(v)][w.starts])  # noqa: E731, B023
            n_tokens.append(np.diff(w.starts) + 1)
            n_known.append(sums(each > 0) + (ends > 0))
            base.append(sums(np.log10(c + 1.0)[w.number] - floor) + np.log10(ends + 1.0) - floor)
            score.append(scores(net, corpus, w.starts, w.number, c.astype(float), ids, begin[own], size[own]))
        held = pc.invert(t.column("learn"))
        columns = [np.concatenate(x) if x else np.zeros(0, d) for x, d in ((n_tokens, np.int64), (n_known, np.int64), (base, float), (score, float))]
        made = dict(zip(("n_tokens", "n_known", "base_score", "score"), map(pa.array, columns)))
        return pa.table({"doc_id": t.column("doc_id"), "held_out": held, "n_tokens": made["n_tokens"].cast(pa.int64()), "n_known": made["n_known"].cast(pa.int64()), "train_tokens": pa.array([tokens] * t.num_rows, pa.int64()), "base_score": made["base_score"], "score": made["score"]})

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    answers = back.where("block >= 0").select("block", "words", "counts", "sizes", "ids")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, out)


def _portions(t: pa.Table, most: int = SCORED_BYTES) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The texts, and whether each is learnt from, in portions of about ``most`` bytes."""
    texts = t.column("text").combine_chunks()
    learn = t.column("learn").to_numpy().astype(bool)
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
    cuts = np.unique(np.r_[0, np.searchsorted(size, np.arange(most, size[-1], most)) + 1, len(learn)]) if len(learn) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield texts.slice(int(a), int(b - a)), learn[a:b]


def _streamed(texts: pa.Array, bpe) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts, each with its end, and where each text's begin (one more for the last's end)."""
    words = Words(texts)
    ids, begin, size = subwords_of(words.distinct, bpe)
    ends = np.r_[0, np.cumsum(size[words.number])][words.starts]
    return np.insert(stretched(ids, begin[words.number], size[words.number]), ends[1:], END), ends + np.arange(len(ends))


def _mixture(rows: DataFrame, encoded: DataFrame, path: str, masses: np.ndarray, n_rows: int) -> np.ndarray | None:
    """The component of each subword, by a mixture over all training texts.

    It starts from one fitted to stretches of the SEED_DOCS texts of the least hashes; None without enough texts.
    """
    spark = rows.sparkSession
    h = F.xxhash64(F.lit("lm"), F.col("doc_id").cast("string"), "text")
    taught = rows.where("learn and text is not null").withColumn("h", h)
    near = taught.where(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * SEED_DOCS / max(1, n_rows)) + 64))
    drawn = near.select("h", F.pmod("h", F.lit(1 << 30)).alias("order"), "text").mapInArrow(_seeds, "h long, order long, part string")
    texts = [r.part for r in drawn.orderBy("order", "h", "part").limit(SEED_DOCS).collect()]
    stream, starts = _streamed(pa.array(texts, pa.string()), tokenizer(path))
    found = attention.seeded(masses, [stream[a:z] for a, z in zip(starts[:-1], starts[1:])])
    for _ in range(MIXTURE_STEPS if found else 0):
        shared = spark.sparkContext.broadcast((*found, attention.known_of(masses)))  # of fixed size
        sums = _summed(encoded.select("ids").mapInArrow(_bagged(shared, len(masses)), "i int, pid long, v array<double>"), 1)
        if len(sums):
            v = sums[0]
            found = attention.updated(v[: attention.COMPONENTS], v[attention.COMPONENTS :].reshape(attention.COMPONENTS, -1))
    return attention.components_of(masses, *found) if found else None


def _stretches(text: str, h: int) -> Iterator[tuple[int, str]]:
    """(place, characters) of a text's stretches: one from each STRETCH characters, from hashed places, at words' begins."""
    for k in range(max(1, math.ceil(len(text) / STRETCH))):
        room = max(1, min(STRETCH, len(text) - k * STRETCH) - WINDOW_CHARS // 2)
        at = k * STRETCH + zlib.crc32(f"{h}:{k}".encode()) % room
        while 0 < at < len(text) and not text[at - 1].isspace():
            at += 1
        yield at, text[at : at + WINDOW_CHARS]


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        parts = [" ".join(x for _, x in _stretches(t, h))[:SEED_CHARS] for h, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(parts, pa.string())], names=["h", "order", "part"])


def _bagged(shared, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of an expectation step over a partition's texts."""
        attention.one_blas_thread()
        (phi, weight, known), sums = shared.value, None
        for b in batches:
            stream, starts = _held(b.column(0).to_pylist())
            for lo in range(0, len(starts) - 1, BAGS):
                own = starts[lo : lo + BAGS + 1]
                x = attention.bags_of([stream[a:z] for a, z in zip(own[:-1], own[1:])], known, size)
                if len(x):
                    now = np.concatenate([v.ravel().astype(float) for v in attention.shared_out(x, phi, weight)])
                    sums = now if sums is None else sums + now
        if sums is not None:
            from pyspark import TaskContext

            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([sums], pa.list_(pa.float64()))], names=["i", "pid", "v"])

    return run


def _encoded(rows: DataFrame, path: str) -> DataFrame:
    """(h, h2, ids) of each training document, written: all its ids with its end, in two bytes each, under two hashes of the row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for b in gathered(batches, "text"):
            stream, starts = _streamed(b.column(2), bpe)
            stream = stream.astype("<u2")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([stream[a:z].tobytes() for a, z in zip(starts[:-1], starts[1:])], pa.binary())], names=["h", "h2", "ids"])

    text = F.coalesce("text", F.lit(""))
    taught = rows.where("learn").select(F.xxhash64(F.col("doc_id").cast("string"), text).alias("h"), F.hash(text, F.col("doc_id").cast("string")).alias("h2"), text.alias("text"))
    return saved(taught.mapInArrow(run, "h long, h2 int, ids binary"), compression="zstd")


def _held(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts, of two bytes each, in one array, and where each text's begin (one more for the last's end)."""
    return np.frombuffer(b"".join(texts), "<u2").astype(np.int64), np.cumsum([0, *(len(x) // 2 for x in texts)])


def _learnt(shared, k: int):
    def run(t: pa.Table) -> pa.Table:
        """The weights, times the windows seen, of the model after a group's windows of round ``k``; the windows' number comes last."""
        net = Attention.loads(shared.value)
        # in an order of their own: a task that runs again learns alike
        own = sorted(zip(t.column("ids").to_pylist(), t.column("n").to_pylist()))
        group = t.column("g")[0].as_py()
        windows, text = attention.whole_windows(*_held([r for r, _ in own]), END)
        rate = attention.ROUND_RATE if k else attention.RATE
        attention.trained_on(net, windows, np.array([x for _, x in own], float)[text], 1000 * k + group, rate, attention.STEPS)
        flat = np.concatenate([getattr(net, x).ravel() for x in attention.TRAINED]).astype(float) * len(windows)
        return pa.table({"i": pa.array([0], pa.int32()), "pid": pa.array([group], pa.int64()), "v": pa.array([np.r_[flat, len(windows)]], pa.list_(pa.float64()))})

    return run


def groups_of(ids: float) -> int:
    """The groups of a round, where all rounds have so many ids."""
    return max(1, int(ids / WINDOW / ROUNDS / GROUP_WINDOWS))


def _trained(encoded: DataFrame, masses: np.ndarray, component: np.ndarray | None) -> Attention:
    """The model after ROUNDS rounds, which go over all ids of all training documents. Rows that are equal are one text with a weight."""
    spark = encoded.sparkSession
    model = Attention.new(masses, np.random.default_rng(attention.SEED), component)
    if not masses.sum():
        model.u[:] = 0
        return model
    groups = groups_of(masses.sum())
    spaces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(4 * groups, 4096))
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model.dumps())  # of fixed size
        mine = encoded.where(F.pmod("h", F.lit(ROUNDS)) == k).select(F.pmod(F.shiftright("h", 8), F.lit(groups)).cast("long").alias("g"), "h", "h2", "ids")
        texts = mine.repartition(spaces, "g").groupBy("g", "h", "h2").agg(F.first("ids").alias("ids"), F.count("*").alias("n"))
        summed = _summed(texts.groupBy("g").applyInArrow(_learnt(shared, k), "i int, pid long, v array<double>"), 1)
        if len(summed):
            flat, at = summed[0][:-1] / summed[0][-1], 0
            for x in attention.TRAINED:
                own = getattr(model, x)
                own[...] = flat[at : at + own.size].reshape(own.shape)
                at += own.size
    return model

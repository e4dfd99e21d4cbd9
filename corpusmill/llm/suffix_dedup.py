"""Removal of byte strings that occur again, by a sparse suffix array over the whole corpus.

Every byte that is covered by a string of ``LENGTH`` bytes that also starts elsewhere goes. Suffixes are ordered by their
leading tokens: the first token of a suffix is its first 8 bytes, read as a big-endian number, so the order is that of
the bytes; the second, by which only suffixes of equal first tokens are ordered, is the 64-bit fingerprint of all
``LENGTH`` bytes.

Not every suffix has to be ordered. Each window of ``LENGTH`` bytes has an anchor: its least ``GRAM``-byte string by
hash, which equal windows share. A first round goes through anchors only, by fingerprints of their own bytes (a window
whose anchor occurs once occurs once) and of all bytes of the windows that share the anchor (if those occur again with
the anchor in the same place, so do all these windows). The second round orders the suffixes that are still open, which
are those near the ends of repeated stretches, beside one representative of each settled stretch that has the anchor
of an open one.

Each round: splitters, sampled from texts, range-partition the keys; buckets sort by multikey quicksort, and equal
neighbours count as repeated. Splitters of suffixes are suffixes themselves, often the most frequent. Of a suffix that
equals a splitter one half of the blocks sends its copies to the bucket below, the other half to the bucket above, and
each asks the other bucket too: what stands on both sides of a boundary is compared by adding the two counts. Documents are
dealt in blocks; a block sends each distinct suffix of a portion once, with its count, so a string that very many
documents share is a row per block. Blocks send no more messages than suffixes, whatever the number of buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.common import n_blocks, short_batches

LENGTH = 200
GRAM = 40
#: Bytes that are hashed at a time; longer texts are cut with an overlap.
CHUNK = 1 << 18
#: Stored bytes of a block's documents, which a task holds in memory; blocks to a bucket.
BLOCK_BYTES, BLOCKS_PER_BUCKET = 4 << 20, 4
#: Open suffixes that a block has in memory at a time, about.
PORTION = 400_000
LEAD = 8

_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    value = rng.integers(1, 2**63, 256, dtype=np.uint64)
    inverse = pow(_BASE, -1, 2**64)
    power, back = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    power[0] = back[0] = 1
    return value, np.multiply.accumulate(power), np.multiply.accumulate(back)


class Hasher:
    """Fingerprints of all substrings of a chunk of bytes in constant time each."""

    tables = None

    def __init__(self, data: np.ndarray):
        if Hasher.tables is None:
            Hasher.tables = _tables(2 * CHUNK + 4 * LENGTH)
        value, power, self.back = Hasher.tables
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value[data] * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:-length]) * self.back[:n])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Chunk:
    """Part of a document: its windows, runs of windows with one anchor, and the keys of each run."""

    def __init__(self, data: np.ndarray):
        self.windows = len(data) - LENGTH + 1
        self.hash = Hasher(data)
        w = LENGTH - GRAM + 1
        low = np.uint64((1 << 21) - 1)
        gram = self.hash.all(GRAM)
        least = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
        span = 1
        while span * 2 <= w:
            least = np.minimum(least[: len(least) - span], least[span:])
            span *= 2
        if span < w:
            least = np.minimum(least[: self.windows], least[w - span : w - span + self.windows])
        anchor = (least[: self.windows] & low).astype(np.int64)
        self.first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        self.last = np.r_[self.first[1:], self.windows] - 1
        at = anchor[self.first]
        self.gram = gram[at]
        place = (at - self.first).astype(np.uint64) * np.uint64(LENGTH * 4) + (self.last - self.first).astype(np.uint64)
        self.whole = _mixed(self.hash.of(self.first, self.last + LENGTH) + place * _M1 + np.uint64(1))

    @staticmethod
    def tokens(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two tokens of the windows at ``start``: the first bytes as a number, the fingerprint of all."""
        lead = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, LEAD)[start]).view(">u8").ravel()
        return lead.astype(np.uint64), Hasher(data).of(start, start + LENGTH)


def chunks(raw: bytes) -> Iterator[tuple[int, Chunk]]:
    """(offset, chunk) such that every window of the text starts in exactly one chunk."""
    data = np.frombuffer(raw, np.uint8)
    for at in range(0, len(data) - LENGTH + 1, CHUNK):
        yield at, Chunk(data[at : at + CHUNK + LENGTH - 1])


class Runs:
    """The runs of windows with one anchor of several texts, as flat arrays; texts shorter than a window have none."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        doc, off, first, last, gram, whole = [], [], [], [], [], []
        for i, raw in enumerate(texts):
            for start, c in chunks(raw):
                n = len(c.first)
                doc.append(np.full(n, i))
                off.append(np.full(n, start))
                for into, values in ((first, c.first), (last, c.last), (gram, c.gram), (whole, c.whole)):
                    into.append(values)
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.doc, self.off, self.first, self.last = (join(x, np.int64) for x in (doc, off, first, last))
        self.gram, self.whole = join(gram, np.uint64), join(whole, np.uint64)

    def suffixes(self, wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(text, window starts, first and second tokens) of the windows of the ``wanted`` runs, chunk by chunk."""
        if not wanted.any():
            return
        edges = np.flatnonzero(np.r_[True, (self.doc[1:] != self.doc[:-1]) | (self.off[1:] != self.off[:-1]), True])
        for a, b in zip(edges[:-1], edges[1:]):
            m = wanted[a:b]
            if not m.any():
                continue
            lo, n = self.first[a:b][m], (self.last[a:b] - self.first[a:b] + 1)[m]
            start = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            doc, off = int(self.doc[a]), int(self.off[a])
            data = np.frombuffer(self.texts[doc], np.uint8)[off : off + CHUNK + LENGTH - 1]
            t1, t2 = Chunk.tokens(data, start)
            yield doc, start + off, t1, t2


def _distinct(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a block's keys: one representative of each in order, how often it occurs here (1, or 2 for more), and each one's place."""
    order, _, new = multikey_order(first, second)
    place = np.empty(len(order), np.int64)
    group = np.cumsum(new) - 1
    place[order] = group
    return order[new], np.minimum(np.bincount(group, minlength=int(new.sum())), 2).astype(np.uint8), place


def multikey_order(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multikey quicksort by two tokens: (order, where a new first token begins, where a new pair begins).

    Suffixes are sorted by the first token; only those that tie are sorted by the second, each within its tie.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    f = first[order]
    new_first = np.r_[True, f[1:] != f[:-1]][:n]
    tied = ~(new_first & np.r_[new_first[1:], True][:n])
    rows = order[tied]
    order[tied] = rows[np.lexsort((second[rows], np.cumsum(new_first)[tied]))]
    s = second[order]
    return order, new_first, new_first | np.r_[True, s[1:] != s[:-1]][:n]


def _groups(new: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each row of an order, the sum of ``values`` over its group."""
    group = np.cumsum(new) - 1
    return np.bincount(group, values, minlength=int(new.sum()))[group].astype(np.int64) if len(new) else np.zeros(0, np.int64)


#: What a block learns of an anchor: once in the corpus; settled, as all its windows occur again; open; settled, and to be
#: sent as the representative of its kind. Of a suffix: how often it occurs in the bucket (2 for more).
_ONCE, _SETTLED, _OPEN, _SENDS = 0, 1, 2, 3


def judge_anchors(gram: np.ndarray, whole: np.ndarray, times: np.ndarray) -> np.ndarray:
    order, new_gram, new_pair = multikey_order(gram, whole)
    mixed = _groups(new_gram, new_pair.astype(np.int64)) > 1
    settled = _groups(new_pair, times[order].astype(np.int64)) > 1
    out = np.empty(len(order), np.uint8)
    out[order] = np.where(settled, np.where(mixed & new_pair, _SENDS, _SETTLED), np.where(mixed, _OPEN, _ONCE))
    return out


def judge_suffixes(first: np.ndarray, second: np.ndarray, times: np.ndarray) -> np.ndarray:
    order, _, new_pair = multikey_order(first, second)
    out = np.empty(len(order), np.uint8)
    out[order] = np.minimum(_groups(new_pair, times[order].astype(np.int64)), 2)
    return out


_SENT = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("part", pa.int32()), ("first", pa.binary()), ("second", pa.binary()), ("times", pa.binary())])
_SENT_DDL = "bucket int, block int, part int, first binary, second binary, times binary"
_BACK = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("bucket", pa.int32()), ("flags", pa.binary())])
_BACK_DDL = "block int, kind int, part int, bucket int, flags binary"
_ANCHOR, _SUFFIX = 0, 1


class Splitters:
    """Pairs of tokens in ascending order; bucket k holds what lies from splitter k - 1 to splitter k, both included."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second

    def ranges(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted keys: (where each bucket's begin, where they end). A key that equals a splitter is in two buckets."""
        lo, hi = (np.searchsorted(first, self.first, side=side) for side in ("left", "right"))
        left, right = lo.copy(), hi.copy()
        for k in np.flatnonzero(hi > lo):
            own = second[lo[k] : hi[k]]
            left[k], right[k] = lo[k] + np.searchsorted(own, self.second[k], "left"), lo[k] + np.searchsorted(own, self.second[k], "right")
        return np.r_[0, left], np.r_[right, len(first)]

    def holds(self, bucket: int, first: np.ndarray, second: np.ndarray) -> bool:
        """Whether all keys lie in the bucket's range."""
        ok = np.ones(len(first), bool)
        if bucket > 0:
            s, t = self.first[bucket - 1], self.second[bucket - 1]
            ok &= (first > s) | ((first == s) & (second >= t))
        if bucket < len(self.first):
            s, t = self.first[bucket], self.second[bucket]
            ok &= (first < s) | ((first == s) & (second <= t))
        return bool(ok.all())


def _sent(block: int, part: int, splitters: Splitters, first: np.ndarray, second: np.ndarray, times: np.ndarray) -> list[dict]:
    """A block's distinct keys, in order, cut at the splitters: those that equal one count on one side, and ask on the other."""
    begin, end = splitters.ranges(first, second)
    out = []
    for k in np.flatnonzero(end > begin).tolist():
        a, b = int(begin[k]), int(end[k])
        counted = times[a:b].copy()
        # blocks of even number count what equals a splitter above it, the others below it
        if k > 0 and end[k - 1] > a and block % 2:
            counted[0] = 0
        if k < len(splitters.first) and begin[k + 1] < b and not block % 2:
            counted[-1] = 0
        out.append({"bucket": k, "block": block, "part": part, "first": first[a:b].tobytes(), "second": second[a:b].tobytes(), "times": counted.tobytes()})
    return out


def _texts(t: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """A block's texts in the order of their places, which is the same in every pass, and the rows they come from."""
    order = np.argsort(t.column("place").to_numpy(), kind="stable")
    raw = t.column("raw").to_pylist()
    return [raw[i] or b"" for i in order], order


def _answers(back: dict[tuple[int, int], list[tuple[int, bytes]]], kind: int, part: int, splitters: Splitters, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The buckets' answers for a portion's distinct keys, in order; where two buckets answer, their sum."""
    begin, end = splitters.ranges(first, second)
    out, got = np.zeros(len(first), np.uint8), 0
    for bucket, flags in back.get((kind, part), ()):
        a, b = int(begin[bucket]), int(end[bucket])
        out[a:b] += np.frombuffer(flags, np.uint8)
        got += b - a
    if got != int(np.maximum(end - begin, 0).sum()):
        raise RuntimeError(f"a block got {got} answers for {len(first)} keys")
    return out


def _by_portion(back: pa.Table) -> dict[tuple[int, int], list[tuple[int, bytes]]]:
    out: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
    for kind, part, bucket, flags in zip(*(back.column(c).to_pylist() for c in ("kind", "part", "bucket", "flags"))):
        out.setdefault((kind, part), []).append((bucket, flags))
    return out


def _portions(runs: Runs, wanted: np.ndarray) -> Iterator[list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The windows of the ``wanted`` runs in portions of about PORTION."""
    held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    for x in runs.suffixes(wanted):
        held.append(x)
        if sum(len(h[1]) for h in held) >= PORTION:
            yield held
            held = []
    if held:
        yield held


def _splitters(rows: DataFrame, n: int, docs: int = 200, chars: int = 20_000) -> tuple[Splitters, Splitters]:
    """(of anchors, of suffixes): keys that part those of all texts into ``n`` ranges, from a bounded sample of texts.

    They balance the buckets and never decide what is found. One half of the suffixes' are quantiles of all windows, the
    other of those that are open within the sample, which stand for the frequent ones.
    """
    total = rows.count()
    drawn = rows.where(F.pmod(F.xxhash64("raw"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, docs / max(1, total)))).select(F.substring("raw", 1, chars).alias("raw"))
    runs = Runs([bytes(r.raw or b"") for r in drawn.limit(4 * docs).collect()])
    gram = np.sort(runs.gram)
    evenly = lambda m, size: (np.arange(1, m) * size) // m
    if len(gram) >= 40 * n:
        first = np.unique(gram[evenly(n, len(gram))])
    else:
        first = np.array([i * (2**64 // n) for i in range(1, n)], np.uint64)
    # of anchors only the first token parts, so that all of one anchor's meet
    anchors = Splitters(first, np.zeros(len(first), np.uint64))
    open_ = judge_anchors(runs.gram, runs.whole, np.ones(len(runs.gram), np.uint8)) >= _OPEN
    chosen = []
    for wanted, step, m in ((np.ones(len(open_), bool), 7, n - n // 2), (open_, 1, n // 2)):
        found = [(t1[::step].copy(), t2[::step].copy()) for _, _, t1, t2 in runs.suffixes(wanted)]
        if found and m > 1:
            t1, t2 = (np.concatenate([x[i] for x in found]) for i in (0, 1))
            pick = np.lexsort((t2, t1))[evenly(m, len(t1))]
            chosen.append(np.stack([t1[pick], t2[pick]], 1))
    both = np.unique(np.concatenate(chosen), axis=0) if chosen else np.zeros((0, 2), np.uint64)
    return anchors, Splitters(both[:, 0].copy(), both[:, 1].copy())


def repeated_bytes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (array of start, end: the maximal removed runs), kept (binary).

    Texts are UTF-8 bytes, null is empty; removed is each byte that a string of 200 bytes covers which also starts
    anywhere else, in the same text or another, as judged on the input. ``kept`` may cut a character. Repeated rows
    count as texts of their own and are dealt to blocks by their place in the scan, so an input without a stable
    order of rows should be a written table. Texts under 200 bytes stay whole. Ids may be null or repeat; an empty
    table gives no rows. Strings are told apart by their first 8 bytes and 64 bits of fingerprint.
    """
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8").alias("raw"))
    n = n_blocks(docs, BLOCK_BYTES)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCKS_PER_BUCKET))
    of_anchors, of_suffixes = _splitters(rows, buckets)
    # repeated rows are no hot block: their places differ
    place = F.xxhash64(F.col("doc_id").cast("string"), F.monotonically_increasing_id())
    dealt = rows.withColumn("place", place).withColumn("block", F.pmod("place", F.lit(n)).cast("int")).repartition(n, "block")

    def anchors(t: pa.Table) -> pa.Table:
        runs = Runs(_texts(t)[0])
        pick, times, _ = _distinct(runs.gram, runs.whole)
        return pa.Table.from_pylist(_sent(t.column("block")[0].as_py(), 0, of_anchors, runs.gram[pick], runs.whole[pick], times), schema=_SENT)

    def judged(kind: int):
        splitters, judge = ((of_anchors, judge_anchors), (of_suffixes, judge_suffixes))[kind]

        def run(t: pa.Table) -> pa.Table:
            t = t.sort_by([("block", "ascending"), ("part", "ascending")])  # the representative is that of the least block: a task that runs again answers alike
            first, second = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint64) for c in ("first", "second"))
            sizes = np.array([len(x) for x in t.column("times").to_pylist()])
            times = np.frombuffer(b"".join(t.column("times").to_pylist()), np.uint8)
            if not splitters.holds(t.column("bucket")[0].as_py(), first, second):
                raise RuntimeError("a key lies outside its bucket's range")
            flags = np.split(judge(first, second, times), np.cumsum(sizes)[:-1])
            kinds = pa.array(np.full(t.num_rows, kind), pa.int32())
            return pa.table([t.column("block"), kinds, t.column("part"), t.column("bucket"), pa.array([f.tobytes() for f in flags], pa.binary())], schema=_BACK)

        return run

    def decided(runs: Runs, back: dict) -> np.ndarray:
        pick, _, place = _distinct(runs.gram, runs.whole)
        return _answers(back, _ANCHOR, 0, of_anchors, runs.gram[pick], runs.whole[pick])[place]

    def suffixes(t: pa.Table, back: pa.Table) -> pa.Table:
        if not t.num_rows:
            return _SENT.empty_table()
        runs, block, out = Runs(_texts(t)[0]), t.column("block")[0].as_py(), []
        for part, found in enumerate(_portions(runs, decided(runs, _by_portion(back)) >= _OPEN)):
            t1, t2 = (np.concatenate([x[i] for x in found]) for i in (2, 3))
            pick, times, _ = _distinct(t1, t2)
            out.append(pa.Table.from_pylist(_sent(block, part, of_suffixes, t1[pick], t2[pick], times), schema=_SENT))
        return pa.concat_tables(out) if out else _SENT.empty_table()

    kind_of_id = rows.schema["doc_id"].dataType.simpleString()

    def cut(t: pa.Table, back: pa.Table) -> pa.Table:
        (texts, order), answers = _texts(t), _by_portion(back)
        runs = Runs(texts)
        status = decided(runs, answers)
        steps: list[list[tuple[int, int]]] = [[] for _ in texts]
        sure = np.flatnonzero((status == _SETTLED) | (status == _SENDS))
        for i, a, b in zip(runs.doc[sure].tolist(), (runs.off + runs.first)[sure].tolist(), (runs.off + runs.last)[sure].tolist()):
            steps[i].append((a, b))
        for part, found in enumerate(_portions(runs, status >= _OPEN)):
            t1, t2 = (np.concatenate([x[i] for x in found]) for i in (2, 3))
            pick, _, place = _distinct(t1, t2)
            again = np.split((_answers(answers, _SUFFIX, part, of_suffixes, t1[pick], t2[pick]) > 1)[place], np.cumsum([len(x[1]) for x in found])[:-1])
            for (i, start, _, _), hit in zip(found, again):
                if hit.any():
                    s = start[hit]
                    cuts = np.flatnonzero(np.r_[True, s[1:] != s[:-1] + 1])
                    steps[i] += zip(s[cuts].tolist(), s[np.r_[cuts[1:], len(s)] - 1].tolist())
        kept, spans = [], []
        for raw, own in zip(texts, steps):
            own.sort()
            merged: list[list[int]] = []
            for a, b in own:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b + LENGTH)
                else:
                    merged.append([a, b + LENGTH])
            at, parts = 0, []
            for a, b in merged:
                parts.append(raw[at:a])
                at = b
            kept.append(b"".join([*parts, raw[at:]]) if merged else raw)
            spans.append([{"start": a, "end": b} for a, b in merged])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": t.column("doc_id").take(pa.array(order)), "n_bytes": pa.array(list(map(len, texts)), pa.int64()), "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary())})

    by = lambda df: df.groupBy("block")
    first = by(dealt).applyInArrow(anchors, _SENT_DDL).groupBy("bucket").applyInArrow(judged(_ANCHOR), _BACK_DDL)
    second = by(dealt).cogroup(by(first)).applyInArrow(suffixes, _SENT_DDL).groupBy("bucket").applyInArrow(judged(_SUFFIX), _BACK_DDL)
    return by(dealt).cogroup(by(first.unionByName(second))).applyInArrow(cut, f"doc_id {kind_of_id}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")

"""Byte-level BPE: word counts in Spark, merges on the driver; and reports on a tokenizer over a corpus."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusmill.functions import patterns as P, text as T, udfs

#: Rows of an Arrow batch whose texts are encoded.
BATCH_ROWS = 500


@dataclass(frozen=True)
class Trained:
    spec: str
    vocabulary: int
    train_lines: int
    holdout_lines: int


def check_settings(vocabulary: int, fraction: float) -> None:
    if not 0 < vocabulary <= P.UINT16_MAX + 1:
        raise ValueError("vocabulary must be 1 to 65536")
    if not 0 < fraction < 1:
        raise ValueError("the held-out fraction must lie between 0 and 1")


def byte_characters() -> dict[int, str]:
    """Byte-level BPE's public table: printable bytes stand for themselves, others for characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


def merges_of(words: dict[str, int], vocabulary: int, least: int = P.LEAST_PAIR) -> tuple[list[str], list[tuple[str, str]]]:
    """(tokens, merges) learnt from word counts; a word is a string of byte characters. Most frequent pair first, ties in
    string order, so a result never depends on the order of words."""
    parts = [list(w) for w in sorted(words)]
    count = [words[w] for w in sorted(words)]
    tokens = list(P.SPECIAL_TOKENS) + sorted({c for w in parts for c in w})
    pairs: Counter[tuple[str, str]] = Counter()
    where: dict[tuple[str, str], set[int]] = defaultdict(set)
    for i, w in enumerate(parts):
        for p in zip(w, w[1:]):
            pairs[p] += count[i]
            where[p].add(i)
    queue = [(-n, p) for p, n in pairs.items()]
    heapq.heapify(queue)
    merges: list[tuple[str, str]] = []
    known = set(tokens)
    while queue and len(tokens) < vocabulary:
        n, pair = heapq.heappop(queue)
        if -n != pairs[pair]:
            if pairs[pair] >= least:
                heapq.heappush(queue, (-pairs[pair], pair))
            continue
        if -n < least:
            break
        merges.append(pair)
        if (new := "".join(pair)) not in known:
            known.add(new)
            tokens.append(new)
        touched = set()
        for i in where.pop(pair):
            w = parts[i]
            for p in zip(w, w[1:]):
                pairs[p] -= count[i]
                touched.add(p)
            out, k = [], 0
            while k < len(w):
                both = k + 1 < len(w) and (w[k], w[k + 1]) == pair
                out.append(new if both else w[k])
                k += 1 + both
            parts[i] = out
            for p in zip(out, out[1:]):
                pairs[p] += count[i]
                where[p].add(i)
                touched.add(p)
        for p in touched:
            if pairs[p] >= least:
                heapq.heappush(queue, (-pairs[p], p))
    return tokens, merges


def train(lines: DataFrame, *, vocabulary: int = P.VOCABULARY, seed: int = P.HOLDOUT_SEED, fraction: float = P.HOLDOUT, least: int = P.LEAST_PAIR, text: str = "text", index: str = "line") -> Trained:
    """A tokenizer from numbered lines: normalised, empty ones skipped, a hashed share held out. Only the distinct words
    and their counts come to the driver."""
    check_settings(vocabulary, fraction)
    rows = lines.withColumn("t", T.normalized(F.col(text))).where("t <> ''").withColumn("held", T.is_holdout(F.col(index), seed, fraction))
    n, held = rows.agg(F.count_if(~F.col("held")), F.count_if("held")).first()
    # pieces as the byte-level pre-tokenizer cuts them, with the space that is put before a text
    piece = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    pieces = rows.where("not held").select(F.explode(F.regexp_extract_all(F.concat(F.lit(" "), "t"), F.lit(f"({piece})"), 1)).alias("w"))
    table = byte_characters()
    counts = {"".join(table[b] for b in r.w.encode()): r.n for r in pieces.groupBy("w").agg(F.count("*").alias("n")).toLocalIterator()}
    tokens, merges = merges_of(counts, vocabulary, least)
    from tokenizers import AddedToken, Tokenizer, decoders, models, pre_tokenizers

    made = Tokenizer(models.BPE(vocab={t: i for i, t in enumerate(tokens)}, merges=merges, unk_token=P.SPECIAL_TOKENS[0]))
    made.pre_tokenizer, made.decoder = pre_tokenizers.ByteLevel(add_prefix_space=True), decoders.ByteLevel()
    made.add_special_tokens([AddedToken(t, special=True) for t in P.SPECIAL_TOKENS])
    return Trained(made.to_str(), len(tokens), n, held)


def save(trained: Trained, path: str) -> str:
    Path(path).write_text(trained.spec, encoding="utf-8")
    return file_hash(path)


def file_hash(path: str) -> str:
    """BLAKE2b with 8 bytes of a tokenizer file."""
    return hashlib.blake2b(Path(path).read_bytes(), digest_size=8).hexdigest()


def token_strings(spec: str) -> dict[int, str]:
    from tokenizers import Tokenizer

    return {i: t for t, i in Tokenizer.from_str(spec).get_vocab().items()}


def fallback_ids(spec: str) -> list[int]:
    """Ids whose token is one character that isn't white space or a clitic."""
    return sorted(i for i, t in token_strings(spec).items() if len(t) == 1 and not t.isspace() and t not in P.CLITICS)


def _counted(spec: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, n, held): how often each id stands in all of a partition's texts, and in those held out."""
        n, own = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for b in batches:
            held, at = b.column(1).to_numpy(zero_copy_only=False).astype(bool), 0
            for part in udfs.ids_of(b.column(0), spec):
                for into, ids in ((n, part), (own, [x for x, h in zip(part, held[at : at + len(part)]) if h])):
                    into += np.bincount(np.fromiter(itertools.chain.from_iterable(ids), np.int64), minlength=size)
                at += len(part)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(n[seen], pa.int64()), pa.array(own[seen], pa.int64())], names=["id", "n", "held"])

    return run


def metrics(lines: DataFrame, spec: str, *, seed: int = P.HOLDOUT_SEED, fraction: float = P.HOLDOUT, rare_below: int = P.RARE_BELOW, text: str = "text", index: str = "line") -> DataFrame:
    """One row on a tokenizer over numbered lines: corpus-wide rare tokens, and ratios over the held-out lines.

    dead_pct counts rare tokens among those seen; unused_pct those never seen. Lengths are of byte characters, as tokens
    are written; decoded_length is in characters of text. morph_f1 isn't computed and null. A partition hands on
    a row for each id it has, not one for each token.
    """
    from tokenizers import Tokenizer

    spark = lines.sparkSession
    # lines may be long, so batches are short
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    size, strings = Tokenizer.from_str(spec).get_vocab_size(), token_strings(spec)
    lengths = F.array(*(F.lit(len(strings.get(i, ""))) for i in range(max(strings) + 1)))
    single = F.array(*(F.lit(i) for i in fallback_ids(spec)), F.lit(-1))
    rows = lines.select(F.col(text).alias("x"), T.is_holdout(F.col(index), seed, fraction).alias("held"))
    # an empty text has no ids, so the heavy normalization runs once for each text, and once more for those held out
    counts = rows.select(T.normalized(F.col("x")).alias("t"), "held").mapInArrow(_counted(spec, max(strings) + 1), "id int, n long, held long").groupBy("id").agg(F.sum("n").alias("n"), F.sum("held").alias("held"))
    zero = F.lit(0).cast("long")
    counts = counts.agg(
        F.count_if(F.col("n") < rare_below).alias("rare_tokens"), F.count("*").alias("seen_tokens"), F.coalesce(F.sum("held"), zero).alias("content_tokens"),
        F.coalesce(F.sum(F.col("held") * F.element_at(lengths, F.col("id") + 1)), zero).alias("characters"), F.coalesce(F.sum(F.when(F.array_contains(single, F.col("id")), F.col("held"))), zero).alias("fallback_tokens"),
    )
    held = rows.where("held").select(T.normalized(F.col("x")).alias("t")).where("t <> ''").agg(F.coalesce(F.sum(F.size(T.words(F.col("t")))), zero).alias("words"), F.coalesce(F.sum(F.length("t")), zero).alias("text_characters"), F.count("*").alias("lines"))
    c = F.col
    return held.crossJoin(counts).select(
        F.lit(size).alias("vocab_size"), "lines", "words", "content_tokens", "rare_tokens", T.ratio(c("content_tokens"), c("words")).alias("fertility"), T.ratio(c("fallback_tokens"), c("content_tokens"), 100.0).alias("r_char"),
        T.ratio(c("characters"), c("content_tokens")).alias("l_avg"), T.ratio(c("text_characters"), c("content_tokens")).alias("decoded_length"), T.ratio(c("rare_tokens"), F.lit(size), 100.0).alias("dead_pct"),
        T.ratio(F.lit(size) - c("seen_tokens"), F.lit(size), 100.0).alias("unused_pct"), F.lit(None).cast("double").alias("morph_f1"),
    )


def warnings() -> Column:
    """What is out of the usual in a row of ``metrics``: an array of names."""
    lo, hi = P.MEAN_LENGTH
    return F.array_compact(F.array(F.when(F.col("fertility") > P.MAX_FERTILITY, F.lit("fertility")), F.when(F.col("r_char") > P.MAX_SINGLE_RATE, F.lit("r_char")), F.when(F.col("dead_pct") > P.MAX_DEAD_PCT, F.lit("dead_pct")), F.when((F.col("l_avg") < lo) | (F.col("l_avg") > hi), F.lit("l_avg"))))


def write_report(report: DataFrame, path: str) -> int:
    """The report's one row as JSON, with its warnings and the time; always 0, as warnings never fail a run."""
    row = report.withColumn("warnings", warnings()).withColumn("created_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")).first()
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(row.asDict(), ensure_ascii=False, indent=2), encoding="utf-8")
    return 0

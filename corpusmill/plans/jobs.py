"""Whole jobs from files to files: pack, distil with resume, train a tokenizer, report on one."""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

from corpusmill.functions import patterns as P
from corpusmill.operators import distill, ingest, packing, resume, tokenizer
from corpusmill.plans.scratch import exists, saved
from corpusmill.sources import corpus, packed


def pack_files(spark: SparkSession, raw: str, synthetic: str | None, tokenizer_path: str, out: str, *, pad_id: int = 0) -> dict:
    """<out>.bin, .index.npz and .meta.json from a folder of *.txt files, JSON lines of dialogues (None: none) and a tokenizer.

    Raw lines come first, then dialogues. Unknown ids, ids beyond the vocabulary and single characters fail the job.
    """
    spec = Path(tokenizer_path).read_text(encoding="utf-8")
    vocabulary = len(tokenizer.token_strings(spec))
    talk = corpus.numbered_dialogues(spark, synthetic) if synthetic else spark.createDataFrame([], "row_idx long, user string, assistant string")
    rows = packing.encoded(packing.rows_of(corpus.raw_rows(spark, raw), talk), spec)
    gated = packing.gated(rows, tokenizer.fallback_ids(spec), vocabulary)
    return packed.write(gated.select("kind", "row_idx", "ids"), out, vocabulary=vocabulary, tokenizer_hash=tokenizer.file_hash(tokenizer_path), pad_id=pad_id)


def pack_main(spark: SparkSession, raw: str, synthetic: str | None, tokenizer_path: str, out: str, *, pad_id: int = 0) -> int:
    """``pack_files`` as a command: 0, or 1 and the reason on stderr if the rows can't be packed."""
    try:
        pack_files(spark, raw, synthetic, tokenizer_path, out, pad_id=pad_id)
    except Exception as e:
        if isinstance(e, packing.PackingError) or "can't be packed" in str(e) or "doesn't fit 16 bits" in str(e):
            print(e, file=sys.stderr)
            return 1
        raise
    return 0


def distill_files(spark: SparkSession, metadata: str, out: str, anchors: str, config: distill.Config, transport: distill.Transport, *, max_rows: int = 0, chunk_rows: int = 10_000) -> dict[str, int]:
    """Dialogues of a metadata file's rows appended to ``out``; rows whose anchor stands in ``anchors`` are finished already.

    Rows go in chunks of ``chunk_rows`` by number. After each, its dialogues are appended and then its finished rows' anchors, so
    what a run has done when it fails, or the service asks for payment, needs no doing again; a chunk that fails between
    the two appends finds its dialogues among those that count as seen. Returns total, succeeded, failed, purged, appended.
    """
    rows = corpus.placed(spark.read.parquet(metadata))
    ingest.checked_columns(rows.drop("file", "block", "at"))
    rows = corpus.numbered(rows, "seq")
    valid = ingest.validated(rows, keep=("seq",))
    routed = saved(ingest.distillation_rows(ingest.tier_a(valid, keep=("seq",)), max_rows=max_rows))
    todo = saved(corpus.numbered(resume.todo(routed, resume.load(spark, anchors)).select("*", F.lit("").alias("file"), F.lit(0).alias("block"), F.col("seq").alias("at")), "turn"))
    counts = dict.fromkeys(("total", "succeeded", "failed", "purged", "appended"), 0)
    for first in range(0, todo.count(), chunk_rows):
        chunk = todo.where((F.col("turn") >= first) & (F.col("turn") < first + chunk_rows)).drop("turn")
        earlier = corpus.dialogues(spark, out) if exists(spark, out) else None
        done = distill.completed(chunk, config, transport, earlier=earlier)
        total, good, kept = done.outcomes.count(), done.succeeded.count(), done.dialogues.count()
        corpus.append_dialogues(done.dialogues.orderBy("seq"), out)
        resume.mark(resume.anchored(done.succeeded), anchors)
        for name, n in (("total", total), ("succeeded", good), ("failed", total - good), ("purged", good - kept), ("appended", kept)):
            counts[name] += n
    return counts


def train_file(spark: SparkSession, lines: str, out: str, *, vocabulary: int = P.VOCABULARY, seed: int = P.HOLDOUT_SEED, fraction: float = P.HOLDOUT) -> dict:
    """A tokenizer from a text file's lines, written to ``out``; returns its vocabulary, lines and hash."""
    made = tokenizer.train(corpus.numbered_lines(spark, lines), vocabulary=vocabulary, seed=seed, fraction=fraction)
    return {"vocabulary": made.vocabulary, "train_lines": made.train_lines, "holdout_lines": made.holdout_lines, "hash": tokenizer.save(made, out)}


def report_file(spark: SparkSession, lines: str, tokenizer_path: str, out: str, *, seed: int = P.HOLDOUT_SEED, fraction: float = P.HOLDOUT) -> int:
    """A tokenizer's figures over a text file as JSON; always 0, as warnings never fail a run."""
    spec = Path(tokenizer_path).read_text(encoding="utf-8")
    return tokenizer.write_report(tokenizer.metrics(corpus.numbered_lines(spark, lines), spec, seed=seed, fraction=fraction), out)

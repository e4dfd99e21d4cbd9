"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of whole texts are standardised and mapped to cosine features that approximate a Gaussian kernel. Every
partition sums its normal equations; the sums are added in a tree of groups, and a ridge system of fixed size is
solved on the driver. Raw scores of all training rows fall into 4096 bins, whose sums give an isotonic curve.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusmill.llm.common import in_training, saved, short_batches

N_FEATURES = 256
RIDGE = 1e-3
LENGTH_SCALE = 1.6
SEED = 7
BINS = 4096
RAW_RANGE = (-1.0, 2.0)
#: Rows per bin that the calibration adds with the mean label, so that thin ends stay moderate.
PRIOR_ROWS = 1.0

_UPPER = np.zeros(256, np.float64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.float64)
_DIGIT[48:58] = 1
_SPACE = np.zeros(256, np.float64)
_SPACE[[9, 10, 11, 12, 13, 32]] = 1
_LETTER = np.zeros(256, np.float64)
_LETTER[65:91] = _LETTER[97:123] = 1
_HIGH = np.zeros(256, np.float64)
_HIGH[128:] = 1
_STOP = np.zeros(256, np.float64)
_STOP[[33, 44, 46, 58, 59, 63]] = 1
_CLASSES = np.stack([_UPPER, _DIGIT, _SPACE, _LETTER, _HIGH, _STOP], 1)
_MARKS = np.flatnonzero((_CLASSES.sum(1) == 0) & (np.arange(256) > 32) & (np.arange(256) < 127))

N_STATS = 22


def statistics(text: str | None) -> list[float]:
    """Numbers of a text: its size, character classes, words, lines and how much repeats. Null is empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digit, space, letter, high, stop = (count @ _CLASSES).tolist()
    marks = count[_MARKS]
    words = raw.split()
    nw = max(1, len(words))
    seen = Counter(words)
    top = max(seen.values(), default=0)
    once = sum(1 for v in seen.values() if v == 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    nl = max(1, len(lines))
    p = count[count > 0] / n
    twins = sum(a == b for a, b in zip(words, words[1:]))
    packed = sum(len(zlib.compress(raw[i : i + (1 << 20)], 1)) for i in range(0, len(raw), 1 << 20)) if raw else 0
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    caps = sum(1 for w in seen if len(w) > 1 and w.isupper() for _ in range(1))
    return [
        math.log1p(len(words)), math.log1p(len(lines)), upper / n, digit / n, space / n, (letter + high) / n, high / n, stop / n,
        float(marks.sum()) / n, float(marks.max(initial=0)) / n, float(lengths.mean()), float(lengths.std()), min(1.0, float(lengths.max()) / 100),
        len(seen) / nw, top / nw, once / nw, twins / nw, len(set(lines)) / nl, math.log1p(nw / nl), float(-(p * np.log2(p)).sum()), packed / n, caps / max(1, len(seen)),
    ]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [statistics(t) for t in b.column(b.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], names=[*b.schema.names[:-1], "stats"])


def measured(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the array column stats."""
    from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

    short_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c not in (text, "stats")]
    source = docs.select(*keep, F.col(text).alias("__text"))
    return source.mapInArrow(_measured, StructType([*source.schema.fields[:-1], StructField("stats", ArrayType(DoubleType()))]))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    edges: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return _mapped((stats - self.mean) / self.scale) @ self.weight

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.edges, self.values), 0.0, 1.0)


def _mapped(x: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, with the statistics themselves and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(size=(N_STATS, N_FEATURES)) / (LENGTH_SCALE * math.sqrt(N_STATS))
    x = np.clip(x, -6, 6)
    return np.concatenate([np.cos(x @ w + rng.uniform(0, 2 * np.pi, N_FEATURES)) * math.sqrt(2 / N_FEATURES), x / 10, np.ones((len(x), 1))], 1)


def _summed(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of the partitions' matrices, given as rows (i, pid, v): added in groups of 32 partitions, then all."""

    def add(table: pa.Table) -> pa.Table:
        v = np.stack([np.asarray(x) for x in table.column("v").to_numpy()]).sum(0)
        return pa.table({"i": table.column("i")[:1], "pid": table.column("pid")[:1], "v": pa.array([v], pa.list_(pa.float64()))})

    out = parts.withColumn("pid", F.floor(F.col("pid") / 32)).groupBy("i", "pid").applyInArrow(add, "i int, pid long, v array<double>")
    out = out.withColumn("pid", F.floor(F.col("pid") / 1024)).groupBy("i", "pid").applyInArrow(add, "i int, pid long, v array<double>")
    total: dict[int, np.ndarray] = {}
    for r in out.collect():  # one row of fixed width per feature and 32,768 partitions
        total[r.i] = total.get(r.i, 0) + np.array(r.v)
    return np.stack([total[i] for i in sorted(total)]) if total else np.zeros((0, width))


def _stats_of(b: pa.RecordBatch, column: str = "stats") -> np.ndarray:
    c = b.column(column)
    return c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), N_STATS)


def fit(train: DataFrame) -> Model:
    """A model from rows (stats, label); label null is left out. No rows, or one label only: a constant score."""
    train = train.where("label is not null").select("stats", F.col("label").cast("double").alias("label"))
    n, mean_label, *moments = train.agg(
        F.count("*"), F.avg("label"), *(f(F.col("stats")[i]) for i in range(N_STATS) for f in (F.avg, F.stddev_pop))
    ).first()
    if not n:
        return Model(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(N_STATS + N_FEATURES + 1), np.array([0.0]), np.array([0.5]))
    mean, scale = np.array(moments[::2], float), np.array(moments[1::2], float)
    scale[~(scale > 1e-9)] = 1.0
    width = N_STATS + N_FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a = np.zeros((width, width + 1))
        for b in batches:
            if b.num_rows:
                z, y = _mapped((_stats_of(b) - mean) / scale), b.column("label").to_numpy()
                a += z.T @ np.concatenate([z, y[:, None]], 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([TaskContext.get().partitionId()] * width, pa.int64()), pa.array(list(a), pa.list_(pa.float64()))], names=["i", "pid", "v"])

    a = _summed(train.mapInArrow(equations, "i int, pid long, v array<double>"), width)
    weight = np.linalg.solve(a[:, :width] + RIDGE * n / 1000 * np.eye(width), a[:, width])
    model = Model(mean, scale, weight, np.array([0.0]), np.array([0.5]))
    lo, hi = RAW_RANGE

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ones = np.zeros(BINS), np.zeros(BINS)
        for b in batches:
            if b.num_rows:
                k = np.clip((model.raw(_stats_of(b)) - lo) / (hi - lo) * BINS, 0, BINS - 1).astype(int)
                rows += np.bincount(k, minlength=BINS)
                ones += np.bincount(k, b.column("label").to_numpy(), minlength=BINS)
        k = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(rows[k]), pa.array(ones[k])], names=["bin", "n", "ones"])

    sums = train.mapInArrow(binned, "bin int, n double, ones double").groupBy("bin").agg(F.sum("n"), F.sum("ones")).orderBy("bin").collect()
    model.edges, model.values = isotonic([(lo + (r[0] + 0.5) * (hi - lo) / BINS, r[1], r[2]) for r in sums], float(mean_label))
    return model


def isotonic(bins: list[tuple[float, float, float]], prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (position, rows, ones), ascending: block centres and their shares of ones."""
    blocks: list[list[float]] = []  # weighted position, rows, ones
    for at, n, ones in bins:
        blocks.append([at * n, n, ones])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    value = np.maximum.accumulate(np.array([(b[2] + PRIOR_ROWS * prior) / (b[1] + PRIOR_ROWS) for b in blocks]))
    at = np.array([b[0] / b[1] for b in blocks])
    # towards the ends of the range the curve goes on to 0 and 1, so that raw scores beyond keep their order
    return np.r_[RAW_RANGE[0] - 1, at, RAW_RANGE[1] + 1], np.r_[min(value[0], 0.001), value, max(value[-1], 0.999)]


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` without its array, with score (0 to 1). The model's size is fixed by its parameters."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    keep = [c for c in stats.columns if c != "stats"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(_stats_of(b)) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(s)], names=[*keep, "score"])

    return stats.mapInArrow(run, StructType([*(f for f in stats.schema.fields if f.name != "stats"), StructField("score", DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", modulus: int = 3, held: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (higher: label 1 likelier), predicted (score >= 0.5).

    Labels (doc_id, quality) are learnt only from rows whose crc32(doc_id) mod ``modulus`` is not ``held``; of repeated
    labels of an id the mean counts, rounded. Null and empty texts are scored like others (all statistics zero).
    Repeated rows are scored each. Without usable labels every score is 0.5. Empty table: no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    stats = saved(measured(rows))
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.round(F.avg("quality")).alias("label"))
    train = stats.where(in_training("doc_id", modulus, held)).join(known, "doc_id").select("stats", "label")
    out = scored(stats, fit(saved(train)))
    return out.select("doc_id", (~in_training("doc_id", modulus, held)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def load_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")

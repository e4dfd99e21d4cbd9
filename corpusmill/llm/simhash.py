"""SimHash fingerprints and near-duplicate groups by covering locality-sensitive hashing.

A fingerprint bit is set if it is set in more than half of the 64-bit hashes of a text's word shingles.
Every bit position gets a non-zero vector of GF(2)^(r+1); for each non-zero v of that space, the mask
``M_v`` keeps the positions whose vector has inner product 1 with v. At most r differing positions span a
space of rank r or less, so some v is orthogonal to all of them: their two fingerprints agree on ``M_v`` and
meet in that table. No pair within the radius is missed, whatever the data.

Buckets of many fingerprints are cut into tiles (pairs of chunks), each compared in its own task; a tile
returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.common import components, n_blocks, saved, short_batches

WORDS_PER_SHINGLE = 3
RADIUS = 3
HASH_SEED = 42
#: Fingerprints of one bucket that are compared in one task; larger buckets are cut into tiles.
TILE = 1024


def fingerprint(text: str | None, *, words: int = WORDS_PER_SHINGLE) -> int:
    """The 64-bit SimHash of a text; null or blank text: 0."""
    import xxhash

    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(ws) < words:
        hashes = [digest(b" ".join(ws), HASH_SEED)]
    else:
        hashes = [digest(b" ".join(x), HASH_SEED) for x in zip(*(ws[i:] for i in range(words)))] if words != 3 else [digest(b"%b %b %b" % x, HASH_SEED) for x in zip(ws, ws[1:], ws[2:])]
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at : at + 65536], dtype="<u8")
        total += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, text: str = "text", words: int = WORDS_PER_SHINGLE) -> DataFrame:
    """``docs`` without its text, with column fp (long, the fingerprint's bits)."""
    short_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != text]
    source = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words=words) for t in b.column(len(keep)).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(fp)], names=[*keep, "fp"])

    from pyspark.sql.types import LongType, StructField, StructType

    return source.mapInArrow(run, StructType([*source.schema.fields[: len(keep)], StructField("fp", LongType())]))


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The 2^(radius+1) - 1 masks, as signed 64-bit numbers."""
    size = radius + 1
    vector = [1 + i % (2**size - 1) for i in range(bits)]
    masks = [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, 2**size)]
    return [m - 2**64 if m >= 2**63 else m for m in masks]


def _stars(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between the rows of a bucket: each row with its component's least."""
    order = np.argsort(fps, kind="stable")
    x = fps[order].view(np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    label = np.arange(len(x))
    while True:
        new = np.where(near, label[None, :], len(x)).min(1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(x))
    return fps[order][own], fps[order][label[own]]


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches sorted by bucket; a bucket may go on in the next batch."""
        rest_key, rest_fp = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)
        for b in itertools.chain(batches, [None]):
            if b is None:
                key, fp, cut = rest_key, rest_fp, len(rest_fp)
            else:
                key = np.concatenate([rest_key, np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], 1)])
                fp = np.concatenate([rest_fp, b.column(4).to_numpy()])
                if not len(fp):
                    continue
                cut = int(np.flatnonzero((key != key[-1]).any(1))[-1]) + 1 if (key != key[-1]).any() else 0
            rest_key, rest_fp = key[cut:], fp[cut:]
            key, fp = key[:cut], fp[:cut]
            if not len(fp):
                continue
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
            sizes = np.diff(np.r_[starts, len(fp)])
            two = starts[sizes == 2]
            a, c = fp[two], fp[two + 1]
            near = np.bitwise_count(a.view(np.uint64) ^ c.view(np.uint64)) <= radius
            out = [(a[near], c[near])] + [_stars(fp[s : s + n], radius) for s, n in zip(starts[sizes > 2], sizes[sizes > 2])]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in out])) for i in (0, 1)], names=["a", "b"])

    return run


def links(distinct: DataFrame, *, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of column fp: a spanning forest of every bucket's."""
    spark = distinct.sparkSession
    masks = covering_masks(radius)
    keyed = distinct.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("m", "key"))
    sizes = keyed.groupBy("m", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    met = keyed.join(sizes, ["m", "key"]).select("fp", "m", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    tiles = met.select("m", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    # a chunk's rows meet those of each other chunk in one tile, and their own in (i, i)
    n = max(n_blocks(distinct, 8 << 20), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return tiles.repartition(n, "m", "key", "i", "j").sortWithinPartitions("m", "key", "i", "j").mapInArrow(_links(radius), "a long, b long")


def _grouped(docs: DataFrame, *, words: int = WORDS_PER_SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` (doc_id, text and others) without text, with fp, component (one fingerprint for all of a group) and component_id."""
    fps = saved(fingerprints(docs, words=words))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    group = components(links(distinct.select("fp"), radius=radius))
    classes = distinct.join(group, distinct.fp == group.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    classes = saved(classes)
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(least, "component").select("fp", "component", "component_id")
    return fps.join(classes, "fp")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS_PER_SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id.

    Documents are linked if their fingerprints differ in ``radius`` bits or fewer; component_id is the smallest
    doc_id reachable. Null and blank texts have fingerprint 0 and link like any other. A null doc_id never
    becomes a component_id unless all ids of its component are null. Repeated rows stay. Other columns of
    ``docs`` are not carried. An empty table gives an empty one.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return _grouped(docs, words=words, radius=radius).select("doc_id", "fp", "component_id")


def hexadecimal(fp) -> F.Column:
    """16 lowercase hex digits of a long's bits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the least doc_id's, of repeated ids the least row.

    Rows with a null doc_id are compared like others; they stay only if their whole group has none, and then
    the least row of each such group stays.
    """
    # two hashes of 64 bits stand for the text: with the id they name a row's group, and only they leave the operator; the row
    # is one column, so that its names clash with none here
    keyed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"))
    found = _grouped(keyed.select("doc_id", "text", "h", "g"))
    least = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("id"), F.col("h").alias("lh"), F.col("g").alias("lg"), F.col("component").alias("group")).agg(F.count("*").alias("n"))
    least = saved(least)
    total = least.groupBy(F.col("group").alias("of")).agg(F.sum("n").alias("rows"))
    least = least.join(total, F.col("group") == F.col("of")).select("id", "lh", "lg", "group", "rows")
    kept = keyed.select("row", "doc_id", "h", "g").join(least, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("lh")) & (F.col("g") == F.col("lg")))
    once = kept.where("rows = 1").select("row")
    again = kept.where("rows > 1").groupBy("group").agg(F.min("row").alias("row")).select("row")
    return once.unionByName(again).select("row.*")

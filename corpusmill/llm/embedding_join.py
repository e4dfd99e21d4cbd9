"""Near-duplicate vectors by an exact metric range join.

Unit vectors of cosine c are sqrt(2 - 2c) apart, so a cosine bound is a distance bound r. Vectors go to the cell of
their nearest pivot. A vector is also sent to every cell that could hold a partner: by the triangle inequality all points
within r of x stay in x's cell unless x is within r of the plane midway between the two pivots. Of two cells the
one with the lower number compares, so a pair meets once. Cells join independently; large ones are cut into tiles of
bounded size, each pair of tiles a task of its own. A tile returns counts and a spanning forest of its links, never all pairs.

Within a tile, vectors first meet by a head: their coordinates along a few directions, and the length of the rest. By
Cauchy and Schwarz no pair's cosine is above the product of its heads, so a pair whose heads stay below the bound is no link; all
others are compared in double precision (in dense blocks only those that single precision cannot tell). Directions are those along
which a sample is longest, their number the cheapest on it; any directions give the same links.

How many pivots there are follows from the data: for 1, 4, 16, ... up to an eighth of the vectors a sample tells with how
many vectors one would be compared and to how many cells it would be sent. In clustered data cells stay about as large
as clusters. In data without clusters every plane is near, one cell is as good as many, and the join compares all with
all, in tiles; so it does within cells beyond the PIVOT_BYTES that tasks may get. Equal vectors are compared once, with
their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusmill.llm.attention import one_blas_thread
from corpusmill.llm.common import components, saved

COSINE = 0.95
#: Bytes of pivots that tasks may get, vectors by which their number is judged, and cells that a vector may go to on average.
PIVOT_BYTES, JUDGED, MEAN_CELLS = 16 << 20, 1024, 24
#: Distances to pivots that are held at a time.
DISTANCES = 1 << 21
#: Rows on either side of a tile, their bytes, and the rows of the blocks in which it is multiplied out.
TILE, TILE_BYTES, BLOCK = 1 << 17, 32 << 20, 512
#: Rows below which a tile isn't cut for the sake of idle cores.
SMALL_TILE = 4096
#: Directions of a head that are tried, and what a pair costs besides its head, by a direction, and if its heads don't part it.
HEADS, PAIR_COST, DIRECTION_COST, MET_COST = (8, 16, 24, 32, 48, 64, 96, 128), 12.0, 1.0, 6000.0
#: Links that are gathered before they are joined into components, and pairs compared at a time.
GATHERED, COMPARED = 1 << 18, 1 << 14


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, safely for very large and very small components."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def slack(dims: int) -> float:
    """More than single precision may err in a product of two unit vectors."""
    return 1e-4 + 2e-7 * dims


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """Binary rows of one length as a matrix, without a copy of each."""
    parts = [c for c in column.chunks if len(c)]
    rows = [np.frombuffer(c.buffers()[2], np.uint8)[c.buffers()[1] and np.frombuffer(c.buffers()[1], np.int32)[c.offset] :] for c in parts]
    width = len(parts[0][0].as_py())
    out = np.empty((len(column), width), np.uint8)
    at = 0
    for c, r in zip(parts, rows):
        out[at : at + len(c)] = r[: len(c) * width].reshape(len(c), width)
        at += len(c)
    return out.view(kind)


class Forest:
    """Components of rows whose links come in portions."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        new = self.label[a] != self.label[b]
        if new.any():
            self.parts.append((a[new], b[new]))
            self.held += int(new.sum())
            if self.held >= GATHERED:
                self.join()

    def join(self) -> np.ndarray:
        """Each row's label: the least row of its component."""
        if self.parts:
            a, b = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1))
            self.parts, self.held, label = [], 0, self.label
            while True:
                p, q = label[a], label[b]
                apart = p != q
                if not apart.any():
                    break
                a, b, p, q = a[apart], b[apart], p[apart], q[apart]
                np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
                while (label[label] != label).any():
                    label[:] = label[label]
        return self.label


def heads(x: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Coordinates of unit vectors along orthonormal ``directions`` (columns), and the length of what is left."""
    own = x @ directions
    return np.concatenate([own, np.sqrt(np.maximum(0, 1 - (own * own).sum(1, keepdims=True)))], 1).astype(np.float32)


def chosen_directions(vectors: np.ndarray, cosine: float) -> np.ndarray | None:
    """Directions of the heads of vectors like these unit ``vectors``; None if whole vectors are as cheap."""
    dims = vectors.shape[1]
    judges = vectors[-JUDGED:]
    axes = np.linalg.eigh(vectors.T @ vectors)[1][:, ::-1]
    above = np.triu(np.ones((len(judges), len(judges)), bool), 1)
    linked = (judges @ judges.T >= cosine) & above
    best, least = None, PAIR_COST + DIRECTION_COST * dims
    for k in HEADS:
        if k + 1 < dims:
            h = heads(judges, axes[:, :k])
            met = (h @ h.T >= cosine - slack(dims)) & above & ~linked
            cost = PAIR_COST + DIRECTION_COST * (k + 1) + MET_COST * (met.sum() + 1) / max(1, above.sum())
            if cost < least:
                best, least = np.ascontiguousarray(axes[:, :k]), cost
    return best


def cells(x: np.ndarray, p: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot of each unit vector, whether a vector within ``radius`` of it may belong to each pivot)."""
    square = np.maximum(0, 2 - 2 * x @ p.T)
    home = square.argmin(1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * p[home] @ p.T)) + 1e-9
    sent = square - square.min(1, keepdims=True) <= 2 * radius * apart
    sent[np.arange(len(x)), home] = True
    return home, sent


def spread(x: np.ndarray, radius: float) -> np.ndarray:
    """The vectors, in order, that are more than two radii away from all taken before: one or a few of each cluster."""
    taken = x[:1]
    for lo in range(1, len(x), 256):
        part = x[lo : lo + 256]
        part = part[(2 - 2 * part @ taken.T).min(1) > 4 * radius**2]
        far, left = 2 - 2 * part @ part.T > 4 * radius**2, np.ones(len(part), bool)
        for i in range(len(part)):
            if left[i]:
                left[i + 1 :] &= far[i, i + 1 :]
        taken = np.concatenate([taken, part[left]])
    return taken


def chosen_pivots(vectors: np.ndarray, total: int, radius: float) -> np.ndarray:
    """As many of some unit ``vectors``, in random order, as make the fewest comparisons; the last of them judge."""
    judges = vectors[-JUDGED:]
    most = max(1, min(len(vectors) - len(judges), total // 8, PIVOT_BYTES // (8 * vectors.shape[1])))
    apart = spread(vectors[:most], radius)
    best, cost, n = apart[:1], float(total), 1
    while n < len(apart):
        n = min(4 * n, len(apart))
        p = apart[:n]
        step = max(1, DISTANCES // n)
        found = [cells(judges[lo : lo + step], p, radius) for lo in range(0, len(judges), step)]
        share = (np.bincount(np.concatenate([f[0] for f in found]), minlength=len(p)) + 1 / len(p)) / (len(judges) + 1)
        # a distance to a pivot costs twice: from the vector, and from its nearest pivot
        now = total * sum(float((f[1] @ share).sum()) for f in found) / len(judges) + 2 * len(p)
        if now < 0.7 * cost and sum(int(f[1].sum()) for f in found) <= MEAN_CELLS * len(judges):
            best, cost = p, now
    return best


def _tile(kind: str, cosine: float, directions: dict[int, np.ndarray | None]):
    def run(t: pa.Table) -> pa.Table:
        one_blas_thread()
        node, n, side = (t.column(c).to_numpy() for c in ("node", "n", "side"))
        raw = _matrix(t.column("vec"), kind)
        dims = raw.shape[1]
        along, unsure = directions.get(dims), slack(dims)
        same = t.column("i")[0].as_py() == t.column("j")[0].as_py()
        home = np.flatnonzero(side == 0)
        other = home if same else np.flatnonzero(side == 1)
        f = np.empty(raw.shape, np.float32)
        h = f if along is None else np.empty((len(raw), along.shape[1] + 1), np.float32)
        for lo in range(0, len(raw), 8192):
            x = unit(raw[lo : lo + 8192])
            f[lo : lo + 8192] = x
            if along is not None:
                h[lo : lo + 8192] = heads(x, along)
        links, forest = np.zeros(len(raw), np.int64), Forest(len(raw))
        product, met = np.empty(BLOCK * BLOCK, np.float32), np.empty(BLOCK * BLOCK, bool)

        def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            out = np.empty(len(a), bool)
            for k in range(0, len(a), COMPARED):
                own = slice(k, k + COMPARED)
                out[own] = np.einsum("ij,ij->i", unit(raw[a[own]]), unit(raw[b[own]])) >= cosine
            return out

        for j in range(0, len(other), BLOCK):
            b = other[j : j + BLOCK]
            hb = np.ascontiguousarray(h[b].T)
            for i in range(0, min(len(home), j + BLOCK) if same else len(home), BLOCK):
                a = home[i : i + BLOCK]
                size = len(a) * len(b)
                near = np.greater_equal(np.matmul(h[a], hb, out=product[:size].reshape(len(a), len(b))), np.float32(cosine - unsure), out=met[:size].reshape(len(a), len(b)))
                at = _places(met, size)
                if not len(at):
                    continue
                if len(at) > size // 64:
                    s = f[a] @ f[b].T
                    near = s >= np.float32(cosine + unsure)
                    r, c = np.nonzero(~near & (s >= np.float32(cosine - unsure)))
                    near[r, c] = linked(a[r], b[c])
                    r, c = np.nonzero(near)
                else:
                    r, c = np.divmod(at, len(b))
                    real = linked(a[r], b[c])
                    r, c = r[real], c[real]
                if same and i == j:
                    r, c = r[r < c], c[r < c]
                if len(r):
                    links[a] += np.bincount(r, n[b[c]], len(a)).astype(np.int64)
                    links[b] += np.bincount(c, n[a[r]], len(b)).astype(np.int64)
                    forest.add(a[r], b[c])
        hit = np.flatnonzero(links)
        return pa.table({"a": pa.array(node[hit], pa.int64()), "links": pa.array(links[hit], pa.int64()), "b": pa.array(node[forest.join()[hit]], pa.int64())})

    return run


def _places(met: np.ndarray, size: int) -> np.ndarray:
    """Where the first ``size`` flags are set; mostly none are, so eight are looked at together."""
    whole = size // 8
    eights = np.flatnonzero(met[: 8 * whole].view(np.uint64))
    at = (eights[:, None] * 8 + np.arange(8)).ravel()
    at = np.r_[at, np.arange(8 * whole, size)]
    return at[met[at]]


def near_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, tile: int = TILE) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    n_links counts the other rows whose cosine is ``cosine`` or more, in double precision; component_id is the least vec_id
    reachable over links; kept holds where it is the row's own. Vectors that are null, empty, zero, or hold a null or
    non-finite component link with nothing, and so do vectors of different lengths. Repeated rows are vectors of their
    own. Other columns are not carried. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"))
    single = rows.schema["v"].dataType.elementType.simpleString() == "float"
    kind, spark_kind = ("<f4", "float") if single else ("<f8", "double")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = F.coalesce(F.col("v").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda c: c != 0), F.lit(False))
    keys = [F.xxhash64("v").alias("k1"), F.hash("v").alias("k2")]
    rows = rows.withColumn("v", F.when(usable, F.transform("v", lambda c: c.cast(spark_kind))))
    # equal vectors become one, whatever their number
    groups = rows.where("v is not null").groupBy(*keys).agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("v").alias("v"))
    groups = saved(groups.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("v")))
    total = groups.count()
    radius = math.sqrt(2 - 2 * cosine) * (1 + 1e-9) + 1e-9
    # a sample of bounded size: that of the pivots, and their judges
    width = groups.agg(F.max("dim")).first()[0] or 1
    chosen = groups.orderBy(F.xxhash64("k1", "k2"), "k1", "k2").limit(JUDGED + max(1, min(total // 8, PIVOT_BYTES // (8 * width)))).select("v").collect()
    by_size: dict[int, list[list[float]]] = {}
    for r in chosen:
        by_size.setdefault(len(r.v), []).append(r.v)
    pivots, directions = {}, {}
    for d, v in by_size.items():
        x = unit(np.array(v))
        pivots[d], directions[d] = chosen_pivots(x, total, radius), chosen_directions(x, cosine)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, node, n = (b.column(c).to_numpy() for c in ("dim", "node", "n"))
            values = b.column("v").flatten().to_numpy()
            begin = np.cumsum(dims, dtype=np.int64) - dims
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                raw = np.ascontiguousarray(values[begin[own][:, None] + np.arange(d)].astype(kind))
                p = pivots.get(d)
                if p is None or len(p) == 1:
                    home, i, c = np.zeros(len(own), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
                else:
                    step = max(1, DISTANCES // len(p))
                    found = [cells(unit(raw[lo : lo + step]), p, radius) for lo in range(0, len(own), step)]
                    home, sent = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                    # of two cells, that of the lower number compares
                    i, c = np.nonzero(sent & (np.arange(len(p)) < home[:, None]))
                at, cell = np.r_[np.arange(len(own)), i], np.r_[home, c]
                role = np.r_[np.zeros(len(own), np.int64), np.ones(len(i), np.int64)]
                for lo in range(0, len(at), 4096):
                    k = at[lo : lo + 4096]
                    vec = pa.Array.from_buffers(pa.binary(), len(k), [None, pa.py_buffer((np.arange(len(k) + 1) * raw.itemsize * d).astype(np.int32)), pa.py_buffer(raw[k].tobytes())])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(k), d), pa.int32()), pa.array(cell[lo : lo + 4096], pa.int32()), pa.array(role[lo : lo + 4096], pa.int32()),
                        pa.array(node[own][k], pa.int64()), pa.array(n[own][k], pa.int64()), vec,
                    ], names=["dim", "cell", "role", "node", "n", "vec"])

    sent = saved(groups.select("dim", "node", "n", "v").mapInArrow(dealt, "dim int, cell int, role int, node long, n long, vec binary"))
    sizes = sent.groupBy("dim", "cell").agg(F.count_if(F.col("role") == 0).alias("homes"), F.sum("role").alias("others")).where("homes > 0")
    # pairs of tiles are tasks: at least about two for each core, of bounded bytes
    cores = max(1, spark.sparkContext.defaultParallelism)
    pairs = sizes.agg(F.sum(F.col("homes").cast("double") * (F.col("homes") / 2 + F.col("others")))).first()[0] or 0.0
    even = min(tile, max(SMALL_TILE, math.ceil(math.sqrt(pairs / (2 * cores)))))
    most = F.least(F.lit(even), F.greatest(F.lit(1), F.floor(F.lit(TILE_BYTES) / (F.col("dim") * np.dtype(kind).itemsize))))
    sizes = saved(sizes.select("dim", "cell", F.ceil(F.col("homes") / most).cast("int").alias("h"), F.ceil(F.col("others") / most).cast("int").alias("c")))
    tasks = int(sizes.agg(F.sum(F.col("h").cast("double") * ((F.col("h") + 1) / 2 + F.col("c")))).first()[0] or 0)
    spaces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(8 * tasks, 64 * cores))
    h, c, k, at_home = F.col("h"), F.col("c"), F.col("k"), F.col("role") == 0
    own = F.pmod(F.xxhash64("node"), F.when(at_home, h).otherwise(c)).cast("int")
    met = sent.join(sizes, ["dim", "cell"]).withColumn("own", own).withColumn("k", F.explode(F.sequence(F.lit(0), F.when(at_home, h + c).otherwise(h) - 1)))
    # tiles i <= j of a cell's own rows, then each with the tiles of those sent to it
    met = met.withColumn("i", F.when(at_home & (k < h), F.least("own", "k")).when(at_home, F.col("own")).otherwise(k)).withColumn("j", F.when(at_home & (k < h), F.greatest("own", "k")).when(at_home, k).otherwise(h + F.col("own")))
    met = met.withColumn("side", F.when(at_home, (k < h) & (F.col("own") > k)).otherwise(F.lit(True)).cast("int"))
    # so many partitions, which Spark doesn't join by their bytes: a tile's work isn't in its bytes
    met = met.select("dim", "cell", "i", "j", "side", "node", "n", "vec").repartition(spaces, "dim", "cell", "i", "j")
    found = saved(met.groupBy("dim", "cell", "i", "j").applyInArrow(_tile(kind, cosine, directions), "a long, links long, b long"))
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    part = components(found.select("a", "b"))
    part = part.withColumnRenamed("node", "member")
    named = groups.join(part, F.col("node") == F.col("member"), "left").select("k1", "k2", "n", "least", "node", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").join(links, F.col("node") == F.col("a"), "left").select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    rows = rows.select("vec_id", F.col("v").isNotNull().alias("ok"), *keys)
    out = rows.join(named, F.col("ok") & (F.col("k1") == F.col("g1")) & (F.col("k2") == F.col("g2")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))

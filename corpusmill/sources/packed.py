"""Packed token files: a flat file of unsigned 16-bit ids, an index of rows and a description, and readers for them."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusmill.functions import patterns as P
from corpusmill.operators import packing

_ROWS = "row_idx long, kind byte, start long, ids array<int>"


def _replaced(path: Path, write) -> None:
    """Writes beside ``path``, then takes its place: readers see the old file or the new one."""
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            write(f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise


def _parts(folder: str):
    """Writes each partition's ids, which come in order, to a file of its own that is named by the first row's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name, n = None, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            if held is None:
                name = f"{b.column('kind')[0].as_py():03d}-{b.column('row_idx')[0].as_py():020d}"
                handle, temporary = tempfile.mkstemp(dir=folder, prefix=".writing-")
                held = os.fdopen(handle, "wb")
            ids = b.column("ids").flatten().to_numpy(zero_copy_only=False)
            if len(ids) and (ids.min() < 0 or ids.max() > P.UINT16_MAX):
                raise packing.PackingError("an id doesn't fit 16 bits")
            held.write(ids.astype(np.uint16).tobytes())
            n += len(ids)
        if held is not None:
            held.close()
            # a task that runs again, or twice at a time, leaves the same file
            os.replace(temporary, os.path.join(folder, name))
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["name", "n"])

    return run


def write(rows: DataFrame, path: str, *, vocabulary: int, tokenizer_hash: str, pad_id: int = 0) -> dict:
    """Writes <path>.bin, .index.npz and .meta.json from (kind, row_idx, ids) and returns the description.

    Tasks write part files into a folder beside ``path``, which all executors must see; the driver joins them in order of
    offset without looking into them. Of the rows it holds three numbers each, as the index's format asks. Nothing is
    replaced before all is written.
    """
    if vocabulary > P.UINT16_MAX:
        raise packing.PackingError(f"{vocabulary} ids don't fit 16 bits")
    base = Path(path)
    base.parent.mkdir(parents=True, exist_ok=True)
    order = ("kind", "row_idx")
    placed = packing.with_offsets(rows.withColumn("length", F.size("ids").cast("long")), order=order)
    folder = tempfile.mkdtemp(dir=base.parent, prefix=f".{base.name}.parts-")
    os.chmod(folder, 0o777)
    try:
        n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ordered = placed.select("kind", "row_idx", "ids").repartitionByRange(n, *order).sortWithinPartitions(*order)
        parts = sorted((r.name, r.n) for r in ordered.mapInArrow(_parts(folder), "name string, n long").collect())
        table = placed.select("kind", "row_idx", "start", "length").toArrow().sort_by([("kind", "ascending"), ("row_idx", "ascending")])
        kinds = table.column("kind").to_numpy().astype(np.uint8)
        index = {"starts": table.column("start").to_numpy().astype(np.uint64), "lengths": table.column("length").to_numpy().astype(np.uint64), "kind": kinds}
        total = int(index["lengths"].sum())
        if sum(k for _, k in parts) != total:
            raise packing.PackingError("the parts don't hold the ids of all rows")

        def joined(f) -> None:
            for name, _ in parts:
                with open(os.path.join(folder, name), "rb") as part:
                    shutil.copyfileobj(part, f, 1 << 20)

        _replaced(base.with_name(base.name + ".bin"), joined)
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    _replaced(base.with_name(base.name + ".index.npz"), lambda f: np.savez_compressed(f, **index))
    raw = int((kinds == P.KIND_RAW).sum())
    meta = {"vocab_size": vocabulary, "tokenizer_hash": tokenizer_hash, "total_tokens": total, "rows_raw": raw, "rows_synthetic": int((kinds == P.KIND_SYNTHETIC).sum()), "pad_id": pad_id}
    _replaced(base.with_name(base.name + ".meta.json"), lambda f: f.write(json.dumps(meta).encode()))
    return meta


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int):
        super().__init__((lo, hi))
        self.lo, self.hi = lo, hi


class PackedReader(DataSourceReader):
    """Rows of a packed file, read through a memory map; each partition has a range of rows."""

    def __init__(self, options: dict[str, str]):
        self.path, self.parts = options["path"], int(options.get("partitions", "8"))
        self.flat = int(options.get("flat_row", "0"))

    def _index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.flat:
            n = os.path.getsize(f"{self.path}.bin") // 2
            starts = np.arange(0, n, self.flat, dtype=np.uint64)
            return starts, np.minimum(self.flat, n - starts.astype(np.int64)), np.zeros(len(starts), np.uint8)
        with np.load(f"{self.path}.index.npz") as z:
            out = z["starts"], z["lengths"], z["kind"]
        if len({len(x) for x in out}) > 1:
            raise packing.PackingError("the index's arrays differ in length")
        if json.loads(Path(f"{self.path}.meta.json").read_text())["vocab_size"] > P.UINT16_MAX:
            raise packing.PackingError("the vocabulary doesn't fit 16 bits")
        return out

    def partitions(self) -> list[InputPartition]:
        n = len(self._index()[0])
        cuts = np.linspace(0, n, min(self.parts, max(1, n)) + 1).astype(int).tolist()
        return [_Range(a, b) for a, b in zip(cuts[:-1], cuts[1:])]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        starts, lengths, kinds = self._index()
        data = np.memmap(f"{self.path}.bin", np.uint16, "r") if os.path.getsize(f"{self.path}.bin") else np.zeros(0, np.uint16)
        for lo in range(partition.lo, partition.hi, 1024):
            hi = min(partition.hi, lo + 1024)
            s, n = starts[lo:hi].astype(np.int64), lengths[lo:hi].astype(np.int64)
            ids = np.concatenate([data[a : a + k] for a, k in zip(s, n)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(lo, hi)), pa.array(kinds[lo:hi].astype(np.int8)), pa.array(s), lists], names=["row_idx", "kind", "start", "ids"])


class PackedSource(DataSource):
    """``spark.read.format("packed").option("path", ...)``; with ``flat_row`` the index isn't needed."""

    @classmethod
    def name(cls) -> str:
        return "packed"

    def schema(self) -> str:
        return _ROWS

    def reader(self, schema) -> PackedReader:
        return PackedReader(self.options)


def read(spark: SparkSession, path: str, *, partitions: int = 8) -> DataFrame:
    spark.dataSource.register(PackedSource)
    return spark.read.format("packed").option("path", path).option("partitions", partitions).load()


class Loader:
    """Batches [batch_size, seq_len] of unsigned 16-bit ids, in one process, from a memory map; can stop and go on.

    ``state()`` has the element (flat) or row (indexed) after the last batch that was handed out: going on repeats nothing.
    """

    num_workers = 1

    def __init__(self, path: str, *, indexed: bool, pad_id: int = 0):
        reader = PackedReader({"path": path, "flat_row": "0" if indexed else "1"})
        self.data = np.memmap(f"{path}.bin", np.uint16, "r")
        self.index = reader._index() if indexed else None
        self.pad_id, self.offset = pad_id, 0

    def state(self) -> dict[str, int]:
        return {"offset": self.offset}

    def restore(self, state: dict[str, int]) -> None:
        size = len(self.data) if self.index is None else len(self.index[0])
        if not 0 <= state["offset"] <= size:
            raise ValueError("the offset lies outside the data")
        self.offset = state["offset"]

    def batches(self, batch_size: int, seq_len: int, kinds: tuple[int, ...] | None = None) -> Iterator[np.ndarray]:
        if batch_size < 1 or seq_len < 1:
            raise ValueError("batch_size and seq_len must be at least 1")
        if self.index is None:
            size = batch_size * seq_len
            while self.offset < len(self.data):
                part = self.data[self.offset : self.offset + size]
                self.offset = min(len(self.data), self.offset + size)
                if len(part) < size:
                    part = np.concatenate([part, np.full(size - len(part), self.pad_id, np.uint16)])
                yield part.reshape(batch_size, seq_len)
            return
        starts, lengths, kind = self.index
        wanted = np.ones(len(kind), bool) if kinds is None else np.isin(kind, kinds)
        while (left := np.flatnonzero(wanted[self.offset :])[:batch_size] + self.offset).size:
            out = np.full((batch_size, seq_len), self.pad_id, np.uint16)
            for slot, i in enumerate(left):
                ids = self.data[int(starts[i]) : int(starts[i]) + min(int(lengths[i]), seq_len)]
                out[slot, : len(ids)] = ids
            self.offset = int(left[-1]) + 1
            yield out

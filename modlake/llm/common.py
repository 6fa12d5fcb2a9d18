"""Helpers that several operators share: table access, Arrow batches, output naming."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Folder of the tokenizer files; a parameter of every operator that needs one.
TOKENIZERS = "/opt/tokenizers"
#: Text bytes that one numpy step works on at most (one text may be longer).
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about ``limit`` text bytes each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    part = np.cumsum(sizes, dtype=np.int64) // limit
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, and the n + 1 offsets; null is empty."""
    filled = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = filled.buffers()
    ends = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if data is None or not len(filled):
        return np.zeros(0, np.uint8), ends - ends[0] if len(ends) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def gathered(column: pa.LargeBinaryArray) -> tuple[pa.Buffer, np.ndarray]:
    """All bytes of a column without nulls, and the n + 1 offsets."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    return (data or pa.py_buffer(b""))[ends[0] : ends[-1]], ends - ends[0]


def joined(values: pa.LargeBinaryArray, of: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """A row for each range between two ``ends``: the values that ``of`` numbers there, one after another."""
    data, edge = gathered(values.take(pa.array(of)))
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(edge[ends])), data])


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn`` turns each Arrow batch into a dict of columns; batches stay independent.

    ``fn`` may carry state for speed only (caches), so a lost task is simply run again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn()
        for batch in batches:
            out = work(batch)
            yield from [out] if isinstance(out, pa.RecordBatch) else out

    return df.mapInArrow(run, schema)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns whose names an operator is about to add (any letter case)."""
    taken = {n.lower() for n in names}
    return df.select([f"`{c}`" for c in df.columns if c.lower() not in taken])


def key_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names and types."""
    return df.selectExpr(f"cast(`{key}` as bigint) as doc_id", f"cast(`{text}` as string) as text")


def release(spark: SparkSession) -> None:
    """Let go of shuffle files that finished jobs left: Spark deletes them when the driver collects their handles."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def once(key: tuple, make: Callable):
    """A value made once in each worker process (vocabularies take seconds to load); ``key`` names all it depends on."""
    import sys
    import types

    held = sys.modules.setdefault("_modlake_values", types.ModuleType("_modlake_values")).__dict__.setdefault("held", {})
    if key not in held:
        held[key] = make()
    return held[key]


class Recent:
    """A bounded memory of values in two generations; what is asked for again survives."""

    def __init__(self, limit: int) -> None:
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value

"""Packing of documents into sequences of one capacity, by harmonic classes.

Piece lengths fall into reciprocal classes: class k holds pieces of capacity // k tokens, and each bin
of the class takes exactly k of them, so a bin needs a counter and no search.  A document (its ids and
an end id) is cut so that its pieces fit classes: whole sequences first (class 1), then again and again
the largest class size that fits the rest, while that is ``SMALLEST`` or more; what is left is cut
into powers of two, whose classes leave no gap at all.  Bins that a worker has not filled
at its end are undone: their pieces are cut into powers of two as well and form sequences
whose length is a power of two, which need no padding.  So only full bins are padded, by
capacity - k * (capacity // k), under ``capacity / SMALLEST`` tokens each.

Every worker packs its own documents, nothing is shuffled, and a worker holds only the pieces of
its open bins (one bin per class, each at most one sequence of ids).  Sequence ids are the
worker's number times 2 ** 40 plus a count, so a task that is run again gives the same rows.

Null and empty texts are documents of the end id alone.  Rows that repeat a doc_id, and rows
without one, are documents of their own; other columns are not read.  An empty table has no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.llm.common import TOKENIZERS, key_text, once, table
from modlake.llm.vocabulary import ByteIds

CAPACITY, SMALLEST, END_ID = 1024, 16, 0
#: Pieces of one Arrow batch.
ROWS = 4096
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def powers(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def cuts(n: int, capacity: int = CAPACITY, smallest: int = SMALLEST) -> list[int]:
    """Piece lengths of a document of n tokens, in order; each is a class size."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest >= max(smallest, 1):
        size = capacity // (capacity // (rest + 1) + 1)  # the largest capacity // k that fits
        out.append(size)
        rest -= size
    return out + powers(rest)


class Packer:
    """One worker's bins.  ``add`` and ``close`` yield finished pieces with their sequence and offset."""

    def __init__(self, first: int, capacity: int = CAPACITY, smallest: int = SMALLEST) -> None:
        if capacity < 1 or capacity & (capacity - 1):
            raise ValueError("the capacity must be a power of two")
        self.capacity, self.smallest, self.next = capacity, smallest, first
        self.open: dict[int, list[tuple]] = {}

    def _number(self) -> int:
        self.next += 1
        return self.next - 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        for size in cuts(len(ids), self.capacity, self.smallest):
            yield from self._put((doc_id, start, ids[start : start + size], len(ids)))
            start += size

    def _put(self, piece: tuple) -> Iterator[tuple]:
        size = len(piece[2])
        held = self.open.setdefault(size, [])
        held.append(piece)
        if len(held) == self.capacity // size:
            yield from self._sequence(held)
            del self.open[size]

    def _sequence(self, pieces: list[tuple]) -> Iterator[tuple]:
        number, offset = self._number(), 0
        for piece in pieces:
            yield *piece, number, offset
            offset += len(piece[2])

    def close(self) -> Iterator[tuple]:
        """The open bins: pieces cut into powers of two, then runs of a power of two pieces."""
        left, self.open = [p for held in self.open.values() for p in held], {}
        for doc_id, start, ids, total in left:
            for size in powers(len(ids)):
                yield from self._put((doc_id, start, ids[:size], total))
                start, ids = start + size, ids[size:]
        for held in self.open.values():
            for many in powers(len(held)):
                yield from self._sequence(held[:many])
                held = held[many:]
        self.open = {}


def pack(
    docs: DataFrame, tokenizer: str = f"{TOKENIZERS}/byte_bpe_50k.json", capacity: int = CAPACITY,
    end_id: int = END_ID, smallest: int = SMALLEST,
) -> DataFrame:
    """One row per piece: its document, place and ids there, its sequence and offset in it."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        doc, start, ids, total, number, offset = zip(*rows, strict=True)
        numbers = (start, [len(x) for x in ids])
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), *(pa.array(x, pa.int64()) for x in numbers),
             pa.array([x.tobytes() for x in ids], pa.binary()), *(pa.array(x, pa.int64()) for x in (total, number, offset))],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = once(("byte ids", tokenizer, True), lambda: ByteIds(tokenizer, special=True))
        packer, end = Packer(TaskContext.get().partitionId() << 40, capacity, smallest), np.array([end_id], "<u4")
        ready: list[tuple] = []
        for rows in batches:
            for doc_id, text in zip(rows.column(0), rows.column(1), strict=True):
                ids = np.concatenate([encode(text.as_py() or ""), end])
                for piece in packer.add(doc_id.as_py(), ids):
                    ready.append(piece)
                    if len(ready) >= ROWS:
                        yield batch(ready)
                        ready = []
        ready += packer.close()
        for i in range(0, len(ready), ROWS):
            yield batch(ready[i : i + ROWS])

    return key_text(docs).mapInArrow(work, SCHEMA)


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id, its tokens and its padding: up to the capacity, none at a power of two."""
    total = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.count("*").alias("pieces"))
    whole = F.bit_count("tokens") == 1
    return total.withColumn("padding", F.when(whole, F.lit(0)).otherwise(F.lit(capacity) - F.col("tokens")))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def check(rows: list[dict], documents: list[tuple[int | None, bytes]], capacity: int = CAPACITY) -> float:
    """For tests: every id lies in one piece, offsets are gapless; returns the share of padding."""
    by_seq: dict[int, list] = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = total = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    pieces: dict[int | None, list] = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for doc_id, ids in documents:  # documents of one id each
        at = 0
        for start, length, crc, tokens in sorted(pieces.pop(doc_id)):
            assert (start, tokens) == (at, len(ids) // 4)
            assert crc == zlib.crc32(ids[4 * at : 4 * (at + length)])
            at += length
        assert at == len(ids) // 4
    assert not pieces
    return padding / max(total + padding, 1)

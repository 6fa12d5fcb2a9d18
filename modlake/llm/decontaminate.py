"""Benchmark decontamination by the q-gram lemma.

Texts are folded (ASCII and Latin-1 letters to lower case, runs of other ASCII characters to
one space).  A region within k edits of an item of n folded bytes shares at least n + 1 - q (k + 1) of
its q-grams with it, all on diagonals (text position less item position) at most k apart.  Hits are counted
in overlapping diagonal bands; bands that reach the bound are verified by banded
alignment with free ends in the text.  ``k`` is ``budget`` times n, less where the
bound would fall under ``least`` shared q-grams.

The benchmark is the query set: its items are searched in all texts, in blocks of
bounded size, so that each broadcast index stays under ``block_bytes`` of item text.  Items with fewer
than q folded bytes have no q-gram and match nothing; null texts are empty; null item
texts are left out; items without an id match with a null item_id.  Rows that repeat a doc_id each give their matches.  There is no shuffle of texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.llm.common import key_text, slices, table, utf8

Q, BUDGET, LEAST = 10, 0.08, 8
BLOCK_BYTES = 8 << 20
SLICE = 1 << 20
STEP = 1 << 20  # alignment cells carry cost * STEP + start
SCHEMA = "doc_id bigint, item_id bigint, start bigint, end bigint, distance bigint, similarity double"


def fold_table() -> np.ndarray:
    """Folded byte of each byte: lower-case letters, digits and bytes over 127 stay, all else is a space."""
    out = np.full(256, 32, np.uint8)
    for b in range(256):
        if b > 127 or chr(b).isalnum():
            out[b] = ord(chr(b).lower()) if b < 128 else b
    return out


def folded(data: np.ndarray, ends: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, the source position of each, and where each row begins in them."""
    out = fold[data]
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[upper] += 0x20
    blank = out == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    at = np.flatnonzero(keep)
    return out[at], at, np.searchsorted(at, ends)


def q_grams(text: np.ndarray, q: int) -> np.ndarray:
    """A number for every q bytes: a polynomial, so equal q-grams have equal numbers."""
    n = len(text) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = 0x100000001B3
    out, done, left = np.zeros(n, np.uint64), 0, q
    block, width, factor = text.astype(np.uint64) + np.uint64(1), 1, base
    while left:
        if left & 1:
            out = out * np.uint64(factor) + block[done : done + n]
            done += width
        left >>= 1
        if left:
            block = block[: len(block) - width] * np.uint64(factor) + block[width:]
            width, factor = width * 2, factor * factor % (1 << 64)
    return out


def hashed(grams: np.ndarray, bits: int) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def index_of(items: list[tuple[int | None, str]], q: int = Q, budget: float = BUDGET, least: int = LEAST) -> dict:
    """Sorted q-grams of the items with their places, and each item's edit budget and bound."""
    fold, texts, ids = fold_table(), [], []
    for item_id, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        own = folded(raw, np.array([0, len(raw)]), fold)[0]
        own = own[1:] if len(own) and own[0] == 32 else own
        own = own[:-1] if len(own) and own[-1] == 32 else own
        if len(own) >= q:
            texts.append(own)
            ids.append(item_id)
    size = np.array([len(t) for t in texts], np.int64)
    k = np.maximum(0, np.minimum((budget * size).astype(np.int64), (size + 1 - least) // q - 1))
    bound = np.maximum(1, size + 1 - q * (k + 1))
    grams = [q_grams(t, q) for t in texts]
    key = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
    place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
    order = np.argsort(key, kind="stable")
    unique, first = np.unique(key[order], return_index=True)
    bits = int(np.clip(np.ceil(np.log2(max(len(unique), 1))) + 6, 16, 26))
    seen = np.zeros(1 << bits, bool)
    seen[hashed(unique, bits)] = True
    return {
        "ids": np.array([i or 0 for i in ids], np.int64), "unnamed": np.array([i is None for i in ids], bool),
        "size": size, "k": k, "bound": bound, "q": q, "bits": bits, "seen": seen,
        "text": np.concatenate(texts) if texts else np.zeros(0, np.uint8), "begin": np.cumsum(size) - size,
        "key": unique, "first": np.append(first, len(order)), "item": item[order], "place": place[order],
    }


def candidates(text: np.ndarray, begins: np.ndarray, index: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, item and lowest diagonal of every band whose shared q-grams reach the bound."""
    none = (np.zeros(0, np.int64),) * 3
    if not len(index["key"]):
        return none
    grams = q_grams(text, index["q"])
    at = np.flatnonzero(index["seen"][hashed(grams, index["bits"])])
    found = np.minimum(np.searchsorted(index["key"], grams[at]), len(index["key"]) - 1)
    same = index["key"][found] == grams[at]
    at, found = at[same], found[same]
    row = np.searchsorted(begins, at, side="right") - 1
    inside = at + index["q"] <= begins[row + 1]
    at, found, row = at[inside], found[inside], row[inside]
    lo, n = index["first"][found], index["first"][found + 1] - index["first"][found]
    if not n.sum():
        return none
    posting = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    row, at = np.repeat(row, n), np.repeat(at, n)
    item, diagonal = index["item"][posting], at - begins[row] - index["place"][posting]
    # Most pairs of row and item have too few hits in all: drop them before banding.
    pair = row * len(index["ids"]) + item
    kinds, of, total = np.unique(pair, return_inverse=True, return_counts=True)
    enough = total[of] >= index["bound"][item]
    row, item, diagonal = row[enough], item[enough], diagonal[enough]
    k = index["k"][item]
    band = (diagonal + (1 << 40)) // (k + 1)
    row, item = np.concatenate([row, row]), np.concatenate([item, item])
    key = np.stack([row, item, np.concatenate([band, band - 1])])
    kinds, total = np.unique(key, axis=1, return_counts=True)
    good = total >= index["bound"][kinds[1]]
    row, item, band = kinds[:, good]
    return row, item, band * (index["k"][item] + 1) - (1 << 40)


def align(text: np.ndarray, begins: np.ndarray, row: np.ndarray, item: np.ndarray, low: np.ndarray, index: dict):
    """Distance, start and end (in the row's folded text) of the best alignment in each band."""
    k, size = index["k"][item], index["size"][item]
    width = int((4 * k + 3).max())
    offset = low - k  # leftmost diagonal of the band: k of slack on both sides of 2 k + 2 diagonals
    inside = np.arange(width)[None, :] <= (4 * k + 2)[:, None]
    start, stop = begins[row], begins[row + 1]
    huge = np.int64(1) << 50
    steps = np.arange(width, dtype=np.int64) * STEP
    cell = np.where(inside, np.arange(width, dtype=np.int64)[None, :], huge)
    out = np.full(len(row), huge)
    end_at = np.zeros(len(row), np.int64)
    padded = np.append(text, np.uint8(0))
    for i in range(int(size.max(initial=0))):
        place = start[:, None] + (offset + i)[:, None] + np.arange(width)[None, :]
        fits = (place >= start[:, None]) & (place < stop[:, None])
        letters = padded[np.where(fits, place, len(text))]
        # Past an item's end the letter is another item's; its result is taken by then.
        own = index["text"][np.minimum(index["begin"][item] + i, len(index["text"]) - 1)]
        change = np.where((letters == own[:, None]) & fits, 0, STEP)
        over = np.concatenate([cell[:, 1:], np.full((len(row), 1), huge)], axis=1) + STEP
        fresh = np.where(inside, np.minimum(cell + change, over), huge)
        cell = np.minimum.accumulate(fresh - steps, axis=1) + steps
        cell = np.where(inside, np.minimum(cell, huge), huge)
        done = np.flatnonzero(size == i + 1)
        if len(done):
            best = cell[done].argmin(axis=1)
            out[done], end_at[done] = cell[done, best], offset[done] + i + 1 + best
    return out // STEP, offset + out % STEP, end_at


def matches(part: pa.RecordBatch, column: str, index: dict, fold: np.ndarray):
    """Row, item, start, end (code points) and distance of the best region of each row and item."""
    data, ends = utf8(part.column(column))
    text, source, begins = folded(data, ends, fold)
    row, item, low = candidates(text, begins, index)
    if not len(row):
        return (np.zeros(0, np.int64),) * 5
    by_size = np.argsort(index["size"][item], kind="stable")  # so that a long item delays few others
    row, item, low = row[by_size], item[by_size], low[by_size]
    distance, start, end = (np.concatenate(x) for x in zip(*(
        align(text, begins, row[a : a + 512], item[a : a + 512], low[a : a + 512], index) for a in range(0, len(row), 512)
    ), strict=True))
    order = np.lexsort((start, distance, item, row))
    order = order[distance[order] <= index["k"][item[order]]]
    first = np.ones(len(order), bool)
    first[1:] = (row[order][1:] != row[order][:-1]) | (item[order][1:] != item[order][:-1])
    pick = order[first]
    row, item, start, end = row[pick], item[pick], np.maximum(start[pick], 0), end[pick]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    base = begins[row]
    stop = begins[row + 1]
    first_byte = source[np.minimum(base + start, stop - 1)]
    last_byte = source[np.clip(base + end - 1, base, stop - 1)] + 1
    origin = points[ends[row]]
    return row, item, points[first_byte] - origin, points[last_byte] - origin, distance[pick]


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``block_bytes`` of text each."""
    items = benchmark.selectExpr("cast(item_id as bigint) as item_id", "cast(text as string) as text").filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield sorted(((r.item_id, r.text) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def search(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, **how) -> DataFrame:
    """doc_id, item_id, region (code points, end exclusive), distance and similarity of every match."""
    spark, found = docs.sparkSession, None
    for items in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(index_of(items, **how))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, fold = shared.value, fold_table()
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    row, item, start, end, d = matches(part, "text", index, fold)
                    if len(row):
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(row)), pa.array(index["ids"][item], mask=index["unnamed"][item]),
                             pa.array(start), pa.array(end), pa.array(d), pa.array(1 - d / index["size"][item])],
                            names=["doc_id", "item_id", "start", "end", "distance", "similarity"],
                        )

        own = key_text(docs).mapInArrow(work, SCHEMA)
        found = own if found is None else found.unionAll(own)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, **how) -> DataFrame:
    """The rows of ``docs`` without a match, all columns as they are."""
    spark, kept = docs.sparkSession, docs
    for items in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast(index_of(items, **how))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, fold = shared.value, fold_table()
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    good = np.ones(part.num_rows, bool)
                    good[matches(part, "text", index, fold)[0]] = False
                    yield part.filter(pa.array(good))

        kept = kept.mapInArrow(work, docs.schema)
    return kept


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""Token ids of documents in seekable files of independent zstandard frames.

File layout: frames one after another, each the ids (little-endian unsigned 32-bit
integers) of some consecutive documents; then one skippable frame with the seek table:
a record per document (doc_id, frame, ids before it in the frame, ids) and a record per
frame (offset, stored bytes, raw bytes, crc32 of the raw bytes), their counts, a crc32 of
the table and a closing magic number.  A reader fetches the tail, then only the frames it needs.

Documents are dealt out by ranges of doc_id and sorted, so file numbers follow doc_id.
A task writes to a name of its own and moves the file into place when it is whole, so a task that
is run again replaces its file.  Files go to the shared folder of ``spark.checkpoint.dir``.

Null texts are empty and still get the end id; rows that repeat a doc_id stay, in the
order of their text's digest; null ids come first.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modlake.llm.bpe import byte_letters
from modlake.llm.common import TOKENIZERS, Recent, joined, key_text, slices, table
from modlake.session import scratch_folder

#: Raw bytes after which a frame is closed.
FRAME_BYTES = 1 << 20
#: White-space-separated strings a worker remembers.
CACHE_WORDS = 500_000
#: Text bytes that are encoded in one step at most (one text may be longer).
SLICE = 8 << 20
SKIPPABLE, MAGIC = 0x184D2A5E, 0x5A544944
DOC, FRAME, FOOT = "<qIII", "<QIII", "<IIII"


class Encoder:
    """Ids of a text by the tokenizer file, through a cache of the strings between white space.

    The tokenizer drops white space and never looks across it, so a text's ids are those
    of its strings in order.  Texts with special strings or control characters, where
    this may not hold, are encoded whole.
    """

    def __init__(self, path: str, end_id: int) -> None:
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known = Recent(CACHE_WORDS)
        self.end = np.array([end_id], "<u4").tobytes()
        self.model = self.tokenizer.model
        self.letters = {b: c for c, b in byte_letters().items()}
        #: Lower-case Latin letters that normalisation leaves alone, and perhaps a mark after them.
        self.plain = re.compile("([a-z\u00df-\u00f6\u00f8-\u017f]+)([.,])?")
        self.special = re.compile(
            "|".join([r"[\x00-\x08\x0e-\x1f\x7f-\x9f\u0130\u03a3\u0300-\u036f\u180e\u200b-\u200f\ufeff]"]
                     + [re.escape(str(t)) for t in self.tokenizer.get_added_tokens_decoder().values()
                        for t in [t.content]])
        )

    def encode(self, text: str) -> bytes:
        if self.special.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes() + self.end
        known, words = self.known, text.lower().split()
        ids = list(map(known.new.get, words))
        if None in ids:
            ids = [i or known.get(w) or self.word(w) for i, w in zip(ids, words, strict=True)]
        return b"".join(ids) + self.end

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` of every text; each different string of them is looked up once."""
        odd = [i for i, t in enumerate(texts) if self.special.search(t)]
        words = pc.utf8_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
        flat, known = words.flatten().dictionary_encode(), self.known
        found = flat.dictionary.to_pylist()
        ids = list(map(known.new.get, found))
        if None in ids:
            ids = [i or known.get(w) or self.word(w) for i, w in zip(ids, found, strict=True)]
        rows = joined(pa.array(ids, pa.large_binary()), flat.indices.to_numpy(), words.offsets.to_numpy())
        out = [x + self.end for x in rows.to_pylist()]
        for i in odd:
            out[i] = self.encode(texts[i])
        return out

    def word(self, word: str) -> bytes:
        """Ids of one string without white space; letters and a closing mark are two parts of it."""
        plain = self.plain.fullmatch(word)
        if not plain:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        elif plain[2]:
            ids = (self.known.get(plain[1]) or self.word(plain[1])) + (self.known.get(plain[2]) or self.word(plain[2]))
        else:
            # The tokenizer's own model, on the letters that stand for the word's bytes.
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        self.known.put(word, ids)
        return ids


def _fs(folder: str):
    """A file system for a folder's address, and the folder's path in it."""
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri("file://" + folder.removeprefix("file:").removeprefix("//")
                                  if folder.startswith("file:") else folder)


def write_file(folder: str, name: str, rows: Iterator[tuple[int, bytes]], frame_bytes: int = FRAME_BYTES) -> tuple[int, int]:
    """Write one file; returns its documents and ids.  Holds one frame in memory."""
    import zstandard

    files, path = _fs(folder)
    files.create_dir(path, recursive=True)
    packer = zstandard.ZstdCompressor(level=3)
    docs, frames, held, size, at, total = [], [], [], 0, 0, 0
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:

        def close() -> None:
            nonlocal held, size, at
            raw = b"".join(held)
            data = packer.compress(raw)
            out.write(data)
            frames.append(struct.pack(FRAME, at, len(data), len(raw), zlib.crc32(raw)))
            at, held, size = at + len(data), [], 0

        for doc_id, ids in rows:
            docs.append(struct.pack(DOC, doc_id, len(frames), size // 4, len(ids) // 4))
            held.append(ids)
            size += len(ids)
            total += len(ids) // 4
            if size >= frame_bytes:
                close()
        if held:
            close()
        tab = b"".join(docs + frames)
        tab += struct.pack(FOOT, len(docs), len(frames), zlib.crc32(tab), MAGIC)
        out.write(struct.pack("<II", SKIPPABLE, len(tab)) + tab)
    files.move(part, f"{path}/{name}")
    return len(docs), total


def seek_table(source, size: int) -> tuple[list[tuple], list[tuple]]:
    """Document and frame records of an open file, checked."""
    source.seek(size - struct.calcsize(FOOT))
    n_docs, n_frames, crc, magic = struct.unpack(FOOT, source.read(struct.calcsize(FOOT)))
    body = n_docs * struct.calcsize(DOC) + n_frames * struct.calcsize(FRAME)
    if magic != MAGIC:
        raise ValueError("no seek table")
    source.seek(size - struct.calcsize(FOOT) - body)
    tab = source.read(body)
    if zlib.crc32(tab) != crc:
        raise ValueError("damaged seek table")
    cut = n_docs * struct.calcsize(DOC)
    return list(struct.iter_unpack(DOC, tab[:cut])), list(struct.iter_unpack(FRAME, tab[cut:]))


def read_file(folder: str, name: str, wanted: set[int] | None = None) -> Iterator[tuple[int, bytes]]:
    """(doc_id, ids) in file order; with ``wanted`` only the frames that hold those are read."""
    import zstandard

    files, path = _fs(folder)
    size = files.get_file_info(f"{path}/{name}").size
    with files.open_input_file(f"{path}/{name}") as source:
        docs, frames = seek_table(source, size)
        open_frame, raw = -1, b""
        for doc_id, frame, first, n in docs:
            if wanted is not None and doc_id not in wanted:
                continue
            if frame != open_frame:
                at, stored, length, crc = frames[frame]
                source.seek(at)
                raw = zstandard.ZstdDecompressor().decompress(source.read(stored), max_output_size=length)
                if zlib.crc32(raw) != crc:
                    raise ValueError(f"{name}: damaged frame {frame}")
                open_frame = frame
            yield doc_id, raw[4 * first : 4 * (first + n)]


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write all documents; one row per file: name, number, documents, ids."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        name = f"ids-{number:06d}.zst"
        encoder = Encoder(tokenizer, end_id)

        def rows() -> Iterator[tuple[int, bytes]]:
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    keys = pc.fill_null(part.column(0), -(1 << 63)).to_pylist()
                    yield from zip(keys, encoder.encode_all([t or "" for t in part.column(1).to_pylist()]), strict=True)

        n, total = write_file(folder, name, rows())
        yield pa.RecordBatch.from_pydict({"name": [name], "number": [number], "docs": [n], "ids": [total]})

    dealt = key_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return dealt.mapInArrow(store, "name string, number bigint, docs bigint, ids bigint")


def read(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, ids before it in all files, and ids, from the files listed (name, number, ids)."""
    order = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.select("name", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("before"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held, size = [], 0
                for doc_id, ids in read_file(folder, name):
                    held.append((None if doc_id == -(1 << 63) else doc_id, before, ids))
                    before += len(ids) // 4
                    size += len(ids)
                    if size > (4 << 20):
                        yield _rows(held)
                        held, size = [], 0
                if held:
                    yield _rows(held)

    n = max(1, files.sparkSession.sparkContext.defaultParallelism)
    return listed.repartition(n, "name").mapInArrow(work, "doc_id bigint, start bigint, ids binary")


def _rows(held: list[tuple]) -> pa.RecordBatch:
    a, b, c = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], names=["doc_id", "start", "ids"]
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "ids")
    files = write(table(spark, sf_dir, "documents"), f"{folder}/data", f"{TOKENIZERS}/word_bpe_49k.json")
    files.write.parquet(f"{folder}/list")
    return read(spark.read.parquet(f"{folder}/list"), f"{folder}/data").selectExpr(
        "doc_id", "start", "cast(octet_length(ids) / 4 as bigint) as n_tokens", "crc32(ids) as ids_crc32"
    )

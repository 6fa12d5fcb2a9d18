"""Exact byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word the last token of its encoding is unique.  It is the token
that ends there, whose own start is a solved prefix, and that is compatible with that
prefix's last token: merging the two alone gives the two back.  A trie automaton lists
the tokens that end at a position, back-pointers then give the ids.

Null is encoded as the empty text.  Every input row gives one row; empty texts give no
ids.  Words repeat, so each worker keeps the ids of words it has met (a bounded cache,
for speed only), and texts are cut at blanks where a word must end: each different string of
some megabytes of text is looked up once.  No shuffle: one text is one row's work.
"""

from __future__ import annotations

import hashlib
import json

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from modlake.llm.common import TOKENIZERS, Recent, gathered, joined, key_text, map_arrow, slices, table

#: Words a worker remembers, and strings between blanks.
CACHE_WORDS, CACHE_STRINGS = 400_000, 100_000
#: Text bytes that are encoded in one step at most (one text may be longer).
SLICE = 4 << 20
#: The published word pattern of byte-level vocabularies.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """A byte-level vocabulary with its merges."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        special = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
        self.bytes_of: dict[int, bytes] = {i: t.encode() for t, i in special.items()}
        for token, i in data["model"]["vocab"].items():
            if token not in special:
                self.bytes_of[i] = bytes(letters[c] for c in token)
        self.id_of = {b: i for i, b in self.bytes_of.items() if b.decode("utf-8", "ignore") not in special}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"])
        self.rank = {
            (bytes(letters[c] for c in a), bytes(letters[c] for c in b)): n for n, (a, b) in enumerate(pairs)
        }
        #: How each token is merged; only if there is one way.
        self.parts = {a + b: (n, a, b) for (a, b), n in self.rank.items()}
        self.one_way = len(self.parts) == len(self.rank) and all(len(x) > 1 for x in self.parts)
        self.wholes: dict[bytes, bool] = {}
        self.ends = ahocorasick.Automaton()
        for token in self.id_of:
            self.ends.add_word(token.decode("latin-1"), token)
        self.ends.make_automaton()
        self.words = regex.compile(WORDS)
        self.special = special
        self.cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.known, self.strings = Recent(CACHE_WORDS), Recent(CACHE_STRINGS)
        self.tokens = pa.array([self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)], pa.large_binary())
        self.unused = np.array([i not in self.bytes_of for i in range(len(self.tokens))])

    def merged(self, text: bytes) -> list[bytes]:
        """Plain merging by rank, for the pair test on two tokens only."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            a, b = parts[best], parts[best + 1]
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == a and parts[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def whole(self, token: bytes) -> bool:
        """Does merging the token's bytes give the token?"""
        ok = self.wholes.get(token)
        if ok is None:
            ok = self.wholes[token] = self.merged(token) == [token]
        return ok

    def apart(self, a: bytes, b: bytes) -> bool:
        """Does merging ``a + b`` give the two tokens, each of which its own bytes give?

        The merges that made the two are taken back, the last first: none may come later than
        a merge across the cut that was possible by then.
        """
        first, none = len(self.rank), (-1, b"", b"")
        while True:
            rank = self.rank.get((a, b))
            if rank is not None and rank < first:
                return False
            left, right = self.parts.get(a, none), self.parts.get(b, none)
            if left[0] > right[0]:
                first, a = left[0], left[2]
            elif right[0] >= 0:  # of equal merges the one across the cut is further left
                first, b = right[0] + 1, right[1]
            else:
                return True

    def compatible(self, a: bytes, b: bytes) -> bool:
        ok = self.fits.get((a, b))
        if ok is None:
            if len(self.fits) > 4 * CACHE_WORDS:
                self.fits.clear()
            if self.one_way:
                ok = self.whole(a) and self.whole(b) and self.apart(a, b)
            else:
                ok = self.merged(a + b) == [a, b]
            self.fits[a, b] = ok
        return ok

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one word by the unique last token of every prefix."""
        if word in self.id_of and self.whole(word):
            return [self.id_of[word]]
        last: list[bytes | None] = [b""] + [None] * len(word)
        fits = self.fits
        for end, token in self.ends.iter(word.decode("latin-1")):  # by end, the longest first
            if last[end + 1] is None:
                before = last[end + 1 - len(token)]
                if before is not None and (not before or fits.get((before, token)) or self.compatible(before, token)):
                    last[end + 1] = token
        out, at = [], len(word)
        while at:
            out.append(self.id_of[last[at]])
            at -= len(last[at])
        return out[::-1]

    def plain_ids(self, text: str) -> bytes:
        known, words = self.known, self.words.findall(text)
        parts = list(map(known.new.get, words))
        if None in parts:
            for i, ids in enumerate(parts):
                if ids is None:
                    ids = known.get(words[i])
                    if ids is None:
                        ids = np.array(self.encode_word(words[i].encode()), "<u4").tobytes()
                        known.put(words[i], ids)
                    parts[i] = ids
        return b"".join(parts)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special strings are one id each."""
        if not self.cut or not self.cut.search(text):
            return self.plain_ids(text)
        parts, at = [], 0
        for m in self.cut.finditer(text):
            parts += [self.plain_ids(text[at : m.start()]), np.uint32(self.special[m.group()]).tobytes()]
            at = m.end()
        return b"".join([*parts, self.plain_ids(text[at:])])

    def encode_all(self, texts: list[str]) -> pa.LargeBinaryArray:
        """``encode`` of every text, by the different strings between blanks.

        No word goes on from other characters to white space, and white space leaves its last
        character to what follows: a word ends before every blank that has no white space on one side.
        """
        pieces = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        ends, flat = pieces.offsets.to_numpy(), pieces.flatten().dictionary_encode()
        found, of = flat.dictionary.to_pylist(), flat.indices.to_numpy().copy()
        opens = np.fromiter((not x or x[0].isspace() for x in found), bool, len(found))
        closes = np.fromiter((not x or x[-1].isspace() for x in found), bool, len(found))
        inside = closes[of[:-1]] & opens[of[1:]]
        inside[ends[1:-1] - 1] = False  # between two texts
        odd = set(np.searchsorted(ends, np.flatnonzero(inside), "right") - 1)
        if self.cut:
            odd.update(i for i, t in enumerate(texts) if any(x in t for x in self.special))
        # The string that begins a text has no blank before it.
        heads = [found[i] for i in of[ends[:-1]].tolist()]
        of[ends[:-1]] = len(found) + np.arange(len(heads))
        strings, held = [" " + x for x in found] + heads, self.strings
        ids = list(map(held.new.get, strings))
        for i, x in enumerate(ids):
            if x is None:
                ids[i] = held.get(strings[i])
                if ids[i] is None:
                    ids[i] = self.plain_ids(strings[i])
                    held.put(strings[i], ids[i])
        out = joined(pa.array(ids, pa.large_binary()), of, ends)
        if not odd:
            return out
        rows = out.to_pylist()
        for i in odd:
            rows[i] = self.encode(texts[i])
        return pa.array(rows, pa.large_binary())

    def decode_all(self, ids: pa.LargeBinaryArray) -> list[str]:
        """``decode`` of every row."""
        data, ends = gathered(ids)
        number = np.frombuffer(data, "<u4")
        if len(number) and (number.max() >= len(self.unused) or self.unused[number].any()):
            raise KeyError("an id that the vocabulary does not have")
        return [b.decode("utf-8", "replace") for b in joined(self.tokens, number, ends // 4).to_pylist()]

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.decode("utf-8", "replace")


def encode(docs: DataFrame, path: str = f"{TOKENIZERS}/byte_bpe_50k.json") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers), n_tokens and decoded text digest."""

    def start():
        codec = Codec(path)

        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for part in slices(batch, "text", SLICE):
                ids = codec.encode_all([t or "" for t in part.column(1).to_pylist()])
                back = [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in codec.decode_all(ids)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pc.divide(pc.binary_length(ids), 4), ids.cast(pa.binary()), pa.array(back, pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded_sha256"],
                )

        return work

    return map_arrow(key_text(docs), start, "doc_id bigint, n_tokens bigint, ids binary, decoded_sha256 string")


def decode(encoded: DataFrame, path: str = f"{TOKENIZERS}/byte_bpe_50k.json") -> DataFrame:
    """doc_id and text from rows of ``encode``; null ids are the empty text."""

    def start():
        codec = Codec(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [codec.decode(i or b"") for i in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

        return work

    return map_arrow(encoded.select("doc_id", "ids"), start, "doc_id bigint, text string")


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "n_tokens", "sha2(ids, 256) as ids_sha256", "decoded_sha256"
    )

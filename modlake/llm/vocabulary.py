"""Byte-level ids of whole texts at speed, with a linear way for very long strings.

Ids come from the tiktoken library with the vocabulary, merges and word pattern of a tokenizer file;
its merging is quadratic in one word, so texts with a run of ``LONG`` characters with or without
white space go through the prefix programme of ``bpe`` (the same ids, linear).
"""

from __future__ import annotations

import re

import numpy as np

from modlake.llm.bpe import WORDS, Codec

LONG = 1000


class ByteIds:
    """Encoder of one tokenizer file.  ``special``: its special strings inside texts are one id each."""

    def __init__(self, path: str, special: bool) -> None:
        import tiktoken

        self.codec = Codec(path)
        ranks = self.codec.id_of
        merged = [ranks[a + b] for a, b in self.codec.rank]  # in merge order
        if any(x >= y for x, y in zip(merged, merged[1:], strict=False)):
            raise ValueError(f"{path}: token ids do not follow the order of merges")
        self.special = self.codec.special if special else {}
        self.library = tiktoken.Encoding(
            "own", pat_str=WORDS, mergeable_ranks=dict(ranks), special_tokens=self.special
        )
        self.run = re.compile(rf"\S{{{LONG}}}|\s{{{LONG}}}")

    def long(self, text: str) -> bool:
        """Is there a run of ``LONG`` characters?  Most texts are ruled out by the places of their ASCII blanks."""
        data = np.frombuffer(text.encode(), np.uint8)
        at = np.flatnonzero(data < 128)
        blank = data[at] <= 32
        edges = at[1:][blank[1:] != blank[:-1]]
        return bool(np.diff(edges, prepend=0, append=len(data)).max() >= LONG and self.run.search(text))

    def __call__(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit integers."""
        if len(text) >= LONG and self.long(text):
            raw = self.codec.encode(text) if self.special else self.codec.plain_ids(text)
            return np.frombuffer(raw, "<u4")
        return self.library.encode_to_numpy(text, allowed_special="all")

    def sizes(self) -> np.ndarray:
        """Bytes of every token, by id."""
        out = np.zeros(max(self.codec.bytes_of) + 1, np.int64)
        for i, b in self.codec.bytes_of.items():
            out[i] = len(b)
        return out

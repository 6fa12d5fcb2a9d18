"""Secret scan: credential patterns and a token-efficiency test for random strings.

A language model's vocabulary packs prose into few tokens and random strings into
many, so a long string with few characters per token is likely to be a credential.
Known digests and identifiers are no secrets and are left out of that test.

Null and empty texts have no spans; every row of the input gives one row, so repeated
rows repeat.  The scan needs no shuffle: one text is one row's work.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from modlake.llm.common import TOKENIZERS, key_text, map_arrow, table

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?a:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: A candidate of the token-efficiency test.
LONG = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Lengths of published digests written in hexadecimal.
DIGESTS = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Names, paths, dates and numbers: parts that are all letters or all digits.
IDENTIFIER = re.compile(r"[+/_=-]*(?:(?:[A-Za-z]+|[0-9]+)(?:[+/_=-]+|$))*")
#: A word with a number after it, such as a version or a serial name.
NUMBERED = re.compile(r"[A-Za-z]+[0-9]{1,6}")

SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, "
    "base_spans array<struct<kind:string,start:int,end:int>>, "
    "spans array<struct<kind:string,start:int,end:int>>"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the credential patterns, in output order."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def is_known(word: str) -> bool:
    """Digests, UUIDs and identifiers are not candidates."""
    return bool(
        DIGESTS.fullmatch(word) or UUID.fullmatch(word) or IDENTIFIER.fullmatch(word)
        or all(NUMBERED.fullmatch(p) or p.isalpha() or p.isdigit() for p in re.split(r"[+/_=-]+", word) if p)
    )


def random_spans(text: str, encode, ratio: float, taken) -> list[tuple[int, int, int]]:
    """Long strings of at most ``ratio`` characters per token that no base span touches."""
    found = []
    for m in LONG.finditer(text):
        word = m.group()
        if is_known(word) or any(a < m.end() and m.start() < b for a, _, b in taken):
            continue
        if len(word) <= ratio * len(encode(word)):
            found.append((m.start(), 3, m.end()))
    return found


def tokenizer(folder: str):
    """A byte-pair encoder over a vocabulary file of ranks."""
    import tiktoken

    with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    words = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("ranks", pat_str=words, mergeable_ranks=ranks, special_tokens={})


def scan(docs: DataFrame, folder: str = TOKENIZERS, ratio: float = 1.8) -> DataFrame:
    """One row per document with all spans; offsets are code points, ends exclusive."""

    def start():
        encode = tokenizer(folder).encode_ordinary

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, base, spans = [], [], []
            for text in batch.column(1).to_pylist():
                own = base_spans(text or "")
                extra = random_spans(text or "", encode, ratio, own)
                counts.append([sum(k == n for _, k, _ in own) for n in range(3)] + [len(extra)])
                base.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in own])
                spans.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(own + extra)])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([c[n] for c in counts], pa.int64()) for n in range(4)),
                 pa.array(base, kind), pa.array(spans, kind)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans"],
            )

        return work

    return map_arrow(key_text(docs), start, SCHEMA)


def joined(column: str) -> str:
    """SQL of ``kind:start:end`` items in order, comma-joined."""
    return f"array_join(transform({column}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "n_assign", "n_access", "n_hex",
        f"sha2({joined('base_spans')}, 256) as base_sha256",
        f"{joined('spans')} as spans", "n_random",
    )


def digest(items: list[tuple[int, int, int]]) -> str:
    """The base digest of one text, for tests."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in items).encode()).hexdigest()

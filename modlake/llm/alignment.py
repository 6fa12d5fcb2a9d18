"""Alignment of two tokenizers' ids over a corpus, by inverted pair bitmaps.

A text is encoded by a byte-level vocabulary (A, on a space and the text) and a sentence-piece
vocabulary (B, which adds that space itself).  Byte offsets where tokens of both end cut the tokens
into groups; every A and B token of one group are linked.  For each id pair and block of
consecutive documents a posting is written: a compressed bitmap of the block's documents that hold the pair (a sorted
array of 16-bit places, or bits where those are shorter), and multiplicity planes: plane j has bit j of
(links - 1) of each of these documents.  Counts by document are sums of the bitmaps'
bits over blocks, link counts come from the planes.  Postings then carry the counts of their pair back to
their block, where they add up to scores per document.

A block has at most ``BLOCK`` documents and about ``ENTRIES`` distinct pairs, so each bitmap is whole when
it is written; a pair in every document has one bounded row per block.  Blocks are numbered by the
task that reads them, rows stay single even if they repeat a doc_id or have none.

A text that is null or empty, or whose joined bytes of A or B differ from a space and the text (B
normalises some texts), has no tokens: zeros and an empty digest column.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.llm.common import TOKENIZERS, key_text, once, table
from modlake.llm.vocabulary import ByteIds
from modlake.session import scratch_folder

#: Documents and distinct (document, pair) entries after which a block is closed.
BLOCK, ENTRIES = 4096, 1 << 21
#: Links of one document that are listed one by one; beyond, equal ids of a group are counted first.
LISTED = 1 << 20
B_BITS = 16
DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
SCHEMA = f"kind int, block bigint, place int, {DOC}, pair bigint, n bigint, links bigint, docs binary, planes binary"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


class Pieces:
    """The sentence-piece vocabulary: ids of a text, and the bytes of every id."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = [self._bytes(i) for i in range(self.model.get_piece_size())]
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


class Aligner:
    """Groups and links of one text."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteIds(path_a, special=False), Pieces(path_b)
        if len(self.b.bytes_of) > 1 << B_BITS:
            raise ValueError(f"{path_b}: more ids than fit in {B_BITS} bits")
        self.size_a = self.a.sizes()
        n = max(len(self.size_a), len(self.b.bytes_of))
        #: Each id as text, with each separator that can follow it.
        self.spelled = {s: np.array([f"{i}{s}" for i in range(n)], object) for s in ",|;"}

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, if their bytes are those of a space and the text."""
        if not text:
            return None
        data = b" " + text.encode()
        b = self.b(text)
        if b"".join(map(self.b.bytes_of.__getitem__, b.tolist())) != data:
            return None
        a = self.a(" " + text).astype(np.int64)
        # Byte-level ids of well-formed text give its bytes back.
        return (a, b) if int(self.size_a[a].sum()) == len(data) else None

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The group of every A token and of every B token."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.b.sizes[b])
        cut = np.zeros(int(ends_a[-1]) + 1, np.int8)
        cut[ends_a] = 1
        cut[ends_b] += cut[ends_b]  # 2 where both end
        lasts = cut[ends_a] == 2, cut[ends_b] == 2
        return np.cumsum(lasts[0]) - lasts[0], np.cumsum(lasts[1]) - lasts[1]

    def digest(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> str:
        """Hex digest of ``a1,a2|b1;a3|b2,b3``."""
        n = int(of_a[-1]) + 1
        in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        out = np.empty(len(a) + len(b), object)
        spot_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[of_a]
        spot_b = np.arange(len(b)) + np.cumsum(in_a)[of_b]
        out[spot_a] = self.spelled[","][a]
        out[spot_b] = self.spelled[","][b]
        last_a, last_b = np.cumsum(in_a) - 1, np.cumsum(in_b) - 1
        out[spot_a[last_a]] = self.spelled["|"][a[last_a]]
        out[spot_b[last_b]] = self.spelled[";"][b[last_b]]
        return hashlib.sha256("".join(out.tolist())[:-1].encode()).hexdigest()

    def links(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Distinct pairs (A id, then B id in the low bits) with their link counts, and the number of links."""
        n = int(of_a[-1]) + 1
        in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        total = int(in_a @ in_b)
        if total <= LISTED:
            return *self._crossed(a, np.ones(len(a), np.int64), of_a, b, np.ones(len(b), np.int64), of_b), total
        # Long groups: equal ids of one group are one entry, and a slice of the groups is crossed at a time.
        (a, na, of_a), (b, nb, of_b) = (_counted(i, g) for i, g in ((a, of_a), (b, of_b)))
        work = np.bincount(of_a, minlength=n) * np.bincount(of_b, minlength=n)
        part = np.cumsum(work) // LISTED
        found = []
        for p in np.unique(part):
            low, high = np.searchsorted(part, [p, p + 1])
            sa, sb = (slice(*np.searchsorted(g, [low, high])) for g in (of_a, of_b))
            found.append(self._crossed(a[sa], na[sa], of_a[sa] - low, b[sb], nb[sb], of_b[sb] - low))
        return *_summed(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])), total

    @staticmethod
    def _crossed(a, na, of_a, b, nb, of_b) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of every A entry with the B entries of its group, summed."""
        in_b = np.bincount(of_b, minlength=int(of_a[-1]) + 1)
        first = np.cumsum(in_b) - in_b
        many = in_b[of_a]
        spot = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[of_a], many)
        return _summed(np.repeat(a, many) << B_BITS | b[spot], np.repeat(na, many) * nb[spot])


def _counted(ids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each group with their counts, by group."""
    key, n = np.unique(group << 32 | ids, return_counts=True)
    return key & 0xFFFFFFFF, n, key >> 32


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(key) else n


def pack_places(places: np.ndarray) -> bytes:
    """A compressed bitmap: 16-bit places, or bits if that is shorter (a first byte says which)."""
    if 2 * len(places) <= BLOCK // 8:
        return b"\0" + places.astype("<u2").tobytes()
    bits = np.zeros(BLOCK, bool)
    bits[places] = True
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def unpack_places(data: bytes) -> np.ndarray:
    if data[:1] == b"\0":
        return np.frombuffer(data, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little"))


def pack_planes(links: np.ndarray) -> bytes:
    """Bit planes of links - 1, lowest first, in the order of the bitmap's documents; none if all are 1."""
    more = links - 1
    return b"".join(
        np.packbits(more >> j & 1, bitorder="little").tobytes() for j in range(int(more.max(initial=0)).bit_length())
    )


def unpack_planes(data: bytes, n: int) -> np.ndarray:
    out = np.ones(n, np.int64)
    size = (n + 7) // 8
    for j in range(len(data) // size if size else 0):
        plane = np.frombuffer(data, np.uint8, count=size, offset=j * size)
        out += np.unpackbits(plane, count=n, bitorder="little").astype(np.int64) << j
    return out


def postings(place: np.ndarray, pair: np.ndarray, links: np.ndarray) -> tuple[list, ...]:
    """Pair, documents, links, bitmap and planes of every pair of a block."""
    order = np.lexsort((place, pair))
    place, pair, links = place[order], pair[order], links[order]
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(pair)) if len(pair) else first
    raw = place.astype("<u2").tobytes()
    top = np.maximum.reduceat(links, first) if len(pair) else links
    docs, planes = [], []
    for a, b, m in zip(first.tolist(), ends.tolist(), top.tolist(), strict=True):
        small = 2 * (b - a) <= BLOCK // 8
        docs.append(b"\0" + raw[2 * a : 2 * b] if small else pack_places(place[a:b]))
        planes.append(b"" if m == 1 else pack_planes(links[a:b]))
    total = np.add.reduceat(links, first) if len(pair) else links
    return pair[first], ends - first, total, docs, planes


def _batch(rows: int, /, **given) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "place": pa.int32(), "groups_sha256": pa.string(), "docs": pa.binary(), "planes": pa.binary()}
    columns = [
        pa.array(given[c], kinds.get(c, pa.int64())) if c in given else pa.nulls(rows, kinds.get(c, pa.int64())) for c in NAMES
    ]
    return pa.RecordBatch.from_arrays(columns, names=NAMES)


def inverted(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of kind 0, a document each, and of kind 1, a posting each (see ``SCHEMA``)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = once(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        block = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        entries = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal rows, pairs, entries, block
            if not rows:
                return
            columns = dict(zip([c.split()[0] for c in DOC.split(", ")], zip(*rows, strict=True), strict=True))
            n = len(rows)
            yield _batch(n, kind=[0] * n, block=[block] * n, place=list(range(n)), **columns)
            place = np.repeat(np.arange(n), [len(p) for p, _ in pairs])
            key, count, total, bits, planes = postings(
                place, np.concatenate([p for p, _ in pairs]), np.concatenate([m for _, m in pairs])
            )
            for a in range(0, len(key), 1 << 16):
                s = slice(a, a + (1 << 16))
                m = len(key[s])
                yield _batch(
                    m, kind=np.ones(m, np.int32), block=np.full(m, block), pair=key[s], n=count[s], links=total[s],
                    docs=bits[s], planes=planes[s],
                )
            rows, pairs, entries, block = [], [], 0, block + 1

        none = np.zeros(0, np.int64)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = aligner.tokens(text.as_py())
                if ids is None:
                    rows.append((doc_id, 0, 0, 0, 0, ""))
                    pairs.append((none, none))
                else:
                    of = aligner.groups(*ids)
                    key, m, total = aligner.links(*ids, *of)
                    rows.append((doc_id, len(ids[0]), len(ids[1]), int(of[0][-1]) + 1, total, aligner.digest(*ids, *of)))
                    pairs.append((key, m))
                    entries += len(key)
                if len(rows) >= BLOCK or entries >= ENTRIES:
                    yield from close()
        yield from close()

    return key_text(docs).mapInArrow(work, SCHEMA)


def pair_counts(posts: DataFrame) -> DataFrame:
    """pair, documents and links corpus-wide, and whether it is among its A id's most frequent."""
    counts = posts.groupBy("pair").agg(F.sum("n").alias("documents"), F.sum("links").alias("links"))
    counts = counts.withColumn("a", F.shiftright("pair", B_BITS)).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)))
    top = counts.groupBy("a").agg(F.max("documents").alias("top"))
    return counts.join(top, "a").select("pair", "a", "b", "documents", "links", (F.col("documents") == F.col("top")).alias("best"))


def scored(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Documents (see ``DOC``) with n_best and count_sum, added up from the postings of their block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best, total = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            kinds, blocks = batch.column("kind").to_numpy(), batch.column("block").to_numpy()
            post = np.flatnonzero(kinds == 1)
            lists = [batch.column(c).take(pa.array(post)).to_pylist() for c in ("n", "documents", "best", "docs", "planes")]
            cuts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])).tolist()
            for lo, hi in zip(cuts, [*cuts[1:], len(blocks)], strict=True):
                if blocks[lo] != block:  # postings of a block come before its documents
                    block, best, total = blocks[lo], np.zeros(BLOCK, np.int64), np.zeros(BLOCK, np.int64)
                a, b = np.searchsorted(post, [lo, hi])
                for n, documents, top, docs, planes in zip(*(x[a:b] for x in lists), strict=True):
                    at = unpack_places(docs)
                    links = unpack_planes(planes, n) if planes else 1
                    total[at] += links * documents
                    if top:
                        best[at] += links
                of = np.arange(lo, hi)[kinds[lo:hi] == 0]
                if len(of):
                    held = batch.take(pa.array(of))
                    place = held.column("place").to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [held.column(c) for c in names] + [pa.array(best[place]), pa.array(total[place])],
                        names=[*names, "n_best", "count_sum"],
                    )

    names = [c.split()[0] for c in DOC.split(", ")]
    posts = rows.filter("kind = 1").select("block", "pair", "n", "docs", "planes").join(
        counts.select("pair", "documents", "best"), "pair"
    )
    mine = rows.filter("kind = 0").select("kind", "block", "place", *names)
    both = mine.unionByName(
        posts.select(F.lit(1).alias("kind"), "block", "n", "documents", "best", "docs", "planes"), allowMissingColumns=True
    )
    return both.repartition("block").sortWithinPartitions("block", F.desc("kind")).mapInArrow(
        work, f"{DOC}, n_best bigint, count_sum bigint"
    )


def align(
    docs: DataFrame, scratch: str, path_a: str = f"{TOKENIZERS}/byte_bpe_50k.json", path_b: str = f"{TOKENIZERS}/piece_bpe_32k.model",
) -> tuple[DataFrame, DataFrame]:
    """Scores by document, and the pair table; documents and postings are written once under ``scratch``."""
    inverted(docs, path_a, path_b).write.partitionBy("kind").parquet(f"{scratch}/inverted")
    rows = docs.sparkSession.read.schema(SCHEMA).parquet(f"{scratch}/inverted")
    pair_counts(rows.filter("kind = 1")).write.parquet(f"{scratch}/pairs")
    counts = docs.sparkSession.read.parquet(f"{scratch}/pairs")
    return scored(rows, counts), counts


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, _ = align(table(spark, sf_dir, "documents"), scratch_folder(spark, "align"))
    return scores.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def brute_force(texts: list[tuple[int | None, str | None]], path_a: str, path_b: str) -> list[tuple]:
    """The same by plain loops, for tests."""
    import os
    from collections import Counter

    import sentencepiece

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    from modlake.llm.bpe import byte_letters

    ta = Tokenizer.from_file(path_a)
    ta.encode_special_tokens = True
    tb = sentencepiece.SentencePieceProcessor(model_file=path_b)
    letters = byte_letters()

    def b_bytes(i: int) -> bytes:
        p = tb.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for doc_id, text in texts:
        data = (" " + (text or "")).encode()
        a = ta.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = tb.encode(text) if text else []
        by_a = [bytes(letters[c] for c in ta.id_to_token(i)) for i in a]
        by_b = [b_bytes(i) for i in b]
        if not text or b"".join(by_a) != data or b"".join(by_b) != data:
            docs.append((doc_id, [], [], []))
            continue
        groups, i, j, ca, cb = [([], [])], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if ca <= cb and i < len(a):
                groups[-1][0].append(a[i])
                ca += len(by_a[i])
                i += 1
            else:
                groups[-1][1].append(b[j])
                cb += len(by_b[j])
                j += 1
            if ca == cb and i + j < len(a) + len(b):
                groups.append(([], []))
        docs.append((doc_id, a, b, groups))
        counts.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    top: dict[int, int] = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for doc_id, a, b, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        spelled = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == top[p[0]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(spelled.encode()).hexdigest() if groups else "",
        ))
    return out

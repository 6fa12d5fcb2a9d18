"""Near-duplicate classes of documents by weighted minimum hashing over word shingles.

A text is the multiset of its five-word shingles (lower-cased, split at white space; a text of fewer words is
one shingle).  Its signature is drawn from hierarchical Poisson processes over the
discretised weights: weight is cut into levels [0, 1), [1, 2), [2, 4), ...; each
shingle has one process per level, in order of time; a point's place in its level is found by
halving, and it counts if that place is below the shingle's weight.  Every slot keeps the earliest
point.  Two signatures agree in a slot with a chance equal to the weighted Jaccard index.  Points after the
time by which all slots are full are never drawn, so the work is near linear in the text.

Texts of equal multisets form one group first, named by the multiset's digest.  Groups meet in bands of the signature;
in each band bucket all members are compared with a centre (the member that shares most buckets),
by multiset overlap of the real shingles, which are written once for all members of buckets.  Members of a bucket
that are then still in different classes meet block by block: first by a byte of each signature slot, which leaves those
with a partner that agrees in ``LIKELY`` of the slots (at a similarity of 0.8 or more that fails with a chance of about 1e-13), then in
products of their shingle matrices.  So no link between documents that share a bucket is lost and no
pair is written but the links found.  Classes are the connected components of the verified links.

Null texts and texts without a word have no shingle and are classes of their own.  Rows that
repeat a doc_id share its class (of the smallest of its multisets); rows without an id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.llm.common import key_text, slices, table
from modlake.session import scratch_folder

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 6
SLICE = 1 << 20
#: Rows and shingles of one block of a bucket, and columns of one matrix product.
BLOCK_ROWS, BLOCK_SHINGLES, COLUMNS = 512, 1 << 20, 2048
#: Members that are compared with one copy of their centre, and the share of slots that a link must have in common.
STAR, LIKELY = 4096, 0.55
C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * C2
    x = (x ^ (x >> np.uint64(27))) * C3
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[str]) -> np.ndarray:
    """A hash of each word, the same on every machine: a polynomial over its code units."""
    joined = "\x00".join(words)
    units = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.flatnonzero(units == 0)
    starts = np.concatenate([[0], ends + 1])
    stops = np.append(ends, len(units))
    place = np.arange(len(units)) - np.repeat(starts, np.diff(np.append(starts, len(units) + 1)))[: len(units)]
    powers = np.cumprod(np.full(int(place.max(initial=0)) + 2, C1, np.uint64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((units + np.uint64(1)) * powers[place])])
    return mix(sums[stops] - sums[starts])


def shingles(texts: list[str | None], size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of every distinct shingle, by row then hash."""
    split = [(t or "").lower().replace("\x00", " ").split() for t in texts]
    n = np.array([len(s) for s in split], np.int64)
    flat = [w for s in split for w in s]
    if not flat:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = word_hashes(flat)
    begins = np.concatenate([[0], np.cumsum(n)])
    count = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    row = np.repeat(np.arange(len(texts)), count)
    first = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + begins[row]
    out = np.zeros(len(row), np.uint64)
    for j in range(size):
        at = first + j
        fits = at < begins[row + 1]
        out = np.where(fits, mix(out * C1 + h[np.minimum(at, len(h) - 1)] + np.uint64(j + 1)), out)
    order = np.lexsort((out, row))
    row, out = row[order], out[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (out[1:] != out[:-1])
    at = np.flatnonzero(fresh)
    return row[at], out[at], np.diff(np.append(at, len(row)))


def signatures(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n_rows: int, slots: int) -> np.ndarray:
    """Identity of the earliest counted point in every slot; rows without a shingle have zeros."""
    time = np.full((n_rows, slots), np.inf)
    point = np.zeros((n_rows, slots), np.uint64)
    if not len(row):
        return point
    total = np.bincount(row, weight, n_rows)
    level = np.ceil(np.log2(weight)).astype(np.int64)  # processes 0 .. level
    horizon = (np.log(slots) + 4) / np.maximum(total, 1)
    open_rows = total > 0
    begun = np.zeros(n_rows)
    which = np.repeat(np.arange(len(row)), level + 1)
    of_level = np.arange(len(which)) - np.repeat(np.cumsum(level + 1) - level - 1, level + 1)
    seed = mix(key[which] + mix(of_level.astype(np.uint64) + np.uint64(1)))
    low = np.where(of_level == 0, 0.0, np.exp2(of_level - 1.0))
    span = np.maximum(low, 1.0)
    while open_rows.any():
        active = np.flatnonzero(open_rows[row[which]])
        t, s, k = np.zeros(len(active)), seed[active], 0
        while len(active):
            s = mix(s + C1)
            u = ((s >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))
            r = row[which[active]]
            t = t - np.log(u) / (slots * span[active])
            on = t <= horizon[r]
            active, t, s, r = active[on], t[on], s[on], r[on]
            place = mix(s ^ C2)
            # The place in the level, halving by halving: the bits of a uniform number.
            y = low[active] + span[active] * ((place >> np.uint64(32)).astype(np.float64) / 4294967296.0)
            counts = (np.floor(y) < weight[which[active]]) & (t > begun[r])
            slot = (place & np.uint64(0xFFFFFFFF)).astype(np.int64) % slots
            rr, ss, tt, pp = r[counts], slot[counts], t[counts], s[counts]
            order = np.lexsort((tt, ss, rr))
            rr, ss, tt, pp = rr[order], ss[order], tt[order], pp[order]
            lead = np.ones(len(rr), bool)
            lead[1:] = (rr[1:] != rr[:-1]) | (ss[1:] != ss[:-1])
            rr, ss, tt, pp = rr[lead], ss[lead], tt[lead], pp[lead]
            sooner = tt < time[rr, ss]
            time[rr[sooner], ss[sooner]] = tt[sooner]
            point[rr[sooner], ss[sooner]] = pp[sooner]
        filled = np.isfinite(time).all(axis=1)
        open_rows &= ~filled
        begun = np.where(open_rows, horizon, begun)
        horizon = np.where(open_rows, horizon * 2, horizon)
    return point


def digests(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n_rows: int) -> np.ndarray:
    """A digest of each row's multiset; 0: no shingle."""
    out = np.zeros(n_rows, np.uint64)
    np.add.at(out, row, mix(key * C1 + weight.astype(np.uint64)))
    return out


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest of the multiset (0: no shingle), band keys and a byte of each slot of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                row, key, weight = shingles(part.column("text").to_pylist())
                sign = signatures(row, key, weight, part.num_rows, bands * rows)
                band = np.zeros((part.num_rows, bands), np.uint64)
                for j in range(rows):
                    band = mix(band * C1 + sign[:, j::rows] + np.uint64(j + 1))
                band = mix(band + mix(np.arange(1, bands + 1, dtype=np.uint64)))
                digest = digests(row, key, weight, part.num_rows)
                flat = pa.array(band.view(np.int64).ravel())
                low = np.ascontiguousarray(sign.astype(np.uint8))
                ends = pa.py_buffer(np.arange(0, low.size + 1, bands * rows, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(digest.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), flat),
                     pa.Array.from_buffers(pa.binary(), part.num_rows, [None, ends, pa.py_buffer(low)])],
                    names=["doc_id", "digest", "bands", "slots"],
                )

    return key_text(docs).filter("doc_id is not null").mapInArrow(
        work, "doc_id bigint, digest bigint, bands array<bigint>, slots binary"
    )


def verified(pairs: DataFrame, held: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (member, centre) whose multiset overlap reaches ``similarity``, from the bags of both.

    A member's bag moves once for each of its centres, a centre's once for ``STAR`` of its members.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, bag = None, np.zeros(0, np.int64)
        for batch in batches:
            ids, centres = batch.column("rep").to_numpy(), batch.column("centre").to_numpy()
            keys = batch.column("keys")
            flat, ends = keys.flatten().to_numpy(zero_copy_only=False), keys.offsets.to_numpy()
            ends, good = ends - ends[0], np.zeros(len(ids), bool)
            for i, (rep, of) in enumerate(zip(ids.tolist(), centres.tolist(), strict=True)):
                own = flat[ends[i] : ends[i + 1]]
                if rep == of:  # a centre comes before its members
                    centre, bag = rep, np.sort(own)
                elif of == centre:
                    shared = int((bag[np.minimum(np.searchsorted(bag, own), len(bag) - 1)] == own).sum())
                    good[i] = shared / max(len(bag) + len(own) - shared, 1) >= similarity
            yield batch.select(["rep", "centre"]).rename_columns(["a", "b"]).filter(pa.array(good))

    many = pairs.groupBy("centre").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    members = pairs.join(many, "centre").select("rep", "centre", part.alias("part"))
    centres = many.select(F.col("centre").alias("rep"), "centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    both = members.unionAll(centres).join(held.select("rep", "keys").hint("merge"), "rep")
    dealt = both.repartition("centre", "part").sortWithinPartitions("centre", "part", F.col("rep") != F.col("centre"))
    return dealt.select("rep", "centre", "keys").mapInArrow(work, "a bigint, b bigint").distinct()


def components(edges: DataFrame, scratch: str) -> DataFrame:
    """node and the smallest node of its component, by alternating star steps on written edges."""
    spark = edges.sparkSession
    mark = (F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h"))
    path, n, before = f"{scratch}/edges0", 0, None
    edges.selectExpr("greatest(a, b) as u", "least(a, b) as v").filter("u <> v").distinct().write.parquet(path)
    while True:
        now = spark.read.parquet(path)
        both = now.unionAll(now.selectExpr("v as u", "u as v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = both.join(low, "u").filter("v > u").selectExpr("v as u", "m as v").distinct()
        # The small step: every node's smaller neighbours and itself point to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("v as u", "m as v").filter("u <> v").unionAll(
            least.selectExpr("u", "m as v")
        ).distinct()
        n += 1
        path = f"{scratch}/edges{n}"
        small.write.parquet(path)
        after = spark.read.parquet(path)
        seen = tuple(after.agg(*mark).first())
        if seen == before:  # the same edges twice: every node points to its root
            return after.selectExpr("u as node", "v as root")
        before = seen


def bags(docs: DataFrame, members: DataFrame) -> DataFrame:
    """rep and the hashes of its shingles, for members (rep, first: a document of it); a shingle's further copies have hashes of their own."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                row, key, weight = shingles(part.column("text").to_pylist())
                first = np.repeat(np.cumsum(weight) - weight, weight)
                copy = (np.arange(len(first)) - first).astype(np.uint64)
                flat = mix(np.repeat(key, weight) + copy * C1)
                ends = np.searchsorted(np.repeat(row, weight), np.arange(part.num_rows + 1)).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))
                own = pa.array(digests(row, key, weight, part.num_rows).view(np.int64))
                out = pa.RecordBatch.from_arrays([part.column("rep"), keys], names=["rep", "keys"])
                yield out.filter(pc.equal(own, part.column("rep")))  # other texts may have the same id

    # One join for all comparisons to come; merged at every size, as both sides grow with the input.
    texts = key_text(docs).join(members.withColumnRenamed("first", "doc_id").hint("merge"), "doc_id").select("rep", "text")
    return texts.mapInArrow(work, "rep bigint, keys array<bigint>").dropDuplicates(["rep"]).withColumn("n", F.size("keys"))


def tile_links(reps: np.ndarray, roots: np.ndarray, flat: np.ndarray, sizes: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between members of different roots.

    Members outside the commonest root meet all members in products of 0/1 matrices, a slice of
    the shared shingles at a time, so every pair of different roots is compared exactly.
    """
    m, who = len(reps), np.repeat(np.arange(len(reps)), sizes)
    _, root = np.unique(roots, return_inverse=True)
    outside = np.flatnonzero(root != np.bincount(root).argmax())
    if not len(outside):
        return []
    _, code, seen = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(seen > 1) - 1
    held = seen[code] > 1
    who, code = who[held], number[code[held]]
    order = np.argsort(code, kind="stable")
    who, code = who[order], code[order]
    both = np.zeros((len(outside), m))
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(code, [low, low + COLUMNS])
        x = np.zeros((m, COLUMNS), np.float32)
        x[who[a:b], code[a:b] - low] = 1
        both += x[outside] @ x.T
    union = sizes[outside][:, None] + sizes[None, :] - both
    good = (both / np.maximum(union, 1) >= similarity) & (root[outside][:, None] != root[None, :])
    linked = np.zeros((m, m), bool)
    linked[outside] = good
    linked |= linked.T
    found, met = [], np.zeros(m, bool)
    for start in np.flatnonzero(linked.any(axis=1)):
        if met[start]:
            continue
        met[start], open_nodes = True, [start]
        while open_nodes:
            x = open_nodes.pop()
            fresh = np.flatnonzero(linked[x] & ~met)
            met[fresh] = True
            found += [(int(reps[x]), int(reps[y])) for y in fresh]
            open_nodes.extend(fresh.tolist())
    return found


def likely(slots: np.ndarray, roots: np.ndarray, share: float) -> np.ndarray:
    """Which members agree in that share of their slots with a member of another root?"""
    _, root = np.unique(roots, return_inverse=True)
    outside = np.flatnonzero(root != np.bincount(root).argmax())
    same = np.zeros((len(outside), len(root)), np.int16)
    for column in slots.T:
        same += column[outside][:, None] == column[None, :]
    near = (same >= share * slots.shape[1]) & (root[outside][:, None] != root[None, :])
    found = near.any(axis=0)
    found[outside] |= near.any(axis=1)
    return found


def tiled(rest: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rest`` (band, rep and others) once for each tile (i, j): two blocks of one bucket, by ``sizes`` (rep, n)."""
    sums = rest.join(sizes, "rep").groupBy("band").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")),
    )
    made = rest.join(sums, "band").withColumn("block", block).withColumn("tile", F.explode(others))
    return made.select(*rest.columns, "tile.i", "tile.j")


def bucket_links(rest: DataFrame, held: DataFrame, reps: DataFrame, similarity: float, scratch: str) -> DataFrame:
    """Links (a, b) between members (band, rep, root) of one bucket that are in different roots.

    A bucket is cut into blocks of bounded rows and shingles, and each two blocks meet in one
    tile.  A tile returns at most one link per member, never its pairs.
    """
    share = LIKELY * similarity / SIMILARITY

    def sieve(tile: pa.Table) -> pa.Table:
        raw = b"".join(tile.column("slots").to_pylist())
        slots = np.frombuffer(raw, np.uint8).reshape(tile.num_rows, -1)
        return tile.select(["band", "rep", "root"]).filter(pa.array(likely(slots, tile.column("root").to_numpy(), share)))

    def work(tile: pa.Table) -> pa.Table:
        tile = tile.combine_chunks()
        keys = tile.column("keys").combine_chunks()
        sizes = np.diff(keys.offsets.to_numpy())
        flat = keys.flatten().to_numpy(zero_copy_only=False)
        links = tile_links(tile.column("rep").to_numpy(), tile.column("root").to_numpy(), flat, sizes, similarity)
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    sketched = tiled(rest, reps.select("rep", F.lit(0).alias("n"))).join(reps.select("rep", "slots"), "rep")
    sketched.groupBy("band", "i", "j").applyInArrow(sieve, "band bigint, rep bigint, root bigint").distinct().write.parquet(f"{scratch}/sieved")
    left = rest.sparkSession.read.parquet(f"{scratch}/sieved")
    tiles = tiled(left, held.select("rep", "n")).join(held.select("rep", "keys"), "rep")
    return tiles.groupBy("band", "i", "j").applyInArrow(work, "a bigint, b bigint").distinct()


def classes(docs: DataFrame, scratch: str, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id and class_id, the smallest doc_id of its class."""
    spark = docs.sparkSession
    sketches(docs, bands, rows).write.parquet(f"{scratch}/sketches")
    made = spark.read.parquet(f"{scratch}/sketches")
    # Equal multisets: one representative each; texts without a shingle stay alone.
    of = made.groupBy("doc_id").agg(F.min("digest").alias("digest")).select(
        "doc_id", "digest", F.when(F.col("digest") == 0, F.col("doc_id")).alias("alone")
    )
    made.filter("digest <> 0").groupBy("digest").agg(
        F.min_by(F.struct("bands", "slots"), "doc_id").alias("s"), F.min("doc_id").alias("first")
    ).select(F.col("digest").alias("rep"), "first", "s.bands", "s.slots").write.parquet(f"{scratch}/reps")
    reps = spark.read.parquet(f"{scratch}/reps")
    member = reps.select("rep", F.explode("bands").alias("band")).repartition("band")  # one shuffle for both uses
    size = member.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    member.join(size.hint("merge"), "band").write.parquet(f"{scratch}/members")
    members = spark.read.parquet(f"{scratch}/members")
    degree = members.groupBy("rep").agg(F.sum("n").alias("degree"))
    centre = members.join(degree, "rep").groupBy("band").agg(F.max(F.struct("degree", "rep")).alias("top"))
    centre = centre.select("band", F.col("top.rep").alias("centre"))
    members.join(centre, "band").filter("rep <> centre").select("rep", "centre").distinct().write.parquet(f"{scratch}/pairs")
    needed = reps.select("rep", "first").join(degree.select("rep"), "rep", "left_semi")
    bags(docs, needed).write.parquet(f"{scratch}/bags")
    held = spark.read.parquet(f"{scratch}/bags")
    verified(spark.read.parquet(f"{scratch}/pairs"), held, similarity).write.parquet(f"{scratch}/links")
    links = spark.read.parquet(f"{scratch}/links")
    root = components(links, f"{scratch}/first")
    placed = members.join(root, members.rep == root.node, "left").select("band", "rep", F.coalesce("root", "rep").alias("root"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("band")
    placed.join(mixed, "band").write.parquet(f"{scratch}/mixed")
    bucket_links(spark.read.parquet(f"{scratch}/mixed"), held, reps, similarity, scratch).write.parquet(f"{scratch}/links2")
    root = components(links.unionAll(spark.read.parquet(f"{scratch}/links2")), f"{scratch}/second")
    placed = reps.select("rep", "first").join(root, F.col("rep") == F.col("node"), "left").select(
        F.col("rep").alias("digest"), "first", F.coalesce("root", "rep").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("first").alias("class_id"))
    grouped = placed.join(least, "root").select("digest", "class_id")
    return of.join(grouped, "digest", "left").select("doc_id", F.coalesce("class_id", "alone").alias("class_id"))


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"), scratch_folder(spark, "near"))

"""Repair of conversation structure at least cost, by a rank-convergence parallel Viterbi.

A repaired conversation has role initials ``(s?(ua)+)?``.  Keeping a row costs 0, giving it the role user or
assistant 1, deleting it 2 (blank and repeated rows must go), inserting an empty user or assistant
row 5; a truncated row that stays costs 5 more.  Four states (nothing yet, after s, u, a) make this
a shortest path, whose cost vector is computed backwards from the end of the conversation.

Rows are dealt out by ranges of (conversation, turn), so a long conversation lies in many tasks, and
are written in chunks of bounded rows and bytes.  Chunks of conversations that have several start from a
speculative vector (that of the end).  Fix-up passes hand each chunk the vector its right neighbour found:
it steps backwards from both vectors, and as soon as they differ by a constant only, the rest stays as it was.
Passes end when no vector changes but by a constant.  Then each chunk traces the least edits from every state it can be entered in;
a chunk's exit, which rarely depends on its entry, is the next one's entry.  Deletions that a fault forces
move no vector, so chunks of nothing else take no part in the passes.  In the worst case (a conversation in which vectors never meet)
there are as many passes as it has chunks.

Rows are ordered by turn (nulls first), then role, then text.  Null roles and texts are one space, a null
conversation id is a conversation; equal rows repeat each other and all but the first are duplicates.
Conversations without rows have no parts; an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modlake.llm.common import table
from modlake.session import scratch_folder

#: Rows and text bytes of a chunk.
CHUNK_ROWS, CHUNK_BYTES = 4096, 4 << 20
SPACE = " \t\n\x0b\x0c\r"
EMPTY, AFTER_S, AFTER_U, AFTER_A = range(4)
INITIALS = "sua"
NEXT = {EMPTY: "su", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
FAR = 1 << 40
#: Cost from each state at the end of a conversation, and the insertions that end it.
END = np.array([0, 10, 5, 0], np.int64)
END_EDITS = ("", "II", "I", "")
FORCED, CUT = 4, 8  # flags beside the initial (0 s, 1 u, 2 a, 3 other) in a row's code
KEY = "pid int, seq int"
CHUNK = f"{KEY}, conv_id bigint, before boolean, after boolean, turns array<bigint>, roles array<string>, texts array<string>, keys array<binary>, codes binary"
LINE = "array<struct<role:string,text:string>>"
PART = (
    f"{KEY}, conv_id bigint, whole boolean, cost bigint, audit string, lines {LINE}, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)


def _moves(code: int, state: int) -> list[tuple[str, int, int, str]]:
    """Edits that use up one row from a state, least first: letters, cost, next state, role of the row."""
    initial, found = code & 3, []
    for inserts in range(3):
        at, ok = state, True
        for _ in range(inserts):
            at = AFTER_A if at == AFTER_U else AFTER_U
        head, cost = "I" * inserts, 5 * inserts
        found.append((head + "D", cost + 2, at, ""))
        if code & FORCED or not ok:
            continue
        cost += 5 if code & CUT else 0
        for i, target in ((0, AFTER_S), (1, AFTER_U), (2, AFTER_A)):
            if INITIALS[i] in NEXT[at]:
                if initial == i:
                    found.append((head + "K", cost, target, ""))
                if i:
                    found.append((head + "R", cost + 1, target, "user" if i == 1 else "assistant"))
    return sorted(found, key=lambda m: m[0])


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """By code: least cost from state to state; cost and target of every move; the moves."""
    moves = [[_moves(c, s) for s in range(4)] for c in range(16)]
    most = max(len(m) for row in moves for m in row)
    step = np.full((16, 4, 4), FAR, np.int64)
    cost, target = np.full((16, 4, most), FAR, np.int64), np.zeros((16, 4, most), np.int64)
    for c, s in product(range(16), range(4)):
        for i, (_, price, to, _) in enumerate(moves[c][s]):
            step[c, s, to] = min(step[c, s, to], price)
            cost[c, s, i], target[c, s, i] = price, to
    return step, cost, target, moves


STEP, COST, TARGET, MOVES = _tables()


def backward(codes: list[np.ndarray], right: np.ndarray) -> list[np.ndarray]:
    """For each chunk the cost vectors before each of its rows and after the last one."""
    sizes = np.array([len(c) for c in codes])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.empty((begins[-1], 4), np.int64)
    flat = np.concatenate([*[np.append(c, 0) for c in codes], np.zeros(0, np.uint8)]).astype(np.int64)
    order = np.argsort(-sizes, kind="stable")
    out[begins[:-1] + sizes] = right
    for k in range(int(sizes.max(initial=0))):
        on = order[: np.searchsorted(-sizes[order], -k, side="left")]
        at = begins[on] + sizes[on] - k
        out[at - 1] = (STEP[flat[at - 1]] + out[at][:, None, :]).min(axis=2)
    return [out[a : a + n + 1] for a, n in zip(begins[:-1], sizes, strict=True)]


def moved(codes: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray | None:
    """The left vector (least entry 0) for another right vector; None if it stays as it was."""
    for code in codes[::-1]:
        gap = new - old
        if (gap == gap[0]).all():  # from here on the two stay this far apart
            return None
        old, new = ((STEP[code] + x).min(axis=1) for x in (old, new))
    old, new = old - old.min(), new - new.min()
    return None if (old == new).all() else new


def trace(codes: list[np.ndarray], costs: list[np.ndarray], entry: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """The least edits of each chunk from its entry state: state before and move of each row, and the exit state."""
    sizes = np.array([len(c) for c in codes], np.int64)
    begins = np.cumsum(sizes) - sizes
    flat = np.concatenate([*codes, np.zeros(0, np.uint8)]).astype(np.int64)
    here = np.concatenate([*[b[:-1] for b in costs], np.zeros((0, 4), np.int64)])
    then = np.concatenate([*[b[1:] for b in costs], np.zeros((0, 4), np.int64)])
    states, picks = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
    state, order = entry.astype(np.int64), np.argsort(-sizes, kind="stable")
    for k in range(int(sizes.max(initial=0))):
        on = order[: np.searchsorted(-sizes[order], -k, side="left")]
        at, q = begins[on] + k, state[on]
        target = TARGET[flat[at], q]
        good = COST[flat[at], q] + np.take_along_axis(then[at], target, axis=1) == here[at, q][:, None]
        pick = good.argmax(axis=1)
        states[at], picks[at] = q, pick
        state[on] = target[np.arange(len(on)), pick]
    return [states[a : a + n] for a, n in zip(begins, sizes, strict=True)], [picks[a : a + n] for a, n in zip(begins, sizes, strict=True)], state


def prepared(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, a key of role and text, and the code of each row."""
    blank = F.lit(" ")
    given = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )
    core, first = F.rtrim("text", F.lit(SPACE)), F.substring("role", 1, 1)
    code = F.lit(3)
    for i, letter in enumerate(INITIALS):
        code = F.when(first == letter, i).otherwise(code)
    flags = F.when(core == "", FORCED).when(F.right(core, F.lit(1)).isin(".", "!", "?"), 0).otherwise(CUT)
    key = F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")))
    return given.select("*", key.alias("key"), (code + flags).cast("tinyint").alias("code"))


def _lists(values: pa.Array, edges: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values)


def chunked(rows: DataFrame) -> DataFrame:
    """Rows in order, in chunks (see ``CHUNK``); ``before`` and ``after``: the conversation goes on there in this task."""

    def edges(tab: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """First row of every chunk, and which of those open a conversation."""
        ids, none = tab.column("conv_id").fill_null(0).to_numpy(), tab.column("conv_id").is_null().to_numpy()
        opens = np.append(True, (ids[1:] != ids[:-1]) | (none[1:] != none[:-1]))
        begin = np.repeat(np.flatnonzero(opens), np.diff(np.append(np.flatnonzero(opens), len(ids))))
        sizes = pc.binary_length(tab.column("text")).to_numpy().astype(np.int64)
        done = np.cumsum(sizes) - sizes
        part = np.stack([(np.arange(len(ids)) - begin) // CHUNK_ROWS, (done - done[begin]) // CHUNK_BYTES])
        cut = opens.copy()
        cut[1:] |= (part[:, 1:] != part[:, :-1]).any(axis=0)
        return np.flatnonzero(cut), opens[cut]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, seq, rest, goes_on = TaskContext.get().partitionId(), 0, None, False

        def emit(tab: pa.Table, first: np.ndarray, stop: int, before: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
            nonlocal seq
            tab, ends = tab.slice(0, stop).combine_chunks(), np.append(first, stop)
            column = {c: tab.column(c).combine_chunks() for c in tab.column_names}
            column = {c: v.chunk(0) if isinstance(v, pa.ChunkedArray) else v for c, v in column.items()}
            raw = column["code"].to_numpy().astype(np.uint8).tobytes()
            n = len(first)
            out = pa.RecordBatch.from_arrays(
                [pa.array([pid] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int32()), column["conv_id"].take(pa.array(first)),
                 pa.array(before), pa.array(after), *(_lists(column[c], ends) for c in ("turn", "role", "text", "key")),
                 pa.array([raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())],
                names=[c.split()[0] for c in CHUNK.split(", ")],
            )
            seq += n
            return out

        for batch in batches:
            tab = pa.Table.from_batches([batch])
            if rest is not None:
                tab = pa.concat_tables([rest, tab]).combine_chunks()
            if not tab.num_rows:
                continue
            first, opens = edges(tab)
            if len(first) > 1:  # the last chunk waits for the rows to come
                before = ~opens
                before[0] = goes_on
                yield emit(tab, first[:-1], int(first[-1]), before[:-1], before[1:])
                goes_on = bool(before[-1])
            rest = tab.slice(int(first[-1]))
        if rest is not None and rest.num_rows:
            yield emit(rest, np.zeros(1, np.int64), rest.num_rows, np.array([goes_on]), np.array([False]))

    order = ["conv_id", "turn", "role"]
    dealt = prepared(rows).repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    return dealt.mapInArrow(work, CHUNK)


def numbered(chunks: DataFrame) -> DataFrame:
    """Chunks without texts, with a number that follows their order, joined over the borders of tasks."""
    ends = chunks.groupBy("pid").agg(
        F.count("*").alias("n"), F.min_by(F.struct("conv_id"), "seq").alias("head"),
        F.max_by(F.struct("conv_id", F.expr("cast(conv(hex(substring(codes, -1, 1)), 16, 10) as int)").alias("code")), "seq").alias("last"),
    )
    tasks = Window.orderBy("pid")  # one row per task
    ends = ends.select(
        "pid", "n", (F.sum("n").over(tasks) - F.col("n")).alias("base"), F.lag("last").over(tasks).alias("prior"),
        F.lead("head").over(tasks).alias("next"),
    )
    first, final = F.col("seq") == 0, F.col("seq") == F.col("n") - 1
    goes_on = F.coalesce(F.col("prior").isNotNull() & F.col("prior.conv_id").eqNullSafe(F.col("conv_id")), F.lit(False))
    stays = F.coalesce(F.col("next").isNotNull() & F.col("next.conv_id").eqNullSafe(F.col("conv_id")), F.lit(False))
    return chunks.select("pid", "seq", "conv_id", "before", "after", "keys", "codes").join(ends, "pid").select(
        "pid", "seq", (F.col("base") + F.col("seq")).alias("g"), "conv_id",
        F.when(first, goes_on).otherwise(F.col("before")).alias("before"), F.when(final, stays).otherwise(F.col("after")).alias("after"),
        "keys", "codes",
    )


def faulted(chunks: DataFrame) -> DataFrame:
    """g, pid, seq, conv_id, before, after, codes with forced deletions of duplicates, and the counts of faults."""
    spots = chunks.select("conv_id", "g", F.posexplode("keys").alias("at", "key"))
    first = spots.groupBy("conv_id", "key").agg(F.min(F.struct("g", "at")).alias("first"))
    listed = first.groupBy("first.g").agg(F.collect_list("first.at").alias("firsts"))
    prior = chunks.select((F.col("g") + 1).alias("g"), F.substring("codes", -1, 1).alias("prior"))
    joined = chunks.drop("keys").join(listed, "g", "left").join(prior, "g", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, counts = [], []
            columns = (batch.column(c).to_pylist() for c in ("codes", "firsts", "before", "prior"))
            for raw, firsts, before, prior in zip(*columns, strict=True):
                code = np.frombuffer(raw, np.uint8).copy()
                fresh = np.zeros(len(code), bool)
                fresh[firsts or []] = True
                blank = code & FORCED > 0
                again = ~blank & ~fresh
                code[again] = (code[again] & ~np.uint8(CUT)) | FORCED
                who = np.append(np.frombuffer(prior, np.uint8) if before else np.zeros(0, np.uint8), code) & 3
                pair = who[:-1] * 4 + who[1:]
                codes.append(code.tobytes())
                counts.append((int(blank.sum()), int(again.sum()), int((code & CUT > 0).sum()), int((~np.isin(pair, (1, 6, 9))).sum())))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("g", "pid", "seq", "conv_id", "before", "after")), pa.array(codes, pa.binary()),
                 *(pa.array(list(c), pa.int64()) for c in (zip(*counts, strict=True) if counts else [[]] * 4))],
                names=["g", "pid", "seq", "conv_id", "before", "after", "codes", "blank", "duplicate", "truncated", "illegal"],
            )

    return joined.mapInArrow(
        work, "g bigint, pid int, seq int, conv_id bigint, before boolean, after boolean, codes binary, "
        "blank bigint, duplicate bigint, truncated bigint, illegal bigint",
    )


def _vectors(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` from lists of a batch's columns to a list of row tuples."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(names, row, strict=True)) for row in fn(*(c.to_pylist() for c in batch.columns))], schema=kinds
                )

    names = [c.split()[0] for c in schema.split(", ")]
    types = {"bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "boolean": pa.bool_()}
    kinds = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])
    return df.mapInArrow(work, schema)


def _codes(raw: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(c, np.uint8) for c in raw]


def solved(chunks: DataFrame, scratch: str) -> DataFrame:
    """g, right vector and entry state of the chunks that need them: those of conversations with several chunks."""
    spark = chunks.sparkSession
    several = chunks.filter("before or after").select("g", "conv_id", "before", "after", "codes")
    # Chunks of forced deletions alone move no vector and no state; the last one of a conversation ends it.
    free = F.length(F.translate(F.hex("codes"), "4567CDEF", "")) > F.length("codes")
    by_conv = Window.partitionBy("conv_id").orderBy("g")
    linked = several.filter(free | ~F.col("after")).select(
        "g", "codes", F.lag("g").over(by_conv).alias("l"), F.lead("g").over(by_conv).alias("r")
    )
    path, n = f"{scratch}/pass0", 0
    state = "g bigint, codes binary, l bigint, r bigint, right array<bigint>, left array<bigint>, moved boolean"

    def begin(g, codes, left, right):
        costs = backward(_codes(codes), END)
        return [(a, c, x, y, END.tolist(), (b[0] - b[0].min()).tolist(), True)
                for a, c, x, y, b in zip(g, codes, left, right, costs, strict=True)]

    def again(g, codes, lg, rg, right, left, _, new):
        out = []
        for a, c, x, y, old, was, given in zip(g, codes, lg, rg, right, left, new, strict=True):
            fresh = None
            if given is not None and given != old:
                fresh = moved(np.frombuffer(c, np.uint8), np.array(old), np.array(given))
            out.append((a, c, x, y, given or old, was if fresh is None else fresh.tolist(), fresh is not None))
        return out

    _vectors(linked, begin, state).write.parquet(path)
    while True:
        now = spark.read.parquet(path)
        if now.filter("moved").isEmpty():
            break
        beside = now.filter("moved").select(F.col("g").alias("r"), F.col("left").alias("new"))
        n += 1
        path = f"{scratch}/pass{n}"
        _vectors(now.join(beside, "r", "left").select(*now.columns, "new"), again, state).write.parquet(path)

    def exits(g, codes, lg, right):
        rows = _codes(codes)
        costs = backward(rows, np.array(right))
        out = [trace(rows, costs, np.full(len(rows), e))[2].tolist() for e in range(4)]
        return [(a, x, list(m)) for a, x, m in zip(g, lg, zip(*out, strict=True), strict=True)]

    maps = _vectors(now.select("g", "codes", "l", "right"), exits, "g bigint, l bigint, exits array<bigint>")
    maps.write.parquet(f"{scratch}/exits0")
    n = 0
    while True:  # a chunk's map takes in those of ever more chunks before it: 1, 2, 4, ...
        maps = spark.read.parquet(f"{scratch}/exits{n}")
        if maps.filter("l is not null").isEmpty():
            break
        left = maps.select(F.col("g").alias("l"), F.col("l").alias("further"), F.col("exits").alias("before"))
        n += 1
        joined = maps.join(left, "l", "left")
        same = F.size(F.array_distinct("exits")) == 1
        joined.select(
            "g", F.when(same, F.lit(None)).otherwise(F.col("further")).alias("l"),
            F.when(F.col("l").isNull() | same, F.col("exits"))
            .otherwise(F.transform("before", lambda e: F.get("exits", e.cast("int")))).alias("exits"),
        ).write.parquet(f"{scratch}/exits{n}")
    left = maps.select(F.col("g").alias("l"), F.get("exits", F.lit(EMPTY)).alias("entry"))
    return now.join(left, "l", "left").select("g", "right", F.coalesce("entry", F.lit(EMPTY)).alias("entry"))


def repair(rows: DataFrame, scratch: str) -> DataFrame:
    """Parts of repaired conversations (see ``PART``), in the order of pid and seq; written under ``scratch``.

    ``whole`` parts are a conversation each.
    """
    spark = rows.sparkSession
    chunked(rows).write.parquet(f"{scratch}/chunks")
    chunks = spark.read.schema(CHUNK).parquet(f"{scratch}/chunks")
    faulted(numbered(chunks)).write.parquet(f"{scratch}/faults")
    faults = spark.read.parquet(f"{scratch}/faults")
    found = faults
    if faults.filter("before or after").isEmpty():
        found = found.withColumns({"right": F.lit(None).cast("array<bigint>"), "entry": F.lit(None).cast("bigint")})
    else:
        found = found.join(solved(faults, scratch), "g", "left")
    counts = ["blank", "duplicate", "truncated", "illegal"]
    joined = found.join(chunks.select("pid", "seq", "roles", "texts"), ["pid", "seq"]).select(
        "pid", "seq", "conv_id", "before", "after", "codes", "right", "entry", "roles", "texts", *counts
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = {c: batch.column(c).to_pylist() for c in batch.schema.names if c != "texts"}
            whole = [not (a or b) for a, b in zip(column["before"], column["after"], strict=True)]
            codes = _codes(column["codes"])
            right = np.array([END if r is None else r for r in column["right"]])
            entry = np.array([EMPTY if e is None else e for e in column["entry"]])
            states, picks, exits = trace(codes, backward(codes, right), entry)
            cost, audit, lines = [], [], []
            for i, code in enumerate(codes):
                ends = not column["after"][i]
                idle = not whole[i] and column["right"][i] is None  # forced deletions alone
                text = batch.column("texts")[i].as_py()
                got = _edits(code, states[i], picks[i], column["roles"][i], text, exits[i] if ends and not idle else EMPTY)
                cost.append(got[0])
                audit.append(got[1])
                lines.append(got[2])
            yield pa.RecordBatch.from_arrays(
                [batch.column("pid"), batch.column("seq"), batch.column("conv_id"), pa.array(whole), pa.array(cost, pa.int64()),
                 pa.array(audit), pa.array(lines, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                 *(batch.column(c) for c in counts)],
                names=["pid", "seq", "conv_id", "whole", "cost", "audit", "lines", *counts],
            )

    joined.mapInArrow(work, PART).write.parquet(f"{scratch}/parts")
    return spark.read.schema(PART).parquet(f"{scratch}/parts")


def _edits(codes, states, picks, roles, texts, last) -> tuple[int, str, list[dict]]:
    """Cost, letters and the rows that remain, of one chunk; ``last`` is the state its conversation ends in."""
    cost, audit, lines = 0, [], []

    def inserted(state: int, n: int) -> int:
        for _ in range(n):
            state = AFTER_A if state == AFTER_U else AFTER_U
            lines.append({"role": "user" if state == AFTER_U else "assistant", "text": ""})
        return state

    for code, state, pick, role, text in zip(codes.tolist(), states.tolist(), picks.tolist(), roles, texts, strict=True):
        letters, price, _, given = MOVES[code][state][pick]
        inserted(state, len(letters) - 1)
        if letters[-1] != "D":
            lines.append({"role": given or role, "text": text})
        cost += price
        audit.append(letters)
    inserted(last, len(END_EDITS[last]))
    audit.append(END_EDITS[last])
    return cost + 5 * len(END_EDITS[last]), "".join(audit), lines


def repaired_rows(parts: DataFrame) -> DataFrame:
    """conv_id, part and place in it, role and text of every row of the repaired conversations."""
    return parts.select("conv_id", "pid", "seq", F.posexplode("lines").alias("place", "line")).select(
        "conv_id", "pid", "seq", "place", "line.role", "line.text"
    )


def digests(parts: DataFrame) -> DataFrame:
    """conv_id and the digest of its repaired rows (``role:text``, joined by newlines).

    A conversation of several parts streams through one task, part by part.
    """
    joined = F.array_join(F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        mark, digest, begun = (), None, False
        for batch in batches:
            for conv, n, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if mark != (conv,):
                    if mark:
                        yield pa.RecordBatch.from_pydict({"conv_id": pa.array(mark, pa.int64()), "repaired_sha256": [digest.hexdigest()]})
                    mark, digest, begun = (conv,), hashlib.sha256(), False
                if n:
                    digest.update((b"\n" if begun else b"") + text.as_py().encode())
                    begun = True
        if mark:
            yield pa.RecordBatch.from_pydict({"conv_id": pa.array(mark, pa.int64()), "repaired_sha256": [digest.hexdigest()]})

    several = parts.filter("not whole").select("conv_id", F.size("lines").alias("n"), joined.alias("text"), "pid", "seq")
    streamed = several.repartition("conv_id").sortWithinPartitions("conv_id", "pid", "seq").select("conv_id", "n", "text")
    return parts.filter("whole").select("conv_id", F.sha2(joined, 256).alias("repaired_sha256")).unionAll(
        streamed.mapInArrow(work, "conv_id bigint, repaired_sha256 string")
    )


def report(parts: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, cost, edits and the digest of its repaired rows."""
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    listed = F.transform(F.sort_array(F.collect_list(F.struct("pid", "seq", "audit"))), lambda p: p["audit"])
    total = parts.groupBy("conv_id").agg(*sums, F.array_join(listed, "").alias("audit"))
    turns = rows.select(F.col("conv_id").cast("bigint").alias("c"), F.col("turn").cast("bigint").alias("turn")).distinct()
    gaps = turns.groupBy("c").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    hashed = digests(parts).withColumnRenamed("conv_id", "d")
    return total.join(gaps, F.col("conv_id").eqNullSafe(F.col("c"))).join(hashed, F.col("conv_id").eqNullSafe(F.col("d"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with drops, empty texts, missing marks, repeats and wrong roles, by a checksum of conversation and turn."""
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    dealt = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(F.concat(spelled[0], F.lit(":"), spelled[1])) % 20).alias("fate"),
    ).filter("fate <> 0")
    fate = F.col("fate")
    return dealt.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    rows = damaged(given)
    found = report(repair(rows, scratch_folder(spark, "repair")), rows).withColumnRenamed("conv_id", "c")
    everyone = given.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    zeros = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return everyone.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def brute_force(rows: list[tuple]) -> dict:
    """The same for (conv_id, turn, role, text) after damage, by a shortest path over whole audits; for tests."""
    import hashlib

    by_conv: dict = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role, text, turn))
    out = {}
    for conv, held in by_conv.items():
        held.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        seen, counts, fault = set(), [0, 0, 0], []
        for _, _, role, text, _ in held:
            core = text.strip(SPACE)
            f = 0 if not core else 1 if (role, text) in seen else 2 if core[-1] not in ".!?" else 3
            seen.add((role, text))
            fault.append(f)
            if f < 3:
                counts[f] += 1
        # Best (cost, audit) and rows to every state; audits of one state and row are compared whole.
        best = {"": (0, "", [])}

        def grown(best: dict) -> dict:
            for _ in range(2):
                for state, (cost, audit, kept) in list(best.items()):
                    for to in ("u", "a"):
                        if to in {"": "u", "s": "u", "u": "a", "a": "u"}[state]:
                            new = (cost + 5, audit + "I", [*kept, ({"u": "user", "a": "assistant"}[to], "")])
                            if to not in best or new[:2] < best[to][:2]:
                                best[to] = new
            return best

        for (_, _, role, text, _), f in zip(held, fault, strict=True):
            after: dict = {}

            def offer(state, new, after=after):
                if state not in after or new[:2] < after[state][:2]:
                    after[state] = new

            for state, (cost, audit, kept) in grown(best).items():
                offer(state, (cost + 2, audit + "D", kept))
                if f < 2:
                    continue
                more = 5 if f == 2 else 0
                for to in {"": "su", "s": "u", "u": "a", "a": "u"}[state]:
                    if role[:1] == to:
                        offer(to, (cost + more, audit + "K", [*kept, (role, text)]))
                    if to != "s":
                        offer(to, (cost + more + 1, audit + "R", [*kept, ({"u": "user", "a": "assistant"}[to], text)]))
            best = after
        cost, audit, kept = min((v for s, v in grown(best).items() if s in ("", "a")), key=lambda v: v[:2])
        turns = {r[4] for r in held if r[0]}
        firsts = [r[2][:1] for r in held]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts,
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:], strict=False)), cost, audit,
            hashlib.sha256("\n".join(f"{a}:{b}" for a, b in kept).encode()).hexdigest(),
        )
    return out

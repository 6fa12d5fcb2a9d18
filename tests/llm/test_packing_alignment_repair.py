"""Packing, token alignment and conversation repair against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from modlake.llm import alignment, packing, registry, repair
from modlake.llm.common import TOKENIZERS, table

SF = "/root/testdata/sf0.001"
BYTES, PIECES = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
LONG = " ".join(f"word{i % 977} and {i}" for i in range(6000))
TEXTS = [
    (1, "Plain words, twice. Plain words, twice."), (1, "Plain words, twice. Plain words, twice."), (2, None), (3, ""),
    (4, "  two  blanks\n"), (5, "a" * 4000), (6, "é\U0001f600漢字 <|endoftext|> <s> </s>"), (None, "no id here"),
    (7, "▁ is a piece's blank"), (8, LONG), (-9, " leading"), (10, "\x00\x01 control"), (11, " " * 3000 + "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "mine", 0.5, "z") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, pair string, offset double, kind string").repartition(3)


def ids_of(texts):
    tokenizer = Tokenizer.from_file(BYTES)
    return [(i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for i, t in texts]


def test_cuts_are_class_sizes_and_add_up():
    sizes = {packing.CAPACITY // k for k in range(1, packing.CAPACITY + 1)}
    for n in range(0, 3000):
        parts = packing.cuts(n)
        assert sum(parts) == n and set(parts) <= sizes


def test_packing_holds_each_id_once_with_little_padding(spark, docs):
    texts = list({(i, t): None for i, t in TEXTS})  # check() wants each document once
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string")).selectExpr(
        "doc_id", "start", "length", "crc32(ids) as ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
    assert packing.check([r.asDict() for r in rows.collect()], ids_of(texts)) < 0.01
    everything = packing.pack(docs)
    assert everything.agg({"length": "sum"}).first()[0] == sum(len(b) // 4 for _, b in ids_of(TEXTS))
    assert packing.sequences(everything).filter("padding < 0 or tokens > 1024").count() == 0
    assert packing.pack(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.Packer(0, capacity=1000)


def test_packing_query_on_the_documents(spark):
    found = [r.asDict() for r in registry.QUERIES["op12_packing"](spark, SF).collect()]
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert packing.check(found, ids_of(texts)) < 0.01


def test_alignment_matches_plain_loops(spark, docs, tmp_path):
    scores, pairs = alignment.align(docs, str(tmp_path / "a"))
    got = scores.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    want = alignment.brute_force(TEXTS, BYTES, PIECES)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(r[0] == 7 and r[1] == 0 for r in want)  # a text that B does not give back
    assert pairs.agg({"links": "sum"}).first()[0] == sum(r[4] for r in want)
    none, _ = alignment.align(docs.limit(0), str(tmp_path / "b"))
    assert none.count() == 0


def test_alignment_over_many_blocks_and_long_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(alignment, "ENTRIES", 40)
    monkeypatch.setattr(alignment, "LISTED", 3)
    r = random.Random(2)
    words = ["tokenizer", "漢字漢字", "naïveté", "1234567", "\U0001f600\U0001f601", "of", "unbelievably"]
    texts = [(i, " ".join(r.choice(words) for _ in range(r.randrange(30)))) for i in range(60)]
    scores, _ = alignment.align(spark.createDataFrame(texts, "doc_id long, text string").repartition(4), str(tmp_path / "a"))
    got = scores.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(alignment.brute_force(texts, BYTES, PIECES))


def test_bitmaps_and_planes_round_trip():
    r = np.random.default_rng(1)
    for n in (1, 7, 200, 257, 4096):
        places = np.sort(r.choice(alignment.BLOCK, n, replace=False))
        links = r.integers(1, 40, n)
        data = alignment.pack_places(places)
        assert (alignment.unpack_places(data) == places).all() and len(data) <= 1 + alignment.BLOCK // 8
        assert (alignment.unpack_planes(alignment.pack_planes(links), n) == links).all()
        assert alignment.pack_planes(np.ones(n, np.int64)) == b""


def damaged(rows):
    """The contract's damage in plain Python."""
    out = []
    for conv, turn, role, text in rows:
        spelled = [" " if x is None else str(x) for x in (conv, turn)]
        fate = zlib.crc32(":".join(spelled).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        if fate == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def test_repair_query_matches_plain_search(spark, tmp_path):
    given = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    given += [(-1, None, None, None), (-2, 1, "", "x"), (None, 3, "user", "Hello."), (None, None, "assistant", "Hi!")]
    given += [(c, t, "user", "Same.") for c in range(-60, -50) for t in range(2)]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(given, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as cost", "2 as audit").write.parquet(path)
    got = {r.conv_id: tuple(r)[1:] for r in registry.QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()}
    want = repair.brute_force(damaged(given))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: want.get(c, nothing) for c in {r[0] for r in given}}


def test_repair_over_many_chunks(spark, tmp_path, monkeypatch):
    """Long conversations over tasks and chunks, with stretches whose vectors never meet."""
    monkeypatch.setattr(repair, "CHUNK_ROWS", 7)
    r, rows = random.Random(3), []
    for conv in (1, None):
        rows += [
            (conv, r.choice([None, *range(90)]), r.choice(["user", "assistant", "system", "tool", ""]),
             r.choice(["", " \n", "hi.", "yes", f"x{i}.", f"y{i}", f"z{i}!\t"])) for i in range(130)
        ]
    rows += [(5, i, "user", f"t{i}" if i < 40 else "") for i in range(90)]  # truncated, then blank ones
    rows += [(6, i, "user" if i % 2 else "assistant", f"m{i}.") for i in range(90)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    parts = repair.repair(df, str(tmp_path / "r"))
    got = {x.conv_id: tuple(x)[1:] for x in repair.report(parts, df).collect()}
    assert got == repair.brute_force(rows)
    assert parts.filter("not whole").count() > 20
    kept = repair.repaired_rows(parts).filter("conv_id = 6").orderBy("pid", "seq", "place").collect()
    assert [x.role[0] for x in kept] == ["u", "a"] * (len(kept) // 2)
    empty = repair.repair(df.limit(0), str(tmp_path / "e"))
    assert repair.report(empty, df.limit(0)).count() == 0

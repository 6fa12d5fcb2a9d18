"""Personal data by patterns, and more of it by bootstrapped context patterns; Spark expressions only.

Base: e-mail addresses, IPv4 addresses, payment card numbers and phone numbers.  Every one of
those spans is a seed, whatever its spaces or digits: the two words of the text before the word in
which it starts are its context pattern (one word, if the text has no more; none at the very start).
Seeds and the digit words that follow a pattern are its instances.  Pattern and instance scores are computed from each
other in a few rounds over the graph of (pattern, instance) pairs; strings after patterns of high
confidence are added as ``context`` spans.

All offsets are code points, ends exclusive.  Patterns run in linear time on any text:
runs are matched possessively, and repeated groups are first turned into plain character runs by a
length-preserving replacement.  Null and empty texts have no spans.  A row's spans come from its own
text alone, so repeated or null ids do no harm; each row stays.

Trusted patterns are few strings: up to ``MOST`` of them become literals, so context spans are found in the
row where they are and no text moves.  More of them are joined, by id and digest of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modlake.llm.common import key_text, table
from modlake.session import scratch_folder

KINDS = ("email", "ip", "card", "phone", "context")
LOCAL, LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
#: Each runs on the text after its own length-preserving replacement.
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[{LABEL}]++\.[{LABEL}.]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9\x20-]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A word with a digit.
WORD = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"
SPAN = "struct<start:int,kind:int,end:int>"

ROUNDS, MIN_SUPPORT, CONFIDENCE = 3, 5, 0.8
MIN_CHARS, MIN_DIGITS = 6, 4
#: Trusted patterns, and their characters in all, that travel in the plan.
MOST, MOST_CHARS = 10_000, 1 << 20


def _breaks(text: Column) -> Column:
    return F.size(F.split(text, r"\s+", -1)) - 1


def _matches(text: Column, pattern: str, when: Column) -> Column:
    """Array of (start, string, word) of all matches, from the matches and the gaps between them.

    ``word`` is the number of white-space runs before the match; none may start or end with one.
    """
    gaps = F.split(text, pattern, -1)
    strings = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        strings, F.slice(F.transform(gaps, lambda g: F.struct(F.length(g).alias("skip"), _breaks(g).alias("breaks"))),
                         1, F.greatest(F.size(strings), F.lit(0))),
        lambda s, g: F.struct(g["skip"].alias("skip"), g["breaks"].alias("breaks"), s.alias("s")),
    )
    kind = "struct<start:int,s:string,word:int>"

    def step(acc: Column, m: Column) -> Column:
        start, word = acc["at"] + m["skip"], acc["word"] + m["breaks"]
        return F.struct(
            (start + F.length(m["s"])).alias("at"), (word + _breaks(m["s"])).alias("word"),
            F.concat(acc["out"], F.array(F.struct(start.alias("start"), m["s"].alias("s"), word.alias("word")))).alias("out"),
        )

    zero = F.expr(f"struct(0 as at, 0 as word, cast(array() as array<{kind}>) as out)")
    found = F.aggregate(pairs, zero, step, lambda acc: acc["out"])
    return F.when(when, found).otherwise(F.expr(f"cast(array() as array<{kind}>)"))


def _luhn(digits: Column) -> Column:
    backward = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substring(backward, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))),
                         F.substring(backward, i, F.lit(1)).cast("int") + 1)
        ),
    )
    return total % 10 == 0


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _spans(found: Column, kind: int) -> Column:
    return F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), (m["start"] + F.length(m["s"])).alias("end"))
    )


def _placed(found: Column) -> Column:
    """start, string and context pattern of matches, from the words of the whole text."""
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), m["s"].alias("s"),
        F.lower(F.ltrim(F.concat_ws(" ", F.get("_split", m["word"] - 2), F.get("_split", m["word"] - 1)))).alias("pattern"),
    ))


def with_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``base``, the base spans by start then kind, ``seeds``, their strings and contexts, and ``words``, digit words and theirs."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    dotted = F.regexp_replace(t, rf"\.(?![{LABEL}])", "%")
    # White space stays white space, so that words are counted alike in every form of the text.
    spaced = F.regexp_replace(F.regexp_replace(t, r"\x20(?![0-9])", "\t"), "-(?![0-9])", "x")
    part = r"0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    has_digit = t.rlike("[0-9]")
    found = df.select(
        *df.columns,
        _matches(dotted, EMAIL, t.contains("@")).alias("_email"),
        _matches(t, IP, has_digit & t.contains(".")).alias("_ip"),
        _matches(spaced, CARD, t.rlike(r"[0-9][0-9\x20-]{12}")).alias("_card"),
        _matches(t, PHONE, t.contains("+")).alias("_phone"),
        _matches(t, WORD, has_digit).alias("_word"),
        F.when(has_digit | t.contains("@"), F.split(t, r"\s+", -1)).alias("_split"),
    )
    ip = F.filter("_ip", lambda m: m["s"].rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
    card = F.filter("_card", lambda m: F.length(_digits(m["s"])).between(14, 19) & _luhn(_digits(m["s"])))
    phone = F.filter("_phone", lambda m: F.length(_digits(m["s"])).between(10, 15))
    return found.select(
        *df.columns,
        F.array_sort(F.concat(_spans(F.col("_email"), 0), _spans(ip, 1), _spans(card, 2), _spans(phone, 3))).alias("base"),
        _placed(F.concat("_email", ip, card, phone)).alias("seeds"),
        _placed(F.col("_word")).alias("words"),
    )


def _cores(words: Column, base: Column) -> Column:
    """Digit words less the marks around them, long enough for an identifier and outside base spans."""
    def core(w: Column) -> Column:
        tail = F.regexp_replace(w["s"], r"^[^A-Za-z0-9+]++", "")
        instance = F.regexp_replace(tail, r"(?<![^A-Za-z0-9])[^A-Za-z0-9]++$|(?<=[A-Za-z0-9])[^A-Za-z0-9]++$", "")
        start = w["start"] + F.length(w["s"]) - F.length(tail)
        return F.struct(start.alias("start"), (start + F.length(instance)).alias("end"), instance.alias("instance"), w["pattern"].alias("pattern"))

    return F.filter(
        F.transform(words, core),
        lambda c: (F.length(c["instance"]) >= MIN_CHARS) & (F.length(_digits(c["instance"])) >= MIN_DIGITS) & (c["pattern"] != "")
        & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )


def candidates(scanned: DataFrame) -> DataFrame:
    """Seeds, and digit words outside them long enough for an identifier: doc_id, start, end, instance, pattern, seed."""
    seeds = scanned.select("doc_id", F.explode("seeds").alias("w")).select(
        "doc_id", "w.start", (F.col("w.start") + F.length("w.s")).alias("end"), F.col("w.s").alias("instance"), "w.pattern",
        F.lit(True).alias("seed"),
    )
    others = scanned.select("doc_id", F.explode(_cores(F.col("words"), F.col("base"))).alias("w")).select(
        "doc_id", "w.start", "w.end", "w.instance", "w.pattern", F.lit(False).alias("seed")
    )
    return seeds.unionByName(others).filter("pattern <> ''")


def score_patterns(words: DataFrame, scratch: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """pattern, confidence, support after some rounds over the pattern-instance graph.

    A pattern's confidence is the mean confidence of its instances, lowered for few of
    them; an instance that is no seed has, towards each pattern, the best confidence of
    its other patterns, so that no pattern lifts itself.  Each round's scores are written under
    ``scratch`` (a new folder, unless one is given), so the plan does not grow with the rounds.
    """
    scratch = scratch or scratch_folder(words.sparkSession, "pii-rounds")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{scratch}/{name}")
        return words.sparkSession.read.parquet(f"{scratch}/{name}")

    edges = words.groupBy("pattern", "instance").agg(F.max(F.col("seed").cast("double")).alias("seed"))
    seeds = words.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("conf"))

    def patterns(trusted: DataFrame) -> DataFrame:
        return trusted.groupBy("pattern").agg((F.sum("conf") / (F.count("*") + 1)).alias("confidence"), F.count("*").alias("support"))

    known = written(edges.join(seeds, "instance").select("pattern", "instance", "conf"), "edges")
    edges, scored = known.select("pattern", "instance"), written(patterns(known), "scores0")
    for n in range(1, rounds):
        # Only patterns with some confidence can lift an instance; the rest need no message.
        messages = edges.join(scored.filter("confidence > 0"), "pattern").select("pattern", "instance", "confidence")
        best = messages.groupBy("instance").agg(F.max(F.struct("confidence", "pattern")).alias("best"))
        second = messages.join(best, "instance").filter("pattern <> best.pattern").groupBy("instance").agg(
            F.max("confidence").alias("second")
        )
        other = F.when(F.col("pattern") == F.col("best.pattern"), F.col("second")).otherwise(F.col("best.confidence"))
        lifted = known.join(best, "instance", "left").join(second, "instance", "left")
        lifted = lifted.select("pattern", F.greatest("conf", F.coalesce(other, F.lit(0.0))).alias("conf"))
        scored = written(patterns(lifted), f"scores{n}")
    return scored


def context_spans(words: DataFrame, confidence: float = CONFIDENCE, support: int = MIN_SUPPORT) -> DataFrame:
    """doc_id and its ``context`` spans: unseen identifiers after patterns of high confidence."""
    trusted = score_patterns(words).filter((F.col("confidence") >= confidence) & (F.col("support") >= support))
    return (
        words.filter(~F.col("seed")).join(trusted.select("pattern"), "pattern", "left_semi")
        .groupBy("doc_id").agg(F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end")).alias("more"))
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, base spans, seeds and digit words of every row."""
    inner = key_text(docs).withColumn("digest", F.xxhash64("text"))
    return with_spans(inner).select("doc_id", "digest", "base", "seeds", "words")


def trusted_patterns(scanned: DataFrame, scratch: str, confidence: float = CONFIDENCE, support: int = MIN_SUPPORT) -> DataFrame:
    """Context patterns of high confidence, written under ``scratch``."""
    spark = scanned.sparkSession
    candidates(scanned).select("instance", "pattern", "seed").write.parquet(f"{scratch}/words")
    scored = score_patterns(spark.read.parquet(f"{scratch}/words"), f"{scratch}/rounds")
    scored.filter((F.col("confidence") >= confidence) & (F.col("support") >= support)).select("pattern").write.parquet(f"{scratch}/trusted")
    return spark.read.parquet(f"{scratch}/trusted")


def _all_spans(more: Column) -> Column:
    found = F.transform(more, lambda c: F.struct(c["start"].alias("start"), F.lit(4).alias("kind"), c["end"].alias("end")))
    return F.array_sort(F.array_distinct(F.concat("base", found)))


def with_all_spans(scanned: DataFrame, trusted: DataFrame) -> DataFrame:
    """``scanned`` (doc_id, digest, base, words and others) with ``spans``: base spans and unseen identifiers."""
    cores = scanned.withColumn("cores", _cores(F.col("words"), F.col("base"))).drop("words")
    size = trusted.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("pattern")), F.lit(0)).alias("chars")).first()
    if size.n <= MOST and size.chars <= MOST_CHARS:
        known = [r.pattern for r in trusted.collect()]
        own = F.filter("cores", lambda c: c["pattern"].isin(known)) if known else F.filter("cores", lambda c: F.lit(False))
        return cores.withColumn("spans", _all_spans(own)).drop("cores")
    hits = (
        cores.select("doc_id", "digest", F.explode("cores").alias("c")).withColumn("pattern", F.col("c.pattern"))
        .join(trusted, "pattern", "left_semi").groupBy("doc_id", "digest").agg(F.collect_set("c").alias("more"))
        .withColumnsRenamed({"doc_id": "d", "digest": "g"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("digest").eqNullSafe(F.col("g"))
    joined = cores.join(hits, same, "left").drop("d", "g")
    none = F.filter("cores", lambda c: F.lit(False))
    return joined.withColumn("spans", _all_spans(F.coalesce("more", none))).drop("cores", "more")


def find(docs: DataFrame, scratch: str) -> DataFrame:
    """doc_id, base spans and all spans of every row."""
    scan(docs).write.parquet(f"{scratch}/scan")
    scanned = docs.sparkSession.read.parquet(f"{scratch}/scan")
    return with_all_spans(scanned, trusted_patterns(scanned, scratch)).select("doc_id", "base", "spans")


def mask(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones as one) replaced by its kind in brackets."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def step(acc: Column, s: Column) -> Column:
        keep = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"), F.concat(acc["out"], F.array(keep, F.element_at(names, s["kind"] + 1))).alias("out")
        )).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    zero = F.expr("struct(0 as at, cast(array() as array<string>) as out)")
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, zero, step,
        lambda acc: F.array_join(F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, F.length(text)))), ""),
    ))


def redact(docs: DataFrame, scratch: str) -> DataFrame:
    """``docs`` with personal data in ``text`` masked; other columns and all rows stay.

    The texts are read twice: for the patterns, and to be masked where they are.
    """
    trusted = trusted_patterns(scan(docs), scratch)
    row = F.struct(*[f"`{c}`" for c in docs.columns]).alias("row")
    inner = docs.select(row, F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = with_spans(inner.withColumn("digest", F.xxhash64("text"))).drop("seeds")
    masked = with_all_spans(marked, trusted).select("row", mask(F.col("text"), F.col("spans")).alias("masked"))
    return masked.select(*(F.col("masked").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def _listed(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    ), ",")


def _counted(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"), scratch_folder(spark, "pii"))
    counts = [_counted(k).cast("bigint").alias(f"n_{KINDS[k]}") for k in range(4)]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))

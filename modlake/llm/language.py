"""Language identification by interpolated Kneser-Ney character models.

Letters are folded to lower case, everything else is one space.  Four-character strings are
counted by Spark and all of them are kept; the lower orders use continuation counts.  Every
language's model is a set of sorted arrays of mixed keys with log probabilities and
back-off weights.  A text gets the language of lowest cross-entropy per character, and
is rejected if that is far above what held training texts of that language show.

Bounds: each language is fitted on all its labelled rows, or, where it has more, on about
``fit_rows`` of them chosen by a hash of id and text, each text whole; none of their strings is left out,
so the languages and each one's discounts and counts never depend on other languages.  The broadcast has
about 40 bytes for each distinct string of a language.  Calibration uses about ``sample`` labelled
rows per language, chosen by a hash of their id.  Scoring covers all texts whole.

Texts that are null or have no letter get ``und``, score 0 and are rejected.  With no
labelled text at all nothing is learned: every text is ``und`` and none with a letter is rejected.
Ties go to the first language by name.  Each input row gives one row; columns of the
input whose names the result needs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modlake.llm.common import slices, table, utf8, without

ORDER, SPACE = 4, 32
FIT_ROWS, CALIBRATION_ROWS = 20_000, 2_000
#: A letter, or a code point that Java's tables do not know yet.
LETTER = r"[\p{L}\p{Cn}]"
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Text bytes of one numpy step; its arrays take some fifty times as much.
SLICE = 1 << 20


def letter_table() -> np.ndarray:
    """Folded code of every code point: lower-case letter, or a space for all else."""
    codes = np.full(0x110000, SPACE, np.uint16)
    for c in range(0x110000):
        letter = chr(c)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            codes[c] = low if low < 0xFFFF else 0xFFFF
    return codes


def grams(batch: pa.RecordBatch, column: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed strings of four characters, the row each belongs to, and letters per row."""
    data, ends = utf8(batch.column(column))
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[ends]
    sizes = np.diff(begins)
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    pad = ORDER - 1
    folded = codes[points]
    letters = np.bincount(row[folded != SPACE], minlength=len(sizes))
    blank = folded == SPACE
    keep = ~blank
    keep[1:] |= ~blank[:-1] & (row[1:] == row[:-1])  # the first space of a run after a letter
    folded, row = folded[keep], row[keep]
    out = np.full(len(folded) + pad * (len(sizes) + 1), SPACE, np.uint64)
    at = np.arange(len(folded)) + pad * (row.astype(np.int64) + 1)
    out[at] = folded
    pairs = (out[:-1] << np.uint64(16)) | out[1:]
    fours = (pairs[:-2] << np.uint64(32)) | pairs[2:]
    return fours[at - pad], row, letters


def count_grams(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, gram, n over all labelled texts of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, held = letter_table(), {}
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                g, row, _ = grams(part, "text", codes)
                names, of = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
                which = of[row]
                for k, name in enumerate(names):
                    u, n = np.unique(g[which == k], return_counts=True)
                    held.setdefault(name, []).append((u, n))
                    if len(held[name]) > 8:
                        held[name] = [_summed(held[name])]
        for name, parts in held.items():
            u, n = _summed(parts)
            for a in range(0, len(u), 50_000):
                m = len(u[a : a + 50_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * m), pa.array(u[a : a + m].view(np.int64)), pa.array(n[a : a + m])],
                    names=["lang", "gram", "n"],
                )

    labelled = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).filter(
        "text is not null and lang is not null"
    )
    rows = labelled.mapInArrow(work, "lang string, gram bigint, n bigint")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, of = np.unique(np.concatenate([u for u, _ in parts]), return_inverse=True)
    return keys, np.bincount(of, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


#: One language's log probabilities: orders[n] has (keys, log p, context keys, log weight); unknown is for
#: characters never seen.  A plain dict, so that a broadcast needs no code of this folder.
Model = dict


def _mixed(keys: np.ndarray) -> np.ndarray:
    h = keys * MIX
    return h ^ (h >> np.uint64(32))


def _arrays(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = _mixed(keys)
    order = np.argsort(mixed)
    return mixed[order], values[order].astype(np.float32)


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.float32)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, values[at]


def fit(keys: np.ndarray, counts: np.ndarray) -> Model:
    """Interpolated Kneser-Ney from the counts of four-character strings."""
    model, levels = Model(orders={}, unknown=0.0), {ORDER: (keys, counts.astype(np.float64))}
    for n in range(ORDER - 1, 0, -1):
        u, c = np.unique(levels[n + 1][0] & np.uint64((1 << 16 * n) - 1), return_counts=True)
        levels[n] = (u, c.astype(np.float64))
    lower_keys, lower = None, None
    for n in range(1, ORDER + 1):
        k, c = levels[n]
        ones, twos = (c == 1).sum(), (c == 2).sum()
        d = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
        ctx, of = np.unique(k >> np.uint64(16), return_inverse=True)
        total, kinds = np.bincount(of, c), np.bincount(of)
        weight = d * kinds / total
        if n == 1:
            below = np.full(len(k), 1.0 / (len(k) + 1))
            model["unknown"] = float(np.log(weight[0] / (len(k) + 1)))
        else:
            below = lower[np.searchsorted(lower_keys, k & np.uint64((1 << 16 * (n - 1)) - 1))]
        p = np.maximum(c - d, 0) / total[of] + weight[of] * below
        lower_keys, lower = k, p
        model["orders"][n] = (*_arrays(k, np.log(p)), *_arrays(ctx, np.log(weight)))
    return model


def log_probs(model: Model, g: np.ndarray) -> np.ndarray:
    """Log probability of the last character of each string given the ones before it."""
    out = np.zeros(len(g), np.float32)
    todo, rest = np.arange(len(g)), g
    for n in range(ORDER, 0, -1):
        keys, values, ctx, weights = model["orders"][n]
        part = rest & np.uint64((1 << 16 * n) - 1 if n < 4 else 0xFFFFFFFFFFFFFFFF)
        found, p = _look(keys, values, _mixed(part))
        out[todo[found]] += p[found]
        todo, rest, part = todo[~found], rest[~found], part[~found]
        if n > 1:
            seen, w = _look(ctx, weights, _mixed(part >> np.uint64(16)))
            out[todo[seen]] += w[seen]
    out[todo] += model["unknown"]
    return out


def entropies(batch: pa.RecordBatch, column: str, codes: np.ndarray, models: list[Model]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cross-entropy per character for each row and language, characters and letters of each row."""
    g, row, letters = grams(batch, column, codes)
    kinds, of = np.unique(g, return_inverse=True)
    sums = np.empty((batch.num_rows, len(models)))
    for k, model in enumerate(models):
        sums[:, k] = np.bincount(row, log_probs(model, kinds)[of], batch.num_rows)
    n = np.bincount(row, minlength=batch.num_rows)
    return -sums / np.maximum(n, 1)[:, None], n, letters


@dataclass
class Identifier:
    """Learned languages, their models, and the calibration of the rejection."""

    names: list[str]
    models: list[Model]
    mean: np.ndarray
    limit: np.ndarray


def _excess(h: np.ndarray, n: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """How far a cross-entropy is above the usual; short texts may vary more."""
    return (h - mean) / (1 + 8 / np.sqrt(np.maximum(n, 1)))


def fit_sample(labelled: DataFrame, text: str, lang: str, key: str, fit_rows: int) -> DataFrame:
    """text and lang of about ``fit_rows`` labelled rows with letters per language, of all where it has fewer."""
    drawn = labelled.select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.col(key).cast("string"), F.col(text)), F.lit(1 << 30)).alias("draw"),
    ).filter(F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    # The lowest draw is always in, so that no language can vanish.
    below = drawn.groupBy(F.col("lang").alias("l")).agg(
        F.greatest(F.lit(float(fit_rows)) / F.count("*") * (1 << 30), F.min("draw") + 1.0).alias("below")
    )
    return drawn.join(F.broadcast(below), F.col("lang") == F.col("l")).filter("draw < below").select("text", "lang")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          fit_rows: int = FIT_ROWS, sample: int = CALIBRATION_ROWS) -> Identifier:
    """Fit each language's model and its rejection on a bounded number of its labelled rows."""
    rows = count_grams(fit_sample(labelled, text, lang, key, fit_rows), "text", "lang").toArrow()
    coded = rows.column("lang").combine_chunks().dictionary_encode()
    labels, lang_of = coded.dictionary.to_pylist(), np.asarray(coded.indices)
    gram, n = (np.asarray(rows.column(c).combine_chunks()) for c in ("gram", "n"))
    names, models = sorted(labels), []
    for name in names:
        own = np.flatnonzero(lang_of == labels.index(name))
        own = own[np.argsort(gram[own].view(np.uint64))]
        models.append(fit(gram[own].view(np.uint64), n[own]))
    found = Identifier(names, models, np.zeros(len(names)), np.full(len(names), np.inf))
    if not names:
        return found
    share = labelled.filter(F.col(text).isNotNull()).groupBy(F.col(lang).cast("string").alias("l")).count()
    share = share.filter(F.col("l").isin(names)).select("l", (F.lit(float(sample)) / F.col("count")).alias("share"))
    picked = labelled.join(F.broadcast(share), F.col(lang).cast("string") == F.col("l")).filter(
        F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    )
    spark, codes_of = labelled.sparkSession, {n: k for k, n in enumerate(names)}
    shared = spark.sparkContext.broadcast(models)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = letter_table()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                h, n, letters = entropies(part, "text", codes, shared.value)
                which = np.array([codes_of[x] for x in part.column("lang").to_pylist()])
                own = h[np.arange(len(which)), which]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which), pa.array(own), pa.array(n.astype(np.int64) * (letters > 0))], names=["k", "h", "n"]
                )

    seen = picked.select(F.col(text).alias("text"), F.col("l").alias("lang")).mapInArrow(work, "k bigint, h double, n bigint")
    seen = seen.filter("n > 0").toPandas()
    for k in range(len(names)):
        own = seen[seen.k == k]
        if len(own):
            found.mean[k] = np.average(own.h, weights=own.n)
            found.limit[k] = 0.2 + 1.5 * max(0.0, _excess(own.h.to_numpy(), own.n.to_numpy(), found.mean[k]).max())
    return found


def identify(docs: DataFrame, model: Identifier, text: str = "text") -> DataFrame:
    """All rows and columns with lang_pred, score (0 to 1), cross_entropy and accepted."""
    names, shared = model.names, docs.sparkSession.sparkContext.broadcast((model.models, model.mean, model.limit))
    rest = without(docs, "lang_pred", "score", "cross_entropy", "accepted")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, known = letter_table(), shared.value
        for batch in batches:
            for part in slices(batch, text, SLICE):
                yield _predicted(part, text, codes, known, names)

    kinds = [("lang_pred", "string"), ("score", "double"), ("cross_entropy", "double"), ("accepted", "boolean")]
    schema = T.StructType(list(rest.schema.fields))
    for name, kind in kinds:
        schema = schema.add(name, kind)
    return rest.mapInArrow(work, schema)


def _predicted(part: pa.RecordBatch, text: str, codes: np.ndarray, known: tuple, names: list[str]) -> pa.RecordBatch:
    rows = np.arange(part.num_rows)
    if not names:
        _, _, letters = grams(part, text, codes)
        h, n = np.zeros((part.num_rows, 1)), letters
        best = np.zeros(part.num_rows, np.int64)
    else:
        h, n, letters = entropies(part, text, codes, known[0])
        best = h.argmin(axis=1)
    low = h[rows, best]
    worded = letters > 0
    learned = worded & bool(names)
    gap = np.minimum((h - low[:, None]) * np.minimum(n, 200)[:, None], 700)
    score = np.where(learned, 1 / np.exp(-gap).sum(axis=1), 0.0)
    accepted = worded.copy()
    if names:
        accepted &= _excess(low, n, known[1][best]) <= known[2][best]
    labels = [names[k] if ok else "und" for k, ok in zip(best, learned, strict=True)]
    more = [pa.array(labels, pa.string()), pa.array(score), pa.array(np.where(learned, low, 0.0)), pa.array(accepted)]
    return pa.RecordBatch.from_arrays(
        [*part.columns, *more], names=[*part.schema.names, "lang_pred", "score", "cross_entropy", "accepted"]
    )


def held_out(docs: DataFrame) -> DataFrame:
    """The fold rule: a row is held out if crc32 of its id as text leaves 2 by 4."""
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return docs.withColumn("held_out", F.coalesce(remainder == 2, F.lit(False)))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = held_out(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    model = train(docs.filter(~F.col("held_out")))
    return identify(docs.select("doc_id", "text", "held_out"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "accepted", "cross_entropy"
    )

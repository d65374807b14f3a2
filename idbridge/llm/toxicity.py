"""Toxicity from two Kneser-Ney models, one of toxic and one of ordinary text.

The models are over bytes, folded to 32 symbols, of order 5: toxic words show
in what follows their beginnings, also when inflected or glued to others. The
ordinary model's discounted counts back off to a shared distribution, made
from the continuation counts of the 5-gram types of both classes; the toxic
model's back off to the ordinary one, so an expression too rare to be told
apart scores the same in both. A text's value is its log likelihood ratio per
byte, less what each context's ratio would be on average in ordinary text:
ordinary text of any language then has a mean of 0. A logistic curve turns it
into a score. The curve is fitted on all labelled rows, each valued by a model
that has counted only the other half of them.

All labelled rows are counted. Tasks send one entry per 5-gram type; there are
32**5 types at most, so the tables after the sum have a bound that does not
depend on the input: 32 MB a model, one byte per 5-gram, sent compressed to the scoring tasks.

Defined results: a null text is empty, an empty one has a ratio of 0; rows of
a doc_id with several labels count as toxic if one says so; null labels or
doc_ids teach nothing; without labels of both classes all texts get the share
of toxic rows (one half if there are none); every row gives one row.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Store, likely_rows, small_batches
from .words import chunks, utf8

BITS, ORDER = 5, 5
SYMBOLS = 1 << BITS
MASK = (1 << BITS * ORDER) - 1
CONTEXT = 1 << BITS * (ORDER - 1)
GROUP = 3 * BITS  # a group of the last step: the 5-grams of one two-symbol start

# Bytes to symbols: 0 white space, 1-26 letters, 27 digits, 28 ASCII signs,
# 29-31 bytes of other characters.
FOLD = np.empty(256, np.uint32)
FOLD[:128] = 28
FOLD[:33] = 0
FOLD[0x30:0x3A] = 27
FOLD[0x41:0x5B] = FOLD[0x61:0x7B] = np.arange(1, 27)
FOLD[128:] = 29 + np.arange(128) % 3
LABEL_WORDS = 1 << 20  # rows of 64 doc_ids' labels that are broadcast: 24 MB at most
STEP = 1 / 12  # of the stored log ratios
STRENGTH = 30.0  # toxic observations of a context that weigh as much as the ordinary model


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The code of the 5-gram that ends at every byte; texts begin after
    white space."""
    s = FOLD[data]
    code, before = s.copy(), s
    start = offsets[:-1][offsets[:-1] < offsets[1:]]
    for k in range(1, ORDER):
        before = np.concatenate((np.zeros(1, np.uint32), before[:-1])) if len(before) else before
        before[start] = 0
        code |= before << np.uint32(BITS * k)
    return code


COUNTS = ("t0", "o0", "t1", "o1")  # toxic and ordinary, in both halves
MODELS = {"ratio": (0, 1), "without0": (1,), "without1": (0,)}  # the halves that each model counts


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """5-gram types of the task with their counts by class and half."""
    held: list[tuple[np.ndarray, ...]] = []

    def merged() -> tuple[np.ndarray, ...]:
        code, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        return (code, *(np.bincount(at, np.concatenate([h[k] for h in held]), len(code)) for k in range(1, 5)))

    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        which = 2 * batch.column("half").to_numpy(zero_copy_only=False) + 1 - batch.column("toxic").to_numpy(zero_copy_only=False)
        for i, j in chunks(offsets, 1 << 22):
            code = grams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            types, at = np.unique(code, return_inverse=True)
            own = np.repeat(which[i:j].astype(np.int64), np.diff(offsets[i:j + 1]))
            n = np.bincount(at * 4 + own, minlength=4 * len(types)).reshape(-1, 4)
            held.append((types, *n.T))
            if len(held) > 16:
                held = [merged()]
    if held:
        every = merged()
        for a in range(0, len(every[0]), 1 << 16):
            part = [pa.ListArray.from_arrays(pa.array([0, len(x[a:a + (1 << 16)])], pa.int32()),
                                             pa.array(x[a:a + (1 << 16)].astype(np.int64))) for x in every]
            yield pa.RecordBatch.from_arrays(part, names=["code", *COUNTS])


def discount(counts: np.ndarray) -> float:
    one, two = (counts == 1).sum(), (counts == 2).sum()
    return float(one / (one + 2 * two)) if one else 0.5


def shared_backoff(codes: np.ndarray, lefts: np.ndarray) -> np.ndarray:
    """The shared distribution of a symbol after three others, dense: from
    ``lefts``, how many symbols precede each 4-gram type."""
    n = np.zeros(CONTEXT)
    n[codes] = lefts
    levels = [n.reshape((SYMBOLS,) * (ORDER - 1))]
    while levels[-1].ndim > 1:
        levels.append((levels[-1] > 0).sum(axis=0).astype(float))
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for n in reversed(levels):
        total, d = n.sum(axis=-1, keepdims=True), discount(n[n > 0])
        kinds = (n > 0).sum(axis=-1, keepdims=True)
        seen = (np.maximum(n - d, 0) + d * kinds * p) / np.maximum(total, 1)
        p = np.where(total > 0, seen, np.broadcast_to(p, n.shape))
    return p.reshape(-1)


def _smoothed(n: np.ndarray, d: float, strength: float, back: np.ndarray) -> np.ndarray:
    """Discounted counts, the rest from ``back``; ``strength``: how many
    observations of a context weigh as much as ``back``."""
    total, kinds = n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True)
    seen = (np.maximum(n - d, 0) + (strength + d * kinds) * back) / np.maximum(total + strength, 1e-9)
    return np.where(total > 0, seen, back)


def _ratios(table: pa.Table, shared: np.ndarray, d: dict[str, float], strength: float) -> pa.Table:
    """Log ratios of all 5-grams of one two-symbol start, a byte each before
    compression, for every model."""
    group, at = table["g"][0].as_py(), table["code"].to_numpy() & ((1 << GROUP) - 1)
    back = shared.reshape(SYMBOLS, -1)[group % SYMBOLS].reshape(-1, SYMBOLS)  # by its second symbol and two more
    rows = []
    for halves in MODELS.values():
        n = {}
        for c in "to":
            n[c] = np.zeros(1 << GROUP)
            n[c][at] = sum(table[f"{c}{k}"].to_numpy() for k in halves)
            n[c] = n[c].reshape(-1, SYMBOLS)
        ordinary = _smoothed(n["o"], d["o"], 0.0, back)
        toxic = _smoothed(n["t"], d["t"], strength, ordinary)
        ratio = np.log(toxic / ordinary)
        ratio -= (ordinary * ratio).sum(axis=1, keepdims=True)
        rows.append(zlib.compress(np.clip(np.rint(ratio / STEP), -127, 127).astype(np.int8).tobytes(), 1))
    return pa.table({"g": pa.array([group] * len(rows), pa.int32()), "model": pa.array(list(MODELS)),
                     "row": pa.array(rows, pa.binary())})


@dataclass(frozen=True)
class Ratios:
    """Compressed log ratios: (start of two symbols, model, bytes)."""

    id: str
    rows: list[tuple[int, str, bytes]]


@lru_cache(maxsize=1)
def _tables(id_: str) -> dict[str, np.ndarray]:
    return {m: np.zeros(MASK + 1, np.int8) for m in MODELS}


def tables(ratios: Ratios) -> dict[str, np.ndarray]:
    """Log ratios (in steps) of all 5-grams by model; opened once per worker."""
    out = _tables(ratios.id)
    if "open" not in out:
        for g, m, row in ratios.rows:
            out[m][g << GROUP:(g + 1) << GROUP] = np.frombuffer(zlib.decompress(row), np.int8)
        out["open"] = np.empty(0, np.int8)
    return {m: out[m] for m in MODELS}


def fit(labelled: DataFrame, store: Store, strength: float = STRENGTH) -> Ratios:
    """The models of rows (text, toxic and half: 0 or 1)."""
    counted = labelled.mapInArrow(_counts, ", ".join(f"{c} array<bigint>" for c in ("code", *COUNTS)))
    counted = counted.select(F.explode(F.arrays_zip("code", *COUNTS)).alias("x")).select("x.*")
    counted = store.put(counted.groupBy("code").agg(*[F.sum(c).alias(c) for c in COUNTS]), "grams")
    both = {c: F.col(f"{c}0") + F.col(f"{c}1") for c in "to"}
    n = counted.agg(*[F.count_if(both[c] == k).alias(f"{c}_{k}") for c in "to" for k in (1, 2)],
                    *[F.coalesce(F.sum(both[c]), F.lit(0)).alias(c) for c in "to"]).first()
    if not n["t"] or not n["o"]:
        return Ratios(uuid.uuid4().hex, [])
    d = {c: n[f"{c}_1"] / (n[f"{c}_1"] + 2 * n[f"{c}_2"]) if n[f"{c}_1"] else 0.5 for c in "to"}
    left = (counted.groupBy((F.col("code") % CONTEXT).cast("int").alias("c")).agg(F.count(F.lit(1)).cast("int").alias("n"))
            .toPandas())  # at most 32**4 rows
    back = labelled.sparkSession.sparkContext.broadcast(shared_backoff(left["c"].to_numpy(), left["n"].to_numpy()))
    rows = (counted.withColumn("g", F.shiftright("code", GROUP).cast("int")).groupBy("g")
            .applyInArrow(lambda t: _ratios(t, back.value, d, strength), "g int, model string, row binary"))
    # at most 32**5 bytes for each model before compression
    return Ratios(uuid.uuid4().hex, [(r["g"], r["model"], bytes(r["row"])) for r in rows.collect()])


def _mean_ratio(batches: Iterator[pa.RecordBatch], packed: Ratios) -> Iterator[pa.RecordBatch]:
    ratios = tables(packed)
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        z = {m: np.zeros(batch.num_rows) for m in ratios}
        for i, j in chunks(offsets, 1 << 18):
            cut = offsets[i:j + 1] - offsets[i]
            code = grams(data[offsets[i]:offsets[j]], cut)
            for m, table in ratios.items():
                total = np.concatenate(([0], np.cumsum(table[code], dtype=np.int64)))[cut]
                z[m][i:j] = np.diff(total) * STEP / np.maximum(np.diff(cut), 1)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, z.values())], names=["doc_id", *z])


@dataclass(frozen=True)
class Curve:
    """score = 1 / (1 + exp(-(slope * ratio + base)))."""

    slope: float
    base: float


def calibrate(rows: DataFrame, bins: int = 4000, width: float = 1 / 2000) -> Curve:
    """Logistic regression of the label on the ratio, from counts per bin of
    the ratio: all rows count, the driver gets at most ``bins`` of them."""
    bin_ = F.least(F.greatest(F.round(F.col("ratio") / width), F.lit(-bins / 2)), F.lit(bins / 2))
    got = rows.groupBy(bin_.alias("b")).agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).toPandas()
    got = got.sort_values("b")  # the same sums on every run
    x, t, n = (got[c].to_numpy(np.float64) for c in "btn")
    x = x * width
    total, bad = n.sum(), t.sum()
    if not 0 < bad < total or np.ptp(x) == 0:
        share = (bad + 0.5) / (total + 1)
        return Curve(0.0, float(np.log(share / (1 - share))))
    scale = max(1e-6, float(np.sqrt((n * (x - (n * x).sum() / total) ** 2).sum() / total)))
    feats = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(feats @ w, -30, 30)))
        grad = feats.T @ (t - n * p) - 1e-3 * w
        hess = (feats * (n * p * (1 - p))[:, None]).T @ feats + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        w += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return Curve(float(w[0] / scale), float(w[1]))


def labelled(docs: DataFrame, learned: DataFrame, half: Column, store: Store) -> DataFrame:
    """The rows of ``docs`` with a label: text, toxic, half.

    Labels are held as bits, 64 neighbouring doc_ids a row, which is exact. Up to
    ``LABEL_WORDS`` such rows (counted first) are broadcast, and no text is shuffled;
    beyond that the labelled texts meet their labels in a shuffled join."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("doc_id").cast("bigint").bitwiseAND(F.lit(63)).cast("int"))
    word = F.shiftright(F.col("doc_id").cast("bigint"), 6)
    words = store.put(learned.select(word.alias("w"), bit.alias("b"), "toxic").groupBy("w")
                      .agg(F.bit_or("b").alias("known"), F.bit_or(F.when(F.col("toxic") == 1, F.col("b")).otherwise(0)).alias("bad")),
                      "words")
    if words.count() > LABEL_WORDS:
        return likely_rows(docs, "doc_id", learned, "doc_id").join(learned, "doc_id").select("text", "toxic", "half")
    told = docs.withColumn("w", word).join(F.broadcast(words), "w").where(F.col("known").bitwiseAND(bit) != 0)
    return told.select("text", (F.col("bad").bitwiseAND(bit) != 0).cast("int").alias("toxic"),
                       half.cast("int").alias("half"))


def score_toxicity(docs: DataFrame, labels: DataFrame, teaches: Column, half: Column, store: Store) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, ratio, score, one row per row.
    ``labels`` (doc_id, toxic) are learned where ``teaches`` holds; ``half``
    deals them to two halves, 0 and 1 (both on doc_id)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    learned = store.put(labels.where("doc_id is not null and toxic is not null").where(teaches).groupBy("doc_id")
                        .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).withColumn("half", half.cast("int")), "labels")
    ratios = spark.sparkContext.broadcast(fit(labelled(docs, learned, half, store), store))
    schema = docs.select("doc_id").schema
    for m in MODELS:
        schema = schema.add(m, T.DoubleType())
    valued = store.put(docs.mapInArrow(lambda it: _mean_ratio(it, ratios.value), schema), "ratios")
    other = F.when(F.col("half") == 0, F.col("without0")).otherwise(F.col("without1"))
    curve = calibrate(valued.join(learned, "doc_id").select(other.alias("ratio"), "toxic"))
    return valued.select("doc_id", "ratio", (1 / (1 + F.exp(-(curve.slope * F.col("ratio") + curve.base)))).alias("score"))

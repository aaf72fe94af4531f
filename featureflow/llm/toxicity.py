"""Toxicity by a linear classifier on naive-Bayes-scaled character n-grams.

A text's features are the different character n-grams (3 to 6 bytes of the
lower-cased text, white space as one blank) it holds, hashed to ``WIDTH`` slots.
Each is scaled by its log-count ratio, the log of how much likelier it is in
toxic than in other labelled texts, and a logistic regression is fitted on the
scaled features. Slots whose ratio says nothing are left out.

Fitting uses a bounded sample of the labelled rows given to it: at most
``SAMPLE`` texts of each label, the ones with the least digests of their id.
Scoring is row by row over whole texts, without a shuffle.

Defined cases: null or empty texts have no n-grams and score by the bias alone;
rows without a label are not learnt from, and a document with several labels
counts as toxic if one says so; without labelled rows of both kinds every score
is the share of toxic ones (0.5 if none are labelled); repeated rows are scored
one by one; an empty table gives an empty table; columns beside id and text are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import stored
from featureflow.llm.linear import fit_logistic, sigmoid
from featureflow.llm.shingles import mix

SAMPLE = 8000  # labelled texts of each label
ORDERS = (3, 4, 5, 6)
BITS = 22
WIDTH = 1 << BITS
LEAST_DOCS = 6
LEAST_RATIO = 1.0
SMOOTH = 10.0  # pseudo-documents, shared by the labels in proportion
PIECE = 1 << 20  # bytes hashed at a time

_rng = np.random.default_rng(41)
_TABLE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_TABLE[65:91] = _TABLE[97:123]
_TABLE[[9, 10, 11, 12, 13]] = _TABLE[32]
_P = np.uint64(0x9E3779B97F4A7C15)


def _slots(piece: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the slot of the n-gram that starts at each byte."""
    b = _TABLE[piece]
    h = b.copy()
    for n in range(2, ORDERS[-1] + 1):
        if len(piece) < n:
            return
        h = h[:-1] * _P + b[n - 1:]
        if n in ORDERS:
            yield (mix(h + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: list[bytes], seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) pairs, each once, in order; only slots marked in ``seen``.

    Texts are laid end to end with a blank around each, in pieces that overlap
    by the longest n-gram; an n-gram over the seam of two texts is dropped.
    """
    pairs = []

    def add(data: np.ndarray, ends: np.ndarray, first: int):
        sizes = np.diff(ends, prepend=0)
        text, end = np.repeat(np.arange(len(ends)) + first, sizes), np.repeat(ends, sizes)
        for n, slot in zip(ORDERS, _slots(data)):
            at = np.flatnonzero(seen[slot]) if seen is not None else np.arange(len(slot))
            at = at[at + n <= end[at]]
            pairs.append(text[at] * WIDTH + slot[at])

    group, size, first = [], 0, 0
    for i, t in enumerate(texts):
        if len(t) > PIECE:
            for lo in range(0, len(t), PIECE):
                part = (b" " if lo == 0 else b"") + t[max(0, lo - ORDERS[-1] + 1):lo + PIECE] + (b" " if lo + PIECE >= len(t) else b"")
                add(np.frombuffer(part, np.uint8), np.array([len(part)]), i)
            t = b""
        elif size + len(t) > PIECE and group:
            add(np.frombuffer(b"".join(group), np.uint8), np.cumsum([len(x) for x in group]), first)
            group, size = [], 0
        if not group:
            first = i
        group.append(b" " + t + b" " if t else b"")
        size += len(t)
    if group:
        add(np.frombuffer(b"".join(group), np.uint8), np.cumsum([len(x) for x in group]), first)
    key = np.sort(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    return key // WIDTH, key % WIDTH


def _texts(column: pa.Array) -> Iterator[list[bytes]]:
    group, size = [], 0
    for x in column:
        group.append(x.as_py() or b"")
        size += len(group[-1])
        if size >= 1 << 20:
            yield group
            group, size = [], 0
    if group:
        yield group


@dataclass(frozen=True)
class ToxicityModel:
    slots: np.ndarray  # sorted
    weights: np.ndarray  # regression weight times ratio
    bias: float


def sample_labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> DataFrame:
    """(text, y) of at most ``sample`` labelled texts of each label."""
    y = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max((F.col(label_col) != 0).cast("int")).alias("y"))
    # the join on ids comes before the choice, so that labels of absent rows choose nothing
    ids = docs.select(F.col(id_col).alias("id")).join(y, F.col("id") == F.col("_id")).select("id", "y").distinct()
    least = [ids.where(F.col("y") == k).orderBy(F.xxhash64(F.col("id")), "id").limit(sample) for k in (0, 1)]
    chosen = stored(least[0].union(least[1]), "toxic-sample")  # at most 2 * sample rows
    text = docs.select(F.col(id_col).alias("_i"), F.col(text_col).cast("binary").alias("text"))
    text = text.join(F.broadcast(chosen), F.col("_i") == F.col("id")).dropDuplicates(["id"]).select("id", "text", "y")
    return stored(text, "toxic-texts")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE) -> ToxicityModel:
    rows = sample_labelled(docs, labels, id_col, text_col, label_col, sample)
    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    if not n0 or not n1:
        share = (n1 + 0.5) / (n0 + n1 + 1)
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))

    def count(batches):
        table = np.zeros((2, WIDTH), np.int32)
        for b in batches:
            y, at = b.column(1).to_numpy(), 0
            for texts in _texts(b.column(0)):
                text, slot = features(texts)
                toxic = y[at:at + len(texts)][text] == 1
                table[0] += np.bincount(slot[~toxic], minlength=WIDTH).astype(np.int32)
                table[1] += np.bincount(slot[toxic], minlength=WIDTH).astype(np.int32)
                at += len(texts)
        slot = np.flatnonzero(table.any(0))
        for lo in range(0, len(slot), 1 << 16):
            part = slot[lo:lo + (1 << 16)]
            yield pa.record_batch([pa.array(part), pa.array(table[0, part]), pa.array(table[1, part])], names=["slot", "c0", "c1"])

    counts = rows.select("text", "y").coalesce(12).mapInArrow(count, "slot long, c0 int, c1 int").groupBy("slot").agg(
        F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    s0, s1 = SMOOTH * n0 / (n0 + n1), SMOOTH * n1 / (n0 + n1)
    ratio = F.log((F.col("c1") + s1) / (n1 + s1)) - F.log((F.col("c0") + s0) / (n0 + s0))
    best = counts.where(F.col("c0") + F.col("c1") >= LEAST_DOCS).select("slot", ratio.alias("ratio"))
    best = best.where(F.abs("ratio") >= LEAST_RATIO).toPandas().sort_values("slot")  # at most WIDTH slots
    slots, ratios = best["slot"].to_numpy(np.int64), best["ratio"].to_numpy(float)
    shared = rows.sparkSession.sparkContext.broadcast(slots)

    def sparse(batches):
        slots = shared.value
        seen = np.zeros(WIDTH, bool)
        seen[slots] = True
        for b in batches:
            out = []
            for texts in _texts(b.column(1)):
                text, slot = features(texts, seen)
                cut = np.searchsorted(text, np.arange(len(texts) + 1))
                col = np.searchsorted(slots, slot).astype(np.int32)
                out += [col[lo:hi].tobytes() for lo, hi in zip(cut[:-1], cut[1:])]
            yield pa.record_batch([b.column(0), b.column(2), pa.array(out, pa.binary())], names=["id", "y", "cols"])

    id_type = rows.schema["id"].dataType.simpleString()
    got = rows.select("id", "text", "y").mapInArrow(sparse, f"id {id_type}, y int, cols binary").orderBy("id").toPandas()
    cols = [np.frombuffer(x, np.int32) for x in got["cols"]]
    row = np.repeat(np.arange(len(cols)), [len(c) for c in cols])
    col = np.concatenate(cols)
    y = got["y"].to_numpy(float)
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    w, bias = fit_logistic(row, col, ratios[col], y, weight, len(slots), l2=1.0)
    return ToxicityModel(slots, w * ratios, bias)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) with score the chance of the label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        m = shared.value
        seen = np.zeros(WIDTH, bool)
        seen[m.slots] = True
        for b in batches:
            out = [np.zeros(0)]
            for texts in _texts(b.column(1)):
                text, slot = features(texts, seen)
                z = np.bincount(text, m.weights[np.searchsorted(m.slots, slot)], len(texts)) if len(slot) else np.zeros(len(texts))
                out.append(sigmoid(z + m.bias))
            yield pa.record_batch([b.column(0), pa.array(np.concatenate(out))], names=["id", "score"])

    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary"))
    return src.mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_col)

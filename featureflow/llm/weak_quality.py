"""Quality classifier from weak labels.

Eight heuristic labellers vote good, bad or nothing on every document. The
accuracies of the overlapping labellers, and the share of bad documents, are
estimated by expectation-maximisation over all documents, of which only the
counts of vote patterns matter. The posterior of a pattern is the label of its
documents, and a logistic scorer over hashed word shapes is trained on these
soft labels; the scorer, not the votes, judges the documents. No given label is
used.

The scorer is fitted on a bounded sample: ``SAMPLE`` different texts of each
side of the posterior, the ones with the least digests. All else covers every
document.

Defined cases: null text is read as empty; a text of few words gets no
votes, and without words the score of the bias alone; repeated rows are scored one by one and count
once in the sample; an empty table gives an empty table; any id passes through;
columns beside id and text are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import stored
from featureflow.llm.linear import fit_logistic, sigmoid
from featureflow.llm.shingles import batches_by_bytes, word_hashes

SAMPLE = 4000  # different texts of each side on which the scorer is fitted
WIDTH = 1 << 15
SHAPES = 16 * 16 * 5 * 2
STEADY = 10  # words added to a text's length, so that a few odd words of a short text weigh little

# Byte classes of word shapes.
_CLASS = np.full(256, 15, np.uint8)
for _k, _chars in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!", b"?",
                             b"|", b"#*$%&", b"<>", b"'\"`", b"()[]{}", b"-_/\\", b"@=+~^"]):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 0  # bytes of other scripts count as letters

# Labellers: the measure, and the bounds beyond which they vote bad or good.
LABELLERS = [
    ("symbol_words", 0.10, 0.01),   # words that end in a symbol
    ("bare_words", 0.10, 0.03),     # words without a letter or digit
    ("shouting", 0.40, 0.15),       # upper-case letters among ASCII letters
    ("exclaiming", 0.10, 0.02),     # words that end in !!
    ("stuttering", 0.15, 0.03),     # words equal to the one before
    ("few_words", -0.25, -0.45),    # different words per word (low is bad), first 400 words of a run
    ("few_letters", -0.75, -0.90),  # letters among the bytes of words (low is bad)
    ("copied_lines", 0.50, 0.10),   # words in lines equal to an earlier line
]
GOOD, BAD, NONE = 0, 1, 2
LEAST_WORDS = 5  # shorter texts show the labellers nothing


@dataclass
class Words:
    """The words of a group of texts: bytes, hashes, offsets, and the first word of each text."""
    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    cut: np.ndarray
    n_texts: int

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), np.diff(self.cut))


def group_words(texts: list[bytes]) -> Words:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    h, a, b = word_hashes(data)
    cut = np.concatenate(([0], np.searchsorted(a, np.cumsum([len(t) + 1 for t in texts]))))
    return Words(data, h, a, b, cut, len(texts))


def _distinct_share(w: Words, text: np.ndarray, block: int = 400) -> np.ndarray:
    """Mean share of different words over blocks of 400, so that long texts are not held to be poor."""
    place = np.arange(len(w.hashes)) - w.cut[text]
    run = place // block
    # blocks are numbered through; a (block, hash) pair counts once
    first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (run[1:] != run[:-1])))) if len(text) else np.zeros(0, int)
    number = np.zeros(len(text), np.int64)
    number[first[1:]] = 1
    number = np.cumsum(number)
    order = np.lexsort((w.hashes, number))
    n, h = number[order], w.hashes[order]
    new = np.concatenate(([True], (n[1:] != n[:-1]) | (h[1:] != h[:-1]))) if len(n) else np.zeros(0, bool)
    return np.bincount(text[order], new, w.n_texts)


def measures(w: Words) -> np.ndarray:
    """(texts, labellers): what the labellers look at; nan where there is nothing to see."""
    t, k = w.text, np.maximum(np.diff(w.cut), 0)
    n = np.maximum(k, 1)
    cls = _CLASS[w.data]
    share = lambda mark: np.bincount(t, mark, w.n_texts) / n
    last = cls[w.ends - 1]
    named = np.concatenate(([0], np.cumsum(cls <= 2)))
    in_word = named[w.ends] - named[w.starts]
    shout = w.data[np.maximum(w.ends - 2, 0)] == 33
    again = np.zeros(len(t), bool)
    again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (t[1:] == t[:-1])
    upto = lambda mask: np.concatenate(([0], np.cumsum(mask)))
    upper, lower = upto(cls == 1), upto((w.data >= 97) & (w.data <= 122))
    ups = np.bincount(t, upper[w.ends] - upper[w.starts], w.n_texts)
    lows = np.bincount(t, lower[w.ends] - lower[w.starts], w.n_texts)
    size = np.bincount(t, w.ends - w.starts, w.n_texts)
    out = np.full((w.n_texts, len(LABELLERS)), np.nan)
    out[:, 0] = share((last == 7) | (last == 8) | (last == 6))
    out[:, 1] = share(in_word == 0)
    out[:, 2] = ups / np.maximum(ups + lows, 1)
    out[:, 3] = share((last == 4) & shout & (w.ends - w.starts >= 2))
    out[:, 4] = share(again)
    out[:, 5] = -_distinct_share(w, t) / n
    out[:, 6] = -np.bincount(t, in_word, w.n_texts) / np.maximum(size, 1)
    out[:, 7] = _copied(w, t) / n
    out[k < LEAST_WORDS] = np.nan
    return out


def _copied(w: Words, t: np.ndarray) -> np.ndarray:
    """Words in lines that equal an earlier line of their text, by the lines' sums of placed word hashes."""
    if not len(t):
        return np.zeros(w.n_texts)
    line = np.searchsorted(np.flatnonzero(w.data == 10), w.starts)
    start = np.concatenate(([0], np.flatnonzero(np.diff(line)) + 1))
    place = (np.arange(len(line)) - np.repeat(start, np.diff(np.append(start, len(line))))).astype(np.uint64)
    mixed = (w.hashes ^ (place * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    sums = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), start)
    long = np.diff(np.append(start, len(line)))
    of = t[start]
    order = np.lexsort((np.arange(len(start)), sums, of))
    same = np.zeros(len(order), bool)
    same[1:] = (sums[order][1:] == sums[order][:-1]) & (of[order][1:] == of[order][:-1])
    return np.bincount(of[order], same * long[order], w.n_texts)


def votes(m: np.ndarray) -> np.ndarray:
    bad = np.array([x[1] for x in LABELLERS])
    good = np.array([x[2] for x in LABELLERS])
    with np.errstate(invalid="ignore"):
        return np.where(m > bad, BAD, np.where(m <= good, GOOD, NONE)).astype(np.int64)


def pattern(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


def unpattern(p: np.ndarray, n: int = len(LABELLERS)) -> np.ndarray:
    return p[:, None] // (3 ** np.arange(n)) % 3


def fit_votes(v: np.ndarray, count: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Chances of each vote given a good or bad document (labeller, class, vote), and the share of bad.

    A labeller that abstains says nothing: chances are among the votes given.
    Expectation-maximisation over vote patterns and their counts. Priors hold
    the labellers to being better than chance: a good document rarely gets a bad
    vote, a bad one gets some.
    """
    n_lab = v.shape[1]
    votes_bad = (v == BAD).sum(1)
    p_bad = np.clip(0.05 + 0.45 * votes_bad, 0, 0.95)
    prior = np.array([[20.0, 0.2], [3.0, 3.0]])
    chance = np.ones((n_lab, 2, 3))
    share = 0.5
    for _ in range(rounds):
        for k, p in ((GOOD, 1 - p_bad), (BAD, p_bad)):
            for x in (GOOD, BAD):
                chance[:, k, x] = ((v == x) * (p * count)[:, None]).sum(0) + prior[k, x]
        chance[:, :, :NONE] /= chance[:, :, :NONE].sum(2, keepdims=True)
        new = ((p_bad * count).sum() + 1) / (count.sum() + 2)
        p_bad = posterior(v, chance, new)
        if abs(new - share) < 1e-10:
            break
        share = new
    return chance, float(new)


def posterior(v: np.ndarray, chance: np.ndarray, share: float) -> np.ndarray:
    lab = np.arange(v.shape[1])
    odds = np.log(share / (1 - share)) + (np.log(chance[lab, BAD, v]) - np.log(chance[lab, GOOD, v])).sum(1)
    return sigmoid(odds)


def shape_features(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value): hashed shapes of words and of pairs of words, as root frequencies.

    A word's shape is the class of its first and last byte, its length's class,
    and whether it repeats the word before.
    """
    t = w.text
    if not len(t):
        return t, t, np.zeros(0)
    cls = _CLASS[w.data]
    length = np.searchsorted([2, 4, 8, 14], w.ends - w.starts, "right")
    again = np.zeros(len(t), np.int64)
    again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (t[1:] == t[:-1])
    code = ((cls[w.starts].astype(np.int64) * 16 + cls[w.ends - 1]) * 5 + length) * 2 + again
    pair = t[1:] == t[:-1]
    two = (code[:-1] * SHAPES + code[1:])[pair].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    two = SHAPES + (two >> np.uint64(33)).astype(np.int64) % (WIDTH - SHAPES)
    key = np.concatenate((t * WIDTH + code, t[1:][pair] * WIDTH + two))
    key, count = np.unique(key, return_counts=True)
    row = key // WIDTH
    return row, key % WIDTH, np.sqrt(count / (np.diff(w.cut)[row] + STEADY))


def _groups(b: pa.RecordBatch, text_at: int):
    """(row numbers, words) of a batch in groups of bounded bytes."""
    text = b.column(text_at)
    rows = ((i, text[i].as_py() or b"") for i in range(b.num_rows))
    for group in batches_by_bytes(rows):
        yield [i for i, _ in group], group_words([t for _, t in group])


def voted(docs: DataFrame, text_col: str) -> DataFrame:
    """(digest, pattern) of every document."""
    src = docs.select(F.xxhash64(F.col(f"`{text_col}`")).alias("digest"), F.col(f"`{text_col}`").cast("binary"))

    def run(batches):
        for b in batches:
            out = [pattern(votes(measures(w))) for _, w in _groups(b, 1)]
            yield pa.record_batch([b.column(0), pa.array(np.concatenate(out) if out else np.zeros(0, np.int64))],
                                  names=["digest", "pattern"])

    return stored(src.mapInArrow(run, "digest long, pattern long"), "weak-votes")


@dataclass(frozen=True)
class QualityModel:
    chance: np.ndarray  # labeller, class, vote
    share: float
    weights: np.ndarray
    bias: float


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> QualityModel:
    rows = voted(docs, text_col)
    counts = rows.groupBy("pattern").count().toPandas()  # at most 3 ** 8 rows
    v = unpattern(counts["pattern"].to_numpy(dtype=np.int64))
    chance, share = fit_votes(v, counts["count"].to_numpy(dtype=float))
    if not len(counts):
        return QualityModel(chance, share, np.zeros(WIDTH), 0.0)
    bad = [int(p) for p, q in zip(counts["pattern"], posterior(v, chance, share)) if q > 0.5]
    texts = rows.distinct()
    least = lambda part: part.select("digest").orderBy(F.xxhash64("digest"), "digest").limit(sample)
    chosen = least(texts.where(F.col("pattern").isin(bad))).union(least(texts.where(~F.col("pattern").isin(bad))))
    chosen = stored(chosen, "weak-sample").select(F.col("digest").alias("_d"))
    src = docs.select(F.xxhash64(F.col(f"`{text_col}`")).alias("digest"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    src = src.join(F.broadcast(chosen), F.col("digest") == F.col("_d"), "left_semi")

    def run(batches):
        seen = set()
        for b in batches:
            for at, w in _groups(b, 1):
                row, col, value = shape_features(w)
                p, out = pattern(votes(measures(w))), []
                for k, i in enumerate(at):
                    digest = b.column(0)[i].as_py()
                    if digest not in seen:
                        seen.add(digest)
                        lo, hi = np.searchsorted(row, [k, k + 1])
                        out.append((digest, int(p[k]), col[lo:hi].astype(np.int32).tobytes(), value[lo:hi].astype(np.float32).tobytes()))
                yield pa.record_batch([pa.array(list(x), t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))]
                                      if out else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary())],
                                      names=["digest", "pattern", "col", "value"])

    got = src.mapInArrow(run, "digest long, pattern long, col binary, value binary").dropDuplicates(["digest"])
    got = got.toPandas().sort_values("digest")  # at most 2 * sample rows
    cols = [np.frombuffer(x, np.int32) for x in got["col"]]
    values = [np.frombuffer(x, np.float32) for x in got["value"]]
    y = 1 - posterior(unpattern(got["pattern"].to_numpy(dtype=np.int64)), chance, share)
    # the sample holds as many of each side; weigh them back to their shares of the corpus
    sides = np.where(y > 0.5, max((y > 0.5).mean(), 1e-9) / (1 - share), max((y <= 0.5).mean(), 1e-9) / share)
    weights, bias = fit_logistic(np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.concatenate(cols),
                                 np.concatenate(values).astype(float), y, 1 / sides, WIDTH, l2=0.5)
    return QualityModel(chance, share, weights, bias)


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, p_weak, quality): the labellers' posterior of good, and the scorer's."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        m = shared.value
        for b in batches:
            weak, out = [np.zeros(0)], [np.zeros(0)]
            for at, w in _groups(b, 1):
                row, col, value = shape_features(w)
                out.append(sigmoid(np.bincount(row, value * m.weights[col], len(at)) + m.bias))
                weak.append(1 - posterior(votes(measures(w)), m.chance, m.share))
            yield pa.record_batch([b.column(0), pa.array(np.concatenate(weak)), pa.array(np.concatenate(out))],
                                  names=["id", "p_weak", "quality"])

    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary"))
    return src.mapInArrow(run, f"id {id_type}, p_weak double, quality double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with exactly its columns."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, text_col))
    at = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        for b in batches:
            good = [np.zeros(0, bool)]
            texts = pa.record_batch([b.column(at).cast(pa.binary())], names=["text"])
            for rows, w in _groups(texts, 0):
                row, col, value = shape_features(w)
                good.append(sigmoid(np.bincount(row, value * m.weights[col], len(rows)) + m.bias) >= least)
            yield b.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(run, docs.schema)

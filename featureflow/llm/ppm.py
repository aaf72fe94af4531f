"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` deep, held level by level:
the grams of a level are its contexts with one following symbol. A symbol is
predicted in the longest context seen in training; where it was not seen there,
the model escapes to the context without its first byte, and the symbols that
the longer context offered are excluded there. Each symbol of a context gives
``ESCAPE`` of its count to the escape. Counts of the deepest contexts are those
of the corpus; a shallower context counts a symbol once for each longer context
that it followed in, since only then it is asked. What a context offers, its
suffix offers too, so one excluded weight per context settles every exclusion
beforehand.
Texts are lower-cased in A-Z and closed by an end symbol, of which the model
also sees enough before the first byte to fill the context.

Grams are counted over all training texts. The deepest level decides the rest.
The trie goes to the tasks by broadcast, behind a check of its size: levels of
more than ``MOST_GRAMS`` grams stay in a stored table, whole, and the levels
above them travel. Then the commonest deepest grams, at most ``MOST_GRAMS``,
travel with their chances, and what texts hold of all others is looked up once a
gram: grams and table meet in buckets of the context's last symbols, where the
levels that stayed behind can be built apart from those of other buckets. So a
task's memory has a bound at any corpus size, and the scores are those of the
whole trie, whatever travels.

Beside it stands the unigram word model, as a base. The commonest words, at
most ``COMMON``, travel to the tasks; what a text holds of all other words is joined with
their counts.

Defined cases: null text is read as empty, which has the end token alone; a null
id falls in bucket 0 of the held-out rule; repeated rows are scored one by one;
without training texts every symbol is equally likely and no word is known; an
empty table gives an empty table; columns beside id and text are not looked at.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import partitions, stored

ORDER = 5
MOST_GRAMS = 4_000_000
COMMON = 1 << 18
SYMBOLS = 257
END = 256
ESCAPE = 0.3  # of a symbol's count
BITS = 9  # of a symbol in a packed gram
SLICE = 1 << 18  # positions handled at a time
BUCKET_GRAMS = 500_000  # of the deepest level that meet in one bucket, about
FLUSH = 200_000  # words, or grams, that a task gathers before it sends them on

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _groups(column: pa.Array, limit: int = 1 << 20):
    group, size = [], 0
    for x in column:
        group.append((x.as_py() or b"").translate(_LOWER))
        size += len(group[-1])
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def gram_slices(texts: list[bytes], order: int):
    """(text numbers, grams) of every byte and end symbol, a bounded slice at a time.

    A gram packs the context's symbols and then the symbol itself, oldest first.
    """
    pad = np.full(order, END, np.uint16)
    parts, owners, sizes = [pad], [-1], [order]
    for i, t in enumerate(texts):
        parts += [np.frombuffer(t, np.uint8).astype(np.uint16), pad if order else np.full(1, END, np.uint16)]
        owners += [i, -1]
        sizes += [len(t) + 1, max(order - 1, 0)]
    symbols, owner = np.concatenate(parts), np.repeat(owners, sizes)
    for lo in range(order, len(symbols), SLICE):
        hi = min(lo + SLICE, len(symbols))
        g = np.zeros(hi - lo, np.uint64)
        for back in range(order, -1, -1):
            g = (g << np.uint64(BITS)) | symbols[lo - back:hi - back]
        here = owner[lo:hi]
        real = here >= 0
        yield here[real], g[real]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def corpus_counts(docs: DataFrame, text_col: str, order: int) -> DataFrame:
    """(word, gram, n): counts of words (gram null) and of grams (word null) over all rows."""
    src = docs.select(F.col(f"`{text_col}`").cast("binary"))

    def words_out(counter: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(counter), pa.binary()), pa.nulls(len(counter), pa.int64()),
                                pa.array(list(counter.values()), pa.int64())], names=["word", "gram", "n"])

    def grams_out(parts) -> pa.RecordBatch:
        keys, counts = _merged(parts)
        return pa.record_batch([pa.nulls(len(keys), pa.binary()), pa.array(keys.view(np.int64)), pa.array(counts)],
                               names=["word", "gram", "n"])

    def run(batches):
        _TRIES.clear()  # of a model before this one
        words, parts, held = Counter(), [], 0
        for b in batches:
            for texts in _groups(b.column(0)):
                for t in texts:
                    words.update(t.split())  # of bytes: at ASCII space and tab..carriage return
                    if len(words) > FLUSH:
                        yield words_out(words)
                        words = Counter()
                for _, g in gram_slices(texts, order):
                    g = np.sort(g)
                    first = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
                    parts.append((g[first], np.diff(np.append(first, len(g)))))
                    held += len(first)
                    if held > 4 * FLUSH:
                        parts = [_merged(parts)]
                        held = len(parts[0][0])
                        if held > 2 * FLUSH:
                            yield grams_out(parts)
                            parts, held = [], 0
        yield words_out(words)
        if parts:
            yield grams_out(parts)

    rows = src.mapInArrow(run, "word binary, gram long, n long")
    return stored(rows.groupBy("word", "gram").agg(F.sum("n").alias("n")), "ppm-counts")


@dataclass
class Level:
    """The contexts of one length, sorted, and their grams."""
    grams: np.ndarray
    log_weight: np.ndarray  # of a gram's symbol
    contexts: np.ndarray
    log_total: np.ndarray  # of all weights and the escape
    log_escape: np.ndarray
    log_total_after: np.ndarray  # in the suffix context, without this context's symbols
    log_escape_after: np.ndarray


class Index:
    """An open table of numbers by gram."""

    def __init__(self, grams: np.ndarray, value: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(grams))))) + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, ~np.uint64(0)), np.zeros(1 << bits, np.float32)
        left, slot = np.arange(len(grams)), self._slot(grams)
        while len(left):
            free = self.keys[slot] == ~np.uint64(0)
            self.keys[slot[free]] = grams[left[free]]  # of several for one place the last stays
            placed = self.keys[slot] == grams[left]
            self.values[slot[placed]] = value[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & self.mask

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The grams' numbers, 0 for those not held, and the places of these."""
        slot = self._slot(grams)
        found = self.keys[slot] == grams
        out = np.where(found, self.values[slot], 0.0)
        left = np.flatnonzero(~found)
        seek = slot[left]
        miss = [np.zeros(0, np.int64)]
        while len(left):
            seek = (seek + 1) & self.mask
            here = self.keys[seek]
            hit = here == grams[left]
            out[left[hit]] = self.values[seek[hit]]
            gone = (here == ~np.uint64(0)) | (self.keys[(seek - 1) & self.mask] == ~np.uint64(0))
            miss.append(left[gone & ~hit])
            on = ~(hit | gone)
            left, seek = left[on], seek[on]
        return out, np.concatenate(miss)


class Trie:
    """A trie of contexts, built from the grams of its deepest level.

    With a ``base``, a trie of the levels up to its order, only the deeper ones
    are built. They may be part of a corpus: contexts that share their last
    ``base.order + 1`` symbols have to be here together.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, order: int, base: Trie | None = None,
                 grows: bool = False):
        self.order, self.levels = order, list(base.levels) if base else []
        found, start = [], len(self.levels)
        last = base.last if base else None
        for depth in range(order, start - 1, -1):
            found.append((grams, counts))
            if depth > start:
                grams, counts = _merged([(grams & np.uint64((1 << BITS * depth) - 1), np.ones(len(grams), np.int64))])
        log = lambda x: np.log10(np.maximum(x, 1e-300))
        for depth in range(start, order + 1):
            grams, counts = found[order - depth]
            weight = counts - ESCAPE
            context = grams >> np.uint64(BITS)
            first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(context) else np.zeros(0, np.int64)
            kinds = ESCAPE * np.diff(np.append(first, len(context)))
            weights = np.add.reduceat(weight, first) if len(first) else weight
            if depth:
                below, below_grams, below_weight, below_kinds, below_weights = last
                # this context's symbols, by their weight in the suffix context
                at = np.searchsorted(below_grams, grams & np.uint64((1 << BITS * depth) - 1))
                excluded = np.add.reduceat(below_weight[at], first) if len(first) else weights
                suffix = np.searchsorted(below, context[first] & np.uint64((1 << BITS * (depth - 1)) - 1))
                escape_after = np.where(below_kinds[suffix] - kinds > ESCAPE / 2, below_kinds[suffix] - kinds, 0.0)
                # with nothing left to offer, the escape is certain
                total_after = np.where(escape_after > 0, below_weights[suffix] - excluded + escape_after, 0.0)
            else:
                escape_after = total_after = SYMBOLS - kinds / ESCAPE  # what no context offers, all alike
            last = (context[first], grams, weight, kinds, weights)
            self.levels.append(Level(grams, log(weight), context[first], log(weights + kinds), log(kinds),
                                     log(total_after), np.where(escape_after > 0, log(escape_after), log(total_after))))
        self.last = last if grows else None  # what deeper levels are built on
        top = self.levels[-1]
        context = np.searchsorted(top.contexts, top.grams >> np.uint64(BITS))
        self.index = Index(top.grams, top.log_weight - top.log_total[context])

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """The log10 probability of each gram's symbol after its context."""
        out, rest = self.index.find(grams)
        if len(rest):
            out[rest] = self._escape(grams[rest])
        return out

    def _escape(self, grams: np.ndarray) -> np.ndarray:
        n = len(grams)
        total, left = np.zeros(n), np.arange(n)
        child = np.full(n, -1)  # the context escaped from, one level up
        for depth in range(self.order, -1, -1):
            level = self.levels[depth]
            if not len(level.contexts):
                continue
            context = (grams[left] >> np.uint64(BITS)) & np.uint64((1 << BITS * depth) - 1)
            at = np.minimum(np.searchsorted(level.contexts, context), len(level.contexts) - 1)
            there = level.contexts[at] == context
            came = child[left] >= 0
            after = child[left]
            if depth < self.order and came.any():
                up = self.levels[depth + 1]
                whole = np.where(came, up.log_total_after[after], level.log_total[at])
                escape = np.where(came, up.log_escape_after[after], level.log_escape[at])
            else:
                whole, escape = level.log_total[at], level.log_escape[at]
            gram = grams[left] & np.uint64((1 << BITS * (depth + 1)) - 1)
            g = np.minimum(np.searchsorted(level.grams, gram), len(level.grams) - 1)
            hit = there & (level.grams[g] == gram)
            total[left[hit]] += level.log_weight[g[hit]] - whole[hit]
            out = there & ~hit
            total[left[out]] += escape[out] - whole[out]
            child[left[out]] = at[out]
            left = left[~hit]
        # among the symbols that the empty context does not offer
        root = self.levels[0]
        total[left] -= root.log_total_after[0] if len(root.contexts) else np.log10(SYMBOLS)
        return total


@dataclass(frozen=True)
class Model:
    grams: np.ndarray  # of the deepest level that travels
    counts: np.ndarray
    order: int
    words: pa.Array
    word_counts: np.ndarray
    tokens: int  # of training, ends included
    kinds: int
    texts: int
    depth: int  # of the whole trie
    id: str  # another one for every model
    longer: np.ndarray | None = None  # grams one longer that end in each gram, if deeper levels stay behind
    common: np.ndarray | None = None  # the commonest grams of the whole trie's deepest level
    common_log10: np.ndarray | None = None
    deep: DataFrame | None = None  # (gram, n) of that level


_TRIES: dict[str, tuple] = {}


def _ready(shared) -> tuple[Trie, dict[bytes, float], Index | None]:
    """The worker's trie, logarithms of word counts and common deep grams; kept between tasks of the same model."""
    m = shared.value
    if m.id not in _TRIES:
        _TRIES.clear()
        behind = m.longer is not None
        _TRIES[m.id] = (Trie(m.grams, m.longer if behind else m.counts, m.order, grows=behind),
                        dict(zip(m.words.to_pylist(), np.log10(m.word_counts + 0.5).tolist())),
                        Index(m.common, m.common_log10) if behind else None)
    return _TRIES[m.id]


def _commonest(counted: DataFrame, limit: int) -> DataFrame:
    """The rows with counts from the least bound on ``n`` that leaves at most ``limit`` of them."""
    band = F.floor(8 * F.log2("n"))
    bands = counted.groupBy(band.cast("int").alias("band")).count().toPandas().sort_values("band", ascending=False)
    taken = bands[bands["count"].cumsum() <= limit]["band"]
    return counted.where(band >= (int(taken.min()) if len(taken) else 1 << 30))


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER, most_grams: int = MOST_GRAMS,
          common: int = COMMON) -> tuple[Model, DataFrame]:
    """The model and the (word, n) table of all training words."""
    counts = corpus_counts(docs, text_col, order)
    deep = grams = counts.where("gram is not null").select("gram", "n")
    depth, more = order, {}
    while order > 0 and grams.limit(most_grams + 1).count() > most_grams:
        keep = F.col("gram").bitwiseAND(F.lit((1 << BITS * order) - 1))
        grams = stored(grams.groupBy(keep.alias("gram")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("longer")), "ppm-grams")
        order -= 1
    words = counts.where("word is not null").select("word", "n")
    whole = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    texts = docs.count()
    g = grams.toArrow().sort_by("gram")
    if order < depth:
        total = F.sum("n").over(Window.partitionBy(F.shiftright("gram", BITS)))  # at most SYMBOLS rows each
        chance = deep.withColumn("log10", F.log10(F.col("n") - ESCAPE) - F.log10(total))
        top = _commonest(chance, most_grams).select("gram", "log10").toArrow()
        more = {"longer": g.column("longer").to_numpy().astype(np.int64), "deep": deep,
                "common": top.column("gram").to_numpy().astype(np.uint64), "common_log10": top.column("log10").to_numpy()}
    top = _commonest(words, common).toArrow()
    return Model(g.column("gram").to_numpy().astype(np.uint64), g.column("n").to_numpy().astype(np.int64), order,
                 top.column("word").combine_chunks(), top.column("n").to_numpy().astype(np.int64),
                 (whole[0] or 0) + texts, whole[1] + (texts > 0), texts, depth, uuid.uuid4().hex, **more), words


def _gram_lists(pairs: list[tuple[np.ndarray, np.ndarray]], n: int) -> pa.Array:
    """For each of n texts, its different grams and how often it holds each, of (text, gram) pairs."""
    text, gram = (np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, np.uint64)), *pairs))
    order = np.lexsort((gram, text))
    text, gram = text[order], gram[order]
    first = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (gram[1:] != gram[:-1]))) if len(text) else order
    structs = pa.StructArray.from_arrays([pa.array(gram[first].view(np.int64)), pa.array(np.diff(np.append(first, len(text))).astype(np.int32))],
                                         names=["gram", "n"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text[first], np.arange(n + 1)).astype(np.int32)), structs)


def _looked_up(grams: DataFrame, model: Model, shared) -> DataFrame:
    """(gram, log10) of each of the distinct ``grams``, by the whole trie."""
    buckets = max(partitions(grams.sparkSession), model.deep.count() // BUCKET_GRAMS + 1)
    # the last order + 1 symbols of the context: what levels beyond the order share
    of = F.shiftright("gram", BITS).bitwiseAND(F.lit((1 << BITS * (model.order + 1)) - 1))
    bucket = F.pmod(F.xxhash64(of), F.lit(buckets)).cast("int").alias("bucket")

    def run(known: pa.Table, asked: pa.Table) -> pa.Table:
        g, n = known.column("gram").to_numpy().astype(np.uint64), known.column("n").to_numpy().astype(np.int64)
        order = np.argsort(g)
        trie = Trie(g[order], n[order], shared.value.depth, _ready(shared)[0])
        ask = asked.column("gram").to_numpy().astype(np.uint64)
        parts = [trie.log10(ask[lo:lo + SLICE]) for lo in range(0, len(ask), SLICE)]
        return pa.table({"gram": asked.column("gram"), "log10": pa.array(np.concatenate([np.zeros(0), *parts]))})

    known = model.deep.select(bucket, "gram", "n").groupBy("bucket")
    asked = grams.select(bucket, "gram").groupBy("bucket")
    return known.cogroup(asked).applyInArrow(run, "gram long, log10 double")


def score(docs: DataFrame, model: Model, words: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          extra: Column | None = None) -> DataFrame:
    """(id, [extra,] n_tokens, n_known, train_tokens, base_score, score), one row per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, deep=None))
    behind = model.deep is not None
    id_type = docs.schema[id_col].dataType.simpleString()
    more = extra if extra is not None else F.lit(None).cast("boolean")
    src = docs.select(F.col(f"`{id_col}`").alias("id"), more.alias("extra"), F.col(f"`{text_col}`").cast("binary"))
    schema = ("id " + id_type + ", extra boolean, n_tokens long, known long, base double, score double, "
              "rare array<struct<word: binary, n: int>>" + (", grams array<struct<gram: long, n: int>>" if behind else ""))
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))

    def run(batches):
        trie, logs, common = _ready(shared)
        end = np.log10(shared.value.texts + 0.5)
        for b in batches:
            at = 0
            for texts in _groups(b.column(2)):
                total, rest = np.zeros(len(texts)), []
                for text, g in gram_slices(texts, shared.value.depth):
                    if behind:
                        chance, left = common.find(g)
                        rest.append((text[left], g[left]))
                    else:
                        chance = trie.log10(g)
                    total += np.bincount(text, chance, len(texts))
                n, known, base, rare = [], [], [], []
                for t in texts:
                    ws = t.split()
                    hits = [x for x in map(logs.get, ws) if x is not None]
                    n.append(len(ws) + 1)
                    known.append(len(hits) + (1 if shared.value.texts else 0))
                    base.append(sum(hits) + end)
                    rare.append([{"word": w, "n": k} for w, k in Counter(w for w in ws if w not in logs).items()]
                                if len(hits) < len(ws) else [])
                part = b.slice(at, len(texts))
                at += len(texts)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                                       pa.array(base, pa.float64()), pa.array(total, pa.float64()), pa.array(rare, rare_type),
                                       *([_gram_lists(rest, len(texts))] if behind else [])],
                                      names=["id", "extra", "n_tokens", "known", "base", "score", "rare", *(["grams"] if behind else [])])

    rows = stored(src.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "ppm-rows")
    rest = rows.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("w"), F.col("r.n").alias("k"))
    rest = rest.join(words, F.col("w") == F.col("word"), "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_base"),
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("rare_known")).withColumnRenamed("row", "of")
    out = rows.drop("rare", "grams").join(rest, F.col("row") == F.col("of"), "left")
    if behind:
        held = rows.select("row", F.explode("grams").alias("r")).select("row", F.col("r.gram").alias("g"), F.col("r.n").alias("k"))
        chances = stored(_looked_up(held.select(F.col("g").alias("gram")).distinct(), model, shared), "ppm-chances")
        held = held.join(chances, F.col("g") == F.col("gram")).groupBy(F.col("row").alias("in")).agg(
            F.sum(F.col("k") * F.col("log10")).alias("held"))
        out = out.join(held, F.col("row") == F.col("in"), "left").withColumn("score", F.col("score") + F.coalesce("held", F.lit(0.0)))
    shared.destroy()  # the tables that it made are stored
    scale = F.lit(float(np.log10(model.tokens + 0.5 * (model.kinds + 1))))
    return out.select(F.col("id").alias(id_col), *([F.col("extra")] if extra is not None else []), "n_tokens",
                      (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(model.tokens).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * scale).alias("base_score"), "score")

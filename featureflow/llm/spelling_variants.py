"""Grouping of spelling variants by bidirectional FM-index search schemes.

The words of all texts are counted. A word of two halves that differs from
another by one code point shares one half with it exactly, at its beginning or
at its end. So there are two searches for every word: match the left half,
closed by a delimiter on its left, then extend to the right over the other half
allowing one error; or match the right half, closed on its right, then extend
to the left. Both run on a bidirectional FM-index over the delimited vocabulary
(``Bidirectional``): an occurrence is a pair of suffix-rank intervals, of the
text and of its reverse, kept in step whichever way it is extended.

Words are dealt by the half that must match: a word is a query under its own
half, and an entry of the index under the halves that queries one code point
longer or shorter can have. Keys are packed into shards of about
``SHARD_WORDS`` entries. Where more than ``SHARD_WORDS`` words share a half,
entries and queries are dealt over blocks, and every block of entries meets
every block of queries: no shard grows with a half's number of words, and no
pair is lost. A shard holds two tables of ranks, 4 bytes for each symbol of the
shard's alphabet and each of its code points.

Defined cases: null text has no words; a null id counts as the text ``null``;
repeated rows count as often as they occur; an empty table gives an empty
table; words may be of any length; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import sized, stored, workers_import

LEAST_POINTS = 7
LEAST_COUNT = 2
TIMES = 10  # a form occurs at least so many times as often as its variant
DROPPED = 31
SHARD_WORDS = 4096
FLUSH = 200_000  # words that a worker counts before it hands them on

_RUNS = re.compile(f"[a-zÀ-ÿ]{{{LEAST_POINTS},}}")


def runs_of(text: str) -> list[str]:
    """The letter runs of at least ``LEAST_POINTS`` code points, A-Z lower-cased."""
    return _RUNS.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def spoiled(run: str, prefix_crc: int) -> str:
    """The run, less one code point where its checksum says so."""
    h = crc32(run.encode(), prefix_crc)
    if h % DROPPED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all texts, of words of at least ``LEAST_POINTS`` code points and ``LEAST_COUNT`` occurrences."""
    workers_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def handed_on() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in batches:
            for key, text in zip(b.column(0), b.column(1)):
                seed = crc32(f"{key.as_py()}:".encode())
                for w, n in Counter(runs_of(text.as_py())).items():
                    w = spoiled(w, seed)
                    if len(w) >= LEAST_POINTS:
                        total[w] += n
                if len(total) >= FLUSH:
                    yield handed_on()
        yield handed_on()

    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    counted = rows.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# -- the index -------------------------------------------------------------------------

def _flat(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' code points one after another, and where each word starts (and the last ends)."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)


class _Ranks:
    """Occurrence counts over the Burrows-Wheeler transform of ``$w1$w2..$wn$``, words in ascending order.

    Because the words ascend, telling the delimiters apart by their word gives
    the same order of suffixes as taking them for one symbol, and sorting by
    doubled prefixes ends at the longest word.
    """

    def __init__(self, words: list[str], alphabet: np.ndarray):
        codes, starts = _flat(words)
        n_words, sigma = len(words), len(alphabet) + 1
        size = len(codes) + n_words + 1
        text = np.zeros(size, np.int64)  # 0 is the delimiter
        word_of = np.repeat(np.arange(n_words), np.diff(starts))
        text[np.arange(len(codes)) + word_of + 1] = np.searchsorted(alphabet, codes) + 1
        delimiters = np.flatnonzero(text == 0)
        rank = text + n_words
        rank[delimiters] = np.arange(1, n_words + 2)
        rank[delimiters[-1]] = 0  # followed by the end
        longest = int(np.diff(starts).max(initial=0)) + 1
        order, step = None, 1
        while order is None or step < longest:
            key = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
            order = np.argsort(key, kind="stable")
            ahead = key[order]
            rank = np.empty(size, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(ahead[1:] != ahead[:-1])])
            step *= 2
        bwt = text[order - 1]
        self.occ = np.zeros((size + 1, sigma), np.int32)
        self.occ[np.arange(1, size + 1), bwt] = 1
        np.cumsum(self.occ, axis=0, out=self.occ)
        self.first = np.concatenate([[0], np.cumsum(self.occ[-1])[:-1]]).astype(np.int64)


class Bidirectional:
    """Suffix-rank intervals of a vocabulary and of its reverse, in step.

    A state is (lo, back, size): the interval [lo, lo + size) of the pattern in
    the text and [back, back + size) of the reversed pattern in the reverse.
    """

    def __init__(self, words: list[str]):
        self.words = sorted(set(words))
        self.alphabet = np.unique(_flat(self.words)[0])
        self.ahead = _Ranks(self.words, self.alphabet)
        self.behind = _Ranks(sorted(w[::-1] for w in self.words), self.alphabet)
        self.size = len(self.ahead.occ) - 1

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; -1 for those that no word holds."""
        at = np.searchsorted(self.alphabet, points)
        known = np.zeros(len(points), bool)
        inside = at < len(self.alphabet)
        known[inside] = self.alphabet[at[inside]] == points[inside]
        return np.where(known, at + 1, -1)

    def all_extensions(self, lo: np.ndarray, back: np.ndarray, size: np.ndarray, left: bool):
        """For every state and symbol: (lo, back, size) of the pattern extended by the symbol on one side."""
        ranks, own, other = (self.ahead, lo, back) if left else (self.behind, back, lo)
        low = ranks.occ[own]
        sizes = (ranks.occ[own + size] - low).astype(np.int64)
        own = ranks.first + low
        other = other[:, None] + np.cumsum(sizes, axis=1) - sizes
        return (own, other, sizes) if left else (other, own, sizes)

    def extended(self, lo: np.ndarray, back: np.ndarray, size: np.ndarray, symbol: np.ndarray, left: bool):
        """(lo, back, size) of every state extended by its own symbol; size 0 where the symbol is unknown."""
        a, b, n = self.all_extensions(lo, back, size, left)
        i, known = np.arange(len(lo)), symbol >= 0
        s = np.where(known, symbol, 0)
        return a[i, s], b[i, s], np.where(known, n[i, s], 0)

    def near(self, queries: list[str], left_half: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query number, word number) of all words that are one code point away and hold the query's half.

        With ``left_half`` the first half (rounded down) is matched exactly and
        the search goes on to the right, else the second half and to the left.
        """
        points, starts = _flat(queries)
        symbols, lengths = self.codes(points), np.diff(starts)
        half = lengths // 2
        count = half if left_half else lengths - half
        rest = lengths - count
        # position of the i-th symbol of the exact half, then of the rest, in the order of the search
        exact_at = (lambda q, i: starts[q] + half[q] - 1 - i) if left_half else (lambda q, i: starts[q] + half[q] + i)
        rest_at = (lambda q, i: starts[q] + half[q] + i) if left_half else (lambda q, i: starts[q] + half[q] - 1 - i)

        q = np.arange(len(queries))
        lo, back, size = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.full(len(q), self.size)
        closed, step = [], 0
        while len(q):
            done = count[q] == step
            closed.append([x[done] for x in (q, lo, back, size)])
            q, lo, back, size = (x[~done] for x in (q, lo, back, size))
            lo, back, size = self.extended(lo, back, size, symbols[exact_at(q, step)], left_half)
            q, lo, back, size = (x[size > 0] for x in (q, lo, back, size))
            step += 1
        q, lo, back, size = (np.concatenate(x) for x in zip(*closed))
        lo, back, size = self.extended(lo, back, size, np.zeros(len(q), np.int64), left_half)
        clean = [x[size > 0] for x in (q, lo, back, size)]
        wrong = [x[:0] for x in clean]  # states with their one error
        found, step, left = [], 0, not left_half
        while len(clean[0]) or len(wrong[0]):
            # one error here: another symbol for the next one, a symbol too many, or the next one left out
            q, lo, back, size = clean
            a, b, n = self.all_extensions(lo, back, size, left)
            inside = step < rest[q]
            at = rest_at(q, np.where(inside, step, 0))
            following = np.where(inside, symbols[np.where(inside, at, 0)], 0)
            state, symbol = np.nonzero(n)
            other = (symbol != following[state]) & (symbol > 0)
            state, symbol = state[other], symbol[other]
            extra = [q[state], a[state, symbol], b[state, symbol], n[state, symbol]]
            changed = [x[inside[state]] for x in extra]
            # of a run of equal symbols the last one is left out
            more = step + 1 < rest[q]
            after = np.where(more, symbols[np.where(more, rest_at(q, np.where(more, step + 1, 0)), 0)], -2)
            skipped = [x[inside & (after != following)] for x in clean]
            wrong = [np.concatenate(x) for x in zip(wrong, extra)]
            # closed by a delimiter, or on by one symbol
            ended = rest[wrong[0]] == step
            q, lo, back, size = (x[ended] for x in wrong)
            lo, back, size = self.extended(lo, back, size, np.zeros(len(q), np.int64), left)
            found.append((q[size > 0], lo[size > 0] - 1))
            wrong = self._on([x[~ended] for x in wrong], lambda s: symbols[rest_at(s, step)], left)
            wrong = [np.concatenate(x) for x in zip(wrong, changed, skipped)]
            clean = self._on([x[inside] for x in clean], lambda s: symbols[rest_at(s, step)], left)
            step += 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate([f[0] for f in found]) * (len(self.words) + 1) + np.concatenate([f[1] for f in found]))
        return pairs // (len(self.words) + 1), pairs % (len(self.words) + 1)

    def _on(self, states: list[np.ndarray], symbol_of, left: bool) -> list[np.ndarray]:
        q, lo, back, size = states
        lo, back, size = self.extended(lo, back, size, symbol_of(q), left)
        return [x[size > 0] for x in (q, lo, back, size)]


# -- the words dealt to shards -----------------------------------------------------------

def _dealt(words: DataFrame) -> DataFrame:
    """(left_half, half, word, n, query): a word under the halves by which it can be found, and under its own as a query."""
    size = F.length("word")
    own_left, own_right = F.floor(size / 2).cast("int"), F.ceil(size / 2).cast("int")
    others = F.array_distinct(F.transform(F.sequence(F.greatest(size - 1, F.lit(LEAST_POINTS)), size + 1), lambda m: F.floor(m / 2).cast("int")))
    other_rights = F.array_distinct(F.transform(F.sequence(F.greatest(size - 1, F.lit(LEAST_POINTS)), size + 1), lambda m: F.ceil(m / 2).cast("int")))
    left = words.select(F.lit(True).alias("left_half"), F.explode(others).alias("k"), "word", "n", own_left.alias("own"))
    right = words.select(F.lit(False).alias("left_half"), F.explode(other_rights).alias("k"), "word", "n", own_right.alias("own"))
    half = F.when(F.col("left_half"), F.substring("word", F.lit(1), F.col("k"))).otherwise(F.substring("word", -F.col("k"), F.col("k")))
    return left.unionByName(right).select("left_half", half.alias("half"), "word", "n", (F.col("k") == F.col("own")).alias("query"))


def _block(blocks: Column, salt: str) -> Column:
    return F.pmod(F.xxhash64("word", F.lit(salt)), blocks).cast("int")


def sharded(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(shard, cell, left_half, word, n, entry, query): which words a shard's cell indexes and which it looks for.

    Halves of few words share cell 0 of a shard; a block of entries and a block
    of queries of a half of many words have a cell of their own, so that no pair
    is found twice.
    """
    rows = _dealt(words)
    counts = rows.groupBy("left_half", "half").agg(F.count(F.lit(1)).alias("c"))
    many = stored(counts.where(F.col("c") > shard_words).select(
        "left_half", "half", F.ceil(F.col("c") / shard_words).cast("int").alias("blocks")), "variants-many")
    shards = max(1, -(-2 * words.count() // shard_words))
    key = ["left_half", "half"]
    few = rows.join(sized(many), key, "left_anti").select(
        F.pmod(F.xxhash64(*key), F.lit(shards)).alias("shard"), F.lit(0).cast("bigint").alias("cell"), "left_half", "word", "n",
        F.lit(True).alias("entry"), "query")
    large = rows.join(sized(many), key)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    entries = large.withColumn("at", _block(F.col("blocks"), "entry")).withColumn("query_at", F.explode(every)).withColumns(
        {"entry": F.lit(True), "query": F.lit(False)})
    queries = large.where("query").withColumn("query_at", _block(F.col("blocks"), "query")).withColumn("at", F.explode(every)).withColumn("entry", F.lit(False))
    split = entries.unionByName(queries).select(
        F.xxhash64("half").alias("shard"), (F.col("at") * F.col("blocks") + F.col("query_at") + 1).cast("bigint").alias("cell"),
        "left_half", "word", "n", "entry", "query")
    return few.unionByName(split)


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each query with near words in this shard: their number and the best of them."""
    left_half = bool(rows["left_half"].iloc[0])
    entries, asked = rows[rows["entry"]], rows[rows["query"]]
    empty = pd.DataFrame({"word": [], "n": [], "n_near": [], "best_n": [], "best": []}).astype(
        {"word": str, "n": "int64", "n_near": "int64", "best_n": "int64", "best": str})
    if not len(entries) or not len(asked):
        return empty
    index = Bidirectional(entries["word"].tolist())
    n_of = dict(zip(entries["word"], entries["n"]))
    asked = asked.drop_duplicates("word")
    queries, query_n = asked["word"].tolist(), asked["n"].tolist()
    out: dict[int, list] = {}
    for q, w in zip(*(x.tolist() for x in index.near(queries, left_half))):
        query, word = queries[q], index.words[w]
        if not left_half and word.startswith(query[:len(query) // 2]):
            continue  # found by its left half as well, and counted there
        n = n_of[word]
        best = out.get(q)
        if best is None:
            out[q] = [1, n, word]
        else:
            best[0] += 1
            if n > best[1] or (n == best[1] and word < best[2]):
                best[1:] = n, word
    if not out:
        return empty
    return pd.DataFrame([(queries[q], query_n[q], *found) for q, found in out.items()], columns=list(empty.columns))


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, n, n_near, best, best_n) of each of ``words`` (word, n); best is null and n_near 0 where none is near."""
    found = sharded(words, shard_words).groupBy("shard", "cell", "left_half").applyInPandas(
        _search, "word string, n bigint, n_near bigint, best_n bigint, best string")
    everything = found.select("word", "n", "n_near", F.struct((-F.col("best_n")).alias("less"), "best").alias("found")).unionByName(
        words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"),
                     F.lit(None).cast("struct<less: bigint, best: string>").alias("found")))
    # the most frequent one, of equal ones the first in code-point order
    least = everything.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("found").alias("found"))
    return least.select("word", "n", "n_near", F.col("found.best").alias("best"), (-F.col("found.less")).alias("best_n"))


def with_roots(formed: DataFrame) -> DataFrame:
    """``formed`` (word, form, ..) with ``root``, the last of a word's chain of forms.

    Links are doubled: each round every word takes the link of the word that
    its link ends at. Chains are short, since each link's count is ``TIMES``
    times the one before.
    """
    links = stored(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "variants-links")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if links.join(ahead, "root", "left_semi").isEmpty():
            break
        links = stored(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "variants-links")
    return formed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    words = stored(count_words(docs, id_col, text_col), "variants-words")
    near = near_words(words, shard_words)
    is_form = F.col("best_n") >= TIMES * F.col("n")
    formed = stored(near.select("word", F.when(is_form, F.col("best")).alias("form"), "n", "n_near", F.when(is_form, F.col("best_n")).alias("form_n")),
                    "variants-forms")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")

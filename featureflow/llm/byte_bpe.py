"""Byte-level BPE encoding and decoding.

A text is cut by the vocabulary's pattern; each piece is merged on its own. A
segment tree over the piece's byte positions holds, in every node, the lowest
rank of a pair of neighbours below it, the leftmost one of equal ranks. Each
merge reads the root and updates the three leaves whose pairs changed, so a
piece of n bytes takes n log n steps however long it is.

The work is row by row in Arrow batches, without a shuffle. The vocabulary is
read on the driver (its size is that of one rank file) and broadcast. A worker
remembers the pieces it has merged in two dictionaries of bounded size: when the
newer one is full it becomes the older one, and pieces met again move back. That
changes the time, never the result.

Defined cases: null text is read as empty; empty text has no ids; an empty
table gives an empty table; any id (null, repeated) is passed through; other
columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import workers_import

REMEMBERED = 400_000  # pieces, in each of the two memories
REMEMBERED_BYTES = 64  # longer pieces are merged afresh
NONE = 1 << 60  # no such pair


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece, by a segment tree of (rank, position) minima.

    A leaf's key is rank * n + position, so the smallest key is the lowest rank
    and, among equal ranks, the leftmost pair.
    """
    n = len(piece)
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    size = 1
    while size < n:
        size *= 2
    end = list(range(1, n + 1))  # of the part that begins at a position
    before = list(range(-1, n - 1))  # start of the part to the left
    look = ranks.get
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        r = look(piece[i:i + 2])
        if r is not None:
            tree[size + i] = r * n + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    while tree[1] != NONE:
        i = tree[1] % n
        j = end[i]
        last = end[i] = end[j]
        if last < n:
            before[last] = i
        # the merged pair's leaf, the one to its right, which is no start any more, and the one to its left
        left = before[i]
        for at in (j, i, left) if left >= 0 else (j, i):
            stop = end[at]
            r = look(piece[at:end[stop]]) if at != j and stop < n else None
            k = NONE if r is None else r * n + at
            at += size
            if tree[at] == k:
                continue
            tree[at] = k
            while at > 1:
                a = tree[at ^ 1]
                at >>= 1
                if a < k:
                    k = a
                if tree[at] == k:
                    break
                tree[at] = k
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


PLANE = 0x10000  # of the code points that ``re`` holds in one table


def _char_class(pattern: str, end: int) -> str:
    """The characters below ``end`` of a class of the ``regex`` module as plain ranges for ``re``."""
    import regex

    every = "".join(map(chr, (c for c in range(end) if not 0xD800 <= c < 0xE000)))
    runs = []
    for m in regex.finditer(f"{pattern}+", every):
        lo, hi = m.group()[0], m.group()[-1]
        # the gap of the surrogates ends no run here; they never occur in a text
        runs.append(f"\\U{ord(lo):08x}-\\U{ord(hi):08x}")
    return "".join(runs)


def compile_pattern(pattern: str, end: int = 0x110000) -> re.Pattern:
    r"""The tokenizer's pattern for ``re``, several times faster than ``regex``.

    Only \s, \S, \p{L} and \p{N} have another meaning there; they are written
    out as the ranges that ``regex`` gives them, so both cut every text alike.
    With ``end``, classes hold the code points below it only: for texts that
    hold no others.
    """
    classes = {name: _char_class(name, end) for name in (r"\s", r"\p{L}", r"\p{N}")}
    out, inside, i = [], False, 0
    while i < len(pattern):
        token = next((t for t in (r"\p{L}", r"\p{N}", r"\s", r"\S") if pattern.startswith(t, i)), None)
        if token:
            if token == r"\S":
                if inside:
                    raise ValueError(r"\S inside a class")
                out.append(f"[^{classes[chr(92) + 's']}]")
            else:
                out.append(classes[token] if inside else f"[{classes[token]}]")
            i += len(token)
            continue
        if pattern[i] == "\\":
            out.append(pattern[i:i + 2])
            i += 2
            continue
        inside = pattern[i] == "[" or (inside and pattern[i] != "]")
        out.append(pattern[i])
        i += 1
    return re.compile("".join(out))


class Codec:
    """Encodes and decodes texts; one per worker process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find_any, self.find_plain = compile_pattern(pattern).findall, compile_pattern(pattern, PLANE).findall
        self.beyond = re.compile(f"[{chr(PLANE)}-{chr(0x10FFFF)}]").search
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, r in ranks.items():
            self.bytes_of[r] = token
        # of a piece: how many ids, their decimal text, the bytes they decode to, and the ids
        self.known: dict[str, tuple[int, str, bytes, tuple[int, ...]]] = {}
        self.older: dict[str, tuple[int, str, bytes, tuple[int, ...]]] = {}

    def find(self, text: str) -> list[str]:
        # beyond the first plane ``re`` walks a list of ranges for every character that is in none
        return self.find_any(text) if self.beyond(text) else self.find_plain(text)

    def _merged(self, piece: str) -> tuple[int, str, bytes, tuple[int, ...]]:
        entry = self.older.get(piece)
        if entry is None:
            ids = tuple(merge_piece(piece.encode("utf-8", "surrogatepass"), self.ranks))
            entry = (len(ids), " ".join(map(str, ids)), self.decode(ids), ids)
        if len(piece) <= REMEMBERED_BYTES:
            if len(self.known) >= REMEMBERED:
                self.known, self.older = {}, self.known
            self.known[piece] = entry
        return entry

    def pieces(self, text: str) -> list[tuple[int, str, bytes, tuple[int, ...]]]:
        """The text's pieces, encoded."""
        found = self.find(text)
        out = list(map(self.known.get, found))
        if None in out:
            out = [entry or self._merged(piece) for entry, piece in zip(out, found)]
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(e[3] for e in self.pieces(text)))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODECS: dict[str, Codec] = {}


def _codec(shared) -> Codec:
    """The worker's codec; kept between tasks of the same vocabulary."""
    key, ranks, pattern = shared.value
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks, pattern)
    return _CODECS[key]


def share_vocabulary(spark: SparkSession, path: str, pattern: str):
    workers_import(spark)
    return spark.sparkContext.broadcast((uuid.uuid4().hex, load_ranks(path), pattern))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def encode(docs: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>), one row per input row."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids = [codec.encode(t) for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[id_col, "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes binary) of a table of ids; null ids give empty bytes."""
    schema = T.StructType([T.StructField(id_col, encoded.schema[id_col].dataType), T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for b in batches:
            out = [codec.decode(ids or ()) for ids in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(out, pa.binary())], names=[id_col, "bytes"])

    return encoded.select(id_col, ids_col).mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]): encode, then decode the ids, in one pass."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                n, shown, back, all_ids = [], [], [], []
                for t in part.column(1):
                    sizes, decimals, decoded, ids = tuple(zip(*codec.pieces(t.as_py()))) or ((),) * 4
                    n.append(sum(sizes))
                    shown.append(hashlib.sha256(" ".join(decimals).encode()).hexdigest())
                    back.append(hashlib.sha256(b"".join(decoded)).hexdigest())
                    if with_ids:
                        all_ids.append(pa.array(chain.from_iterable(ids), pa.int32(), size=n[-1]))
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(shown, pa.string()), pa.array(back, pa.string())]
                if with_ids:
                    ends = pa.array([0, *accumulate(n)], pa.int32())
                    columns.append(pa.ListArray.from_arrays(ends, pa.concat_arrays(all_ids)))
                yield pa.record_batch(columns, names=schema.names)

    return _rows(docs, id_col, text_col).mapInArrow(run, schema)

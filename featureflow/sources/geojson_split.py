"""One huge FeatureCollection read by many tasks.

See ``split`` for the two passes. A range's entry state is whether it begins
inside a text, its nesting depth, and whether it begins before, in or after the
top-level ``features`` array. Features are cut at the commas of depth two;
everything else of the document, its shell, is judged as any small document.

Defined cases: documents without a top-level ``features`` array (a Feature, a
geometry, an array, unreadable text) are their own shell and are read whole, as
``read_geojson`` does. An empty file is one row with its problem. A document
that is unreadable outside of its features is one row with that problem, beside
the features found; so is one that has ``features`` and another type. What
follows the end of a document is passed by, as ``read_geojson`` does. ``_ord``
is the byte at which the feature begins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featureflow.sources import geojson as GJ
from featureflow.sources import split as S
from featureflow.sources.files import without_text

SEP = b"}"
KEY = re.compile(rb'"features"\s*:\s*\[')
ESCAPED = re.compile(rb'(?<!\\)(?:\\\\)*\\"')
OPEN, CLOSE, COMMA = 1, 2, 3
_KIND = np.zeros(256, np.uint8)
_KIND[[ord("{"), ord("[")]] = OPEN
_KIND[[ord("}"), ord("]")]] = CLOSE
_KIND[ord(",")] = COMMA
_STEP = np.array([0, 1, -1, 0], np.int8)
FAR = 1 << 30

_ways = ", ".join(f"`{c}{h}` long" for h in (0, 1) for c in ("step", "least", "key", "after"))
RANGES = f"_doc string, _range long, _size long, bytes long, flips boolean, {_ways}"


def marks(buf: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Places of brackets and commas, their kinds, whether each has an odd number of quotes before it, and the text's parity."""
    a = np.frombuffer(buf, np.uint8)
    quote = a == ord('"')
    if b'\\"' in buf:
        for m in ESCAPED.finditer(buf):
            quote[m.end() - 1] = False
    odd = np.cumsum(quote, dtype=np.uint8) & 1
    at = np.flatnonzero(_KIND[a])
    return at, _KIND[a[at]], odd[at].astype(bool), bool(odd[-1]) if len(odd) else False


class _Way:
    """What a range does if it is entered outside (0) or inside (1) a text; depths are relative to its entry."""

    def __init__(self, inside: bool):
        self.inside, self.depth, self.least, self.key, self.after = inside, 0, 0, FAR, FAR

    def feed(self, buf: bytes, found: tuple, keys: list[int]) -> None:
        at, kind, odd, flips = found
        out = odd == self.inside
        at, kind = at[out], kind[out]
        depth = self.depth + np.cumsum(_STEP[kind], dtype=np.int64)
        cut = 0
        for bracket in keys:
            i = int(np.searchsorted(at, bracket))
            if i < len(at) and at[i] == bracket and depth[i] - 1 < self.key:
                self.key, self.after, cut = int(depth[i]) - 1, FAR, i
        if len(depth):
            self.least = min(self.least, int(depth.min()))
            if self.key < FAR:
                self.after = min(self.after, int(depth[cut:].min()))
            self.depth = int(depth[-1])
        self.inside ^= flips


def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First pass: one row a range."""
    out = []
    for row, buf, first, last in S.runs(batches, SEP):
        if first:
            ways, size, parity = (_Way(False), _Way(True)), 0, False
        found = marks(buf)
        keys = [m.end() - 1 for m in KEY.finditer(buf)]
        for w in ways:
            w.feed(buf, found, keys)
        size, parity = size + len(buf), parity ^ found[3]
        if last:
            out.append({"_doc": row["_doc"], "_range": row["_range"], "_size": row["_size"], "bytes": size, "flips": parity}
                       | {f"{n}{h}": v for h, w in enumerate(ways) for n, v in
                          (("step", w.depth), ("least", w.least), ("key", w.key), ("after", w.after))})
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
            [("_doc", pa.string()), ("_range", pa.int64()), ("_size", pa.int64()), ("bytes", pa.int64()), ("flips", pa.bool_())]
            + [(f"{n}{h}", pa.int64()) for h in (0, 1) for n in ("step", "least", "key", "after")]))


def entry_states(ranges: DataFrame) -> DataFrame:
    """``_doc, _range, start, cut, inside, depth, phase``: how each range is entered (phase: 0 before, 1 in, 2 after the array)."""
    by = Window.partitionBy("_doc").orderBy("_range")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    r = S.first_bytes(ranges)
    r = r.withColumn("inside", F.coalesce(F.sum(F.col("flips").cast("int")).over(before), F.lit(0)) % 2 == 1)
    way = lambda n: F.when(F.col("inside"), F.col(f"{n}1")).otherwise(F.col(f"{n}0"))
    r = r.select("_doc", "_range", "start", "cut", "inside", way("step").alias("step"), way("least").alias("least"),
                 way("key").alias("key"), way("after").alias("after"))
    r = r.withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    opens = (F.col("depth") + F.col("key") == 1) & (F.col("key") < FAR)
    r = r.withColumn("opened", F.coalesce(F.max(opens).over(before), F.lit(False)))
    r = r.withColumn("low", F.when(F.col("opened"), F.col("depth") + F.col("least")).when(opens, F.col("depth") + F.col("after")))
    phase = F.when(~F.col("opened"), 0).when(F.min("low").over(before) >= 2, 1).otherwise(2)
    return r.select("_doc", "_range", "start", "cut", "inside", "depth", phase.alias("phase"))


class _Cutter:
    """Second pass over one range: its features, pieces of features, and what is no feature."""

    def __init__(self, state: dict):
        self.doc, self.at = state["_doc"], state["start"]
        self.inside, self.depth, self.phase = state["inside"], state["depth"], state["phase"]
        self.part, self.begin, self.continued, self.head = [], self.at, self.phase == 1, False
        self.rows: list[tuple] = []

    def _start(self, place: int, head: bool) -> None:
        self.begin, self.continued, self.head = place, False, head

    def _end(self, text: bytes, ended: bool, final: bool) -> None:
        self.rows.append((self.doc, self.begin, b"".join([*self.part, text]), self.continued, ended, self.head, final, False))
        self.part = []

    def _shell(self, text: bytes, place: int) -> None:
        if text:
            self.rows.append((self.doc, place, text, False, True, False, False, True))

    def feed(self, buf: bytes) -> None:
        at, kind, odd, flips = marks(buf)
        out = odd == self.inside
        at, kind = at[out], kind[out]
        depth = self.depth + np.cumsum(_STEP[kind], dtype=np.int64)
        begin = 0
        if self.phase == 0:
            for m in KEY.finditer(buf):
                i = int(np.searchsorted(at, m.end() - 1))
                if i < len(at) and at[i] == m.end() - 1 and depth[i] == 2:
                    begin, self.phase = m.end(), 1
                    self._start(self.at + begin, True)
                    break
            self._shell(buf[:begin or len(buf)], self.at)
        if self.phase == 1:
            i = int(np.searchsorted(at, begin))
            closing = np.flatnonzero((kind[i:] == CLOSE) & (depth[i:] == 1))
            end = i + int(closing[0]) if len(closing) else len(at)
            for c in at[i:end][(kind[i:end] == COMMA) & (depth[i:end] == 2)].tolist():
                self._end(buf[begin:c], True, False)
                begin = c + 1
                self._start(self.at + begin, False)
            if len(closing):
                stop = int(at[end])
                self._end(buf[begin:stop], True, True)
                self.phase, begin = 2, stop
                self._shell(buf[stop:], self.at + stop)
            else:
                self.part.append(buf[begin:])
        elif self.phase == 2:
            self._shell(buf, self.at)
        self.depth = int(depth[-1]) if len(depth) else self.depth
        self.inside ^= flips
        self.at += len(buf)

    def close(self) -> None:
        if self.phase == 1:
            self._end(b"", False, False)


_OUT = pa.schema([("_doc", pa.string()), ("_ord", pa.int64()), ("piece", pa.binary()), ("continued", pa.bool_()),
                  ("ended", pa.bool_()), ("head", pa.bool_()), ("final", pa.bool_()), ("shell", pa.bool_())])


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second pass: features and pieces."""
    for row, buf, first, last in S.runs(batches, SEP):
        if first:
            c = _Cutter(S.known(row))
        c.feed(buf[:-1] if last and row["cut"] else buf)
        if last:
            c.close()
        if c.rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*c.rows), _OUT)], schema=_OUT)
            c.rows = []


def read_geojson_split(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON documents, a file each, split over tasks: the rows of ``read_geojson``, with byte places as ``_ord``."""
    S.refuse_compressed(spark, path)
    toks = S.tokens(spark, path, SEP.decode())
    ranges = S.surveyed(toks, survey, RANGES)
    states = entry_states(ranges)
    pieces = S.with_states(toks, states).mapInArrow(cut, S.PIECES)

    shells = pieces.where("shell").groupBy("_doc").agg(S.in_order(F.col("piece").cast("string"), "_ord").alias("value"))
    with_text = S.first_bytes(ranges).where("bytes > 1 OR NOT cut")
    rest = GJ.parse_geojson(shells.unionByName(without_text(spark, path, with_text)), problem=_other_type)

    items = S.stitched(pieces.where(~F.col("shell")).drop("shell"))
    nothing = F.col("text").rlike(r"^\s*$") & F.col("head") & F.col("final")
    # the parser stops after the first value: as an array, two values without a comma are an error
    alone = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), "text", F.lit("]"))), "$", "array<variant>")
    items = items.where(~nothing).select("_doc", "_ord", GJ.let(alone, lambda a: F.when(F.size(a) == 1, F.get(a, 0))).alias("item"))
    place = F.col("_ord")
    return GJ.features(items, place, F.when(F.col("item").isNull(), F.lit("invalid JSON"))
                       .otherwise(GJ.item_problem(F.col("item"), place))).unionByName(rest)


def _other_type(doc: Column) -> Column:
    """Why a shell does not fit the features cut out of it, or null."""
    cut_out = F.try_variant_get(F.variant_get(doc, "$.features", "variant"), "$", "array<variant>").isNotNull()
    return F.when(cut_out & ~F.coalesce(GJ.kind_of(doc) == "FeatureCollection", F.lit(False)),
                  F.lit("'features' in a document of another type"))

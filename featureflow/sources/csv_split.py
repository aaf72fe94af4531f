"""Huge CSV files read by many tasks, also where quoted cells hold line breaks.

See ``split`` for the two passes. A range begins at a line; that line begins a
row or continues a quoted cell. The first pass tells for both cases in which of
them the range ends, the second cuts rows knowing the case, and rows that cross
ranges are joined. A quote opens a cell only at the cell's start, a doubled one
is a quote, and what follows a closing quote runs to the separator.

Defined cases: UTF-8 with or without a byte order mark; lines end with a line
feed, with or without a carriage return before it; the first row of every file
is its header, blank rows are passed by; a row with more cells than the header,
and one whose quote is never closed, keeps its problem; empty files have no
rows. ``_ord`` is the byte at which the row begins.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featureflow.sources import csv as CSV
from featureflow.sources import split as S

RANGES = "_doc string, _range long, _size long, bytes long, row boolean, cell boolean"


def line_end(sep: str) -> Callable[[bytes, bool], bool]:
    """Whether a line, entered inside a quoted cell or not, ends inside one."""
    s = re.escape(sep.encode())
    rest = rb"(?:(?!" + s + rb").)*+"
    quoted = rb'"(?:[^"]|"")*+"' + rest
    opens = re.compile(rb"(?:(?:" + quoted + rb'|(?!")' + rest + rb")" + s + rb')*+"(?:[^"]|"")*+\Z', re.DOTALL)
    closes = re.compile(rb'(?:[^"]|"")*+"' + rest, re.DOTALL)
    width = len(sep.encode())

    def end(line: bytes, inside: bool) -> bool:
        if b'"' not in line:
            return inside
        if inside:
            m = closes.match(line)
            if not m:
                return True
            line = line[m.end() + width:]
        return opens.match(line) is not None

    return end


def _survey(sep: str):
    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, end = [], line_end(sep)
        for row, buf, first, last in S.runs(batches, b"\n"):
            if first:
                a, b, size = False, True, 0
            size += len(buf)
            for line in buf.split(b"\n")[:-1]:
                if b'"' in line:
                    same, a = a == b, end(line, a)
                    b = a if same else end(line, b)
            if last:
                out.append({"_doc": row["_doc"], "_range": row["_range"], "_size": row["_size"], "bytes": size, "row": a, "cell": b})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("_doc", pa.string()), ("_range", pa.int64()), ("_size", pa.int64()), ("bytes", pa.int64()), ("row", pa.bool_()), ("cell", pa.bool_())]))

    return survey


def entry_states(ranges: DataFrame) -> DataFrame:
    """``_doc, _range, start, cut, inside``: whether each range begins inside a quoted cell.

    A range whose end does not depend on its entry settles the state; one that
    turns it round is counted.
    """
    by = Window.partitionBy("_doc").orderBy("_range")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    r = S.first_bytes(ranges)
    turns = F.sum((F.col("row") & ~F.col("cell")).cast("int"))
    r = r.withColumn("turned", turns.over(by.rowsBetween(Window.unboundedPreceding, 0)))
    settled = F.when(F.col("row") == F.col("cell"), F.col("row").cast("int") + F.col("turned"))
    since = F.coalesce(F.last(settled, ignorenulls=True).over(before), F.lit(0)) + F.coalesce(F.last("turned").over(before), F.lit(0))
    return r.select("_doc", "_range", "start", "cut", (since % 2 == 1).alias("inside"))


def _cut(sep: str):
    schema = pa.schema([("_doc", pa.string()), ("_ord", pa.int64()), ("piece", pa.binary()), ("continued", pa.bool_()),
                        ("ended", pa.bool_()), ("head", pa.bool_()), ("final", pa.bool_()), ("shell", pa.bool_())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = line_end(sep)
        for row, buf, first, last in S.runs(batches, b"\n"):
            if first:
                S.known(row)
                place, inside, head, part = row["start"], row["inside"], row["start"] == 0, []
                begin, continued = place, inside
            rows = []
            for line in buf.split(b"\n")[:-1]:
                inside = end(line, inside)
                part.append(line)
                place += len(line) + 1
                if not inside:
                    text = b"\n".join(part)
                    if continued or text.strip(b"\r"):
                        rows.append((row["_doc"], begin, text, continued, True, head, False, False))
                        head = False
                    begin, continued, part = place, False, []
            if last and part:
                rows.append((row["_doc"], begin, b"\n".join([*part, b""]), continued, False, head, False, False))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    return cut


def read_csv_split(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """The records of ``read_csv``, its files split over tasks, with byte places as ``_ord``."""
    S.refuse_compressed(spark, path)
    sep, header = CSV.read_header(spark, path, "utf-8", sep, True)
    toks = S.tokens(spark, path, "\n")
    states = entry_states(S.surveyed(toks, _survey(sep), RANGES))
    rows = S.stitched(S.with_states(toks, states).mapInArrow(_cut(sep), S.PIECES)).where(~F.col("head"))
    line = F.regexp_replace("text", "\r?\n?$", "")
    options = {"sep": sep, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_raw"}
    schema = ", ".join([*(f"_cell{i} STRING" for i in range(len(header))), "_raw STRING"])
    parsed = rows.select("_doc", "_ord", "ended", F.from_csv(line, schema, options).alias("_c"))
    cells = [F.col("_c")[f"_cell{i}"].alias(h) for h, i in {h: i for i, h in enumerate(header)}.items()]
    wide = CSV.cell_count(F.col("_c")["_raw"], sep) > len(header)
    return parsed.select("_doc", "_ord", *cells, F.when(~F.col("ended"), F.lit("quoted cell is not closed"))
                         .when(wide, F.lit(f"row has more than {len(header)} cells")).alias("_problem"))

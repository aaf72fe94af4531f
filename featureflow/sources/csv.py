"""Delimited text.

Cells are read as strings and coerced per cell with regexes, like a loader
that keeps ``01234`` and ``+44`` as text. Delimiter sniffing looks at one
header line only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions.geo import let

# Candidate delimiters, and the text forms that round-trip exactly.
DELIMITERS = [",", ";", "\t", "|"]
INT_PATTERN = r"^(0|-?[1-9][0-9]*)$"
FLOAT_PATTERN = r"^-?(0|[1-9][0-9]*)[.]([0-9]|[0-9]*[1-9])$"
EXPONENT_PATTERN = r"^-?[1-9]([.][0-9]*[1-9])?e(-(0[5-9]|[1-9][0-9]+)|[+](1[6-9]|[2-9][0-9]|[1-9][0-9]{2,}))$"
_WS = r"^\s+|\s+$"


def sniff_delimiter(header: str) -> str:
    """The delimiter that splits the header into the most fields (comma on a tie)."""
    header = header.lstrip("﻿")
    best, best_n = ",", 1
    for d in DELIMITERS:
        n = len(header.split(d))
        if n > best_n:
            best, best_n = d, n
    return best


def _is_shortest(s: Column, d: Column) -> Column:
    """Whether a number's text has no more digits than its double needs.

    15 digits always come back; 16 or 17 are needed if neither neighbour with
    one digit less is the same double. More are never needed.
    """
    low = F.lower(s)
    mantissa = F.regexp_replace(F.substring_index(low, "e", 1), "-", "")
    power = F.when(low.contains("e"), F.regexp_replace(F.substring_index(low, "e", -1), "[+]", "").try_cast("int")).otherwise(F.lit(0))
    decimals = F.when(mantissa.contains("."), F.length(F.substring_index(mantissa, ".", -1))).otherwise(F.lit(0))
    digits = F.regexp_replace(F.regexp_replace(mantissa, "[.]", ""), "^0+", "")

    def longer(parts: Column) -> Column:
        """Of (digits, power of the last digit): is there a shorter text of the same double?"""
        head = F.substring(parts["digits"], F.lit(1), F.length(parts["digits"]) - 1).try_cast("long")
        up = F.concat(F.lit("e"), (parts["power"] + 1).cast("string"))
        same = lambda n: F.concat(n.cast("string"), up).try_cast("double") == F.abs(d)
        return F.coalesce(same(head) | same(head + 1), F.lit(False))

    n = F.length(digits)
    return (n <= 15) | ((n <= 17) & ~let(F.struct(digits.alias("digits"), (power - decimals).alias("power")), longer))


def coerce_kind(cell: Column) -> Column:
    """``null``/``bool``/``int``/``float``/``str`` for one CSV cell."""
    def kind(s: Column) -> Column:
        low, d = F.lower(s), s.try_cast("double")
        # a number only if its shortest text is the cell: 0.30000000000000004 is, 0.300000000000000041 is not
        plain = s.rlike(FLOAT_PATTERN) & (F.abs(d) >= F.lit(1e-4)) & (F.abs(d) < F.lit(1e16))
        is_float = (plain | s.rlike(EXPONENT_PATTERN)) & _is_shortest(s, d)
        return (F.when((s == "") | (low == "null"), F.lit("null"))
                .when(low.isin("true", "false"), F.lit("bool"))
                .when(s.rlike(INT_PATTERN) & (F.length(s) <= 38), F.lit("int"))
                .when(s.isin("0.0", "-0.0"), F.lit("float"))
                .when(is_float, F.lit("float"))
                .otherwise(F.lit("str")))

    return F.when(cell.isNull(), F.lit("null")).otherwise(let(F.regexp_replace(cell, _WS, ""), kind))


def coerce(cell: Column) -> Column:
    """The coerced cell as VARIANT (strings keep their whitespace)."""
    s = F.regexp_replace(cell, _WS, "")
    return let(coerce_kind(cell), lambda kind: (
        F.when(kind == "null", F.lit(None).cast("variant"))
        .when(kind == "bool", (F.lower(s) == "true").cast("variant"))
        .when(kind == "int", s.try_cast("decimal(38,0)").cast("variant"))
        .when(kind == "float", s.try_cast("double").cast("variant"))
        .otherwise(cell.cast("variant"))))


def parse_lines(lines: DataFrame, header: list[str], sep: str, line_col: str = "value") -> DataFrame:
    """Parse CSV lines (no header row) into string columns plus ``_too_many``.

    A row with more cells than the header is flagged, also when the further
    cells are empty; a shorter row keeps nulls in its missing cells. Quoting is
    handled by ``from_csv``, a quote inside quotes being doubled.
    """
    schema = ", ".join(f"`{h}` STRING" for h in header)
    parsed = lines.withColumn("_cells", F.from_csv(F.col(line_col), schema, {"sep": sep, "mode": "PERMISSIVE", "escape": '"'}))
    cols = [F.col("_cells")[h].alias(h) for h in header]
    return parsed.select(*[c for c in lines.columns if c != line_col], *cols,
                         (cell_count(F.col(line_col), sep) > len(header)).alias("_too_many"))


def cell_count(line: Column, sep: str) -> Column:
    """Cells of a CSV row: the separators outside quotes, and one."""
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _options(encoding: str, sep: str, multi_line: bool) -> dict:
    return {"sep": sep, "encoding": encoding, "escape": '"', "multiLine": multi_line, "mode": "PERMISSIVE"}


def read_header(spark: SparkSession, path: str, encoding: str, sep: str | None, multi_line: bool) -> tuple[str, list[str]]:
    """The separator, sniffed if not given, and the names of the header."""
    first = spark.read.option("encoding", encoding).text(path).limit(1).collect()
    line = first[0][0].lstrip("\ufeff") if first else ""
    sep = sep or sniff_delimiter(line)
    options = _options(encoding, sep, multi_line)
    names = spark.read.options(**options, header=False, inferSchema=False).csv(path).limit(1).collect() if first else []
    header = [(c or "").lstrip("\ufeff").strip() for c in names[0]] if names else []
    if not header or "" in header:
        raise ValueError(f"CSV header contains an empty column name: {header!r}")
    return sep, header


def read_csv(spark: SparkSession, path: str, encoding: str = "utf-8", sep: str | None = None,
             multi_line: bool = True) -> DataFrame:
    """Header CSV with a sniffed delimiter, as records with ``_doc``, ``_ord`` and ``_problem``.

    Every cell is a STRING (coerce with S7). Quotes are doubled inside quotes.
    With ``multi_line`` a quoted cell may hold line breaks, and a file is one
    task; switch it off to split huge files whose cells hold none. A row with
    more cells than the header is kept with its problem.
    """
    sep, header = read_header(spark, path, encoding, sep, multi_line)
    options = _options(encoding, sep, multi_line)
    wide = T.StructType([T.StructField(f"_cell{i}", T.StringType()) for i in range(len(header))] + [T.StructField("_raw", T.StringType())])
    rows = (spark.read.options(**options, header=True, columnNameOfCorruptRecord="_raw", enforceSchema=True)
            .schema(wide).csv(path))
    place = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33)) + F.col("_metadata.file_block_start") * F.lit(1 << 20)
    # of columns of one name the last one stands
    cells = [F.col(f"_cell{i}").alias(h) for h, i in {h: i for i, h in enumerate(header)}.items()]
    too_many = cell_count(F.col("_raw"), sep) > len(header)
    return rows.select(F.col("_metadata.file_path").alias("_doc"), place.alias("_ord"), *cells,
                       F.when(too_many, F.concat(F.lit(f"row has more than {len(header)} cells"))).alias("_problem"))


def coerced(records: DataFrame, text: Sequence[str] = ()) -> DataFrame:
    """S7 for the rows of ``read_csv``: every cell as VARIANT, but for those in ``text``."""
    from featureflow.operators import is_property, named

    return records.select(*[coerce(named(c)).alias(c) if is_property(c) and c not in text else named(c) for c in records.columns])


def decode_check(content: Column, encoding: str = "UTF-8") -> Column:
    """Whether binary content is valid text in ``encoding``."""
    if encoding.upper().replace("-", "") == "UTF8":
        return F.is_valid_utf8(content.cast("string"))
    return F.try_to_binary(F.decode(content, encoding), F.lit("utf-8")).isNotNull()

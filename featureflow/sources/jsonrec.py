"""JSON documents + record selectors.

A selector (``$.a.b``, ``a.b``, ``$.a[0]``, ``$.a[-1]``, ``$.a[*]``,
``$["odd.key"]``) is turned into a chain of VARIANT lookups. A missing member
is reported, never read as an empty list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions import geo
from featureflow.functions.geo import json_type_name, let
from featureflow.operators.features import as_number

def selector_steps(selector: str | None) -> list[str | int | None]:
    """A selector as a list of steps: a member's name, an index, or None for all values.

    The text is taken apart from the left: a dot takes a bare name, a bracket
    takes a number, a star, or a quoted name in which a backslash keeps the
    character after it.
    """
    rest = (selector or "").strip()
    rest = rest[1:] if rest.startswith("$") else "." + rest.lstrip(".") if rest else ""
    steps: list[str | int | None] = []
    while rest:
        before = rest
        if rest[0] == ".":
            size = next((i for i, ch in enumerate(rest[1:]) if ch in ".[]"), len(rest) - 1)
            name, rest = rest[1:size + 1], rest[size + 1:]
            steps.append(name or _bad(selector, before))
        elif rest[0] == "[":
            step, rest = _bracketed(selector, rest[1:].lstrip())
            steps.append(step)
        else:
            _bad(selector, before)
    return steps


def _bad(selector: str | None, at: str):
    raise ValueError(f"selector {selector!r} is not understood from {at!r} on")


def _bracketed(selector: str | None, rest: str) -> tuple[str | int | None, str]:
    """The step inside a bracket and what follows the closing bracket."""
    if rest[:1] in ("'", '"') and rest:
        name, i = [], 1
        while i < len(rest) and rest[i] != rest[0]:
            i += rest[i] == "\\"
            name.append(rest[i:i + 1])
            i += 1
        inner, tail = "".join(name), rest[i + 1:].lstrip()
    else:
        text, found, tail = rest.partition("]")
        tail, text = found + tail, text.strip()
        digits = text[1:] if text.startswith("-") else text
        inner = None if text == "*" else int(text) if digits.isdigit() else _bad(selector, "[" + rest)
    if not tail.startswith("]"):
        _bad(selector, "[" + rest)
    return inner, tail[1:]


def _step(value: Column, step: str | int | None, place: str) -> tuple[Column, Column]:
    """One step down from ``value``: what is there, or why nothing is."""
    members = F.try_variant_get(value, "$", "map<string,variant>")
    items = F.try_variant_get(value, "$", "array<variant>")
    kind = json_type_name(value)
    if step is None:
        every = F.coalesce(items, F.map_values(members)).cast("variant")
        return every, F.when(every.isNull(), F.concat(F.lit(f"no values to list at {place}: "), kind))
    if isinstance(step, int):
        item = F.try_element_at(items, F.lit(step + 1 if step >= 0 else step))
        return item, (F.when(items.isNull(), F.concat(F.lit(f"no array at {place}: "), kind))
                      .when(item.isNull(), F.concat(F.lit(f"no item {step} among "), F.size(items).cast("string"), F.lit(f" at {place}"))))
    member = F.try_element_at(members, F.lit(step))
    return member, (F.when(members.isNull(), F.concat(F.lit(f"no object at {place}: "), kind))
                    .when(member.isNull(), F.lit(f"no member {step!r} at {place}")))


def select_path(v: Column, selector: str | None) -> tuple[Column, Column]:
    """``(value, problem)``; value is VARIANT (an array for ``[*]``). The first step that fails names the problem."""
    value, problems, place = v, [], "$"
    for step in selector_steps(selector):
        value, problem = _step(value, step, place)
        problems.append(problem)
        place += "[*]" if step is None else f"[{step}]" if isinstance(step, int) else f".{step}"
    return value, F.coalesce(*problems) if problems else F.lit(None).cast("string")


def select_records(doc: Column, selector: str | None) -> tuple[Column, Column]:
    """S3: ``(array<variant> of record objects, problem)``."""
    value, missing = select_path(doc, selector)
    place = selector or "$"
    records = F.try_variant_get(value, "$", "array<variant>")

    def unusable(rs: Column) -> Column:
        odd = F.transform(rs, lambda r, i: F.when(F.try_variant_get(r, "$", "map<string,variant>").isNull(), F.concat(
            F.lit(f"record no object at {place}["), i.cast("string"), F.lit("]: "), json_type_name(r))))
        return F.coalesce(missing, F.when(rs.isNull(), F.concat(F.lit(f"no list of records at {place}: "), json_type_name(value))),
                          F.get(F.filter(odd, lambda p: p.isNotNull()), 0))

    return records, let(records, unusable)


def read_json_records(spark: SparkSession, path: str, selector: str | None = None) -> DataFrame:
    """S3: JSON documents, one per file, as schemaless records ``(_doc, _ord, rec, _problem)``.

    An unreadable document is one row with its problem.
    """
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("_doc"), "value")
    records, problems = scan_json_records(docs, selector)
    return records.withColumn("_problem", F.lit(None).cast("string")).unionByName(problems, allowMissingColumns=True)


def features_of_records(records: DataFrame, lon: str, lat: str) -> DataFrame:
    """B1, B3 on schemaless records: a Point from two members, the others as ``_props``; ready for a run.

    The one path from ``read_json_records`` or ``read_csv`` rows to features.
    """
    rec = F.try_variant_get(F.col("rec"), "$", "map<string,variant>")
    x, y = (as_number(rec[name], T.VariantType()) for name in (lon, lat))
    bad = F.when(x.isNull() | y.isNull(), F.concat(F.lit("record "), F.col("_ord").cast("string"), F.lit(f": {lon!r} or {lat!r} is not a number")))
    problem = F.coalesce(F.col("_problem"), bad)
    return records.select(
        "_doc", "_ord", F.when(problem.isNull(), geo.point(x, y)).alias("geometry"),
        F.to_variant_object(F.map_filter(rec, lambda k, _: ~k.isin(lon, lat))).alias("_props"), problem.alias("_problem"))


def scan_json_records(docs: DataFrame, selector: str | None, text_col: str = "value",
                      doc_col: str = "_doc") -> tuple[DataFrame, DataFrame]:
    """S3: ``(records, problems)``: one row per record ``(_doc, _ord, rec)``, and per-document problems."""
    parsed = docs.select(F.col(doc_col).alias("_doc"), F.try_parse_json(F.col(text_col)).alias("doc"))
    recs, problem = select_records(F.col("doc"), selector)
    staged = parsed.select("_doc", recs.alias("recs"),
                           F.when(F.col("doc").isNull(), F.lit("invalid JSON")).otherwise(problem).alias("_problem"))
    records = (staged.where(F.col("_problem").isNull())
               .select("_doc", F.posexplode("recs").alias("_ord", "rec"))
               .withColumn("_ord", F.col("_ord").cast("long")))
    problems = staged.where(F.col("_problem").isNotNull()).select("_doc", "_problem")
    return records, problems

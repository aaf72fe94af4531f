"""Records -> features (B1-B4): point geometry, geometry field, properties, id."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions import geo
from featureflow.operators import is_property, named


def _repr(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.concat(F.lit("'"), c, F.lit("'")), F.lit("None"))
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(F.when(c, F.lit("True")).otherwise(F.lit("False")), F.lit("None"))
    return F.coalesce(c.cast("string"), F.lit("None"))


def as_number(c: Column, dtype: T.DataType) -> Column:
    """B1: a coordinate value as DOUBLE; numeric text accepted, bool/null/text rejected (null)."""
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    def of_text(t: Column) -> Column:
        s = F.regexp_replace(t, r"^\s+|\s+$", "")
        # a cast would also take a type suffix such as 1d or 2F
        return F.when(~s.rlike("(?i)^[^n]*[0-9.][df]$"), s.try_cast("double"))

    if isinstance(dtype, T.StringType):
        return of_text(c)
    if isinstance(dtype, T.VariantType):
        s = F.schema_of_variant(c)
        return (F.when(s.rlike(r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"), F.variant_get(c, "$", "double"))
                .when(s == "STRING", of_text(F.variant_get(c, "$", "string"))))
    return F.lit(None).cast("double")


def map_point(records: DataFrame, lon: str, lat: str, index_col: str = "_ord") -> DataFrame:
    """B1: ``geometry`` Point from two fields (geometry fields dropped), ``_problem`` per record."""
    fields = {f.name: f.dataType for f in records.schema.fields}
    for name, role in ((lon, "longitude"), (lat, "latitude")):
        if name not in fields:
            raise ValueError(f"{role} field {name!r} is missing; available fields: "
                             + (", ".join(sorted(fields)[:10]) or "<no fields>"))
    x, y = as_number(named(lon), fields[lon]), as_number(named(lat), fields[lat])

    def bad(name: str) -> Column:
        return F.concat(F.lit("record "), F.col(index_col).cast("string"), F.lit(f": field {name!r} is not a number ("),
                        _repr(named(name), fields[name]), F.lit(")"))

    problem = _with_earlier(records, F.when(x.isNull(), bad(lon)).when(y.isNull(), bad(lat)))
    return (records.withColumn("geometry", F.when(problem.isNull(), geo.point(x, y)))
            .withColumn("_problem", problem).drop(lon, lat))


def map_geometry_field(records: DataFrame, field: str, index_col: str = "_ord") -> DataFrame:
    """B2: ``geometry`` from a field holding GeoJSON (object or JSON text), validated by G1."""
    dtype = records.schema[field].dataType
    raw = F.try_parse_json(named(field)) if isinstance(dtype, T.StringType) else named(field)
    if isinstance(dtype, T.VariantType):
        raw = F.when(F.schema_of_variant(raw) == "STRING", F.try_parse_json(F.variant_get(raw, "$", "string"))) \
            .otherwise(raw)
    staged = records.withColumn("geometry", raw)
    problem = geo.geometry_problem(F.col("geometry"))
    return staged.withColumn("_problem", _with_earlier(records, F.when(problem.isNotNull(), F.concat(
        F.lit("record "), F.col(index_col).cast("string"),
        F.lit(f": field {field!r} is not a valid GeoJSON geometry ("), problem, F.lit(")"))))).drop(field)


def _with_earlier(records: DataFrame, problem: Column) -> Column:
    """What the reader found wrong with a record stands before what the mapping finds."""
    return F.coalesce(F.col("_problem"), problem) if "_problem" in records.columns else problem


def map_properties(features: DataFrame, names: Sequence[str] | str = "*") -> DataFrame:
    """Keep listed properties (a missing one is an error naming what exists) or ``*`` for all."""
    props = [c for c in features.columns if is_property(c)]
    if names == "*":
        return features
    missing = [n for n in names if n not in props]
    if missing:
        raise ValueError(f"property field {missing[0]!r} is missing; available fields: "
                         + ", ".join(sorted(props)[:10]))
    keep = [c for c in features.columns if not is_property(c)]
    return features.select(*map(named, keep), *map(named, names))


def map_id(features: DataFrame, field: str) -> DataFrame:
    """Copy a field to the top-level feature id (it stays a property too)."""
    if field not in features.columns:
        raise ValueError(f"id field {field!r} is missing")
    return features.withColumn("_id", named(field))

"""Filter helpers with the reference filter language's null rules.

Plain SQL comparisons return NULL on a missing value, and NULL under ``NOT``
stays NULL, so rows vanish where the reference keeps them. These helpers pin
each operator to two-valued logic. Everything is a Column; Catalyst pushes
the comparisons that are plain SQL down to the scan.
"""

from __future__ import annotations

from functools import reduce
from typing import Any, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.operators import is_property


def _false() -> Column:
    return F.lit(False)


def _c(x: Any) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def prop(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """A property, or NULL when the frame or the row has no such property.

    In a schemaless frame the property is read as ``dtype``; a value of another
    kind is NULL.
    """
    if name in df.columns and is_property(name):
        return F.col(f"`{name}`")
    if "_props" in df.columns:
        if "'" not in name and "\\" not in name:
            return F.try_variant_get(F.col("_props"), f"$['{name}']", dtype)
        members = F.try_variant_get(F.col("_props"), "$", "map<string,variant>")
        return F.try_variant_get(F.try_element_at(members, F.lit(name)), "$", dtype)
    return F.lit(None)


def eq(a: Any, b: Any) -> Column:
    """``==`` where null equals null."""
    return _c(a).eqNullSafe(_c(b))


def ne(a: Any, b: Any) -> Column:
    """``!=``; a missing value differs from any present one."""
    return ~_c(a).eqNullSafe(_c(b))


def lt(a: Any, b: Any) -> Column:
    """Ordering comparisons are false when either side is null."""
    return F.coalesce(_c(a) < _c(b), _false())


def le(a: Any, b: Any) -> Column:
    return F.coalesce(_c(a) <= _c(b), _false())


def gt(a: Any, b: Any) -> Column:
    return F.coalesce(_c(a) > _c(b), _false())


def ge(a: Any, b: Any) -> Column:
    return F.coalesce(_c(a) >= _c(b), _false())


_OPS = {"<": lt, "<=": le, ">": gt, ">=": ge, "==": eq, "!=": ne}


def chain(first: Any, *pairs: tuple[str, Any]) -> Column:
    """P5: ``a < b <= c`` as the AND of adjacent comparisons."""
    terms, left = [], first
    for op, right in pairs:
        terms.append(_OPS[op](left, right))
        left = right
    return reduce(lambda x, y: x & y, terms)


def is_in(a: Any, values: Iterable[Any] | None) -> Column:
    """Membership; a null container is never a match, a null member matches null."""
    if values is None:
        return _false()
    values = list(values)
    present = [v for v in values if v is not None]
    hit = F.coalesce(_c(a).isin(present), _false()) if present else _false()
    return (hit | _c(a).isNull()) if len(present) < len(values) else hit


def not_in(a: Any, values: Iterable[Any] | None) -> Column:
    """``not in``; true for a null container and for a missing value."""
    return ~is_in(a, values)


def is_(a: Any, b: Any) -> Column:
    """``is`` against null/true/false."""
    return _c(a).isNull() if b is None else _c(a).eqNullSafe(_c(b))


def is_not(a: Any, b: Any) -> Column:
    return ~is_(a, b)


def truthy(c: Column, dtype: T.DataType) -> Column:
    """Python truthiness (null, 0, '' and [] are false)."""
    if isinstance(dtype, T.BooleanType):
        out = c
    elif isinstance(dtype, T.StringType):
        out = F.length(c) > 0
    elif isinstance(dtype, T.NumericType):
        out = c != 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        out = F.size(c) > 0
    else:
        out = c.isNotNull()
    return F.coalesce(out, _false())


def py_and(a: Column, a_type: T.DataType, b: Column) -> Column:
    """``a and b`` returns ``a`` when it is falsy, else ``b``."""
    return F.when(~truthy(a, a_type), a).otherwise(b)


def py_or(a: Column, a_type: T.DataType, b: Column) -> Column:
    """``a or b`` returns ``a`` when it is truthy, else ``b``."""
    return F.when(truthy(a, a_type), a).otherwise(b)


def py_not(a: Column, a_type: T.DataType) -> Column:
    return ~truthy(a, a_type)


def div(a: Any, b: Any) -> Column:
    """P10: true division, always double; ANSI mode raises on a zero divisor."""
    return _c(a).cast("double") / _c(b).cast("double")


def floordiv(a: Any, b: Any, integral: bool = True) -> Column:
    """``//`` rounds toward negative infinity; whole numbers never pass through a double."""
    a, b = _c(a), _c(b)
    if not integral:
        return F.floor(a.cast("double") / b.cast("double")).cast("double")
    a, b = a.cast("long"), b.cast("long")
    down = (a % b != 0) & ((a < 0) != (b < 0))
    return F.call_function("div", a, b) - F.when(down, F.lit(1)).otherwise(F.lit(0)).cast("long")


def mod(a: Any, b: Any) -> Column:
    """``%`` takes the divisor's sign (Spark's ``%`` takes the dividend's)."""
    a, b = _c(a), _c(b)
    r = a % b
    return F.when((r != 0) & ((r < 0) != (b < 0)), r + b).otherwise(r)


def if_else(cond: Column, cond_type: T.DataType, a: Any, b: Any) -> Column:
    """``a if cond else b``."""
    return F.when(truthy(cond, cond_type), _c(a)).otherwise(_c(b))


def length(c: Column, dtype: T.DataType) -> Column:
    """``len``; null counts as 0."""
    n = F.size(c) if isinstance(dtype, (T.ArrayType, T.MapType)) else F.length(c)
    return F.coalesce(n.cast("long"), F.lit(0).cast("long"))


def lower(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Lower case of a string; any other value as it is."""
    return F.lower(c) if isinstance(dtype, T.StringType) else c


def upper(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    return F.upper(c) if isinstance(dtype, T.StringType) else c


def to_int(c: Column) -> Column:
    """``int`` truncates toward zero; bad text raises under ANSI."""
    return c.cast("long")


def to_float(c: Column) -> Column:
    return c.cast("double")


def to_str(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """``str``; null becomes the empty string, booleans ``True`` and ``False``."""
    text = F.initcap(c.cast("string")) if isinstance(dtype, T.BooleanType) else c.cast("string")
    return F.coalesce(text, F.lit(""))


def startswith(c: Column, dtype: T.DataType, prefix: str) -> Column:
    """False for non-strings and nulls."""
    if not isinstance(dtype, T.StringType):
        return _false()
    return F.coalesce(c.startswith(prefix), _false())


def endswith(c: Column, dtype: T.DataType, suffix: str) -> Column:
    if not isinstance(dtype, T.StringType):
        return _false()
    return F.coalesce(c.endswith(suffix), _false())


def contains(c: Column, dtype: T.DataType, needle: Any) -> Column:
    """P20: substring or array membership; a null haystack is false."""
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.array_contains(c, _c(needle)), _false())
    return F.coalesce(c.contains(_c(needle)), _false())


def is_null(c: Column) -> Column:
    return c.isNull()


def coalesce(*cols: Any) -> Column:
    return F.coalesce(*[_c(x) for x in cols])


def missing_names(df: DataFrame, names: Iterable[str]) -> list[str]:
    """P22 pre-flight: referenced property names the frame does not have."""
    cols = set(df.columns)
    return sorted(n for n in set(names) if n not in cols)

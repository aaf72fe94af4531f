"""GeoJSON geometry as a VARIANT column: validation, positions, rounding.

Every function returns a Column; nothing leaves the JVM. The coordinate
depths of simple geometries are unrolled at plan-build time into higher-order
functions over ``array<variant>``. Collections are opened level by level with
an ``aggregate`` whose number of steps is the row's own nesting bound, so any
depth gives the same answer and rows without collections take no step.
"""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from featureflow.functions.canonical import number_variant

# Nesting depth of ``coordinates`` per simple geometry type.
COORD_DEPTH = {
    "Point": 0,
    "MultiPoint": 1,
    "LineString": 1,
    "MultiLineString": 2,
    "Polygon": 2,
    "MultiPolygon": 3,
}
GEOMETRY_TYPES = sorted([*COORD_DEPTH, "GeometryCollection"])

_NUMERIC = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"
# An array, nested or not, that holds numbers of one kind only.
_ALL_NUMERIC = r"^(ARRAY<)+(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\))>+$"
# By depth of ``coordinates``: an object of a type and numbers nested just so, and of nothing else.
_PLAIN = [rf"^OBJECT<coordinates: (ARRAY<){{{d}}}(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\))>{{{d}}}, type: STRING>$"
          for d in range(1, 5)]
# A feature's JSON text that begins with a point of two numbers and of nothing else.
POINT_TEXT = r'^\{"geometry":\{"coordinates":\[-?[0-9][0-9.eE+-]*,-?[0-9][0-9.eE+-]*\],"type":"Point"\}[,}]'
_LEAF = "struct<depth: int, g: variant>"
_PIECE = "struct<lead: string, g: variant>"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` (a lambda binding).

    Expressions inside higher-order functions run interpreted, without common
    subexpression elimination; binding shared values keeps each row's work
    linear in the size of its geometry. The functions of a geometry below bind
    it first: a filter on one is pushed below the projection that made the
    geometry, and what made it then takes its place once, not at every mention.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


_BUILT: dict[tuple, object] = {}


def built(build, *args):
    """``build(F.col("geometry"), *args)``, made once per Spark application.

    The expressions here have thousands of nodes, and each is a call from
    Python to the JVM: seconds, when built anew for every frame.
    """
    key = (SparkContext.getOrCreate().applicationId, build.__name__, args)
    if key not in _BUILT:
        _BUILT[key] = build(F.col("geometry"), *args)
    return _BUILT[key]


def _array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _member(v: Column, name: str) -> Column:
    return F.variant_get(v, f"$.{name}", "variant")


def json_type_name(v: Column) -> Column:
    """The Python type name of a JSON value (``dict``, ``list``, ``str``...)."""
    s = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit("NoneType"))
        .when(s.startswith("OBJECT"), F.lit("dict"))
        .when(s.startswith("ARRAY"), F.lit("list"))
        .when(s == "STRING", F.lit("str"))
        .when(s == "BOOLEAN", F.lit("bool"))
        .when(s == "VOID", F.lit("NoneType"))
        .when(s.rlike(r"^(TINYINT|SMALLINT|INT|BIGINT)$") | s.rlike(r"^DECIMAL\([0-9]+,0\)$"), F.lit("int"))
        .otherwise(F.lit("float"))
    )


def is_number(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).rlike(_NUMERIC), F.lit(False))


def _float_text(d: Column) -> Column:
    """Python ``str(float)`` for ordinary magnitudes."""
    return d.cast("string")


def _first(problems: Column) -> Column:
    return F.get(F.filter(problems, lambda x: x.isNotNull()), 0)


def _position_problem(p: Column) -> Column:
    def check(arr: Column) -> Column:
        n = F.size(arr)
        lon = F.variant_get(arr[0], "$", "double")
        lat = F.variant_get(arr[1], "$", "double")
        return (
            F.when(arr.isNull(), F.concat(F.lit("position must be an array, got "), json_type_name(p)))
            .when((n < 2) | (n > 3), F.concat(F.lit("position must have 2 or 3 numbers, got "), n.cast("string")))
            .when(~F.forall(arr, is_number), F.lit("position components must be numbers"))
            .when(~lon.between(-180.0, 180.0),
                  F.concat(F.lit("longitude "), _float_text(lon), F.lit(" is outside [-180, 180]")))
            .when(~lat.between(-90.0, 90.0),
                  F.concat(F.lit("latitude "), _float_text(lat), F.lit(" is outside [-90, 90]")))
        )

    return let(_array(p), check)


def _nested_problem(c: Column, depth: int) -> Column:
    if depth == 0:
        return _position_problem(c)

    def check(arr: Column) -> Column:
        return (
            F.when(arr.isNull(), F.concat(F.lit(f"expected an array at nesting depth {depth}, got "),
                                          json_type_name(c)))
            .when(F.size(arr) == 0, F.lit("coordinate array must not be empty"))
            .otherwise(_first(F.transform(arr, lambda e: _nested_problem(e, depth - 1))))
        )

    return let(_array(c), check)


def _ring_problem(kind: Column, rings: Column) -> Column:
    def one(r: Column) -> Column:
        return (
            F.when(F.size(r) < 4, F.concat(kind, F.lit(": a linear ring needs at least 4 positions, got "),
                                           F.size(r).cast("string")))
            .when(~(F.slice(r[0], 1, 2) == F.slice(F.element_at(r, -1), 1, 2)),
                  F.concat(kind, F.lit(": linear ring is not closed (first position != last)")))
        )

    return _first(F.transform(rings, one))


def _depth_of(kind: Column) -> Column:
    out = None
    for name, depth in COORD_DEPTH.items():
        out = F.when(kind == name, F.lit(depth)) if out is None else out.when(kind == name, F.lit(depth))
    return out


def _simple_problem(kind: Column, coords: Column) -> Column:
    """Problems of a simple geometry; one nested check per depth, shared by types."""
    def check(depth: Column) -> Column:
        nested = None
        for d in range(4):
            nested = F.when(depth == d, _nested_problem(coords, d)) if nested is None else \
                nested.when(depth == d, _nested_problem(coords, d))
        rings = (F.when(kind == "Polygon", F.try_variant_get(coords, "$", "array<array<array<double>>>"))
                 .when(kind == "MultiPolygon",
                       F.flatten(F.try_variant_get(coords, "$", "array<array<array<array<double>>>>"))))
        return let(nested, lambda problem: (
            F.when(coords.isNull(), F.concat(kind, F.lit(" geometry has no 'coordinates'")))
            .when(problem.isNotNull(), F.concat(kind, F.lit(": "), problem))
            .otherwise(_ring_problem(kind, rings))))

    return let(_depth_of(kind), check)


def _kind_repr(kind_v: Column) -> Column:
    s = F.schema_of_variant(kind_v)
    return (
        F.when(kind_v.isNull() | (s == "VOID"), F.lit("None"))
        .when(s == "STRING", F.concat(F.lit("'"), F.variant_get(kind_v, "$", "string"), F.lit("'")))
        .when(s == "BOOLEAN", F.when(F.variant_get(kind_v, "$", "boolean"), "True").otherwise("False"))
        .otherwise(F.to_json(kind_v))
    )


def geometry_kind(v: Column) -> Column:
    """``type`` member when it is a string, else null."""
    kind_v = _member(v, "type")
    return F.when(F.schema_of_variant(kind_v) == "STRING", F.variant_get(kind_v, "$", "string"))


def _object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _kind_of_map(m: Column) -> Column:
    kind_v = m["type"]
    return F.when(F.schema_of_variant(kind_v) == "STRING", F.variant_get(kind_v, "$", "string"))


def _is_collection(v: Column) -> Column:
    # no other value than this text reads as it
    return F.coalesce(F.try_variant_get(v, "$.type", "string") == "GeometryCollection", F.lit(False))


def _members(v: Column) -> Column:
    """The members of a collection, or null when the value is none."""
    return F.when(_is_collection(v), F.try_variant_get(v, "$.geometries", "array<variant>"))


def _levels(v: Column) -> Column:
    """An upper bound of a geometry's collection nesting: 0 unless it is a collection."""
    def times(text: Column) -> Column:
        return F.floor((F.length(text) - F.length(F.replace(text, F.lit('"geometries"'), F.lit("")))) / F.lit(12)).cast("int")

    return F.when(_is_collection(v), let(F.to_json(v), times)).otherwise(F.lit(0))


def _opened(v: Column, first: Column, step) -> Column:
    """Apply ``step`` to the list ``first`` once for each level of nesting of ``v``."""
    return F.aggregate(let(_levels(v), lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))),
                       first, lambda acc, _: step(acc))


def leaves(v: Column) -> Column:
    """``array<struct<depth, g>>``: a geometry's simple members in order, and collections without members."""
    def step(acc: Column) -> Column:
        def one(x: Column) -> Column:
            return let(_members(x["g"]), lambda ms: F.when(F.size(ms) > 0, F.transform(
                ms, lambda m: F.struct((x["depth"] + 1).alias("depth"), m.alias("g")).cast(_LEAF))).otherwise(F.array(x)))

        return F.flatten(F.transform(acc, one))

    return _opened(v, F.array(F.struct(F.lit(0).alias("depth"), v.alias("g")).cast(_LEAF)), step)


def _sound(v: Column) -> Column:
    """Whether a geometry is plain and without a problem: then no part of it needs to be taken out and named."""
    kind = F.try_variant_get(v, "$.type", "string")

    def position(p: Column) -> Column:
        return (F.size(p).between(2, 3) & F.get(p, 0).between(-180.0, 180.0) & F.get(p, 1).between(-90.0, 90.0)
                & ((F.size(p) == 2) | F.get(p, 2).isNotNull()))

    def line(r: Column) -> Column:
        return (F.size(r) > 0) & F.forall(r, position)

    def ring(r: Column) -> Column:
        return line(r) & (F.size(r) >= 4) & (F.slice(F.get(r, 0), 1, 2) == F.slice(F.element_at(r, -1), 1, 2))

    def polygon(rings: Column) -> Column:
        return (F.size(rings) > 0) & F.forall(rings, ring)

    def at(depth: int) -> Column:
        return let(_typed(v, "$.coordinates", depth), (
            position, line,
            lambda c: F.when(kind == "Polygon", polygon(c)).otherwise((F.size(c) > 0) & F.forall(c, line)),
            lambda c: (F.size(c) > 0) & F.forall(c, polygon))[depth])

    return F.coalesce(_plain_by_depth(v, kind, at), F.lit(False))


def _typed(v: Column, path: str, depth: int) -> Column:
    return F.try_variant_get(v, path, "array<" * (depth + 1) + "double" + ">" * (depth + 1))


def _plain_by_depth(v: Column, kind: Column, branch) -> Column:
    """``branch(depth)`` for a plain geometry whose numbers are nested as its type says; null for all others."""
    return let(F.schema_of_variant(v), lambda schema: _by_depth(kind, lambda d: F.when(schema.rlike(_PLAIN[d]), branch(d))))


def _leaf_problem(v: Column) -> Column:
    """The problem of a geometry that holds no members."""
    def with_object(m: Column) -> Column:
        return (
            F.when(v.isNull() | F.is_variant_null(v), F.lit("geometry is null"))
            .when(m.isNull(), F.concat(F.lit("geometry must be an object, got "), json_type_name(v)))
            .otherwise(let(_kind_of_map(m), lambda kind: (
                F.when(kind.isNull() | ~kind.isin(GEOMETRY_TYPES),
                       F.concat(F.lit("unknown geometry type "), _kind_repr(m["type"]),
                                F.lit("; expected one of " + ", ".join(GEOMETRY_TYPES))))
                .when(kind == "GeometryCollection", F.lit("GeometryCollection needs a non-empty 'geometries' array"))
                .otherwise(_simple_problem(kind, m["coordinates"])))))
        )

    return F.when(~_sound(v), let(_object(v), with_object))


def geometry_problem(v: Column) -> Column:
    """G1: the first structural problem of a geometry, or null when sound; collections at any depth."""
    def in_leaf(x: Column) -> Column:
        return F.concat(F.repeat(F.lit("GeometryCollection member: "), x["depth"]), _leaf_problem(x["g"]))

    return let(v, lambda g: _first(F.transform(leaves(g), in_leaf)))


def no_problem(v: Column) -> Column:
    """Whether a geometry is sound. It names the geometry more than once: for a column of a frame, not for a filter."""
    return F.coalesce(_sound_pair(v), F.lit(False)) | geometry_problem(v).isNull()


def _number_at(v: Column, i: int) -> Column:
    """A coordinate of a plain point, or null where it has none there."""
    return F.try_variant_get(v, f"$.coordinates[{i}]", "double")


def _sound_pair(v: Column) -> Column:
    """Whether a geometry is a plain point of two numbers within their ranges."""
    return (_plain_point(v) & F.variant_get(v, "$.coordinates[2]", "variant").isNull()  # a null there is a value
            & _number_at(v, 0).between(-180.0, 180.0) & _number_at(v, 1).between(-90.0, 90.0))


def positions(v: Column) -> Column:
    """Every ``[lon, lat]`` of a geometry as ``array<array<double>>``, collections at any depth.

    Only numbers count as coordinates; unreadable ones yield no position, never
    an error.
    """
    return let(v, lambda g: F.flatten(F.transform(leaves(g), lambda x: let(geometry_kind(x["g"]), lambda kind: _positions_of(x["g"], kind)))))


def _by_depth(kind: Column, branch) -> Column:
    out = None
    for depth in range(4):
        hit = kind.isin([name for name, d in COORD_DEPTH.items() if d == depth])
        out = F.when(hit, branch(depth)) if out is None else out.when(hit, branch(depth))
    return out


def _positions_of(v: Column, kind: Column) -> Column:
    coords = _member(v, "coordinates")
    numeric = F.schema_of_variant(coords).rlike(_ALL_NUMERIC)

    def flat(depth: int) -> Column:
        return F.transform(_deep_flat(_typed(coords, "$", depth), depth), lambda p: F.slice(p, 1, 2))

    def picked(depth: int) -> Column:
        """Among values of several kinds, the positions whose first two members are numbers."""
        level = F.array(_array(coords)) if depth == 0 else F.transform(_array(coords), _array)
        for _ in range(depth - 1):
            level = F.transform(F.flatten(F.filter(level, lambda x: x.isNotNull())), _array)
        pairs = F.filter(level, lambda p: p.isNotNull() & (F.size(p) >= 2))
        pairs = F.filter(pairs, lambda p: is_number(p[0]) & is_number(p[1]))
        return F.transform(pairs, lambda p: F.transform(F.slice(p, 1, 2), lambda x: F.variant_get(x, "$", "double")))

    found = F.when(numeric, _by_depth(kind, flat)).otherwise(_by_depth(kind, picked))
    return F.filter(F.coalesce(found, F.array().cast("array<array<double>>")),
                    lambda p: (F.size(p) == 2) & p[0].isNotNull() & p[1].isNotNull())


def _plain_point(v: Column) -> Column:
    """Whether a geometry is a point of a type and numbers of one kind, and of nothing else."""
    return F.schema_of_variant(v).rlike(_PLAIN[0]) & (F.try_variant_get(v, "$.type", "string") == "Point")


def round_geometry(v: Column, precision: int) -> Column:
    """T4: round every coordinate (altitude included) to ``precision`` places, collections at any depth.

    Rounded numbers are stored as decimals, so ``-0.0`` becomes ``0`` and
    integral values print without a fraction. Values that are no numbers and
    members other than ``coordinates``/``geometries`` are kept as they are.
    """
    if not 0 <= precision <= 15:
        raise ValueError("precision must be between 0 and 15")

    # A collection is written as pieces of JSON text with simple members between them.
    def step(acc: Column) -> Column:
        def one(x: Column) -> Column:
            rest = F.to_json(F.to_variant_object(F.map_filter(_object(x["g"]), lambda k, _: k != "geometries")))
            head = F.struct(F.concat(x["lead"], F.lit('{"geometries":[')).alias("lead"), F.lit(None).cast("variant").alias("g")).cast(_PIECE)
            tail = F.struct(F.concat(F.lit("],"), F.substr(rest, F.lit(2))).alias("lead"), F.lit(None).cast("variant").alias("g")).cast(_PIECE)

            def body(ms: Column) -> Column:
                return F.transform(ms, lambda g, i: F.struct(F.when(i > 0, F.lit(",")).otherwise(F.lit("")).alias("lead"), g.alias("g")).cast(_PIECE))

            return let(_members(x["g"]), lambda ms: F.when(ms.isNotNull(), F.concat(F.array(head), body(ms), F.array(tail))).otherwise(F.array(x)))

        return F.flatten(F.transform(acc, one))

    def joined(rounded: Column) -> Column:
        text = F.array_join(F.transform(rounded, lambda x: F.concat(x["lead"], F.coalesce(F.to_json(x["g"]), F.lit("")))), "")
        # without a collection there is one piece: the geometry itself
        return F.when(_levels(v) > 0, F.try_parse_json(text)).otherwise(F.get(rounded, 0)["g"])

    def whole(v: Column) -> Column:
        pieces = _opened(v, F.array(F.struct(F.lit("").alias("lead"), v.alias("g")).cast(_PIECE)), step)
        return let(F.transform(pieces, lambda x: F.struct(x["lead"].alias("lead"), _round_simple(x["g"], precision).alias("g"))), joined)

    numbers = F.transform(_typed(v, "$.coordinates", 0), lambda x: _rounded(x, precision))
    point = F.to_variant_object(F.struct(numbers.alias("coordinates"), F.lit("Point").alias("type")))
    return F.when(_plain_point(v), point).otherwise(let(v, whole))


def _rounded(x: Column, precision: int) -> Column:
    return F.bround(x, precision).cast(f"decimal(38,{precision})")


def _round_simple(v: Column, precision: int) -> Column:
    coords = _member(v, "coordinates")
    numeric = F.schema_of_variant(coords).rlike(_ALL_NUMERIC)

    def num(x: Column) -> Column:
        return _rounded(x, precision)

    def typed(depth: int) -> Column:
        def walk(c: Column, d: int) -> Column:
            return F.transform(c, num if d == 0 else lambda e: walk(e, d - 1))

        return walk(_typed(coords, "$", depth), depth)

    def mixed(depth: int) -> Column:
        def walk(c: Column, d: int) -> Column:
            inner = (lambda x: F.when(is_number(x), num(F.variant_get(x, "$", "double")).cast("variant")).otherwise(x)) if d == 0 \
                else lambda e: walk(e, d - 1)
            return let(_array(c), lambda a: F.when(a.isNull(), c).otherwise(F.transform(a, inner).cast("variant")))

        return walk(coords, depth)

    def with_kind(kind: Column) -> Column:
        rounded = F.when(numeric, _by_depth(kind, lambda d: typed(d).cast("variant"))).otherwise(_by_depth(kind, mixed))
        as_map = _object(v)
        return F.when(as_map.isNull() | coords.isNull(), v).otherwise(F.to_variant_object(F.transform_values(
            as_map, lambda k, x: F.when(k == "coordinates", F.coalesce(rounded, x)).otherwise(x))))

    def plain(kind: Column) -> Column:
        return _plain_by_depth(v, kind, lambda d: F.to_variant_object(F.struct(typed(d).alias("coordinates"), kind.alias("type"))))

    return let(geometry_kind(v), lambda kind: F.coalesce(plain(kind), with_kind(kind)))


def _deep_flat(typed: Column, depth: int) -> Column:
    """Nested numeric arrays flattened to ``array<array<double>>``."""
    if depth == 0:
        return F.array(typed)
    out = typed
    for _ in range(depth - 1):
        out = F.flatten(out)
    return out


def point(lon: Column, lat: Column) -> Column:
    """A Point geometry VARIANT from two numeric columns."""
    return F.to_variant_object(F.struct(
        F.array(number_variant(lon), number_variant(lat)).alias("coordinates"),
        F.lit("Point").alias("type"),
    ))


def bbox(v: Column, text: Column | None = None) -> Column:
    """``struct<west, south, east, north>`` of a geometry, its members null when it has no positions.

    ``text`` is the feature's JSON text, where the caller has it: it tells a plain point at less cost than the value.
    """
    def ends(pos: Column) -> Column:
        lons, lats = F.transform(pos, lambda p: p[0]), F.transform(pos, lambda p: p[1])
        return F.struct(F.array_min(lons).alias("west"), F.array_min(lats).alias("south"),
                        F.array_max(lons).alias("east"), F.array_max(lats).alias("north"))

    lon, lat = _number_at(v, 0), _number_at(v, 1)
    box = F.struct(lon.alias("west"), lat.alias("south"), lon.alias("east"), lat.alias("north"))
    plain = _plain_point(v) if text is None else text.rlike(POINT_TEXT)
    return F.when(plain & lon.isNotNull() & lat.isNotNull(), box).otherwise(let(positions(v), ends))


def bbox_parts(v: Column) -> tuple[Column, Column, Column, Column]:
    """Per-row min lon, min lat, max lon, max lat (null when no positions)."""
    box = bbox(v)  # one value, so that the four share it
    return box["west"], box["south"], box["east"], box["north"]

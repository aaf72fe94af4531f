"""DataFrame -> DataFrame operators over feature frames.

A feature frame has a VARIANT ``geometry`` column, one column per property
(or a VARIANT ``_props`` for schemaless sources), and the reserved columns
below. Reserved names are whole names: a property such as ``_score`` is a
property like any other. A source whose records use a reserved name themselves
keeps its properties in ``_props``, where no name can collide.
"""

# _id: top-level feature id; _ord: input order; _doc: input document; _source:
# source name; _hash: feature hash; _key: diff key; _problem: why a row is unusable;
# _dropped: the step of a run that removed a row.
RESERVED = frozenset({"geometry", "_id", "_ord", "_doc", "_source", "_hash", "_key", "_problem", "_props", "_names",
                      "_json", "_too_many", "_dropped"})


def named(name: str):
    """The column of exactly this name, dots and backticks included."""
    from pyspark.sql import functions as F

    return F.col("`" + name.replace("`", "``") + "`")


def is_property(name: str) -> bool:
    return name not in RESERVED


def property_fields(df):
    """Property columns of a typed feature frame, in column order."""
    return [f for f in df.schema.fields if is_property(f.name)]

"""SQL sources (S9): one statement, one row per record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_sql(spark: SparkSession, statement: str) -> DataFrame:
    """Run one query on registered views (or a JDBC view); decimals and times become JSON-safe."""
    if ";" in statement.strip().rstrip(";"):
        raise ValueError("a SQL source takes exactly one statement")
    return json_safe(spark.sql(statement))


def json_safe(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text: the kinds that JSON has."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A database query as a source, through Spark's JDBC reader.

    One task reads it unless ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` are given.
    """
    source = f"({query.strip().rstrip(';')}) AS source"
    return json_safe(spark.read.format("jdbc").option("url", url).option("dbtable", source).options(**options).load())

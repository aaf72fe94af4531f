"""Landed HTTP responses.

Fetching is not Spark's job; a fetcher lands each response as a row
``(source, url, status, fetched_at, etag, last_modified, content_type,
attempts, bytes_read)``. These operators pick the payload to use and report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: HTTP statuses worth retrying (transient).
RETRYABLE_STATUS = [408, 425, 429, 500, 502, 503, 504, 507, 509]


def status_class(status: Column) -> Column:
    """``ok`` (< 400), ``transient`` (retryable) or ``permanent``."""
    return (F.when(status < 400, F.lit("ok"))
            .when(status.isin(RETRYABLE_STATUS), F.lit("transient"))
            .otherwise(F.lit("permanent")))


def latest_success(landing: DataFrame, by: str = "source") -> DataFrame:
    """Newest successful response per source (an aggregate, so no per-source sort)."""
    ok = landing.where(F.col("status") < 400)
    cols = [c for c in landing.columns if c != by]
    # responses of one time are told apart by their other columns, not by arrival
    plain = [f.name for f in landing.schema if f.name in cols and f.dataType.typeName() not in ("map", "variant") and f.name != "fetched_at"]
    latest = F.max_by(F.struct(*cols), F.struct("fetched_at", *plain))
    return ok.groupBy(by).agg(latest.alias("r")).select(by, "r.*")


def redact_origin(url: Column) -> Column:
    """Drop credentials (everything up to the last ``@``) from a URL."""
    return F.regexp_replace(url, r"^(.*?)://.*@", "$1://***@")


def fetch_stats(landing: DataFrame, by: str = "source") -> DataFrame:
    """Responses, bytes, attempts and outcome counts per source."""
    cls = status_class(F.col("status"))
    return landing.groupBy(by).agg(
        F.count(F.lit(1)).alias("responses"),
        F.sum("bytes_read").cast("long").alias("bytes_read"),
        F.max("attempts").alias("max_attempts"),
        F.count_if(cls == "ok").alias("ok"),
        F.count_if(cls == "transient").alias("transient"),
        F.count_if(cls == "permanent").alias("permanent"),
    )

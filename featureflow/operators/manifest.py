"""Run bookkeeping over the runs/manifest table.

The manifest is a table with one row per ``(run_ts, source)``. Windows are
partitioned by source and ordered by run time; a source has one row per run,
so a window partition grows with the number of runs, never with data size.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.functions.freshness import age_seconds, humanize_age, is_stale

# Run exit codes.
EXIT_OK, EXIT_NO_CHANGE, EXIT_FETCH_FAILURE, EXIT_VALIDATION_FAILURE, EXIT_WRITE_FAILURE = 0, 3, 4, 5, 6


def carry_forward(runs: DataFrame, cols: Sequence[str] = ("fetched_at", "content_hash", "feature_count")) -> DataFrame:
    """last successful value of each column up to every run (failed runs inherit it)."""
    w = Window.partitionBy("source").orderBy("run_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = runs
    for c in cols:
        out = out.withColumn(f"last_{c}", F.last(F.col(c), ignorenulls=True).over(w))
    return out


def source_status(runs: DataFrame) -> DataFrame:
    """``failed`` / ``ok`` (hash moved or first) / ``unchanged`` per run, with the previous good hash."""
    carried = carry_forward(runs)
    prev = F.lag("last_content_hash").over(Window.partitionBy("source").orderBy("run_ts"))
    out = carried.withColumn("previous_content_hash", prev)
    changed = F.col("ok") & ~F.coalesce(F.col("content_hash") == F.col("previous_content_hash"), F.lit(False))
    status = (F.when(~F.col("ok"), F.lit("failed")).when(changed, F.lit("ok")).otherwise(F.lit("unchanged")))
    return out.withColumn("changed", changed).withColumn("status", status)


def run_outcome(status: DataFrame, by: Sequence[str] = ("run_ts",), force: bool = False) -> DataFrame:
    """F8: exit code per run: the worst error code of a failed source, else 0 when something changed, else 3.

    A failure without an ``error_code`` counts as a validation failure. ``force``
    makes an unchanged run a success.
    """
    code = F.col("error_code") if "error_code" in status.columns else F.lit(None).cast("int")
    worst = F.max(F.when(F.col("status") == "failed", F.coalesce(code, F.lit(EXIT_VALIDATION_FAILURE))))
    quiet = F.lit(EXIT_OK if force else EXIT_NO_CHANGE)
    return status.groupBy(*by).agg(F.coalesce(
        worst, F.when(F.bool_or("changed"), F.lit(EXIT_OK)).otherwise(quiet)).alias("exit_code"))


def with_freshness(status: DataFrame) -> DataFrame:
    """F3/F5 on carried-forward fetch times: ``age_seconds`` (int) and ``stale``."""
    fetched = F.col("last_fetched_at")
    return (status.withColumn("age_seconds", F.when(fetched.isNotNull(),
                                                    F.floor(age_seconds(fetched, F.col("now"))).cast("long")))
            .withColumn("stale", is_stale(fetched, F.col("max_age"), F.col("now"))))


def manifest_totals(manifest: DataFrame, by: Sequence[str] = ("run_ts",)) -> DataFrame:
    """per run: sources, features, changed/stale/failed counts and the any-flags."""
    return manifest.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sources"),
        F.coalesce(F.sum("last_feature_count"), F.lit(0)).cast("long").alias("features"),
        F.count_if("changed").alias("changed_sources"),
        F.count_if("stale").alias("stale_sources"),
        F.count_if(F.col("status") == "failed").alias("failed_sources"),
        F.bool_or("changed").alias("changed"),
        F.bool_or("stale").alias("stale"),
    )


def freshness_state(manifest: DataFrame, by: Sequence[str] = ("run_ts",), source: str | None = None) -> DataFrame:
    """badge state per run: failed > stale > fresh; the oldest source (never fetched first) drives the label.

    ``source`` narrows it to one source. Over nothing at all (``by`` empty) the
    state is ``unknown``. Titles name the failed, else the stale sources.
    """
    manifest = manifest if source is None else manifest.where(F.col("source") == source)
    never = F.col("age_seconds").isNull()
    error = F.col("error") if "error" in manifest.columns else F.lit(None).cast("string")

    def named(cond: Column, text: Column) -> Column:
        """The lines of the sources that meet a condition, by name; one row per source and run."""
        lines = F.array_sort(F.collect_list(F.when(cond, F.struct("source", text.alias("line")))))
        return F.array_join(F.transform(lines, lambda x: x["line"]), "\n")

    agg = manifest.groupBy(*by).agg(
        F.bool_or(F.col("status") == "failed").alias("any_failed"),
        F.bool_or("stale").alias("any_stale"),
        F.bool_or(never).alias("any_never"),
        F.max("age_seconds").alias("oldest"),
        F.count(F.lit(1)).alias("n_sources"),
        F.coalesce(F.sum("last_feature_count"), F.lit(0)).cast("long").alias("features"),
        named(F.col("status") == "failed", F.concat(F.col("source"), F.lit(": "), F.coalesce(error, F.lit("failed")))).alias("failed"),
        named(F.col("stale"), F.concat(F.col("source"), F.lit(" is older than its "),
                                       F.replace(humanize_age(F.col("max_age")), F.lit(" ago"), F.lit("")), F.lit(" limit"))).alias("old"),
    )
    age = F.when(F.col("any_never"), F.lit(None)).otherwise(F.col("oldest"))
    text = F.coalesce(humanize_age(age), F.lit("unknown"))
    none = F.col("n_sources") == 0
    state = (F.when(none, F.lit("unknown")).when(F.col("any_failed"), F.lit("failed"))
             .when(F.col("any_stale"), F.lit("stale")).otherwise(F.lit("fresh")))
    label = (F.when(none, F.lit("No data")).when(F.col("any_failed"), F.concat(F.lit("Refresh failed — showing data from "), text))
             .when(F.col("any_stale"), F.concat(F.lit("Data may be out of date — updated "), text))
             .otherwise(F.concat(F.lit("Updated "), text)))
    title = (F.when(state == "fresh", F.concat(F.col("features").cast("string"), F.lit(" features across "),
                                               F.col("n_sources").cast("string"), F.lit(" source(s)")))
             .when(state == "failed", F.col("failed")).when(state == "stale", F.col("old"))
             .otherwise(F.lit("The manifest lists no matching sources.")))
    return agg.select(*by, state.alias("state"), label.alias("label"), title.alias("title"), age.alias("age_seconds"))


def status_report(manifest: DataFrame) -> DataFrame:
    """the status table: age text, features and flags per source."""
    age_text = F.when(F.col("age_seconds").isNull(), F.lit("never fetched")).otherwise(humanize_age(F.col("age_seconds")))
    flag = (F.when(F.col("status") == "failed", F.lit("FAILED")).when(F.col("changed"), F.lit("changed"))
            .otherwise(F.col("status")))
    flags = F.concat_ws(" ", F.when(F.col("stale"), F.lit("STALE")), flag)
    more = []
    if {"added", "removed", "modified"} <= set(manifest.columns):
        some = (F.col("added") > 0) | (F.col("removed") > 0) | (F.col("modified") > 0)
        more.append(F.when(some, F.concat(F.lit("+"), F.col("added").cast("string"), F.lit(" / -"), F.col("removed").cast("string"),
                                          F.lit(" / ~"), F.col("modified").cast("string"))).alias("diff"))
    if "error" in manifest.columns:
        more.append(F.col("error"))
    return manifest.select("run_ts", "source", age_text.alias("age"),
                           F.coalesce(F.col("last_feature_count"), F.lit(0)).cast("long").alias("features"),
                           flags.alias("flags"), *more)


def min_features_gate(counts: DataFrame, spec: DataFrame) -> DataFrame:
    """V1: every source's surviving feature count against ``min_features``; a source without rows counts 0."""
    j = spec.join(counts, "source", "left")
    minimum = F.coalesce(F.col("min_features"), F.lit(0))
    count = F.coalesce(F.col("feature_count"), F.lit(0)).cast("long")
    return j.select("source", count.alias("feature_count"), minimum.alias("min_features"), (count >= minimum).alias("passed"))


def publish_gate(status: DataFrame, by: Sequence[str] = ("run_ts",)) -> DataFrame:
    """V2: a run publishes nothing when any source failed."""
    return status.groupBy(*by).agg(F.bool_or(F.col("status") == "failed").alias("blocked"),
                                   F.count_if(F.col("status") == "failed").alias("failed_sources"))


def nonfinite_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V3: NaN/Infinity count per numeric column (any > 0 fails the source)."""
    def bad(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.count_if(F.isnan(x) | (F.abs(x) == F.lit(float("inf")))).alias(c)

    wide = df.agg(*[bad(c) for c in cols])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nonfinite"))
                                          for c in cols])))

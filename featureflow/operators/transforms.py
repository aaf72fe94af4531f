"""Transform steps T1-T7: filter, select, rename, round, drop_invalid.

Steps are plain ``DataFrame -> DataFrame`` functions chained with
``DataFrame.transform``; Catalyst fuses the chain into one stage. Per-step
row counts come from a single aggregation (``step_counts``), not from one
job per step.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from inspect import signature
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.functions import geo
from featureflow.operators import is_property, property_fields


def _expr(cond, df: DataFrame | None = None) -> Column:
    """A condition given as SQL text, a Column, or a function of nothing or of the frame."""
    if isinstance(cond, str):
        return F.expr(cond)
    if isinstance(cond, Column) or not callable(cond):
        return cond
    return cond(df) if signature(cond).parameters else cond()


@dataclass(frozen=True)
class Step:
    """One configured step. ``op`` is filter/select/rename/round/drop_invalid."""

    op: str
    arg: object = None
    detail: str = ""

    def apply(self, df: DataFrame) -> DataFrame:
        return STEP_FUNCTIONS[self.op](df, self.arg)

    def keeps(self, df: DataFrame | None = None) -> Column | None:
        """Row-survival condition of this step, or None when it keeps every row."""
        if self.op == "filter":
            return F.coalesce(_expr(self.arg, df), F.lit(False))
        if self.op == "drop_invalid" and self.arg:
            return geo.built(geo.no_problem)
        return None


def t_filter(df: DataFrame, cond) -> DataFrame:
    """Keep rows where the condition is true (null counts as false)."""
    return df.where(_expr(cond, df))


def _props(df: DataFrame) -> Column:
    """The properties of a schemaless frame as a map."""
    return F.try_variant_get(F.col("_props"), "$", "map<string,variant>")


def t_select(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep only the listed properties, in list order; absent names are skipped."""
    if "_props" in df.columns:
        kept = F.map_filter(_props(df), lambda k, _: k.isin(list(names)))
        return df.withColumn("_props", F.when(F.col("_props").isNotNull(), F.to_variant_object(kept)))
    keep_props = [n for n in dict.fromkeys(names) if n in df.columns and is_property(n)]
    others = [c for c in df.columns if not is_property(c)]
    return df.select(*others, *[F.col(f"`{c}`") for c in keep_props])


def t_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename properties; when two land on one name, the later column wins."""
    if "_props" in df.columns:
        def renamed(m: Column) -> Column:
            name = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair]) if mapping else None
            entries = F.transform(F.map_entries(m), lambda e: F.struct(
                (F.coalesce(F.try_element_at(name, e["key"]), e["key"]) if mapping else e["key"]).alias("key"), e["value"].alias("value")))

            def last(es: Column) -> Column:
                return F.filter(es, lambda e, i: ~F.exists(F.slice(es, i + 2, F.size(es)), lambda x: x["key"] == e["key"]))

            return F.map_from_entries(geo.let(entries, last))

        return df.withColumn("_props", F.when(F.col("_props").isNotNull(), F.to_variant_object(renamed(_props(df)))))
    target: dict[str, str] = {}
    for f in property_fields(df):
        target[mapping.get(f.name, f.name)] = f.name  # later source column overwrites
    cols = []
    for c in df.columns:
        if not is_property(c):
            cols.append(F.col(c))
    for new_name, src in target.items():
        cols.append(F.col(f"`{src}`").alias(new_name))
    return df.select(*cols)


def t_round(df: DataFrame, precision: int) -> DataFrame:
    """T4: round every coordinate to ``precision`` decimal places."""
    return df.withColumn("geometry", geo.built(geo.round_geometry, int(precision)))


def t_drop_invalid(df: DataFrame, enabled: bool = True) -> DataFrame:
    """T5: drop rows whose geometry has a structural problem."""
    if not enabled:
        return df
    return df.where(geo.built(geo.geometry_problem).isNull())


STEP_FUNCTIONS: dict[str, Callable[[DataFrame, object], DataFrame]] = {
    "filter": t_filter,
    "select": t_select,
    "rename": t_rename,
    "round": t_round,
    "drop_invalid": t_drop_invalid,
}


def apply_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Run the steps in order; the input frame is never changed."""
    return reduce(lambda acc, step: acc.transform(step.apply), steps, df)


def mark_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """T6/T7 in the run's own pass: the steps in order, but a removed row stays, with its step's number in ``_dropped``.

    A removed row loses its geometry, and later conditions are not evaluated on
    it, so what an earlier step removed cannot make a later one raise. A row that
    its reader could not use is passed by in the same way, under the number 0.
    """
    gone, out = F.col("_dropped"), df.withColumn("_dropped", F.lit(None).cast("int"))
    if "_problem" in df.columns:
        out = df.withColumn("_dropped", F.when(F.col("_problem").isNotNull(), F.lit(0)))
        out = out.withColumn("geometry", F.when(gone.isNull(), F.col("geometry")))
    for i, step in enumerate(steps, start=1):
        keep = step.keeps(out)
        if keep is None:
            out = step.apply(out)
            continue
        out = out.withColumn("_dropped", F.when(gone.isNotNull(), gone).when(~keep, F.lit(i)))
        out = out.withColumn("geometry", F.when(gone.isNull(), F.col("geometry")))
    return out


def step_report(steps: Sequence[Step], features_out: int, dropped: Sequence[int]) -> list[tuple]:
    """(step_no, step, detail, features_in, features_out, removed) per step, from the rows left and those each step removed."""
    left, rows = features_out + sum(dropped[:len(steps)]), []
    for i, (step, removed) in enumerate(zip(steps, dropped), start=1):
        rows.append((i, step.op, step.detail, left, left - removed, removed))
        left -= removed
    return rows


# Marks travel as columns that no step touches.
_ALIVE = "_ord::alive"


def _around_marks(df: DataFrame, step: Step) -> DataFrame:
    """Apply a step that keeps every row, with the marks set aside in the order column."""
    marks = [c for c in df.columns if c.startswith(_ALIVE)]
    had = "_ord" in df.columns
    held = F.struct(*([F.col("_ord")] if had else []), *[F.col(f"`{m}`").alias(m) for m in marks])
    out = step.apply(df.select(*[c for c in df.columns if c not in marks and c != "_ord"], held.alias("_ord")))
    rest = [c for c in out.columns if c != "_ord"]
    return out.select(*rest, *([F.col("_ord._ord").alias("_ord")] if had else []), *[F.col("_ord")[m].alias(m) for m in marks])


def step_counts(df: DataFrame, steps: Sequence[Step], by: Sequence[str] = ()) -> DataFrame:
    """Rows in / out / removed per step in one aggregation pass.

    Returns ``(*by, step_no, step, detail, features_in, features_out, removed)``.
    Every row carries a mark for each step that it outlives, and the other steps
    are applied as they come, so a condition sees the names and values that the
    steps before it left. Nothing is materialised.
    """
    marked, alive = df.withColumn(_ALIVE + "0", F.lit(True)), _ALIVE + "0"
    for i, step in enumerate(steps, start=1):
        mark, keep = f"{_ALIVE}{i}", step.keeps(marked)
        if keep is None:
            marked = marked.withColumn(mark, F.col(alive))
            marked = _around_marks(marked, step)
        else:
            marked = marked.withColumn(mark, F.col(alive) & keep)
        alive = mark
    aggs = [F.count(F.lit(1)).alias("n0")] + [F.count_if(F.col(f"{_ALIVE}{i}")).alias(f"n{i}") for i in range(1, len(steps) + 1)]
    counts = marked.groupBy(*by).agg(*aggs)
    rows = [
        F.struct(F.lit(i).alias("step_no"), F.lit(s.op).alias("step"), F.lit(s.detail).alias("detail"),
                 F.col(f"n{i - 1}").alias("features_in"), F.col(f"n{i}").alias("features_out"))
        for i, s in enumerate(steps, start=1)
    ]
    out = counts.select(*by, F.inline(F.array(*rows)))
    return out.withColumn("removed", F.greatest(F.lit(0).cast("long"), F.col("features_in") - F.col("features_out")))


def drop_reasons(df: DataFrame, by: Sequence[str] = (), limit: int = 3) -> DataFrame:
    """T5 report: number of rejects and the first ``limit`` reasons by input order.

    ``df`` is the frame entering the drop step (with ``_ord``). The reason text
    is ``feature {index}: {problem}`` where index is the row's 0-based position
    in that frame. The first rejects are a top-k per group (bounded by
    ``limit``); their positions come from one conditional count over the frame,
    joined to a one-row-per-group side.
    """
    from pyspark.sql import Window

    keys = list(by)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    checked = df.select(*keys, "_ord", geo.built(geo.geometry_problem).alias("problem"))
    # one exchange of the rejects serves the count and the first few: the check runs once per row
    bad = checked.where(F.col("problem").isNotNull()).repartition(n, "_ord")
    rk = F.row_number().over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_ord"))
    first = (bad.withColumn("rk", rk).where(F.col("rk") <= limit)
             .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rk", "_ord", "problem"))).alias("fs")))
    rejected = bad.groupBy(*keys).agg(F.count(F.struct("_ord", "problem")).alias("rejected"))
    one_row = rejected.join(first, keys) if keys else rejected.join(F.broadcast(first.where(F.col("fs").isNotNull())), how="left")
    at = [F.try_element_at(F.col("fs"), F.lit(k)) for k in range(1, limit + 1)]
    # positions: how many rows come before; without keys the other side is one row
    orders = df.select(*keys, "_ord")
    joined = orders.join(one_row, keys) if keys else orders.join(F.broadcast(one_row))
    counted = joined.groupBy(*keys).agg(
        F.first("rejected").alias("rejected"), F.first("fs").alias("fs"),
        *[F.count_if(F.col("_ord") < x["_ord"]).alias(f"i{k}") for k, x in enumerate(at, 1)])
    parts = [F.when(x.isNotNull(), F.concat(F.lit("feature "), F.col(f"i{k}").cast("string"), F.lit(": "), x["problem"]))
             for k, x in enumerate(at, 1)]
    more = F.col("rejected") - F.lit(limit)
    detail = F.concat(F.concat_ws("; ", *parts),
                      F.when(more > 0, F.concat(F.lit(" (+"), more.cast("string"), F.lit(" more)"))).otherwise(F.lit("")))
    return counted.select(*by, F.coalesce("rejected", F.lit(0)).alias("rejected"), F.when(F.col("rejected") > 0, detail).alias("detail"))

"""The refresh run (R1, R2, O4-O6): sources -> steps -> digest -> diff -> gates -> publish -> state.

Every source is reduced to one hashed table ``(_source, _key, _hash, _doc,
_ord, _json, box, _problem, _dropped)``, written once. Rows that cannot be used keep their problem
and pass by the steps, so no step can hide them; they fail their source and no
other. Rows that a step removes are written as the step's number and nothing else that
is large, so the step report is counted with the features, without a job of its
own, and no retried task counts twice. The run needs four aggregations over the frame (digest, bbox/count, key
index, hash multiset) and one full outer join against the previous state, each
source in the mode that its keys allow. Only per-source rows (a handful) reach
the driver, to choose that mode and to decide what to write.

A run writes features, then its state, then its manifest under ``run_id``. The
manifest is the commit point: ``load_state`` reads the state of the last run
that has one, and a replayed run overwrites its own folders.

``run_committed`` is the form for large state: it reads and writes the state of
``plans.state`` (a bucketed base, deltas, Merkle digests, a commit log), so a
run costs what changed, and runs on one folder do not overwrite each other.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions import geo
from featureflow.functions.canonical import nonfinite
from featureflow.functions.freshness import is_stale
from featureflow.operators import diff as D
from featureflow.operators import named, property_fields
from featureflow.operators.digest import collection_digest, empty_digest_hash, feature_json
from featureflow.operators.publish import write_features
from featureflow.operators.transforms import Step, mark_steps, step_report
from featureflow.plans import state as S
from featureflow.session import spread, written

STATE_INDEX_SCHEMA = "source STRING, key STRING, hash STRING, n BIGINT"
# published_hash: the content last written out; it lags content_hash while publishing is blocked.
STATE_META_SCHEMA = ("source STRING, content_hash STRING, fetched_at TIMESTAMP, feature_count BIGINT, "
                     "published_hash STRING")


STEPS_SCHEMA = ("ARRAY<STRUCT<step_no: INT, step: STRING, detail: STRING, features_in: BIGINT, features_out: BIGINT, "
                "removed: BIGINT>>")


@dataclass(frozen=True)
class SourceSpec:
    """One configured source: how to load it as features, and what to do with it.

    ``features``, if given, makes the features from the rows that ``load`` reads:
    it is applied to rows dealt out over the cores, ``load`` only to the splits of the files.
    """

    name: str
    load: Callable[[SparkSession], DataFrame]
    steps: Sequence[Step] = ()
    id_property: str | None = None
    min_features: int | None = None
    max_age: float | None = None
    features: Callable[[DataFrame], DataFrame] = lambda rows: rows


@dataclass
class RunResult:
    manifest: DataFrame
    next_index: DataFrame
    next_meta: DataFrame
    features: DataFrame
    outputs: list[str] = field(default_factory=list)
    exit_code: int = 0
    committed: S.State | None = None  # of a run on a committed state

    def step_report(self) -> DataFrame:
        """(source, step_no, step, detail, features_in, features_out, removed) of every source that ran."""
        return self.manifest.select("source", F.inline("steps"))


def empty_state(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame([], STATE_INDEX_SCHEMA), spark.createDataFrame([], STATE_META_SCHEMA)


def load_state(spark: SparkSession, out_dir: str, replay_of: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The state of the last committed run in ``out_dir``; an empty one when there is none or it cannot be read.

    A run that may be a replay names itself in ``replay_of``: it starts from the
    state before its own, which it is about to overwrite.
    """
    try:
        runs = spark.read.parquet(f"{out_dir}/manifest").withColumn("run", F.col("run_id").cast("string"))
        if replay_of is not None:
            runs = runs.where(F.col("run") != replay_of)
        last = runs.agg(F.max(F.struct("run_at", F.length("run").alias("n"), "run"))).first()[0]
        if last is None:
            return empty_state(spark)
        base = f"{out_dir}/state/run_id={last['run']}"
        index = spark.read.schema(STATE_INDEX_SCHEMA).parquet(f"{base}/index")
        meta = spark.read.schema(STATE_META_SCHEMA).parquet(f"{base}/meta")
        meta.collect()
        index.limit(1).collect()
        index.count()  # reads every footer
        return index, meta
    except AnalysisException:  # no folder, or no table in it: a first run
        return empty_state(spark)
    except Exception as e:  # noqa: BLE001  damaged files have no exception of their own
        if not S.damaged(e):
            raise
        return empty_state(spark)


def hashed_features(spark: SparkSession, specs: Sequence[SourceSpec]) -> DataFrame:
    """All selected sources as one frame of hashed, keyed features.

    Each source is read once and dealt out before the work on it, which per byte
    of a source is far more than the read.
    """
    out = None
    for spec in specs:
        raw = spec.features(spread(spec.load(spark)))
        problem = F.col("_problem") if "_problem" in raw.columns else F.lit(None).cast("string")
        read = problem.isNull()
        df = mark_steps(raw, spec.steps)
        kept = F.col("_dropped").isNull()
        # a non-finite number stands in the text as one of these; a text that holds neither needs no look at its values
        suspect = F.col("_json").contains('NaN"') | F.col("_json").contains('Infinity"')
        bad_numbers = kept & suspect & _nonfinite(df)
        df = df.withColumn("_json", F.when(kept, feature_json(df)))  # built once: the hash is over this text
        keyed = D.with_key(df.withColumn("_hash", F.sha2("_json", 256)), spec.id_property)
        doc = F.col("_doc").cast("string") if "_doc" in df.columns else F.lit(None).cast("string")
        part = keyed.select(
            F.lit(spec.name).alias("_source"), F.when(kept, F.col("_key")).alias("_key"), "_hash",
            F.when(read, doc).alias("_doc"), F.when(read, F.col("_ord")).alias("_ord"), "geometry", "_json",
            F.coalesce(problem, F.when(bad_numbers, F.lit("non-finite number: NaN and Infinity have no JSON form"))).alias("_problem"),
            F.when(read, F.col("_dropped")).alias("_dropped"))
        out = part if out is None else out.unionByName(part)
    return out


def staged(hashed: DataFrame) -> DataFrame:
    """The run's features, written once to the shared folder: text, hash, key, place and box of each.

    All that follows reads narrow columns of this table. It outlives a lost
    executor, nothing is computed twice, and the plans behind it stay small.
    """
    out = written(hashed.withColumn("_box", geo.bbox(F.col("geometry"), F.col("_json"))).drop("geometry"), "run")
    return out.withColumns({f"_{side}": F.col("_box")[side] for side in ("west", "south", "east", "north")}).drop("_box")


def _nonfinite(df: DataFrame) -> Column:
    out = nonfinite(F.col("geometry"), df.schema["geometry"].dataType)
    if "_props" in df.columns:
        return out | nonfinite(F.col("_props"), df.schema["_props"].dataType)
    for f in property_fields(df):
        out = out | nonfinite(named(f.name), f.dataType)
    return out


def refresh(spark: SparkSession, specs: Sequence[SourceSpec], state_index: DataFrame, state_meta: DataFrame,
            now: str, only: Sequence[str] = (), force: bool = False, dry_run: bool = False,
            out_dir: str | None = None, run_id: str = "0", state: S.State | None = None) -> RunResult:
    """One refresh run. Writes only when something changed (or ``force``) and nothing failed.

    With a committed ``state`` the frames of the old one are not looked at, and
    the run's changes are committed after it.
    """
    if state is not None:
        state_index, state_meta = None, state.meta()
    known = [s.name for s in specs]
    unknown = [n for n in only if n not in known]
    if unknown:
        raise ValueError(f"unknown source {unknown[0]!r}; this config defines: {', '.join(known)}")
    selected = [s for s in specs if not only or s.name in only]
    spec_rows = [(s.name, s.name in [x.name for x in selected], s.id_property, s.min_features, s.max_age) for s in specs]
    spec_df = spark.createDataFrame(spec_rows, "source STRING, selected BOOLEAN, id_property STRING, "
                                               "min_features BIGINT, max_age DOUBLE")
    now_col = F.lit(now).cast("timestamp")

    everything = staged(hashed_features(spark, selected))
    sound = F.col("_problem").isNull() & F.col("_dropped").isNull()
    feats = everything.where(sound).drop("_problem", "_dropped")
    by = ["_source"]
    digest = collection_digest(feats, by)
    numbers = range(1, max((len(x.steps) for x in selected), default=0) + 1)
    per_source = everything.groupBy(*by).agg(
        F.count_if(sound).alias("feature_count"), F.count_if(sound & F.col("_key").isNotNull()).alias("with_key"),
        F.count("_problem").alias("problems"), F.min("_problem").alias("problem"), F.min("_west").alias("min_lon"),
        F.min("_south").alias("min_lat"), F.max("_east").alias("max_lon"), F.max("_north").alias("max_lat"),
        *[F.count_if(F.col("_dropped") == i).alias(f"dropped_{i}") for i in numbers])
    of_sources = per_source.collect()  # one row per source
    per_source = spark.createDataFrame(of_sources, per_source.schema)
    modes = {r["_source"]: r["with_key"] == r["feature_count"] for r in of_sources if r["feature_count"] > 0}
    counted = {r["_source"]: r for r in of_sources}
    reports = spark.createDataFrame([
        (x.name, step_report(x.steps, counted[x.name]["feature_count"] if x.name in counted else 0,
                             [counted[x.name][f"dropped_{i}"] if x.name in counted else 0 for i in numbers]))
        for x in selected], f"_source STRING, steps {STEPS_SCHEMA}")
    by_key = [n for n, keyed in modes.items() if keyed]

    prev_meta = state_meta.select(F.col("source").alias("_source"), F.col("content_hash").alias("previous_content_hash"),
                                  F.col("fetched_at").alias("prev_fetched_at"),
                                  F.col("feature_count").alias("prev_feature_count"),
                                  F.col("published_hash").alias("prev_published_hash"))
    change = None
    if state is not None:
        # a source that lost all its rows keeps its mode
        change = S.compare(state, feats, {x.name: modes.get(x.name, state.entry["keyed"].get(x.name, False)) for x in selected})
        counts = change.counts
    else:
        counts = _counts(feats, state_index, by_key)

    m = (spec_df.withColumnRenamed("source", "_source")
         .join(per_source, by, "left").join(digest.drop("feature_count"), by, "left")
         .join(prev_meta, by, "left").join(counts, by, "left").join(reports, by, "left"))
    # a selected source without rows is an empty collection, with its own digest
    m = m.withColumn("feature_count", F.when(F.col("selected"), F.coalesce("feature_count", F.lit(0))))
    m = m.withColumn("content_hash", F.when(F.col("selected"), F.coalesce("content_hash", F.lit(empty_digest_hash()))))
    keyed = (F.col("feature_count") > 0) & (F.col("with_key") == F.col("feature_count"))
    first_run = F.col("previous_content_hash").isNull()
    min_ok = F.coalesce(F.col("feature_count"), F.lit(0)) >= F.coalesce(F.col("min_features"), F.lit(0))
    failed = F.col("selected") & ((F.coalesce(F.col("problems"), F.lit(0)) > 0) | ~min_ok)
    error = (F.when(F.coalesce(F.col("problems"), F.lit(0)) > 0,
                    F.concat(F.col("problems").cast("string"), F.lit(" record(s) could not be read: "), F.col("problem")))
             .when(~min_ok, F.concat(F.lit("only "), F.coalesce(F.col("feature_count"), F.lit(0)).cast("string"),
                                     F.lit(" feature(s) survived the pipeline but min_features is "),
                                     F.col("min_features").cast("string"))))
    changed = F.col("selected") & ~failed & ~F.coalesce(F.col("content_hash") == F.col("previous_content_hash"),
                                                        F.lit(False))
    status = (F.when(~F.col("selected"), F.lit("skipped")).when(failed, F.lit("failed"))
              .when(changed, F.lit("ok")).otherwise(F.lit("unchanged")))
    fresh = F.col("selected") & ~failed

    def pick(o: str):
        total = F.coalesce(F.col("feature_count"), F.lit(0)).cast("long")
        if o == "added":
            first = total
        else:
            first = F.lit(0).cast("long")
        return (F.when(~fresh, F.lit(None).cast("long")).when(first_run, first)
                .otherwise(F.coalesce(F.col(o), F.lit(0)).cast("long")))

    fetched_at = F.when(fresh, now_col).otherwise(F.col("prev_fetched_at"))
    manifest = m.select(
        F.col("_source").alias("source"), status.alias("status"),
        F.when(fresh, F.col("feature_count")).otherwise(F.coalesce(F.col("prev_feature_count"), F.lit(0)))
        .cast("long").alias("feature_count"),
        F.when(fresh, F.col("content_hash")).otherwise(F.col("previous_content_hash")).alias("content_hash"),
        "previous_content_hash", changed.alias("changed"),
        *[pick(o).alias(o) for o in D.OPS],
        sum((pick(o) for o in ("removed", "modified")), pick("added")).alias("diff_total"),
        # keyed counts are over different keys: what is left are further copies
        F.when(fresh & keyed, F.col("feature_count") - sum((F.coalesce(F.col(o), F.lit(0)) for o in ("modified", "unchanged")), F.coalesce(F.col("added"), F.lit(0))))
        .cast("long").alias("duplicates"),
        F.when(fresh, keyed).alias("keyed"), F.when(fresh, first_run).alias("first_run"),
        F.when(fresh, F.col("min_lon")).alias("min_lon"), F.when(fresh, F.col("min_lat")).alias("min_lat"),
        F.when(fresh, F.col("max_lon")).alias("max_lon"), F.when(fresh, F.col("max_lat")).alias("max_lat"),
        fetched_at.alias("fetched_at"), F.col("max_age").alias("max_age_seconds"),
        is_stale(fetched_at, F.col("max_age"), now_col).alias("stale"), error.alias("error"),
        F.when(failed, F.lit(5)).alias("error_code"), "steps",
    )

    # One row per source: computed once, here, for the caller, the decision and the tables written below.
    published_before = {r["source"]: r["published_hash"] for r in state_meta.select("source", "published_hash").collect()}
    decision = manifest.collect()
    manifest = spark.createDataFrame(decision, manifest.schema)
    failures = [r for r in decision if r["status"] == "failed"]
    any_failed = bool(failures)
    # what is written out is compared with what was written last, so a change that was blocked is not lost
    to_publish = [r["source"] for r in decision if r["status"] not in ("failed", "skipped")
                  and (force or r["content_hash"] != published_before.get(r["source"]))]
    exit_code = max([r["error_code"] or 5 for r in failures], default=0 if to_publish or force else 3)
    outputs: list[str] = []
    if not any_failed and to_publish:
        published = feats.where(F.col("_source").isin(to_publish))
        for name in to_publish:
            path = f"{out_dir}/features/run_id={run_id}/_source={name}" if out_dir else f"features/_source={name}"
            outputs.append(("would write geojson " if dry_run else "") + path)
        if not dry_run and out_dir:
            lines = published.select("_source", F.concat(
                F.substring("_json", F.lit(1), F.length("_json") - 1), F.lit(',"type":"Feature"}')).alias("value"))
            write_features(lines, f"{out_dir}/features/run_id={run_id}")

    written = {name: [o for o in outputs if o.endswith(f"/_source={name}")] for name in known}
    manifest = spark.createDataFrame([(*r, written[r["source"]]) for r in decision], T.StructType(manifest.schema.fields).add("outputs", T.ArrayType(T.StringType())))

    # Next state: fresh sources get their new index; failed and skipped sources keep the old rows.
    fresh_names = [r["source"] for r in decision if r["status"] not in ("failed", "skipped")]
    wrote = set(to_publish) if not any_failed else set()
    published_now = [(r["source"], r["content_hash"] if r["source"] in wrote else published_before.get(r["source"])) for r in decision]
    next_meta = manifest.where(F.col("status") != "skipped").select("source", "content_hash", "fetched_at", "feature_count").join(
        spark.createDataFrame(published_now, "source STRING, published_hash STRING"), "source").unionByName(
        state_meta.join(manifest.where(F.col("status") == "skipped").select("source"), "source", "left_semi"))

    if state is not None:
        committed = state
        try:
            if not dry_run:
                entry = S.write_state(change, fresh_names, next_meta) | {"run_id": run_id, "run_at": now}
                if outputs:
                    entry["features"] = state.entry["features"] | {n: f"{out_dir}/features/run_id={run_id}/_source={n}" for n in wrote}
                manifest.withColumn("run_at", now_col).write.mode("overwrite").parquet(f"{out_dir}/manifest/run_id={run_id}")
                committed = S.commit(state, entry)
        finally:
            change.release()
        return RunResult(manifest=manifest, next_index=committed.index(), next_meta=committed.meta(), features=_written(spark, outputs, dry_run, out_dir, run_id, feats),
                         outputs=outputs, exit_code=exit_code, committed=committed)
    next_index = _next_index(feats, state_index, fresh_names, per_source)
    if not dry_run and out_dir:
        # the manifest last: what it does not name is not part of a run
        next_index.write.mode("overwrite").parquet(f"{out_dir}/state/run_id={run_id}/index")
        next_meta.write.mode("overwrite").parquet(f"{out_dir}/state/run_id={run_id}/meta")
        manifest.withColumn("run_at", now_col).write.mode("overwrite").parquet(f"{out_dir}/manifest/run_id={run_id}")
        return RunResult(manifest=manifest, next_index=spark.read.schema(STATE_INDEX_SCHEMA).parquet(f"{out_dir}/state/run_id={run_id}/index"),
                         next_meta=spark.read.schema(STATE_META_SCHEMA).parquet(f"{out_dir}/state/run_id={run_id}/meta"),
                         features=_written(spark, outputs, dry_run, out_dir, run_id, feats), outputs=outputs, exit_code=exit_code)
    return RunResult(manifest=manifest, next_index=next_index, next_meta=next_meta, features=feats, outputs=outputs,
                     exit_code=exit_code)


def _written(spark: SparkSession, outputs: list[str], dry_run: bool, out_dir: str | None, run_id: str, feats: DataFrame) -> DataFrame:
    return spark.read.text(f"{out_dir}/features/run_id={run_id}") if outputs and not dry_run else feats


def _counts(feats: DataFrame, state_index: DataFrame, by_key: Sequence[str]) -> DataFrame:
    """(_source, added, removed, modified, unchanged), each source in the diff of its mode only."""
    by = ["_source"]
    prev = state_index.withColumnRenamed("source", "_source")
    keyed_source = F.col("_source").isin(list(by_key))
    keyed = D.diff_counts(D.change_feed(D.key_index(feats.where(keyed_source), by),
                                        prev.where(keyed_source & F.col("key").isNotNull()).select("_source", "key", "hash"), by), by)
    # an unkeyed previous run keeps (hash, n); a keyed one can be compared as a multiset too
    unkeyed = D.unkeyed_diff(D.hash_counts(feats.where(~keyed_source), by), prev.where(~keyed_source).select("_source", "hash", "n"), by)
    return keyed.unionByName(unkeyed)


def _next_index(feats: DataFrame, state_index: DataFrame, fresh: Sequence[str], per_source: DataFrame) -> DataFrame:
    of_fresh = feats.where(F.col("_source").isin(list(fresh)))
    keyed_rows = of_fresh.groupBy("_source", "_key").agg(F.max(D.place(feats))["_hash"].alias("hash"), F.count(F.lit(1)).alias("n"))
    mode = per_source.select("_source", ((F.col("with_key") == F.col("feature_count")) & (F.col("feature_count") > 0)).alias("all_keyed"))
    new_keyed = (keyed_rows.join(mode, "_source").where(F.col("all_keyed") & F.col("_key").isNotNull())
                 .select(F.col("_source").alias("source"), F.col("_key").alias("key"), "hash", "n"))
    new_unkeyed = (D.hash_counts(of_fresh, ["_source"]).join(mode, "_source").where(~F.col("all_keyed"))
                   .select(F.col("_source").alias("source"), F.lit(None).cast("string").alias("key"), "hash", "n"))
    return new_keyed.unionByName(new_unkeyed).unionByName(state_index.where(~F.col("source").isin(list(fresh))))


def run_committed(spark: SparkSession, specs: Sequence[SourceSpec], out_dir: str, now: str, run_id: str, attempts: int = 3,
                  **options) -> RunResult:
    """R1 on the committed state of ``out_dir``: read the last commit, run, commit; run again if another run came first."""
    for left in range(attempts - 1, -1, -1):
        state = S.open_state(spark, out_dir)
        try:
            return refresh(spark, specs, None, None, now, out_dir=out_dir, run_id=run_id, state=state, **options)
        except S.RunConflict:
            if not left:
                raise
    raise ValueError("attempts must be at least 1")


def published(spark: SparkSession, out_dir: str, version: int | None = None) -> dict[str, str]:
    """The folder of each source's features as a commit left them: a reader's snapshot."""
    return dict(S.open_state(spark, out_dir, version).entry["features"])

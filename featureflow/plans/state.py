"""State kept between runs: a base and deltas, Merkle digests of its leaves, and a log of commits.

The state of a run holds one row per key of a keyed source and one per feature
hash of an unkeyed one: ``(source, id, keyed, hash, n)``. A run writes what it
changed only: a *delta* of changed and gone rows, and the digests of the leaves
that these rows lie in. A leaf is the rows whose id's hash begins with the same
hex digits; how many digits is chosen when a base is written, so that a leaf
holds about ``LEAF_ROWS`` rows. When the deltas outgrow the base, or are too
many, the merged state is written as the next base.

* **Diff.** Current rows and deltas meet in one aggregation by (source, id).
  Digests of the current leaves are compared with the stored ones: rows of equal
  leaves are unchanged and go no further. Those of other leaves are joined with
  the base, a table bucketed by (source, id): it is read where it lies, without
  an exchange.
* **Commits.** ``log/`` holds one numbered file per commit, made whole by a
  rename that fails where the number is taken. It names everything a reader
  needs, so a reader sees one commit whole; a run that finds its number taken
  raises ``RunConflict`` and is run again on the newer state. Folders that no
  recent commit names are dropped by ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators import diff as D

LEAF_ROWS = 64
MOST_DIGITS = 6
MOST_DELTAS = 8
MOST_SHARE = 0.3  # of the base's rows that deltas may hold before the next base
PRUNED_LEAVES = 100_000  # changed leaves that are broadcast; beyond, all rows are joined

ROWS = "source STRING, id STRING, keyed BOOLEAN, hash STRING, n BIGINT"
DELTA = ROWS + ", gone BOOLEAN"
LEAVES = "source STRING, leaf STRING, digest STRING, ids BIGINT, features BIGINT"
META = "source STRING, content_hash STRING, fetched_at TIMESTAMP, feature_count BIGINT, published_hash STRING"


class RunConflict(RuntimeError):
    """Another run has committed since this one read its state."""


class Files:
    """The few file operations that tables do not offer, on whatever file system a path names."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        fs = at.getFileSystem(self.conf)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def exists(self, path: str) -> bool:
        at = self.path(path)
        return at.getFileSystem(self.conf).exists(at)

    def drop(self, path: str) -> None:
        at = self.path(path)
        at.getFileSystem(self.conf).delete(at, True)

    def create(self, path: str, text: str) -> bool:
        """Make the file with its whole text; False, and no change, where there is one."""
        target, draft = self.path(path), self.path(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        out = draft.getFileSystem(self.conf).create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        none = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf)
        try:
            context.rename(draft, target, none)
            return True
        except Exception as e:  # noqa: BLE001  a Java exception: only its kind tells
            self.drop(draft.toString())
            if "FileAlreadyExists" in str(e):
                return False
            raise


# -- rows and digests ----------------------------------------------------------------------

def id_hash(id_col: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.xxhash64(id_col))), 16, "0")


def leaf_of(id_col: Column, digits: int) -> Column:
    return F.substring(id_hash(id_col), 1, digits) if digits else F.lit("")


def digits_for(rows: int) -> int:
    """Hex digits that cut ``rows`` into leaves of about ``LEAF_ROWS``."""
    digits = 0
    while digits < MOST_DIGITS and rows > LEAF_ROWS * 16 ** digits:
        digits += 1
    return digits


def leaf_digests(rows: DataFrame, digits: int) -> DataFrame:
    """(source, leaf, digest, ids, features) of state rows; a leaf's rows are few, so they are hashed in order."""
    entry = F.concat_ws(":", "id", "hash", F.col("n").cast("string"))
    return (rows.groupBy("source", leaf_of(F.col("id"), digits).alias("leaf"))
            .agg(F.sha2(F.array_join(F.array_sort(F.collect_list(entry)), ","), 256).alias("digest"),
                 F.count(F.lit(1)).alias("ids"), F.sum("n").alias("features")))


def middle_digests(leaves: DataFrame, digits: int) -> DataFrame:
    """(source, middle, digest) over the leaves that share all but their last two digits."""
    middle = F.substring("leaf", 1, max(0, digits - 2)) if digits > 2 else F.lit("")
    return leaves.groupBy("source", middle.alias("middle")).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "leaf", "digest"))), ","), 256).alias("digest"))


def differing_leaves(now: DataFrame, before: DataFrame, digits: int) -> DataFrame:
    """(source, leaf) of the leaves whose digests differ or that only one side has.

    Middle digests are compared first; only leaves below differing ones are
    compared one by one.
    """
    def unequal(a: DataFrame, b: DataFrame, place: str) -> DataFrame:
        a, b = a.select("source", place, F.col("digest").alias("now")), b.select("source", place, F.col("digest").alias("before"))
        return a.join(b, ["source", place], "full_outer").where(~F.col("now").eqNullSafe(F.col("before"))).select("source", place)

    middle = F.substring("leaf", 1, max(0, digits - 2)) if digits > 2 else F.lit("")
    open_middles = unequal(middle_digests(now, digits), middle_digests(before, digits), "middle")

    def below(leaves: DataFrame) -> DataFrame:
        return leaves.withColumn("middle", middle).join(open_middles, ["source", "middle"], "left_semi")

    return unequal(below(now), below(before), "leaf")


def latest(parts: Sequence[DataFrame], by: Sequence[str]) -> DataFrame | None:
    """Of tables written one after another, the last row of each key."""
    out = None
    for i, part in enumerate(parts):
        part = part.withColumn("_at", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return None
    if len(parts) == 1:
        return out.drop("_at")
    values = [c for c in out.columns if c not in by and c != "_at"]
    return out.groupBy(*by).agg(F.max_by(F.struct(*values), "_at").alias("_last")).select(*by, "_last.*")


# -- a committed state -----------------------------------------------------------------------

@dataclass
class State:
    """The state that one commit names; version 0 is the empty state before the first commit."""

    spark: SparkSession
    out_dir: str
    entry: dict = field(default_factory=lambda: {"version": 0, "deltas": [], "leaves": [], "keyed": {}, "features": {}})

    @property
    def version(self) -> int:
        return self.entry["version"]

    @property
    def digits(self) -> int:
        return self.entry.get("digits", 0)

    def at(self, name: str) -> str:
        return f"{self.out_dir}/state/{name}"

    def base(self) -> DataFrame:
        """The base's rows, bucketed by (source, id)."""
        if "base" not in self.entry:
            return self.spark.createDataFrame([], ROWS)
        table = self.entry["base"].replace("-", "_")
        if not self.spark.catalog.tableExists(table):  # another session wrote it
            self.spark.sql(f"CREATE TABLE {table} ({ROWS}) USING parquet CLUSTERED BY (source, id) SORTED BY (source, id) "
                           f"INTO {int(self.entry['buckets'])} BUCKETS LOCATION '{self.at(self.entry['base'])}'")
        return self.spark.table(table)

    def delta(self) -> DataFrame:
        """The last row of every (source, id) that changed since the base."""
        parts = [self.spark.read.schema(DELTA).parquet(self.at(d)) for d in self.entry["deltas"]]
        return latest(parts, ["source", "id"]) if parts else self.spark.createDataFrame([], DELTA)

    def rows(self) -> DataFrame:
        """The whole state: the base, with what the deltas say of it."""
        if not self.entry["deltas"]:
            return self.base()
        delta = self.delta()
        kept = self.base().join(delta.select("source", "id"), ["source", "id"], "left_anti")
        return kept.unionByName(delta.where(~F.col("gone")).drop("gone"))

    def leaves(self) -> DataFrame:
        parts = [self.spark.read.schema(LEAVES).parquet(self.at(x)) for x in self.entry["leaves"]]
        found = latest(parts, ["source", "leaf"])
        return self.spark.createDataFrame([], LEAVES) if found is None else found.where(F.col("digest").isNotNull())

    def index(self) -> DataFrame:
        """The state as ``(source, key, hash, n)``, key null for unkeyed sources."""
        return self.rows().select("source", F.when(F.col("keyed"), F.col("id")).alias("key"), "hash", "n")

    def check(self) -> None:
        """Raise unless every file that the commit names has a readable footer and first rows."""
        self.meta().collect()
        for frame in (self.base(), self.delta(), self.leaves()):
            frame.limit(1).collect()
            frame.count()

    def meta(self) -> DataFrame:
        return self.spark.read.schema(META).parquet(self.at(self.entry["meta"])) if "meta" in self.entry else self.spark.createDataFrame([], META)


def damaged(e: Exception) -> bool:
    """Whether Spark failed because a file is not what it should be."""
    return any(word in str(e) for word in ("CANNOT_READ_FILE", "FAILED_READ_FILE", "is not a Parquet file", "Could not read footer", "ParquetDecodingException"))


def commits(spark: SparkSession, out_dir: str) -> list[int]:
    """The numbers of the commits in ``out_dir``."""
    return sorted(int(n[:-5]) for n in Files(spark).names(f"{out_dir}/state/log") if n.endswith(".json") and n[:-5].isdigit())


def open_state(spark: SparkSession, out_dir: str, version: int | None = None) -> State:
    """The state of a commit, the last one unless ``version`` names another; the empty state where there is none.

    A commit whose files cannot be read is passed over for the one before it.
    """
    found = commits(spark, out_dir)
    if version is not None:
        found = [v for v in found if v <= version]
    for v in reversed(found):
        try:
            text = spark.read.text(f"{out_dir}/state/log/{v:020d}.json", wholetext=True).first()[0]
            state = State(spark, out_dir, json.loads(text) | {"version": found[-1]})  # the next number is free, whichever is read
            state.check()
            return state
        except (AnalysisException, ValueError, KeyError, OSError) as e:
            spark.sparkContext._jvm.org.apache.logging.log4j.LogManager.getLogger("featureflow").warn(f"commit {v} cannot be read: {e}")
        except Exception as e:  # noqa: BLE001  what Spark raises for a damaged file has no type of its own
            if not damaged(e):
                raise
    return State(spark, out_dir, State(spark, out_dir).entry | {"version": found[-1] if found else 0})


# -- a run's change --------------------------------------------------------------------------

@dataclass
class Change:
    """What a run found against a state: its counts per source, and what it will write."""

    state: State
    merged: DataFrame  # (source, id, hash, n, last): current rows beside what deltas say
    leaves_now: DataFrame
    changed: DataFrame
    feed: DataFrame  # rows of changed leaves: (source, id, op, hash, n, prev_hash, prev_n)
    counts: DataFrame  # (_source, added, removed, modified, unchanged)
    keyed: dict[str, bool]
    digits: int

    def release(self) -> None:
        for frame in (self.merged, self.leaves_now, self.changed):
            frame.unpersist()


def current_rows(feats: DataFrame, keyed: dict[str, bool]) -> DataFrame:
    """(source, id, place): each feature under its key, or under its hash where its source is not keyed."""
    of_key = F.col("_source").isin([s for s, k in keyed.items() if k])
    return feats.select(F.col("_source").alias("source"), F.when(of_key, F.col("_key")).otherwise(F.col("_hash")).alias("id"),
                        D.place(feats).alias("place"))


def compare(state: State, feats: DataFrame, keyed: dict[str, bool]) -> Change:
    """The change from ``state`` to ``feats``, whose sources are keyed as ``keyed`` says.

    A source that was keyed otherwise before has rows under other ids: its
    counts come from its feature hashes if it has no keys now, and all of it is
    new if it has keys for the first time.
    """
    spark = state.spark
    otherwise = [s for s, k in keyed.items() if state.entry["keyed"].get(s, k) != k]
    none = F.lit(None)
    now = current_rows(feats, keyed).select("*", none.cast("struct<hash: string, n: bigint, gone: boolean>").alias("last"))
    old = state.delta().where(F.col("source").isin(list(keyed)) & ~F.col("source").isin(otherwise))
    parts = now.unionByName(old.select("source", "id", none.cast(now.schema["place"].dataType).alias("place"),
                                       F.struct("hash", "n", "gone").alias("last")))
    merged = parts.groupBy("source", "id").agg(F.max("place")["_hash"].alias("hash"), F.count("place").alias("n"),
                                               F.max("last").alias("last")).persist(StorageLevel.MEMORY_AND_DISK)
    present = merged.where(F.col("hash").isNotNull())
    rows = present.count()
    digits = state.digits if "base" in state.entry else digits_for(rows)
    leaves_now = leaf_digests(present.select("source", "id", "hash", "n"), digits).persist(StorageLevel.MEMORY_AND_DISK)
    before = state.leaves().where(F.col("source").isin(list(keyed)) & ~F.col("source").isin(otherwise))
    changed = differing_leaves(leaves_now, before, digits).persist(StorageLevel.MEMORY_AND_DISK)

    base = state.base().where(F.col("source").isin(list(keyed)) & ~F.col("source").isin(otherwise))
    rest = merged
    prune = changed.limit(PRUNED_LEAVES + 1).count() <= PRUNED_LEAVES
    if prune:
        def below(frame: DataFrame) -> DataFrame:
            here = frame.withColumn("leaf", leaf_of(F.col("id"), digits))
            return here.join(F.broadcast(changed), ["source", "leaf"], "left_semi").drop("leaf")

        rest, base = below(merged), below(base)
    joined = rest.join(base.select("source", "id", F.col("hash").alias("base_hash"), F.col("n").alias("base_n")), ["source", "id"], "full_outer")
    said, there = F.col("last").isNotNull(), ~F.col("last.gone")
    feed = joined.select("source", "id", "hash", F.coalesce("n", F.lit(0)).alias("n"),
                         F.when(said, F.when(there, F.col("last.hash"))).otherwise(F.col("base_hash")).alias("prev_hash"),
                         F.when(said, F.when(there, F.col("last.n")).otherwise(0)).otherwise(F.coalesce("base_n", F.lit(0))).alias("prev_n"))
    feed = feed.where("hash IS NOT NULL OR prev_hash IS NOT NULL")
    op = (F.when(F.col("prev_hash").isNull(), "added").when(F.col("hash").isNull(), "removed")
          .when(F.col("hash") != F.col("prev_hash"), "modified").otherwise("unchanged"))
    feed = feed.withColumn("op", op)

    of_key = F.col("source").isin([s for s, k in keyed.items() if k])
    more, less, same = (F.col("n") - F.col("prev_n"), F.col("prev_n") - F.col("n"), F.least("n", "prev_n"))
    counts = feed.groupBy("source").agg(
        F.sum(F.when(of_key, (op == "added").cast("long")).otherwise(F.greatest(more, F.lit(0)))).alias("added"),
        F.sum(F.when(of_key, (op == "removed").cast("long")).otherwise(F.greatest(less, F.lit(0)))).alias("removed"),
        F.sum(F.when(of_key, (op == "modified").cast("long")).otherwise(F.lit(0))).alias("modified"),
        F.sum(F.when(of_key, (op == "unchanged").cast("long")).otherwise(same)).alias("unchanged"))
    if prune:
        zero = F.lit(0).cast("long")
        kept = leaves_now.join(F.broadcast(changed), ["source", "leaf"], "left_anti").groupBy("source").agg(
            F.sum(F.when(of_key, F.col("ids")).otherwise(F.col("features"))).alias("unchanged"))
        counts = counts.unionByName(kept.select("source", zero.alias("added"), zero.alias("removed"), zero.alias("modified"), "unchanged"))
        counts = counts.groupBy("source").agg(*[F.sum(o).alias(o) for o in D.OPS])
    lost_keys = [s for s in otherwise if not keyed[s]]
    if lost_keys:
        old_hashes = state.rows().where(F.col("source").isin(lost_keys)).groupBy(F.col("source").alias("_source"), "hash").agg(F.sum("n").alias("n"))
        of_hashes = D.unkeyed_diff(D.hash_counts(feats.where(F.col("_source").isin(lost_keys)), ["_source"]), old_hashes, ["_source"])
        counts = counts.where(~F.col("source").isin(lost_keys)).unionByName(of_hashes.withColumnRenamed("_source", "source"))
    return Change(state, merged, leaves_now, changed, feed, counts.withColumnRenamed("source", "_source"), keyed, digits)


def write_state(change: Change, fresh: Sequence[str], meta: DataFrame) -> dict:
    """Write the next state, ``fresh`` sources changed and all others as they were; return the entry to commit.

    The next base is written if there is none, if a source's mode changed, or
    if the deltas are too many or too large; else a delta.
    """
    state, entry = change.state, dict(change.state.entry)
    keyed = state.entry["keyed"] | {s: k for s, k in change.keyed.items() if s in fresh}
    otherwise = any(state.entry["keyed"].get(s, k) != k for s, k in keyed.items())
    entry["keyed"], entry["meta"] = keyed, f"meta-{uuid.uuid4().hex}"
    meta.write.parquet(state.at(entry["meta"]))
    mode = F.col("source").isin([s for s, k in keyed.items() if k])
    is_fresh = F.col("source").isin(list(fresh))
    delta = change.feed.where(is_fresh & ~(F.col("hash").eqNullSafe(F.col("prev_hash")) & (F.col("n") == F.col("prev_n")))).select(
        "source", "id", mode.alias("keyed"), F.coalesce("hash", "prev_hash").alias("hash"), "n", F.col("hash").isNull().alias("gone"))
    if "base" in entry and not otherwise and len(entry["deltas"]) < MOST_DELTAS:
        name = f"delta-{uuid.uuid4().hex}"
        delta.coalesce(max(1, change.state.entry["buckets"] // 8)).write.parquet(state.at(name))
        written = state.spark.read.schema(DELTA).parquet(state.at(name)).count()
        if entry["delta_rows"] + written <= max(LEAF_ROWS, MOST_SHARE * entry["base_rows"]):
            leaves = f"leaves-{uuid.uuid4().hex}"
            of_fresh = change.changed.where(is_fresh)
            digests = of_fresh.join(change.leaves_now, ["source", "leaf"], "left")  # a leaf that is gone has no digest
            digests.select("source", "leaf", "digest", "ids", "features").write.parquet(state.at(leaves))
            if written:
                entry |= {"deltas": [*entry["deltas"], name], "leaves": [*entry["leaves"], leaves], "delta_rows": entry["delta_rows"] + written}
            return entry
    return entry | _write_base(change, fresh, mode)


def _write_base(change: Change, fresh: Sequence[str], mode: Column) -> dict:
    state = change.state
    now = change.merged.where(F.col("hash").isNotNull() & F.col("source").isin(list(fresh))).select("source", "id", mode.alias("keyed"), "hash", "n")
    rows = now.unionByName(state.rows().where(~F.col("source").isin(list(fresh))).select(*now.columns))
    name, buckets = f"base-{uuid.uuid4().hex}", int(state.spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.repartition(buckets, "source", "id").write.bucketBy(buckets, "source", "id").sortBy("source", "id")
     .option("path", state.at(name)).saveAsTable(name.replace("-", "_")))
    written = state.spark.read.schema(ROWS).parquet(state.at(name))
    n = written.count()
    digits, leaves = digits_for(n), f"leaves-{uuid.uuid4().hex}"
    leaf_digests(written, digits).write.parquet(state.at(leaves))
    return {"base": name, "buckets": buckets, "digits": digits, "base_rows": n, "deltas": [], "delta_rows": 0, "leaves": [leaves]}


def commit(state: State, entry: dict) -> State:
    """Make ``entry`` the commit after ``state``; raise ``RunConflict`` if there is one already."""
    entry = entry | {"version": state.version + 1}
    if not Files(state.spark).create(f"{state.out_dir}/state/log/{entry['version']:020d}.json", json.dumps(entry, sort_keys=True)):
        raise RunConflict(f"commit {entry['version']} of {state.out_dir} was made by another run")
    return State(state.spark, state.out_dir, entry)


def vacuum(spark: SparkSession, out_dir: str, keep: int = 2) -> list[str]:
    """Drop the state folders that none of the last ``keep`` commits names; return their names.

    To be called while no run is under way: a run's folders are named by its
    commit only.
    """
    files, named = Files(spark), set()
    for v in commits(spark, out_dir)[-keep:]:
        entry = json.loads(spark.read.text(f"{out_dir}/state/log/{v:020d}.json", wholetext=True).first()[0])
        named |= {entry.get("base"), entry.get("meta"), *entry["deltas"], *entry["leaves"]}
    gone = [n for n in files.names(f"{out_dir}/state") if n.split("-")[0] in ("base", "delta", "leaves", "meta") and n not in named]
    for n in gone:
        if n.startswith("base-"):
            spark.sql(f"DROP TABLE IF EXISTS {n.replace('-', '_')}")
        files.drop(f"{out_dir}/state/{n}")
    return gone

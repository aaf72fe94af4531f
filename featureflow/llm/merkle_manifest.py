"""A Merkle manifest of a dataset, and the proof of every row by a recursive climb.

Each row is a leaf, H of its fields. The leaves of a group (a language) stand
in the order of their ids; every 8 consecutive nodes become their H until one
is left, the group's subroot. The subroots, in the order of the groups, form
one more tree of the same kind, whose last node is the root. H is the lowercase
hex SHA-256 of its inputs' concatenation.

The built levels are stored as node rows, each with its place, the place of its
parent, its children's digests and the number of leaves below it. A recursive
query then climbs from every leaf: a step looks up the parent's row, folds the
carried digest between the siblings to its left and right, and appends the
parent, whose row holds the siblings, to the path. What is carried per leaf
stays small (a digest and eight bytes a level). The siblings' text is resolved
afterwards, once for each run of 8 leaves, whose paths are the same.

Scale: no group is sorted as a whole. Places come from a range partitioning and
the counts of its partitions. Close to the root all leaves ask for the same
few rows; such rows are stored in up to ``COPIES`` copies (one for each
``FEW`` leaves below), and every leaf asks for the copy of its number.

Defined cases: a null field is ``-``; null ids stand first, rows of equal id in
the order of their leaves (equal rows are equal leaves, so their order does not
show); the null group stands first; a lone leaf is its subroot and a lone
subroot the root, their proof being H of nothing; an empty table gives an empty
table. Long and empty texts are like others. Other columns are not looked at,
and the result has none of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import partitions, sized, stored

RUN = 8
COPIES = 256
FEW = 64
TOP = -1  # the tree of the subroots
HEX = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*fields: Column) -> Column:
    """H of fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    parts = []
    for c in fields:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


@dataclass
class Manifest:
    """A built manifest.

    leaves: (tree, idx, id, hash, tampered, n, uptree, uplevel, up, slot, copies), one row per row.
    nodes: (node, tree, level, idx, hash, children, n, uptree, uplevel, up, slot, copies) of all
    levels above the leaves. (uptree, uplevel, up) is the parent's place, ``slot`` the place among
    its children, ``copies`` the parent's number of copies; all are null at the root.
    """

    leaves: DataFrame
    nodes: DataFrame


def numbered(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """``df``, stored, with ``idx``: each row's place from 0 in its group ``by``, in the order ``order``.

    Rows are dealt by ranges of (by, order); a place is the row's place in its
    partition and the group's rows in those before. The columns ``by`` must not
    be null.
    """
    ranged = df.repartitionByRange(partitions(df.sparkSession), *by, *order).sortWithinPartitions(*by, *order)
    rows = stored(ranged.withColumn("_seq", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("_part", F.shiftright("_seq", 33))
    # one row per group and partition; a group's window holds at most as many rows as there are partitions
    parts = rows.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(parts.select(*by, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), f"{name}-starts")
    return (rows.join(sized(starts), [*by, "_part"])
            .withColumn("idx", F.col("_seq") - F.col("_first") + F.col("_start")).drop("_seq", "_part", "_first", "_start"))


def _copies(n: Column) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(COPIES), F.floor(n / FEW))).cast("long")


def _tree(nodes: DataFrame, depth: int, name: str) -> list[DataFrame]:
    """All levels above ``nodes`` (tree, idx, hash, n, size), the trees' leaves; ``size`` counts the leaves of the tree.

    Level k of a tree exists while level k - 1 has more than one node, which
    ``size`` tells. At most 8 rows meet in a group.
    """
    out, below = [], nodes.select("tree", "idx", "hash", "n", F.col("size").alias("_left"))
    for level in range(1, depth + 1):
        up = (below.where("_left > 1").groupBy("tree", F.floor(F.col("idx") / RUN).cast("long").alias("_up"))
              .agg(F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("_run"), F.sum("n").alias("n"),
                   F.max("_left").alias("_left")))
        children = F.array_join(F.transform("_run", lambda x: x["hash"]), "")
        below = stored(up.select("tree", F.lit(level).alias("level"), F.col("_up").alias("idx"), F.sha2(children, 256).alias("hash"),
                                 children.alias("children"), "n", F.ceil(F.col("_left") / RUN).cast("long").alias("_left")), f"{name}-{level}")
        out.append(below)
    return out


def _depth(leaves: int) -> int:
    depth = 0
    while leaves > 1:
        leaves, depth = -(-leaves // RUN), depth + 1
    return depth


def build(rows: DataFrame, by: str, id_col: str) -> Manifest:
    """The manifest of ``rows`` (by, id, hash, tampered): all levels, with links to the parents."""
    keyed = rows.select(F.col(by).isNotNull().alias("known"), F.coalesce(F.col(by).cast("string"), F.lit("")).alias("name"),
                        F.col(id_col).alias("id"), "hash", "tampered")
    placed = numbered(stored(keyed, "merkle-rows"), ["known", "name"], ["id", "hash"], "merkle-order")
    groups = stored(placed.groupBy("known", "name").agg(F.count(F.lit(1)).alias("size")), "merkle-groups")
    groups = stored(numbered(groups, [], ["known", "name"], "merkle-group-order").withColumnRenamed("idx", "tree"), "merkle-trees")
    n_trees, largest = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    leaves = stored(placed.join(sized(groups), ["known", "name"]).select(
        "tree", "idx", "id", "hash", "tampered", F.lit(1).cast("long").alias("n"), "size"), "merkle-leaves")
    levels = _tree(leaves, _depth(largest), "merkle-level")
    tops = [leaves.where("size = 1").select("tree", "hash", "n")] + [x.where("_left = 1").select("tree", "hash", "n") for x in levels]
    subroots = tops[0]
    for x in tops[1:]:
        subroots = subroots.unionByName(x)
    subroots = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "hash", "n", F.lit(n_trees).cast("long").alias("size"))
    top_levels = _tree(subroots, _depth(n_trees), "merkle-top")

    # the parent's place: in the same tree, or for a subroot in the tree of subroots
    columns = ["tree", "level", "idx", "hash", "children", "n", "_left"]
    nodes = leaves.select("tree", F.lit(0).alias("level"), "idx", "hash", F.lit(None).cast("string").alias("children"), "n",
                          F.col("size").alias("_left")).where(F.lit(False))
    for x in levels + top_levels:
        nodes = nodes.unionByName(x.select(*columns))
    nodes = stored(_linked(nodes, n_trees), "merkle-nodes")
    at_leaf = _linked(leaves.withColumnRenamed("size", "_left").withColumn("level", F.lit(0)), n_trees)
    copies = nodes.select(F.col("tree").alias("uptree"), F.col("level").alias("uplevel"), F.col("idx").alias("up"), _copies(F.col("n")).alias("copies"))
    linked = nodes.join(copies, ["uptree", "uplevel", "up"], "left").withColumn("node", F.monotonically_increasing_id())
    return Manifest(stored(at_leaf.join(copies, ["uptree", "uplevel", "up"], "left"), "merkle-linked-leaves"), stored(linked, "merkle-linked"))


def _linked(nodes: DataFrame, n_trees: int) -> DataFrame:
    subroot = (F.col("_left") == 1) & (F.col("tree") != TOP)
    last = F.col("_left") == 1 if n_trees == 1 else (F.col("_left") == 1) & (F.col("tree") == TOP)
    place = F.floor(F.when(subroot, F.col("tree")).otherwise(F.col("idx")) / RUN).cast("long")
    return nodes.select(
        "*", F.when(~last, F.when(subroot, F.lit(TOP)).otherwise(F.col("tree"))).cast("long").alias("uptree"),
        F.when(~last, F.when(subroot, F.lit(1)).otherwise(F.col("level") + 1)).alias("uplevel"), F.when(~last, place).alias("up"),
        F.when(~last, F.when(subroot, F.col("tree")).otherwise(F.col("idx")) % RUN).cast("int").alias("slot")).drop("_left")


# One step: the carried digest takes its slot among the parent's children, whose row is then the next to climb from.
CLIMB = f"""
WITH RECURSIVE climb (tree, idx, uptree, uplevel, up, slot, copies, folded, path, slots) AS (
  SELECT tree, idx, uptree, uplevel, up, slot, copies, start, CAST(array() AS ARRAY<BIGINT>), '' FROM {{leaves}}
  UNION ALL
  SELECT c.tree, c.idx, p.uptree, p.uplevel, p.up, p.slot, p.copies,
         sha2(concat(substring(p.children, 1, {HEX} * c.slot), c.folded, substring(p.children, {HEX} * (c.slot + 1) + 1)), 256),
         array_append(c.path, p.node), concat(c.slots, CAST(c.slot AS STRING))
  FROM climb c JOIN {{nodes}} p
    ON c.uptree = p.tree AND c.uplevel = p.level AND c.up = p.idx AND c.idx % c.copies = p.copy)
SELECT tree, idx, folded, path, slots FROM climb WHERE up IS NULL
"""


def climb(manifest: Manifest, start: Column) -> DataFrame:
    """(tree, idx, folded, path, slots) of every leaf: the root that ``start``, a column of the leaves, folds to,
    the numbers of the node rows passed on the way, and the slot taken in each."""
    spark = manifest.leaves.sparkSession
    # each node's row as often as its number of copies asks; its number is any that tells it from others
    rows = manifest.nodes.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), _copies(F.col("n")) - 1)))
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    try:
        return stored(spark.sql(CLIMB, leaves=manifest.leaves.withColumn("start", start), nodes=rows), "merkle-climb")
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", limit)


def _proofs(manifest: Manifest, climbed: DataFrame) -> DataFrame:
    """(tree, idx, folded, proof): the siblings' text, resolved once per run of leaves."""
    run = F.floor(F.col("idx") / RUN).cast("long")
    paths = climbed.where((F.col("idx") % RUN == 0) & (F.size("path") > 0)).select("tree", run.alias("run"), F.posexplode("path").alias("level", "node"))
    texts = (paths.join(manifest.nodes.select("node", "children"), "node").groupBy("tree", "run")
             .agg(F.array_sort(F.collect_list(F.struct("level", "children"))).alias("steps")))

    def siblings(step: Column, i: Column) -> Column:
        slot = F.substring(F.col("slots"), i + 1, F.lit(1)).cast("int")
        all_of = step["children"]
        return F.concat(F.substring(all_of, F.lit(1), slot * HEX), F.substring(all_of, (slot + 1) * HEX + 1, F.length(all_of)))

    joined = climbed.withColumn("run", run).join(texts, ["tree", "run"], "left")
    return joined.select("tree", "idx", "folded", F.coalesce(F.array_join(F.transform("steps", siblings), ""), F.lit("")).alias("proof"))


def verify(docs: DataFrame, by: str = "lang", id_col: str = "doc_id", fields: tuple[str, ...] = FIELDS, text_col: str = "text") -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Rows whose id's crc32 is divided by 3 are tampered with: their text is
    lower-cased in A-Z. Their climb starts from the tampered leaf; all siblings
    are those of the manifest.
    """
    values = [F.col(f"`{f}`") for f in fields]
    changed = [lower_ascii(F.col(f"`{f}`")) if f == text_col else F.col(f"`{f}`") for f in fields]
    tampered = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 0
    rows = docs.select(F.col(f"`{by}`").alias("by"), F.col(f"`{id_col}`").alias("id"), digest_of(*values).alias("hash"),
                       F.when(tampered, digest_of(*changed)).alias("tampered"))
    manifest = build(rows, "by", "id")
    climbed = climb(manifest, F.coalesce("tampered", "hash"))
    proofs = _proofs(manifest, climbed)
    tops = manifest.leaves.where("uptree IS NULL OR uptree = -1").select("tree", F.col("hash").alias("subroot")).unionByName(
        manifest.nodes.where("tree <> -1 AND (uptree IS NULL OR uptree = -1)").select("tree", F.col("hash").alias("subroot")))
    last = manifest.leaves.where("uptree IS NULL").select("hash").unionByName(manifest.nodes.where("uptree IS NULL").select("hash")).first()
    root = F.lit(last[0] if last else None).cast("string")
    out = (manifest.leaves.select("tree", "idx", "id", "hash").join(proofs, ["tree", "idx"])
           .join(sized(stored(tops, "merkle-subroots")), "tree"))
    return out.select(F.col("id").alias(id_col), F.col("hash").alias("leaf"), "subroot", root.alias("root"),
                      F.sha2("proof", 256).alias("proof_sha256"), F.col("folded").alias("folded_root"),
                      (F.col("folded") == root).alias("verified"))

"""N-gram Jaccard join by prefix trees.

A text's set of word shingles is put in one global order: shingles that many
documents hold come last, the rest by hash. Two sets of Jaccard similarity t
share an element among the first n - ceil(t*n) + 1 of each, so only those
elements are exchanged. What comes out of them is verified by a prefix-tree
join: the sets that meet a probe are stored in a trie (their sorted sequences,
visited in order, so that a shared beginning is walked once), the overlap so far
is shared by everything below a node, and a subtree is left when the overlap
plus the shorter of the remaining lengths cannot reach what is needed. Before a
set travels, a parity sketch of a quarter byte per element tests the pair: every
bit in which two sketches differ stands for an element that only one set has, so
a pair that differs in too many bits cannot reach the threshold.

Exact copies collapse into one class before anything is compared. A group of
many near copies is linked to a leader first; only pairs that are not yet
connected are compared after that, so no group emits all its pairs, and every
pair that could join two components is still compared.

Defined cases: null or empty texts and texts without words have the empty set,
are linked with nothing and are their own component; a null id is allowed (the
component's id is the least one that is not null); repeated rows fall in one
class; an empty table gives an empty table; columns beside id and text are not
looked at. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import sized, stored
from featureflow.llm.components import components
from featureflow.llm.shingles import batches_by_bytes, set_id, shingle_sets

# At most so many shingles are called frequent: the least count that makes a
# shingle frequent is at least (all shingles) / MAX_FREQUENT, which bounds the
# broadcast. Which ones are changes the work, never the result.
MAX_FREQUENT = 1 << 20
LEAST_FREQUENT = 48
CODES_PER_BUCKET = 1 << 21
SALTS = 64
SMALL_GROUP = 16  # classes that share an element and meet in a join; more meet in blocks
BLOCK = 1024


def _texts(batches: Iterator[pa.RecordBatch], width: int):
    """(key columns as Python values, shingle set) of every row, in bounded groups."""
    for b in batches:
        keys = [b.column(i) for i in range(b.num_columns - 1)]
        text = b.column(b.num_columns - 1)
        rows = ((*(k[i] for k in keys), text[i].as_py() or b"") for i in range(b.num_rows))
        for group in batches_by_bytes(rows):
            for row, s in zip(group, shingle_sets([r[-1] for r in group], width)):
                yield row[:-1], s


def _order(s: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """A set in the global order, infrequent by hash, then frequent by hash; and how many are infrequent."""
    if not len(frequent):
        return s, len(s)
    code = (s >> np.uint64(32)).astype(np.uint32)
    at = np.minimum(np.searchsorted(frequent, code), len(frequent) - 1)
    late = frequent[at] == code
    return np.concatenate((s[~late], s[late])), int(len(s) - late.sum())


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the elements per cell, two to four cells an element, as packed bits."""
    cells = 64
    while cells < 2 * len(s):
        cells *= 2
    counts = np.bincount((s & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little")


def may_reach(a: np.ndarray, na: int, b: np.ndarray, nb: int, percent: int) -> bool:
    """Whether two sketches allow the threshold; a longer one is folded to the shorter's cells."""
    while len(a) > len(b):
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    differ = int(np.bitwise_count(a ^ b).sum())
    return differ <= na + nb - 2 * _need(na, nb, percent)


def assigned(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n, c, k): set size, class id and sketch of each document."""
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary"))

    def run(batches):
        for b in batches:
            n, c, k = [], [], []
            for _, s in _texts([b.select([1])], width):
                n.append(len(s))
                c.append(set_id(s) if len(s) else None)
                k.append(sketch(s).tobytes() if len(s) else None)
            yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(k, pa.binary())],
                                  names=["id", "n", "c", "k"])

    return stored(src.mapInArrow(run, f"id {id_type}, n long, c long, k binary"), "jj-docs")


def frequent_codes(docs: DataFrame, text_col: str, width: int, total: int) -> np.ndarray:
    """Sorted 32-bit codes (top halves) of the shingles that many documents hold.

    Every shingle of every document is counted. A task sends its sorted codes to
    each bucket of the code space as gaps, in two 16-bit planes of which the
    upper is nearly empty, so a shingle costs about two bytes.
    """
    least = max(LEAST_FREQUENT, total // MAX_FREQUENT)
    buckets = 1
    while buckets * CODES_PER_BUCKET < total and buckets < 1 << 16:
        buckets *= 2
    shift = np.uint32(32 - int(np.log2(buckets)))

    def blocks(parts: list[np.ndarray]):
        codes = np.sort(np.concatenate(parts))
        bucket = (codes.astype(np.uint64) >> np.uint64(shift)).astype(np.int64)
        cut = np.flatnonzero(np.diff(bucket)) + 1
        names, gaps = [], []
        for part in np.split(codes, cut):
            g = np.diff(part, prepend=np.uint32(0)).astype("<u4")
            names.append(int(int(part[0]) >> int(shift)))
            gaps.append(g.view("<u2").reshape(-1, 2).T.tobytes())
        return pa.record_batch([pa.array(names, pa.int32()), pa.array(gaps, pa.binary())], names=["bucket", "gaps"])

    def run(batches):
        parts, size = [], 0
        for _, s in _texts(batches, width):
            parts.append((s >> np.uint64(32)).astype(np.uint32))
            size += len(s)
            if size >= 4 << 20:
                yield blocks(parts)
                parts, size = [], 0
        if size:
            yield blocks(parts)

    def count(group: pa.Table) -> pa.Table:
        parts = []
        for g in group.column("gaps"):
            planes = np.frombuffer(g.as_py(), "<u2").reshape(2, -1)
            parts.append(np.cumsum(planes[0] + (planes[1].astype(np.uint32) << np.uint32(16)), dtype=np.uint32))
        codes = np.sort(np.concatenate(parts))
        first = np.concatenate(([0], np.flatnonzero(np.diff(codes)) + 1))
        counts = np.diff(np.append(first, len(codes)))
        return pa.table({"code": pa.array(codes[first[counts >= least]].astype(np.int64))})

    src = docs.select(F.col(f"`{text_col}`").cast("binary"))
    found = src.mapInArrow(run, "bucket int, gaps binary").groupBy("bucket").applyInArrow(count, "code long")
    codes = found.toArrow().column("code").to_numpy()
    return np.sort(codes.astype(np.uint32))


def prefixes(docs: DataFrame, text_col: str, width: int, percent: int, frequent) -> DataFrame:
    """(t, c, n, own): the prefix elements of every class; own is its share of infrequent shingles, in 1/10000."""
    def run(batches):
        order, seen = frequent.value, set()
        for b in batches:
            t, c, n, own = [], [], [], []
            for _, s in _texts([b], width):
                if not len(s):
                    continue
                k = set_id(s)
                if k in seen:  # a copy within this task
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(k)
                p, few = _order(s, order)
                p = p[:len(s) - (percent * len(s) + 99) // 100 + 1]
                t.append(p.view(np.int64))
                c.append(np.full(len(p), k, np.int64))
                n.append(np.full(len(p), len(s), np.int32))
                own.append(np.full(len(p), 10_000 * few // len(s), np.int32))
            if t:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in (t, c, n, own)], names=["t", "c", "n", "own"])

    return docs.select(F.col(f"`{text_col}`").cast("binary")).mapInArrow(run, "t long, c long, n int, own int")


def sets_of(docs: DataFrame, id_col: str, text_col: str, width: int, ids: DataFrame) -> DataFrame:
    """(c, n, s) of the documents named in ``ids``; s is the sorted set as bytes."""
    need = sized(stored(ids.select(F.col("id").alias("_id")).distinct(), "jj-ids"))
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    src = src.join(need, F.col("id").eqNullSafe(F.col("_id")), "left_semi").select("text")

    def run(batches):
        seen = set()
        for b in batches:
            c, n, out = [], [], []
            for _, s in _texts([b], width):
                k = set_id(s)
                if not len(s) or k in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(k)
                c.append(k)
                n.append(len(s))
                out.append(s.tobytes())
            yield pa.record_batch([pa.array(c, pa.int64()), pa.array(n, pa.int32()), pa.array(out, pa.binary())],
                                  names=["c", "n", "s"])

    return src.mapInArrow(run, "c long, n int, s binary")


def _need(a: int, b: int, percent: int) -> int:
    """The least overlap of sets of sizes a and b with 100 * overlap >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def trie_probe(probe: np.ndarray, stored_sets: list[np.ndarray], percent: int) -> list[int]:
    """Overlap of ``probe`` with each stored set, or -1 where it cannot reach the threshold.

    The sets, visited in lexicographic order, are the trie's paths. ``over[d]``
    is the overlap of the current path's first d elements; a set resumes at the
    depth it shares with the last one. ``dead`` is a depth at which the current
    path was left: a set that shares it is tested on that node's bound alone.
    """
    out = [-1] * len(stored_sets)
    order = sorted(range(len(stored_sets)), key=lambda i: stored_sets[i].astype(">u8").tobytes())
    last, over, known = np.zeros(0, np.uint64), np.zeros(1, np.int64), 0
    total = len(probe)
    for i in order:
        s = stored_sets[i]
        need = _need(total, len(s), percent)
        m = min(len(s), known)
        differ = np.flatnonzero(s[:m] != last[:m])
        depth = int(differ[0]) if len(differ) else m
        path = np.empty(len(s) + 1, np.int64)
        path[:depth + 1] = over[:depth + 1]
        # elements of the probe not yet passed at this depth
        passed = int(np.searchsorted(probe, s[depth - 1], "right")) if depth else 0
        while depth < len(s) and path[depth] + min(len(s) - depth, total - passed) >= need:
            seg = s[depth:depth + 128]
            at = np.searchsorted(probe, seg)
            hit = probe[np.minimum(at, total - 1)] == seg
            path[depth + 1:depth + 1 + len(seg)] = path[depth] + np.cumsum(hit)
            depth += len(seg)
            passed = int(at[-1]) + int(hit[-1])
        if depth == len(s) and path[depth] >= need:
            out[i] = int(path[depth])
        last, over, known = s, path, depth
    return out


def sketched(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (a, b) whose sketches allow the threshold."""
    one = classes.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("k").alias("ka"))
    two = classes.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("k").alias("kb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ka", "kb")

    def run(batches):
        for b in batches:
            na, nb = b.column(2).to_pylist(), b.column(3).to_pylist()
            bits = lambda x: np.frombuffer(x.as_buffer(), np.uint8)
            keep = [may_reach(bits(ka), x, bits(kb), y, percent) for ka, x, kb, y in zip(b.column(4), na, b.column(5), nb)]
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


class Sketches:
    """The sketches of a block of classes by length, each length also folded once for shorter probes."""

    def __init__(self, rows: list[tuple]):
        self.by_length: dict[int, tuple] = {}
        groups: dict[int, list] = {}
        for row in rows:
            groups.setdefault(len(row[-1]), []).append(row)
        for length, part in groups.items():
            bits = np.stack([np.frombuffer(r[-1], np.uint8) for r in part])
            c, n, root = (np.array([r[i] for r in part], np.int64) for i in range(3))
            self.by_length[length] = (c, n, root, {length: bits})

    def meet(self, c: int, n: int, root: int, main: int, k: bytes, percent: int) -> np.ndarray:
        """The classes of other components that the probe may be similar to, by size and sketch."""
        out = []
        mine = {len(k): np.frombuffer(k, np.uint8)}
        for length, (cs, ns, roots, bits) in self.by_length.items():
            wanted = ((roots != root) & ((roots == main) | (cs > c))
                      & (100 * np.minimum(ns, n) >= percent * np.maximum(ns, n)))
            if not wanted.any():
                continue
            short = min(length, len(k))
            while short not in bits:
                least = bits[min(bits)]
                half = least.shape[1] // 2
                bits[half] = least[:, :half] ^ least[:, half:]
            while short not in mine:
                least = mine[min(mine)]
                mine[len(least) // 2] = least[:len(least) // 2] ^ least[len(least) // 2:]
            at = np.flatnonzero(wanted)
            differ = np.bitwise_count(bits[short][at] ^ mine[short]).sum(1, dtype=np.int64)
            both = ns[at] + n
            least_overlap = -(-percent * both // (100 + percent))
            out.append(cs[at[differ <= both - 2 * least_overlap]])
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def blocked(many: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of large groups that size and sketch allow, of different components.

    A group's members are dealt into blocks of about ``BLOCK``. Those outside
    the main component go to every block of their group and stream past it; the
    pairs they make are tested in place, and only those that pass leave the task.
    """
    kinds = classes.select(F.col("c").alias("kc"), "k")
    rows = many.join(kinds, F.col("c") == F.col("kc")).select("t", "c", F.col("n").cast("long").alias("n"), "root", "main", "size", "k")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    cols = ["t", "block", "kind", "c", "n", "root", "main", "k"]
    members = rows.withColumn("block", F.pmod(F.xxhash64("c"), blocks).cast("int")).withColumn("kind", F.lit(0))
    probes = rows.where("root <> main").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("kind", F.lit(1))
    n = int(many.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.select(cols).union(probes.select(cols)).repartition(n, "t", "block").sortWithinPartitions("t", "block", "kind", "c")

    def run(batches):
        now, held, block = None, [], None
        for b in batches:
            one, two = [], []
            for t, at, kind, c, size, root, main, k in zip(*(b.column(i).to_pylist() for i in range(8))):
                if (t, at) != now:
                    now, held, block = (t, at), [], None
                if kind == 0:
                    held.append((c, size, root, k))
                    continue
                block = block or Sketches(held)
                found = block.meet(c, size, root, main, k, percent)
                one.append(np.minimum(found, c))
                two.append(np.maximum(found, c))
            empty = [np.zeros(0, np.int64)]
            yield pa.record_batch([pa.array(np.concatenate(one or empty)), pa.array(np.concatenate(two or empty))], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, width: int,
             percent: int) -> DataFrame:
    """(a, b, overlap) of the candidate pairs (a, b), a stored table, that reach the threshold."""
    ids = pairs.select("a").union(pairs.select("b")).distinct().join(classes, F.col("a") == F.col("c")).select("id")
    return compared(pairs, stored(sets_of(docs, id_col, text_col, width, ids), "jj-sets"), percent)


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The trie join proper.

    A probe a meets the sets of its partners in salted blocks; a block streams
    through its task behind its probe, a few hundred sets in the trie at a time.
    """
    p = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    probes = p.select("a", "salt").distinct().join(sets, F.col("a") == F.col("c")).select(
        "a", "salt", F.lit(None).cast("long").alias("b"), "s")
    partners = p.join(sets, F.col("b") == F.col("c")).select("a", "salt", "b", "s")
    rows = probes.union(partners)
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def run(batches):
        key, probe, names, held = None, None, [], []

        def flush():
            over = trie_probe(probe, held, percent) if held and probe is not None else []
            found = [(key[0], b, o) for b, o in zip(names, over) if o >= 0]
            names.clear()
            held.clear()
            return found

        for batch in batches:
            out = []
            for a, salt, b, s in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                s = np.frombuffer(s.as_py(), np.uint64)
                if (a, salt) != key:
                    out += flush()
                    key, probe = (a, salt), None
                if b is None:
                    probe = s
                else:
                    names.append(b)
                    held.append(s)
                    if len(held) >= 512:
                        out += flush()
            yield pa.record_batch([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["a", "b", "overlap"])
        out = flush()
        yield pa.record_batch([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["a", "b", "overlap"])

    return rows.mapInArrow(run, "a long, b long, overlap long")


def _near(x: str, y: str, percent: int) -> Column:
    return F.lit(100) * F.least(x, y) >= F.lit(percent) * F.greatest(x, y)


def links(docs: DataFrame, docs_of: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(a, b, overlap) between classes: enough links that no two linked classes stay apart."""
    spark = docs.sparkSession
    total = docs_of.agg(F.sum("n")).first()[0] or 0
    frequent = spark.sparkContext.broadcast(frequent_codes(docs, text_col, width, total))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = prefixes(docs, text_col, width, percent, frequent).repartition(parts, "t")
    # the leader is the class with the least of its own: the original among its altered copies
    lead = rows.groupBy("t").agg(F.min(F.struct("own", "c", "n")).alias("lead"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    lead = lead.where("lo < hi").select(F.col("t").alias("lt"), F.col("lead.c").alias("lc"), F.col("lead.n").alias("ln"))
    # both sides read all columns of the rows, so that one exchange serves both
    shared = stored(rows.join(lead, F.col("t") == F.col("lt")).select("t", "c", "n", "own", "lc", "ln"), "jj-shared")

    classes = stored(docs_of.where("c is not null").groupBy("c").agg(
        F.min("id").alias("id"), F.max("n").alias("n"), F.first("k").alias("k")), "jj-classes")
    compare = lambda pairs: verified(pairs, docs, classes, id_col, text_col, width, percent)

    # every class against the leaders of its elements
    to_leader = stored(shared.where("c <> lc").where(_near("n", "ln", percent)).select(
        F.col("lc").alias("a"), F.col("c").alias("b")).distinct(), "jj-leaders")
    first = stored(compare(stored(sketched(to_leader, classes, percent), "jj-pairs")), "jj-links")
    roots = stored(components(first, "a", "b"), "jj-roots")

    # What is left: elements whose classes are in several components. A group's
    # main component needs no pairs within; everyone else meets everyone. Small
    # groups meet in a join, large ones in blocks that give out survivors only.
    at = shared.select("t", "c", "n").distinct().join(roots, F.col("c") == F.col("node"), "left").select(
        "t", "c", "n", F.coalesce("root", "c").alias("root"))
    at = stored(at, "jj-rooted")
    main = at.groupBy("t", "root").agg(F.count(F.lit(1)).alias("k")).groupBy("t").agg(
        F.max(F.struct("k", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("roots"), F.sum("k").alias("size"))
    main = main.where("roots > 1").select(F.col("t").alias("mt"), "main", "size")
    many = stored(at.join(main, F.col("t") == F.col("mt")).drop("mt"), "jj-many")
    few = many.where("root <> main").where(F.col("size") <= SMALL_GROUP).select(
        F.col("t").alias("t2"), F.col("c").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"))
    others = many.where(F.col("size") <= SMALL_GROUP).select("t", F.col("c").alias("b"), "n", "root", "main")
    cross = few.join(others, (F.col("t") == F.col("t2")) & (F.col("ra") != F.col("root"))
                     & ((F.col("root") == F.col("main")) | (F.col("a") < F.col("b"))) & _near("na", "n", percent))
    cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    cross = sketched(cross, classes, percent).union(blocked(many.where(F.col("size") > SMALL_GROUP), classes, percent)).distinct()
    tried = to_leader.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct()
    cross = cross.join(tried, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left_anti")
    return stored(first.union(compare(stored(cross, "jj-cross"))), "jj-all")


def join_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                 percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(id, n, c) per document, and (node, root) of the classes that are linked with another."""
    docs_of = assigned(docs, id_col, text_col, width)
    return docs_of, stored(components(links(docs, docs_of, id_col, text_col, width, percent), "a", "b"), "jj-roots")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, n_shingles, class_id, component_id) of every document."""
    docs_of, roots = join_classes(docs, id_col, text_col, width, percent)
    least = docs_of.where("c is not null").groupBy("c").agg(F.min("id").alias("least"))
    rooted = least.join(roots, F.col("c") == F.col("node"), "left").select("c", "least", F.coalesce("root", "c").alias("root"))
    rooted = stored(rooted, "jj-classes")
    linked = rooted.join(roots.select(F.col("root").alias("r")).distinct(), F.col("root") == F.col("r"), "left_semi")
    top = linked.groupBy("root").agg(F.min("least").alias("top")).withColumnRenamed("root", "r")
    classes = rooted.join(top, F.col("root") == F.col("r"), "left").select(
        F.col("c").alias("of"), F.coalesce("top", "least").alias("component_id"))
    out = docs_of.select("id", "n", "c").join(classes, F.col("c") == F.col("of"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("c").alias("class_id"),
                      F.when(F.col("c").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def _with_class(docs: DataFrame, text_col: str, width: int, name: str) -> DataFrame:
    """``docs`` and each row's class id (null for the empty set)."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            c = [set_id(s) if len(s) else None for _, s in _texts([pa.record_batch([b.column(at).cast(pa.binary())], names=["t"])], width)]
            yield pa.record_batch([*b.columns, pa.array(c, pa.int64())], schema=pa.schema([*b.schema, pa.field(name, pa.int64())]))

    return docs.mapInArrow(run, schema)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, one of each component (the least id), with exactly its columns.

    Of repeated rows one stays; rows with the empty set all stay. The kept rows
    are found by id and class, which a last pass over the texts computes again,
    so the texts are neither copied nor, up to a checked number of kept rows,
    shuffled.
    """
    docs_of, roots = join_classes(docs, id_col, text_col, width, percent)
    rows = docs_of.where("c is not null").groupBy("c", "id").agg(F.count(F.lit(1)).alias("rows"))
    rooted = rows.join(roots, F.col("c") == F.col("node"), "left").withColumn("root", F.coalesce("root", "c"))
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "c", "rows")).alias("x"))
    kept = stored(first.select(F.col("x.id").alias("_kid"), F.col("x.c").alias("_kc"), F.col("x.rows").alias("_rows")), "jj-kept")
    name = "_class"
    while name in docs.columns:
        name += "_"
    held = docs.columns
    found = _with_class(docs, text_col, width, name).select(F.struct(*[F.col(f"`{c}`") for c in held]).alias("_row"), F.col(f"`{name}`").alias("_c"))
    found = found.join(sized(kept), (F.col("_c") == F.col("_kc")) & F.col("_row")[id_col].eqNullSafe(F.col("_kid")), "left")
    if not kept.where("_rows > 1").limit(1).count():
        return found.where("_c is null or _kc is not null").select("_row.*")
    once = found.where("_c is null or _rows = 1").select("_row")
    more = found.where("_rows > 1").dropDuplicates(["_kc"]).select("_row")
    return once.union(more).select("_row.*")

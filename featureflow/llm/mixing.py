"""Mixing sources to target weights by Pareto order sampling.

A document's ideal number of copies is its importance times a level of its
source, at most ``max_copies``; the level is set so that the ideal copies of a
source hold its target. The whole part is allocated for certain. For the rest,
documents are ranked by random odds over inclusion odds, u/(1-u) * (1-p)/p, and
the lowest ranks are taken up to a fixed size: the source's remaining words.
DataFrame functions only.

Defined cases: null text has size 0; null source is a source of its own, last
in order; documents of size 0 are never drawn; a null id takes part with a fixed
random number; an empty table gives an empty table; repeated rows take part one
by one; columns beside id, text, source and importance are not looked at. An
importance that is null, NaN, infinite or not above 0 is never drawn; others are cut to
five significant bits (whole numbers to 31 stay), so a source has a bounded
number of them, however many documents it has.
Random numbers come from a digest of the id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import sized, stored, words

MAX_COPIES = 3
# Ranks fall in this many coarse, then as many fine buckets.
BUCKETS = 4096


def targets(sizes: DataFrame, weights: Column, max_copies: int = MAX_COPIES) -> DataFrame:
    """Adds ``target`` to (source, source_size), one row per source.

    Targets share the total size by weight, none above ``max_copies`` times its
    source; the excess is shared again by weight. The fixed point is
    min(cap, level * weight): going up by cap/weight, a source is capped when
    what is left for it and the later ones, by weight, reaches its cap. One row
    per source, so the global window sorts the list of weights, never documents.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    t = sizes.withColumn("_i", F.row_number().over(order)).withColumn("_w", weights.cast("double"))
    t = t.withColumn("_cap", F.lit(max_copies) * F.col("source_size").cast("double"))
    upto = Window.orderBy(F.col("_cap") / F.col("_w"), "_i").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum(F.col("source_size").cast("double")).over(rest) - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))
    weight = F.sum("_w").over(rest) - F.coalesce(F.sum("_w").over(upto), F.lit(0.0))
    t = t.withColumn("_level", left / weight)
    t = t.withColumn("_capped", F.col("_cap") <= F.col("_level") * F.col("_w"))
    level = F.min(F.when(~F.col("_capped"), F.struct(F.col("_cap") / F.col("_w"), "_i", "_level"))).over(rest)["_level"]
    return t.select("source", "source_size",
                    F.when(F.col("_capped"), F.col("_cap")).otherwise(level * F.col("_w")).alias("target"))


def cyclic_weights(n: int = 3) -> Column:
    """1, 2, .. n, repeating in the order of the sources."""
    return F.pmod(F.col("_i") - 1, F.lit(n)) + 1


def by_length(text: Column) -> Column:
    """An importance that grows with the length: the binary digits of the number of words."""
    return F.length(F.bin(F.size(words(text)).cast("long")))


def graded(importance: Column) -> Column:
    """``importance`` cut to five significant bits; 0 where it is no positive number."""
    x = importance.cast("double")
    octave = F.pow(F.lit(2.0), F.floor(F.log2(x)))
    cut = F.floor(x / octave * 16) / 16 * octave
    return F.when((x > 0) & (x < float("inf")) & ~F.isnan(x), cut).otherwise(0.0)


def levels(rows: DataFrame, t: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, level): copies per unit of importance, null where every document gets ``max_copies``.

    From the largest importance down, one is capped when the level that the rest
    of the target gives it and the smaller ones reaches ``max_copies``. One row per source and
    importance (``graded``: bounded) enters the windows, after a map-side sum.
    """
    g = rows.where("_imp > 0").groupBy("source", "_imp").agg(F.sum("size").cast("double").alias("_words"))
    g = g.join(t.select(F.col("source").alias("_s"), "target"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    down = Window.partitionBy("source").orderBy(F.col("_imp").desc())
    before = F.coalesce(F.sum("_words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(F.col("_imp") * F.col("_words")).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    g = g.withColumn("_level", F.when(rest > 0, (F.col("target") - F.lit(max_copies) * before) / rest))
    free = F.col("_level") * F.col("_imp") < max_copies
    return g.groupBy("source").agg(F.max(F.when(free, F.struct("_imp", "_level")))["_level"].alias("level"))


def uniform(id_col: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from the id: 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 52))


def plan_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Column | None = None, importance: Column | None = None, seed: str = "mix",
                max_copies: int = MAX_COPIES, keep: Column | None = None) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken), and ``_keep`` if asked for.

    Sizes are counted once and written to the shared folder. The cut in each
    source's order is found by sums of words per bucket of ranks: coarse over
    all rows, fine over the bucket that holds the cut, then row by row in one
    fine bucket. So no source is ever sorted as a whole.
    """
    kept = [keep.alias("_keep")] if keep is not None else []
    imp = importance if importance is not None else F.lit(1.0)
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                              F.size(words(F.col(text_col))).cast("long").alias("size"),
                              uniform(F.col(id_col), seed).alias("_u"), graded(imp).alias("_imp"),
                              F.monotonically_increasing_id().alias("_row"), *kept), "mix")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = stored(targets(sums, weights if weights is not None else cyclic_weights(), max_copies), "mix-targets")
    level = levels(rows, sized(t), max_copies)
    t = t.withColumnRenamed("source", "_s").join(level.withColumnRenamed("source", "_s2"), F.col("_s").eqNullSafe(F.col("_s2")), "left").drop("_s2")
    t = sized(stored(t, "mix-levels"))

    d = rows.join(t, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    ideal = F.least(F.lit(float(max_copies)), F.col("level") * F.col("_imp"))  # the least of what is not null
    d = d.withColumn("_ideal", F.when(F.col("_imp") > 0, ideal).otherwise(0.0)).withColumn("_sure", F.floor("_ideal"))
    p = F.col("_ideal") - F.col("_sure")
    rank = (F.col("_u") / (1 - F.col("_u"))) * ((1 - p) / p)
    drawn = (p > 0) & (F.col("size") > 0)
    d = d.withColumn("_q", F.when(drawn, rank))
    # rank/(1+rank) is monotone in the rank and lies between 0 and 1
    at = F.col("_q") / (1 + F.col("_q")) * F.lit(float(BUCKETS * BUCKETS))
    fine = F.least(F.floor(at), F.lit(BUCKETS * BUCKETS - 1)).cast("long")
    d = d.withColumn("_fine", fine).withColumn("_coarse", F.floor(F.col("_fine") / BUCKETS).cast("int"))

    need = d.groupBy("source").agg(F.sum(F.col("_sure") * F.col("size")).alias("_certain"),
                                   F.first("target").alias("_target"))
    need = stored(need.select(F.col("source").alias("_s"), (F.col("_target") - F.col("_certain")).alias("_need")), "mix-need")
    need = sized(need)

    def cut(level: DataFrame, by: str) -> DataFrame:
        """The bucket in which the running sum of words passes the need, and the sum before it."""
        before = F.sum("_words").over(Window.partitionBy("source").orderBy(by)) - F.col("_words")
        b = level.groupBy("source", by).agg(F.sum("size").alias("_words")).withColumn("_before", before)
        return b

    coarse = cut(d.where("_q is not null"), "_coarse").join(need, F.col("source").eqNullSafe(F.col("_s")))
    edge = coarse.where((F.col("_before") < F.col("_need")) & (F.col("_before") + F.col("_words") >= F.col("_need")))
    edge = sized(stored(edge.select("_s", "_need", F.col("_coarse").alias("_edge"), F.col("_before").alias("_b1")), "mix-cut"))
    inside = d.where("_q is not null").join(edge, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_coarse") == F.col("_edge")))
    fines = cut(inside, "_fine").withColumnRenamed("_before", "_b2")
    fines = fines.join(edge, F.col("source").eqNullSafe(F.col("_s")))
    total = F.col("_b1") + F.col("_b2")
    fedge = fines.where((total < F.col("_need")) & (total + F.col("_words") >= F.col("_need")))
    fedge = sized(stored(fedge.select("_s", "_need", F.col("_fine").alias("_fedge"), total.alias("_b3")), "mix-fine"))
    last = d.where("_q is not null").join(fedge, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_fine") == F.col("_fedge")))
    # repeated rows of one id tie: they are counted, and as many taken as bring the sum nearest to the need
    ties = last.groupBy("source", "_fedge", "_need", "_b3", "_q", "id", "size").agg(F.count(F.lit(1)).alias("_n"))
    by_tie = Window.partitionBy("source").orderBy("_q", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ties = ties.withColumn("_before", F.col("_b3") + F.coalesce(F.sum(F.col("_n") * F.col("size")).over(by_tie), F.lit(0)))
    # the row at the cut goes to the nearer side
    ties = ties.where(F.col("_before") + F.col("size") / 2 <= F.col("_need"))
    fit = F.floor((F.col("_need") - F.col("_before")) / F.col("size") + 0.5)
    ties = ties.withColumn("_take", F.least("_n", F.greatest(F.lit(1), fit)).cast("long"))
    top = ties.groupBy("source").agg(F.max(F.struct("_q", "id", "size", "_take")).alias("_t"))
    top = sized(stored(top.select(F.col("source").alias("_s2"), "_t"), "mix-tie"))
    # the last row taken of the tie at the cut, by counts per task that wrote rows, then row by row in one task's
    tied = last.join(top, F.col("source").eqNullSafe(F.col("_s2"))
                     & F.col("id").eqNullSafe(F.col("_t.id"))
                     & (F.col("_q") == F.col("_t._q")) & (F.col("size") == F.col("_t.size")))
    tied = tied.select("_s2", "_t", "_row", F.shiftright("_row", 33).alias("_part"))
    parts = tied.groupBy("_s2", "_t", "_part").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.withColumn("_upto", F.sum("_n").over(Window.partitionBy("_s2").orderBy("_part")))
    parts = parts.where((F.col("_upto") >= F.col("_t._take")) & (F.col("_upto") - F.col("_n") < F.col("_t._take")))
    parts = parts.select(F.col("_s2").alias("_s3"), F.col("_part").alias("_p3"), (F.col("_t._take") - F.col("_upto") + F.col("_n")).alias("_nth"))
    tied = tied.join(sized(stored(parts, "mix-part")), F.col("_s2").eqNullSafe(F.col("_s3")) & (F.col("_part") == F.col("_p3")))
    tied = tied.withColumn("_i", F.row_number().over(Window.partitionBy("_s2").orderBy("_row"))).where("_i = _nth")
    cut_row = tied.select("_s2", F.struct("_t._q", "_t.id", "_t.size", "_row").alias("_last"))
    top = sized(stored(fedge.join(cut_row, F.col("_s").eqNullSafe(F.col("_s2")), "left")
                       .select("_s", "_fedge", "_last"), "mix-edge"))
    # what a source draws: ranks before the fine bucket, and in it up to the last row taken;
    # a source whose ranked words never reach its need draws all of them
    whole = need.select(F.col("_s").alias("_n"), "_need")
    d = d.join(top, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    d = d.join(whole, F.col("source").eqNullSafe(F.col("_n")), "left").drop("_n")
    here = F.struct("_q", "id", "size", "_row")
    inside_cut = (F.col("_fine") < F.col("_fedge")) | ((F.col("_fine") == F.col("_fedge")) & F.coalesce(here <= F.col("_last"), F.lit(False)))
    taken = F.col("_q").isNotNull() & (F.col("_need") > 0) & F.coalesce(inside_cut, F.lit(True))
    copies = (F.col("_sure") + taken.cast("int")).cast("int")
    return d.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                    copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
                    *(["_keep"] if keep is not None else []))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the plan takes it, with exactly its columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    planned = plan_copies(docs, keep=row, **options)
    return (planned.where("copies > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("_keep.*"))

"""Host-level quality rules.

Each document is measured against cheap text rules. The failures of a host's
documents are counted rule by rule, each rate is shrunk towards the corpus by
an empirical beta prior of its rule, and the host's verdict is joined back to its
documents: a host goes when it is all but certain that most of its documents
break one rule. DataFrame functions only.

The rules: ``base`` (too few words, or too many repeated ones), which rejects the
document itself too; ``symbols`` (markup characters to words), ``lines`` (share of
lines that are copies) and ``letters`` (words of too few code points on average),
which a clean document may break now and then, so they judge hosts only.

Defined cases: null text has no words; a text below the minimum length fails;
a text without words breaks the base rule and no other;
a document without a host (null) gets no host verdict, so its own rules decide;
an empty table gives an empty table; repeated rows are measured one by one;
columns beside id, text and host are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import sized, stored, words

SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8


@dataclass(frozen=True)
class HostRules:
    min_words: int = 20
    max_repeat_pct: int = 30
    # Of 100 words, symbols; of 100 lines, copies; of 100 words, the least code points.
    max_symbol_pct: int = 10
    max_dup_line_pct: int = 30
    min_word_chars_pct: int = 300
    # A host goes when the posterior mean of a rule's failure rate, less this many deviations, is above the rate.
    max_host_rate: float = 0.5
    deviations: float = 2.0
    # Bounds of the prior's strength, in documents.
    min_strength: float = 2.0
    max_strength: float = 1e6


MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def measured(docs: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` plus the text measures, row by row and without a shuffle.

    Repeated words: a window is the 64-bit hash of its 8 word hashes. Only texts
    with a repeated window sort (hash, position); every marked window then
    covers 8 words, less where the next marked one starts earlier. That is
    n log n in the text's length however often windows repeat.
    """
    names = [f"_k{i}" for i in range(len(keep))]
    body = F.coalesce(text, F.lit(""))
    d = docs.select(*[c.alias(n) for c, n in zip(keep, names)], body.alias("_t"))
    d = d.select(*names, "_t", words(F.col("_t")).alias("_w"),
                 F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    d = d.select(*names, F.size("_w").cast("long").alias("n_words"),
                 F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                 (F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                 F.size("_l").cast("long").alias("n_lines"),
                 (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                 F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"))
    done = [*names, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    d = d.select(*done, F.when(
        F.size("_h") >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW),
                    lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)]))).alias("_g"))
    d = d.select(*done, F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.array_sort(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
    same = lambda e, k: F.get("_s", k)["h"].eqNullSafe(e["h"])
    d = d.select(*done, F.array_sort(F.transform(
        F.filter("_s", lambda e, k: same(e, k - 1) | same(e, k + 1)), lambda e: e["i"])).alias("_p"))
    gap = lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - x, F.lit(WINDOW)))
    covered = F.aggregate(F.transform("_p", gap), F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select(*names, *done[len(names):], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed(rules: HostRules) -> Column:
    return ((F.col("n_words") < rules.min_words)
            | (F.lit(100) * F.col("n_repeat_words") > F.lit(rules.max_repeat_pct) * F.col("n_words")))


def broken(rules: HostRules) -> dict[str, Column]:
    """The rules that hosts are judged by, each as a condition over the measures."""
    hundred = F.lit(100)
    return {
        "base": base_failed(rules),
        "symbols": (F.col("n_words") > 0) & (hundred * F.col("n_symbols") > F.lit(rules.max_symbol_pct) * F.col("n_words")),
        "lines": hundred * F.col("n_dup_lines") > F.lit(rules.max_dup_line_pct) * F.col("n_lines"),
        "letters": hundred * F.col("word_chars") < F.lit(rules.min_word_chars_pct) * F.col("n_words"),
    }


def flags(rules: HostRules) -> list[Column]:
    return [c.alias(f"_bad_{r}") for r, c in broken(rules).items()]


def host_verdicts(rows: DataFrame, host: str, rules: HostRules) -> DataFrame:
    """(host, n, host_rate, host_rejected, host_rule) from rows with a host and the ``flags``.

    A rule's prior: mean and second moment are averaged over hosts with at least two
    documents (m/n and m(m-1)/(n(n-1)) are unbiased for p and p^2), which gives
    the beta strength s = (mean - second) / (second - mean^2). Only these averages,
    two a rule, reach the driver. ``host_rate`` is the posterior mean of the rule
    whose lower bound is highest, ``host_rule`` its name.
    """
    names = list(broken(rules))
    hosts = rows.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"_bad_{r}").cast("long")).alias(f"m_{r}") for r in names])
    hosts = stored(hosts, "rules-counts")
    n = F.col("n").cast("double")

    def m(r: str) -> Column:
        return F.col(f"m_{r}").cast("double")

    two = hosts.where("n >= 2").agg(*[F.avg(m(r) / n).alias(f"mean_{r}") for r in names],
                                    *[F.avg(m(r) * (m(r) - 1) / (n * (n - 1))).alias(f"second_{r}") for r in names]).first()
    bounds = []
    for i, r in enumerate(names):
        mean, second = two[f"mean_{r}"] or 0.0, two[f"second_{r}"] or 0.0
        spread = second - mean * mean
        strength = rules.max_strength if spread <= 0 else (mean - second) / spread
        strength = min(max(strength, rules.min_strength), rules.max_strength)
        size = n + F.lit(strength)
        rate = (m(r) + F.lit(strength * mean)) / size
        deviation = F.sqrt(F.greatest(rate * (1 - rate), F.lit(0.0)) / (size + 1))
        bounds.append(F.struct((rate - F.lit(rules.deviations) * deviation).alias("low"), F.lit(-i).alias("i"),
                               rate.alias("rate"), F.lit(r).alias("rule")))
    worst = hosts.select(F.col(host).alias("host"), "n", F.greatest(*bounds).alias("_w"))
    bad = F.col("_w.low") > F.lit(rules.max_host_rate)
    return worst.select("host", "n", F.col("_w.rate").alias("host_rate"), bad.alias("host_rejected"),
                        F.when(bad, F.col("_w.rule")).alias("host_rule"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          rules: HostRules = HostRules()) -> DataFrame:
    """(id, measures, base_failed, host_rate, host_rejected, host_rule, kept), one row per input row.

    The measures are written once to the shared folder; hosts are counted with a
    map-side combine and joined back on the host: by broadcast up to a checked
    number of hosts, so that a hot host moves no documents, else by a shuffle.
    """
    rows = measured(docs, F.col(text_col), [F.col(id_col), F.col(host_col)])
    rows = stored(rows, "rules").withColumn("base_failed", base_failed(rules))
    verdicts = sized(stored(host_verdicts(rows.select("_k1", *flags(rules)), "_k1", rules), "rules-hosts"))
    out = rows.join(verdicts, F.col("_k1") == F.col("host"), "left")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return out.select(F.col("_k0").alias(id_col), *MEASURES, "base_failed", "host_rate",
                      rejected.alias("host_rejected"), "host_rule", (~F.col("base_failed") & ~rejected).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source",
              rules: HostRules = HostRules()) -> DataFrame:
    """The rows of ``docs`` that pass, with exactly its columns (any names).

    The texts are measured twice, once for the hosts' counts and once to filter,
    rather than written out in between.
    """
    text, host = F.col(f"`{text_col}`"), F.col(f"`{host_col}`")
    counted = measured(docs, text, [host]).select("_k0", *flags(rules))
    verdicts = host_verdicts(counted, "_k0", rules)
    bad = sized(stored(verdicts.where("host_rejected").select("host"), "rules-hosts"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # the flag's row number keeps the filter above the measures: pushed below, it would compute them many times over
    flag = (base_failed(rules) & (F.monotonically_increasing_id() >= 0)).alias("_failed")
    rows = measured(docs, text, [row, host]).select("_k0", "_k1", flag).where(~F.col("_failed"))
    return rows.join(bad, F.col("_k1") == F.col("host"), "left_anti").select("_k0.*")

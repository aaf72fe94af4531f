"""License scans: MinHash bands retrieve templates, exact containment verifies them.

Words are runs of anything but ASCII blanks, control characters and
punctuation, in lower case; a shingle is ``WIDTH`` of them. A text is cut into overlapping windows as long as a template, and a
window's MinHash signature is banded: it retrieves the templates that share a
band. A retrieved template is reported if the window, with a margin, holds
enough of its shingles. Part of these may stand in the margin alone, so the
window itself can be far less similar; the bands of a template's length are as
many as make the least similar such window (``least_similar``) collide with a
chance of ``SURE`` at least.

A window can share a band only if it holds the shingle that gave the template's
value, so windows are cut only around such shingles; no collision is lost by
that. Windows start on a grid of an eighth of their length. DataFrame functions
only; nothing is shuffled but the hits. Shingles are compared by 64-bit hashes.

Defined cases: null or empty texts have no hits and no row; a template with
fewer words than a shingle is refused; a template in a text many times gives one
row, with the best containment and the first place; rows with one id are taken
together, null ids too; an empty table gives an empty table; other columns are
not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import sized, stored

WIDTH = 2
ROWS = 1
SURE = 0.999
CONTAINED = 0.85

# Wordings of common license notices.
NOTICES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met:",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                      "and associated documentation files, to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def grid(n: int) -> int:
    """Shingles between the starts of windows of ``n``; also the margin on either side."""
    return max(1, n // 8)


def least_similar(n: int, contained: float = CONTAINED) -> float:
    """The least Jaccard similarity to a template of ``n`` shingles of a window that holds ``contained`` of it with its margins."""
    inside = max(1, math.ceil(contained * n) - 2 * grid(n))
    return inside / (2 * n - inside)


def bands_needed(similar: float, rows: int = ROWS, sure: float = SURE) -> int:
    """Bands of ``rows`` values for which a pair of this similarity collides with chance ``sure``."""
    return math.ceil(math.log(1 - sure) / math.log(1 - similar ** rows)) if similar < 1 else 1


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the shingles of a text in order."""
    w = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-/:-@\[-`{-\x7F]+", -1), "")
    at = lambda a: F.when(F.size(a) >= width, F.transform(
        F.sequence(F.lit(0), F.size(a) - width), lambda i: F.xxhash64(*[F.get(a, i + k) for k in range(width)]))
    ).otherwise(F.array().cast("array<bigint>"))
    return F.element_at(F.transform(F.array(w), at), 1)  # binds the words once


def signature(shingles: Column, values: int) -> Column:
    """The least hash of a set of shingles under each of ``values`` hash functions."""
    least = lambda p: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, F.lit(p))))
    return F.array(*[least(p) for p in range(values)])


def band_keys(signature_col: Column, bands: int, rows: int = ROWS) -> Column:
    bind = lambda s: F.array(*[F.xxhash64(F.lit(b), *[F.get(s, b * rows + r) for r in range(rows)]) for b in range(bands)])
    return F.element_at(F.transform(F.array(signature_col), bind), 1)


def notices(spark) -> DataFrame:
    """(license, text) of the built-in wordings."""
    rows = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in NOTICES.items()])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.license", "r.text")


def scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         contained: float = CONTAINED) -> DataFrame:
    """(id, license, containment, first_shingle, n_windows) of the templates found in each document.

    ``templates`` has the columns license and text. It is a list of wordings:
    the values of their signatures stand in the plan as literals.
    """
    t = templates.select("license", shingle_hashes(F.col("text")).alias("h")).withColumn("n", F.size("h"))
    t = stored(t, "license-words")
    if t.where("n = 0").limit(1).count():
        raise ValueError(f"a template has fewer than {WIDTH} words")
    bands = {r["n"]: bands_needed(least_similar(r["n"], contained)) for r in t.select("n").distinct().collect()}
    lengths, most = sorted(bands), max(bands.values(), default=1)
    t = stored(t.withColumn("sig", signature(F.col("h"), most * ROWS)), "license-templates")
    used = F.lit(0)
    for n, b in bands.items():
        used = F.when(F.col("n") == n, F.lit(b * ROWS)).otherwise(used)
    least = t.select("h", F.posexplode(F.slice("sig", F.lit(1), used)).alias("p", "v"))
    least = least.select(F.explode(F.filter("h", lambda x: F.xxhash64(x, F.col("p")) == F.col("v"))).alias("x"))
    marks = sorted(r["x"] for r in least.distinct().collect())

    d = docs.select(F.col(f"`{id_col}`").alias("id"), shingle_hashes(F.col(f"`{text_col}`")).alias("h"))
    spots = F.filter(F.transform("h", lambda x, i: F.when(x.isin(marks), i)), lambda i: i.isNotNull())
    d = d.withColumn("spots", spots).where(F.size("spots") > 0) if marks else d.withColumn("spots", F.array().cast("array<int>")).limit(0)

    def windows(n: int) -> Column:
        """The windows of n shingles that hold a spot: start, slice with margin, band keys."""
        step = grid(n)
        first = lambda i: F.greatest(F.lit(0), F.ceil((i - (n - 1)) / F.lit(step)).cast("int") * step)
        last = lambda i: F.floor(i / F.lit(step)).cast("int") * step
        starts = F.array_distinct(F.flatten(F.transform("spots", lambda i: F.sequence(
            F.least(first(i), last(i)), last(i), F.lit(step)))))
        return F.transform(starts, lambda s: F.struct(
            F.lit(n).alias("n"), s.alias("start"),
            F.slice("h", F.greatest(F.lit(1), s + 1 - step), F.lit(n + 2 * step)).alias("near"),
            band_keys(signature(F.slice("h", s + 1, F.lit(n)), bands[n] * ROWS), bands[n]).alias("keys")))

    w = d.select("id", F.explode(F.concat(*[windows(n) for n in lengths])).alias("w")) if lengths else \
        d.select("id", F.lit(None).cast("struct<n:int,start:int,near:array<bigint>,keys:array<bigint>>").alias("w"))
    w = w.select("id", "w.n", "w.start", "w.near", F.posexplode("w.keys").alias("band", "key"))
    b = t.select("license", "h", F.col("n").alias("tn"), F.posexplode(band_keys(F.col("sig"), most)).alias("tband", "tkey"))
    hits = w.join(sized(b), (F.col("n") == F.col("tn")) & (F.col("band") == F.col("tband")) & (F.col("key") == F.col("tkey")))
    distinct = F.array_distinct("h")
    hits = hits.withColumn("containment", F.size(F.array_intersect(distinct, F.col("near"))) / F.size(distinct))
    found = hits.where(F.col("containment") >= contained).groupBy("id", "license").agg(
        F.max("containment").alias("containment"), F.min("start").cast("long").alias("first_shingle"),
        F.count_distinct("start").alias("n_windows"))
    return found.withColumnRenamed("id", id_col)

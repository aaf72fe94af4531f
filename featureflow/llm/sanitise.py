"""Information-theoretic sanitisation of personal data.

Four kinds are found by their form: e-mail addresses, IP addresses, card
numbers (Luhn) and phone numbers. Their values are the protected entities. A
word near an entity can give it away even when the entity itself is blotted
out; how much it does is estimated from the corpus. With document frequencies n
over N documents, an entity e holds log2(N / n(e)) bits, and a term t in its
neighbourhood tells PMI(t, e) = log2(N n(e, t) / (n(e) n(t))) of them. The
share PMI / bits is the term's disclosure: 1 if the term never occurs without
the entity, about 0 if it occurs as if by chance. Terms from ``GENERALISED`` on
are replaced by their class (name, number or word), from ``REMOVED`` on they
are removed.

Two words that meet in copies of one text prove nothing, so a pair needs
``LEAST_CONTEXTS`` independent contexts: of the two words on either side of the
term, a further context must share none, each at its place, with the commonest
context. Copies, and copies with single words altered, add nothing.

Scale: texts are read twice, once for the entities and their neighbourhoods
(at most 2 x ``WINDOW`` words each), once for document frequencies, counted in
each task before they are shuffled. Texts are never shuffled; the joins are on
(entity, term) and on the number of the row.

Defined cases: null text is empty and has no spans; any id (null, repeated) is
passed through, every row on its own; an empty table gives an empty table; of
overlapping kinds each is kept; other columns are not looked at. Every scan is
linear in the text, whatever it holds.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import sized, stored, workers_import

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
WINDOW = 10  # words on either side of an entity
LEAST_LETTERS = 3
LEAST_CONTEXTS = 3
GENERALISED = 0.8
REMOVED = 0.95
FLUSH = 200_000
HITS = 20_000  # neighbourhood rows handed on at once

# The forms of the four kinds.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match begins where its first run of digits does, so no start inside a run is tried
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses from the left, none overlapping: each ``@`` takes the run before it and the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, normal form of the value) of the four kinds, in order."""
    out = [(a, 0, b, text[a:b].lower()) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            out.append((m.start(), 1, m.end(), ".".join(p.lstrip("0") or "0" for p in m.group().split("."))))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), digits))
    for m in _PHONE.finditer(text):
        digits = "".join(c for c in m.group() if c.isdigit())
        if 10 <= len(digits) <= 15:
            out.append((m.start(), 3, m.end(), digits))
    return sorted(out)


def _bare(word: str) -> tuple[int, str]:
    """Where a word's letters and digits begin, and the word without what stands around them."""
    if word.isalnum():
        return 0, word
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return a, word[a:b]


def terms_of(text: str) -> set[str]:
    """The terms of a text, lower-cased."""
    return {t for t in (_bare(w)[1].lower() for w in set(_WORD.findall(text))) if len(t) >= LEAST_LETTERS}


def neighbourhoods(text: str, found: list[tuple[int, int, int, str]]) -> Iterator[tuple[str, str, str, int, int, list[int]]]:
    """(entity, term, class, start, end, context) of the words around the entities, words that touch one left out.

    The context holds the checksums of two words before and two after.
    """
    words = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(text)]
    taken = []
    spans, i = sorted((a, b) for a, _, b, _ in found), 0
    reach = 0
    for a, b, _ in words:
        while i < len(spans) and spans[i][0] < b:
            reach = max(reach, spans[i][1])
            i += 1
        taken.append(reach > a)
    sums = [0, 0] + [0 if t else crc32(w.lower().encode("utf-8", "surrogatepass")) for (_, _, w), t in zip(words, taken)] + [0, 0]
    at = 0
    for start, kind, end, value in found:
        while words[at][1] <= start:
            at += 1
        last = at
        while last + 1 < len(words) and words[last + 1][0] < end:
            last += 1
        for k in (*range(max(0, at - WINDOW), at), *range(last + 1, min(len(words), last + 1 + WINDOW))):
            if taken[k]:
                continue
            a, _, w = words[k]
            skip, bare = _bare(w)
            if len(bare) >= LEAST_LETTERS:
                sort = "number" if bare.isdigit() else "name" if bare[0].isupper() else "word"
                yield (f"{KINDS[kind]}:{value}", bare.lower(), sort, a + skip, a + skip + len(bare),
                       [sums[k], sums[k + 1], sums[k + 3], sums[k + 4]])


_FOUND = {"key": T.LongType(), "is_row": T.BooleanType(), "id": None, **{f"n_{k}": T.LongType() for k in KINDS}, "base": T.StringType(),
          "entity": T.StringType(), "term": T.StringType(), "sort": T.StringType(), "start": T.LongType(), "end": T.LongType(),
          "context": T.ArrayType(T.LongType())}


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each row of ``docs`` (``is_row``), with its base spans, and one for each word near an entity."""
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField(name, kind or rows.schema["id"].dataType) for name, kind in _FOUND.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bases: list = []
            counts: list = []
            hits: list = []
            for key, text in zip(b.column(0), b.column(2)):
                text = text.as_py()
                found = personal(text)
                counts.append([sum(k == kind for _, k, _, _ in found) for kind in range(4)] if found else [0, 0, 0, 0])
                bases.append(",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e, _ in found))
                if found:
                    key = key.as_py()
                    for hit in neighbourhoods(text, found):
                        hits.append((key, *hit))
                        if len(hits) == HITS:
                            yield near(hits, b.schema.field(1).type)
                            hits = []
            if hits:
                yield near(hits, b.schema.field(1).type)
            n = b.num_rows
            yield pa.record_batch(
                [b.column(0), pa.array([True] * n), b.column(1), *[pa.array([c[k] for c in counts], pa.int64()) for k in range(4)],
                 pa.array(bases, pa.string()), *[pa.nulls(n, t) for t in (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(),
                                                                           pa.list_(pa.int64()))]], names=schema.names)

    def near(hits: list, id_kind: pa.DataType) -> pa.RecordBatch:
        n = len(hits)
        key, entity, term, sort, start, end, context = zip(*hits)
        return pa.record_batch(
            [pa.array(key, pa.int64()), pa.array([False] * n), pa.nulls(n, id_kind), *[pa.nulls(n, pa.int64())] * 4, pa.nulls(n, pa.string()),
             pa.array(entity, pa.string()), pa.array(term, pa.string()), pa.array(sort, pa.string()), pa.array(start, pa.int64()),
             pa.array(end, pa.int64()), pa.array(context, pa.list_(pa.int64()))], names=schema.names)

    return rows.mapInArrow(run, schema)


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n_term): in how many rows a term occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def handed_on() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])
            total.clear()
            return out

        for b in batches:
            for text in b.column(0):
                total.update(terms_of(text.as_py()))
                if len(total) >= FLUSH:
                    yield handed_on()
        yield handed_on()

    counted = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).mapInArrow(run, "term string, n bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("n_term"))


def _independent(context: Column, common: Column) -> Column:
    """Whether two contexts have at least two places to compare and share no word at its place; 0 stands for no word."""
    places = F.sequence(F.lit(0), F.lit(3))
    seen = F.filter(places, lambda i: (F.get(context, i) != 0) & (F.get(common, i) != 0))
    return (F.size(seen) >= 2) & ~F.exists(seen, lambda i: F.get(context, i) == F.get(common, i))


def disclosures(found: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(entity, term, n_entity, n_both, n_term, bits, disclosure) of the pairs with enough independent contexts.

    ``found`` is what ``_scan`` returned, stored.
    """
    hits = found.where(~F.col("is_row"))
    n_rows = found.where("is_row").count()
    each = hits.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("c"))
    common = each.groupBy("entity", "term").agg(F.max_by("context", F.struct("c", "context")).alias("common"))
    # the common context joins back: no pair's contexts are gathered in one value
    apart = each.join(common, ["entity", "term"]).where(_independent(F.col("context"), F.col("common")))
    enough = (apart.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("others")).where(F.col("others") >= LEAST_CONTEXTS - 1))
    both = hits.select("entity", "term", "key").distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
    entities = hits.select("entity", "key").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    pairs = stored(enough.join(both, ["entity", "term"]).join(entities, "entity").select("entity", "term", "n_entity", "n_both"), "sanitise-pairs")
    known = document_frequencies(docs, text_col).join(sized(pairs.select("term").distinct()), "term", "left_semi")
    bits = F.log2(F.lit(float(max(n_rows, 1))) / F.col("n_entity"))
    told = F.log2(F.lit(float(max(n_rows, 1))) * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    return pairs.join(known, "term").select("entity", "term", "n_entity", "n_both", "n_term", bits.alias("bits"),
                                            F.when(bits > 0, told / bits).otherwise(F.lit(0.0)).alias("disclosure"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalised: float = GENERALISED,
             removed: float = REMOVED) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, terms) of every row.

    ``base`` is the list ``kind:start:end`` of the four kinds, ``terms`` an array
    of (start, end, disclosure, replacement) of the terms that tell too much,
    ``replacement`` being empty for those to remove.
    """
    workers_import(docs.sparkSession)
    found = stored(_scan(docs, id_col, text_col), "sanitise-found")
    telling = stored(disclosures(found, docs, text_col).where(F.col("disclosure") >= generalised).select("entity", "term", "disclosure"), "sanitise-telling")
    hits = found.where(~F.col("is_row")).select("key", "entity", "term", "sort", "start", "end")
    shown = F.when(F.col("disclosure") >= removed, F.lit("")).otherwise(F.concat(F.lit("<"), F.col("sort"), F.lit(">")))
    # a term near several entities tells as much as it does of any
    spans = (hits.join(sized(telling), ["entity", "term"])
             .groupBy("key", "start", "end").agg(F.max("disclosure").alias("disclosure"), F.min(shown).alias("replacement"))
             .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "disclosure", "replacement"))).alias("terms")))
    rows = found.where("is_row").select("key", F.col("id").alias(id_col), *[f"n_{k}" for k in KINDS], "base")
    none = F.array().cast("array<struct<start: bigint, end: bigint, disclosure: double, replacement: string>>")
    return rows.join(sized(stored(spans, "sanitise-spans")), "key", "left").withColumn("terms", F.coalesce("terms", none)).drop("key")


def _entries(base: Column, terms: Column) -> Column:
    """All spans as (start, kind's number, text), in order."""
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    of_base = F.transform(F.filter(F.split(base, ","), lambda x: x != ""), lambda x: F.struct(
        F.split_part(x, F.lit(":"), F.lit(2)).cast("bigint").alias("start"), order[F.split_part(x, F.lit(":"), F.lit(1))].alias("kind"), x.alias("text")))
    of_terms = F.transform(terms, lambda x: F.struct(x["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), F.concat_ws(
        ":", F.lit(TERM), x["start"].cast("string"), x["end"].cast("string")).alias("text")))
    return F.array_sort(F.concat(of_base, of_terms))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms) of every row."""
    out = sanitise(docs, id_col, text_col)
    spans = F.when(F.size("terms") == 0, F.col("base")).otherwise(
        F.array_join(F.transform(_entries(F.col("base"), F.col("terms")), lambda x: x["text"]), ","))
    return out.select(id_col, *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"),
                      F.size("terms").alias("n_terms"))


def redact(text: str, base: str, terms: list) -> str:
    """The text with its spans replaced: ``<kind>`` for personal data, each term's replacement for it; the longest of overlapping ones."""
    spans = [(int(a), int(b), f"<{k}>") for k, a, b in (x.split(":") for x in base.split(",") if x)]
    spans += [(t["start"], t["end"], t["replacement"]) for t in terms]
    out, at = [], 0
    for a, b, shown in sorted(spans, key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], shown]
        at = max(at, b)
    return "".join(out) + text[at:]

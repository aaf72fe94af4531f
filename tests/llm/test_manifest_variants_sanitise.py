"""Merkle manifest, spelling variants and sanitisation against plain versions, and on odd input."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from featureflow.llm import merkle_manifest, sanitise, spelling_variants
from featureflow.llm.common import table
from featureflow.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ROWS = [
    (1, "The Quick brown fox", "en", "a", 1), (1, "The Quick brown fox", "en", "a", 1), (1, "another text", "en", "a", 1),
    (3, None, None, "a", None), (4, "", "en", "b", 0), (5, " \n\t ", "en", "b", 3), (None, "No id, mail a.b@c.de", "en", "b", 1),
    (None, None, None, None, None), (6, "short", "en", "a", 5), (7, "wonderful " * 30000, "en", "c", 1),
    (9, "Ünïcode ça va   naïve \x85 \U0001f600 wonderful", "fr", "c", 1), (12, "lone Leaf", "de", "c", 9),
    (13, "a@" * 20000 + "+" * 20000 + "1" * 20000 + ".1" * 20000, "en", "c", 1),
]
CLASHES = ["id", "n", "key", "tree", "idx", "level", "word", "term", "entity", "base", "hash", "start", "node", "path", "half", "shard"]


def odd(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("clash").alias(c) for c in CLASHES])


def documents(spark, sf_dir):
    return [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]


# -- 13 -------------------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)])


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_manifest(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, plain_leaf(*r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [plain_levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order]
    top = plain_levels([t[-1][0] for t in trees])
    out = []
    for k, g in enumerate(order):
        for i, (known, doc_id, leaf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            tampered = known and zlib.crc32(str(doc_id).encode()) % 3 == 0 and r[1] is not None
            folded, proof = plain_leaf(r[0], r[1].translate(LOWER), *r[2:]) if tampered else leaf, []
            for levels, at in ((trees[k], i), (top, k)):
                for level in levels[:-1]:
                    run = level[at // 8 * 8:at // 8 * 8 + 8]
                    proof += run[:at % 8] + run[at % 8 + 1:]
                    folded = h(*run[:at % 8], folded, *run[at % 8 + 1:])
                    at //= 8
            out.append((r[0], leaf, trees[k][-1][0], top[-1][0], h(*proof), folded, folded == top[-1][0]))
    return out


def shown(rows):
    return sorted(map(str, rows))


def test_manifest_matches_a_plain_tree(spark, sf_dir):
    got = [tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, sf_dir).collect()]
    want = plain_manifest(documents(spark, sf_dir))
    assert shown(got) == shown(want)
    assert {r[6] for r in want} == {True, False}


def test_manifest_on_odd_rows(spark):
    got = [tuple(r) for r in merkle_manifest.verify(odd(spark)).collect()]
    assert shown(got) == shown(plain_manifest(ROWS))
    assert merkle_manifest.verify(odd(spark, [])).count() == 0
    only = merkle_manifest.verify(odd(spark, ROWS[:1])).first()
    assert only["leaf"] == only["subroot"] == only["root"] and only["proof_sha256"] == h()


def test_manifest_of_many_groups_and_deep_trees(spark, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "COPIES", 4)
    monkeypatch.setattr(merkle_manifest, "FEW", 2)
    rng = random.Random(5)
    rows = [(i, f"Text {rng.random()}", rng.choice([None, "hot", "hot", f"l{i % 70}"]), "s", i) for i in range(1200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert shown(tuple(r) for r in merkle_manifest.verify(docs).collect()) == shown(plain_manifest(rows))


def test_manifest_leaves_the_session_as_it_was(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle_manifest.verify(odd(spark)).collect()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


# -- 11 -------------------------------------------------------------------------

def plain_words(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            c = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if c % 31 == 0:
                run = run[:c % len(run)] + run[c % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_variants(words):
    masked = collections.defaultdict(set)  # words that differ by a replacement share a masked form
    near = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masked[w[:i], w[i + 1:]].add(w)
            shorter = w[:i] + w[i + 1:]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in masked.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, others in [x for x in near.items() if x[1]]:
        best = min(others, key=lambda x: (-words[x], x))
        if words[best] >= 10 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=str)


def test_variants_match_brute_force(spark, sf_dir):
    got = [tuple(r) for r in QUERIES["op11_spelling_variants"](spark, sf_dir).collect()]
    want = plain_variants(plain_words([r[:2] for r in documents(spark, sf_dir)]))
    assert sorted(got, key=str) == want
    assert any(r[1] for r in want) and len(want) > 500


def test_variants_in_blocks_of_a_hot_half(spark):
    rng = random.Random(2)
    ends = ["".join(rng.choice("abé") for _ in range(rng.randint(3, 6))) for _ in range(900)]
    words = {f"wond{e}": rng.choice([2, 3, 40, 500]) for e in ends} | {f"{e}zing": 2 for e in ends if len(e) > 2}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: (r["best"], r["n_near"]) for r in spelling_variants.near_words(frame, 64).collect()}
    want = {}
    for w, _, _, _, n_near, _ in plain_variants(words):
        want[w] = n_near
    assert {w: n for w, (_, n) in got.items()} == want
    shards = spelling_variants.sharded(frame, 64).where("cell > 0").groupBy("shard", "cell").count().agg(F.max("count")).first()[0]
    assert 0 < shards < 64 * 4


def test_chains_of_forms_end_at_their_root(spark):
    names = ["wonderful", "wonderfu", "wonderf", "wonderff", "wonderffx", "wonderffxy"]
    rows = [(w, names[i - 1] if i else None) for i, w in enumerate(names)]
    got = {r["word"]: r["root"] for r in spelling_variants.with_roots(spark.createDataFrame(rows, "word string, form string")).collect()}
    assert got == {w: "wonderful" for w in names}


def test_variants_on_odd_rows(spark):
    rows = ROWS + [(20, "wonderfull wonderfull", None, None, None)] + [(21, "x" * 5000 + " " + "x" * 5000 + "é", "en", "a", 1)] * 2
    got = [tuple(r) for r in spelling_variants.group_variants(odd(spark, rows)).collect()]
    assert sorted(got, key=str) == plain_variants(plain_words([r[:2] for r in rows]))
    assert spelling_variants.group_variants(odd(spark, [])).count() == 0


def near_by_hand(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_each_search_finds_what_holds_its_half():
    rng = random.Random(3)
    for t in range(40):
        words = sorted({"".join(rng.choice("ab" if t % 2 else "abcé") for _ in range(rng.randint(7, 10))) for _ in range(rng.randint(1, 60))})
        index = spelling_variants.Bidirectional(words)
        left, right = (set(zip(*(x.tolist() for x in index.near(words, side)))) for side in (True, False))
        for i, q in enumerate(words):
            for j, w in enumerate(words):
                assert ((i, j) in left) == (near_by_hand(q, w) and w.startswith(q[:len(q) // 2]))
                assert ((i, j) in right) == (near_by_hand(q, w) and w.endswith(q[len(q) // 2:]))


# -- 12 -------------------------------------------------------------------------

PLAIN = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_personal(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return sorted(out)


def plain_counts(text):
    found = plain_personal(text)
    return [sum(k == i for _, k, _ in found) for i in range(4)], ",".join(x for _, _, x in found)


def test_personal_data_matches_the_plain_patterns(spark, sf_dir):
    texts = {r[0]: r[1] for r in documents(spark, sf_dir)}
    rows = QUERIES["op12_sanitise"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts, base = plain_counts(texts[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        assert r["base_sha256"] == h(base) and set(filter(None, base.split(","))) <= set(r["spans"].split(","))
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in rows) > 5


@pytest.mark.parametrize("text", [
    "a@b.c@d.e f@g.h.i.", "@x.y a@.b a@b..c a-@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111-",
    "4111  1111 1111 1111", "+1 (555) 123-4567, +12, +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "+15551234567 x@+1.5551234567", "%+-@a.b", "é1.1.1.1é"])
def test_personal_data_at_the_borders(text):
    assert [(a, k) for a, k, _, _ in sanitise.personal(text)] == [(a, k) for a, k, _ in plain_personal(text)]
    assert [f"{sanitise.KINDS[k]}:{a}:{b}" for a, k, b, _ in sanitise.personal(text)] == [x for _, _, x in plain_personal(text)]


def test_personal_data_in_random_texts():
    rng = random.Random(9)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "1", "25", "411111", ".", "@", "-", " ", "+", "(", ")", "b.c", "é", "\n", "00"]) for _ in range(rng.randint(0, 40)))
        assert [f"{sanitise.KINDS[k]}:{a}:{b}" for a, k, b, _ in sanitise.personal(text)] == [x for _, _, x in plain_personal(text)]


def revealing_table(spark):
    """A nickname that stands near one address in texts of their own, a common word that does too, and copies of one text."""
    rng = random.Random(4)
    filler = [f"w{i}" for i in range(4000)]

    def prose(n):
        return [rng.choice(filler) for _ in range(n)]

    rows = []
    for i in range(6):
        rows.append((i, " ".join([*prose(20), "Zorblax,", *prose(2), "common", *prose(1), "zb@mail.org", *prose(20)])))
    for i in range(6, 300):
        rows.append((i, " ".join([*prose(20), "common", *prose(10)])))
    copied = [*prose(8), "Quibble", *prose(3), "copy@mail.org", *prose(12)]
    for i in range(300, 340):
        altered = [rng.choice(filler) if rng.random() < 0.05 and "@" not in w and w != "Quibble" else w for w in copied]
        rows.append((i, " ".join(altered)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_reveal_an_entity_are_found(spark):
    docs = revealing_table(spark)
    rows = {r["doc_id"]: r for r in sanitise.sanitise(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i in range(6):
        assert [texts[i][t["start"]:t["end"]] for t in rows[i]["terms"]] == ["Zorblax"]
        clean = sanitise.redact(texts[i], rows[i]["base"], rows[i]["terms"])
        assert "Zorblax" not in clean and "zb@" not in clean and "<email>" in clean and " common " in clean
    # a word common elsewhere tells little, and copies of one text prove nothing
    assert all(rows[i]["terms"] == [] for i in range(6, 340))
    spans = {r["doc_id"]: r["spans"] for r in sanitise.digests(docs).collect()}
    at = texts[0].index("Zorblax")
    mail = texts[0].index("zb@")
    assert spans[0] == f"term:{at}:{at + 7},email:{mail}:{mail + 11}"


def test_disclosure_is_the_share_of_the_entity(spark):
    docs = revealing_table(spark)
    found = sanitise.stored(sanitise._scan(docs, "doc_id", "text"), "test-found")
    got = {(r["entity"], r["term"]): r for r in sanitise.disclosures(found, docs).collect()}
    r = got["email:zb@mail.org", "common"]
    assert (r["n_entity"], r["n_both"], r["n_term"]) == (6, 6, 300)
    assert math.isclose(r["disclosure"], math.log2(340 * 6 / (6 * 300)) / math.log2(340 / 6))
    assert math.isclose(got["email:zb@mail.org", "zorblax"]["disclosure"], 1)


def test_sanitise_on_odd_rows(spark):
    got = sanitise.digests(odd(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)
    for r in got:
        if r["doc_id"] is None:
            assert (r["n_email"], r["spans"]) in {(1, "email:12:20"), (0, "")}
    assert sanitise.digests(odd(spark, [])).count() == 0

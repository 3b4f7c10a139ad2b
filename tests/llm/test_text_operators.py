"""Operators over documents against plain versions, on awkward rows and on the driver's table."""

import brute
import pytest
from pyspark.sql import functions as F

from sparloom.llm import decontaminate, license_scan, packing, simhash, substring_dedup, suffix_dedup
from sparloom.llm.suffix_array import suffix_array

ROWS = brute.awkward()
NULL = -(10**9)


def frame(spark, rows, parts=5):
    df = spark.createDataFrame(rows, brute.SCHEMA)
    # names that the operators use themselves must not disturb them
    return df.repartition(parts).withColumn("id", F.lit(7)).withColumn("kind", F.lit("k")).withColumn("dedup", F.lit(1)).withColumn("_id", F.lit(2))


def bag(pairs):
    return sorted([tuple(NULL if x is None else x for x in p) for p in pairs])


@pytest.fixture(scope="module")
def docs(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    return df, [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("rows", [ROWS, []], ids=["awkward", "empty"])
def test_substrings(spark, rows):
    df = frame(spark, rows)
    out = substring_dedup.dedup_substrings(df, out="made")
    assert out.columns == [*df.columns, "made"]
    got = bag((r.doc_id, r.made.n_words, r.made.n_removed, r.made.kept_sha256) for r in out.collect())
    assert got == bag((i, *x) for (i, *_), x in zip(rows, brute.windows_before(rows)))


def test_substrings_of_table(spark, sf, docs):
    got = bag(tuple(r) for r in substring_dedup.op7_substring_dedup(spark, sf).collect())
    assert got == bag((r[0], *x) for r, x in zip(docs[1], brute.windows_before(docs[1])))


@pytest.mark.parametrize("rows", [ROWS, []], ids=["awkward", "empty"])
def test_bytes(spark, rows):
    df = frame(spark, rows)
    out = suffix_dedup.dedup_bytes(df, out="made")
    assert out.columns == [*df.columns, "made"]
    got = bag((r.doc_id, *tuple(r.made)[:4]) for r in out.collect())
    assert got == bag((i, *x) for (i, *_), x in zip(rows, brute.bytes_anywhere(rows)))


@pytest.mark.parametrize("kinds", [3, 90, 400])
def test_bytes_with_hot_anchor(spark, kinds):
    """Few and many kinds of extents around one anchor, some alike beyond the passage: the same steps, the same result."""
    rng = __import__("random").Random(kinds)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, ends = noise(700), [noise(9) for _ in range(5)]
    rows = [(i, noise(rng.randrange(50, 300)) + rng.choice(ends)[rng.randrange(9) :] + passage[rng.randrange(0, 9) :] + rng.choice(ends) + noise(200), None, None, None) for i in range(kinds)]
    got = bag((r.doc_id, *tuple(r.dedup)[:4]) for r in suffix_dedup.dedup_bytes(spark.createDataFrame(rows, brute.SCHEMA)).collect())
    assert got == bag((i, *x) for (i, *_), x in zip(rows, brute.bytes_anywhere(rows)))


def test_rows_of_a_hot_group_grow_in_proportion(spark):
    """Documents that share one passage between surroundings of their own."""
    rng = __import__("random").Random(8)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, many = noise(700), {}
    for n in (40, 160):
        docs = spark.createDataFrame([(i, i, noise(300) + passage + noise(300)) for i in range(n)], "id long, tid long, body string")
        kinds = suffix_dedup._open(suffix_dedup._counted(docs.mapInArrow(suffix_dedup._seed, suffix_dedup.FOUND)))
        marks = kinds.groupBy("id", "tid").agg(F.collect_list(F.struct("lo", "hi", "at", "many")).alias("marks"))
        many[n] = docs.join(marks, ["id", "tid"]).select("id", "tid", "body", "marks").mapInArrow(suffix_dedup._cells, suffix_dedup.FOUND).count()
    assert 3 * many[40] < many[160] < 5 * many[40]


def test_arrays_over_entries():
    """Entries of (core, outer byte, inner byte) against counted strings."""
    rng = __import__("random").Random(9)
    for _ in range(200):
        n = rng.randrange(1, 12)
        kinds = list({(rng.randrange(3), rng.choice([0, 1, 255, 256]), rng.choice([0, 1, 256])) for _ in range(n)})
        many = [rng.choice([1, 1, 2]) for _ in kinds]
        count = {}
        for (core, o, i), m in zip(kinds, many):
            for string in ((core, "outer", o),) * (o < 256) + ((core, "inner", i),) * (i < 256):
                count[string] = count.get(string, 0) + m
        want = {(k, 1) for k, (core, o, _) in enumerate(kinds) if count.get((core, "outer", o), 0) > 1} | {(k, 0) for k, (core, _, i) in enumerate(kinds) if count.get((core, "inner", i), 0) > 1}
        assert set(suffix_dedup.repeated(*map(list, zip(*kinds)), many)) == want


def test_bytes_of_table(spark, sf, docs):
    got = bag(tuple(r) for r in suffix_dedup.op6_suffix_dedup(spark, sf).collect())
    assert got == bag((r[0], *x) for r, x in zip(docs[1], brute.bytes_anywhere(docs[1])))


def test_suffix_array():
    rng = __import__("random").Random(2)
    for _ in range(600):
        x = bytes(rng.randint(0, rng.choice([1, 2, 3, 255])) for _ in range(rng.randint(0, 70)))
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


ITEMS = [(1, "alpha beta gamma d of the x1"), (2, None), (3, ""), (4, " ".join(ROWS[8][1].split()[10:40])), (4, "two words"), (None, "one"), (5, "日本 zwölf of " * 5)]


@pytest.mark.parametrize("rows,items", [(ROWS, ITEMS), ([], ITEMS), (ROWS, [])], ids=["awkward", "no documents", "no items"])
def test_contamination(spark, rows, items):
    found = decontaminate.find_contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    rows_out = found.select("id", "n_words", "spans", "items").mapInArrow(decontaminate._count, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
    assert bag(tuple(r) for r in rows_out.collect()) == bag((i, *x) for (i, *_), x in zip(rows, brute.contamination(rows, items)))


def test_contamination_of_table(spark, sf, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = bag(tuple(r) for r in decontaminate.op2_decontaminate(spark, sf).collect())
    assert got == bag((r[0], *x) for r, x in zip(docs[1], brute.contamination(docs[1], items)))


@pytest.mark.parametrize("rows", [ROWS, []], ids=["awkward", "empty"])
def test_simhash(spark, rows):
    out = simhash.simhash_groups(frame(spark, rows)).select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component")
    assert bag(tuple(r) for r in out.collect()) == bag((i, *x) for (i, *_), x in zip(rows, brute.simhash(rows)))


def test_simhash_of_table(spark, sf, docs):
    got = bag(tuple(r) for r in simhash.op10_simhash(spark, sf).collect())
    assert got == bag((r[0], *x) for r, x in zip(docs[1], brute.simhash(docs[1])))


def test_trie_join_links_all_within_budget():
    rng = __import__("random").Random(4)
    base = [rng.getrandbits(64) for _ in range(6)]
    values = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (1 << 64) - 1 for b in base for _ in range(40)})
    up = {v: v for v in values}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in simhash.trie_join(values):
        assert (a ^ b).bit_count() <= 2
        up[find(a)] = find(b)
    for a in values:
        for b in values:
            assert (a ^ b).bit_count() > 2 or find(a) == find(b)


def test_components_of_chains(spark):
    from sparloom.llm.common import Workspace
    from sparloom.llm.components import components

    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7)] + [(300, 300 + i) for i in range(1, 40)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long"), Workspace(spark, "t")).collect()}
    assert got == {(i, 0) for i in range(1, 61)} | {(150, 100), (200, 100)} | {(300 + i, 300) for i in range(1, 40)}


@pytest.mark.parametrize("rows", [ROWS, []], ids=["awkward", "empty"])
def test_packing(spark, rows):
    from tokenizers import Tokenizer

    got = [tuple(r) for r in packing.pack(frame(spark, rows), packing.default_tokenizer()).collect()]
    want = brute.pieces(rows, Tokenizer.from_file(packing.default_tokenizer()))
    assert bag(r[:5] for r in got) == bag(want)
    by = {}
    for r in got:
        by.setdefault(r[5], []).append((r[6], r[3]))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= packing.LENGTH


def test_packing_is_tight():
    import numpy as np

    rng = np.random.default_rng(1)
    for sizes in (rng.integers(1, 2049, 5000), np.repeat([700, 660], [1000, 2000]), np.repeat([1025, 1000, 23], 500), np.repeat([683, 682], [900, 1800])):
        counts = np.bincount(sizes, minlength=2049)
        plan = packing.best_plan(counts)
        bound = max(-(-int(sizes.sum()) // 2048), int((sizes > 1024).sum()), -(-len(sizes) // 3) if sizes.min() > 512 else 0)
        assert plan.next <= bound * 1.02 + 1
        runs = plan.runs()
        assert len(runs) < 20_000 and not plan.left.any()


def test_plan_does_not_grow_with_rows():
    import numpy as np

    counts = np.bincount(np.random.default_rng(2).integers(1, 2049, 4000), minlength=2049)
    assert len(packing.best_plan(counts * 10**6).runs()) < 20_000


def test_licenses(spark):
    from sparloom.llm.license_templates import TEMPLATES

    isc, mit = TEMPLATES["isc"], TEMPLATES["mit"]
    rows = [(1, "lead in " + mit.replace("merge,", "merge and") + " tail"), (2, None), (3, ""), (4, isc.upper() + " x " + isc), (4, isc.upper() + " x " + isc), (5, "Released under the MIT License."), (6, "released for the")]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id int, text string").withColumn("id", F.lit(1))).collect()
    found = sorted((r.id, r.license, r.first_word, r.last_word, r.matched_words) for r in got)
    assert [f[:3] for f in found if f[0] == 1] == [(1, "mit", 2)] and found[0][4] == len(license_scan.Index(TEMPLATES).words[license_scan.Index(TEMPLATES).names.index("mit")])
    n = len(brute.ALNUM_WORD.findall(brute.lower(isc)))
    assert [f for f in found if f[0] == 4] == [(4, "isc", 0, n, n)] * 2 + [(4, "isc", n + 1, 2 * n + 1, n)] * 2
    assert [f[:4] for f in found if f[0] == 5] == [(5, "mit-line", 0, 5)] and not [f for f in found if f[0] in (2, 3, 6)]


def test_banded_alignment_equals_full_one():
    rng = __import__("random").Random(6)
    for _ in range(60):
        template = [rng.choice("abcdefgh").encode() for _ in range(12)]
        words = list(template)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(words))
            words[k : k + 1] = rng.choice([[], [b"zz"], [words[k], b"q"]])
        banded, full = (license_scan.align(template, words, 0, band) for band in (8, 40))
        assert banded[0] >= 6 and banded == full


def test_licenses_against_full_alignment(spark):
    """Every template against every text by a whole alignment table."""
    from sparloom.llm.license_templates import TEMPLATES

    rng = __import__("random").Random(11)
    fill = lambda n: [f"z{rng.randrange(500)}" for _ in range(n)]
    rows = [(0, ""), (1, None)]
    for name, text in sorted(TEMPLATES.items()):
        words = text.split()
        for share in (0.0, 0.04, 0.1):
            made = [w for w in words if rng.random() >= share / 2]
            made = [w if rng.random() >= share / 2 else "zz" for w in made]
            rows.append((len(rows), " ".join([*fill(rng.randrange(30)), *made, *fill(rng.randrange(30))])))
    got = {}
    for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.id, r.license] = max(r.matched_words, got.get((r.id, r.license), 0))
    words = {name: brute.ALNUM_WORD.findall(brute.lower(text)) for name, text in TEMPLATES.items()}
    said = {i: brute.ALNUM_WORD.findall(brute.lower(text)) for i, text in rows}
    own = {(2 + 3 * k + j, name) for k, name in enumerate(sorted(TEMPLATES)) for j in range(3)}
    # the planted licence is found with the words of the best alignment (equal scores may differ by a word, a chain may add some)
    for i, name in own:
        best = brute.local_alignment(words[name], said[i])
        if best >= license_scan.LEAST * len(words[name]) and brute.shared_run(words[name], said[i]) >= 5:
            assert got[i, name] >= best - 1
    # and nothing is reported that the text doesn't hold in the template's order
    assert all(license_scan.LEAST * len(words[name]) <= n <= brute.in_order(words[name], said[i]) for (i, name), n in got.items())


def test_licenses_edges(spark):
    kind = "doc_id long, text string"
    assert license_scan.scan_licenses(spark.createDataFrame([], kind)).count() == 0
    same = {"b": "one two three four five six", "a": "one two three four five six"}
    got = license_scan.scan_licenses(spark.createDataFrame([(1, "x " * 200_000 + same["a"] + " y" * 200_000), (None, same["a"])], kind).withColumn("license", F.lit("kept out")), same).collect()
    assert sorted((r.id or 0, r.license, r.first_word, r.last_word) for r in got) == [(0, "a", 0, 6), (0, "b", 0, 6), (1, "a", 200_000, 200_006), (1, "b", 200_000, 200_006)]


def test_licenses_of_table(spark, sf, docs):
    import re

    got = {r.doc_id for r in license_scan.op9_license_scan(spark, sf).collect() if r.coverage == 1}
    want = {r[0] for r in docs[1] if re.search(r"Licensed under (CC BY|the Apache License, Version 2)|Released under the MIT License|licensed under the GNU General Public", r[1] or "")}
    assert got == want

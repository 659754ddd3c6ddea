"""Keyed permutations, tolerant placement, ages in both enrichment tests, coverage by category: against brute force."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from locuspark.operators import compose as cm
from locuspark.operators import coverage as cv
from locuspark.operators import enrich as en
from locuspark.operators import shuffle as sh
from locuspark.storage import ordinals


def test_permutations_are_bijections_and_even(spark):
    for n in (1, 2, 3, 10, 997):
        places = spark.range(n).selectExpr("id AS i", f"CAST({n} AS BIGINT) AS n", "explode(sequence(1L, 20L)) AS r")
        got = places.withColumn("j", sh.permutation(5)("i", "n", "r")).collect()
        by = defaultdict(list)
        for x in got:
            by[x.r].append((x.i, x.j))
        assert all(sorted(j for _, j in v) == list(range(n)) for v in by.values())
    rounds = 6000
    got = spark.range(5).selectExpr("id AS i", "5L AS n", f"explode(sequence(1L, {rounds}L)) AS r").withColumn("j", sh.permutation(1)("i", "n", "r")).collect()
    single, pairs, place = Counter((x.i, x.j) for x in got), Counter(), defaultdict(dict)
    for x in got:
        place[x.r][x.i] = x.j
    for p in place.values():
        pairs[p[0], p[1]] += 1
    assert len(single) == 25 and all(abs(c - rounds / 5) < 6 * math.sqrt(rounds / 5) for c in single.values())
    assert len(pairs) == 20 and all(abs(c - rounds / 20) < 6 * math.sqrt(rounds / 20) for c in pairs.values())


def test_ordinals_of_any_type_without_a_window_over_rows(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), f"{rng.getrandbits(60):x}") for _ in range(400)]
    out = ordinals(spark.createDataFrame(rows, "chrom string, te_id string").repartition(7), ["chrom"], ["te_id"])
    got = sorted((r.chrom, r.te_id, r._i, r._n) for r in out.collect())
    want = []
    for c in "ab":
        ids = sorted(i for x, i in rows if x == c)
        want += [(c, i, k, len(ids)) for k, i in enumerate(ids)]
    assert got == want
    assert "_part" in str(out._jdf.queryExecution().optimizedPlan().toString())


def test_shuffled_positions_of_hashed_ids_permute_midpoints(spark):
    rng = random.Random(2)
    rows = [("c", s := rng.randrange(100, 5000), s + 2 * rng.randrange(5, 20), f"id{rng.getrandbits(64):x}") for _ in range(200)]
    te = spark.createDataFrame(rows, "chrom string, start long, end long, te_id string")
    sizes = spark.createDataFrame([("c", 6000)], "chrom string, length long")
    got = sh.shuffle_positions(te, sizes, 3).collect()
    mids = Counter((s + e) // 2 for _, s, e, _ in rows)
    assert all(Counter((r.start + r.end) // 2 for r in got if r.round == k) == mids for k in (1, 2, 3))
    later = sh.shuffle_positions(te, sizes, 1, first=3).collect()
    assert sorted(map(tuple, later)) == sorted(tuple(r) for r in got if r.round == 3)


@pytest.mark.parametrize("seed", range(12))
def test_admissible_starts_equal_brute_force(seed):
    rng = random.Random(seed)
    cells = [rng.random() < 0.4 for _ in range(121)]

    def runs(flags):
        out, p = [], 1
        while p <= 120:
            if flags[p]:
                q = p
                while q < 120 and flags[q + 1]:
                    q += 1
                out.append((p, q))
                p = q + 1
            p += 1
        return np.array(out, np.int64).reshape(-1, 2)

    inside = [True] * 121
    for p in rng.sample(range(1, 121), 3):
        inside[p] = False
    for span in (0, 3, 17, 60):
        for most in (0, 2, 9):
            at, n = sh.admissible_starts(runs(inside), runs(cells), span, most)
            got = sorted(s for a, k in zip(at, n, strict=True) for s in range(a, a + k))
            want = [s for s in range(1, 121 - span) if all(inside[s : s + span + 1]) and sum(cells[s : s + span + 1]) <= most]
            assert got == want


def test_tolerant_placement_is_uniform_over_admissible_starts(spark):
    te = spark.createDataFrame([("c", 1, 10, 1), ("c", 1, 4, 2), ("c", 1, 100, 3)], "chrom string, start long, end long, te_id long")
    sizes = spark.createDataFrame([("c", 40)], "chrom string, length long")
    excl = spark.createDataFrame([("c", 11, 20), ("c", 15, 22), ("c", 36, 36)], "chrom string, start long, end long")
    rounds = 3000
    out = sh.shuffle_random(te, sizes, rounds, excl, max_excl_fraction=0.3)
    seen = defaultdict(Counter)
    for r in out.collect():
        assert r.end - r.start == {1: 9, 2: 3}[r.te_id]
        seen[r.te_id][r.start] += 1
    bad = {*range(11, 23), 36}
    for i, length in ((1, 10), (2, 4)):
        want = [s for s in range(1, 42 - length) if sum(p in bad for p in range(s, s + length)) <= math.floor(0.3 * length)]
        assert sorted(seen[i]) == want
        assert all(abs(c - rounds / len(want)) < 6 * math.sqrt(rounds / len(want)) for c in seen[i].values())
    with pytest.raises(ValueError):
        sh.shuffle_random(te, sizes, 1, excl, no_overlap=True, max_excl_fraction=0.3)


@pytest.mark.parametrize("included", [False, True])
def test_tolerant_placement_keeps_the_exact_step_for_what_many_draws_refuse(spark, monkeypatch, included):
    rng = random.Random(3)
    spans = {i: 20_000 if i % 100 == 0 else 9_000 if i == 7 else rng.randint(20, 400) for i in range(600)}
    te = spark.createDataFrame([("c", 1, 1 + n, i) for i, n in spans.items()] + [("d", 1, 5_000, 900), ("d", 1, 50, 901)], "chrom string, start long, end long, te_id long")
    sizes = spark.createDataFrame([("c", 400_000), ("d", 6_000)], "chrom string, length long")
    bars = [(s, s + rng.randint(1, 60)) for s in range(500, 399_000, 2_000)] + [(100_000, 115_000)]
    excl = spark.createDataFrame([("c", *b) for b in bars] + [("d", 1, 4_000)], "chrom string, start long, end long")
    parts = [(1, 150_000), (160_000, 400_000)] if included else [(1, 400_000)]
    incl = spark.createDataFrame([("c", *p) for p in parts] + [("d", 1, 6_000)], "chrom string, start long, end long") if included else None
    asked, exact = [], sh._draw
    monkeypatch.setattr(sh, "_draw", lambda items, *a: (asked.append({r.te_id for r in items.collect()}), exact(items, *a))[1])
    got = sh.shuffle_random(te, sizes, 4, excl, incl, max_excl_fraction=0.1).collect()
    assert len(asked) == 1 and {900} <= asked[0] <= {900, 901}  # of 602 repeats only one that fits nowhere, and at most one with few places
    assert sorted((r.te_id, r.round) for r in got) == sorted((i, k) for i in (*spans, 901) for k in (1, 2, 3, 4))
    bad = np.zeros(400_002, np.int64)
    for s, e in bars:
        bad[s : e + 1] = 1
    before = np.cumsum(bad)
    for r in got:
        if r.te_id != 901:
            assert r.end - r.start == spans[r.te_id] and any(s <= r.start and r.end <= e for s, e in parts)
            assert before[r.end] - before[r.start - 1] <= math.floor(0.1 * (r.end - r.start + 1))


AGES = [("R1", "old", "Eutheria"), ("R2", "old", None), ("R3", "young", "Eutheria"), ("R4", "young", "")]


def test_age_hits_count_a_feature_once_per_age(spark):
    rng = random.Random(4)
    hits = [(f"f{rng.randrange(30)}", f"R{rng.randrange(1, 7)}", rng.randrange(2)) for _ in range(150)]
    df = spark.createDataFrame(hits, "feature string, rname string, round long")
    ages = spark.createDataFrame(AGES, "rname string, age1 string, age2 string")
    got = {(r.round, r.rfam, r.rname): r.hits for r in cm.age_hits(cm.with_ages(df, ages), ["feature"], ["round"]).collect()}
    table, seen = {n: (a, b) for n, a, b in AGES}, defaultdict(set)
    for f, n, k in hits:
        if n in table:
            a, b = table[n]
            for level in [("cat.1", "tot"), ("cat.2", "tot"), ("cat.1", a), *([("cat.2", b)] if b else [])]:
                seen[k, *level].add(f)
    assert got == {k: len(v) for k, v in seen.items()}
    counts = {(r.rfam, r.rname): r.n for r in cm.genome_ages(cm.with_ages(df, ages)).collect()}
    assert counts["cat.1", "tot"] == counts["cat.2", "tot"] == sum(n in table for _, n, _ in hits)
    assert counts["cat.2", "Eutheria"] == sum(n in ("R1", "R3") for _, n, _ in hits)


def test_an_exons_age_counts_in_the_category_of_its_first_repeat(spark):
    rng = random.Random(6)
    rows = [(1, rng.randrange(3), rng.randrange(4), rng.choice(["TSS", "polyA", "exonized"]), f"R{rng.randrange(1, 7)}", s := rng.randrange(100), s + 20, i) for i in range(120)]
    df = spark.createDataFrame(rows, "round long, tr long, k long, category string, rname string, te_st long, te_en long, te_id long")
    ages = spark.createDataFrame(AGES, "rname string, age1 string, age2 string")
    got = {(r.category, r.rfam, r.rname): r.hits for r in cm.age_hits_by_category(cm.with_ages(df, ages), ["round"]).collect()}
    table, seen, want = {n: (a, b) for n, a, b in AGES}, set(), Counter()
    for _, tr, k, cat, n, *_ in sorted(rows, key=lambda r: r[5:]):  # line by line in file order
        if n not in table:
            continue
        a, b = table[n]
        for level in [("cat.1", "tot"), ("cat.2", "tot"), ("cat.1", a), *([("cat.2", b)] if b else [])]:
            if (tr, k, level) not in seen:
                seen.add((tr, k, level))
                want[cat, *level] += 1
    assert got == want


def test_enrichment_has_age_rows_with_the_genomes_counts(spark):
    te = spark.createDataFrame([("c", 100 * i, 100 * i + 50, i, "X", "F", f"R{i % 5}") for i in range(1, 40)], "chrom string, start long, end long, te_id long, rclass string, rfam string, rname string")
    features = spark.createDataFrame([("c", 200 * i, 200 * i + 30, f"f{i}") for i in range(1, 15)], "chrom string, start long, end long, feature string")
    sizes = spark.createDataFrame([("c", 5000)], "chrom string, length long")
    ages = spark.createDataFrame(AGES, "rname string, age1 string, age2 string")
    t = en.enrichment(te, features, sh.shuffle_positions(te, sizes, 20), 20, ages=ages)
    rows = {(r.rfam, r.rname): r for r in t.where("rclass = 'age'").collect()}
    assert set(rows) == {("cat.1", "tot"), ("cat.2", "tot"), ("cat.1", "old"), ("cat.1", "young"), ("cat.2", "Eutheria")}
    assert rows["cat.1", "tot"].n == sum(i % 5 > 0 for i in range(1, 40)) and rows["cat.1", "old"].obs == sum((2 * i) % 5 in (1, 2) for i in range(1, 15))
    assert t.where("p > 1").count() == 0 and 0 < rows["cat.1", "tot"].p <= 1


def test_category_places(spark):
    cols = "chrom string, te_st long, te_en long, te_id long, te_strand string, rname string, block long, strand string, st long, en long, tr long, category string"
    rows = [
        ("c", 10, 40, 1, "+", "R", 1, "+", 20, 60, 1, "TSS"),
        ("c", 10, 40, 1, "+", "R", 1, "+", 20, 80, 2, "TSS"),  # the same place of another transcript
        ("c", 12, 40, 2, "+", "R", 1, "+", 20, 60, 3, "TSS"),  # a second piece of the repeat there
        ("c", 10, 40, 1, "+", "R", 1, "-", 5, 30, 4, "TSS_5SPL"),
        ("c", 10, 40, 1, "+", "R", 1, "-", 5, 30, 5, "polyA"),
    ]
    df = spark.createDataFrame(rows, cols)
    got = sorted((r.tr, r.st, r.en, r.te_id) for r in cv.category_places(df, "TSS").collect())
    assert [g[1:] for g in got] == [(20, 20, 1), (30, 30, 1)]
    assert cv.category_places(df, "exonized").count() == 4
    te = spark.createDataFrame([("c", 10, 40, "R", 1, 101, 131, 9), ("c", 12, 40, "R", 1, 101, 131, 9)], "chrom string, start long, end long, rname string, block long, rep_start long, rep_end long, rep_left long")
    depth = {r.pos: r.depth for r in cv.consensus_coverage(df, te, kind="TrInfos", category="TSS").collect()}
    assert {p: d for p, d in depth.items() if d} == {111: 1, 121: 1} and len(depth) == 140
    whole = cv.consensus_coverage(None, te, kind="RMout")
    assert {r.depth for r in whole.where("pos BETWEEN 101 AND 131").collect()} == {2}
    with pytest.raises(ValueError):
        cv.consensus_coverage(df, te, kind="other")


def test_all_categories_in_one_job_are_each_by_itself(spark, monkeypatch):
    cols = "chrom string, te_st long, te_en long, te_id long, te_strand string, rname string, block long, strand string, st long, en long, tr long, category string"
    cats = ["TSS", "polyA", "5SPL", "3SPL", "TSS_5SPL", "exonized"]
    df = spark.createDataFrame([("c", 10 + i, 40 + i, i, "+-"[i % 2], f"R{i % 2}", 1, "+-"[i % 3 % 2], 20, 60 + i, i, cats[i % 6]) for i in range(24)], cols)
    te = spark.createDataFrame([("c", 10 + i, 40 + i, f"R{i % 2}", 1, 101, 131, 9 + i % 2) for i in range(22)] * 2, "chrom string, start long, end long, rname string, block long, rep_start long, rep_end long, rep_left long")
    looked = []
    lookup = cv.with_consensus
    monkeypatch.setattr(cv, "with_consensus", lambda *a: looked.append(1) or lookup(*a))
    got = sorted(map(tuple, cv.coverage_by_category(df, te).select("site", "rname", "pos", "depth").collect()))
    assert looked == [1]  # the repeats are met once
    each = [(c, r.rname, r.pos, r.depth) for c in ("exonized", *cv.SITES) for r in cv.consensus_coverage(df, te, kind="TrInfos", category=c).collect()]
    assert got == sorted(each) and sum(d for *_, d in got) > 50

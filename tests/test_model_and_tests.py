"""Transcript model, categories, shuffles and exact tests on small inputs."""

import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from locuspark.functions import binomial as bn
from locuspark.functions import sequences as sq
from locuspark.functions import statistics as st
from locuspark.operators import annotation as an
from locuspark.operators import classify as cl
from locuspark.operators import model as md
from locuspark.operators import shuffle as sh
from locuspark.operators.coverage import depth_per_base
from locuspark.plans import registry
from locuspark.sources import readers as rd


def exons(spark, strand="+"):
    rows = [("g", "t", 1, "c", strand, 101, 200), ("g", "t", 2, "c", strand, 301, 400), ("g", "t", 3, "c", strand, 501, 650)]
    return spark.createDataFrame(rows, "gene string, tr string, k long, chrom string, strand string, start long, end long")


def test_exon_types_follow_the_strand(spark):
    for strand, want in (("+", ["FIRST", "MIDDLE", "LAST"]), ("-", ["LAST", "MIDDLE", "FIRST"])):
        got = md.exon_structure(exons(spark, strand)).orderBy("start").collect()
        assert [r.exon_type for r in got] == want


def test_mapping_there_and_back(spark):
    for strand in "+-":
        e = exons(spark, strand)
        p = spark.createDataFrame([("c", x) for x in (101, 200, 301, 650, 250)], "chrom string, pos long")
        m = md.map_positions(p, e)
        got = {r.pos: r.mapped for r in m.collect()}
        assert got == ({101: 1, 200: 100, 301: 101, 650: 350} if strand == "+" else {101: 350, 200: 251, 301: 250, 650: 1})
        back = md.map_to_genome(m.select("tr", F.col("mapped").alias("at"), F.col("pos").alias("was")), e)
        assert all(r.pos == r.was for r in back.collect())


def test_aed_of_equal_transcripts_is_zero(spark):
    e = exons(spark)
    both = e.union(e.withColumn("tr", F.lit("u")))
    assert md.aed(md.transcript_pairs(both), both).first().aed == 0
    assert md.splice_complexity(e).first().complexity is None


def test_exon_categories_by_strand_type_and_side(spark):
    rows = [(t, s, a, b) for t in ("SINGLE", "FIRST", "MIDDLE", "LAST") for s in "+-" for a, b in ((90, 110), (190, 210), (90, 210), (120, 130))]
    j = spark.createDataFrame([(t, s, a, b, 100, 200) for t, s, a, b in rows], "exon_type string, strand string, te_st long, te_en long, st long, en long")
    got = {(r.exon_type, r.strand, r.te_st, r.te_en): r.category for r in cl.classify_exon(j).collect()}
    head = {"SINGLE": "TSS", "FIRST": "TSS", "MIDDLE": "3SPL", "LAST": "3SPL"}
    tail = {"SINGLE": "polyA", "FIRST": "5SPL", "MIDDLE": "5SPL", "LAST": "polyA"}
    both = {"SINGLE": "TSS_polyA", "FIRST": "TSS_5SPL", "MIDDLE": "3SPL_exon_5SPL", "LAST": "3SPL_polyA"}
    for t, s, a, b in rows:
        low, high = a <= 100, b >= 200
        five, three = (low, high) if s == "+" else (high, low)
        want = both[t] if five and three else head[t] if five else tail[t] if three else "exonized"
        assert got[t, s, a, b] == want


def test_shuffles_keep_lengths_and_stay_inside(spark):
    te = spark.createDataFrame([(i, f"c{i % 2}", 10 * i + 1, 10 * i + 1 + i % 7, "+") for i in range(1, 60)], "te_id long, chrom string, start long, end long, strand string")
    sizes = spark.createDataFrame([("c0", 700), ("c1", 650)], "chrom string, length long")
    tss = spark.createDataFrame([(1, "c0", "+", 50, 50), (2, "c0", "-", 400, 400), (3, "c1", "+", 300, 300)], "tss_id long, chrom string, strand string, start long, end long")
    excl = spark.createDataFrame([("c0", 100, 300), ("c1", 1, 50)], "chrom string, start long, end long")
    length = {r.te_id: (r.chrom, r.end - r.start) for r in te.collect()}
    top = {"c0": 700, "c1": 650}
    for out in (sh.shuffle_positions(te, sizes, 3), sh.shuffle_tss(te, tss, sizes, 3), sh.shuffle_random(te, sizes, 3, excl)):
        got = out.collect()
        assert len(got) == 3 * len(length)
        assert all((r.chrom, r.end - r.start) == length[r.te_id] and 1 <= r.start and r.end <= top[r.chrom] for r in got)
    bars = {"c0": (100, 300), "c1": (1, 50)}
    assert all(r.end < bars[r.chrom][0] or r.start > bars[r.chrom][1] for r in sh.shuffle_random(te, sizes, 3, excl).collect())


def test_binomial_p_is_exact():
    def brute(x, n, p):
        pmf = [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]
        return sum(v for v in pmf if v <= pmf[x] * (1 + 1e-7))

    for n in (1, 7, 40):
        for x in range(0, n + 1, 3):
            for p in (0.05, 0.3, 0.5, 0.9):
                assert abs(bn.binomial_p(x, n, p) - brute(x, n, p)) < 1e-9
    assert bn.binomial_p(3, 2, 0.5) is None and bn.binomial_p(0, 0, 0.5) is None and bn.binomial_p(1, 5, 0) is None
    lo, hi = bn.clopper_pearson(8, 20)
    assert abs(lo - 0.1911901) < 1e-5 and abs(hi - 0.6394574) < 1e-5
    assert 0 <= bn.binomial_p(100_500, 1_000_000, 0.1) <= 1


def test_depth_sums_to_lengths(spark):
    cov = spark.createDataFrame([("R", 1, 5), ("R", 3, 9), ("S", 2, 2)], "rname string, con_start long, con_end long")
    lens = spark.createDataFrame([("R", 8), ("S", 3)], "rname string, length long")
    d = {(r.rname, r.pos): r.depth for r in depth_per_base(cov, lens).collect()}
    assert [d["R", i] for i in range(1, 9)] == [1, 1, 2, 2, 2, 1, 1, 1]
    assert [d["S", i] for i in range(1, 4)] == [0, 1, 0]


def test_sequences(spark):
    df = spark.createDataFrame([("ATGCCTtaa",), ("",), ("AC GT1",)], "s string")
    got = df.select(sq.translate_cds(F.col("s")).alias("p"), sq.revcomp(F.col("s")).alias("r"), sq.gc_content(F.col("s")).alias("g")).collect()
    assert [r.p for r in got] == ["MP", "", "T"]
    assert got[0].r == "ttaAGGCAT" and got[1].g is None


def test_statistics_edges(spark):
    one = spark.createDataFrame([(1.0,)], "v double")
    assert st.mean_sd(one.withColumn("g", F.lit(1)), ["g"], "v").first().sd is None
    assert st.mode(one, "v").first().mode is None
    m = st.moments(one, "v").first()
    assert m.skewness is None and m.kurtosis is None
    z = spark.createDataFrame([(0.0,), (2.0,)], "v double")
    assert st.other_means(z, "v").first().harmonic_mean is None
    assert st.order_stats(z, "v", percent=10).first().percentile is None


def test_random_placement_is_uniform_over_fitting_starts(spark):
    te = spark.createDataFrame([(i, "c", 1, 10 if i % 2 else 12) for i in range(1, 401)] + [(900, "c", 1, 14)], "te_id long, chrom string, start long, end long")
    sizes = spark.createDataFrame([("c", 2000)], "chrom string, length long")
    excl = spark.createDataFrame([("c", 20 * i + (13 if i < 50 else 11), 20 * i + 20) for i in range(100)], "chrom string, start long, end long")
    got = sh.shuffle_random(te, sizes, 5, excl).collect()
    assert len(got) == 5 * 400 and len({(r.te_id, r.round) for r in got}) == 5 * 400
    for length, want in ((10, {20 * i + 1 + k for i in range(100) for k in range(3 if i < 50 else 1)}), (12, {20 * i + 1 for i in range(50)})):
        at = Counter(r.start for r in got if r.end - r.start + 1 == length)
        assert set(at) <= want and len(at) > 0.9 * len(want)
        assert sum((n - 1000 / len(want)) ** 2 for n in (at[s] for s in want)) / (1000 / len(want)) < 2 * len(want)


def test_random_placement_apart_shares_no_position(spark):
    spans = {i: (i * 7) % 23 for i in range(1, 201)}
    te = spark.createDataFrame([(i, "c", 1, 1 + n) for i, n in spans.items()] + [(900, "c", 1, 500)], "te_id long, chrom string, start long, end long")
    sizes = spark.createDataFrame([("c", 4000), ("empty", 50)], "chrom string, length long")
    excl = spark.createDataFrame([("c", 200 * i + 150 + i, 200 * i + 160) for i in range(10)], "chrom string, start long, end long")
    barred = {p for i in range(10) for p in range(200 * i + 150 + i, 200 * i + 161)}
    out = sh.shuffle_random(te, sizes, 4, excl, no_overlap=True)
    got = out.collect()
    assert sorted((r.te_id, r.round) for r in got if r.te_id != 900) == sorted((i, r) for i in spans for r in range(1, 5))  # room for all, but one draw does not do
    for k in range(1, 5):
        rows = sorted((r.start, r.end, r.te_id) for r in got if r.round == k)
        assert all(a[1] < b[0] for a, b in zip(rows, rows[1:]))
        assert all(1 <= s and e <= 4000 and not barred & set(range(s, e + 1)) and (i == 900 or e - s == spans[i]) for s, e, i in rows)
    assert len({r.start for r in got if r.te_id == 1}) > 1
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, got))  # the same draws again


def test_random_placement_apart_fills_what_fits_and_spreads(spark):
    sizes = spark.createDataFrame([("c", 40), ("d", 1000)], "chrom string, length long")
    full = spark.createDataFrame([(i, "c", 1, 10) for i in range(1, 7)], "te_id long, chrom string, start long, end long")
    got = sh.shuffle_random(full, sizes, 3, no_overlap=True).collect()
    assert all(sorted(r.start for r in got if r.round == k) == [1, 11, 21, 31] for k in (1, 2, 3))
    two = spark.createDataFrame([(1, "d", 1, 100), (2, "d", 1, 100)], "te_id long, chrom string, start long, end long")
    starts = [(r.round, r.te_id, r.start) for r in sh.shuffle_random(two, sizes, 400, no_overlap=True).collect()]
    at = {(k, i): s for k, i, s in starts}
    assert len(at) == 800 and all(abs(at[k, 1] - at[k, 2]) >= 100 for k in range(1, 401))
    assert 150 < sum(at[k, 1] < at[k, 2] for k in range(1, 401)) < 250
    low = [min(at[k, 1], at[k, 2]) for k in range(1, 401)]
    assert abs(sum(low) / 400 - (1 + 800 / 3)) < 40  # the smaller of two uniform draws of 0..800
    none = spark.createDataFrame([], "te_id long, chrom string, start long, end long")
    assert sh.shuffle_random(none, sizes, 2, no_overlap=True).count() == 0


def test_smoothing_and_wide_coverage_of_the_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("the driver's tables are not here")
    want, last = {}, {}
    for r in spark.read.parquet(f"{sf}/events.parquet").orderBy("event_id").collect():
        last[r.user_id] = 0.4 * last[r.user_id] + (1 - 0.4) * r.value if r.user_id in last else r.value
        want[r.user_id, r.event_id] = last[r.user_id]
    got = {(r.user_id, r.event_id): r.smoothed for r in registry.QUERIES["w6_exponential_smoothing_all"](spark, sf).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    depth = {(r.rname, r.pos): r.depth for r in registry.QUERIES["a18_depth_per_base"](spark, sf).collect()}
    wide = registry.QUERIES["a19_coverage_wide_all"](spark, sf)
    assert set(wide.columns) == {"pos"} | {n for n, _ in depth}
    rows = wide.collect()
    assert len(rows) == max(p for _, p in depth) and all(r[n] == depth.get((n, r.pos), 0) for r in rows for n in wide.columns[1:])


def test_descendants_of_all_levels(spark):
    rel = spark.createDataFrame([(f"f{i:02}", f"f{i + 1:02}") for i in range(12)] + [("x", "y"), ("y", "x")], "parent string, child string")
    got = {(r.ancestor, r.descendant): r.depth for r in an.descendants(rel).collect()}
    want = {(f"f{i:02}", f"f{k:02}"): k - i for i in range(12) for k in range(i + 1, 13)} | {("x", "y"): 1, ("y", "x"): 1, ("x", "x"): 2, ("y", "y"): 2}
    assert got == want
    assert an.descendants(rel, 2).agg(F.max("depth")).first()[0] == 2 and an.descendants(rel.limit(0)).count() == 0


def test_all_samples_and_effects(spark, tmp_path):
    (tmp_path / "a.vcf").write_text("\t".join(["1", "5", ".", "A", "C,G", "9", "PASS", "AF=1", "GT", *[f"s{i}" for i in range(10_050)]]) + "\n" + "\t".join(["1", "6", "r", "A", "C", "9", "PASS", "AF=1"]) + "\n")
    assert {r.start: r.samples for r in rd.read_vcf(spark, str(tmp_path)).collect()} == {5: [f"s{i}" for i in range(10_050)], 6: []}
    v = spark.createDataFrame([("v", ["C", "G"], "frameshift-near-splice:t,odd word:u")], "feature_id string, variant_seq array<string>, effects string")
    got = {(r.allele, r.effect, r.feature_type, r.target) for r in rd.variant_effects(v, "seattleseq").collect()}
    assert got == {(a, *x) for a in "CG" for x in (("frameshift_variant", "mRNA", "t"), ("splice_region_variant", "mRNA", "t"), ("odd word", "unknown", "u"))}
    w = v.withColumn("effects", F.lit("EXON_DELETED(HIGH|||||||||T|1),CODON_INSERTION(LOW|||||||||T|1)"))
    assert {r.effect for r in rd.variant_effects(w, "snpeff").collect()} == {"exon_loss_variant", "inframe_insertion"}


def test_end_to_end_tests_have_rounds_enough(spark):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("the driver's tables are not here")
    for name in ("r6_enrichment_simple", "r7_enrichment_transcripts"):
        p = [r.p for r in registry.QUERIES[name](spark, sf).select("p").collect()]
        assert p and all(math.isclose(50 * x, round(50 * x), abs_tol=1e-9) for x in p) and any(not math.isclose(2 * x, round(2 * x)) for x in p)

"""Values worked out by hand from the rules, and brute force for the operators that work by stretches."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from locuspark.functions import binomial as bn
from locuspark.functions import features as ft
from locuspark.functions import statistics as st
from locuspark.operators import classify as cl
from locuspark.operators import compose as cm
from locuspark.operators import coverage as cv
from locuspark.operators import enrich as en
from locuspark.operators import intervals as iv
from locuspark.operators import merge as mg
from locuspark.sources import readers as rd


def test_class_and_family_of_every_spelling(spark):
    rows = [
        ("LINE/L1", "L1MA", "LINE", "L1"), ("LTR/ERV1/x", "MER4", "LTR", "ERV1_x"), ("hAT.DNA", "a", "DNA", "hAT"), ("a.b.c", "a", "c", "a.b"), ("Unknown", "a", "Unknown", "Unknown"),
        ("LTR/ERVL", "HERV-int", "LTR", "ERVL--int"), ("LTR/ERVL", "HERV_Int_2", "LTR", "ERVL--int"), ("LTR/ERVL", "X-I", "LTR", "ERVL--int"), ("LTR/ERVL", "X-i", "LTR", "ERVL"), ("LTR/Gypsy", "G-int", "LTR", "Gypsy"),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "classfam string, rname string")
    got = {(r.classfam, r.rname): (r.rclass, r.rfam) for r in ft.split_class_family(df).collect()}
    assert got == {r[:2]: r[2:] for r in rows}
    assert ft.split_class_family(df, internal=False).where("rfam LIKE '%--int'").count() == 0


def test_categories_where_edges_are_equal(spark):
    j = spark.createDataFrame([(100, 150, "FIRST"), (99, 150, "FIRST"), (120, 200, "FIRST"), (120, 201, "FIRST"), (99, 201, "indet"), (100, 200, "SINGLE")], "te_st long, te_en long, exon_type string").withColumns({"st": F.lit(100), "en": F.lit(200), "strand": F.lit("+"), "side": F.lit("up")})
    cats = lambda d: [r.category for r in d.orderBy("te_st", "te_en").collect()]
    assert cats(cl.classify_exon(j)) == ["TSS", "indet", "exonized", "exonized", "exonized", "5SPL"]
    assert cats(cl.classify_exon(j, coding=True)) == ["ATG", "indet", "exonized", "exonized", "exonized", "5SPL"]
    assert cats(cl.classify_exon(j, inclusive=True)) == ["TSS", "indet", "TSS", "TSS_polyA", "5SPL", "5SPL"]
    assert cats(cl.classify_intron(j)) == ["SPL", "5SPL_3SPL", "intronized", "intronized", "intronized", "SPL"]
    assert cats(cl.classify_intron(j, sides=True)) == ["5SPL", "5SPL_3SPL", "intronized", "intronized", "intronized", "3SPL"]
    assert cats(cl.classify_flank(j)) == ["partial", "TSS_Full", "included", "included", "included", "TSS"]


def test_categories_of_the_enrichment_test(spark):
    # a transcript 100..900 of three exons 100..200, 400..500, 800..900
    rows = [
        ("+", 99, 901, 400, 500, 3, "TSS_polyA"), ("+", 100, 901, 800, 900, 3, "3SPL_polyA"), ("+", 99, 300, 100, 200, 3, "TSS_5SPL"), ("-", 99, 300, 100, 200, 3, "3SPL_polyA"), ("-", 700, 950, 800, 900, 3, "TSS_5SPL"),
        ("+", 390, 510, 400, 500, 3, "3SPL_exon_5SPL"), ("+", 90, 150, 100, 200, 3, "TSS"), ("-", 90, 150, 100, 200, 3, "polyA"), ("+", 390, 450, 400, 500, 3, "3SPL"), ("-", 390, 450, 400, 500, 3, "5SPL"),
        ("+", 850, 950, 800, 900, 3, "polyA"), ("-", 850, 950, 800, 900, 3, "TSS"), ("+", 450, 510, 400, 500, 3, "5SPL"), ("-", 450, 510, 400, 500, 3, "3SPL"), ("+", 100, 200, 100, 200, 3, "exonized"), ("+", 90, 150, 100, 900, 1, "TSS"), ("-", 850, 950, 100, 900, 1, "TSS"),
    ]
    df = spark.createDataFrame([(i, *r[:6], 100, 900) for i, r in enumerate(rows)], "i int, strand string, te_st long, te_en long, st long, en long, n_exons int, tr_st long, tr_en long")
    assert [r.category for r in cl.classify_shuffle(df).orderBy("i").collect()] == [r[6] for r in rows]


def test_consensus_ends_of_fragments_with_indels(spark):
    # 100..199 aligns to 11..90: twenty bases inserted; the feature covers 120..150
    row = ("+", 100, 199, 11, 90, 10, 120, 150)
    cols = "te_strand string, te_st long, te_en long, rep_start long, rep_end long, rep_left long, o_st long, o_en long"
    df = spark.createDataFrame([row, ("C", *row[1:]), (*row[:6], 100, 199)], cols)
    ends = lambda force=None: [(r.con_start, r.con_end, r.con_left) for r in cv.lift_to_consensus(df, force).collect()]
    # plus: 11 + 20, 90 - 49; minus: 11 + 49, 90 - 20, swapped where reversed; whole: as it is
    assert ends() == [(31, 41, 59), (60, 70, 30), (11, 90, 10)]
    assert ends("Rstart") == [(31, 61, 39), (60, 90, 10), (11, 90, 10)]
    assert ends("Rend") == [(11, 41, 59), (40, 70, 30), (11, 90, 10)]


def test_weighted_smoothing_values(spark):
    df = spark.createDataFrame([("g", k, float(x), n) for k, (x, n) in enumerate([(1, 1), (2, 3), (4, 2), (8, 5)])] + [("h", 1, 5.0, 2), ("h", 2, None, 2)], "g string, k long, x double, n long")
    got = {(r.g, r.k): r.smoothed for r in st.weighted_smooth(df, ["g"], "k", "x", "n", 0.4).collect()}
    s, w, want = 1.0, 1.0, [1.0]
    for x, n in ((2, 3), (4, 2), (8, 5)):
        a, b = 0.4 * w / (w + n), 0.6 * n / (w + n)
        s, w = (a * s + b * x) / (a + b), (a * w + b * n) / (a + b)
        want.append(s)
    assert [round(got["g", k], 9) for k in range(4)] == [round(v, 9) for v in want] and got["h", 1] == 5.0 and len(got) == 5
    assert [round(v, 3) for v in want] == [1.0, 1.818, 2.979, 6.823]
    one = {r.k: r.smoothed for r in st.exp_smooth(df.where("g = 'g'"), [], "k", "x", 0.4).collect()}
    assert [round(one[k], 4) for k in range(4)] == [1.0, 1.6, 3.04, 6.016]


def test_labels_and_subsets_of_run_names(spark):
    names = ["a.b.exons", "x.introns.nr", "x.up.1000.corr", "x.dw.5000.corr", "x.CDS", "y.UTRs", "other", "x.up.corr"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    name, region = mg.region_of_run(F.col("n"))
    got = [(r[0], r[1]) for r in df.orderBy("i").select(name, region).collect()]
    assert got == [("a.b", "02.exons"), ("x", "04.introns"), ("x", "01.up"), ("x", "03.dw"), ("x", "02.CDS"), ("y", "02.UTR"), ("nd", "nd"), ("nd", "nd")]
    parts = spark.createDataFrame([("set.v2.nonTE.parsed",), ("f.p",), ("one",)], "n string").select(*mg.run_subset(F.col("n"))).collect()
    assert [tuple(r) for r in parts] == [("set.v2", "nonTE.parsed"), ("", "f.p"), ("", ".one")]


def test_parsed_tables_of_both_layouts(spark, tmp_path):
    new = ["#Rname\tRclass\tRfam\tRlen\tFRG_NB_all", "L1MA\tLINE\tL1\t900\t7\t5\t1000\t1\t1\t1\t1\t1\t1\t1\t2.5\t100\t0.5\t10", "l1ma\tLINE\tL1\t900\t1\t1\t50\t1\t1\t1\t1\t1\t1\t1\t0.5\t0\t0\t0", "H-int\tLTR\tERV1/x\t1\t1\t1\t9\t1\t1\t1\t1\t1\t1\t1\t0.1"]
    (tmp_path / "new.tab").write_text("\n".join(new) + "\n")
    got = {r.rname_lc: r for r in rd.read_parsed_rm(spark, str(tmp_path / "new.tab")).collect()}
    assert (got["l1ma"].g_len, got["l1ma"].g_count, got["l1ma"].g_nr) == (950, 8, 6) and math.isclose(got["l1ma"].g_pct, 2.5)
    assert got["h-int"].g_len == 9 and got["h-int"].rfam == "ERV1_x--int"
    old = ["#Rname\tRclass\tRfam\tRfullname\tRlen\tx\tMED_LEN_MASKED", "\t".join(["A", "DNA", "hAT", "A#DNA/hAT", "900", "x", "7", "x", "5", *["x"] * 6, "1000", "x", "x", "2.5", "100", "0.5"])]
    (tmp_path / "old.tab").write_text("\n".join(old) + "\n")
    (r,) = rd.read_parsed_rm(spark, str(tmp_path / "old.tab")).collect()
    assert (r.g_len, r.g_count, r.g_nr, r.g_pct) == (900, 7, 5, 2.0)
    (tmp_path / "nd.tab").write_text(new[0] + "\n" + new[1].replace("\t2.5\t", "\tnd\t") + "\n")
    with pytest.raises(Exception, match="nd"):
        rd.read_parsed_rm(spark, str(tmp_path / "nd.tab")).collect()


def test_one_outlier_goes_whatever_its_key(spark):
    low = [(1, 1.0), (1, 2.0), (1, 2.5), (3, 1.5), (3, 1.7), (3, 1.9)]
    df = spark.createDataFrame([*low, (1, 99.0), (2, 99.0), (1, 99.0)], "k long, v double")
    kept = st.drop_outlier(df, "v", lambda v, m: F.abs(v - m) > 1, "k")
    assert sorted(map(tuple, kept.collect())) == sorted([*low, (1, 99.0), (2, 99.0)])
    assert st.drop_outlier(df, "v", lambda v, m: F.abs(v - m) > 1e6, "k").count() == 9


@pytest.mark.parametrize("n", [1, 2, 3, 10, 997])
def test_order_statistics_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    v = np.round(rng.normal(size=n) * rng.choice([1, 100], n), 2)
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    r = st.order_stats(df, "v", percent=90, trim=0.1).first()
    q = np.quantile(v, [0.25, 0.5, 0.75])
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip((r.q1, r.median, r.q3), q)) and r.n == n
    s = np.sort(v)
    cut = int(n * 0.1)
    assert math.isclose(r.trimmed_mean, s[cut : n - cut].mean(), abs_tol=1e-9)
    assert r.percentile == (s[math.ceil(n * 90 / 100) - 1] if 90 >= 100 / n else None)


def test_nearest_and_gaps_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(iv, "STRETCH", 50)
    rng = random.Random(1)
    a = [(i, rng.choice("cd"), s, s + rng.randrange(1, 40)) for i, s in enumerate(rng.randrange(1, 3000) for _ in range(120))]
    b = [(i, rng.choice("cd"), s, s + rng.randrange(1, 20), rng.choice("+-")) for i, s in enumerate(rng.randrange(1, 3000) for _ in range(25))]
    ta, tb = spark.createDataFrame(a, "aid long, chrom string, start long, end long"), spark.createDataFrame(b, "bid long, chrom string, start long, end long, strand string")
    got = {r.aid: (r.bid, r.distance) for r in iv.nearest(ta, tb, "aid", "bid").collect()}
    for i, c, s, e in a:
        best = min(((max(0, bs - e, s - be), bid, bs, be, sd) for bid, bc, bs, be, sd in b if bc == c), default=None)
        d, bid, bs, be, sd = best
        sign = 1 if (s > be) == (sd == "+") else -1
        assert got[i] == (bid, d * sign if d else 0), i
    sizes = spark.createDataFrame([("c", 3100), ("d", 2900), ("e", 7)], "chrom string, length long")
    gaps = {(r.chrom, p) for r in iv.interval_complement(ta, sizes).collect() for p in range(r.start, r.end + 1)}
    taken = {(c, p) for _, c, s, e in a for p in range(s, e + 1)}
    assert gaps == {(c, p) for c, n in (("c", 3100), ("d", 2900), ("e", 7)) for p in range(1, n + 1)} - taken


def windows(df):
    return re.findall(r"Window \[.*?\], \[(.*?)\], \[", df._jdf.queryExecution().executedPlan().toString())


def test_no_window_over_rows_spans_a_chromosome(spark):
    te = spark.createDataFrame([("c", 1, 9, 1, "+")], "chrom string, start long, end long, te_id long, strand string")
    sizes = spark.createDataFrame([("c", 100)], "chrom string, length long")
    for df in (iv.nearest(te, te.withColumnRenamed("te_id", "b"), "te_id", "b"), iv.interval_complement(te, sizes), iv.merge_intervals(te), iv.covered_amount(te, parity=True)):
        for spec in re.findall(r"windowspecdefinition\((.*?), specifiedwindowframe", df._jdf.queryExecution().optimizedPlan().toString()):
            keys = re.sub(r"#\d+L?", "", spec)
            assert "_bin" in keys, keys  # per stretch, or over the stretches' own rows


def test_sequences_of_split_files(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 one\nACGT\nAC\n\n>s2\nGG\n")
    (tmp_path / "b.fa").write_text(">s3 > odd\n" + "ACGTN" * 10 + "\n" + "TT\n" * 2000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        chunks = rd.fasta_chunks(spark, str(tmp_path))
        assert chunks.rdd.getNumPartitions() >= 1
        got = {r.chrom: r.seq for r in rd.fasta_records(spark, str(tmp_path)).collect()}
        assert got == {"s1": "ACGTAC", "s2": "GG", "s3": "ACGTN" * 10 + "TT" * 2000}
        assert {r.chrom: r.length for r in rd.fasta_lengths(spark, str(tmp_path)).collect()} == {k: len(v) for k, v in got.items()}
        assert [(r.start, r.seq) for r in chunks.where("chrom = 's1'").orderBy("start").collect()] == [(1, "ACGT"), (5, "AC")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "x.gff3").write_text("##gff-version 3\nc\ts\tgene\t1\t9\t.\t+\t.\tID=g\n##FASTA\n>c a\tb\nACGT\n")
    (f,) = rd.read_many(spark, str(tmp_path / "g"), rd.read_gff3).collect()
    assert (f.feature_id, f.run) == ("g", "x.gff3")


def test_binomial_of_any_size_and_its_limits():
    assert bn.binomial_p(500_000_000_000, 1_000_000_000_000, 0.5) == 1.0
    far = bn.binomial_p(500_001_000_000, 1_000_000_000_000, 0.5)  # two standard deviations
    assert math.isclose(far, math.erfc(2 / math.sqrt(2)), rel_tol=1e-4)
    assert 0 < bn.binomial_p(10, 1_000_000, 0.0001) < 1e-20 and bn.binomial_p(0, 40_000_000, 0.5) == 0.0
    lo, hi = bn.clopper_pearson(400, 1000)
    pmf = lambda p: np.exp([math.lgamma(1001) - math.lgamma(k + 1) - math.lgamma(1001 - k) + k * math.log(p) + (1000 - k) * math.log1p(-p) for k in range(1001)])
    assert math.isclose(pmf(lo)[400:].sum(), 0.025, rel_tol=1e-6) and math.isclose(pmf(hi)[:401].sum(), 0.025, rel_tol=1e-6)


@pytest.mark.parametrize("strict", [False, True])
def test_ranks_equal_the_zero_filled_rounds(spark, strict):
    rng = random.Random(3)
    obs = spark.createDataFrame([(k, rng.randrange(0, 4)) for k in range(8)], "k long, hits long")
    exp = spark.createDataFrame([(k, r, rng.randrange(1, 5)) for k in range(4, 12) for r in range(1, 11) if rng.random() < 0.6], "k long, round long, hits long")
    got = {r.k: r for r in en.permutation_test(obs, exp, ["k"], 10, strict).collect()}
    own = {r.k: r.hits for r in obs.collect()}
    full = {}
    for r in en.expected_initialised(obs, exp, ["k"], 10).collect():
        full.setdefault(r.k, []).append(r.hits)
    assert got.keys() == full.keys()
    for k, hits in full.items():
        o = own.get(k, 0)
        rank = 1 + sum(h < o if strict else h <= o for h in hits)
        assert (got[k].obs, got[k]["rank"]) == (o, rank)
        assert math.isclose(got[k].exp_mean, np.mean(hits), abs_tol=1e-12) and math.isclose(got[k].exp_sd, np.std(hits, ddof=1), abs_tol=1e-9)


def test_transcript_hits_by_category_level_and_gene(spark):
    rows = [("g1", "t1", 1, "LINE", "L1", "a", "TSS"), ("g1", "t1", 1, "LINE", "L1", "b", "TSS"), ("g1", "t1", 2, "LINE", "L2", "c", "5SPL"), ("g2", "t2", 1, "DNA", "hAT", "d", "TSS")]
    df = spark.createDataFrame(rows, "gene string, tr string, k int, rclass string, rfam string, rname string, category string")
    got = {(r.category, r.rclass, r.rfam, r.rname): r.hits for r in cm.hits_by_category(df).collect()}
    assert got["TSS", "tot", "tot", "tot"] == 2 and got["TSS", "LINE", "tot", "tot"] == 1 and got["TSS", "LINE", "L1", "b"] == 1
    assert got["transcript", "tot", "tot", "tot"] == 2 and ("transcript", "LINE", "tot", "tot") not in got and len(got) == 13


def test_buckets_of_unknown_and_renamed_classes(spark):
    rows = [("ERV", "ERV1--int", "ERV/LTRint", "LTR"), ("LTR", "ERVK", "ERV/LTRs", "LTR"), ("LTR", "Copia", "LTR/Others", "LTR"), ("RC", "Helitron", "DNA/Helitrons", "DNA"), ("DNA", "maverick", "DNA/Tlr,Mavericks,Polintons", "DNA"), ("Unknown", "x", "Others", "Others"), ("tRNA", "x", "Others", "Others"), ("nonTE", "x", "nonTE", "nonTE"), ("SINE", "alu", "nonLTR/SINE/B3,B4,others", "SINE"), ("LINE", "RTE", "nonLTR/LINE/L2,3,4", "LINE")]
    df = spark.createDataFrame([r[:2] for r in rows], "rclass string, rfam string")
    assert {tuple(r) for r in cl.te_bucket(df).select("rclass", "rfam", "superfamily", "class6").collect()} == set(rows)

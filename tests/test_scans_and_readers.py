"""Scans, sweeps and doublings against loops; records, repeated names and effect words of readers."""

import functools
import random
import statistics
from collections import defaultdict

import pytest

from locuspark.functions import features as ft
from locuspark.functions import statistics as st
from locuspark.operators import annotation as an
from locuspark.operators import intervals as iv
from locuspark.operators import model as md
from locuspark.sources import readers as rd


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("kind", ["long", "string"])
def test_nearest_takes_the_smallest_id_of_all_that_are_equally_close(spark, kind):
    name = (lambda i: i) if kind == "long" else (lambda i: f"s{i:02d}")
    a = spark.createDataFrame([("c", 100, 110, name(1)), ("c", 300, 310, name(2)), ("c", 500, 510, name(3))], f"chrom string, start long, end long, aid {kind}")
    b = [
        ("c", 10, 50, "+", name(1)), ("c", 20, 50, "+", name(2)), ("c", 160, 170, "+", name(3)),  # both ends, either side at 50
        ("c", 360, 370, "-", name(4)), ("c", 360, 365, "+", name(5)), ("c", 240, 250, "+", name(6)),
        ("c", 505, 520, "+", name(9)), ("c", 490, 500, "+", name(8)), ("c", 511, 511, "+", name(7)),
    ]
    tb = spark.createDataFrame(b, f"chrom string, start long, end long, strand string, bid {kind}")
    for stretch in (30, 1000):
        got = {r.aid: (r.bid, r.distance) for r in iv.nearest(a, tb, "aid", "bid", stretch).collect()}
        assert got == {name(1): (name(1), 50), name(2): (name(4), 50), name(3): (name(8), 0)}


def test_nearest_equals_all_pairs(spark):
    rng = random.Random(9)
    a = [(i, "c", s, s + rng.randrange(1, 9)) for i, s in enumerate(rng.randrange(1, 300) for _ in range(60))]
    b = [(f"b{i:02d}", "c", s, s + rng.randrange(1, 9), rng.choice("+-")) for i, s in enumerate(rng.randrange(1, 300) for _ in range(25))]
    got = iv.nearest(spark.createDataFrame(a, "aid long, chrom string, start long, end long"), spark.createDataFrame(b, "bid string, chrom string, start long, end long, strand string"), "aid", "bid", 40)
    for r in got.collect():
        _, _, s, e = a[r.aid]
        d, bid, bs, be, strand = min((max(0, bs - e, s - be), bid, bs, be, strand) for bid, _, bs, be, strand in b)
        assert (r.bid, r.distance) == (bid, d * (1 if (s > be) == (strand == "+") else -1))


def test_hot_bins_are_cut_into_blocks(spark):
    n = 10_000
    a = spark.range(n).selectExpr("'c' AS chrom", "CAST(100 + id % 7 AS BIGINT) AS start", "CAST(108 AS BIGINT) AS end", "id")
    b = spark.range(n).selectExpr("'c' AS chrom", "CAST(101 AS BIGINT) AS start", "CAST(102 + id % 5 AS BIGINT) AS end", "id")
    few = [iv.overlap_join(a.where("id < 300"), b.where("id < 200"), hot_rows=k) for k in (None, 40)]
    rows = [sorted((r.a_id, r.b_id, r.overlap) for r in d.collect()) for d in few]
    assert rows[0] == rows[1] and len(rows[0]) > 10_000
    x, y = iv._cut_hot(a.withColumn("_bin", a.start * 0), b.withColumn("_bin", b.start * 0), ["chrom"], ["chrom"], ["_bin"], 1000)
    blocks = x.groupBy("_row", "_column").count().join(y.groupBy("_row", "_column").count().withColumnRenamed("count", "m"), ["_row", "_column"]).collect()
    work = sorted(r["count"] * r["m"] for r in blocks)
    assert len(work) == 100 and sum(work) == n * n and work[-1] < 3 * work[50]


def test_subtraction_sweeps_rows_longer_than_a_stretch(spark):
    rng = random.Random(3)
    a = [("c", 1, 2000, "x"), ("c", 1, 2000, "x"), ("c", 50, 60, None), ("d", 5, 900, "y"), ("d", 1000, 1100, "z"), ("e", 1, 9, "w")]
    b = [(rng.choice("cd"), s, s + rng.randrange(0, 15)) for s in (rng.randrange(1, 2100) for _ in range(120))] + [("d", 995, 1200)]
    ta = spark.createDataFrame(a, "chrom string, start long, end long, name string")
    out = iv.subtract_intervals(ta, spark.createDataFrame(b, "chrom string, start long, end long"), bin_size=50, stretch=100)
    want = []
    for c, s, e, n in a:
        free = [p for p in range(s, e + 1) if not any(c == x and u <= p <= v for x, u, v in b)]
        for p in free:
            if p - 1 in set(free) and want and want[-1][0] == c and want[-1][2] == p - 1 and want[-1][3] == (n or ""):
                want[-1][2] = p
            else:
                want.append([c, p, p, n or ""])
    assert sorted((r.chrom, r.start, r.end, r.name or "") for r in out.collect()) == sorted(map(tuple, want))
    assert "collect_list" not in plan(out)


def test_descendants_double_their_reach(spark):
    rel = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(300)], "parent string, child string")
    joins, real = [], type(rel).join
    type(rel).join = lambda self, *a, **k: joins.append(1) or real(self, *a, **k)
    try:
        got = an.descendants(rel)
    finally:
        type(rel).join = real
    assert len(joins) <= 10 and got.count() == 300 * 301 // 2
    assert got.where("depth <> CAST(descendant AS INT) - CAST(ancestor AS INT)").count() == 0
    assert an.descendants(rel, 5).agg({"depth": "max"}).first()[0] == 5
    loop = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")], "parent string, child string")
    assert {(r.ancestor, r.descendant): r.depth for r in an.descendants(loop).collect()} == {("a", "b"): 1, ("a", "c"): 1, ("b", "c"): 1, ("c", "a"): 1, ("a", "a"): 2, ("b", "a"): 2, ("c", "b"): 2, ("c", "c"): 2, ("b", "b"): 3}


def test_splice_complexity_equals_the_mean_over_pairs_and_makes_none(spark):
    rng = random.Random(8)
    rows = [(g, 10 * g + t, "c", s, s + rng.randrange(5, 40)) for g in range(4) for t in range(1 + 3 * g) for s in (rng.randrange(1, 200) for _ in range(3))]
    exons = spark.createDataFrame(rows, "gene long, tr long, chrom string, start long, end long")
    want = {r.gene: r.m for r in md.aed(md.transcript_pairs(exons), exons).groupBy("gene").agg({"aed": "avg"}).withColumnRenamed("avg(aed)", "m").collect()}
    got = {r.gene: r.complexity for r in md.splice_complexity(exons).collect()}
    assert got.pop(0) is None and got == pytest.approx(want)
    many = spark.range(2000).selectExpr("1L AS gene", "id AS tr", "'c' AS chrom", "1L AS start", "CAST(10 + 10 * (id % 2) AS BIGINT) AS end")
    r = md.splice_complexity(many).first()
    same, differ = 2 * (1000 * 999 // 2), 1000 * 1000
    assert r.complexity == pytest.approx(differ * (1 - (1 + 0.5) / 2) / (same + differ))


def test_smoothing_hands_on_between_partitions(spark):
    rng = random.Random(4)
    rows = [(g, i, rng.random() if rng.random() > 0.05 else None) for g in (1, 2, 3) for i in range(900 if g == 1 else 20)] + [(None, 1, 5.0), (None, 2, 7.0)]
    df = spark.createDataFrame(rows, "g long, i long, x double").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.g, r.i): r.smoothed for r in st.exp_smooth(df, ["g"], "i", "x", 0.7).collect()}
        alone = {r.i: r.smoothed for r in st.exp_smooth(df.where("g = 1"), [], "i", "x", 0.7).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    state = {}
    for g, i, x in sorted(rows, key=lambda r: (r[0] or 0, r[1])):
        if x is not None:
            state[g] = x if g not in state else 0.7 * state[g] + (1 - 0.7) * x
            assert g is None or got[g, i] == pytest.approx(state[g], abs=1e-12)
            assert g != 1 or alone[i] == pytest.approx(state[g], abs=1e-12)


def test_ranks_in_one_task_and_in_buckets_are_the_same(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.randrange(3), float(rng.randrange(80))) for _ in range(700)] + [(1, None), (9, None)], "g long, v double")
    for by in (["g"], []):
        one, many = (sorted(tuple(r[c] for c in (*by, "_v", "_k", "_below", "_n")) for r in st.ranked_values(df, "v", by, buckets=7, one_task=k).collect()) for k in (None, 0))
        assert one == many and one
    for r in st.mad(df, "v", ["g"]).where("mad IS NOT NULL").collect():
        own = [x.v for x in df.where(f"g = {r.g} AND v IS NOT NULL").collect()]
        m = statistics.median(own)
        assert r.mad == statistics.median(abs(v - m) for v in own)


def test_frequencies_by_bisection(spark):
    rng = random.Random(6)
    values = [rng.randrange(-5, 120) / 2 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for limits in ([3.0], [0.0, 7.5, 7.500001, 20.0, 41.0], [float(i) for i in range(64)]):
        got = [(r.upper, r.n) for r in st.frequency(df, "v", limits).orderBy("upper").collect()]
        low = [float("-inf"), *limits[:-1]]
        assert got == [(u, sum(a < v <= u for v in values)) for a, u in zip(low, limits)]
    assert sum(r.n for r in st.frequency(df, "v", 9).collect()) == 500


def test_records_end_at_each_files_own_marker(spark, tmp_path):
    def text(name, rows, stop):
        body = [x for k in range(rows) for x in (f"{name} {k}", "# note", "")]
        (tmp_path / name).write_text("##meta\n\n# c\nH1\n# d\nH2\n" + "\n".join(body[:stop]) + "\n##FASTA\n" + "\n".join(body[stop:]) + "\n##FASTA\n")
        return [x for x in body[:stop] if x and x[0] != "#"]

    want = text("a.txt", 400, 900) + text("b.txt", 300, 33)
    (tmp_path / "c.txt").write_text("H1\n#\nH2\nonly")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        got = rd.read_records(spark, str(tmp_path), header_count=2, end_of_data="^##FASTA")
        assert got.rdd.getNumPartitions() > 5
        assert sorted(r.value for r in got.collect()) == sorted([*want, "only"])
        assert rd.read_records(spark, str(tmp_path / "a.txt"), metadata="^##").count() == 402
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_the_last_row_of_a_repeated_name_counts(spark, tmp_path):
    head = "#Rname\tRclass\tRfam\n"
    row = lambda n, c, d: f"{n}\t{c}\tF/x\t{c}/F\t{d}\tL\tOld\n"
    (tmp_path / "run1.tab").write_text(head + row("Alu", "A", 1) + "".join(row(f"n{i}", "X", 0) for i in range(200)) + row("ALU", "B", 2))
    (tmp_path / "run2.tab").write_text(head + row("aLu", "C", 3))
    info = rd.read_te_info(spark, str(tmp_path / "run1.tab"))
    assert [(r.rname, r.rclass, r.pct_div) for r in info.where("rname_lc = 'alu'").collect()] == [("ALU", "B", 2.0)]
    many = rd.read_many(spark, str(tmp_path / "*"), functools.partial(rd.read_te_info, per_file=True), r"(run\d)")
    assert sorted((r.run, r.rclass) for r in many.where("rname_lc = 'alu'").collect()) == [("run1", "B"), ("run2", "C")]
    te = spark.createDataFrame([("alu", "q", "q")], "rname string, rclass string, rfam string")
    twice = spark.createDataFrame([("f", (0, 2), "Alu", "late", "F"), ("f", (0, 1), "alu", "zearly", "F")], "file string, place struct<split:long,at:long>, rname string, rclass string, rfam string")
    assert ft.override_class(te, twice).first().rclass == "late"
    assert ft.override_class(te, twice.drop("place")).first().rclass == "zearly"
    (tmp_path / "fa").mkdir()
    (tmp_path / "fa" / "x1.fa").write_text(">s\nAC\n")
    (tmp_path / "fa" / "x2.fa").write_text(">s\nG\n")
    got = rd.read_many(spark, str(tmp_path / "fa"), functools.partial(rd.fasta_chunks, per_file=True), r"(x\d)\.fa")
    assert sorted((r.run, r.seq) for r in got.collect()) == [("x1", "AC"), ("x2", "G")]


#: Each word with its effect and, if it implies one, the variant's type for A>AC.
ANNOVAR = {
    "frameshift insertion": ("frameshift_elongation", "insertion"), "frameshift deletion": ("frameshift_truncation", "deletion"), "frameshift block substitution": ("frameshift_variant", "complex_substitution"),
    "stopgain SNV": ("stop_gained", "SNV"), "stoploss SNV": ("stop_lost", "SNV"), "nonframeshift insertion": ("inframe_insertion", "insertion"), "nonframeshift deletion": ("inframe_deletion", "deletion"),
    "nonframeshift block substitution": ("inframe_variant", "complex_substitution"), "nonsynonymous SNV": ("missense_variant", "SNV"), "synonymous SNV": ("synonymous_variant", "SNV"), "unknown": ("sequence_variant", "sequence_alteration"),
    "exonic": ("exon_variant", None), "splicing": ("splice_site_variant", None), "ncRNA": ("non_coding_transcript_variant", None), "UTR5": ("5_prime_UTR_variant", None), "UTR3": ("3_prime_UTR_variant", None),
    "intronic": ("intron_variant", None), "upstream": ("upstream_gene_variant", None), "downstream": ("downstream_gene_variant", None), "intergenic": ("intergenic_variant", None), "odd": ("odd", None),
}


def test_annovar_words(spark):
    rows = [(w, "A", ["AC"], f"{w}:T1") for w in ANNOVAR] + [("mnp", "AG", ["CT"], "nonframeshift block substitution:T1")]
    got = defaultdict(set)
    for r in rd.variant_effects(spark.createDataFrame(rows, "feature_id string, reference_seq string, variant_seq array<string>, effects string"), "annovar").collect():
        got[r.feature_id].add((r.effect, r.variant_type, r.target))
    assert got == {**{w: {(e, t, "T1")} for w, (e, t) in ANNOVAR.items()}, "mnp": {("inframe_variant", "MNP", "T1")}}


def test_lines_with_children_and_sequence_headers(spark, tmp_path):
    from locuspark.sources import writers as wr

    rows = [
        ("g1", "gene", 1, 90, "+", None), ("t1", "mRNA", 1, 90, "+", ["g1"]), ("t2", "mRNA", 5, 80, "+", ["g1"]), ("e1", "exon", 1, 20, "+", ["t1", "t2"]), ("e2", "exon", 60, 80, "+", ["t1"]),
        ("g2", "gene", 200, 300, "-", None), ("t3", "mRNA", 200, 300, "-", ["g2"]), ("e3", "exon", 200, 210, "-", ["t3"]), ("e4", "exon", 250, 300, "-", ["t3"]),
    ]
    made = [("c", "src", kind, s, e, ".", strand, ".", i, {"ID": [i], **({"Parent": p} if p else {})}) for i, kind, s, e, strand, p in rows]
    f = spark.createDataFrame(made, "seqid string, source string, type string, start long, end long, score string, strand string, phase string, feature_id string, attributes map<string,array<string>>")
    roots = f.where("feature_id IN ('t1', 'g2')").select("feature_id")
    assert sorted(r.feature_id for r in wr.with_children(f, roots).collect()) == ["e1", "e2", "e3", "e4", "g2", "t1", "t3"]
    wr.write_gff3(f, str(tmp_path / "out"), roots)
    lines = [r.value.split("\t") for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(x[-1].split(";")[0] for x in lines) == [f"ID={i}" for i in ("e1", "e2", "e3", "e4", "g2", "t1", "t3")]
    heads = {r.feature_id: r.header for r in wr.fasta_headers(f).collect()}
    assert heads["g1"] == "g1 locus=c:1-90;strand=+;type=gene;"
    assert heads["t2"] == "t2 locus=c:5-80;strand=+;type=mRNA;parent=g1;sib_count=2:2;"
    assert heads["e1"] == "e1 locus=c:1-20;strand=+;type=exon;parent=t1,t2;sib_count=1:2;"
    assert heads["e4"] == "e4 locus=c:250-300;strand=-;type=exon;parent=t3;sib_count=1:2;" and heads["t3"].endswith("parent=g2;")

"""Composition reports, filters and accessors over the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.functions import features as ft
from locuspark.operators import classify as cl
from locuspark.operators import compose as cm
from locuspark.operators import model as md
from locuspark.plans.fixtures import Fixtures
from locuspark.plans.interval_queries import MERGE
from locuspark.plans.model_queries import CATS, NUMBER, REAL, REAL_HIT, SHUFFLE, SITES, STRUCT, by_number, real, structure, with_cats, with_shuffle_cats
from locuspark.plans.registry import query

#: Non-redundant overlap length per {by}, in DuckDB.
NR = """SELECT {by}, CAST(sum(en - st + 1) AS BIGINT) AS nr_len FROM (SELECT {by}, chrom, isl, min(st) AS st, max(en) AS en FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR st > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY {by}, chrom ORDER BY st, en, o ROWS UNBOUNDED PRECEDING) AS isl FROM (
    SELECT *, max(en) OVER (PARTITION BY {by}, chrom ORDER BY st, en, o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (
      SELECT {by}, chrom, greatest(te_st, st) AS st, least(te_en, en) AS en, row_number() OVER (ORDER BY te_id, tr, k) AS o FROM {t}))) GROUP BY {by}, chrom, isl) GROUP BY {by}"""
INFO = "ti AS (SELECT 'R' || i AS rname, 'L' || (i % 5) AS lineage, CASE WHEN i % 2 = 0 THEN 'Ancient' ELSE 'LineageSpe' END AS age, CAST(i AS DOUBLE) AS pct_div FROM range(0, 50) t(i))"
SIX = "CASE WHEN rclass = 'RC' THEN 'DNA' WHEN rclass = 'Simple_repeat' THEN 'Others' ELSE rclass END"


def te_info(fx: Fixtures) -> DataFrame:
    """A repeat table derived from the repeats' own names; names from 50 on are missing."""
    i = F.regexp_extract("rname", r"(\d+)", 1).cast("int")
    return fx.te.select("rname").distinct().where(i < 50).select("rname", F.concat(F.lit("L"), (i % 5).cast("string")).alias("lineage"), F.when(i % 2 == 0, "Ancient").otherwise("LineageSpe").alias("age"), i.cast("double").alias("pct_div"))


def hits(fx: Fixtures) -> DataFrame:
    return fx.raw("hit")


@query("a2_nr_length_by_class", "hit", sql=NR.format(by="rclass", t="hit"))
def a2(fx: Fixtures) -> DataFrame:
    return cm.nr_length(hits(fx), ["rclass"])


@query("a2_nr_length_by_transcript", "hit", sql=NR.format(by="tr", t="hit"))
def a2b(fx: Fixtures) -> DataFrame:
    return cm.nr_length(hits(fx), ["tr"])


@query("a2_nr_length_adjacent", "hit", sql="""SELECT rname, CAST(sum(CASE WHEN p >= en THEN 0 WHEN p >= st THEN en - p ELSE en - st + 1 END) AS BIGINT) AS nr_len FROM (
  SELECT *, lag(en) OVER (PARTITION BY rname, chrom ORDER BY st, en) AS p FROM (SELECT rname, chrom, greatest(te_st, st) AS st, least(te_en, en) AS en FROM hit)) GROUP BY rname""")
def a2c(fx: Fixtures) -> DataFrame:
    return cm.nr_length(hits(fx), ["rname"], parity=True)


@query("a3_fragment_counts", "hit", sql="SELECT rname, count(*) AS fragments, count(DISTINCT (rname, block, chrom)) AS nr_fragments, count(DISTINCT chrom) AS n_chrom FROM hit GROUP BY rname")
def a3(fx: Fixtures) -> DataFrame:
    return cm.fragment_counts(hits(fx))


LEVELS = """SELECT coalesce(rclass, 'tot') AS rclass, coalesce(rfam, 'tot') AS rfam, coalesce(rname, 'tot') AS rname, {agg} FROM {t} GROUP BY ROLLUP (rclass, rfam, rname)"""


@query("a5_hits_by_level", "hit", sql=LEVELS.format(agg="count(DISTINCT (tr, k)) AS hits", t="hit"))
def a5(fx: Fixtures) -> DataFrame:
    return cm.hits_by_level(hits(fx), ["tr", "k"])


@query("a6_hits_by_age", "hit", sql=f"WITH {INFO} SELECT age, lineage, count(DISTINCT (tr, k)) AS hits FROM hit JOIN ti USING (rname) GROUP BY age, lineage")
def a6(fx: Fixtures) -> DataFrame:
    return ft.add_age(hits(fx), te_info(fx)).where("age IS NOT NULL").groupBy("age", "lineage").agg(F.countDistinct("tr", "k").alias("hits"))


@query("a7_hits_by_category", "hit", "tr", sql=f"""WITH {SHUFFLE.format(hit='hit')} SELECT tr_type, category, coalesce(rclass, 'tot') AS rclass, coalesce(rfam, 'tot') AS rfam, coalesce(rname, 'tot') AS rname, count(DISTINCT (tr, k)) AS hits FROM sc
    GROUP BY GROUPING SETS ((tr_type, category), (tr_type, category, rclass), (tr_type, category, rclass, rfam), (tr_type, category, rclass, rfam, rname))
  UNION ALL SELECT tr_type, 'transcript', 'tot', 'tot', 'tot', count(DISTINCT gene) FROM sc GROUP BY tr_type""")
def a7(fx: Fixtures) -> DataFrame:
    return cm.hits_by_category(with_shuffle_cats(fx), ["tr_type"])


@query("a8_genome_counts", "te", sql=LEVELS.format(agg="count(*) AS n", t="te"))
def a8(fx: Fixtures) -> DataFrame:
    return cm.genome_counts(fx.te)


RATIO = f"""WITH nl AS ({NR.format(by='rname', t='hit')}), fc AS (SELECT rname, count(*) AS fragments, count(DISTINCT (rname, block, chrom)) AS nr_fragments, count(DISTINCT chrom) AS n_chrom FROM hit GROUP BY rname),
  g AS (SELECT rname, CAST(sum(en - st + 1) AS BIGINT) AS g_len, count(*) AS g_count, count(DISTINCT (block, chrom)) AS g_nr FROM te GROUP BY rname)
  SELECT rname, nr_len, fragments, nr_fragments, n_chrom, g_len, g_count, g_nr, round(100 * nr_len / (SELECT sum(nr_len) FROM nl), 6) AS pct_len, round(100 * nr_fragments / (SELECT sum(nr_fragments) FROM fc), 6) AS pct_nr,
    round((nr_len / (SELECT sum(nr_len) FROM nl)) / (g_len / (SELECT sum(g_len) FROM g WHERE rname IN (SELECT rname FROM nl))), 6) AS len_ratio, round((nr_fragments / (SELECT sum(nr_fragments) FROM fc)) / (g_nr / (SELECT sum(g_nr) FROM g WHERE rname IN (SELECT rname FROM nl))), 6) AS nr_ratio
  FROM nl JOIN fc USING (rname) LEFT JOIN g USING (rname)"""


@query("a9_te_ratios", "hit", "te", sql=RATIO)
def a9(fx: Fixtures) -> DataFrame:
    r = cm.te_ratios(hits(fx), fx.te)
    return r.withColumns({c: F.round(c, 6) for c in ("pct_len", "pct_nr", "len_ratio", "nr_ratio")})


def buckets_sql(col: str, by: str, buckets) -> str:
    """The four metrics of each bucket, in DuckDB: lengths and counts per {by}, summed over the bucket, and their shares."""
    each = lambda v, kind: ", ".join(f"CAST(coalesce(sum({v}) FILTER (b = '{x}'), 0) AS DOUBLE){kind} AS \"{x}\"" for x in buckets)
    part = lambda m, v, share: f"SELECT '{m}' AS metric, {each(v, f' * 100 / sum({v})' if share else '')} FROM m"
    lengths = NR.format(by=f"{by}, {col}", t="rh")
    return f"n AS ({lengths}), q AS (SELECT {by}, {col}, count(DISTINCT (rname, block, chrom)) AS nr FROM rh GROUP BY {by}, {col}), m AS MATERIALIZED (SELECT {col} AS b, nr_len, nr FROM n JOIN q USING ({by}, {col})), w AS (" + " UNION ALL ".join(
        part(*x) for x in (("Length", "nr_len", False), ("nrCounts", "nr", False), ("%len", "nr_len", True), ("%nrCounts", "nr", True))
    ) + ")"


def rounded_buckets(df: DataFrame, buckets) -> DataFrame:
    return df.withColumns({b: F.round(F.col(f"`{b}`"), 6) for b in buckets})


@query("a10_superfamily_table", "hit", sql=f"WITH {REAL_HIT}, {buckets_sql('sf', 'rclass, rfam', cl.SUPERFAMILIES)} SELECT metric, " + ", ".join(f'round("{s}", 6) AS "{s}"' for s in cl.SUPERFAMILIES) + " FROM w")
def a10(fx: Fixtures) -> DataFrame:
    return rounded_buckets(cm.bucket_table(cl.te_bucket(real(hits(fx))), "superfamily", cl.SUPERFAMILIES, ["rclass", "rfam"]), cl.SUPERFAMILIES)


@query("a11_class_table", "hit", "exon", sql=f"WITH {REAL_HIT}, {buckets_sql('c6', 'rclass', cl.CLASSES)}, t AS (SELECT CAST(sum(nr_len) AS DOUBLE) AS t, 100 * sum(nr_len) / (SELECT sum(en - st + 1) FROM exon) AS p FROM m) SELECT metric, " + ", ".join(f'round("{s}", 6) AS "{s}"' for s in cl.CLASSES) + ", CASE WHEN metric = 'Length' THEN t END AS \"TOTAL\", CASE WHEN metric = 'Length' THEN round(p, 6) END AS pct_tot FROM w, t")
def a11(fx: Fixtures) -> DataFrame:
    n = fx.exon.agg(F.sum(F.col("end") - F.col("start") + 1)).first()[0]
    t = cm.class_table(cl.te_bucket(real(hits(fx))), cl.CLASSES, n)
    return rounded_buckets(t, cl.CLASSES).withColumn("pct_tot", F.round("pct_tot", 6))


@query("a12_age_table", "hit", sql=f"WITH {INFO}, h AS (SELECT hit.*, lineage, age FROM hit JOIN ti USING (rname)) {NR.format(by='lineage, age', t='h')}")
def a12(fx: Fixtures) -> DataFrame:
    return cm.nr_length(ft.add_age(hits(fx), te_info(fx)).where("age IS NOT NULL"), ["lineage", "age"])


@query("a13_site_summary", "hit", "exon", "tr", sql=f"""WITH {STRUCT}, {SITES}, {CATS}, a AS (SELECT tr_type, site, count(DISTINCT (chrom, pos)) AS n FROM sr GROUP BY ALL UNION ALL SELECT tr_type, 'transcripts', count(*) FROM tr GROUP BY tr_type),
  c AS (SELECT ct.*, tr_type, CASE WHEN ct.strand = '-' THEN t.en ELSE t.st END AS a5, CASE WHEN ct.strand = '-' THEN t.st ELSE t.en END AS a3, CASE WHEN ct.strand = '-' THEN ct.en ELSE ct.st END AS e5, CASE WHEN ct.strand = '-' THEN ct.st ELSE ct.en END AS e3 FROM ct JOIN tr t ON ct.tr = t.tr),
  i AS (SELECT tr_type, 'TSS' AS site, count(DISTINCT (chrom, a5)) AS in_te FROM c WHERE category LIKE '%TSS%' GROUP BY tr_type UNION ALL SELECT tr_type, 'polyA', count(DISTINCT (chrom, a3)) FROM c WHERE category LIKE '%polyA%' GROUP BY tr_type
    UNION ALL SELECT tr_type, '3SPL', count(DISTINCT (chrom, e5)) FROM c WHERE category LIKE '%3SPL%' GROUP BY tr_type UNION ALL SELECT tr_type, '5SPL', count(DISTINCT (chrom, e3)) FROM c WHERE category LIKE '%5SPL%' GROUP BY tr_type
    UNION ALL SELECT tr_type, 'transcripts', count(DISTINCT tr) FROM c GROUP BY tr_type)
  SELECT tr_type, site, in_te, n, round(100 * in_te / n, 6) AS pct FROM i JOIN a USING (tr_type, site)""")
def a13(fx: Fixtures) -> DataFrame:
    ends = fx.tr.select("tr", F.col("start").alias("tr_st"), F.col("end").alias("tr_en"))
    taken = cm.site_hits(with_cats(fx).join(ends, "tr"))
    return cm.site_summary(taken, md.distinct_sites(structure(fx))).withColumn("pct", F.round("pct", 6))


@query("a33_feature_count", "hit", "exon", sql="SELECT (SELECT count(*) FROM exon) AS n, (SELECT count(DISTINCT (tr, k)) FROM hit) AS n_hit, (SELECT count(*) FROM exon) - (SELECT count(DISTINCT (tr, k)) FROM hit) AS n_unhit")
def a33(fx: Fixtures) -> DataFrame:
    hit = hits(fx).select("tr", "k").distinct().withColumn("h", F.lit(1))
    j = fx.exon.select("tr", "k").join(hit, ["tr", "k"], "left")
    return j.agg(F.count(F.lit(1)).alias("n"), F.count("h").alias("n_hit")).withColumn("n_unhit", F.col("n") - F.col("n_hit"))


@query("j5_enrich_join", "hit", "exon", "tr", sql=f"WITH {STRUCT}, {INFO} SELECT te_id, h.tr, h.k, es.exon_type, tr.tr_type, tr.mature_len, ti.age FROM hit h JOIN es ON h.tr = es.tr AND h.k = es.k JOIN tr ON h.tr = tr.tr LEFT JOIN ti ON h.rname = ti.rname")
def j5(fx: Fixtures) -> DataFrame:
    return cm.te_transcript_table(hits(fx), fx.tr, md.exon_structure(fx.exon), te_info(fx)).select("te_id", "tr", "k", "exon_type", "tr_type", "mature_len", "age")


@query("j6_genome_reference_join", "hit", "te", sql="SELECT h.rname, count(*) AS n, g.g_len, g.g_count FROM hit h JOIN (SELECT rname, CAST(sum(en - st + 1) AS BIGINT) AS g_len, count(*) AS g_count FROM te GROUP BY rname) g ON lower(h.rname) = lower(g.rname) GROUP BY ALL")
def j6(fx: Fixtures) -> DataFrame:
    n = hits(fx).groupBy("rname").agg(F.count(F.lit(1)).alias("n"))
    g = cm.genome_totals(fx.te).select(F.lower("rname").alias("l"), "g_len", "g_count")
    return n.join(g, F.lower("rname") == F.col("l"), "left").drop("l")


@query("f1_split_class_family", "te", sql="""SELECT m, rname, classfam, CASE m WHEN 3 THEN 'Unknown' WHEN 4 THEN 'LTR' ELSE rclass END AS rclass,
  CASE m WHEN 0 THEN rfam || '_x' WHEN 2 THEN 'sub.' || rfam WHEN 3 THEN 'Unknown' WHEN 4 THEN CASE WHEN i % 3 = 2 THEN 'ERV' || rfam ELSE 'ERV' || rfam || '--int' END ELSE rfam END AS rfam, count(*) AS n
  FROM (SELECT m, i, rclass, rfam, rname || CASE WHEN m < 4 THEN '' WHEN i % 3 = 0 THEN '-int' WHEN i % 3 = 1 THEN '_I' ELSE '-i' END AS rname,
    CASE m WHEN 0 THEN rclass || '/' || rfam || '/x' WHEN 1 THEN rclass || '/' || rfam WHEN 2 THEN 'sub.' || rfam || '.' || rclass WHEN 3 THEN 'Unknown' ELSE 'LTR/ERV' || rfam END AS classfam
    FROM (SELECT *, te_id % 5 AS m, CAST(replace(rname, 'R', '') AS INT) AS i FROM te)) GROUP BY ALL""")
def f1(fx: Fixtures) -> DataFrame:
    m, i = F.col("te_id") % 5, F.regexp_extract("rname", r"(\d+)", 1).cast("int") % 3
    mark = F.when(m < 4, "").when(i == 0, "-int").when(i == 1, "_I").otherwise("-i")
    name = F.when(m == 0, F.concat_ws("/", "rclass", "rfam", F.lit("x"))).when(m == 1, F.concat_ws("/", "rclass", "rfam")).when(m == 2, F.concat_ws(".", F.lit("sub"), "rfam", "rclass")).when(m == 3, "Unknown").otherwise(F.concat(F.lit("LTR/ERV"), "rfam"))
    t = fx.te.select(m.alias("m"), F.concat("rname", mark).alias("rname"), name.alias("classfam"))
    return ft.split_class_family(t).groupBy("m", "rname", "classfam", "rclass", "rfam").agg(F.count(F.lit(1)).alias("n"))


#: Classes for the filter's modes, and which modes keep them, worked out by hand.
FILTERED = (
    ("LTR", "all no_low no_nonTE none"), ("Unknown", "all no_low no_nonTE none"), ("nonTE", "all no_low"), ("tRNA", "all no_low no_nonTE"), ("srpRNA", "all no_low no_nonTE"), ("snRNA?", "all no_low no_nonTE"),
    ("Simple_repeat", "all no_nonTE"), ("simple_repeat", "all no_nonTE"), ("Low_complexity", "all no_nonTE"), ("Satellite", "all no_low no_nonTE"), ("ARTEFACT", "all no_low no_nonTE"), ("Segmental", "all no_low no_nonTE none"),
)


@query("f2_filter_nonte", "te", sql="SELECT mode, v.rclass, count(*) AS n FROM te JOIN (VALUES " + ", ".join(f"({k}, '{c}', '{m}')" for k, (c, ms) in enumerate(FILTERED) for m in ms.split()) + ") v(k, rclass, mode) ON te_id % 12 = k GROUP BY ALL")
def f2(fx: Fixtures) -> DataFrame:
    t = fx.te.withColumn("rclass", F.element_at(F.array(*[F.lit(c) for c, _ in FILTERED]), (F.col("te_id") % 12 + 1).cast("int")))
    modes = [ft.filter_nonte(t, m).select(F.lit(m).alias("mode"), "rclass") for m in ft.NON_TE]
    return modes[0].union(modes[1]).union(modes[2]).union(modes[3]).groupBy("mode", "rclass").agg(F.count(F.lit(1)).alias("n"))


@query("f3_filter_repeat", "te", sql="SELECT te_id, rname FROM te WHERE contains(lower(rname), 'r1') AND rclass = 'LINE'")
def f3(fx: Fixtures) -> DataFrame:
    return ft.filter_repeat(ft.filter_repeat(fx.te, "name", "R1", contains=True, ignore_case=True), "class", "LINE").select("te_id", "rname")


@query("f4_override_class", "te", sql="SELECT te_id, CASE WHEN i % 4 = 0 THEN 'NEW' ELSE rclass END AS rclass, CASE WHEN i % 4 = 0 THEN 'fam' || i WHEN i % 4 = 1 THEN 'rm' ELSE rfam END AS rfam FROM (SELECT *, CAST(replace(rname, 'R', '') AS INT) AS i FROM te)")
def f4(fx: Fixtures) -> DataFrame:
    i = F.regexp_extract("rname", r"(\d+)", 1).cast("int")
    names = fx.te.select("rname", "rclass").distinct()
    info = names.where(i % 4 == 0).select(F.lower("rname").alias("rname"), F.lit("NEW").alias("rclass"), F.concat(F.lit("fam"), i.cast("string")).alias("rfam"))
    rm = names.where(i % 4 < 2).select("rname", "rclass", F.lit("rm").alias("rfam"))
    return ft.override_class(fx.te, info, rm).select("te_id", "rclass", "rfam")


@query("f5_filter_input", "tr", sql="SELECT tr FROM tr WHERE tr_type = 'lincRNA'")
def f5(fx: Fixtures) -> DataFrame:
    t = fx.tr.select("tr", F.create_map(F.lit("transcript_type"), "tr_type").alias("attributes"))
    return ft.filter_input(t, "transcript_type", "lincRNA").select("tr")


@query("f6_filter_added", "exon", sql="SELECT tr, k FROM exon WHERE strand = '-'")
def f6(fx: Fixtures) -> DataFrame:
    return ft.filter_input(fx.exon, "strand", "-").select("tr", "k")


@query("f9_keep_known_seq", "te", "exon", sql="SELECT te_id FROM te WHERE chrom IN (SELECT chrom FROM exon WHERE strand = '+' AND tr % 5 = 0)")
def f9(fx: Fixtures) -> DataFrame:
    return ft.keep_known_seq(fx.te, fx.exon.where("strand = '+' AND tr % 5 = 0")).select("te_id")


@query("f10_feature_search", "exon", sql="SELECT tr, k, st FROM exon WHERE strand = '+' AND chrom IN ('chr1', 'chr2', 'chr3') AND st >= 100000 AND en <> 5 AND k < 4 ORDER BY chrom, st")
def f10(fx: Fixtures) -> DataFrame:
    return ft.search(fx.exon, {"strand": "+", "chrom": ["chr1", "chr2", "chr3"], "start": {">=": 100_000}, "end": {"ne": 5}, "k": {"<": 4}}, ["chrom", "start"]).select("tr", "k", "start")


@query("f11_locus", "exon", sql="SELECT tr, k, chrom || ':' || st || '-' || en AS locus, 'chrom=' || chrom || ',strand=' || strand AS fields FROM exon")
def f11(fx: Fixtures) -> DataFrame:
    m = ft.as_map(fx.exon, ["chrom", "strand"])
    fields = F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return fx.exon.select("tr", "k", ft.locus().alias("locus"), fields.alias("fields"))


@query("f12_strand_ends", "exon", sql="SELECT tr, k, CASE WHEN strand = '-' THEN en ELSE st END AS my_start, CASE WHEN strand = '-' THEN st ELSE en END AS my_end, en - st + 1 AS length FROM exon")
def f12(fx: Fixtures) -> DataFrame:
    return fx.exon.select("tr", "k", ft.my_start().alias("my_start"), ft.my_end().alias("my_end"), ft.genomic_length().alias("length"))


@query("f15_feature_bin", "te", sql="SELECT te_id, chrom || ':' || CASE " + " ".join(f"WHEN st // {s} = en // {s} THEN '{k + 1}:' || (st // {s})" for k, s in enumerate(ft.BIN_SIZES)) + " END AS bin FROM te")
def f15(fx: Fixtures) -> DataFrame:
    return fx.te.select("te_id", ft.smallest_bin().alias("bin"))


@query("f15_all_bins", "te", sql="SELECT bin, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT chrom || ':{k + 1}:' || unnest(range(st // {s}, en // {s} + 1)) AS bin FROM te" for k, s in enumerate(ft.BIN_SIZES)) + ") GROUP BY bin")
def f15b(fx: Fixtures) -> DataFrame:
    return fx.te.select(F.explode(ft.all_bins()).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


@query("f17_significance_stars", sql="SELECT l_discount AS p, CASE WHEN l_discount > 0.05 THEN 'ns' WHEN l_discount > 0.01 THEN '*' WHEN l_discount > 0.001 THEN '**' ELSE '***' END AS stars, count(*) AS n FROM lineitem GROUP BY ALL")
def f17(fx: Fixtures) -> DataFrame:
    t = fx.table("lineitem").select(F.col("l_discount").alias("p"))
    return t.withColumn("stars", cl.stars(F.col("p"))).groupBy("p", "stars").agg(F.count(F.lit(1)).alias("n"))


@query("f18_age_lookup", "te", sql=f"WITH {INFO} SELECT te_id, lineage, age, coalesce(pct_div, CAST(replace(rname, 'R', '') AS DOUBLE) / 2) AS pct_div FROM te LEFT JOIN ti USING (rname)")
def f18(fx: Fixtures) -> DataFrame:
    i = F.regexp_extract("rname", r"(\d+)", 1).cast("double")
    rm = fx.te.select("rname").distinct().withColumn("pct_div", i / 2)
    return ft.add_age(fx.te, te_info(fx), rm).select("te_id", "lineage", "age", "pct_div")


@query("f19_contig_alias", "te", sql="SELECT te_id, CASE WHEN te_id % 3 = 0 THEN 'chrUn_gl000' || (te_id % 4) ELSE chrom END AS chrom FROM te")
def f19(fx: Fixtures) -> DataFrame:
    te = fx.te.withColumn("chrom", F.when(F.col("te_id") % 3 == 0, F.concat(F.lit("GL000"), (F.col("te_id") % 4).cast("string"), F.lit(".1"))).otherwise(F.col("chrom")))
    sizes = fx.sizes.select("chrom").union(te.where("te_id % 3 = 0").select(F.concat(F.lit("chrUn_gl000"), (F.col("te_id") % 4).cast("string"))).distinct())
    return ft.contig_alias(te.select("te_id", "chrom"), sizes)


@query("a4_n_chromosomes", "hit", sql="SELECT rname, count(DISTINCT chrom) AS n_chrom FROM hit GROUP BY rname")
def a4(fx: Fixtures) -> DataFrame:
    return cm.fragment_counts(hits(fx)).select("rname", "n_chrom")


@query("w2_previous_interval", "hit", sql="""SELECT rclass, CAST(sum(CASE WHEN p >= en THEN 0 WHEN p >= st THEN en - p ELSE en - st + 1 END) AS BIGINT) AS nr_len FROM (
  SELECT *, lag(en) OVER (PARTITION BY rclass, chrom ORDER BY st, en) AS p FROM (SELECT rclass, chrom, greatest(te_st, st) AS st, least(te_en, en) AS en FROM hit)) GROUP BY rclass""")
def w2(fx: Fixtures) -> DataFrame:
    return cm.nr_length(hits(fx), ["rclass"], parity=True)

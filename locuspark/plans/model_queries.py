"""Transcript model and overlap categories over the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.operators import classify as cl
from locuspark.operators import intervals as iv
from locuspark.operators import model as md
from locuspark.plans.fixtures import Fixtures
from locuspark.plans.interval_queries import DIFF, MERGE
from locuspark.plans.registry import query

#: Classes and families of repeats by the number in their name, with internal parts, unknown and non-TE classes; SQL of both engines.
NUMBER = "CAST(replace(rname, 'R', '') AS INT) % 20"
REAL = (
    ("LTR", "ERV1--int"), ("LTR", "ERVK"), ("ERV", "ERVL-MaLR"), ("LTR", "Gypsy"), ("LINE", "L1"), ("LINE", "CR1"), ("LINE", "Jockey"), ("SINE", "Alu"), ("SINE", "MIR"), ("SINE", "5S"),
    ("DNA", "hAT-Charlie"), ("DNA", "TcMar-Tigger"), ("DNA", "Helitron"), ("DNA", "Maverick"), ("DNA", "PiggyBac"), ("RC", "Helitron"), ("nonTE", "nonTE"), ("Unknown", "Unknown"), ("Simple_repeat", "Simple_repeat"), ("srpRNA", "srpRNA"),
)
#: The bucket of each of them among the sixteen and the six, worked out by hand.
SUPER_NO = (0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 11, 15, 14, 14, 14)
SIX_NO = (0, 0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 3, 3, 3, 5, 4, 4, 4)
SUPERS = (
    "ERV/LTRint ERV/LTRs LTR/Others nonLTR/LINE/L1 nonLTR/LINE/L2,3,4 nonLTR/LINE/Others nonLTR/SINE/B1,ALUs nonLTR/SINE/B2,MIRs nonLTR/SINE/B3,B4,others "
    "DNA/hAT DNA/TcMar DNA/Helitrons DNA/Tlr,Mavericks,Polintons DNA/Others Others nonTE"
).split()
SIXES = "LTR LINE SINE DNA Others nonTE".split()


def by_number(values) -> str:
    return f"CASE {NUMBER} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


def real(df: DataFrame) -> DataFrame:
    """Repeats or hits with the classes and families of ``REAL``."""
    return df.withColumns({"rclass": F.expr(by_number([c for c, _ in REAL])), "rfam": F.expr(by_number([f for _, f in REAL]))})


#: Hits with these classes, and their buckets by hand.
REAL_HIT = f"rh AS MATERIALIZED (SELECT * EXCLUDE (rclass, rfam), {by_number([c for c, _ in REAL])} AS rclass, {by_number([f for _, f in REAL])} AS rfam, {by_number([SUPERS[k] for k in SUPER_NO])} AS sf, {by_number([SIXES[k] for k in SIX_NO])} AS c6 FROM hit)"

STRUCT = """es AS MATERIALIZED (SELECT *, CASE WHEN n = 1 THEN 'SINGLE' WHEN r = 1 THEN CASE WHEN strand = '-' THEN 'LAST' ELSE 'FIRST' END
  WHEN r = n THEN CASE WHEN strand = '-' THEN 'FIRST' ELSE 'LAST' END ELSE 'MIDDLE' END AS exon_type
  FROM (SELECT *, row_number() OVER (PARTITION BY tr ORDER BY st, en) AS r, count(*) OVER (PARTITION BY tr) AS n FROM exon))"""
CDSUM = """cs AS MATERIALIZED (SELECT tr, cds_start, cds_end, n_cds, cds_len, CASE WHEN strand = '-' THEN cds_end ELSE cds_start END AS atg, CASE WHEN strand = '-' THEN cds_start ELSE cds_end END AS stop
  FROM (SELECT tr, min(strand) AS strand, min(st) AS cds_start, max(en) AS cds_end, count(*) AS n_cds, CAST(sum(en - st + 1) AS BIGINT) AS cds_len FROM cds GROUP BY tr))"""
#: Whether the repeat hangs over the 5' and the 3' end.
FIVE = "CASE WHEN strand = '-' THEN te_en > en ELSE te_st < st END"
THREE = "CASE WHEN strand = '-' THEN te_st < st ELSE te_en > en END"
EXCAT = """CASE WHEN exon_type = 'SINGLE' AND f AND t THEN 'TSS_polyA' WHEN exon_type IN ('SINGLE', 'FIRST') AND f AND NOT t THEN 'TSS' WHEN exon_type IN ('SINGLE', 'LAST') AND t AND NOT f THEN 'polyA'
  WHEN exon_type = 'FIRST' AND f AND t THEN 'TSS_5SPL' WHEN exon_type IN ('FIRST', 'MIDDLE') AND t AND NOT f THEN '5SPL' WHEN exon_type = 'MIDDLE' AND f AND t THEN '3SPL_exon_5SPL'
  WHEN exon_type IN ('MIDDLE', 'LAST') AND f AND NOT t THEN '3SPL' WHEN exon_type = 'LAST' AND f AND t THEN '3SPL_polyA' ELSE 'exonized' END"""
#: Flanks of 5,000 bases by strand, clipped.
FLANK = """fl AS MATERIALIZED (SELECT * FROM (
  SELECT t.gene, t.tr, t.chrom, t.strand, CASE WHEN strand = '-' THEN 'down' ELSE 'up' END AS side, greatest(1, st - 5000) AS st, st - 1 AS en FROM tr t JOIN sizes USING (chrom)
  UNION ALL SELECT t.gene, t.tr, t.chrom, t.strand, CASE WHEN strand = '-' THEN 'up' ELSE 'down' END, en + 1, least(length, en + 5000) FROM tr t JOIN sizes USING (chrom)) WHERE st <= en)"""
OFFSETS = """o AS MATERIALIZED (SELECT *, CAST(coalesce(sum(en - st + 1) OVER (PARTITION BY tr ORDER BY CASE WHEN strand = '-' THEN -en ELSE st END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM {t})"""
POINT = "pt AS MATERIALIZED (SELECT DISTINCT chrom, (st + en) // 2 AS pos FROM te)"
KEY = "((({i}) * 1103515245 + ({r}) * 12345 + {s}) % 2147483648)"


def rand_key(i: str, r: str, s: int) -> str:
    x = KEY.format(i=i, r=r, s=s)
    return f"(({x} * ({x} % 65521 + ({r}) + 1)) % 2147483647)"


def structure(fx: Fixtures) -> DataFrame:
    types = fx.tr.select("tr", "tr_type", "mature_len")
    return md.exon_structure(fx.exon).join(types, "tr")


def with_cats(fx: Fixtures) -> DataFrame:
    s = structure(fx).select("tr", "k", "exon_type", "tr_type", "mature_len")
    return cl.classify_exon(fx.raw("hit").join(s, ["tr", "k"]))


@query("t1_transcript_summary", "exon", sql="SELECT gene, tr, min(chrom) AS chrom, min(strand) AS strand, min(st) AS st, max(en) AS en, count(*) AS n_exons, CAST(sum(en - st + 1) AS BIGINT) AS mature_len FROM exon GROUP BY gene, tr")
def t1(fx: Fixtures) -> DataFrame:
    return md.transcripts(fx.exon)


@query("t2_cds_summary", "cds", sql=f"WITH {CDSUM} SELECT * FROM cs")
def t2(fx: Fixtures) -> DataFrame:
    return md.cds_summary(fx.cds)


@query("t3_exon_structure", "exon", sql=f"WITH {STRUCT} SELECT tr, k, r AS exon_no, n AS n_exons, exon_type FROM es")
def t3(fx: Fixtures) -> DataFrame:
    return md.exon_structure(fx.exon).select("tr", "k", "exon_no", "n_exons", "exon_type")


@query("t4_cds_structure", "cds", sql=f"""WITH {CDSUM} SELECT c.tr, k, row_number() OVER (PARTITION BY c.tr ORDER BY st, en) AS cds_no,
  CASE WHEN strand = '+' AND st = a AND en = z THEN 'SINGLE' WHEN strand = '-' AND en = a AND st = z THEN 'SINGLE' WHEN strand = '+' AND st > a AND en < z THEN 'MIDDLE' WHEN strand = '-' AND st > z AND en < a THEN 'MIDDLE'
    WHEN strand = '+' AND en = z THEN 'LAST' WHEN strand = '-' AND st = z THEN 'LAST' WHEN strand = '+' AND st = a THEN 'FIRST' WHEN strand = '-' AND en = a THEN 'FIRST' ELSE 'indet' END AS cds_type
  FROM (SELECT c.*, CASE WHEN c.tr % 6 = 0 THEN atg + 700 ELSE atg END AS a, CASE WHEN c.tr % 9 = 0 THEN NULL ELSE stop END AS z FROM cds c JOIN cs USING (tr)) c""")
def t4(fx: Fixtures) -> DataFrame:
    cds = fx.cds
    s = md.cds_summary(cds)  # with some codons moved or missing, so that parts do not begin or end at them
    s = s.withColumns({"atg": F.when(F.col("tr") % 6 == 0, F.col("atg") + 700).otherwise(F.col("atg")), "stop": F.when(F.col("tr") % 9 != 0, F.col("stop"))})
    return md.cds_structure(cds, s).select("tr", "k", "cds_no", "cds_type")


INTRON = "it AS MATERIALIZED (SELECT gene, tr, chrom, strand, p + 1 AS st, st - 1 AS en FROM (SELECT *, lag(en) OVER (PARTITION BY tr ORDER BY st, en) AS p FROM exon) WHERE st - 1 > p + 1)"


@query("t5_introns", "exon", sql=f"WITH {INTRON} SELECT *, row_number() OVER (PARTITION BY tr ORDER BY st, en) AS intron_no FROM it")
def t5(fx: Fixtures) -> DataFrame:
    return md.introns(fx.exon)


@query("t6_utrs", "exon", "cds", sql=f"""WITH {CDSUM}, mc AS MATERIALIZED ({MERGE.format(t='cds')}),
  u AS (SELECT * FROM (SELECT tr, k, strand, s AS st, coalesce(lead(bs) OVER (PARTITION BY tr, k ORDER BY o) - 1, aen) AS en FROM (
    SELECT tr, k, strand, en AS aen, 0 AS o, st AS s, NULL AS bs FROM exon UNION ALL
    SELECT a.tr, a.k, a.strand, a.en, b.st, b.en + 1, b.st FROM exon a JOIN mc b ON a.chrom = b.chrom AND a.st <= b.en AND b.st <= a.en)) WHERE st <= en)
  SELECT tr, k, st, en, CASE WHEN CASE WHEN strand = '-' THEN st > atg ELSE en < atg END THEN '5UTR' WHEN CASE WHEN strand = '-' THEN en < stop ELSE st > stop END THEN '3UTR' ELSE 'indet' END AS utr FROM u JOIN cs USING (tr)""")
def t6(fx: Fixtures) -> DataFrame:
    cds = fx.cds
    return md.utrs(fx.exon.select("chrom", "start", "end", "strand", "tr", "k"), cds, md.cds_summary(cds)).select("tr", "k", "start", "end", "utr")


@query("t7_utrs_per_mrna", "exon", "cds", sql=f"""WITH {CDSUM}, u AS (
  SELECT tr, CASE WHEN strand = '-' THEN '3UTR' ELSE '5UTR' END AS utr, chrom, strand, st, least(en, cds_start - 1) AS en FROM exon JOIN cs USING (tr) UNION ALL
  SELECT tr, CASE WHEN strand = '-' THEN '5UTR' ELSE '3UTR' END, chrom, strand, greatest(st, cds_end + 1), en FROM exon JOIN cs USING (tr))
  SELECT *, row_number() OVER (PARTITION BY tr, utr ORDER BY CASE WHEN strand = '-' THEN -st ELSE st END) AS utr_no FROM u WHERE st <= en""")
def t7(fx: Fixtures) -> DataFrame:
    return md.utrs_per_mrna(fx.exon, md.cds_summary(fx.cds))


@query("t8_flanks", "tr", "sizes", sql=f"WITH {FLANK} SELECT * FROM fl")
def t8(fx: Fixtures) -> DataFrame:
    return md.flanks(fx.tr, fx.sizes, 5000)


@query("t9_cut_flank", "tr", "sizes", sql=f"""WITH {FLANK} SELECT gene, tr, chrom, strand, side, CAST(cut AS BIGINT) AS cut,
  CASE WHEN (side = 'up') = (strand <> '-') THEN greatest(st, en - cut + 1) ELSE st END AS st, CASE WHEN (side = 'up') = (strand <> '-') THEN en ELSE least(en, st + cut - 1) END AS en
  FROM fl, (VALUES (5000), (1000), (200)) c(cut)""")
def t9(fx: Fixtures) -> DataFrame:
    return md.cut_flank(md.flanks(fx.tr, fx.sizes, 5000), [5000, 1000, 200])


@query("t10_tss_table", "tr", sql="SELECT gene, tr, chrom, strand, greatest(1, CASE WHEN strand = '-' THEN en ELSE st END - 1) AS st, CASE WHEN strand = '-' THEN en ELSE st END + 1 AS en FROM tr")
def t10(fx: Fixtures) -> DataFrame:
    return md.tss_table(fx.tr)


SITES = """sr AS MATERIALIZED (SELECT tr_type, site, chrom, pos, tr FROM (
  SELECT tr, chrom, exon_type, CASE WHEN strand = '-' THEN en ELSE st END AS h, CASE WHEN strand = '-' THEN st ELSE en END AS t FROM es) e JOIN (SELECT tr, tr_type FROM tr) USING (tr),
  LATERAL (SELECT 'TSS' AS site, h AS pos WHERE exon_type IN ('FIRST', 'SINGLE') UNION ALL SELECT 'polyA', t WHERE exon_type IN ('LAST', 'SINGLE')
    UNION ALL SELECT '5SPL', t WHERE exon_type IN ('FIRST', 'MIDDLE') UNION ALL SELECT '3SPL', h WHERE exon_type IN ('LAST', 'MIDDLE')))"""


@query("t11_distinct_sites", "exon", "tr", sql=f"WITH {STRUCT}, {SITES} SELECT tr_type, site, count(DISTINCT (chrom, pos)) AS n FROM sr GROUP BY ALL UNION ALL SELECT tr_type, 'transcripts', count(DISTINCT tr) FROM tr GROUP BY tr_type")
def t11(fx: Fixtures) -> DataFrame:
    return md.distinct_sites(structure(fx))


@query("t12_gene_transcripts", "exon", sql="SELECT gene, tr, count(*) AS n_exons, tr IN (SELECT tr FROM tr0) AS is_mrna FROM exon GROUP BY gene, tr".replace("(SELECT tr FROM tr0)", "(SELECT CAST(o_orderkey AS BIGINT) FROM orders WHERE o_orderkey % 3 = 0)"))
def t12(fx: Fixtures) -> DataFrame:
    return md.transcript_index(fx.exon, fx.tr.where("tr_type = 'protein_coding'"))


@query("t13_pick_transcript", "exon", sql=f"""WITH i AS (SELECT gene, tr, count(*) AS n_exons FROM exon GROUP BY gene, tr)
  SELECT r AS round, gene, tr, n_exons FROM i, range(1, 6) s(r) QUALIFY row_number() OVER (PARTITION BY r, gene ORDER BY {rand_key('tr', 'r', 1)}, tr) = 1""")
def t13(fx: Fixtures) -> DataFrame:
    return md.pick_transcript(fx.exon.groupBy("gene", "tr").agg(F.count(F.lit(1)).alias("n_exons")), 5)


@query("t14_transcript_order", "tr", sql="SELECT gene, tr, row_number() OVER (PARTITION BY gene ORDER BY CASE WHEN strand = '-' THEN -en ELSE st END, en - st DESC, tr) AS tr_no FROM tr")
def t14(fx: Fixtures) -> DataFrame:
    return md.order_transcripts(fx.tr).select("gene", "tr", "tr_no")


@query("t15_mrna_metrics", "exon", "cds", sql="""SELECT tr, CAST(m AS BIGINT) AS mature_len, CASE WHEN strand = '-' THEN hi ELSE lo END AS cds_start, CASE WHEN strand = '-' THEN lo ELSE hi END AS cds_end, CAST(c AS BIGINT) AS cds_len, CAST(c // 3 - 1 AS BIGINT) AS protein_len FROM (SELECT tr, sum(en - st + 1) AS m FROM exon GROUP BY tr)
  JOIN (SELECT tr, min(strand) AS strand, min(st) AS lo, max(en) AS hi, sum(en - st + 1) AS c FROM cds GROUP BY tr) USING (tr)""")
def t15(fx: Fixtures) -> DataFrame:
    return md.mrna_metrics(fx.exon, fx.cds)


AED = """n AS MATERIALIZED (SELECT gene, tr, sum(en - st + 1) AS b FROM exon GROUP BY gene, tr), d AS MATERIALIZED (SELECT x.gene, x.tr AS tr_a, y.tr AS tr_b, 1 - (coalesce(s, 0) / x.b + coalesce(s, 0) / y.b) / 2 AS aed
  FROM n x JOIN n y ON x.gene = y.gene AND x.tr < y.tr LEFT JOIN (SELECT a.tr AS ta, b.tr AS tb, sum(least(a.en, b.en) - greatest(a.st, b.st) + 1) AS s FROM exon a JOIN exon b
    ON a.gene = b.gene AND a.tr < b.tr AND a.st <= b.en AND b.st <= a.en GROUP BY a.tr, b.tr) ON ta = x.tr AND tb = y.tr)"""


@query("t16_aed", "exon", sql=f"WITH {AED} SELECT gene, tr_a, tr_b, round(aed, 9) AS aed FROM d")
def t16(fx: Fixtures) -> DataFrame:
    return md.gene_aed(fx.exon).withColumn("aed", F.round("aed", 9))


@query("t17_splice_complexity", "exon", sql=f"WITH {AED} SELECT gene, round(avg(aed), 9) AS complexity FROM (SELECT DISTINCT gene FROM exon) LEFT JOIN d USING (gene) GROUP BY gene")
def t17(fx: Fixtures) -> DataFrame:
    return md.splice_complexity(fx.exon).withColumn("complexity", F.round("complexity", 9))


def points(fx: Fixtures) -> DataFrame:
    return fx.te.select("chrom", F.floor((F.col("start") + F.col("end")) / 2).alias("pos")).distinct()


MAPPED = "SELECT pt.chrom, pos, tr, CASE WHEN strand = '-' THEN en - pos ELSE pos - st END + 1 + before AS {c} FROM pt JOIN o ON pt.chrom = o.chrom AND pos BETWEEN st AND en"


@query("t18_genome_to_transcript", "te", "exon", sql=f"WITH {OFFSETS.format(t='exon')}, {POINT} {MAPPED.format(c='mapped')}")
def t18(fx: Fixtures) -> DataFrame:
    return md.map_positions(points(fx), fx.exon)


@query("t18_transcript_to_genome", "exon", sql=f"WITH {OFFSETS.format(t='exon')}, a AS (SELECT tr, 1 + tr % 150 AS w FROM exon GROUP BY tr) SELECT a.tr, w AS \"at\", chrom, CASE WHEN strand = '-' THEN en - (w - before - 1) ELSE st + (w - before - 1) END AS pos FROM a JOIN o ON a.tr = o.tr AND w > before AND w <= before + en - st + 1")
def t18b(fx: Fixtures) -> DataFrame:
    p = fx.exon.select("tr").distinct().withColumn("at", 1 + F.pmod(F.col("tr"), F.lit(150)))
    return md.map_to_genome(p, fx.exon)


@query("t18_genome_to_protein", "te", "cds", sql=f"WITH {OFFSETS.format(t='cds')}, {POINT}, m AS ({MAPPED.format(c='c')}) SELECT chrom, pos, tr, CAST((c - 1) // 3 + 1 AS BIGINT) AS aa FROM m")
def t18c(fx: Fixtures) -> DataFrame:
    return md.map_positions(points(fx), fx.cds, "c").select("chrom", "pos", "tr", md.to_protein(F.col("c")).alias("aa"))


@query("t19_frame_phase_codon", "te", "cds", sql=f"WITH {OFFSETS.format(t='cds')}, {POINT}, m AS ({MAPPED.format(c='cds_pos')}) SELECT chrom, pos, tr, cds_pos, (cds_pos - 1) % 3 AS phase, CAST((cds_pos - 1) // 3 + 1 AS BIGINT) AS codon_no, cds_pos - (cds_pos - 1) % 3 AS codon_start FROM m")
def t19(fx: Fixtures) -> DataFrame:
    return md.frame_at(points(fx), fx.cds)


@query("t20_split_coding", "tr", sql="SELECT CASE WHEN tr_type LIKE '%protein_coding%' THEN 'coding' ELSE 'noncoding' END AS feature_class, count(*) AS n, CAST(sum(mature_len) AS BIGINT) AS bases FROM tr GROUP BY 1")
def t20(fx: Fixtures) -> DataFrame:
    return md.split_coding(fx.tr).groupBy("feature_class").agg(F.count(F.lit(1)).alias("n"), F.sum("mature_len").alias("bases"))


@query("t21_exon_id", "exon", sql="SELECT gene || '#' || tr || '#' || chrom || ':' || st || '-' || en AS exon_id FROM exon WHERE en - st + 1 >= 2")
def t21(fx: Fixtures) -> DataFrame:
    return md.exon_ids(fx.exon).select("exon_id")


@query("f7_filter_intragenic", "tr", sql="SELECT tr, mature_len FROM tr WHERE tr_type NOT IN ('protein_coding', 'lincRNA') AND mature_len > 600")
def f7(fx: Fixtures) -> DataFrame:
    return md.filter_intragenic(fx.tr, 600).select("tr", "mature_len")


CATS = f"ct AS MATERIALIZED (SELECT *, {EXCAT} AS category FROM (SELECT h.*, es.exon_type, {FIVE.replace('strand', 'h.strand').replace(' en', ' h.en').replace(' st', ' h.st')} AS f, {THREE.replace('strand', 'h.strand').replace(' en', ' h.en').replace(' st', ' h.st')} AS t FROM hit h JOIN es ON h.tr = es.tr AND h.k = es.k))"


@query("c1_te_contribution_exon", "hit", "exon", "tr", sql=f"WITH {STRUCT}, {CATS} SELECT te_id, ct.tr, k, category, overlap, round(100 * overlap / (ct.en - ct.st + 1), 6) AS pct_exon, round(100 * overlap / mature_len, 6) AS pct_transcript FROM ct JOIN tr ON ct.tr = tr.tr")
def c1(fx: Fixtures) -> DataFrame:
    return cl.exon_shares(with_cats(fx)).select("te_id", "tr", "k", "category", "overlap", F.round("pct_exon", 6).alias("pct_exon"), F.round("pct_transcript", 6).alias("pct_transcript"))


@query("c2_te_contribution_intron", "te", "exon", sql=f"""WITH {INTRON}, j AS (SELECT t.te_id, t.st AS te_st, t.en AS te_en, i.tr, i.st, i.en, i.strand FROM te t JOIN it i ON t.chrom = i.chrom AND t.st <= i.en AND i.st <= t.en)
  SELECT te_id, tr, st, en, CASE WHEN f AND t THEN '5SPL_3SPL' WHEN f OR t THEN 'SPL' ELSE 'intronized' END AS category FROM (SELECT *, {FIVE} AS f, {THREE} AS t FROM j)""")
def c2(fx: Fixtures) -> DataFrame:
    j = iv.overlap_join(fx.te.select("chrom", "start", "end", "te_id"), md.introns(fx.exon))
    j = j.selectExpr("a_te_id AS te_id", "a_start AS te_st", "a_end AS te_en", "b_tr AS tr", "b_start AS st", "b_end AS en", "b_strand AS strand")
    return cl.classify_intron(j).select("te_id", "tr", "st", "en", "category")


@query("c3_te_contribution_flank", "te", "tr", "sizes", sql=f"""WITH {FLANK}, j AS (SELECT t.te_id, t.st AS te_st, t.en AS te_en, i.tr, i.side, i.st, i.en, i.strand FROM te t JOIN fl i ON t.chrom = i.chrom AND t.st <= i.en AND i.st <= t.en)
  SELECT te_id, tr, side, CASE WHEN i AND o THEN n || '_Full' WHEN i THEN n WHEN o THEN 'partial' ELSE 'included' END AS category FROM (
    SELECT te_id, tr, side, CASE WHEN side = 'up' THEN 'TSS' ELSE 'PolyA' END AS n, CASE WHEN side = 'up' THEN t ELSE f END AS i, CASE WHEN side = 'up' THEN f ELSE t END AS o FROM (SELECT *, {FIVE} AS f, {THREE} AS t FROM j))""")
def c3(fx: Fixtures) -> DataFrame:
    j = iv.overlap_join(fx.te.select("chrom", "start", "end", "te_id"), md.flanks(fx.tr, fx.sizes, 5000))
    j = j.selectExpr("a_te_id AS te_id", "a_start AS te_st", "a_end AS te_en", "b_tr AS tr", "b_side AS side", "b_start AS st", "b_end AS en", "b_strand AS strand")
    return cl.classify_flank(j).select("te_id", "tr", "side", "category")


#: The test's category of each hit: over the whole transcript first, then by whether the exon ends with the transcript.
SHUFFLE = """sc AS MATERIALIZED (SELECT *, CASE WHEN te_st < ts AND te_en > te THEN 'TSS_polyA'
    WHEN te_st < st AND te_en > en THEN CASE WHEN st = ts AND en = te THEN '3SPL_exon_5SPL' WHEN CASE WHEN strand = '+' THEN en = te ELSE st = ts END THEN '3SPL_polyA' WHEN CASE WHEN strand = '+' THEN st = ts ELSE en = te END THEN 'TSS_5SPL' ELSE '3SPL_exon_5SPL' END
    WHEN te_st < st AND strand = '+' THEN CASE WHEN n = 1 OR (st = ts AND en <> te) THEN 'TSS' ELSE '3SPL' END
    WHEN te_st < st THEN CASE WHEN n = 1 OR (st = ts AND en <> te) THEN 'polyA' ELSE '5SPL' END
    WHEN te_en > en AND strand = '+' THEN CASE WHEN n = 1 OR (en = te AND st <> ts) THEN 'polyA' ELSE '5SPL' END
    WHEN te_en > en THEN CASE WHEN n = 1 OR (en = te AND st <> ts) THEN 'TSS' ELSE '3SPL' END ELSE 'exonized' END AS category
  FROM (SELECT h.*, t.st AS ts, t.en AS te, n_exons AS n, tr_type FROM {hit} h JOIN tr t ON h.tr = t.tr))"""


def with_shuffle_cats(fx: Fixtures) -> DataFrame:
    t = fx.tr.select("tr", F.col("start").alias("tr_st"), F.col("end").alias("tr_en"), "n_exons", "tr_type")
    return cl.classify_shuffle(fx.raw("hit").join(t, "tr"))


@query("c4_shuffle_category", "hit", "tr", sql=f"WITH {SHUFFLE.format(hit='hit')} SELECT te_id, tr, k, category FROM sc")
def c4(fx: Fixtures) -> DataFrame:
    return with_shuffle_cats(fx).select("te_id", "tr", "k", "category")


@query("c5_punctual_coords", "exon", sql=f"WITH {STRUCT} SELECT tr, CASE WHEN strand = '-' THEN en ELSE st END AS st, CASE WHEN strand = '-' THEN en ELSE st END AS en FROM es WHERE exon_type IN ('FIRST', 'SINGLE')")
def c5(fx: Fixtures) -> DataFrame:
    s = md.exon_structure(fx.exon).where(F.col("exon_type").isin("FIRST", "SINGLE"))
    return cl.punctual(s, "TSS", "start", "end").select("tr", "start", "end")


@query("f16_superfamily_bucket", "te", sql=f"SELECT rclass, rfam, class6, superfamily, count(*) AS n FROM (SELECT {by_number([c for c, _ in REAL])} AS rclass, {by_number([f for _, f in REAL])} AS rfam, {by_number([SUPERS[k] for k in SUPER_NO])} AS superfamily, {by_number([SIXES[k] for k in SIX_NO])} AS class6 FROM te) GROUP BY ALL")
def f16(fx: Fixtures) -> DataFrame:
    return cl.te_bucket(real(fx.te)).groupBy("rclass", "rfam", "class6", "superfamily").agg(F.count(F.lit(1)).alias("n"))


@query("w3_ordinal_in_parent", "exon", "cds", sql="SELECT 'exon' AS part, tr, k, row_number() OVER (PARTITION BY tr ORDER BY st, en) AS no FROM exon UNION ALL SELECT 'cds', tr, k, row_number() OVER (PARTITION BY tr ORDER BY st, en) FROM cds")
def w3(fx: Fixtures) -> DataFrame:
    cds = fx.cds
    e = md.exon_structure(fx.exon).select(F.lit("exon").alias("part"), "tr", "k", F.col("exon_no").alias("no"))
    return e.union(md.cds_structure(cds, md.cds_summary(cds)).select(F.lit("cds"), "tr", "k", "cds_no"))


@query("w4_cumulative_exon_offset", "exon", sql=f"WITH {OFFSETS.format(t='exon')} SELECT tr, k, before FROM o")
def w4(fx: Fixtures) -> DataFrame:
    return md.with_offsets(fx.exon).select("tr", "k", "before")

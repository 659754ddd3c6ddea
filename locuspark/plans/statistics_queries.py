"""Statistics, sequences, consensus coverage and merged reports over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.functions import sequences as sq
from locuspark.functions import statistics as st
from locuspark.operators import coverage as cv
from locuspark.operators import merge as mg
from locuspark.plans.composition_queries import INFO, NR, SIX, hits, te_info
from locuspark.plans.model_queries import CATS, STRUCT, with_cats
from locuspark.operators import classify as cl
from locuspark.operators import compose as cm
from locuspark.functions import features as ft
from locuspark.plans.fixtures import Fixtures
from locuspark.plans.registry import query
from locuspark.storage import checkpoint


def li(fx: Fixtures) -> DataFrame:
    return fx.table("lineitem")


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


@query("a15_mean_sd", sql="SELECT l_returnflag, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS sd FROM lineitem GROUP BY 1")
def a15(fx: Fixtures) -> DataFrame:
    return rounded(st.mean_sd(li(fx), ["l_returnflag"], "l_extendedprice"), "mean", "sd", digits=4)


@query("a15_mean_sd_parity", sql="""SELECT l_returnflag, round(m, 4) AS mean, round(sqrt(sum(CASE WHEN l_discount <> 0 THEN (l_discount - m) ** 2 ELSE 0 END) / (count(*) - 1)), 4) AS sd
  FROM lineitem JOIN (SELECT l_returnflag, avg(l_discount) AS m FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY l_returnflag, m""")
def a15b(fx: Fixtures) -> DataFrame:
    return rounded(st.mean_sd(li(fx), ["l_returnflag"], "l_discount", parity=True), "mean", "sd", digits=4)


@query("a21_category_counts", sql="SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1")
def a21(fx: Fixtures) -> DataFrame:
    return st.category_counts(fx.table("events"), "event_type")


@query("a21_category_summary", sql="SELECT count(event_type) AS n, count(DISTINCT event_type) AS n_distinct, min(event_type) AS min_value, max(event_type) AS max_value FROM events")
def a21b(fx: Fixtures) -> DataFrame:
    return st.category_summary(fx.table("events"), "event_type")


@query("a22_describe_numeric", sql="SELECT l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS total, round(avg(l_quantity), 6) AS mean, round(var_samp(l_quantity), 6) AS variance, round(stddev_samp(l_quantity), 6) AS sd, min(l_quantity) AS min, max(l_quantity) AS max, max(l_quantity) - min(l_quantity) AS range FROM lineitem GROUP BY 1")
def a22(fx: Fixtures) -> DataFrame:
    return rounded(rounded(st.describe(li(fx), "l_quantity", ["l_linestatus"]), "mean", "variance", "sd"), "total", digits=4)


TRIM = """SELECT {g}, avg(l_extendedprice) AS trimmed_mean FROM (SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY l_extendedprice) AS r, count(*) OVER (PARTITION BY {g}) AS n FROM lineitem) WHERE r > floor(n * 0.1) AND r <= n - floor(n * 0.1) GROUP BY {g}"""


@query("a23_order_statistics", sql=f"""SELECT l_returnflag, round(median(l_extendedprice), 4) AS median, percentile, round(q1, 4) AS q1, round(q3, 4) AS q3, n, round(trimmed_mean, 4) AS trimmed_mean FROM (
  SELECT l_returnflag, l_extendedprice, quantile_disc(l_extendedprice, 0.9) OVER w AS percentile, quantile_cont(l_extendedprice, 0.25) OVER w AS q1, quantile_cont(l_extendedprice, 0.75) OVER w AS q3, count(*) OVER w AS n FROM lineitem WINDOW w AS (PARTITION BY l_returnflag))
  JOIN ({TRIM.format(g='l_returnflag')}) USING (l_returnflag) GROUP BY ALL""")
def a23(fx: Fixtures) -> DataFrame:
    return rounded(st.order_stats(li(fx), "l_extendedprice", ["l_returnflag"]), "median", "q1", "q3", "trimmed_mean", digits=4)


@query("a24_other_means", sql="SELECT l_linenumber, round(count(*) / sum(1 / l_quantity), 6) AS harmonic_mean, round(exp(avg(ln(l_quantity))), 6) AS geometric_mean FROM lineitem GROUP BY 1")
def a24(fx: Fixtures) -> DataFrame:
    return rounded(st.other_means(li(fx), "l_quantity", ["l_linenumber"]), "harmonic_mean", "geometric_mean")


@query("a25_mode", sql="SELECT l_linenumber, CASE WHEN n > 1 THEN l_quantity END AS mode FROM (SELECT l_linenumber, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY l_linenumber ORDER BY n DESC, l_quantity) = 1")
def a25(fx: Fixtures) -> DataFrame:
    return st.mode(li(fx), "l_quantity", ["l_linenumber"])


@query("a26_moments", sql="SELECT l_linenumber, round(skewness(l_extendedprice), 5) AS skewness, round(kurtosis(l_extendedprice), 5) AS kurtosis FROM lineitem GROUP BY 1")
def a26(fx: Fixtures) -> DataFrame:
    return rounded(st.moments(li(fx), "l_extendedprice", ["l_linenumber"]), "skewness", "kurtosis", digits=5)


@query("a27_mad", sql="SELECT l_linenumber, round(mad(l_extendedprice), 4) AS mad FROM lineitem GROUP BY 1")
def a27(fx: Fixtures) -> DataFrame:
    return rounded(st.mad(li(fx), "l_extendedprice", ["l_linenumber"]), "mad", digits=4)


@query("a28_arg_extrema", sql="SELECT event_type, (SELECT event_id FROM events i WHERE i.event_type = e.event_type ORDER BY value, event_id LIMIT 1) AS min_index, (SELECT event_id FROM events i WHERE i.event_type = e.event_type ORDER BY value DESC, event_id LIMIT 1) AS max_index FROM (SELECT DISTINCT event_type FROM events) e")
def a28(fx: Fixtures) -> DataFrame:
    return st.arg_extrema(fx.table("events"), "value", "event_id", ["event_type"])


@query("a29_frequency_distribution", sql="SELECT CAST(u AS DOUBLE) AS upper, count(l_quantity) AS n FROM (VALUES (5, 0), (10, 5), (25, 10), (60, 25)) b(u, l) LEFT JOIN lineitem ON l_quantity <= u AND l_quantity > l GROUP BY u")
def a29(fx: Fixtures) -> DataFrame:
    return st.frequency(li(fx), "l_quantity", [5, 10, 25, 60])


@query("a29_frequency_equal_bins", sql="""WITH m AS (SELECT min(l_discount) AS lo, max(l_discount) AS hi FROM lineitem), b AS (SELECT k, lo + (hi - lo) / 4 * (k + 1) AS u, CASE WHEN k = 0 THEN -1 ELSE lo + (hi - lo) / 4 * k END AS l FROM m, range(0, 4) r(k))
  SELECT round(u, 9) AS upper, count(l_discount) AS n FROM b LEFT JOIN lineitem ON round(l_discount, 6) <= round(u, 6) AND round(l_discount, 6) > round(l, 6) GROUP BY u""")
def a29b(fx: Fixtures) -> DataFrame:
    return rounded(st.frequency(li(fx), "l_discount", 4), "upper", digits=9)


@query("a30_cumulative_frequency", sql="WITH f AS (SELECT CAST(u AS DOUBLE) AS upper, count(l_quantity) AS n FROM (VALUES (5, 0), (10, 5), (25, 10), (60, 25)) b(u, l) LEFT JOIN lineitem ON l_quantity <= u AND l_quantity > l GROUP BY u) SELECT upper, n, CAST(sum(n) OVER (ORDER BY upper) AS BIGINT) AS cumulative, round(n / sum(n) OVER (), 9) AS relative, round(sum(n) OVER (ORDER BY upper) / sum(n) OVER (), 9) AS relative_cumulative FROM f")
def a30(fx: Fixtures) -> DataFrame:
    return rounded(st.cumulative_frequency(a29(fx)), "relative", "relative_cumulative", digits=9)


@query("a31_least_squares", sql="SELECT l_linenumber, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept, round(corr(l_extendedprice, l_quantity), 6) AS r, round(sqrt((regr_syy(l_extendedprice, l_quantity) - regr_slope(l_extendedprice, l_quantity) * regr_sxy(l_extendedprice, l_quantity)) / count(*)), 2) AS rms FROM lineitem GROUP BY 1")
def a31(fx: Fixtures) -> DataFrame:
    s = st.least_squares(li(fx), "l_quantity", "l_extendedprice", ["l_linenumber"])
    return rounded(rounded(rounded(rounded(s, "slope", digits=4), "r"), "intercept", digits=3), "rms", digits=2)


@query("a32_drop_outlier", sql="WITH m AS (SELECT event_type, avg(value) AS m FROM events GROUP BY 1), f AS (SELECT event_id, abs(value - m) AS d FROM events JOIN m USING (event_type) QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY abs(value - m) DESC, event_id) = 1) SELECT event_id FROM events WHERE event_id NOT IN (SELECT event_id FROM f WHERE d > 100)")
def a32(fx: Fixtures) -> DataFrame:
    return st.drop_outlier(fx.table("events"), "value", lambda v, m: F.abs(v - m) > 100, "event_id", ["event_type"]).select("event_id")


@query("w6_exponential_smoothing", sql="""WITH RECURSIVE o AS (SELECT user_id AS u, CAST(event_id AS BIGINT) AS event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
  s AS (SELECT u, event_id, k, value AS x FROM o WHERE k = 1 UNION ALL SELECT o.u, o.event_id, o.k, 0.4 * s.x + (1 - 0.4) * o.value FROM s JOIN o ON o.u = s.u AND o.k = s.k + 1)
  SELECT u AS user_id, event_id, round(x, 6) AS smoothed FROM s""")
def w6(fx: Fixtures) -> DataFrame:
    return rounded(w6_all(fx), "smoothed")


@query("w6_exponential_smoothing_all")
def w6_all(fx: Fixtures) -> DataFrame:
    return st.exp_smooth(fx.table("events"), ["user_id"], "event_id", "value", 0.4)


@query("w7_weighted_smoothing", sql="""WITH RECURSIVE o AS (SELECT user_id AS u, CAST(event_id AS BIGINT) AS event_id, value AS x, CAST(1 + event_id % 5 AS DOUBLE) AS n, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
  r AS (SELECT u, event_id, i, x, n AS w FROM o WHERE i = 1 UNION ALL
    SELECT o.u, o.event_id, o.i, (r.x * (0.4 * r.w / (r.w + o.n)) + o.x * (0.6 * o.n / (r.w + o.n))) / (0.4 * r.w / (r.w + o.n) + 0.6 * o.n / (r.w + o.n)), (r.w * (0.4 * r.w / (r.w + o.n)) + o.n * (0.6 * o.n / (r.w + o.n))) / (0.4 * r.w / (r.w + o.n) + 0.6 * o.n / (r.w + o.n))
    FROM r JOIN o ON o.u = r.u AND o.i = r.i + 1)
  SELECT u AS user_id, event_id, round(x, 6) AS smoothed FROM r""")
def w7(fx: Fixtures) -> DataFrame:
    e = fx.table("events").withColumn("samples", 1 + F.col("event_id") % 5)
    return rounded(st.weighted_smooth(e.select("user_id", "event_id", "value", "samples"), ["user_id"], "event_id", "value", "samples", 0.4), "smoothed")


@query("u1_summarise", "exon", sql="SELECT chrom, count(*) AS n, CAST(sum(en - st + 1) AS BIGINT) AS total, round(avg(en - st + 1), 6) AS mean, round(var_samp(en - st + 1), 6) AS variance, round(stddev_samp(en - st + 1), 6) AS sd, min(en - st + 1) AS min, max(en - st + 1) AS max, max(en - st + 1) - min(en - st + 1) AS range FROM exon GROUP BY chrom")
def u1(fx: Fixtures) -> DataFrame:
    return rounded(st.summarise(fx.exon, ft.genomic_length(), ["chrom"]), "mean", "variance", "sd")


# sequences: documents as nucleotide strings
SEQ = "sq AS (SELECT doc_id, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BDEFHIJKLMOPQRSUVWXYZ', 'ACGTNACGTACGTNACGTACG') AS seq FROM documents)"


def seqs(fx: Fixtures) -> DataFrame:
    s = F.translate(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), "BDEFHIJKLMOPQRSUVWXYZ", "ACGTNACGTACGTNACGTACG")
    return fx.table("documents").select("doc_id", s.alias("seq"))


@query("q1_revcomp", sql=f"WITH {SEQ} SELECT doc_id, md5(reverse(translate(seq, 'ACGTN', 'TGCAN'))) AS h FROM sq")
def q1(fx: Fixtures) -> DataFrame:
    return seqs(fx).select("doc_id", F.md5(sq.revcomp(F.col("seq"))).alias("h"))


@query("q2_translate_cds", sql="""WITH sq AS (SELECT doc_id, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BDEFHIJKLMOPQRSUVWXYZ', 'ACGTNACGTACGTNACGTACG') AS seq FROM documents),
  code AS (SELECT a || b || c AS codon, substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG', 1 + 16 * i + 4 * j + k, 1) AS aa FROM (VALUES ('T', 0), ('C', 1), ('A', 2), ('G', 3)) x(a, i), (VALUES ('T', 0), ('C', 1), ('A', 2), ('G', 3)) y(b, j), (VALUES ('T', 0), ('C', 1), ('A', 2), ('G', 3)) z(c, k)),
  c AS (SELECT doc_id, i, substr(seq, 3 * i - 2, 3) AS codon FROM sq, LATERAL (SELECT unnest(range(1, length(seq) // 3 + 1)) AS i)),
  p AS (SELECT doc_id, string_agg(coalesce(aa, 'X'), '' ORDER BY i) AS p FROM c LEFT JOIN code USING (codon) GROUP BY doc_id)
  SELECT doc_id, md5(regexp_replace(coalesce(p, ''), '\\*$', '')) AS h FROM sq LEFT JOIN p USING (doc_id)""")
def q2(fx: Fixtures) -> DataFrame:
    return seqs(fx).select("doc_id", F.md5(sq.translate_cds(F.col("seq"))).alias("h"))


@query("q3_gc_content", sql=f"WITH {SEQ} SELECT doc_id, round(length(regexp_replace(seq, '[^GC]', '', 'g')) / nullif(length(seq), 0), 9) AS gc FROM sq")
def q3(fx: Fixtures) -> DataFrame:
    return seqs(fx).select("doc_id", F.round(sq.gc_content(F.col("seq")), 9).alias("gc"))


@query("q4_extract_sequence", sql=f"""WITH {SEQ}, parts AS (SELECT doc_id, seq, 1 + doc_id % 40 AS s1, 60 + doc_id % 40 AS e1, 130 AS s2, 150 + doc_id % 200 AS e2 FROM sq),
  j AS (SELECT doc_id, substr(seq, s1, e1 - s1 + 1) || substr(seq, s2, e2 - s2 + 1) AS x FROM parts WHERE length(seq) >= s1)
  SELECT doc_id, CASE WHEN doc_id % 2 = 1 THEN reverse(translate(x, 'ACGTN', 'TGCAN')) ELSE x END AS seq FROM j""")
def q4(fx: Fixtures) -> DataFrame:
    s = seqs(fx)
    d = F.col("doc_id")
    p = s.where(F.length("seq") > 0).select("doc_id", d.cast("string").alias("chrom"), F.when(d % 2 == 1, "-").otherwise("+").alias("strand"), F.explode(F.array(F.struct((1 + d % 40).alias("start"), (60 + d % 40).alias("end")), F.struct(F.lit(130).cast("long").alias("start"), (150 + d % 200).alias("end")))).alias("p"))
    parts = p.select("doc_id", "chrom", "strand", "p.start", "p.end")
    return sq.extract(parts, sq.chunked(s.select(d.cast("string").alias("chrom"), "seq"), 64), 64, "doc_id")


@query("q5_expand_iupac", sql="""WITH m AS (SELECT * FROM (VALUES ('A', 'A'), ('C', 'C'), ('G', 'G'), ('T', 'T'), ('U', 'T'), ('M', 'AC'), ('R', 'AG'), ('W', 'AT'), ('S', 'CG'), ('Y', 'CT'), ('K', 'GT'), ('V', 'ACG'), ('H', 'ACT'), ('D', 'AGT'), ('B', 'CGT'), ('X', 'GATC'), ('N', 'GATC')) t(k, v)),
  p AS (SELECT p_partkey, i, substr(upper(p_type), i, 1) AS c FROM part, LATERAL (SELECT unnest(range(1, length(p_type) + 1)) AS i))
  SELECT p_partkey, coalesce(string_agg(v, '' ORDER BY i), '') AS bases FROM p LEFT JOIN m ON c = k GROUP BY p_partkey""")
def q5(fx: Fixtures) -> DataFrame:
    return fx.table("part").select("p_partkey", F.array_join(sq.expand_iupac(F.col("p_type")), "").alias("bases"))


@query("q6_round_compare", sql="SELECT count(*) FILTER (round(l_tax, 6) <= round(l_discount, 6)) AS le, count(*) FILTER (round(l_tax, 6) < round(l_discount, 6)) AS lt, count(*) FILTER (round(l_tax, 6) >= round(l_discount, 6)) AS ge, count(*) FILTER (round(l_tax, 6) > round(l_discount, 6)) AS gt FROM lineitem")
def q6(fx: Fixtures) -> DataFrame:
    return li(fx).agg(*[F.count(F.when(sq.float_cmp(F.col("l_tax"), F.col("l_discount"), op), 1)).alias(n) for op, n in (("<=", "le"), ("<", "lt"), (">=", "ge"), (">", "gt"))])


@query("s12_n_runs", sql=f"""WITH {SEQ}, c AS (SELECT doc_id, unnest(string_split(seq, '')) AS b, generate_subscripts(string_split(seq, ''), 1) AS i FROM sq WHERE seq <> ''),
  r AS (SELECT doc_id, min(i) AS st, max(i) AS en FROM (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM c WHERE b = 'N') GROUP BY doc_id, g) SELECT CAST(doc_id AS VARCHAR) AS chrom, st, en FROM r WHERE en - st + 1 >= 2""")
def s12(fx: Fixtures) -> DataFrame:
    s = seqs(fx).select(F.col("doc_id").cast("string").alias("chrom"), "seq")
    return sq.n_runs(sq.chunked(s, 100), 2)


# consensus coverage
#: Consensus ends with insertions and deletions, and the lift of each end by its own anchor.
REP_END = "rep_start + {en} - {st} + te_id % 41 - 20"
CON = f"""co AS MATERIALIZED (SELECT *, least(a, b) AS cs, greatest(a, b) AS ce FROM (SELECT *, CASE WHEN te_strand = '+' THEN rep_start + (os - te_st) ELSE rep_start + (te_en - oe) END AS a, CASE WHEN te_strand = '+' THEN rep_end - (te_en - oe) ELSE rep_end - (os - te_st) END AS b FROM (
  SELECT h.*, r.rep_start, {REP_END.format(en='r.en', st='r.st').replace('te_id', 'r.te_id').replace('rep_start', 'r.rep_start')} AS rep_end, r.rep_left, greatest(h.te_st, h.st) AS os, least(h.te_en, h.en) AS oe FROM hit h JOIN te r ON h.te_id = r.te_id)))"""


def te_raw(fx: Fixtures) -> DataFrame:
    """Repeats with the three raw consensus columns as the annotation writes them."""
    end = F.expr(REP_END.format(en="end", st="start"))
    s, left = F.col("rep_start").cast("string"), F.concat(F.lit("("), F.col("rep_left").cast("string"), F.lit(")"))
    minus = F.col("strand") == "-"
    return fx.te.withColumns({"r11": F.when(minus, left).otherwise(s), "r12": end.cast("string"), "r13": F.when(minus, s).otherwise(left)}).drop("rep_start", "rep_left")


@query("v1_consensus_coords", "te", sql=f"SELECT te_id, rep_start, {REP_END.format(en='en', st='st')} AS rep_end, rep_left FROM te")
def v1(fx: Fixtures) -> DataFrame:
    return cv.consensus_coords(te_raw(fx)).select("te_id", "rep_start", "rep_end", "rep_left")


def lifted(fx: Fixtures) -> DataFrame:
    j = cv.with_consensus(hits(fx), cv.consensus_coords(te_raw(fx))).withColumns({"o_st": F.greatest("te_st", "st"), "o_en": F.least("te_en", "en")})
    return checkpoint(cv.lift_to_consensus(j).select("te_id", "tr", "k", "rname", "con_start", "con_end", "con_left", "rep_end", "rep_left"))


@query("j10_consensus_lookup", "hit", "te", sql="SELECT h.te_id, tr, k, min(r.rep_start) AS rep_start FROM hit h JOIN te r ON h.rname = r.rname AND h.chrom = r.chrom AND h.te_st = r.st AND h.te_en = r.en AND h.block = r.block GROUP BY ALL")
def j10(fx: Fixtures) -> DataFrame:
    return cv.with_consensus(hits(fx), cv.consensus_coords(te_raw(fx))).groupBy("te_id", "tr", "k").agg(F.min("rep_start").alias("rep_start"))


@query("v2_lift_to_consensus", "hit", "te", sql=f"WITH {CON} SELECT te_id, tr, k, cs AS con_start, ce AS con_end, rep_left + rep_end - ce AS con_left FROM co")
def v2(fx: Fixtures) -> DataFrame:
    return lifted(fx).select("te_id", "tr", "k", "con_start", "con_end", "con_left")


LENS = "ln AS (SELECT rname, length FROM (SELECT rname, rep_end + rep_left AS length, count(*) AS n FROM co GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY rname ORDER BY n DESC, length DESC) = 1)"


@query("a17_consensus_length", "hit", "te", sql=f"WITH {CON}, {LENS} SELECT rname, length FROM ln")
def a17(fx: Fixtures) -> DataFrame:
    return cv.consensus_lengths(lifted(fx))


@query("a18_depth_per_base", "hit", "te", sql=f"WITH {CON}, {LENS} SELECT l.rname, pos, count(c.rname) AS depth FROM (SELECT rname, unnest(range(1, length + 1)) AS pos FROM ln) l LEFT JOIN co c ON c.rname = l.rname AND pos BETWEEN cs AND ce GROUP BY ALL")
def a18(fx: Fixtures) -> DataFrame:
    j = lifted(fx)
    return cv.depth_per_base(j, cv.consensus_lengths(j))


@query("a19_coverage_wide", "hit", "te", sql=f"WITH {CON}, {LENS}, d AS (SELECT l.rname, pos, count(c.rname) AS depth FROM (SELECT rname, unnest(range(1, length + 1)) AS pos FROM ln WHERE rname IN ('R1', 'R7', 'R12')) l LEFT JOIN co c ON c.rname = l.rname AND pos BETWEEN cs AND ce GROUP BY ALL) SELECT pos, coalesce(max(depth) FILTER (rname = 'R1'), 0) AS \"R1\", coalesce(max(depth) FILTER (rname = 'R7'), 0) AS \"R7\", coalesce(max(depth) FILTER (rname = 'R12'), 0) AS \"R12\" FROM d GROUP BY pos")
def a19(fx: Fixtures) -> DataFrame:
    return cv.coverage_wide(a18(fx), ["R1", "R7", "R12"])


@query("a19_coverage_wide_all")
def a19_all(fx: Fixtures) -> DataFrame:
    j = lifted(fx)
    lengths = cv.consensus_lengths(j)
    names = lengths.select("rname").distinct().orderBy("rname").collect()  # one column each
    return cv.coverage_wide(cv.depth_per_base(j, lengths), [r.rname for r in names])


@query("a20_fragment_filters", "hit", "te", sql=f"WITH {CON}, {LENS}, f AS (SELECT te_id, tr, k, co.rname FROM co JOIN ln ON co.rname = ln.rname WHERE length >= 100 AND abs(rep_end + rep_left - length) <= 150) SELECT te_id, tr, k FROM f WHERE rname IN (SELECT rname FROM f GROUP BY rname HAVING count(*) >= 2)")
def a20(fx: Fixtures) -> DataFrame:
    return cv.filter_coverage(lifted(fx), 2, 100, 150).select("te_id", "tr", "k")


@query("v3_consensus_coverage", "hit", "te", sql=f"WITH {CON}, {LENS}, f0 AS (SELECT co.* FROM co JOIN ln ON co.rname = ln.rname WHERE length >= 50), f AS (SELECT * FROM f0 WHERE rname IN (SELECT rname FROM f0 GROUP BY rname HAVING count(*) >= 2)) SELECT l.rname, pos, count(c.rname) AS depth FROM (SELECT rname, unnest(range(1, length + 1)) AS pos FROM ln WHERE rname IN (SELECT rname FROM f)) l LEFT JOIN f c ON c.rname = l.rname AND pos BETWEEN cs AND ce GROUP BY ALL")
def v3(fx: Fixtures) -> DataFrame:
    return cv.consensus_coverage(hits(fx), cv.consensus_coords(te_raw(fx)), min_fragments=2, min_length=50)


#: Hits with their category at the category's place, once per place, strand, category and repeat name; then as before.
PLACED = f"""{STRUCT}, {CATS}, si AS (SELECT unnest(['exonized', 'TSS', 'polyA', '5SPL', '3SPL']) AS site),
  pp AS (SELECT site, ct.te_id, ct.chrom, ct.strand, te_strand, category, rname, te_st, te_en, CASE WHEN site = 'exonized' THEN ct.st WHEN (site IN ('TSS', '3SPL')) = (ct.strand = '-') THEN ct.en ELSE ct.st END AS st, CASE WHEN site = 'exonized' THEN ct.en WHEN (site IN ('TSS', '3SPL')) = (ct.strand = '-') THEN ct.en ELSE ct.st END AS en
    FROM ct JOIN si ON site = 'exonized' OR contains(category, site)),
  po AS (SELECT pp.*, r.rep_start, {REP_END.format(en='r.en', st='r.st').replace('te_id', 'r.te_id').replace('rep_start', 'r.rep_start')} AS rep_end, r.rep_left, greatest(pp.te_st, pp.st) AS os, least(pp.te_en, pp.en) AS oe FROM (SELECT * FROM pp QUALIFY row_number() OVER (PARTITION BY site, chrom, st, en, strand, category, rname ORDER BY te_st, te_en, te_id) = 1) pp JOIN te r ON pp.te_id = r.te_id),
  co AS MATERIALIZED (SELECT *, least(a, b) AS cs, greatest(a, b) AS ce FROM (SELECT *, CASE WHEN te_strand = '+' THEN rep_start + (os - te_st) ELSE rep_start + (te_en - oe) END AS a, CASE WHEN te_strand = '+' THEN rep_end - (te_en - oe) ELSE rep_end - (os - te_st) END AS b FROM po WHERE os <= oe)),
  ln AS (SELECT site, rname, length FROM (SELECT site, rname, rep_end + rep_left AS length, count(*) AS n FROM co GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY site, rname ORDER BY n DESC, length DESC) = 1)"""


@query("v3_coverage_by_category", "hit", "exon", "tr", "te", sql=f"WITH {PLACED} SELECT l.site, l.rname, pos, count(c.rname) AS depth FROM (SELECT site, rname, unnest(range(1, length + 1)) AS pos FROM ln) l LEFT JOIN co c ON c.site = l.site AND c.rname = l.rname AND pos BETWEEN cs AND ce GROUP BY ALL")
def v3_category(fx: Fixtures) -> DataFrame:
    return cv.coverage_by_category(with_cats(fx), cv.consensus_coords(te_raw(fx)))


@query("v3_coverage_fragments", "te", sql=f"WITH co AS (SELECT rname, least(rep_start, rep_end) AS cs, greatest(rep_start, rep_end) AS ce, rep_end, rep_left FROM (SELECT rname, rep_start, rep_left, {REP_END.format(en='en', st='st')} AS rep_end FROM te)), {LENS} SELECT l.rname, pos, count(c.rname) AS depth FROM (SELECT rname, unnest(range(1, length + 1)) AS pos FROM ln) l LEFT JOIN co c ON c.rname = l.rname AND pos BETWEEN cs AND ce GROUP BY ALL")
def v3_fragments(fx: Fixtures) -> DataFrame:
    return cv.consensus_coverage(None, cv.consensus_coords(te_raw(fx)), kind="RMout")


# merged reports: the runs are the strands of the features
def runs(fx: Fixtures) -> dict[str, DataFrame]:
    h = cl.te_bucket(hits(fx))
    return {"a.up.1000.corr": h.where("strand = '+'"), "b.UTRs": h.where("strand = '-'")}


RUN = f"hr AS (SELECT *, CASE WHEN strand = '+' THEN 'a.up.1000.corr' ELSE 'b.UTRs' END AS run, {SIX} AS class6 FROM hit)"


def class_long(fx: Fixtures) -> DataFrame:
    return mg.merge_summaries({n: cm.nr_length(h, ["class6"]).select(F.lit("length").alias("metric"), "class6", F.col("nr_len").alias("value")) for n, h in runs(fx).items()})


@query("m1_merge_summaries", "hit", sql=f"WITH {RUN}, n AS ({NR.format(by='run, class6', t='hr')}) SELECT run, 'length' AS metric, class6, nr_len AS value FROM n")
def m1(fx: Fixtures) -> DataFrame:
    return class_long(fx)


CLS = ("LTR", "LINE", "SINE", "DNA", "Others", "nonTE")


@query("m2_merge_class_tables", "hit", sql=f"WITH {RUN}, n AS ({NR.format(by='run, class6', t='hr')}) SELECT run, CASE WHEN run LIKE '%up%' THEN '01.up' ELSE '02.UTR' END AS region, 'length' AS metric, " + ", ".join(f"CAST(coalesce(sum(nr_len) FILTER (class6 = '{c}'), 0) AS BIGINT) AS \"{c}\"" for c in CLS) + " FROM n GROUP BY run")
def m2(fx: Fixtures) -> DataFrame:
    return mg.merge_class_tables(class_long(fx), CLS)


@query("m3_merge_age_tables", "hit", sql=f"WITH {RUN}, {INFO}, h2 AS (SELECT hr.*, lineage AS type, age AS category FROM hr JOIN ti USING (rname) WHERE run = 'a.up.1000.corr' OR lineage <> 'L1'), n AS ({NR.format(by='run, type, category', t='h2')}) SELECT run, type, category, coalesce(nr_len, 0) AS amount, round(coalesce(100 * nr_len / 1000, 0), 6) AS pct FROM (SELECT DISTINCT run FROM n) CROSS JOIN (SELECT DISTINCT type, category FROM n) LEFT JOIN n USING (run, type, category)")
def m3(fx: Fixtures) -> DataFrame:
    parts = {n: ft.add_age(h, te_info(fx)).where("age IS NOT NULL" + ("" if n == "a.up.1000.corr" else " AND lineage <> 'L1'")) for n, h in runs(fx).items()}
    long = mg.merge_summaries({n: cm.nr_length(h, ["lineage", "age"]).select(F.col("lineage").alias("type"), F.col("age").alias("category"), F.col("nr_len").alias("amount"), F.lit(1000).alias("set_len")) for n, h in parts.items()})
    return rounded(mg.merge_age_tables(long), "pct").withColumn("amount", F.col("amount").cast("long"))


@query("m4_split_run_name", sql="SELECT event_type || '.gtf.' || CAST(user_id AS VARCHAR) || '.tab' AS run, event_type || '.gtf' AS name, CAST(user_id AS VARCHAR) || '.tab' AS subset, count(*) AS n FROM events GROUP BY ALL")
def m4(fx: Fixtures) -> DataFrame:
    e = fx.table("events").select(F.concat_ws(".", "event_type", F.lit("gtf"), F.col("user_id").cast("string"), F.lit("tab")).alias("run"))
    name, subset = mg.run_subset(F.col("run"))
    return e.select("run", name.alias("name"), subset.alias("subset")).groupBy("run", "name", "subset").agg(F.count(F.lit(1)).alias("n"))


@query("m5_merge_enrichment", "hit", sql=f"WITH {RUN}, o AS (SELECT run, rclass, rfam, rname, count(DISTINCT (tr, k)) AS obs, round(1 / (1 + count(*)), 6) AS p FROM hr GROUP BY ALL) SELECT rclass, rfam, rname, " + ", ".join(f"coalesce(max(obs) FILTER (run = '{r}'), 0) AS \"{r}_obs\", max(p) FILTER (run = '{r}') AS \"{r}_p\"" for r in ("a.up.1000.corr", "b.UTRs")) + " FROM o GROUP BY ALL")
def m5(fx: Fixtures) -> DataFrame:
    long = mg.merge_summaries({n: h.groupBy("rclass", "rfam", "rname").agg(F.countDistinct("tr", "k").alias("obs"), F.round(1 / (1 + F.count(F.lit(1))), 6).alias("p")) for n, h in runs(fx).items()})
    return mg.merge_enrichment(long, ["a.up.1000.corr", "b.UTRs"])


@query("u2_outlier_predicate", sql="""WITH m AS (SELECT avg(l_extendedprice) AS m FROM lineitem), f AS (SELECT l_quantity, abs(l_extendedprice - m) AS d FROM lineitem, m ORDER BY d DESC, l_orderkey, l_linenumber LIMIT 1)
  SELECT count(*) - 1 AS n, round(sum(l_quantity) - (SELECT l_quantity FROM f), 2) AS total FROM lineitem""")
def u2(fx: Fixtures) -> DataFrame:
    kept = st.drop_outlier(li(fx), "l_extendedprice", lambda v, m: F.abs(v - m) > 1, "l_orderkey")
    return kept.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("total"))

"""Interval algebra over the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.operators import intervals as iv
from locuspark.plans.fixtures import Fixtures
from locuspark.plans.registry import query

#: Merged intervals of a table, in DuckDB.
MERGE = """SELECT chrom, min(st) AS st, max(en) AS en, count(*) AS n FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR st > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY st, en, o ROWS UNBOUNDED PRECEDING) AS isl FROM (
    SELECT *, max(en) OVER (PARTITION BY chrom ORDER BY st, en, o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (
      SELECT chrom, st, en, row_number() OVER (PARTITION BY chrom ORDER BY st, en) AS o FROM {t}))) GROUP BY chrom, isl"""
M = f"WITH mt AS MATERIALIZED ({MERGE.format(t='te')}), me AS MATERIALIZED ({MERGE.format(t='exon')})"
#: The pieces of merged table a that merged table b leaves, in DuckDB.
DIFF = """SELECT chrom, st, en FROM (
  SELECT chrom, s AS st, coalesce(lead(bs) OVER (PARTITION BY chrom, ast ORDER BY o) - 1, aen) AS en FROM (
    SELECT a.chrom, a.st AS ast, a.en AS aen, 0 AS o, a.st AS s, NULL AS bs FROM {a} a
    UNION ALL SELECT a.chrom, a.st, a.en, b.st, b.en + 1, b.st FROM {a} a JOIN {b} b ON a.chrom = b.chrom AND a.st <= b.en AND b.st <= a.en)) WHERE st <= en"""
HITS = "SELECT rclass, count(*) AS n_pairs, count(DISTINCT (tr, k)) AS n_features, CAST(sum(overlap) AS BIGINT) AS overlap FROM hit GROUP BY rclass"


@query("repeat_composition", "hit", sql=HITS)
def repeat_composition(fx: Fixtures) -> DataFrame:
    j = iv.overlap_join(fx.te.select("chrom", "start", "end", "rclass"), fx.exon.select("chrom", "start", "end", "tr", "k"), min_nt=10)
    return j.groupBy(F.col("a_rclass").alias("rclass")).agg(F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("b_tr", "b_k").alias("n_features"), F.sum("overlap").alias("overlap"))


@query("j1_overlap_join", "hit", sql="SELECT te_id, tr, k, overlap FROM hit")
def j1(fx: Fixtures) -> DataFrame:
    j = iv.overlap_join(fx.te.select("chrom", "start", "end", "te_id"), fx.exon.select("chrom", "start", "end", "tr", "k"), min_nt=10)
    return j.select(F.col("a_te_id").alias("te_id"), F.col("b_tr").alias("tr"), F.col("b_k").alias("k"), "overlap")


@query("j1_overlap_join_long", "te", "tr", sql="""SELECT te_id, tr, CAST(least(t.en, r.en) - greatest(t.st, r.st) + 1 AS BIGINT) AS overlap
  FROM te t JOIN tr r ON t.chrom = r.chrom AND t.st <= r.en AND r.st <= t.en""")
def j1_long(fx: Fixtures) -> DataFrame:
    j = iv.overlap_join(fx.te.select("chrom", "start", "end", "te_id"), fx.tr.select("chrom", "start", "end", "tr"), bin_size=500, long_intervals=True)
    return j.select(F.col("a_te_id").alias("te_id"), F.col("b_tr").alias("tr"), "overlap")


@query("j1_overlap_half_open", "te", "exon", sql="""SELECT te_id, tr, k, CAST(least(t.en, e.en) - greatest(t.st, e.st) AS BIGINT) AS overlap
  FROM te t JOIN exon e ON t.chrom = e.chrom AND t.st <= e.en AND e.st <= t.en WHERE least(t.en, e.en) - greatest(t.st, e.st) >= 1""")
def j1_half(fx: Fixtures) -> DataFrame:
    j = iv.overlap_join(fx.te.select("chrom", "start", "end", "te_id"), fx.exon.select("chrom", "start", "end", "tr", "k"), coords="half_open")
    return j.select(F.col("a_te_id").alias("te_id"), F.col("b_tr").alias("tr"), F.col("b_k").alias("k"), "overlap")


@query("f8_min_overlap_pct", "hit", sql="SELECT te_id, tr, k, overlap FROM hit WHERE 100 * overlap >= 80 * (en - st + 1)")
def f8(fx: Fixtures) -> DataFrame:
    j = iv.overlap_join(fx.te.select("chrom", "start", "end", "te_id"), fx.exon.select("chrom", "start", "end", "tr", "k"), min_nt=10)
    return iv.min_overlap(j, pct=80).select(F.col("a_te_id").alias("te_id"), F.col("b_tr").alias("tr"), F.col("b_k").alias("k"), "overlap")


@query("w1_merge_intervals", "te", sql=MERGE.format(t="te"))
def w1(fx: Fixtures) -> DataFrame:
    return iv.merge_intervals(fx.te)


@query("j2_subtract_intervals", "te", "exon", sql=f"""WITH mb AS MATERIALIZED ({MERGE.format(t='te')}) SELECT tr, k, st, en FROM (
  SELECT tr, k, s AS st, coalesce(lead(bs) OVER (PARTITION BY tr, k ORDER BY o) - 1, aen) AS en FROM (
    SELECT tr, k, en AS aen, 0 AS o, st AS s, NULL AS bs FROM exon
    UNION ALL SELECT a.tr, a.k, a.en, b.st, b.en + 1, b.st FROM exon a JOIN mb b ON a.chrom = b.chrom AND a.st <= b.en AND b.st <= a.en)) WHERE st <= en""")
def j2(fx: Fixtures) -> DataFrame:
    return iv.subtract_intervals(fx.exon.select("chrom", "start", "end", "tr", "k"), fx.te).select("tr", "k", "start", "end")


@query("j3_nearest", "peak", "tr", sql="""WITH tss AS (SELECT tr, chrom, strand, CASE WHEN strand = '-' THEN en ELSE st END AS p FROM tr),
  c AS (SELECT peak_id, tr, abs(d) AS ad, d FROM (SELECT peak_id, tr,
    CAST(CASE WHEN p.st > t.p THEN p.st - t.p WHEN p.en < t.p THEN t.p - p.en ELSE 0 END AS BIGINT)
      * CASE WHEN (p.st > t.p) = (t.strand = '-') THEN -1 ELSE 1 END AS d FROM peak p JOIN tss t ON p.chrom = t.chrom))
  SELECT peak_id, tr, d AS distance FROM c QUALIFY row_number() OVER (PARTITION BY peak_id ORDER BY ad, tr) = 1""")
def j3(fx: Fixtures) -> DataFrame:
    p = F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start"))
    tss = fx.tr.select("chrom", "strand", "tr", p.alias("start"), p.alias("end"))
    return iv.nearest(fx.peak, tss, "peak_id", "tr")


@query("j4_adjacent_fragments", "exon", "tr", sql="""SELECT e.tr, e.k FROM exon e JOIN tr t ON e.gene = t.gene WHERE e.tr <> t.tr AND (e.en = t.st - 1 OR e.st = t.en + 1 ) GROUP BY e.tr, e.k""")
def j4(fx: Fixtures) -> DataFrame:
    return iv.keep_adjacent(fx.exon, fx.tr, "gene").select("tr", "k").distinct()


@query("j12_features_without_te", "exon", "hit", sql="SELECT tr, k FROM exon e WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.tr = e.tr AND h.k = e.k)")
def j12(fx: Fixtures) -> DataFrame:
    return fx.exon.join(fx.raw("hit"), ["tr", "k"], "left_anti").select("tr", "k")


@query("j12_features_with_te", "exon", "hit", sql="SELECT tr, k FROM exon e WHERE EXISTS (SELECT 1 FROM hit h WHERE h.tr = e.tr AND h.k = e.k)")
def j12b(fx: Fixtures) -> DataFrame:
    return fx.exon.join(fx.raw("hit"), ["tr", "k"], "left_semi").select("tr", "k")


@query("x1_interval_union", "te", "exon", sql=f"WITH u AS (SELECT chrom, st, en FROM te UNION ALL SELECT chrom, st, en FROM exon) SELECT chrom, st, en FROM ({MERGE.format(t='u')})")
def x1(fx: Fixtures) -> DataFrame:
    return iv.interval_union(fx.te, fx.exon)


@query("x2_interval_intersection", "te", "exon", sql=f"{M} SELECT a.chrom, greatest(a.st, b.st) AS st, least(a.en, b.en) AS en FROM mt a JOIN me b ON a.chrom = b.chrom AND a.st <= b.en AND b.st <= a.en")
def x2(fx: Fixtures) -> DataFrame:
    return iv.interval_intersection(fx.te, fx.exon)


@query("x3_interval_difference", "te", "exon", sql=f"{M} {DIFF.format(a='mt', b='me')}")
def x3(fx: Fixtures) -> DataFrame:
    return iv.interval_difference(fx.te, fx.exon)


@query("x4_interval_xor", "te", "exon", sql=f"{M}, x AS MATERIALIZED ({DIFF.format(a='mt', b='me')} UNION ALL {DIFF.format(a='me', b='mt')}) SELECT chrom, st, en FROM ({MERGE.format(t='x')})")
def x4(fx: Fixtures) -> DataFrame:
    return iv.interval_xor(fx.te, fx.exon)


@query("x5_interval_complement", "te", "sizes", sql=f"WITH mt AS MATERIALIZED ({MERGE.format(t='te')}), w AS MATERIALIZED (SELECT chrom, 1 AS st, length AS en FROM sizes) {DIFF.format(a='w', b='mt')}")
def x5(fx: Fixtures) -> DataFrame:
    return iv.interval_complement(fx.te, fx.sizes)


@query("x6_interval_contained", "te", "exon", sql=f"WITH me AS MATERIALIZED ({MERGE.format(t='exon')}) SELECT te_id FROM te t WHERE EXISTS (SELECT 1 FROM me m WHERE m.chrom = t.chrom AND t.st >= m.st AND t.en <= m.en)")
def x6(fx: Fixtures) -> DataFrame:
    return iv.contained_in(fx.te, fx.exon).select("te_id")


@query("x6_set_predicates", "te", "exon", sql=f"""{M}, na AS (SELECT chrom, sum(en - st + 1) AS n FROM mt GROUP BY chrom), nb AS (SELECT chrom, sum(en - st + 1) AS n FROM me GROUP BY chrom),
  nab AS (SELECT a.chrom, sum(least(a.en, b.en) - greatest(a.st, b.st) + 1) AS n FROM mt a JOIN me b ON a.chrom = b.chrom AND a.st <= b.en AND b.st <= a.en GROUP BY a.chrom),
  j AS (SELECT coalesce(na.chrom, nb.chrom) AS chrom, coalesce(na.n, 0) AS a, coalesce(nb.n, 0) AS b, coalesce(nab.n, 0) AS ab FROM na FULL JOIN nb ON na.chrom = nb.chrom LEFT JOIN nab ON nab.chrom = coalesce(na.chrom, nb.chrom))
  SELECT chrom, ab = a AS is_subset, ab = b AS is_superset, (ab = a AND ab = b) AS is_equal, ab = 0 AS is_disjoint FROM j""")
def x6b(fx: Fixtures) -> DataFrame:
    return iv.set_predicates(fx.te, fx.exon)


@query("x7_interval_size", "te", sql=f"SELECT chrom, CAST(sum(greatest(least(en, 900000) - greatest(st, 1000) + 1, 0)) AS BIGINT) AS n FROM ({MERGE.format(t='te')}) GROUP BY chrom")
def x7(fx: Fixtures) -> DataFrame:
    return iv.interval_size(fx.te, 1000, 900_000)


RANGES = """WITH p AS (SELECT DISTINCT l_suppkey AS g, l_partkey AS v FROM lineitem),
  r AS (SELECT g, min(v) AS st, max(v) AS en FROM (SELECT g, v, v - row_number() OVER (PARTITION BY g ORDER BY v) AS isl FROM p) GROUP BY g, isl)"""


@query("x8_points_to_ranges", sql=RANGES + " SELECT g, st, en FROM r")
def x8(fx: Fixtures) -> DataFrame:
    p = fx.table("lineitem").select(F.col("l_suppkey").alias("g"), F.col("l_partkey").alias("v"))
    return iv.points_to_ranges(p, ["g"], "v")


@query("x8_format_ranges", sql=RANGES + " SELECT g, string_agg(CASE WHEN st = en THEN CAST(st AS VARCHAR) ELSE st || '-' || en END, ',' ORDER BY st) AS ranges FROM r GROUP BY g")
def x8b(fx: Fixtures) -> DataFrame:
    return iv.format_ranges(x8(fx), ["g"])


@query("x8_parse_ranges", sql=RANGES + " SELECT g, st, en FROM r")
def x8c(fx: Fixtures) -> DataFrame:
    return iv.parse_ranges(x8b(fx), "ranges")


@query("x9_distinct", sql="SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def x9(fx: Fixtures) -> DataFrame:
    return fx.table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("a1_covered_amount", "exon", "te", sql=f"""SELECT CAST((SELECT sum(en - st + 1) FROM te) AS BIGINT) AS total, CAST(sum(en - st + 1) AS BIGINT) AS nr,
  CAST((SELECT sum(en - st + 1) FROM te) - sum(en - st + 1) AS BIGINT) AS overlap FROM ({MERGE.format(t='te')})""")
def a1(fx: Fixtures) -> DataFrame:
    return iv.covered_amount(fx.te)


@query("a1_covered_amount_adjacent", "te", sql="""SELECT rclass, CAST(sum(en - st + 1) AS BIGINT) AS total, CAST(sum(en - st + 1) - sum(sh) AS BIGINT) AS nr, CAST(sum(sh) AS BIGINT) AS overlap FROM (
  SELECT *, CASE WHEN p >= st THEN p - st + 1 ELSE 0 END AS sh FROM (SELECT *, lag(en) OVER (PARTITION BY rclass, chrom ORDER BY st, en) AS p FROM te)) GROUP BY rclass""")
def a1b(fx: Fixtures) -> DataFrame:
    return iv.covered_amount(fx.te, ["rclass"], parity=True)


@query("o1_sort_intervals", "te", sql="SELECT te_id, chrom, st, en FROM te ORDER BY chrom, st, en")
def o1(fx: Fixtures) -> DataFrame:
    return iv.sort_intervals(fx.te.select("te_id", "chrom", "start", "end"))


@query("o2_first_per_group", "te", sql="SELECT rname, te_id, chrom, st FROM te QUALIFY row_number() OVER (PARTITION BY rname ORDER BY chrom, st, te_id) = 1")
def o2(fx: Fixtures) -> DataFrame:
    return iv.first_per(fx.te, ["rname"], ["chrom", "start", "te_id"]).select("rname", "te_id", "chrom", "start")

"""Shuffles and enrichment tests over the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.functions.binomial import binomial_test
from locuspark.operators import enrich as en
from locuspark.operators import shuffle as sh
from locuspark.operators.intervals import first_per
from locuspark.operators.model import pick_transcript, seeded_key
from locuspark.plans.fixtures import Fixtures
from locuspark.plans.model_queries import SHUFFLE, rand_key
from locuspark.plans.registry import query

ROUNDS = 10  # the reference's default
TEST_ROUNDS = 100  # of the tests end to end that have no SQL: the smallest p is 2 / TEST_ROUNDS
INSIDE = "s + CASE WHEN s < 1 THEN 1 - s WHEN e > length THEN greatest(length - e, 1 - s) ELSE 0 END AS st, least(e + CASE WHEN s < 1 THEN 1 - s WHEN e > length THEN greatest(length - e, 1 - s) ELSE 0 END, length) AS en"


def permuted(i: str, n: str, r: str, seed: int = 1) -> str:
    """DuckDB: the place of i of n in round r, rotated and mirrored as in operators.shuffle.permutation."""
    mix = lambda y: f"((({y}) * (({y}) % 65521 + 3)) % {sh.PRIME})"
    key = lambda s: mix(f"((({r}) * 64 + {s}) * {sh.MULTIPLIER} + {seed}) % {sh.TOP}")
    mirror = f"(({key('s')} % ({n}) + ({n}) - x) % ({n}))"
    bit = mix(f"(greatest(x, {mirror}) * {sh.MULTIPLIER} + {key('s')}) % {sh.TOP}")
    return f"list_reduce(list_concat([(({i}) + {key('0')}) % ({n})], range(1, {sh.STEPS + 1})), lambda x, s: CASE WHEN {bit} & 128 = 0 THEN x ELSE {mirror} END)"


PLACES = "CAST(row_number() OVER (PARTITION BY chrom ORDER BY te_id) - 1 AS BIGINT) AS i, count(*) OVER (PARTITION BY chrom) AS n"
POSITIONS = f"""pl AS MATERIALIZED (SELECT t.*, length, {PLACES} FROM te t JOIN sizes USING (chrom)),
  md AS MATERIALIZED (SELECT chrom, i AS j, (st + en) // 2 AS m FROM pl),
  dr AS MATERIALIZED (SELECT r AS round, pl.*, {permuted('i', 'n', 'r')} AS j FROM pl, range(1, {ROUNDS + 1}) x(r)),
  sp AS MATERIALIZED (SELECT round, te_id, chrom, rname, rfam, rclass, {INSIDE} FROM (SELECT dr.*, m - (en - st) // 2 AS s, m - (en - st) // 2 + en - st AS e FROM dr JOIN md USING (chrom, j)))"""


#: The columns that a placement is known by.
PLACED = ("te_id", "chrom", "start", "end")
#: What an exon is known by.
FEATURE = ("tr", "k")


def shuffled(fx: Fixtures, rounds: int = ROUNDS, near: DataFrame | None = None) -> DataFrame:
    return sh.shuffle_positions(fx.te, fx.sizes, rounds, keep=("te_id", "chrom", "start", "end", *en.LEVELS), near=near)


def with_observed(fx: Fixtures, rounds: int = ROUNDS) -> DataFrame:
    """Placements of all rounds near exons, and the repeats near exons as they are (null round), by levels."""
    return sh.shuffle_positions(fx.te, fx.sizes, rounds, keep=("chrom", "start", "end", *en.LEVELS), near=fx.exon, as_they_are=True)


def tss(fx: Fixtures) -> DataFrame:
    p = F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start"))
    return fx.tr.select(F.col("tr").alias("tss_id"), "chrom", "strand", p.alias("start"), p.alias("end"))


@query("r2_shuffle_positions", "te", "sizes", sql=f"WITH {POSITIONS} SELECT round, te_id, chrom, st, en FROM sp")
def r2(fx: Fixtures) -> DataFrame:
    return sh.shuffle_positions(fx.te, fx.sizes, ROUNDS, keep=PLACED).select("round", "te_id", "chrom", "start", "end")


@query("j11_shuffle_pair", "te", "sizes", sql=f"WITH {POSITIONS} SELECT round, chrom, count(*) AS n, CAST(sum(en - st + 1) AS BIGINT) AS bases FROM sp GROUP BY round, chrom")
def j11(fx: Fixtures) -> DataFrame:
    return sh.shuffle_positions(fx.te, fx.sizes, ROUNDS, keep=PLACED).groupBy("round", "chrom").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start") + 1).alias("bases"))


@query("r3_shuffle_keep_tss_distance", "te", "tr", "sizes", sql=f"""WITH ts AS MATERIALIZED (SELECT tr, chrom, strand, CASE WHEN strand = '-' THEN en ELSE st END AS p, row_number() OVER (PARTITION BY chrom ORDER BY tr) - 1 AS slot, count(*) OVER (PARTITION BY chrom) AS n FROM tr),
  d AS MATERIALIZED (SELECT te_id, CAST(CASE WHEN t.st > p THEN t.st - p WHEN t.en < p THEN p - t.en ELSE 0 END * CASE WHEN (t.st > p) = (s.strand = '-') THEN -1 ELSE 1 END AS BIGINT) AS d FROM te t JOIN ts s ON t.chrom = s.chrom
    QUALIFY row_number() OVER (PARTITION BY te_id ORDER BY CASE WHEN t.st > p THEN t.st - p WHEN t.en < p THEN p - t.en ELSE 0 END, s.tr) = 1),
  pl AS MATERIALIZED (SELECT t.te_id, t.chrom, t.en - t.st AS span, d, abs(d) AS g, length, {PLACES.replace('chrom', 't.chrom').replace('te_id', 't.te_id')} FROM te t JOIN d USING (te_id) JOIN sizes z ON z.chrom = t.chrom),
  r AS (SELECT x.r AS round, pl.te_id, pl.chrom, span, d, g, length, {permuted('i', 'n', 'x.r')} AS k FROM pl, range(1, {ROUNDS + 1}) x(r)),
  q AS (SELECT r.*, p, (d > 0) = (strand = '+') AS rt FROM r JOIN ts ON ts.chrom = r.chrom AND ts.slot = r.k % ts.n),
  w AS (SELECT *, CASE WHEN rt THEN p + g ELSE p - g - span END AS a, CASE WHEN rt THEN p - g - span ELSE p + g END AS b FROM q),
  y AS (SELECT *, CASE WHEN d = 0 THEN p - span // 2 WHEN a < 1 OR a + span > length THEN b ELSE a END AS s FROM w),
  z AS (SELECT *, s + span AS e FROM y) SELECT round, te_id, chrom, {INSIDE} FROM z""")
def r3(fx: Fixtures) -> DataFrame:
    return sh.shuffle_tss(fx.te, tss(fx), fx.sizes, ROUNDS, keep=PLACED).select("round", "te_id", "chrom", "start", "end")


@query("r1_shuffle_random")
def r1(fx: Fixtures) -> DataFrame:
    return sh.shuffle_random(fx.te, fx.sizes, ROUNDS, keep=PLACED, excl=fx.exon).select("round", "te_id", "chrom", "start", "end")


@query("r1_shuffle_random_tolerant")
def r1_tolerant(fx: Fixtures) -> DataFrame:
    out = sh.shuffle_random(fx.te, fx.sizes, ROUNDS, keep=PLACED, excl=fx.exon, max_excl_fraction=0.1)
    return out.select("round", "te_id", "chrom", "start", "end")


@query("r1_shuffle_random_apart")
def r1_apart(fx: Fixtures) -> DataFrame:
    return sh.shuffle_random(fx.te, fx.sizes, ROUNDS, keep=PLACED, excl=fx.exon, no_overlap=True).select("round", "te_id", "chrom", "start", "end")


#: Hits of shuffled repeats over exons; both sides are cut into bins of 1,000, and hits are counted distinct.
SHUFFLED_HITS = """eb AS MATERIALIZED (SELECT e.*, unnest(range(st // 1000, en // 1000 + 1)) AS bin FROM exon e),
  hx AS MATERIALIZED (SELECT s.round, s.te_id, s.rname, s.rfam, s.rclass, s.st AS te_st, s.en AS te_en, e.gene, e.tr, e.k, e.strand, e.st, e.en FROM (SELECT *, unnest(range(st // 1000, en // 1000 + 1)) AS bin FROM sp) s JOIN eb e ON s.chrom = e.chrom AND s.bin = e.bin
    WHERE least(s.en, e.en) - greatest(s.st, e.st) + 1 >= 10)"""
EXP = f"""{POSITIONS}, {SHUFFLED_HITS}, ob AS MATERIALIZED (SELECT coalesce(rclass, 'tot') AS rclass, count(DISTINCT (tr, k)) AS hits FROM hit GROUP BY ROLLUP (rclass)),
  ex AS MATERIALIZED (SELECT round, coalesce(rclass, 'tot') AS rclass, count(DISTINCT (tr, k)) AS hits FROM hx GROUP BY GROUPING SETS ((round), (round, rclass))),
  fl AS MATERIALIZED (SELECT k.rclass, r AS round, coalesce(hits, 0) AS hits FROM (SELECT rclass FROM ob UNION SELECT rclass FROM ex) k CROSS JOIN range(1, {ROUNDS + 1}) x(r) LEFT JOIN ex ON ex.rclass = k.rclass AND ex.round = x.r)"""
#: Two-tailed p of a rank among the rounds.
P = f"least(1.0, CASE WHEN rank <= {ROUNDS / 2} THEN 2 * rank / {ROUNDS}.0 ELSE 2 * ({ROUNDS + 2} - rank) / {ROUNDS}.0 END)"


def log_choose(n, k):
    """log of n over k as a column, by the Stirling series (exact to 1e-9 from 10 on; below by the shift to 10)."""
    def log_factorial(x):
        big = x.cast("double") + 10
        lifted = (big + 0.5) * F.ln(big) - big + 0.9189385332046727 + 1 / (12 * big) - 1 / (360 * big * big * big) + 1 / (1260 * big * big * big * big * big)
        for i in range(1, 11):
            lifted = lifted - F.ln(x + i)
        return lifted

    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def class_hits(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """Observed and expected hits of classes and in total."""
    fx.write("exon")
    obs, exp = en.observed_and_expected(with_observed(fx), fx.exon, FEATURE)
    top = lambda d, *extra: d.where("rfam = 'tot'").select(*extra, "rclass", "hits")
    return top(obs), top(exp, "round")


@query("r8_expected_initialised", "te", "sizes", "exon", "hit", sql=f"WITH {EXP} SELECT rclass, round, hits FROM fl")
def r8(fx: Fixtures) -> DataFrame:
    obs, exp = class_hits(fx)
    return en.expected_initialised(obs, exp, ["rclass"], ROUNDS)


@query("r9_aggregate_rounds", "te", "sizes", "exon", "hit", sql=f"WITH {EXP} SELECT rclass, round(avg(hits), 6) AS exp_mean, round(stddev_samp(hits), 6) AS exp_sd, count(*) AS n_rounds FROM fl GROUP BY rclass")
def r9(fx: Fixtures) -> DataFrame:
    a = en.aggregate_rounds(r8(fx), ["rclass"])
    return a.withColumns({"exp_mean": F.round("exp_mean", 6), "exp_sd": F.round("exp_sd", 6)})


@query("r10_expected_distribution", "te", "sizes", "exon", "hit", sql=f"WITH {EXP} SELECT rclass, string_agg(CAST(hits AS VARCHAR), ',' ORDER BY hits) AS counts FROM fl GROUP BY rclass")
def r10(fx: Fixtures) -> DataFrame:
    d = en.expected_distribution(r8(fx), ["rclass"])
    return d.select("rclass", F.array_join(F.transform("counts", lambda x: x.cast("string")), ",").alias("counts"))


@query("r4_permutation_test", "te", "sizes", "exon", "hit", sql=f"""WITH {EXP}, t AS (SELECT rclass, coalesce(max(ob.hits), 0) AS obs, avg(fl.hits) AS m, stddev_samp(fl.hits) AS sd, 1 + count(*) FILTER (fl.hits <= coalesce(ob.hits, 0)) AS rank FROM fl LEFT JOIN ob USING (rclass) GROUP BY rclass)
  SELECT rclass, obs, round(m, 6) AS exp_mean, round(sd, 6) AS exp_sd, rank, {P} AS p FROM t""")
def r4(fx: Fixtures) -> DataFrame:
    obs, exp = class_hits(fx)
    t = en.permutation_test(obs, exp, ["rclass"], ROUNDS)
    return t.withColumns({"exp_mean": F.round("exp_mean", 6), "exp_sd": F.round("exp_sd", 6)})


@query("w5_rank_in_expected", "te", "sizes", "exon", "hit", sql=f"WITH {EXP} SELECT rclass, 1 + count(*) FILTER (fl.hits < coalesce(ob.hits, 0)) AS rank FROM fl LEFT JOIN ob USING (rclass) GROUP BY rclass")
def w5(fx: Fixtures) -> DataFrame:
    obs, exp = class_hits(fx)
    return en.permutation_test(obs, exp, ["rclass"], ROUNDS, strict=True).select("rclass", "rank")


@query("r5_binomial_test", sql="""WITH b AS (SELECT l_linenumber, CAST(l_quantity AS INT) AS n, count(*) FILTER (l_returnflag = 'A') AS c FROM lineitem GROUP BY ALL), x AS (SELECT l_linenumber, n, c % (n + 1) AS x, 0.05 + l_linenumber / 10.0 AS p FROM b),
  f AS (SELECT l_linenumber, n, x, p, k, lgamma(n + 1) - CASE WHEN k = 0 THEN 0 ELSE lgamma(k + 1) END - CASE WHEN k = n THEN 0 ELSE lgamma(n - k + 1) END + k * ln(p) + (n - k) * ln(1 - p) AS l FROM x, LATERAL (SELECT unnest(range(0, n + 1)) AS k))
  SELECT l_linenumber, n, x, round(least(1, sum(exp(f.l))), 9) AS binom_p FROM f JOIN (SELECT l_linenumber, n, l AS lx FROM f WHERE k = x) g USING (l_linenumber, n) WHERE f.l <= lx + 1e-7 GROUP BY ALL""")
def r5(fx: Fixtures) -> DataFrame:
    q = F.col("l_quantity").cast("int")
    b = fx.table("lineitem").groupBy("l_linenumber", q.alias("n")).agg(F.count(F.when(F.col("l_returnflag") == "A", 1)).alias("c"))
    b = b.select("l_linenumber", "n", (F.col("c") % (F.col("n") + 1)).alias("x"), (0.05 + F.col("l_linenumber") / 10).alias("prob"))
    return binomial_test(b, "x", "n", "prob", interval=False).select("l_linenumber", "n", "x", F.round("binom_p", 9).alias("binom_p"))


#: Both limits of the interval leave 2.5 % in their tails, added up in DuckDB from the limits that the query gives back.
@query("r5_binomial_tails", sql="SELECT CAST(l_linenumber AS INT) AS l_linenumber, count(*) AS n, count(*) FILTER (l_returnflag = 'A') AS x, 0.025 AS upper_tail, 0.025 AS lower_tail FROM lineitem GROUP BY l_linenumber")
def r5c(fx: Fixtures) -> DataFrame:
    k = lambda lo, hi, p: F.aggregate(F.sequence(lo.cast("int"), hi.cast("int")), F.lit(0.0), lambda acc, i: acc + F.exp(log_choose(F.col("n"), i) + i * F.ln(p) + (F.col("n") - i) * F.ln(1 - p)))
    t = r5b(fx)
    return t.select(F.col("l_linenumber").cast("int").alias("l_linenumber"), "n", "x", F.round(k(F.col("x"), F.col("n"), F.col("ci_low")), 6).alias("upper_tail"), F.round(k(F.lit(0), F.col("x"), F.col("ci_high")), 6).alias("lower_tail"))


@query("r5_binomial_interval")
def r5b(fx: Fixtures) -> DataFrame:
    b = fx.table("lineitem").groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("l_returnflag") == "A", 1)).alias("x"))
    return binomial_test(b.withColumn("prob", F.lit(0.3)), "x", "n", "prob")


PICK = f"pk AS MATERIALIZED (SELECT r AS round, gene, tr, n_exons FROM (SELECT gene, tr, count(*) AS n_exons FROM exon GROUP BY gene, tr), range(1, {ROUNDS + 1}) s(r) QUALIFY row_number() OVER (PARTITION BY r, gene ORDER BY {rand_key('tr', 'r', 1)}, tr) = 1)"
#: Two ages of most repeat names, the second one of two names in three.
NAME_NO = "CAST(replace(rname, 'R', '') AS INT)"
AGE1, AGE2, AGED = f"'a' || CAST({NAME_NO} % 4 AS STRING)", f"CASE {NAME_NO} % 3 WHEN 0 THEN 'old' WHEN 1 THEN 'young' END", f"{NAME_NO} % 10 <> 9"
AGES = f"ag AS MATERIALIZED (SELECT DISTINCT rname, {AGE1} AS age1, {AGE2} AS age2 FROM te WHERE {AGED})"
AGE_LEVELS = "unnest([{'f': 'cat.1', 'nm': 'tot'}, {'f': 'cat.2', 'nm': 'tot'}, {'f': 'cat.1', 'nm': age1}, {'f': 'cat.2', 'nm': age2}]) AS l"


def ages(fx: Fixtures) -> DataFrame:
    return fx.te.select("rname").distinct().where(F.expr(AGED)).select("rname", F.expr(AGE1).alias("age1"), F.expr(AGE2).alias("age2"))


def level_counts(t: str, by: str, count: str = "count(DISTINCT (tr, k))") -> str:
    """DuckDB: hits in total and per class, family and name of a table's rows, for each ``by``."""
    sets = ", ".join(f"({x})" for x in (by, f"{by}, rclass", f"{by}, rclass, rfam", f"{by}, rclass, rfam, rname"))
    return f"SELECT {by}, coalesce(rclass, 'tot') AS rclass, coalesce(rfam, 'tot') AS rfam, coalesce(rname, 'tot') AS rname, {count} AS hits FROM {t} GROUP BY GROUPING SETS ({sets})"


def age_counts(t: str, by: str, count: str = "count(DISTINCT (tr, k))") -> str:
    return f"SELECT {by}, 'age' AS rclass, l.f AS rfam, l.nm AS rname, {count} AS hits FROM (SELECT t.*, {AGE_LEVELS} FROM {t} t JOIN ag USING (rname)) WHERE l.nm IS NOT NULL GROUP BY ALL"


GENOME = f"gn AS MATERIALIZED (SELECT * RENAME (hits AS n) FROM ({level_counts('(SELECT *, 0 AS one FROM te)', 'one', 'count(*)')} UNION ALL {age_counts('(SELECT *, 0 AS one FROM te)', 'one', 'count(*)')}))"


@query("r6_enrichment_levels", "te", "sizes", "exon", "hit", sql=f"""WITH {POSITIONS}, {SHUFFLED_HITS}, {AGES}, {GENOME},
  ob AS MATERIALIZED ({level_counts('(SELECT *, 0 AS round FROM hit)', 'round')} UNION ALL {age_counts('(SELECT *, 0 AS round FROM hit)', 'round')}),
  ex AS MATERIALIZED ({level_counts('hx', 'round')} UNION ALL {age_counts('hx', 'round')}),
  fl AS (SELECT k.rclass, k.rfam, k.rname, r AS round, coalesce(ex.hits, 0) AS e, coalesce(ob.hits, 0) AS o FROM (SELECT rclass, rfam, rname FROM ob UNION SELECT rclass, rfam, rname FROM ex) k CROSS JOIN range(1, {ROUNDS + 1}) x(r)
    LEFT JOIN ex ON ex.rclass = k.rclass AND ex.rfam = k.rfam AND ex.rname = k.rname AND ex.round = x.r LEFT JOIN ob ON ob.rclass = k.rclass AND ob.rfam = k.rfam AND ob.rname = k.rname),
  t AS (SELECT rclass, rfam, rname, max(o) AS obs, avg(e) AS m, stddev_samp(e) AS sd, 1 + count(*) FILTER (e <= o) AS rank FROM fl GROUP BY ALL)
  SELECT rclass, rfam, rname, obs, round(m, 6) AS exp_mean, round(sd, 6) AS exp_sd, rank, {P} AS p, n, (SELECT count(*) FROM exon) - obs AS unhit FROM t LEFT JOIN gn USING (rclass, rfam, rname)""")
def r6_levels(fx: Fixtures) -> DataFrame:
    t = simple(fx, ROUNDS).withColumns({"exp_mean": F.round("exp_mean", 6), "exp_sd": F.round("exp_sd", 6)})
    return t.select(*en.LEVELS, "obs", "exp_mean", "exp_sd", "rank", "p", "n", "unhit")


def simple(fx: Fixtures, rounds: int) -> DataFrame:
    fx.write("exon")
    features = fx.exon.select("chrom", "start", "end", *FEATURE)
    return en.enrichment(fx.te, features, with_observed(fx, rounds), rounds, FEATURE, ages=ages(fx), as_they_are=True)


@query("r6_enrichment_simple")
def r6(fx: Fixtures) -> DataFrame:
    return simple(fx, TEST_ROUNDS)


def category_counts(t: str) -> str:
    """DuckDB: hits per round, category and level, genes as category transcript, and an exon's ages by its first repeat."""
    first = f"SELECT round, tr, k, l, arg_min(category, (te_st, te_en, te_id)) AS category FROM (SELECT t.*, {AGE_LEVELS} FROM {t} t JOIN ag USING (rname)) WHERE l.nm IS NOT NULL GROUP BY ALL"
    tot = "'tot' AS rclass, 'tot' AS rfam, 'tot' AS rname"
    return f"{level_counts(t, 'round, category')} UNION ALL SELECT round, 'transcript', {tot}, count(DISTINCT gene) FROM {t} GROUP BY round UNION ALL SELECT round, category, 'age', l.f, l.nm, count(*) FROM ({first}) GROUP BY ALL"


OFFERED = (("transcript", "1"), ("TSS_polyA", "1"), ("TSS", "1"), ("polyA", "1"), ("exonized", "n_exons"), ("TSS_5SPL", "CAST(n_exons > 1 AS INT)"), ("3SPL_polyA", "CAST(n_exons > 1 AS INT)"), ("5SPL", "greatest(n_exons - 1, 0)"), ("3SPL", "greatest(n_exons - 1, 0)"), ("3SPL_exon_5SPL", "greatest(n_exons - 2, 0)"))
TOTALS = "SELECT round, c AS category, CAST(sum(v) AS BIGINT) AS n FROM (" + " UNION ALL ".join(f"SELECT round, '{c}' AS c, {v} AS v FROM pk" for c, v in OFFERED) + ") GROUP BY ALL"


@query("r7_enrichment_levels", "te", "sizes", "exon", "tr", "hit", sql=f"""WITH {POSITIONS}, {SHUFFLED_HITS}, {AGES}, {GENOME}, {PICK}, {SHUFFLE.format(hit='hit')}, {SHUFFLE.format(hit='(SELECT DISTINCT * FROM hx)').replace('sc AS', 'se AS')},
  so AS MATERIALIZED (SELECT sc.*, pk.round FROM sc JOIN pk ON sc.tr = pk.tr), sx AS MATERIALIZED (SELECT se.* FROM se JOIN pk ON se.tr = pk.tr AND se.round = pk.round),
  ob AS MATERIALIZED (SELECT category, rclass, rfam, rname, sum(hits) / {ROUNDS}.0 AS o FROM ({category_counts('so')}) GROUP BY ALL), ex AS MATERIALIZED ({category_counts('sx')}),
  fl AS (SELECT k.*, r, coalesce(hits, 0) AS e, coalesce(o, 0) AS o FROM (SELECT category, rclass, rfam, rname FROM ob UNION SELECT category, rclass, rfam, rname FROM ex) k CROSS JOIN range(1, {ROUNDS + 1}) x(r)
    LEFT JOIN ex ON ex.category = k.category AND ex.rclass = k.rclass AND ex.rfam = k.rfam AND ex.rname = k.rname AND ex.round = x.r LEFT JOIN ob ON ob.category = k.category AND ob.rclass = k.rclass AND ob.rfam = k.rfam AND ob.rname = k.rname),
  t AS (SELECT category, rclass, rfam, rname, max(o) AS obs, avg(e) AS m, 1 + count(*) FILTER (e <= o) AS rank, 1 + count(*) FILTER (e < o) AS strict FROM fl GROUP BY ALL),
  u AS (SELECT 'repeat' AS test, * EXCLUDE (strict) FROM t UNION ALL SELECT 'category', * EXCLUDE (rank) FROM t WHERE rclass = 'tot'),
  tt AS (SELECT category, CAST(round(avg(n)) AS BIGINT) AS n FROM ({TOTALS}) GROUP BY ALL)
  SELECT test, u.category, rclass, rfam, rname, round(obs, 6) AS obs, round(m, 6) AS exp_mean, rank, {P} AS p, CASE WHEN test = 'category' THEN tt.n ELSE gn.n END AS n FROM u LEFT JOIN gn USING (rclass, rfam, rname) LEFT JOIN tt ON tt.category = u.category""")
def r7_levels(fx: Fixtures) -> DataFrame:
    fx.write("exon")
    t = en.enrichment_transcripts(fx.te, fx.exon, shuffled(fx, near=fx.exon), ROUNDS, ages=ages(fx))
    return t.select("test", "category", *en.LEVELS, F.round("obs", 6).alias("obs"), F.round("exp_mean", 6).alias("exp_mean"), "rank", "p", "n")


@query("r7_enrichment_transcripts")
def r7(fx: Fixtures) -> DataFrame:
    fx.write("exon")
    return en.enrichment_transcripts(fx.te, fx.exon, shuffled(fx, TEST_ROUNDS, fx.exon), TEST_ROUNDS, ages=ages(fx))


@query("a14_expected_feature_totals", "exon", sql=f"WITH {PICK} {TOTALS}")
def a14(fx: Fixtures) -> DataFrame:
    index = fx.exon.groupBy("gene", "tr").agg(F.count(F.lit(1)).alias("n_exons"))
    return en.feature_totals(pick_transcript(index, ROUNDS))


@query("a16_percent_of_features", "te", "sizes", "exon", "hit", sql=f"WITH {EXP}, n AS (SELECT count(*) AS nf FROM exon) SELECT rclass, round(100 * max(ob.hits) / max(nf), 6) AS obs_pct, round(100 * avg(fl.hits) / max(nf), 6) AS exp_pct, max(nf) - max(ob.hits) AS unhit FROM fl JOIN ob USING (rclass), n GROUP BY rclass")
def a16(fx: Fixtures) -> DataFrame:
    fx.write("exon")
    features = fx.exon.select("chrom", "start", "end", *FEATURE)
    t = en.enrichment(fx.te, features, with_observed(fx), ROUNDS, FEATURE, as_they_are=True).where("rfam = 'tot'")
    return t.select("rclass", F.round("obs_pct", 6).alias("obs_pct"), F.round("exp_pct", 6).alias("exp_pct"), "unhit")


@query("m6_enrichment_matrices", "te", "sizes", "exon", "hit", sql=f"WITH {EXP}, t AS (SELECT rclass, coalesce(max(ob.hits), 0) AS obs, avg(fl.hits) AS m, 1 + count(*) FILTER (fl.hits <= coalesce(ob.hits, 0)) AS rank FROM fl LEFT JOIN ob USING (rclass) GROUP BY rclass) SELECT rclass, CASE WHEN rank <= {ROUNDS / 2} THEN 'DEPLETED' ELSE 'ENRICHED' END AS direction, round(obs / nullif(m, 0), 6) AS odds FROM t")
def m6(fx: Fixtures) -> DataFrame:
    from locuspark.operators.merge import enrichment_matrix

    t = r4(fx).withColumnRenamed("exp_mean", "exp")
    return enrichment_matrix(t, ROUNDS).select("rclass", "direction", F.round("odds", 6).alias("odds"))


@query("o3_random_pick", "te", sql=f"SELECT rclass, te_id FROM te QUALIFY row_number() OVER (PARTITION BY rclass ORDER BY {rand_key('te_id', '1', 7)}, te_id) = 1")
def o3(fx: Fixtures) -> DataFrame:
    t = fx.te.select("rclass", "te_id").withColumn("_key", seeded_key(F.col("te_id"), F.lit(1), 7))
    return first_per(t, ["rclass"], ["_key", "te_id"]).select("rclass", "te_id")

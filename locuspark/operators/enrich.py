"""Enrichment tests: permutation ranks, exact binomial tests, and both jobs end to end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.functions.binomial import binomial_test
from locuspark.operators.classify import classify_shuffle, stars
from locuspark.operators.compose import age_hits_by_category, genome_ages, genome_counts, hits_by_category, hits_by_level, with_ages
from locuspark.operators.intervals import overlap_join
from locuspark.operators.model import pick_transcript
from locuspark.storage import checkpoint

LEVELS = ("rclass", "rfam", "rname")


def expected_initialised(obs: DataFrame, exp: DataFrame, keys: Sequence[str], rounds: int) -> DataFrame:
    """(*keys, round, hits): expected counts with zeros for rounds and keys without hits, observed-only keys too."""
    exp = checkpoint(exp.select(*keys, "round", "hits"))  # few rows, read twice
    spine = obs.select(*keys).union(exp.select(*keys)).distinct().withColumn("round", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(rounds).cast("long"))))
    return spine.join(exp, [*keys, "round"], "left").select(*keys, "round", F.coalesce("hits", F.lit(0)).cast("long").alias("hits"))


def aggregate_rounds(exp: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, exp_mean, exp_sd, n_rounds)."""
    return exp.groupBy(*keys).agg(F.avg("hits").alias("exp_mean"), F.stddev_samp("hits").alias("exp_sd"), F.count(F.lit(1)).alias("n_rounds"))


def expected_distribution(exp: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, counts): the expected counts of all rounds, ascending (one number per round)."""
    return exp.groupBy(*keys).agg(F.array_sort(F.collect_list("hits")).alias("counts"))


def permutation_test(obs: DataFrame, exp: DataFrame, keys: Sequence[str], rounds: int, strict: bool | Column = False, parity: bool = False) -> DataFrame:
    """(*keys, obs, exp_mean, exp_sd, rank, p): two-tailed p of the observed count's rank among the rounds.

    The rank is 1 + the rounds with at most the observed count (fewer than it if ``strict``);
    p is 2 rank / N in the lower half, 2 (N + 2 - rank) / N in the upper, at most 1 (``parity``:
    the middle rank may give more). One pass over the rows of ``exp``: a round without a row counts as 0 hits.
    """
    keys = list(keys)
    both = exp.select(*keys, F.col("hits").alias("_e")).join(obs.select(*keys, F.col("hits").alias("_o")), keys, "full").withColumn("_o", F.coalesce("_o", F.lit(0)))
    strict = F.lit(strict) if isinstance(strict, bool) else strict
    s, q, seen = F.coalesce(F.sum("_e"), F.lit(0)).cast("double"), F.coalesce(F.sum(F.col("_e").cast("double") * F.col("_e")), F.lit(0.0)), F.count("_e")
    a = both.groupBy(*keys).agg(
        F.max("_o").alias("obs"),
        (s / rounds).alias("exp_mean"),
        (F.sqrt(F.greatest(F.lit(0.0), q - s * s / rounds) / (rounds - 1)) if rounds > 1 else F.lit(None).cast("double")).alias("exp_sd"),
        F.count(F.when(F.col("_e") < F.col("_o"), 1)).alias("_less"),
        F.count(F.when(F.col("_e") == F.col("_o"), 1)).alias("_same"),
        (rounds - seen).alias("_none"),
    )
    zeros = F.when(strict & (F.col("obs") <= 0), 0).otherwise(F.col("_none"))
    a = a.withColumn("rank", 1 + F.col("_less") + F.when(strict, 0).otherwise(F.col("_same")) + zeros).drop("_less", "_same", "_none")
    p = F.when(F.col("rank") <= rounds / 2, 2 * F.col("rank") / rounds).otherwise(2 * (rounds + 2 - F.col("rank")) / rounds)
    return a.withColumn("p", p if parity else F.least(F.lit(1.0), p))


def observed_hits(te: DataFrame, features: DataFrame, feature: Sequence[str], min_nt: int = 10, extra: Sequence[str] = (), ages: DataFrame | None = None) -> DataFrame:
    """Hits per level of repeats over features, and per age if ``ages`` are given; ``extra`` columns of the repeats (a round) stay apart."""
    j = overlap_join(te.select("chrom", "start", "end", *LEVELS, *extra), features.select("chrom", "start", "end", *feature), min_nt=min_nt)
    rows = j.select(*[F.col(f"a_{c}").alias(c) for c in (*LEVELS, *extra)], *[F.col(f"b_{c}").alias(c) for c in feature])
    return hits_by_level(rows if ages is None else with_ages(rows, ages), feature, extra, aged=ages is not None)


def observed_and_expected(placed: DataFrame, features: DataFrame, feature: Sequence[str], min_nt: int = 10, ages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Hits per level of the repeats as they are (rows of ``placed`` with a null round), and of the other rows per round.

    One join over the features for both, written once (few rows).
    """
    hits = checkpoint(observed_hits(placed, features, feature, min_nt, ("round",), ages))
    return hits.where("round IS NULL").drop("round"), hits.where("round IS NOT NULL")


def _genome(te: DataFrame, ages: DataFrame | None) -> DataFrame:
    return genome_counts(te) if ages is None else genome_counts(te).unionByName(genome_ages(with_ages(te.select("rname"), ages)))


def enrichment(te: DataFrame, features: DataFrame, shuffled: DataFrame, rounds: int, feature: Sequence[str] = ("feature",), min_nt: int = 10, ages: DataFrame | None = None, as_they_are: bool = False) -> DataFrame:
    """Simple features, end to end: observed and expected hits per level, permutation and binomial tests.

    ``shuffled`` holds all rounds (column round), so expected hits are one join; with ``as_they_are`` it holds the
    repeats that can touch a feature too (null round), else ``te`` goes along with it. The binomial
    test asks for obs successes of as many trials as the genome has such repeats, at the
    expected mean's rate. With ``ages`` (rname, age1, age2) there are rows of class ``age`` too.
    """
    cols = ["chrom", "start", "end", *LEVELS]
    placed = shuffled.select(*cols, F.col("round").cast("long").alias("round"))
    if not as_they_are:
        placed = placed.unionByName(te.select(*cols, F.lit(None).cast("long").alias("round")))
    obs, exp = observed_and_expected(placed, features, feature, min_nt, ages)
    t = permutation_test(obs, exp, LEVELS, rounds)
    total = features.select(*feature).distinct().agg(F.count(F.lit(1)).alias("n_features"))
    t = t.join(_genome(te, ages), list(LEVELS), "left").withColumn("prob", F.col("exp_mean") / F.col("n")).crossJoin(F.broadcast(total))  # one row
    t = t.withColumns({"obs_pct": 100 * F.col("obs") / F.col("n_features"), "exp_pct": 100 * F.col("exp_mean") / F.col("n_features"), "unhit": F.col("n_features") - F.col("obs")})
    return binomial_test(t).withColumn("significance", stars(F.col("p")))


def feature_totals(picked: DataFrame) -> DataFrame:
    """(round, category, n): how many features of each category the picked transcripts offer."""
    n = F.col("n_exons")
    row = lambda name, v: F.struct(F.lit(name).alias("category"), v.cast("long").alias("n"))
    more, most = n > 1, n > 2
    each = F.array(
        *[row(c, F.lit(1)) for c in ("transcript", "TSS_polyA", "TSS", "polyA")], row("exonized", n),
        row("TSS_5SPL", F.when(more, 1).otherwise(0)), row("3SPL_polyA", F.when(more, 1).otherwise(0)),
        row("5SPL", F.when(more, n - 1).otherwise(0)), row("3SPL", F.when(more, n - 1).otherwise(0)), row("3SPL_exon_5SPL", F.when(most, n - 2).otherwise(0)),
    )
    return picked.select("round", F.explode(each).alias("c")).groupBy("round", "c.category").agg(F.sum("c.n").alias("n"))


def category_hits(te: DataFrame, exons: DataFrame, picked: DataFrame, min_nt: int = 10, rounds_of_te: bool = False, ages: DataFrame | None = None) -> DataFrame:
    """(round, category, rclass, rfam, rname, hits): exons of the picked transcripts hit per category and level of repeats; genes hit as transcript.

    Transcript ends are found once per transcript and meet the hits, not all rounds. With
    ``rounds_of_te`` repeats have a round of their own, which must be the transcripts'.
    With ``ages``, an exon counts once per age, in the category of its first repeat with that
    age by place (start, end, te_id).
    """
    ends = exons.groupBy("gene", "tr").agg(F.min("start").alias("tr_st"), F.max("end").alias("tr_en"), F.count(F.lit(1)).alias("n_exons"))
    keep = ["chrom", "start", "end", *LEVELS, *(["round"] if rounds_of_te else []), *(["te_id"] if ages is not None else [])]
    j = overlap_join(te.select(*keep), exons.join(ends, ["gene", "tr"]).select("chrom", "start", "end", "gene", "tr", "k", "strand", "n_exons", "tr_st", "tr_en"), min_nt=min_nt)
    named = {"a_start": "te_st", "a_end": "te_en", "b_start": "st", "b_end": "en", **{f"b_{c}": c for c in ("gene", "tr", "k", "strand", "n_exons", "tr_st", "tr_en")}, **{f"a_{c}": c for c in (*LEVELS, "round", "te_id")}}
    rows = classify_shuffle(j.select(*[F.col(a).alias(b) for a, b in named.items() if a in j.columns]))
    on = ["tr", "round"] if rounds_of_te else ["tr"]
    rows = rows.join(picked.select("round", "tr"), on)
    if ages is None:
        return hits_by_category(rows, ["round"])
    rows = checkpoint(rows.select("round", "gene", "tr", "k", "category", *LEVELS, "te_st", "te_en", "te_id"))  # both hierarchies read it
    return hits_by_category(rows, ["round"]).unionByName(age_hits_by_category(with_ages(rows, ages), ["round"]))


def enrichment_transcripts(te: DataFrame, exons: DataFrame, shuffled: DataFrame, rounds: int, seed: int = 1, min_nt: int = 10, ages: DataFrame | None = None) -> DataFrame:
    """Transcripts, end to end: one transcript per gene and round; observed means, expected counts and tests.

    Rows with test = category have no level (tot): each category's features against what
    the picked transcripts offer, ranked among the rounds with fewer hits. Rows with test =
    repeat are per category and level of repeats: against the repeats of the genome, ranked
    among the rounds with at most as many. Observed hits are repeated over the rounds'
    transcript choices; their mean is ranked, rounded for the binomial test. With ``ages``
    (rname, age1, age2) there are rows of class ``age`` per category too.
    """
    index = exons.groupBy("gene", "tr").agg(F.count(F.lit(1)).alias("n_exons"))
    picked = checkpoint(pick_transcript(index, rounds, seed))
    keys = ["test", "category", *LEVELS]
    tests = F.explode(F.when(F.col("rclass") == "tot", F.array(F.lit("category"), F.lit("repeat"))).otherwise(F.array(F.lit("repeat")))).alias("test")
    obs = category_hits(te, exons, picked, min_nt, ages=ages).groupBy("category", *LEVELS).agg((F.sum("hits") / rounds).alias("hits")).select("*", tests)
    exp = category_hits(shuffled, exons, picked, min_nt, rounds_of_te=True, ages=ages).select("*", tests)
    t = permutation_test(obs, exp, keys, rounds, strict=F.col("test") == "category").withColumn("hits", F.round("obs").cast("long"))
    offered = feature_totals(picked).groupBy("category").agg(F.round(F.avg("n")).cast("long").alias("_offered"))
    t = t.join(offered, "category", "left").join(_genome(te, ages).withColumnRenamed("n", "_genome"), list(LEVELS), "left")
    t = t.withColumn("n", F.when(F.col("test") == "category", F.col("_offered")).otherwise(F.col("_genome"))).drop("_offered", "_genome")
    t = t.withColumn("prob", F.col("exp_mean") / F.col("n"))
    return binomial_test(t, x="hits").withColumn("significance", stars(F.col("p")))

"""Repeat composition of a feature set: lengths, counts, ratios and report tables of an overlap table.

The overlap table ("hits") has te_id, chrom, te_st, te_en, rname, rclass, rfam, block, overlap and
the feature's columns st, en, gene, tr, k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.operators.intervals import merge_intervals, previous_row
from locuspark.storage import checkpoint, if_small


def overlap_intervals(hits: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The overlapping piece of each hit as an interval."""
    return hits.select("chrom", F.greatest("te_st", "st").alias("start"), F.least("te_en", "en").alias("end"), *keep)


def nr_length(hits: DataFrame, by: Sequence[str], parity: bool = False) -> DataFrame:
    """(*by, nr_len): non-redundant overlap length per group; ``parity`` looks at the hit before only."""
    by = list(by)
    iv = overlap_intervals(hits, by)
    if not parity:
        return merge_intervals(iv, [*by, "chrom"]).groupBy(*by).agg(F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("nr_len"))
    iv, prev = previous_row(iv, [*by, "chrom"]), F.col("_before.end")
    new = F.when(prev >= F.col("end"), 0).when(prev >= F.col("start"), F.col("end") - prev).otherwise(F.col("end") - F.col("start") + 1)
    return iv.withColumn("_new", new).groupBy(*by).agg(F.sum("_new").cast("long").alias("nr_len"))


def fragment_counts(hits: DataFrame, by: Sequence[str] = ("rname",)) -> DataFrame:
    """(*by, fragments, nr_fragments, n_chrom): all hits, repeats joined by block, and chromosomes."""
    return hits.groupBy(*by).agg(F.count(F.lit(1)).alias("fragments"), F.countDistinct("rname", "block", "chrom").alias("nr_fragments"), F.countDistinct("chrom").alias("n_chrom"))


def hits_by_level(hits: DataFrame, feature: Sequence[str], extra: Sequence[str] = (), aged: bool = False) -> DataFrame:
    """(*extra, rclass, rfam, rname, hits): features hit at least once, in total ('tot') and per class, family, name.

    ``aged`` hits have age1 and age2 and are counted by age_hits' levels too. Hits are dealt by feature once, and each
    feature becomes one row, the set of the kinds of repeats that hit it. Equal sets are counted before their levels
    are made, so levels are made once per set, not per hit.
    """
    level = lambda c, f, n: F.struct(F.lit(False).alias("a"), c.alias("c"), f.alias("f"), n.alias("n"))
    kind = ["rclass", "rfam", "rname", *(["age1", "age2"] if aged else [])]

    def levels(x: Column) -> Column:
        tot = F.lit("tot")
        own = F.array(level(tot, tot, tot), level(x["rclass"], tot, tot), level(x["rclass"], x["rfam"], tot), level(x["rclass"], x["rfam"], x["rname"]))
        if not aged:
            return own
        ages = F.transform(_age_levels(x["age1"], x["age2"]), lambda y: F.struct(F.lit(True).alias("a"), y["c"].alias("c"), y["f"].alias("f"), y["n"].alias("n")))
        return F.when(x["age1"].isNotNull(), F.concat(own, ages)).otherwise(own)

    by = [*extra, *feature]
    sets = hits.select(*by, F.struct(*kind).alias("_kind")).repartition(*by).groupBy(*by).agg(F.array_sort(F.collect_set("_kind")).alias("_kinds"))
    sets = sets.groupBy(*extra, "_kinds").agg(F.count(F.lit(1)).alias("_k"))
    rows = sets.select(*extra, "_k", F.explode(F.array_distinct(F.flatten(F.transform("_kinds", levels)))).alias("l"))
    return rows.groupBy(*extra, "l").agg(F.sum("_k").alias("hits")).select(*extra, F.col("l.c").alias("rclass"), F.col("l.f").alias("rfam"), F.col("l.n").alias("rname"), "hits")


def hits_by_category(rows: DataFrame, extra: Sequence[str] = (), feature: Sequence[str] = ("tr", "k"), gene: str = "gene") -> DataFrame:
    """(*extra, category, rclass, rfam, rname, hits): features hit per category and level of repeats, and genes hit as category transcript.

    ``rows`` are hits with their category. A feature counts once per category and level; a gene once.
    """
    per = hits_by_level(rows, feature, [*extra, "category"])
    genes = rows.select(*extra, gene).distinct().groupBy(*extra).agg(F.count(F.lit(1)).alias("hits"))
    tot = [F.lit("tot").alias(c) for c in ("rclass", "rfam", "rname")]
    return per.unionByName(genes.select(*extra, F.lit("transcript").alias("category"), *tot, "hits"))


def genome_counts(te: DataFrame) -> DataFrame:
    """(rclass, rfam, rname, n): repeats in the genome in total and per class, family, name ('tot' above)."""
    r = te.rollup("rclass", "rfam", "rname").agg(F.count(F.lit(1)).alias("n"))
    return r.select(*[F.coalesce(c, F.lit("tot")).alias(c) for c in ("rclass", "rfam", "rname")], "n")


#: The class that age levels are counted under, and the families of its two groupings (fixed values).
AGE, AGE_GROUPS = "age", ("cat.1", "cat.2")


def with_ages(df: DataFrame, ages: DataFrame) -> DataFrame:
    """Add age1 and age2 by repeat name, as written; null where ``ages`` (rname, age1, age2; a row per name) lacks the name."""
    few = ages.select("rname", F.nullif("age1", F.lit("")).alias("age1"), F.nullif("age2", F.lit("")).alias("age2"))
    return df.join(if_small(few, few.count()), "rname", "left")


def _age_levels(age1: Column | str = "age1", age2: Column | str = "age2") -> Column:
    """Levels of a repeat with an age: both groupings in total, its first age, and its second one if there is any."""
    level = lambda k, name: F.struct(F.lit(AGE).alias("c"), F.lit(AGE_GROUPS[k]).alias("f"), name.alias("n"))
    ages = [F.col(c) if isinstance(c, str) else c for c in (age1, age2)]
    own = [F.when(c.isNotNull(), level(k, c)) for k, c in enumerate(ages)]
    return F.array_compact(F.array(level(0, F.lit("tot")), level(1, F.lit("tot")), *own))


def age_hits(hits: DataFrame, feature: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """(*extra, rclass, rfam, rname, hits): features hit at least once by repeats with an age, in total and per age of both groupings.

    The second hierarchy beside hits_by_level: rclass is ``age``, rfam the grouping, rname the age or ``tot``.
    """
    once = hits.where(F.col("age1").isNotNull()).select(*extra, *feature, "age1", "age2").distinct()
    rows = once.select(*extra, *feature, F.explode(_age_levels()).alias("l")).distinct()
    return rows.groupBy(*extra, F.col("l.c").alias("rclass"), F.col("l.f").alias("rfam"), F.col("l.n").alias("rname")).agg(F.count(F.lit(1)).alias("hits"))


def age_hits_by_category(rows: DataFrame, extra: Sequence[str] = (), feature: Sequence[str] = ("tr", "k"), order: Sequence[str] = ("te_st", "te_en", "te_id")) -> DataFrame:
    """(*extra, category, rclass, rfam, rname, hits): as age_hits, a feature counting once per age in all categories: in that of its first hit.

    First is the least ``order``, the repeats' places in a sorted file. The totals of both groupings are equal.
    """
    aged = rows.where(F.col("age1").isNotNull()).select(*extra, *feature, "category", F.struct(*order).alias("_o"), F.explode(_age_levels()).alias("l"))
    first = aged.groupBy(*extra, *feature, "l").agg(F.min(F.struct("_o", "category"))["category"].alias("category"))
    return first.groupBy(*extra, "category", F.col("l.c").alias("rclass"), F.col("l.f").alias("rfam"), F.col("l.n").alias("rname")).agg(F.count(F.lit(1)).alias("hits"))


def genome_ages(te: DataFrame) -> DataFrame:
    """(rclass, rfam, rname, n): repeats in the genome with an age, in total and per age of both groupings."""
    counts = te.where(F.col("age1").isNotNull()).groupBy("age1", "age2").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("n", F.explode(_age_levels()).alias("l")).groupBy(F.col("l.c").alias("rclass"), F.col("l.f").alias("rfam"), F.col("l.n").alias("rname")).agg(F.sum("n").alias("n"))


def genome_totals(te: DataFrame, by: Sequence[str] = ("rname",)) -> DataFrame:
    """(*by, g_len, g_count, g_nr): genome-wide length, fragments and block-corrected fragments."""
    return te.groupBy(*by).agg(F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("g_len"), F.count(F.lit(1)).alias("g_count"), F.countDistinct("block", "chrom").alias("g_nr"))


def te_ratios(hits: DataFrame, te: DataFrame) -> DataFrame:
    """Per repeat name: length, counts and their shares in the set and in the genome, and the ratios of the shares.

    Genome shares are over the names that the set holds. The hits are written once, as
    lengths and counts both read them.
    """
    hits = checkpoint(hits.select("te_id", "chrom", "te_st", "te_en", "st", "en", "rname", "block"))
    own = nr_length(hits, ["rname"]).join(fragment_counts(hits), "rname")
    g = genome_totals(te.withColumn("_l", F.lower("rname")), ["_l"])
    j = checkpoint(own.join(g, F.lower("rname") == F.col("_l"), "left").drop("_l"))  # one row per name
    total = j.agg(F.sum("nr_len").alias("t_len"), F.sum("nr_fragments").alias("t_nr"), F.sum("g_len").alias("tg_len"), F.sum("g_nr").alias("tg_nr"))
    share = lambda a, b: 100 * F.col(a) / F.col(b)
    return j.crossJoin(F.broadcast(total)).select(  # one row
        "rname", "nr_len", "fragments", "nr_fragments", "n_chrom", "g_len", "g_count", "g_nr",
        share("nr_len", "t_len").alias("pct_len"), share("nr_fragments", "t_nr").alias("pct_nr"),
        (share("nr_len", "t_len") / share("g_len", "tg_len")).alias("len_ratio"), (share("nr_fragments", "t_nr") / share("g_nr", "tg_nr")).alias("nr_ratio"),
    )


METRICS = ("Length", "nrCounts", "%len", "%nrCounts")


def bucket_table(hits: DataFrame, bucket: str, buckets: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(metric, one column per bucket): non-redundant length and block-corrected counts of each ``by``, summed over its bucket, and their shares.

    ``hits`` have the bucket, a function of ``by``. Four rows; zero where a bucket has no hit.
    """
    by = [*by, bucket]
    hits = checkpoint(hits.select("chrom", "te_st", "te_en", "st", "en", "te_id", "rname", "block", *by))
    counts = hits.groupBy(*by).agg(F.countDistinct("rname", "block", "chrom").alias("nr"))
    sums = nr_length(hits, by).join(counts, by).groupBy(F.col(bucket).alias("_b")).agg(F.sum("nr_len").alias("Length"), F.sum("nr").alias("nrCounts"))
    long = sums.select("_b", F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).cast("double").alias("v")) for m in METRICS[:2]])).alias("x")).select("_b", "x.m", "x.v")
    wide = long.groupBy(F.col("m").alias("metric")).pivot("_b", list(buckets)).agg(F.sum("v")).fillna(0)
    total = sum((F.col(f"`{b}`") for b in buckets[1:]), F.col(f"`{buckets[0]}`"))
    shares = wide.select(F.when(F.col("metric") == "Length", "%len").otherwise("%nrCounts").alias("metric"), *[(100 * F.col(f"`{b}`") / total).alias(b) for b in buckets])
    return wide.unionByName(shares)


def class_table(hits: DataFrame, buckets: Sequence[str], set_len: float) -> DataFrame:
    """bucket_table of the six classes (class6), with the lengths' TOTAL and its share of the set's length ``set_len``."""
    wide = bucket_table(hits, "class6", buckets, ["rclass"])
    length = F.col("metric") == "Length"
    total = sum((F.col(b) for b in buckets[1:]), F.col(buckets[0]))
    return wide.withColumn("TOTAL", F.when(length, total)).withColumn("pct_tot", F.when(length & F.lit(set_len > 0), 100 * total / F.lit(set_len or 1)).when(length, 0.0))


def site_hits(rows: DataFrame) -> DataFrame:
    """(tr_type, site, chrom, pos) that hits with a category take: TSS and polyA of the transcript, splice sites of the exon, transcripts.

    ``rows`` have category, tr_type, tr, chrom, strand, the exon's st and en, and tr_st and tr_en.
    """
    minus = F.col("strand") == "-"
    ends = {"TSS": ("tr_en", "tr_st"), "polyA": ("tr_st", "tr_en"), "5SPL": ("st", "en"), "3SPL": ("en", "st")}
    one = lambda k: F.when(F.col("category").contains(k), F.struct(F.lit(k).alias("site"), F.when(minus, F.col(ends[k][0])).otherwise(F.col(ends[k][1])).cast("string").alias("pos")))
    every = F.struct(F.lit("transcripts").alias("site"), F.col("tr").cast("string").alias("pos"))
    return rows.select("tr_type", "chrom", F.explode(F.array_compact(F.array(*map(one, ends), every))).alias("_s")).select("tr_type", "_s.site", "chrom", "_s.pos")


def site_summary(hits: DataFrame, sites: DataFrame) -> DataFrame:
    """(tr_type, site, in_te, n, pct): distinct sites that repeats take against all distinct sites; transcripts where a site has no total.

    ``sites`` is (tr_type, site, n), with a row ``transcripts`` per type.
    """
    hit = hits.groupBy("tr_type", "site").agg(F.countDistinct("chrom", "pos").alias("in_te"))
    trs = sites.where("site = 'transcripts'").select("tr_type", F.col("n").alias("_trs"))
    j = hit.join(sites, ["tr_type", "site"], "left").join(trs, "tr_type", "left").withColumn("n", F.coalesce("n", "_trs"))
    return j.select("tr_type", "site", "in_te", "n", F.when(F.col("n") > 0, 100 * F.col("in_te") / F.col("n")).otherwise(0.0).alias("pct"))


def te_transcript_table(hits: DataFrame, tr: DataFrame, structure: DataFrame, te_info: DataFrame) -> DataFrame:
    """Every hit with its transcript's, exon's and repeat's records; the repeat table (few rows per name) joins last."""
    t = tr.select("tr", F.col("start").alias("tr_st"), F.col("end").alias("tr_en"), "n_exons", "mature_len", "tr_type")
    e = structure.select("tr", "k", "exon_no", "exon_type")
    return hits.join(t, "tr").join(e, ["tr", "k"], "left").join(te_info, "rname", "left")

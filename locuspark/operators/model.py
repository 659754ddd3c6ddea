"""Transcript model: summaries, exon structure, introns, UTRs, flanks, sites, coordinates.

Exons are rows with gene, tr, chrom, strand, start, end (closed, 1-based); transcripts add n_exons,
mature_len and tr_type. All steps are group aggregates and windows per transcript.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.operators.intervals import merge_intervals, overlap_join, subtract_intervals



def _length() -> Column:
    return F.col("end") - F.col("start") + 1


def transcripts(exons: DataFrame, types: Sequence[str] = ()) -> DataFrame:
    """One row per transcript: chrom, strand, start, end, n_exons, mature_len and the first of each type column."""
    return exons.groupBy("gene", "tr").agg(
        F.min("chrom").alias("chrom"),
        F.min("strand").alias("strand"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.count(F.lit(1)).alias("n_exons"),
        F.sum(_length()).cast("long").alias("mature_len"),
        *[F.min(c).alias(c) for c in types],
    )


def cds_summary(cds: DataFrame, codons: DataFrame | None = None) -> DataFrame:
    """(tr, cds_start, cds_end, n_cds, cds_len, atg, stop): codon positions from the codon rows, else from the CDS ends.

    ``codons`` has tr, kind (start_codon or stop_codon), start, end; the position is the
    codon's first base in reading direction.
    """
    minus = F.col("strand") == "-"
    out = cds.groupBy("tr").agg(
        F.min("strand").alias("strand"), F.min("start").alias("cds_start"), F.max("end").alias("cds_end"), F.count(F.lit(1)).alias("n_cds"), F.sum(_length()).cast("long").alias("cds_len")
    )
    atg, stop = F.when(minus, F.col("cds_end")).otherwise(F.col("cds_start")), F.when(minus, F.col("cds_start")).otherwise(F.col("cds_end"))
    if codons is not None:
        at = lambda kind: F.min(F.when(F.col("kind") == kind, F.when(minus, F.col("end")).otherwise(F.col("start"))))
        c = codons.groupBy("tr").agg(at("start_codon").alias("_atg"), at("stop_codon").alias("_stop"))
        out, atg, stop = out.join(c, "tr", "left"), F.coalesce("_atg", atg), F.coalesce("_stop", stop)
    return out.select("tr", "cds_start", "cds_end", "n_cds", "cds_len", atg.alias("atg"), stop.alias("stop"))


def _place(first: str, last: str, single: str, middle: str, rank: Column, n: Column, minus: Column) -> Column:
    low = F.when(minus, last).otherwise(first)
    high = F.when(minus, first).otherwise(last)
    return F.when(n == 1, single).when(rank == 1, low).when(rank == n, high).otherwise(middle)


def exon_structure(exons: DataFrame) -> DataFrame:
    """Add exon_no (by coordinate) and exon_type SINGLE, FIRST, MIDDLE or LAST by strand."""
    w = Window.partitionBy("tr").orderBy("start", "end")
    rank = F.row_number().over(w).cast("long")
    n = F.count(F.lit(1)).over(Window.partitionBy("tr"))
    out = exons.withColumns({"exon_no": rank, "n_exons": n})
    return out.withColumn("exon_type", _place("FIRST", "LAST", "SINGLE", "MIDDLE", F.col("exon_no"), F.col("n_exons"), F.col("strand") == "-"))


def cds_structure(cds: DataFrame, summary: DataFrame) -> DataFrame:
    """Add cds_no and cds_type: by whether the part begins or ends at a codon; indet where it does neither nor lies between them."""
    w = Window.partitionBy("tr").orderBy("start", "end")
    s = summary.select("tr", "atg", "stop")
    minus = F.col("strand") == "-"
    head, tail = F.when(minus, F.col("end")).otherwise(F.col("start")), F.when(minus, F.col("start")).otherwise(F.col("end"))
    first, last = head == F.col("atg"), tail == F.col("stop")
    between = F.when(minus, (F.col("start") > F.col("stop")) & (F.col("end") < F.col("atg"))).otherwise((F.col("start") > F.col("atg")) & (F.col("end") < F.col("stop")))
    kind = F.when(first & last, "SINGLE").when(between, "MIDDLE").when(last, "LAST").when(first, "FIRST").otherwise("indet")
    return cds.withColumn("cds_no", F.row_number().over(w).cast("long")).join(s, "tr", "left").withColumn("cds_type", kind)


def introns(exons: DataFrame) -> DataFrame:
    """Gaps of more than one base between consecutive exons, numbered by coordinate."""
    w = Window.partitionBy("tr").orderBy("start", "end")
    prev = exons.withColumn("_prev", F.lag("end").over(w))
    gaps = prev.select("gene", "tr", "chrom", "strand", (F.col("_prev") + 1).alias("start"), (F.col("start") - 1).alias("end")).where(F.col("end") > F.col("start"))
    return gaps.withColumn("intron_no", F.row_number().over(w).cast("long"))


def utrs(exons: DataFrame, cds: DataFrame, summary: DataFrame) -> DataFrame:
    """Exons minus the CDS of the whole set, labelled 5UTR, 3UTR or indet by codon positions and strand."""
    left = subtract_intervals(exons, cds.select("chrom", "start", "end"))
    s = summary.select("tr", "atg", "stop")
    minus = F.col("strand") == "-"
    five = F.when(minus, F.col("start") > F.col("atg")).otherwise(F.col("end") < F.col("atg"))
    three = F.when(minus, F.col("end") < F.col("stop")).otherwise(F.col("start") > F.col("stop"))
    return left.join(s, "tr").withColumn("utr", F.when(five, "5UTR").when(three, "3UTR").otherwise("indet")).drop("atg", "stop")


def utrs_per_mrna(exons: DataFrame, summary: DataFrame) -> DataFrame:
    """Exon parts outside each transcript's own CDS span: (tr, utr, utr_no, chrom, strand, start, end)."""
    j = exons.join(summary.select("tr", "cds_start", "cds_end"), "tr")
    low = j.withColumns({"end": F.least(F.col("end"), F.col("cds_start") - 1), "utr": F.when(F.col("strand") == "-", "3UTR").otherwise("5UTR")})
    high = j.withColumns({"start": F.greatest(F.col("start"), F.col("cds_end") + 1), "utr": F.when(F.col("strand") == "-", "5UTR").otherwise("3UTR")})
    both = low.unionByName(high).where(F.col("start") <= F.col("end"))
    no = F.row_number().over(Window.partitionBy("tr", "utr").orderBy(F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))))
    return both.select("tr", "utr", no.cast("long").alias("utr_no"), "chrom", "strand", "start", "end")


def flanks(tr: DataFrame, sizes: DataFrame, n: int) -> DataFrame:
    """Up- and downstream regions of n bases by strand, clipped to 1 and the chromosome's length."""
    j = tr.select("gene", "tr", "chrom", "strand", "start", "end").join(sizes, "chrom")
    minus = F.col("strand") == "-"
    before = j.select("gene", "tr", "chrom", "strand", F.when(minus, "down").otherwise("up").alias("side"), F.greatest(F.lit(1), F.col("start") - n).cast("long").alias("start"), (F.col("start") - 1).alias("end"))
    after = j.select("gene", "tr", "chrom", "strand", F.when(minus, "up").otherwise("down").alias("side"), (F.col("end") + 1).alias("start"), F.least(F.col("length"), F.col("end") + n).cast("long").alias("end"))
    return before.unionByName(after).where(F.col("start") <= F.col("end"))


def cut_flank(flank: DataFrame, cuts: Sequence[int]) -> DataFrame:
    """One row per cut: the part of a flank within the first ``cut`` bases from the transcript."""
    f = flank.withColumn("cut", F.explode(F.array(*[F.lit(c).cast("long") for c in cuts])))
    left = (F.col("side") == "up") == (F.col("strand") != "-")  # the flank lies left of the transcript
    return f.withColumns(
        {"start": F.when(left, F.greatest("start", F.col("end") - F.col("cut") + 1)).otherwise(F.col("start")), "end": F.when(left, F.col("end")).otherwise(F.least("end", F.col("start") + F.col("cut") - 1))}
    )


def tss_table(tr: DataFrame, wide: int = 1) -> DataFrame:
    """One interval around each transcript's start site."""
    p = F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start"))
    return tr.select("gene", "tr", "chrom", "strand", F.greatest(F.lit(1), p - wide).cast("long").alias("start"), (p + wide).cast("long").alias("end"))


def site_rows(structure: DataFrame) -> DataFrame:
    """(tr_type, site, chrom, pos, tr): start sites, polyA sites and splice sites of each transcript's exons."""
    minus = F.col("strand") == "-"
    head, tail = F.when(minus, F.col("end")).otherwise(F.col("start")), F.when(minus, F.col("start")).otherwise(F.col("end"))
    t = F.col("exon_type")
    site = lambda name, on, pos: F.when(on, F.struct(F.lit(name).alias("site"), pos.alias("pos")))
    sites = F.array_compact(
        F.array(site("TSS", t.isin("FIRST", "SINGLE"), head), site("polyA", t.isin("LAST", "SINGLE"), tail), site("5SPL", t.isin("FIRST", "MIDDLE"), tail), site("3SPL", t.isin("LAST", "MIDDLE"), head))
    )
    return structure.withColumn("_s", F.explode(sites)).select("tr_type", F.col("_s.site").alias("site"), "chrom", F.col("_s.pos").alias("pos"), "tr")


def distinct_sites(structure: DataFrame) -> DataFrame:
    """(tr_type, site, n): distinct TSS, polyA, 5SPL, 3SPL positions, and transcripts, per transcript type."""
    sites = site_rows(structure).groupBy("tr_type", "site").agg(F.countDistinct("chrom", "pos").alias("n"))
    return sites.union(structure.groupBy("tr_type").agg(F.countDistinct("tr").alias("n")).select("tr_type", F.lit("transcripts"), "n"))


def transcript_index(exons: DataFrame, coding: DataFrame) -> DataFrame:
    """(gene, tr, n_exons, is_mrna): the transcripts of a gene and whether they have a CDS."""
    n = exons.groupBy("gene", "tr").agg(F.count(F.lit(1)).alias("n_exons"))
    c = coding.select("tr").distinct().withColumn("_c", F.lit(True))
    return n.join(c, "tr", "left").select("gene", "tr", "n_exons", F.coalesce("_c", F.lit(False)).alias("is_mrna"))


def seeded_key(id_col: Column, round_col: Column, seed: int) -> Column:
    """A reproducible pseudo-random key of an id and a round, in plain integer arithmetic.

    Only the id's remainder counts, so it is taken first: products stay within 64 bits whatever the id.
    """
    x = F.pmod(F.pmod(id_col.cast("long"), F.lit(2147483648).cast("long")) * F.lit(1103515245).cast("long") + round_col * F.lit(12345).cast("long") + seed, F.lit(2147483648).cast("long"))
    return F.pmod(x * (F.pmod(x, F.lit(65521)) + round_col + 1), F.lit(2147483647).cast("long"))


def pick_transcript(index: DataFrame, rounds: int, seed: int = 1) -> DataFrame:
    """One transcript per gene and round, drawn by the seeded key: (round, gene, tr, n_exons).

    Rounds are made from genes that hold their transcripts, so what is sorted or sent does not grow with the rounds.
    The number of partitions is given, as the rows before the rounds are too few for all tasks to have some.
    """
    spark = index.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    genes = index.select("gene", "tr", F.col("n_exons").alias("n")).repartition(parts, "gene").groupBy("gene").agg(F.collect_list(F.struct("tr", "n")).alias("_all"))
    r = genes.withColumn("round", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(rounds).cast("long"))))
    drawn = F.array_min(F.transform("_all", lambda x: F.struct(seeded_key(x["tr"], F.col("round"), seed).alias("key"), x["tr"].alias("tr"), x["n"].alias("n"))))
    return r.select("round", "gene", drawn.alias("_d")).select("round", "gene", "_d.tr", F.col("_d.n").alias("n_exons"))


def split_coding(df: DataFrame, type_col: str = "tr_type") -> DataFrame:
    """Add feature_class: coding for protein_coding types, else noncoding."""
    return df.withColumn("feature_class", F.when(F.coalesce(F.col(type_col), F.lit("")).rlike("protein_coding"), "coding").otherwise("noncoding"))


def exon_ids(exons: DataFrame, tr_type: str = "tr_type", gene_type: str = "gene_type") -> DataFrame:
    """Add exon_id gene#tr#chrom:start-end; the type falls back to the gene's; exons under 2 nt are left out."""
    where = F.concat(F.col("chrom"), F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    out = exons.where(_length() >= 2).withColumn("exon_id", F.concat_ws("#", F.col("gene").cast("string"), F.col("tr").cast("string"), where))
    return out.withColumn(tr_type, F.coalesce(tr_type, gene_type)) if gene_type in exons.columns else out


def order_transcripts(tr: DataFrame) -> DataFrame:
    """Add tr_no within the gene: by 5' start on the strand, longest first."""
    five = F.when(F.col("strand") == "-", -F.col("end")).otherwise(F.col("start"))
    w = Window.partitionBy("gene").orderBy(five, F.desc(_length()), "tr")
    return tr.withColumn("tr_no", F.row_number().over(w).cast("long"))


def mrna_metrics(exons: DataFrame, cds: DataFrame) -> DataFrame:
    """(tr, mature_len, cds_start, cds_end, cds_len, protein_len); start and end in reading direction, protein length without the stop codon."""
    m = exons.groupBy("tr").agg(F.sum(_length()).cast("long").alias("mature_len"))
    minus = F.min("strand") == "-"
    c = cds.groupBy("tr").agg(F.when(minus, F.max("end")).otherwise(F.min("start")).alias("cds_start"), F.when(minus, F.min("start")).otherwise(F.max("end")).alias("cds_end"), F.sum(_length()).cast("long").alias("cds_len"))
    return m.join(c, "tr").withColumn("protein_len", F.floor(F.col("cds_len") / 3) - 1)


def transcript_pairs(exons: DataFrame) -> DataFrame:
    """(gene, tr_a, tr_b) of the transcripts of each gene, each pair once."""
    t = exons.select("gene", "tr").distinct()
    a, b = t.select("gene", F.col("tr").alias("tr_a")), t.select("gene", F.col("tr").alias("tr_b"))
    return a.join(b, "gene").where("tr_a < tr_b")


def aed(pairs: DataFrame, exons: DataFrame) -> DataFrame:
    """Annotation edit distance of transcript pairs, 1 - (sn + sp) / 2 on exon bases: (gene, tr_a, tr_b, aed)."""
    m = merge_intervals(exons, ["tr", "chrom"]).select("tr", "chrom", "start", "end")
    size = m.groupBy("tr").agg(F.sum(_length()).cast("long").alias("bases"))
    x = pairs.join(m.withColumnRenamed("tr", "tr_a"), "tr_a")
    y = pairs.select("tr_a", "tr_b").join(m.withColumnRenamed("tr", "tr_b"), "tr_b")
    both = overlap_join(x, y, keys=("chrom", "tr_a", "tr_b"))
    shared = both.groupBy(F.col("a_tr_a").alias("tr_a"), F.col("a_tr_b").alias("tr_b")).agg(F.sum("overlap").alias("shared"))
    j = pairs.join(shared, ["tr_a", "tr_b"], "left").fillna(0, ["shared"])
    j = j.join(size.select(F.col("tr").alias("tr_a"), F.col("bases").alias("na")), "tr_a").join(size.select(F.col("tr").alias("tr_b"), F.col("bases").alias("nb")), "tr_b")
    return j.select("gene", "tr_a", "tr_b", (1 - (F.col("shared") / F.col("na") + F.col("shared") / F.col("nb")) / 2).alias("aed"))


def gene_aed(exons: DataFrame) -> DataFrame:
    """aed of all transcript_pairs: (gene, tr_a, tr_b, aed). Transcripts travel by gene with their exons, pairs do not travel."""
    m = merge_intervals(exons, ["tr", "chrom"])
    own = m.groupBy("tr").agg(F.collect_list(F.struct("chrom", "start", "end")).alias("_e"), F.sum(_length()).cast("long").alias("_n"))
    t = exons.select("gene", "tr").distinct().join(own, "tr")
    a, b = (t.select("gene", *[F.col(c).alias(f"{c}_{k}") for c in ("tr", "_e", "_n")]) for k in "ab")
    common = lambda x, y: F.when(x["chrom"] == y["chrom"], F.greatest(F.least(x["end"], y["end"]) - F.greatest(x["start"], y["start"]) + 1, F.lit(0))).otherwise(0).cast("long")
    shared = F.aggregate("_e_a", F.lit(0).cast("long"), lambda n, x: F.aggregate("_e_b", n, lambda k, y: k + common(x, y)))
    j = a.join(b, "gene").where("tr_a < tr_b").select("gene", "tr_a", "tr_b", "_n_a", "_n_b", shared.alias("_s"))
    return j.select("gene", "tr_a", "tr_b", (1 - (F.col("_s") / F.col("_n_a") + F.col("_s") / F.col("_n_b")) / 2).alias("aed"))


def splice_complexity(exons: DataFrame) -> DataFrame:
    """(gene, complexity): mean edit distance of a gene's transcript pairs, null with fewer than two transcripts.

    The mean is linear in the shared bases, so no pair is made: where c transcripts of a gene have exons, a base adds
    (c - 1) / own bases for each of them. The gene's exons are cut at all their ends; running sums of the
    transcripts that begin and end there give c and the sum of 1 / own bases on each segment.
    """
    m = merge_intervals(exons, ["gene", "tr", "chrom"]).select("gene", "tr", "chrom", "start", "end")
    own = m.groupBy("gene", "tr").agg(F.sum(_length()).alias("_bases"))
    ends = F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("d")), F.struct((F.col("end") + 1).alias("pos"), F.lit(-1).alias("d")))
    change = m.join(own, ["gene", "tr"]).select("gene", "chrom", F.explode(ends).alias("x"), (1 / F.col("_bases")).alias("w"))
    change = change.groupBy("gene", "chrom", F.col("x.pos").alias("pos")).agg(F.sum("x.d").alias("d"), F.sum(F.col("x.d") * F.col("w")).alias("w"))
    w = Window.partitionBy("gene", "chrom").orderBy("pos")
    seg = change.select("gene", (F.lead("pos").over(w) - F.col("pos")).alias("n"), F.sum("d").over(w).alias("c"), F.sum("w").over(w).alias("s"))
    shared = seg.where("c > 1").groupBy("gene").agg(F.sum(F.col("n") * (F.col("c") - 1) * F.col("s")).alias("_shared"))
    t = own.groupBy("gene").agg(F.count(F.lit(1)).alias("_t"))
    mean = 1 - F.coalesce("_shared", F.lit(0.0)) / (F.col("_t") * (F.col("_t") - 1))
    return t.join(shared, "gene", "left").select("gene", F.when(F.col("_t") > 1, mean).alias("complexity"))


def with_offsets(parts: DataFrame, key: str = "tr") -> DataFrame:
    """Add ``before``: bases of the parts (exons or CDS) that come earlier in reading direction."""
    w = Window.partitionBy(key).orderBy(F.when(F.col("strand") == "-", -F.col("end")).otherwise(F.col("start"))).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("before", F.coalesce(F.sum(_length()).over(w), F.lit(0)).cast("long"))


def map_positions(points: DataFrame, parts: DataFrame, to_col: str = "mapped") -> DataFrame:
    """Genome position to 1-based position in the spliced parts of each transcript that holds it.

    ``points`` has chrom and pos; the result adds tr and ``to_col``. Points meet parts in the binned join.
    """
    o = with_offsets(parts).select("chrom", "start", "end", "tr", "strand", "before")
    p = points.withColumns({"start": F.col("pos"), "end": F.col("pos")})
    j = overlap_join(p, o)
    at = F.when(F.col("b_strand") == "-", F.col("b_end") - F.col("a_pos")).otherwise(F.col("a_pos") - F.col("b_start")) + 1 + F.col("b_before")
    return j.select(*[F.col("a_" + c).alias(c) for c in points.columns], F.col("b_tr").alias("tr"), at.cast("long").alias(to_col))


def map_to_genome(points: DataFrame, parts: DataFrame) -> DataFrame:
    """Position in the spliced parts (tr, at) back to the genome: adds chrom, pos."""
    o = with_offsets(parts).select(F.col("tr").alias("_t"), "chrom", "strand", "start", "end", "before")
    inside = (F.col("tr") == F.col("_t")) & (F.col("at") > F.col("before")) & (F.col("at") <= F.col("before") + _length())
    step = F.col("at") - F.col("before") - 1
    pos = F.when(F.col("strand") == "-", F.col("end") - step).otherwise(F.col("start") + step)
    return points.join(o, inside).select(*points.columns, "chrom", pos.cast("long").alias("pos"))


def to_protein(cds_pos: Column) -> Column:
    """Amino-acid number of a 1-based CDS position."""
    return F.floor((cds_pos - 1) / 3) + 1


def frame_at(points: DataFrame, cds: DataFrame) -> DataFrame:
    """Adds tr, cds_pos, phase (0, 1, 2: place in the codon), and the codon's number and first CDS position."""
    m = map_positions(points, cds, "cds_pos")
    return m.withColumns({"phase": F.pmod(F.col("cds_pos") - 1, F.lit(3)), "codon_no": to_protein(F.col("cds_pos")), "codon_start": F.col("cds_pos") - F.pmod(F.col("cds_pos") - 1, F.lit(3))})


def filter_intragenic(tr: DataFrame, min_len: int = 200) -> DataFrame:
    """Everything non-coding that is no lincRNA and longer than ``min_len``."""
    return tr.where(~F.col("tr_type").rlike("protein_coding|lincRNA") & (F.col("mature_len") > min_len))

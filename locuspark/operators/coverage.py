"""Consensus coverage: lift overlaps to repeat consensus coordinates and count depth per base."""

from __future__ import annotations

import functools

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuspark.operators.classify import punctual
from locuspark.storage import checkpoint

#: Categories whose place is one base (fixed values).
SITES = ("TSS", "polyA", "5SPL", "3SPL")


def consensus_coords(te: DataFrame) -> DataFrame:
    """rep_start, rep_end, rep_left from the three raw columns r11, r12, r13, by strand; brackets stripped."""
    num = lambda c: F.regexp_replace(c, "[()]", "").cast("long")
    minus = F.col("strand").isin("-", "C")
    return te.withColumns({"rep_start": F.when(minus, num("r13")).otherwise(num("r11")), "rep_end": num("r12"), "rep_left": F.when(minus, num("r11")).otherwise(num("r13"))})


def lift_to_consensus(j: DataFrame, force: str | None = None) -> DataFrame:
    """Add con_start, con_end and con_left of the overlapping piece (o_st, o_en) in the repeat's consensus.

    Each end moves by its own distance from the fragment's end on its side, so that a
    fragment with insertions or deletions keeps both anchors. ``force`` Rstart or Rend
    counts both ends from that one anchor. An end that is not cut stays. Swapped if reversed.
    """
    plus = F.col("te_strand") == "+"
    low, high = F.col("o_st") - F.col("te_st"), F.col("te_en") - F.col("o_en")  # cut off on either side
    head, tail = F.when(plus, low).otherwise(high), F.when(plus, high).otherwise(low)  # before and after, in consensus order
    length = F.col("te_en") - F.col("te_st")
    start, end = F.col("rep_start") + head, F.col("rep_end") - tail
    if force == "Rstart":
        end = F.when(tail > 0, F.col("rep_start") + length - tail).otherwise(F.col("rep_end"))
    elif force == "Rend":
        start = F.when(head > 0, F.col("rep_end") - length + head).otherwise(F.col("rep_start"))
    left = F.col("rep_left") + F.col("rep_end") - F.greatest(start, end)
    return j.withColumns({"con_start": F.least(start, end), "con_end": F.greatest(start, end), "con_left": left})


def consensus_lengths(cov: DataFrame, by: Sequence[str] = ("rname",)) -> DataFrame:
    """(*by, length): the most frequent reconstructed length (end + left), the largest of ties."""
    n = cov.select(*by, (F.col("rep_end") + F.col("rep_left")).alias("length")).groupBy(*by, "length").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*by).agg(F.max(F.struct("n", "length"))["length"].alias("length"))


def length_lists(cov: DataFrame) -> DataFrame:
    """(rname, lengths): all reconstructed lengths, ascending."""
    return cov.groupBy("rname").agg(F.array_sort(F.collect_set(F.col("rep_end") + F.col("rep_left"))).alias("lengths"))


def filter_coverage(cov: DataFrame, min_fragments: int = 1, min_length: int = 1, max_deviation: int | None = None, by: Sequence[str] = ("rname",)) -> DataFrame:
    """Keep repeats with enough fragments and a long enough consensus; drop fragments whose length deviates more."""
    by = list(by)
    lengths = consensus_lengths(cov, by).where(F.col("length") >= min_length)
    out = cov.join(lengths.withColumnRenamed("length", "con_length"), by)
    if max_deviation is not None:
        out = out.where(F.abs(F.col("rep_end") + F.col("rep_left") - F.col("con_length")) <= max_deviation)
    enough = out.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_fragments)
    return out.join(enough, by, "left_semi")


def depth_per_base(cov: DataFrame, lengths: DataFrame, by: Sequence[str] = ("rname",)) -> DataFrame:
    """(*by, pos, depth) for positions 1..length, zeros kept.

    Starts and ends become +1 and -1 events, summed per position first; no interval is
    expanded. The running sum is per repeat, over at most its consensus' positions.
    """
    by = list(by)
    c = cov.join(lengths, by).select(*by, F.greatest("con_start", F.lit(1)).alias("s"), F.least("con_end", "length").alias("e")).where("s <= e")
    ev = c.select(*by, F.explode(F.array(F.struct(F.col("s").alias("pos"), F.lit(1).alias("d")), F.struct((F.col("e") + 1).alias("pos"), F.lit(-1).alias("d")))).alias("x"))
    change = ev.groupBy(*by, F.col("x.pos").alias("pos")).agg(F.sum("x.d").alias("d"))
    spine = lengths.select(*by, F.explode(F.sequence(F.lit(1).cast("long"), F.col("length"))).alias("pos"))
    w = Window.partitionBy(*by).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return spine.join(change, [*by, "pos"], "left").select(*by, "pos", F.coalesce(F.sum("d").over(w), F.lit(0)).cast("long").alias("depth"))


def coverage_wide(depth: DataFrame, names: Sequence[str]) -> DataFrame:
    """(pos, one column per repeat), zero filled."""
    return depth.where(F.col("rname").isin(list(names))).groupBy("pos").pivot("rname", list(names)).agg(F.max("depth")).fillna(0)


def with_consensus(hits: DataFrame, te: DataFrame) -> DataFrame:
    """Each hit with its repeat's consensus columns, by name, chromosome, place and block; a stub (1..length) if it has none.

    The hits, few beside the repeats, are written; repeats cross the network once, and those without a hit go before
    equal ones are dropped.
    """
    hits = checkpoint(hits)
    t = te.select(F.col("rname").alias("_n"), F.col("chrom").alias("_c"), F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("block").alias("_b"), "rep_start", "rep_end", "rep_left")
    on = (F.col("rname") == F.col("_n")) & (F.col("chrom") == F.col("_c")) & (F.col("te_st") == F.col("_s")) & (F.col("te_en") == F.col("_e")) & F.col("block").eqNullSafe(F.col("_b"))
    t = t.join(hits.select("rname", "chrom", "te_st", "te_en", "block"), on, "left_semi").dropDuplicates(["_n", "_c", "_s", "_e", "_b"])
    j = hits.join(t, on, "left")
    n = F.col("te_en") - F.col("te_st") + 1
    return j.withColumns({"rep_start": F.coalesce("rep_start", F.lit(1)), "rep_end": F.coalesce("rep_end", n), "rep_left": F.coalesce("rep_left", F.lit(0))}).drop("_n", "_c", "_s", "_e", "_b")


def category_places(rows: DataFrame, category: str, order: Sequence[str] = ("te_st", "te_en", "te_id")) -> DataFrame:
    """Hits of transcripts with a category, each reduced to the category's place (st, en), counted once.

    A hit takes part if its category contains ``category``; ``exonized`` takes all, with the whole exon. TSS, polyA,
    5SPL and 3SPL are one base each, by the transcript's strand. Of the hits that share place, strand, category and
    repeat name the first in ``order`` stays, so that a place counts once however many transcripts or pieces have it.
    """
    if category != "exonized":
        rows = rows.where(F.col("category").contains(category))
    if category in SITES:
        rows = punctual(rows, category)
    first = Window.partitionBy("chrom", "st", "en", "strand", "category", "rname").orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")


def consensus_pieces(hits: DataFrame | None, te: DataFrame, kind: str = "TEjoin", category: str = "exonized", force: str | None = None) -> DataFrame:
    """(rname, con_start, con_end, rep_end, rep_left): what each fragment or hit covers of its consensus.

    ``RMout`` takes the fragments of ``te`` as they are, ``TEjoin`` the overlapping pieces of hits with any features,
    ``TrInfos`` hits of transcripts with their category, at the category's place. Places outside their repeat go.
    """
    cols = ["rname", "con_start", "con_end", "rep_end", "rep_left"]
    if kind == "RMout":
        return te.withColumns({"con_start": F.least("rep_start", "rep_end"), "con_end": F.greatest("rep_start", "rep_end")}).select(*cols)
    if kind not in ("TEjoin", "TrInfos"):
        raise ValueError(f"kind is RMout, TEjoin or TrInfos, not {kind}")
    rows = category_places(hits, category) if kind == "TrInfos" else hits
    return _lifted_pieces(with_consensus(rows, te), force).select(*cols)


def _lifted_pieces(j: DataFrame, force: str | None = None) -> DataFrame:
    """Overlapping pieces of hits with their consensus columns, lifted; places outside their repeat go."""
    return lift_to_consensus(j.withColumns({"o_st": F.greatest("te_st", "st"), "o_en": F.least("te_en", "en")}).where("o_st <= o_en"), force)


def consensus_coverage(
    hits: DataFrame | None,
    te: DataFrame,
    min_fragments: int = 1,
    min_length: int = 1,
    max_deviation: int | None = None,
    force: str | None = None,
    kind: str = "TEjoin",
    category: str = "exonized",
) -> DataFrame:
    """The whole job: fragments or hits to depth per consensus base, (rname, pos, depth); kinds and categories as in consensus_pieces."""
    lifted = checkpoint(consensus_pieces(hits, te, kind, category, force))  # read by lengths, filters and depths
    cov = filter_coverage(lifted, min_fragments, min_length, max_deviation)
    return depth_per_base(cov, consensus_lengths(cov))


def coverage_by_category(
    hits: DataFrame, te: DataFrame, categories: Sequence[str] = ("exonized", *SITES), min_fragments: int = 1, min_length: int = 1, max_deviation: int | None = None, force: str | None = None
) -> DataFrame:
    """(site, rname, pos, depth): as consensus_coverage of kind ``TrInfos`` for each category, in one job.

    A hit's consensus does not depend on the category, so hits meet the repeats once; lengths, filters and depths are per category.
    """
    cols, by = ["rname", "con_start", "con_end", "rep_end", "rep_left"], ["site", "rname"]
    known = checkpoint(with_consensus(hits, te))  # a row per hit, read by each category
    each = [_lifted_pieces(category_places(known, c), force).select(F.lit(c).alias("site"), *cols) for c in categories]
    lifted = checkpoint(functools.reduce(DataFrame.unionByName, each))
    cov = filter_coverage(lifted, min_fragments, min_length, max_deviation, by)
    return depth_per_base(cov, consensus_lengths(cov, by), by)

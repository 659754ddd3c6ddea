"""Randomised placements of repeats: all rounds are rows of one job, drawn by a reproducible key."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.operators.intervals import contained_in, interval_complement, interval_intersection, merge_intervals, nearest, overlap_join, running_max
from locuspark.operators.passing import MULTIPLIER, PRIME, STEPS, TOP, Apart, ByPlace, Gaps, Tolerant, apart_draws, draws, held_rows, pass_by, permuted, permuted_places, tolerant_draws  # noqa: F401
from locuspark.storage import checkpoint, if_small, ordinals


def _rounds(df: DataFrame, rounds: int, first: int = 1) -> DataFrame:
    return df.withColumn("round", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(first + rounds - 1).cast("long"))))


def inside(start: Column, end: Column, length: Column) -> tuple[Column, Column]:
    """Shift an interval into 1..length."""
    shift = F.when(start < 1, 1 - start).when(end > length, F.greatest(length - end, 1 - start)).otherwise(0)
    return start + shift, F.least(end + shift, length)


def permutation(seed: int, back: bool = False) -> Callable[[Column, Column, Column], Column]:
    """A function of place, number of places and round (columns) to the place that the round's permutation gives it.

    ``back`` gives the place that the permutation takes there: the same steps from the last to the first.

    A keyed bijection of 0..n-1: the places are rotated, then each step mirrors them about a point of the key and
    swaps those pairs for which a bit of the key and the pair says so. A mirror is its own inverse and both of a
    pair see the same bit, so no place is given twice, whatever n; nothing is sorted or kept. n is under 2^32.
    """

    @F.pandas_udf("long")
    def place(i: pd.Series, n: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series(permuted(i.to_numpy(np.int64), n.to_numpy(np.int64), r.to_numpy(np.int64), seed, back))

    return place


def _dealt(df: DataFrame, by: Sequence[str], bucket: Column, value: Column) -> DataFrame:
    """Add _bucket, _value and _carry: the sum of ``value`` in the buckets of equal ``by`` before the row's own."""
    marked = df.withColumns({"_bucket": bucket, "_value": value})
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = marked.groupBy(*by, "_bucket").agg(F.sum("_value").alias("_c")).select(*by, "_bucket", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_carry"))
    return marked.join(carried, [*by, "_bucket"])


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], bucket: Column, value: Column) -> DataFrame:
    """Add _before: the sum of ``value`` over the rows of equal ``by`` that come before, bucket by bucket."""
    inner = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_value").over(inner), F.lit(0)) + F.col("_carry")
    return _dealt(df, by, bucket, value).withColumn("_before", before).drop("_bucket", "_value", "_carry")


def shuffle_positions(
    te: DataFrame, sizes: DataFrame, rounds: int, seed: int = 1, first: int = 1, keep: Sequence[str] | None = None, near: DataFrame | None = None, as_they_are: bool = False
) -> DataFrame:
    """Permute midpoints among the repeats of each chromosome; lengths stay: te's columns (or ``keep``) with new start, end, and round.

    The repeats are put in the order of their ids once; a round's permutation then gives each one the midpoint at
    another place of its chromosome by arithmetic, so no round is sorted. ``te_id`` may be of any type.
    With ``near`` (chrom, start, end) only placements close to one of these intervals come back, among them every one
    that shares a position with any: where hits are counted the others need not be made. ``as_they_are`` adds the
    repeats close to ``near`` where they stand, with a null round, from the same pass over the places.
    """
    keep = [c for c in te.columns if keep is None or c in keep]
    sizes = checkpoint(sizes.select("chrom", "length"))  # a row per chromosome
    sizes = if_small(sizes, sizes.count())
    if near is not None:
        return _placed_near(te, sizes, keep, near, rounds, seed, first, as_they_are)
    base = ordinals(te.join(sizes, "chrom").select(*{*keep, "chrom", "te_id", "start", "end"}, "length"), ["chrom"], ["te_id"])
    # what travels in every round is a repeat's id, its length and other columns that are kept; the place brings the rest
    other = [c for c in keep if c not in ("chrom", "te_id", "start", "end")]
    s = F.col("_mid") - F.floor(F.col("_span") / 2)
    a, b = inside(s, s + F.col("_span"), F.col("length"))
    mid = F.floor((F.col("start") + F.col("end")) / 2).cast("long")
    held = base.select("chrom", F.col("_i").cast("long").alias("g"), mid.alias("_mid"))
    if (rows := held_rows(held, 3)) is not None:
        items = base.select("chrom", F.col("_i").cast("long").alias("_i"), F.col("_n").cast("long").alias("_n"), "te_id", (F.col("end") - F.col("start")).cast("long").alias("_span"), *other)
        out = pass_by(items, held, rows, ByPlace, permuted_places(rounds, first, seed), "round long, _mid long").join(sizes, "chrom")
        return out.withColumns({"start": a, "end": b}).select(*keep, "round")
    base, at = _numbered(base, ["chrom"])
    drawn = _rounds(base.select("_g0", "_i", "_n", "te_id", (F.col("end") - F.col("start")).alias("_span"), *other), rounds, first)
    drawn = drawn.select((F.col("_g0") + permutation(seed)("_i", "_n", "round")).alias("_g"), F.col("round").cast("int").alias("round"), "te_id", F.col("_span").cast("long"), *other)
    places = at.select("_g", "chrom", "length", mid.alias("_mid"))
    out = drawn.join(if_small(places, places.count()), "_g").withColumns({"start": a, "end": b, "round": F.col("round").cast("long")})
    return out.select(*keep, "round")


def _numbered(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinals with _g0, how many rows the groups before theirs hold, and the same rows with _g: places over all groups in one number."""
    sizes = df.where("_i = 0").select(*by, "_n")  # a row per group
    before = Window.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(*by, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_g0"))
    rows = df.join(if_small(first, first.count()), list(by))
    return rows, rows.withColumn("_g", F.col("_g0") + F.col("_i"))


#: Kinds of repeats (distinct values of the columns besides place and id) up to which a number stands for them.
MOST_KINDS = 100_000


def _by_kind(te: DataFrame, other: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """te with _kind, a number in place of its ``other`` columns, and what they are; te as it is and None where kinds are many."""
    kinds = te.select(*other).distinct()
    if not other or kinds.limit(MOST_KINDS + 1).count() > MOST_KINDS:
        return te, None
    kinds = F.broadcast(checkpoint(kinds.withColumn("_kind", F.monotonically_increasing_id())))
    named = kinds.select(*[F.col(c).alias(f"_k_{c}") for c in other], "_kind")
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in other]
    return te.join(named, on).drop(*[f"_k_{c}" for c in other], *other), kinds


def _placed_near(te: DataFrame, sizes: DataFrame, keep: list[str], near: DataFrame, rounds: int, seed: int, first: int, as_they_are: bool) -> DataFrame:
    """keep and round of the placements that can touch ``near``; ``as_they_are`` the repeats that can, too, with a null round.

    A placement holds its midpoint (moved into the chromosome) and so ends within its length of it. Places farther
    than the reach of usual repeats from every interval are left out before the rounds are made; those left ask the
    permutation backwards which repeat they get. Repeats longer than that reach, which are few, are drawn forwards.
    What all repeats carry through sorting, filter and join is a number per kind, and an id only if it is kept.
    """
    other = [c for c in keep if c not in ("chrom", "te_id", "start", "end")]
    coded, kinds = _by_kind(te, other)
    more = other if kinds is None else ["_kind"]
    mine = [*(["te_id"] if "te_id" in keep else []), *more]
    base = ordinals(coded.select("chrom", "te_id", "start", "end", *more).join(sizes.select("chrom"), "chrom"), ["chrom"], ["te_id"])
    base = base.withColumn("_span", F.col("end") - F.col("start"))
    most, usual = base.agg(F.max("_span"), F.percentile_approx("_span", 0.99)).first()
    reach = 0 if most is None else min(most, 4 * usual)
    wide = merge_intervals(near.select("chrom", (F.col("start") - reach).alias("start"), (F.col("end") + reach).alias("end")))
    mid = F.floor((F.col("start") + F.col("end")) / 2)
    own = base.select("chrom", F.col("_i").alias("_j"), "_n", "_span", mid.alias("_mid"), *(mine if as_they_are else [])).join(sizes, "chrom")
    at = F.greatest(F.lit(1), F.least("_mid", "length")).cast("long")
    inner = own.where(F.col("_mid") == at).drop("length").withColumns({"start": F.col("_mid"), "end": F.col("_mid")})
    # midpoints outside of their chromosome are few and stay
    places = contained_in(inner, wide).drop("start", "end").unionByName(own.where(F.col("_mid") != at).drop("length"))
    places = checkpoint(places)
    asked = _rounds(places.select("chrom", "_n", "_j", "_mid"), rounds, first).select("chrom", "round", "_mid", permutation(seed, back=True)("_j", "_n", "round").alias("_i"))
    drawn = base.where(F.col("_span") <= reach).select("chrom", "_i", "_span", *mine).join(asked, ["chrom", "_i"]).drop("_i")
    long = base.where(F.col("_span") > reach) if most is not None and most > reach else None
    if long is not None:
        mids = base.select("chrom", F.col("_i").alias("_j"), mid.alias("_mid"))
        far = _rounds(long.select("chrom", "_i", "_n", "_span", *mine), rounds, first).withColumn("_j", permutation(seed)("_i", "_n", "round"))
        drawn = drawn.unionByName(if_small(far, long.count() * rounds).join(mids, ["chrom", "_j"]).select(drawn.columns))
    s = F.col("_mid") - F.floor(F.col("_span") / 2)
    a, b = inside(s, s + F.col("_span"), F.col("length"))
    out = drawn.join(sizes, "chrom").withColumns({"start": a, "end": b}).select("chrom", "start", "end", *mine, "round")
    if as_they_are:
        start = F.col("_mid") - F.floor(F.col("_span") / 2)  # a repeat's own one, as its midpoint is rounded down
        alone = places.where(F.col("_span") <= reach).select("chrom", start.alias("start"), (start + F.col("_span")).alias("end"), *mine)
        if long is not None:
            alone = alone.unionByName(long.select("chrom", "start", "end", *mine))
        homeless = coded.join(sizes.select("chrom"), "chrom", "left_anti").select("chrom", "start", "end", *mine)  # their chromosome has no length
        out = out.unionByName(alone.unionByName(homeless).withColumn("round", F.lit(None).cast("long")))
    return (out if kinds is None else out.join(kinds, "_kind")).select(*keep, "round")


def shuffle_tss(te: DataFrame, tss: DataFrame, sizes: DataFrame, rounds: int, seed: int = 1, first: int = 1, keep: Sequence[str] | None = None) -> DataFrame:
    """Give each repeat a random start site of its chromosome and keep its signed distance and length: te's columns (or ``keep``) and round.

    ``tss`` has tss_id, chrom, strand, start = end. Sites are used again in turn when there
    are fewer than repeats. Out of the chromosome, a repeat goes to the site's other side, then is shifted in.
    """
    keep = [c for c in te.columns if keep is None or c in keep]
    other = [c for c in keep if c not in ("chrom", "te_id", "start", "end")]
    te = te.select(*{*keep, "chrom", "te_id", "start", "end"})
    d = nearest(te, tss, "te_id", "tss_id").select("te_id", "distance")
    ranked = ordinals(te.join(d, "te_id").join(sizes.select("chrom"), "chrom"), ["chrom"], ["te_id"]).withColumnRenamed("_n", "_all")
    sites = ordinals(tss.select("chrom", "tss_id", "start", "strand"), ["chrom"], ["tss_id"])
    lengths = sizes.select("chrom", "length")
    held = sites.select("chrom", F.col("_i").cast("long").alias("g"), F.col("start").cast("long").alias("_p"), F.coalesce((F.col("strand") == "+").cast("long"), F.lit(-1)).cast("long").alias("_plus"))
    if (rows := held_rows(held, 4)) is not None:
        items = ranked.select("chrom", F.col("_i").cast("long").alias("_i"), F.col("_all").cast("long").alias("_n"), "te_id", "distance", (F.col("end") - F.col("start")).cast("long").alias("_span"), *other)
        lengths = checkpoint(lengths)  # a row per chromosome
        j = pass_by(items, held, rows, ByPlace, permuted_places(rounds, first, seed), "round long, _p long, _plus long").join(if_small(lengths, lengths.count()), "chrom")
    else:
        sites, slots = _numbered(sites, ["chrom"])
        counts = sites.where("_i = 0").select("chrom", "_g0", "_n")
        slots = slots.join(lengths, "chrom").select("_g", "chrom", "length", F.col("start").alias("_p"), (F.col("strand") == "+").cast("long").alias("_plus"))
        # what travels in every round is a repeat's id, length and distance; the site brings its place and chromosome
        r = ranked.join(if_small(counts, counts.count()), "chrom").select("_g0", "_n", "_i", "_all", "te_id", "distance", (F.col("end") - F.col("start")).alias("_span"), *other)
        r = _rounds(r, rounds, first).withColumn("_g", F.col("_g0") + F.pmod(permutation(seed)("_i", "_all", "round"), "_n")).select("_g", F.col("round").cast("int").alias("round"), "te_id", "distance", "_span", *other)
        j = r.join(if_small(slots, slots.count()), "_g")
    span, gap = F.col("_span"), F.abs("distance")
    right = (F.col("distance") > 0) == F.when(F.col("_plus") >= 0, F.col("_plus") == 1)  # unknown where the strand is
    at = lambda on_right: F.when(on_right, F.col("_p") + gap).otherwise(F.col("_p") - gap - span)
    out = (at(right) < 1) | (at(right) + span > F.col("length"))
    s = F.when(F.col("distance") == 0, F.col("_p") - F.floor(span / 2)).when(out, at(~right)).otherwise(at(right))
    a, b = inside(F.col("_s0"), F.col("_s0") + span, F.col("length"))
    return j.withColumn("_s0", s).withColumns({"start": a, "end": b, "round": F.col("round").cast("long")}).select(*keep, "round")


def allowed_space(sizes: DataFrame, excl: DataFrame | None = None, incl: DataFrame | None = None) -> DataFrame:
    """Where repeats may go: each chromosome, or what is included, minus what is excluded."""
    whole = sizes.select("chrom", F.lit(1).cast("long").alias("start"), F.col("length").cast("long").alias("end"))
    space = interval_intersection(whole, incl) if incl is not None else whole
    if excl is not None:
        space = interval_intersection(space, interval_complement(excl, sizes))
    return space


#: Placements that one task draws at a time.
PLACEMENTS = 500_000


#: Gaps of one block, the share of a chromosome's gaps that one task looks draws up in.
GAP_BLOCK = 20_000


def _drawn(draws: pd.DataFrame, gaps: pd.DataFrame) -> pd.DataFrame:
    """The gap and start of each draw among the gaps of one block, in which it is known to lie.

    A repeat of end - start = span has n - span starts in a gap of n positions, hence _cum - _k span in the _k gaps
    before one: the gap that holds start number _u is found by bisection, for all draws at once.
    """
    gaps = gaps.sort_values("_k")
    at, k, cum = (gaps[c].to_numpy(np.int64) for c in ("start", "_k", "_cum"))
    span, u, fits = (draws[c].to_numpy(np.int64) for c in ("_span", "_u", "_fits"))
    if not len(draws):
        return draws[["chrom", "te_id", "round", "_span"]].assign(_gap=u, _new=u)
    lo, hi = np.zeros(len(u), np.int64), np.minimum(len(k), fits - k[0]) - 1
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        below = cum[mid] - k[mid] * span <= u
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid - 1)
    return draws[["chrom", "te_id", "round", "_span"]].assign(_gap=at[lo], _new=at[lo] + u - (cum[lo] - k[lo] * span))


def _draw_exact(items: DataFrame, gaps: DataFrame, by: Sequence[str], seed: int, block: int | None = None) -> DataFrame:
    """As _draw, where nothing excluded is tolerated.

    Gaps are numbered from the longest on, so those that a repeat fits in come first; with the lengths before each
    gap the number of starts follows from the span, and a drawn start's block of gaps from the blocks' first gaps.
    Only the draws of a block meet its gaps, so a gap is repeated per ``PLACEMENTS`` draws that fall into its block.
    """
    by, block = list(by), block or GAP_BLOCK
    n = (F.col("end") - F.col("start") + 1).cast("long")
    g = ordinals(gaps.select(*by, F.col("start").cast("long").alias("start"), n.alias("_len"), (-n).alias("_short")), by, ["_short", "start"]).withColumnRenamed("_i", "_k").drop("_n", "_short")
    g = running_sum(g, by, ["_k"], F.floor(F.col("_k") / block), F.col("_len")).withColumnsRenamed({"_before": "_cum"}).withColumn("_block", F.floor(F.col("_k") / block).cast("int"))
    g = checkpoint(g.select(*by, "start", "_len", "_k", F.col("_cum").cast("long").alias("_cum"), "_block"))
    longer = g.groupBy(*by, F.col("_len").alias("_pos")).agg(F.struct((F.max("_k") + 1).alias("fits"), F.max(F.col("_cum") + F.col("_len")).alias("total")).alias("_has")).withColumn("_kind", F.lit(1))
    asked = items.select(*by, F.col("_span").alias("_pos")).distinct().select(*by, "_pos", F.lit(None).cast("struct<fits:bigint,total:bigint>").alias("_has"), F.lit(0).alias("_kind"))
    room = running_max(longer.unionByName(asked), by, "_pos", "_has", [F.desc("_pos"), F.asc("_kind")], back=True).where("_kind = 0 AND _before IS NOT NULL")
    room = checkpoint(room.select(*by, F.col("_pos").alias("_span"), F.col("_before.fits").alias("_fits"), (F.col("_before.total") - F.col("_before.fits") * F.col("_pos")).alias("_room")))
    heads = g.groupBy(*by, "_block").agg(F.struct(F.min("_k").alias("k"), F.min("_cum").alias("c")).alias("_h")).groupBy(*by).agg(F.array_sort(F.collect_list("_h")).alias("_heads"))
    d = items.join(if_small(room, room.count()), [*by, "_span"]).join(F.broadcast(heads), by)  # a row per group, a pair of numbers per block
    d = d.withColumn("_u", F.pmod(F.xxhash64("te_id", "round", F.lit(seed)), F.col("_room")))
    d = d.withColumn("_block", F.size(F.filter("_heads", lambda h: (h["k"] < F.col("_fits")) & (h["c"] - h["k"] * F.col("_span") <= F.col("_u")))) - 1)
    parts = checkpoint(d.groupBy(*by, "_block").agg(F.ceil(F.count(F.lit(1)) / PLACEMENTS).cast("int").alias("_parts")))
    few = if_small(parts, parts.count())
    keys = [*by, "_block", "_part"]
    d = d.join(few, [*by, "_block"]).withColumn("_part", F.pmod(F.xxhash64("te_id", "round", F.lit("part")), F.col("_parts")).cast("int")).select(*{*keys, "chrom", "te_id", "round"}, "_span", "_u", "_fits")
    g = g.join(few, [*by, "_block"]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).select(*keys, "start", "_k", "_cum")
    shape = f"chrom string, te_id {dict(items.dtypes)['te_id']}, round long, _span long, _gap long, _new long"
    return d.groupBy(*keys).cogroup(g.groupBy(*keys)).applyInPandas(_drawn, shape)


def admissible_starts(regions: np.ndarray, excluded: np.ndarray, span: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs (first start, number) of the starts at which an interval of span + 1 positions lies in a region and shares at most ``most`` with what is excluded.

    Both are sorted disjoint intervals (rows of start and end). The shared length as a function of the start is
    linear, with slope -1, 0 or 1, between the places where either end of the interval enters or leaves something.
    """
    rs, re = regions.T
    es, ee = excluded.T
    before = np.r_[0, np.cumsum(ee - es + 1)]

    def covered(p: np.ndarray) -> np.ndarray:
        """Excluded positions up to p."""
        k = np.searchsorted(es, p, "right")
        inside = np.minimum(p, np.r_[0, ee][k]) - np.r_[0, es][k] + 1
        return np.where(k > 0, before[np.maximum(k - 1, 0)] + inside, 0)

    at = np.unique(np.concatenate([rs, re - span + 1, es, ee + 1, es - span, ee + 1 - span]))
    if len(at) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, n = at[:-1], np.diff(at)
    region = np.searchsorted(rs, at, "right") - 1
    fits = (region >= 0) & (at <= re[np.maximum(region, 0)] - span)
    at, n = at[fits], n[fits]
    shared = covered(at + span) - covered(at - 1)
    slope = np.where(n > 1, covered(at + 1 + span) - covered(at) - shared, 0)
    low = np.where(slope < 0, np.clip(shared - most, 0, n), np.where(shared <= most, 0, n))
    high = np.where(slope > 0, np.clip(most - shared + 1, 0, n), n)
    keep = high > low
    return (at + low)[keep], (high - low)[keep]


def _drawn_within(fraction: float) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The drawn start of each placement among all at which at most ``fraction`` of its positions are excluded."""

    def run(draws: pd.DataFrame, space: pd.DataFrame) -> pd.DataFrame:
        both = space[["start", "end", "_excluded"]].sort_values("start").to_numpy(np.int64)
        regions, excluded = both[both[:, 2] == 0, :2], both[both[:, 2] == 1, :2]
        out = []
        for span, rows in draws.groupby("_span"):
            at, n = admissible_starts(regions, excluded, int(span), math.floor(fraction * (int(span) + 1)))
            if not len(at):
                continue
            cum = np.cumsum(n)
            u = rows["_key"].to_numpy(np.int64) % cum[-1]
            k = np.searchsorted(cum, u, "right")
            new = at[k] + u - (cum[k] - n[k])
            out.append(rows[["chrom", "te_id", "round", "_span"]].assign(_gap=new, _new=new))
        return pd.concat(out) if out else draws[["chrom", "te_id", "round", "_span"]].head(0).assign(_gap=0, _new=0)

    return run


def _draw(items: DataFrame, gaps: DataFrame, by: Sequence[str], seed: int, fraction: float = 0.0) -> DataFrame:
    """(chrom, te_id, round, _span, _gap, _new): the drawn gap and start of each item that fits in a gap of equal ``by``.

    With a ``fraction``, ``gaps`` are regions and what is excluded of them (_excluded); tasks take a share of the
    placements (``PLACEMENTS``), dealt by length, and all of these; a length of many placements is cut.
    """
    if not fraction:
        return _draw_exact(items, gaps, by, seed)
    parts = items.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / PLACEMENTS).cast("int").alias("_parts"))
    gaps = gaps.select(*[F.col(c).alias(c) for c in gaps.columns])  # columns of their own beside the items
    spans = items.groupBy(*by, "_span").agg(F.count(F.lit(1)).alias("_k")).groupBy(*by).agg(F.ceil(F.max("_k") / PLACEMENTS).cast("int").alias("_cuts"))
    parts = parts.join(spans, [*by]).withColumn("_all", F.col("_parts") * F.col("_cuts"))
    which = F.pmod(F.xxhash64("_span"), F.col("_parts")) * F.col("_cuts") + F.pmod(F.xxhash64("te_id", "round", F.lit("part")), F.col("_cuts"))
    gaps = gaps.join(parts, [*by]).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_all") - 1))).select(*gaps.columns, "_part")
    draws = items.join(parts, [*by]).withColumn("_key", F.xxhash64("te_id", "round", F.lit(seed))).withColumn("_part", F.pmod(which, F.col("_all")).cast("int")).select(*items.columns, "_key", "_part")
    shape = f"chrom string, te_id {dict(items.dtypes)['te_id']}, round long, _span long, _gap long, _new long"
    return draws.groupBy(*by, "_part").cogroup(gaps.groupBy(*by, "_part")).applyInPandas(_drawn_within(fraction), shape)


#: Length of the bins that excluded intervals are kept by, where draws are checked.
CHECK_BIN = 4_096
#: Share of its draws that a turn has to place for the refused ones to draw again.
WORTH = 0.1


def _drawn_among_all(items: DataFrame, regions: DataFrame, seed: int) -> DataFrame:
    """As _draw, whatever is excluded of the regions; where each chromosome is one region a start follows by arithmetic."""
    if not regions.groupBy("chrom").count().where("count > 1").isEmpty():
        return _draw_exact(items, regions, ["chrom"], seed)
    room = F.col("end") - F.col("start") + 1 - F.col("_span")
    drawn = items.join(F.broadcast(regions.select("chrom", "start", "end")), "chrom").where(room > 0)
    new = (F.col("start") + F.pmod(F.xxhash64("te_id", "round", F.lit(seed)), room)).cast("long")
    return drawn.select("chrom", "te_id", "round", "_span", new.alias("_gap"), new.alias("_new"))


def _draw_tolerant(items: DataFrame, longest: int, usual: int, regions: DataFrame, bars: DataFrame, seed: int, fraction: float) -> DataFrame:
    """As _draw, where up to ``fraction`` of a placement's positions may be excluded ones (``bars``, disjoint).

    Each item draws among all starts of the regions; a draw meets only the bars of its bin, and those that share too
    much draw again. That leaves every admissible start equally likely. When under ``WORTH`` of the draws of a turn
    are placed, those left draw among the exact runs of admissible starts. ``longest`` and ``usual`` are spans.
    The refused of a turn are written, so all but
    the first turn are as small as what is excluded; the first one, which holds nearly all, is made anew instead.
    """
    regions, bars = checkpoint(regions), checkpoint(bars)
    reach = min(longest, 4 * usual)  # longer items are few and meet bars through the binned join
    size = max(CHECK_BIN, reach)
    first, last = F.floor((F.col("start") - reach) / size), F.floor(F.col("end") / size)
    # a bin's bars are those that a usual item with its start there can touch, cut to what it can touch
    cells = bars.withColumn("_bin", F.explode(F.sequence(first, last)))
    low, high = F.greatest("start", F.col("_bin") * size), F.least("end", (F.col("_bin") + 1) * size + reach)
    number = (F.row_number().over(Window.orderBy("chrom")) * F.lit(1 << 34)).alias("_c")  # a row per chromosome
    chroms = F.broadcast(checkpoint(regions.select("chrom").distinct().select("chrom", number)))
    cells = cells.join(chroms, "chrom").groupBy((F.col("_c") + F.col("_bin")).alias("_cell")).agg(F.collect_list(F.struct(low.alias("s"), high.alias("e"))).alias("_bars"))
    end = F.col("_new") + F.col("_span")
    part = lambda x: F.greatest(F.least(x["e"], end) - F.greatest(x["s"], F.col("_new")) + 1, F.lit(0))
    most = F.floor(F.lit(fraction) * (F.col("_span") + 1))

    def judged(drawn: DataFrame) -> DataFrame:
        """Draws with _ok: they share few enough positions with the bars."""
        usual = drawn.where(F.col("_span") <= reach).join(chroms, "chrom").withColumn("_cell", F.col("_c") + F.floor(F.col("_new") / size)).drop("_c").join(cells, "_cell", "left")
        shared = F.aggregate("_bars", F.lit(0).cast("long"), lambda n, x: n + part(x))
        usual = usual.withColumn("_ok", F.when(F.col("_bars").isNull(), True).otherwise(shared <= most)).drop("_cell", "_bars")
        if longest <= reach:
            return usual
        long = drawn.where(F.col("_span") > reach).withColumns({"start": F.col("_new"), "end": end})
        over = overlap_join(long, bars, bin_size=size, long_intervals=True).groupBy(F.col("a_te_id").alias("te_id"), F.col("a_round").alias("round")).agg(F.sum("overlap").alias("_shared"))
        long = long.join(over, ["te_id", "round"], "left").withColumn("_ok", F.coalesce("_shared", F.lit(0)) <= most)
        return usual.unionByName(long.select(usual.columns))

    left, placed, turn, before = items, None, 0, None
    while True:
        tried = judged(_drawn_among_all(left, regions, seed + turn))
        if turn:
            tried = checkpoint(tried)
        stay = tried.where("_ok").drop("_ok")
        placed = stay if placed is None else placed.unionByName(stay)
        left = checkpoint(tried.where("NOT _ok").select("chrom", "te_id", "round", "_span"))
        refused, turn = left.count(), turn + 1
        if not refused:
            return placed
        if before is not None and before - refused < WORTH * before:
            break
        before = refused
    space = regions.withColumn("_excluded", F.lit(0)).unionByName(bars.withColumn("_excluded", F.lit(1)))
    return placed.unionByName(_draw(left, space, ["chrom"], seed + turn, fraction))


#: Keys that put placements in order, and how many of them are one bucket.
PLACE_KEYS, PLACE_STEP = 1 << 40, 1 << 32


def _place_key(seed: int, turn: int) -> Column:
    return F.pmod(F.xxhash64("te_id", "round", F.lit(seed), F.lit(turn)), F.lit(PLACE_KEYS))


def _draw_apart(items: DataFrame, gaps: DataFrame, seed: int) -> DataFrame:
    """As _draw, without overlaps within a round.

    Each item draws a gap; in random order, those that the gap's room holds stay and the
    others draw again among the room that is left, until all have a gap or fit in none.
    Then the free positions of each gap are dealt at random between the items it holds: an
    item's place follows from its rank's share of them and the lengths before it. The first
    item of a gap always fits, so every turn places some of those left.
    """
    by = ["chrom", "round", "_gap"]
    order, bucket = ["_key", "te_id"], F.floor(F.col("_key") / PLACE_STEP)
    rounds = items.select("chrom", "round").distinct()
    whole = gaps.join(rounds, "chrom").select("chrom", "round", F.col("start").alias("_gap"), (F.col("end") - F.col("start") + 1).cast("long").alias("_room"))
    whole = checkpoint(whole)
    room, placed, turn = whole, None, 0
    while True:
        free = room.where("_room > 0").select("chrom", "round", F.col("_gap").alias("start"), (F.col("_gap") + F.col("_room") - 1).alias("end"))
        drawn = _draw(items, free, ["chrom", "round"], seed + turn).withColumns({"_length": F.col("_span") + 1, "_key": _place_key(seed, turn)})
        drawn = running_sum(drawn, by, order, bucket, F.col("_length")).join(room, by)
        drawn = checkpoint(drawn.select("te_id", *by, "_span", "_length", (F.col("_before") + F.col("_length") <= F.col("_room")).alias("_stays")))
        stay = drawn.where("_stays").drop("_stays")
        placed = stay if placed is None else placed.unionByName(stay)
        items = drawn.where("NOT _stays").select("chrom", "te_id", "round", "_span")
        if items.isEmpty():
            break
        used = stay.groupBy(*by).agg(F.sum("_length").alias("_used"))
        room = checkpoint(room.join(used, by, "left").select(*by, (F.col("_room") - F.coalesce("_used", F.lit(0))).alias("_room")))
        turn += 1
    used = placed.groupBy(*by).agg(F.sum("_length").alias("_used"))
    slack = whole.join(used, by).select(*by, (F.col("_room") - F.col("_used")).alias("_slack"))
    at = running_sum(placed.withColumn("_key", _place_key(seed, -1)), by, order, bucket, F.col("_length")).join(slack, by)
    ahead = F.least(F.floor(F.col("_key") / PLACE_KEYS * (F.col("_slack") + 1)), F.col("_slack"))  # grows with the order
    return at.select("chrom", "te_id", "round", "_span", "_gap", (F.col("_gap") + ahead + F.col("_before")).cast("long").alias("_new"))


def _lengths(gaps: DataFrame) -> DataFrame:
    return gaps.select("chrom", F.col("start").cast("long").alias("start"), (F.col("end") - F.col("start") + 1).cast("long").alias("length"))


def _tolerant_by_chromosome(own: DataFrame, regions: DataFrame, bars: DataFrame, rounds: int, first: int, seed: int, fraction: float) -> DataFrame | None:
    """As _draw_tolerant, where tasks can hold what a chromosome's regions and excluded intervals are; else None.

    The stream is run twice, once for what its draws leave over, so that placements are not written.
    """
    space = checkpoint(regions.withColumn("excluded", F.lit(0)).unionByName(bars.withColumn("excluded", F.lit(1))).select("chrom", *[F.col(c).cast("long").alias(c) for c in ("start", "end", "excluded")]))
    homes = space.where("excluded = 0").select("chrom").distinct()
    if (rows := held_rows(space, 6)) is None:
        return None
    tries = 64
    out = pass_by(own, space, rows.join(homes, "chrom"), Tolerant, tolerant_draws(rounds, first, seed, fraction, WORTH, tries), "round long, _new long")
    out = out.select("chrom", "te_id", "round", "_span", F.col("_new").alias("_gap"), "_new")
    left = checkpoint(out.where("_new IS NULL").select("chrom", "te_id", "round", "_span"))
    placed = out.where("_new IS NOT NULL")
    if left.isEmpty():
        return placed
    return placed.unionByName(_draw(left, space.withColumnRenamed("excluded", "_excluded"), ["chrom"], seed + tries, fraction))


def _apart_by_chromosome(own: DataFrame, gaps: DataFrame, rounds: int, first: int, seed: int) -> DataFrame | None:
    """As _draw_apart, where tasks can hold a chromosome's gaps and repeats and ids are whole numbers; else None."""
    kind = dict(own.dtypes)["te_id"]
    if kind not in ("tinyint", "smallint", "int", "bigint") or not own.where("te_id IS NULL").isEmpty():
        return None
    column = lambda c: F.col(c).cast("long")
    held = _lengths(gaps).select("chrom", F.lit(0).cast("long").alias("repeat"), F.lit(0).cast("long").alias("te_id"), F.col("start").alias("at"), F.col("length").alias("size"))
    homes = checkpoint(held.select("chrom").distinct())
    repeats = own.select("chrom", F.lit(1).cast("long").alias("repeat"), column("te_id").alias("te_id"), F.col("_own").alias("at"), column("_span").alias("size"))
    held = checkpoint(held.unionByName(repeats))
    if (rows := held_rows(held, 10)) is None:  # with what the draws of a round take
        return None
    items = _rounds(homes, rounds, first)
    parts = min(rounds, -(-own.sparkSession.sparkContext.defaultParallelism // max(1, homes.count())))
    out = pass_by(items, held, rows, Apart, apart_draws(seed, PLACE_KEYS), "te_id long, _span long, _gap long, _new long", parts)
    return out.select("chrom", F.col("te_id").cast(kind).alias("te_id"), "round", "_span", "_gap", "_new")


def shuffle_random(
    te: DataFrame,
    sizes: DataFrame,
    rounds: int,
    excl: DataFrame | None = None,
    incl: DataFrame | None = None,
    seed: int = 1,
    first: int = 1,
    no_overlap: bool = False,
    max_excl_fraction: float = 0.0,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Place each repeat at random on its chromosome, whole inside the allowed space: te's columns (or ``keep``) and round.

    One draw over the exact number of starts at which the repeat fits is uniform over them
    and never rejected. A repeat that fits nowhere is left out. With ``no_overlap`` the
    repeats of a round share no position; one that no room is left for is left out too.
    With ``max_excl_fraction`` up to that share of a repeat's positions may be excluded ones
    (rounded down); it still lies whole in its chromosome and an included region. The two
    options do not go together.
    """
    if max_excl_fraction and no_overlap:
        raise ValueError("placements without overlaps tolerate no excluded positions")
    tolerant = bool(max_excl_fraction) and excl is not None
    sizes = checkpoint(sizes.select("chrom", "length"))  # a row per chromosome
    if excl is not None:
        excl = checkpoint(merge_intervals(excl).select("chrom", "start", "end"))  # read several times, and tables behind it are large
    gaps = allowed_space(sizes, None if tolerant else excl, incl).select("chrom", "start", "end")
    span = (F.col("end") - F.col("start")).cast("long")
    base = checkpoint(te.select("chrom", "te_id", span.alias("_span")))
    items = _rounds(base, rounds, first)
    own = base.withColumn("_own", F.xxhash64("te_id"))
    if no_overlap:
        placed = _apart_by_chromosome(own, gaps, rounds, first, seed)
        placed = _draw_apart(items, gaps, seed) if placed is None else placed
    elif tolerant:
        placed = _tolerant_by_chromosome(own, gaps, excl, rounds, first, seed, max_excl_fraction)
        if placed is None:
            longest, usual = base.agg(F.coalesce(F.max("_span"), F.lit(0)), F.coalesce(F.percentile_approx("_span", 0.99), F.lit(0))).first()
            placed = _draw_tolerant(items, longest, usual, gaps, excl, seed, max_excl_fraction)
    else:
        held = checkpoint(_lengths(gaps))
        rows = held_rows(held, 5)
        placed = _draw(items, gaps, ["chrom"], seed) if rows is None else pass_by(own, held, rows, Gaps, draws(rounds, first, seed), "round long, _gap long, _new long")
    keep = [c for c in te.columns if keep is None or c in keep]
    if {*keep} <= {"chrom", "te_id", "start", "end"}:  # a placement's own
        return placed.withColumns({"start": F.col("_new"), "end": F.col("_new") + F.col("_span")}).select(*keep, "round")
    whole = te.join(placed.select("te_id", "round", "_new"), "te_id")
    return whole.withColumns({"end": F.col("_new") + span, "start": F.col("_new")}).select(*keep, "round")

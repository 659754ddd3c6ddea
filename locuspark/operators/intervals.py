"""Interval algebra: overlap join, subtraction, nearest, merging and set operations.

Intervals are rows with ``chrom``, ``start`` and ``end``, closed and 1-based. Every join is an
equi-join on chromosome and bin, never a cross join; windows that would span a chromosome
work per bin, with what the bins before hand over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.storage import checkpoint, if_small

#: Length of a bin; about twice the length of a usual interval or more.
BIN = 10_000
#: Length of the bins that windows over a chromosome are cut into.
STRETCH = 1_000_000


def _bins(start: Column, end: Column, size: int) -> Column:
    return F.sequence(F.floor(start / size), F.greatest(F.floor(start / size), F.floor(end / size)))


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def overlap_length(coords: str, a: str = "a_", b: str = "b_") -> Column:
    """Shared length of two intervals; half_open counts one less on the same numbers."""
    shared = F.least(f"{a}end", f"{b}end") - F.greatest(f"{a}start", f"{b}start")
    return shared + 1 if coords == "closed" else shared


def overlap_join(
    a: DataFrame,
    b: DataFrame,
    coords: str = "closed",
    min_nt: int = 1,
    min_pct: float | None = None,
    bin_size: int = BIN,
    keys: Sequence[str] = ("chrom",),
    left: str = "a_",
    right: str = "b_",
    long_intervals: bool = False,
    how: str = "inner",
    hot_rows: int | None = None,
) -> DataFrame:
    """All pairs of ``a`` and ``b`` that share ``min_nt`` positions or more, with ``overlap``.

    Columns are prefixed. ``min_pct`` is the share of b's length that must be covered. A
    pair is reported in the bin of its first shared position, so no distinct is needed.
    ``long_intervals`` adds coarser bins (32 and 1,024 times as long) for intervals that
    would fall into too many fine ones; each pair meets at the coarser of its two levels.
    ``how`` left keeps rows of ``a`` without a partner, once per bin, with nulls.
    ``hot_rows`` counts the rows of each bin first and cuts a bin with more rows than that on either side into a grid
    of blocks, each a key of its own: a's rows go to one of the row blocks, b's to one of the column blocks, and every
    pair of blocks is joined. It goes with inner joins.
    """
    a, b = prefixed(a, left), prefixed(b, right)
    sizes = [bin_size * 32**k for k in range(3)] if long_intervals else [bin_size]

    def dealt(df: DataFrame, p: str) -> DataFrame:
        if not long_intervals:
            return df.withColumn("_bin", F.explode(_bins(F.col(f"{p}start"), F.col(f"{p}end"), bin_size)))
        length = F.col(f"{p}end") - F.col(f"{p}start")
        own = F.when(length <= 16 * sizes[0], 0).when(length <= 16 * sizes[1], 1).otherwise(2)
        tagged = lambda k: lambda x: F.struct(F.lit(k).alias("level"), x.alias("bin"))
        at = [F.when(own <= k, F.transform(_bins(F.col(f"{p}start"), F.col(f"{p}end"), s), tagged(k))) for k, s in enumerate(sizes)]
        empty = F.array().cast("array<struct<level:int,bin:bigint>>")
        return df.withColumn(f"{p}_own", own).withColumn("_at", F.explode(F.flatten(F.array(*[F.coalesce(x, empty) for x in at])))).withColumns({"_level": F.col("_at.level"), "_bin": F.col("_at.bin")}).drop("_at")

    first = F.greatest(f"{left}start", f"{right}start")
    on = [F.col(left + k) == F.col(right + k) for k in keys]
    x, y = dealt(a, left), dealt(b, right)
    if hot_rows is not None:
        if how != "inner":
            raise ValueError("hot bins are cut for inner joins only")
        x, y = _cut_hot(x, y, [left + k for k in keys], [right + k for k in keys], ["_bin", *(["_level"] if long_intervals else [])], hot_rows)
        y = y.withColumnsRenamed({"_row": "_row2", "_column": "_column2"})
        on += [F.col("_row") == F.col("_row2"), F.col("_column") == F.col("_column2")]
    y = y.withColumnRenamed("_bin", "_bin2")
    on.append(F.col("_bin") == F.col("_bin2"))
    if long_intervals:
        y = y.withColumnRenamed("_level", "_level2")
        on += [F.col("_level") == F.col("_level2"), F.greatest(f"{left}_own", f"{right}_own") == F.col("_level")]
        size = F.element_at(F.array(*map(F.lit, sizes)), F.col("_level") + 1)
    else:
        size = F.lit(bin_size)
    on += [F.col(f"{left}start") <= F.col(f"{right}end"), F.col(f"{right}start") <= F.col(f"{left}end"), F.floor(first / size) == F.col("_bin")]
    if how == "inner":
        out = x.join(y, on).withColumn("overlap", overlap_length(coords, left, right).cast("long")).where(F.col("overlap") >= min_nt)
    else:
        out = x.join(y, [*on, overlap_length(coords, left, right) >= min_nt], how).withColumn("overlap", overlap_length(coords, left, right).cast("long"))
    if min_pct is not None:
        out = out.where(100 * F.col("overlap") >= min_pct * (F.col(f"{right}end") - F.col(f"{right}start") + 1))
    return out.drop("_bin", "_bin2", "_level", "_level2", f"{left}_own", f"{right}_own", "_row", "_row2", "_column", "_column2")


def _cut_hot(x: DataFrame, y: DataFrame, x_keys: list[str], y_keys: list[str], bins: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with _row and _column: in bins of more than ``most`` rows x is dealt to rows and repeated over columns, y the other way round."""
    count = lambda df, keys, n: df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *bins).agg(F.count(F.lit(1)).alias(n))
    names = [*[f"_k{i}" for i in range(len(x_keys))], *bins]
    both = count(x, x_keys, "_nx").join(count(y, y_keys, "_ny"), names).where((F.col("_nx") > most) | (F.col("_ny") > most))
    hot = checkpoint(both.select(*names, F.ceil(F.col("_nx") / most).cast("int").alias("_rows"), F.ceil(F.col("_ny") / most).cast("int").alias("_columns")))
    few = if_small(hot, hot.count(), 100_000)

    def blocks(df: DataFrame, keys: list[str], own: str, other: str) -> DataFrame:
        renamed = few.withColumnsRenamed({f"_k{i}": k for i, k in enumerate(keys)})
        one, all_ = F.pmod(F.xxhash64(*df.columns), F.coalesce(own, F.lit(1))).cast("int"), F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        mine, theirs = ("_row", "_column") if own == "_rows" else ("_column", "_row")
        return df.join(renamed, [*keys, *bins], "left").withColumn(mine, one).withColumn(theirs, all_).drop("_rows", "_columns")

    return blocks(x, x_keys, "_rows", "_columns"), blocks(y, y_keys, "_columns", "_rows")


def min_overlap(joined: DataFrame, nt: int | None = None, pct: float | None = None, right: str = "b_") -> DataFrame:
    """Keep pairs with ``nt`` shared positions, or ``pct`` percent of the feature, or more."""
    if nt is not None:
        joined = joined.where(F.col("overlap") >= nt)
    if pct is not None:
        joined = joined.where(100 * F.col("overlap") >= pct * (F.col(f"{right}end") - F.col(f"{right}start") + 1))
    return joined


def merge_intervals(df: DataFrame, by: Sequence[str] = ("chrom",), gap: int = 0, stretch: int = STRETCH) -> DataFrame:
    """Union into disjoint runs (overlapping or adjacent intervals join): (*by, start, end, n).

    Gaps and islands within bins of ``stretch``; one row per bin carries the furthest end and
    the last island start over to later bins, so no task holds a chromosome.
    """
    by = list(by)
    rows = df.where(F.col("start") <= F.col("end")).select(*by, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    rows = rows.withColumn("_bin", F.floor(F.col("start") / stretch))
    before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(*by, "_bin").agg(F.max("end").alias("_top")).select(*by, "_bin", F.max("_top").over(before).alias("_carry"))
    inner = Window.partitionBy(*by, "_bin").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest(F.max("end").over(inner), F.col("_carry"))
    flagged = rows.join(tops, [*by, "_bin"]).withColumn("_reach", reach)
    opened = F.when(F.col("_reach").isNull() | (F.col("start") > F.col("_reach") + 1 + gap), F.col("start"))
    flagged = flagged.withColumn("_open", opened)
    last = flagged.groupBy(*by, "_bin").agg(F.max("_open").alias("_last")).select(*by, "_bin", F.max("_last").over(before).alias("_from"))
    upto = Window.partitionBy(*by, "_bin").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)  # equal starts are one place
    island = F.coalesce(F.max("_open").over(upto), F.col("_from"))
    return flagged.join(last, [*by, "_bin"]).withColumn("_island", island).groupBy(*by, "_island").agg(F.max("end").alias("end"), F.count(F.lit(1)).alias("n")).select(*by, F.col("_island").alias("start"), "end", "n")


def subtract_intervals(a: DataFrame, b: DataFrame, bin_size: int = BIN, stretch: int | None = None) -> DataFrame:
    """``a`` minus the union of ``b``: what is left of each row, with a's other columns; repeated rows repeat.

    A sweep: rows get a number and are written; a row's cuts, and a mark before its start, each leave the piece up to
    the next of them. The next one is found per row and stretch of it, the first of later stretches is handed back, so
    a row of a whole chromosome is many rows, never one array.
    """
    stretch, cols = stretch or STRETCH, a.columns
    rows = checkpoint(a.withColumn("_id", F.monotonically_increasing_id()))
    more = [c for c in cols if c not in ("chrom", "start", "end")]
    place = rows.select("_id", "chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    merged = merge_intervals(b).select("chrom", "start", "end")
    long = F.col("end") - F.col("start") >= stretch

    def marks(df: DataFrame) -> DataFrame:
        """(_id, chrom, start, end, s, e): each row's cuts s..e, and an empty one before its start."""
        cut = overlap_join(df, merged, bin_size=bin_size).select(*[F.col(f"a_{c}").alias(c) for c in ("_id", "chrom", "start", "end")], F.greatest("b_start", "a_start").alias("s"), F.col("b_end").alias("e"))
        out = cut.unionByName(df.withColumns({"s": F.col("start") - 1, "e": F.col("start") - 1}))
        return out.withColumn("_bin", F.floor(F.greatest(F.col("s") - F.col("start"), F.lit(0)) / stretch))  # rows under a stretch have one bin

    w = Window.partitionBy("_id", "_bin").orderBy("s")
    swept = marks(place).withColumn("_next", F.lead("s").over(w))
    if not place.where(long).isEmpty():
        later = Window.partitionBy("_id").orderBy("_bin")
        firsts = marks(place.where(long)).groupBy("_id", "_bin").agg(F.min("s").alias("_s")).select("_id", "_bin", F.lead("_s").over(later).alias("_later"))
        swept = swept.join(firsts, ["_id", "_bin"], "left").withColumn("_next", F.coalesce("_next", "_later"))
    s, e = F.greatest(F.col("start"), F.col("e") + 1), F.coalesce(F.col("_next"), F.col("end") + 1) - 1
    pieces = swept.select("_id", "chrom", s.alias("start"), e.alias("end")).where("start <= end")
    if more:
        pieces = pieces.join(rows.select("_id", *more), "_id")
    return pieces.select(*cols)


def running_max(rows: DataFrame, by: Sequence[str], pos: str, value: str, order: Sequence[Column], back: bool = False, stretch: int = STRETCH) -> DataFrame:
    """Rows with _before: the largest ``value`` of all rows that come before in the order of ``pos`` (``back``: downwards).

    The window is per stretch of positions; one row per stretch carries what the stretches before it hold.
    """
    by = list(by)
    rows = rows.withColumn("_bin", F.floor(F.col(pos) / stretch))
    at = F.desc("_bin") if back else F.asc("_bin")
    earlier = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy(*by, "_bin").agg(F.max(value).alias("_top")).select(*by, "_bin", F.max("_top").over(earlier).alias("_carry"))
    inner = Window.partitionBy(*by, "_bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(tops, [*by, "_bin"]).withColumn("_before", F.coalesce(F.max(value).over(inner), F.col("_carry"))).drop("_bin", "_carry")


def nearest(a: DataFrame, b: DataFrame, a_id: str, b_id: str, stretch: int | None = None) -> DataFrame:
    """The closest ``b`` of each ``a``: (a_id, b_id, distance), negative if a lies upstream of b on b's strand.

    Distance 0 if they overlap, else the number of steps from edge to edge. Of all that are equally close, on either
    side, the smallest b_id wins, in the order of its own type. Neighbours on both sides come from one pass over both
    tables per stretch of a chromosome, with one row carried between stretches; overlaps from the binned join.
    """
    stretch = stretch or STRETCH
    minus = F.col("strand") == "-"
    site = F.struct(F.col(b_id).alias("i"), minus.alias("m"))
    at = lambda c: b.groupBy("chrom", F.col(c).cast("long").alias("pos")).agg(F.min(site).alias("site"))  # noqa: E731  the smallest id of each end
    none = F.lit(None)
    asked = a.select("chrom", F.explode(F.array(F.struct(F.col("start").cast("long").alias("pos"), F.lit(True).alias("left")), F.struct(F.col("end").cast("long").alias("pos"), F.lit(False).alias("left")))).alias("x"), F.col(a_id).alias("aid"))
    asked = asked.select("chrom", "x.pos", "x.left", "aid", F.lit(1).alias("kind"), none.alias("low"), none.alias("high"))
    ends = at("end").select("chrom", "pos", none.alias("left"), none.alias("aid"), F.lit(0).alias("kind"), F.struct("pos", "site").alias("low"), none.alias("high"))
    starts = at("start").select("chrom", "pos", none.alias("left"), none.alias("aid"), F.lit(0).alias("kind"), none.alias("low"), F.struct("pos", "site").alias("high"))
    rows = asked.unionByName(ends).unionByName(starts).withColumn("_bin", F.floor(F.col("pos") / stretch))
    before, after = Window.partitionBy("chrom").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("chrom").orderBy("_bin").rowsBetween(1, Window.unboundedFollowing)
    tops = rows.groupBy("chrom", "_bin").agg(F.max("low").alias("_low"), F.min("high").alias("_high"))
    tops = tops.select("chrom", "_bin", F.max("_low").over(before).alias("_low"), F.min("_high").over(after).alias("_high"))
    # questions come before answers of the same place in either direction, so that only what lies beyond an edge counts
    up = Window.partitionBy("chrom", "_bin").orderBy("pos", F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("chrom", "_bin").orderBy(F.desc("pos"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    low, high = F.coalesce(F.max("low").over(up), F.col("_low")), F.coalesce(F.min("high").over(down), F.col("_high"))
    sides = rows.join(tops, ["chrom", "_bin"]).withColumns({"_l": low, "_h": high}).where("kind = 1")
    x = F.when(F.col("left"), F.col("_l")).otherwise(F.col("_h"))
    sides = sides.select("aid", "left", "pos", x.alias("x")).where("x IS NOT NULL")
    sign = F.when(F.col("x.site.m") == F.col("left"), -1).otherwise(1)
    cand = sides.select("aid", F.col("x.site.i").alias("bid"), (F.abs(F.col("x.pos") - F.col("pos")) * sign).cast("long").alias("distance"))
    over = overlap_join(a.select("chrom", "start", "end", F.col(a_id).alias("aid")), b.select("chrom", "start", "end", F.col(b_id).alias("bid")))
    cand = cand.union(over.select("a_aid", "b_bid", F.lit(0).cast("long")))
    best = cand.groupBy("aid").agg(F.min(F.struct(F.abs("distance").alias("d"), F.col("bid"), F.col("distance").alias("distance"))).alias("m"))
    return best.select(F.col("aid").alias(a_id), F.col("m.bid").alias(b_id), F.col("m.distance").alias("distance"))


def keep_adjacent(fragments: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Fragments that touch their parent: end = parent start - 1 or start = parent end + 1."""
    p = parents.select(F.col(key).alias("_k"), F.col("start").alias("_ps"), F.col("end").alias("_pe"))
    touch = (F.col("end") == F.col("_ps") - 1) | (F.col("start") == F.col("_pe") + 1)
    return fragments.join(p, (F.col(key) == F.col("_k")) & touch, "left_semi")


def interval_union(a: DataFrame, b: DataFrame) -> DataFrame:
    cols = ["chrom", "start", "end"]
    return merge_intervals(a.select(*cols).union(b.select(*cols))).select(*cols)


def interval_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    j = overlap_join(merge_intervals(a), merge_intervals(b))
    return j.select(F.col("a_chrom").alias("chrom"), F.greatest("a_start", "b_start").alias("start"), F.least("a_end", "b_end").alias("end"))


def interval_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return subtract_intervals(merge_intervals(a).select("chrom", "start", "end"), b)


def interval_xor(a: DataFrame, b: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """What one of both covers and the other does not, as disjoint runs that do not touch: (chrom, start, end).

    It changes where a run of either starts or has ended, but not where both do; every second change opens a run that
    the next one closes. A change's number and the next one are found per stretch, with one row carried per stretch.
    """
    cols = ["chrom", "start", "end"]
    runs = merge_intervals(a, stretch=stretch).select(*cols).unionByName(merge_intervals(b, stretch=stretch).select(*cols))
    changes = runs.select("chrom", F.explode(F.array(F.col("start"), F.col("end") + 1)).alias("pos")).groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("_n"))
    changes = checkpoint(changes.where("_n = 1").select("chrom", "pos", F.floor(F.col("pos") / stretch).alias("_bin")))
    order = Window.partitionBy("chrom").orderBy("_bin")
    earlier = F.coalesce(F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tops = changes.groupBy("chrom", "_bin").agg(F.count(F.lit(1)).alias("_c"), F.min("pos").alias("_p"))
    tops = tops.select("chrom", "_bin", earlier.alias("_before"), F.lead("_p").over(order).alias("_later"))
    w = Window.partitionBy("chrom", "_bin").orderBy("pos")
    numbered = changes.join(tops, ["chrom", "_bin"]).withColumns({"_i": F.row_number().over(w) - 1 + F.col("_before"), "_next": F.coalesce(F.lead("pos").over(w), F.col("_later"))})
    return numbered.where("_i % 2 = 0").select("chrom", F.col("pos").alias("start"), (F.col("_next") - 1).alias("end"))


def interval_complement(a: DataFrame, sizes: DataFrame) -> DataFrame:
    """What of each chromosome (1..length) no interval covers; chromosomes without intervals whole.

    Each merged run gives the gap before it, from the end carried over; the last gap of a chromosome follows its furthest end.
    """
    length = sizes.select("chrom", F.col("length").cast("long").alias("_length"))
    runs = merge_intervals(a).withColumn("_far", F.col("end"))
    before = running_max(runs, ["chrom"], "start", "_far", [F.asc("start")]).select("chrom", F.coalesce(F.col("_before") + 1, F.lit(1)).alias("start"), (F.col("start") - 1).alias("end"))
    last = length.join(runs.groupBy("chrom").agg(F.max("end").alias("_last")), "chrom", "left")
    last = last.select("chrom", F.coalesce(F.col("_last") + 1, F.lit(1)).alias("start"), F.col("_length").alias("end"))
    gaps = before.unionByName(last).join(length, "chrom")
    return gaps.select("chrom", F.greatest("start", F.lit(1)).cast("long").alias("start"), F.least("end", "_length").cast("long").alias("end")).where("start <= end")


def interval_size(a: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """(chrom, n): positions covered, optionally clipped to lo..hi."""
    s = F.greatest(F.col("start"), F.lit(lo)) if lo is not None else F.col("start")
    e = F.least(F.col("end"), F.lit(hi)) if hi is not None else F.col("end")
    return merge_intervals(a).groupBy("chrom").agg(F.sum(F.greatest(e - s + 1, F.lit(0))).cast("long").alias("n"))


def set_predicates(a: DataFrame, b: DataFrame) -> DataFrame:
    """(chrom, is_subset, is_superset, is_equal, is_disjoint) of a's and b's coverage by chromosome."""
    na, nb = interval_size(a).withColumnRenamed("n", "na"), interval_size(b).withColumnRenamed("n", "nb")
    both = interval_size(interval_intersection(a, b)).withColumnRenamed("n", "nab")
    j = na.join(nb, "chrom", "full").join(both, "chrom", "left").fillna(0, ["na", "nb", "nab"])
    ab = F.col("nab")
    return j.select("chrom", (ab == F.col("na")).alias("is_subset"), (ab == F.col("nb")).alias("is_superset"), ((ab == F.col("na")) & (ab == F.col("nb"))).alias("is_equal"), (ab == 0).alias("is_disjoint"))


def contained_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that lie whole inside the union of ``b``."""
    m = prefixed(merge_intervals(b), "b_")
    x = a.withColumn("_bin", F.floor(F.col("start") / BIN))
    y = m.withColumn("_bin2", F.explode(_bins(F.col("b_start"), F.col("b_end"), BIN)))
    on = [F.col("chrom") == F.col("b_chrom"), F.col("_bin") == F.col("_bin2"), F.col("start") >= F.col("b_start"), F.col("end") <= F.col("b_end")]
    return x.join(y, on, "left_semi").drop("_bin")


def points_to_ranges(points: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Runs of consecutive integers: (*by, start, end)."""
    p = points.select(*by, F.col(value).cast("long").alias("start"), F.col(value).cast("long").alias("end"))
    return merge_intervals(p, by).select(*by, "start", "end")


def format_ranges(ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Text form ``1-5,9`` of each group's ranges, in ascending order."""
    text = F.when(F.col("start") == F.col("end"), F.col("start").cast("string")).otherwise(F.concat_ws("-", "start", "end"))
    return ranges.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", text.alias("t")))), lambda x: x["t"]), ",").alias("ranges"))


def parse_ranges(df: DataFrame, col: str) -> DataFrame:
    """Rows of (other columns, start, end) from the text form."""
    parts = df.withColumn("_p", F.explode(F.split(col, ",")))
    ends = F.split("_p", "(?<=[0-9])-")
    return parts.select(*[c for c in df.columns if c != col], ends[0].cast("long").alias("start"), F.coalesce(F.try_element_at(ends, F.lit(2)), ends[0]).cast("long").alias("end"))


def previous_row(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add _before: start and end of the row before in the order of start, end (null for the first)."""
    place = df.withColumn("_own", F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")))
    return running_max(place, by, "start", "_own", [F.asc("start"), F.asc("end")]).drop("_own")


def covered_amount(df: DataFrame, by: Sequence[str] = (), parity: bool = False) -> DataFrame:
    """(*by, total, nr, overlap): all lengths, positions covered, and the difference.

    ``parity`` compares each interval with the one before it only (sorted by start, end).
    """
    by = list(by)
    length = F.col("end") - F.col("start") + 1
    if parity:
        before = F.col("_before.end")
        rows = previous_row(df, [*by, "chrom"]).withColumn("_shared", F.when(before >= F.col("start"), before - F.col("start") + 1).otherwise(0))
        return rows.groupBy(*by).agg(F.sum(length).cast("long").alias("total"), (F.sum(length) - F.sum("_shared")).cast("long").alias("nr"), F.sum("_shared").cast("long").alias("overlap"))
    total = df.groupBy(*by).agg(F.sum(length).cast("long").alias("total"))
    nr = merge_intervals(df, [*by, "chrom"]).groupBy(*by).agg(F.sum(length).cast("long").alias("nr"))
    both = total.join(nr, by) if by else total.crossJoin(nr)  # one row each
    return both.withColumn("overlap", F.col("total") - F.col("nr"))


def sort_intervals(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Sorted by chromosome, start, end over all partitions."""
    cols = ["chrom", "start", "end"]
    spread = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return spread.sortWithinPartitions(*cols)


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")

"""Descriptive statistics of DataFrame columns: one row per group (or one in all), built from aggregates.

Null values are left out everywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.storage import checkpoint, if_small


def mean_sd(df: DataFrame, by: Sequence[str], col: str, parity: bool = False) -> DataFrame:
    """(*by, mean, sd): sample deviation, null for a single value; ``parity`` leaves zeros out of the squared sum."""
    if not parity:
        return df.groupBy(*by).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("sd"))
    m = df.groupBy(*by).agg(F.avg(col).alias("mean"), F.count(col).alias("_n"), F.sum(F.col(col) * F.col(col)).alias("_q"), F.sum(col).alias("_s"), F.sum(F.when(F.col(col) != 0, 1).otherwise(0)).alias("_k"))
    around = F.col("_q") - 2 * F.col("mean") * F.col("_s") + F.col("_k") * F.col("mean") * F.col("mean")
    return m.select(*by, "mean", F.when(F.col("_n") > 1, F.sqrt(around / (F.col("_n") - 1))).alias("sd"))


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n) of a column."""
    return df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def category_summary(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count(col).alias("n"), F.countDistinct(col).alias("n_distinct"), F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def describe(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    c = F.col(col)
    return df.groupBy(*by).agg(
        F.count(c).alias("n"), F.sum(c).alias("total"), F.avg(c).alias("mean"), F.var_samp(c).alias("variance"), F.stddev_samp(c).alias("sd"), F.min(c).alias("min"), F.max(c).alias("max"), (F.max(c) - F.min(c)).alias("range")
    )


#: Distinct values of a group up to which one task ranks them; more are dealt to buckets. Both give the same ranks.
ONE_TASK = 1_000_000


def ranked_values(df: DataFrame, col: str, by: Sequence[str] = (), buckets: int = 200, one_task: int | None = None) -> DataFrame:
    """(*by, _v, _k, _below, _n): each group's distinct values with how often they occur, how many values are smaller, and all.

    Values are counted first, and the counts written: the rest works on distinct values. A group of up to ``ONE_TASK``
    of them is one running sum; where any has more, all are dealt to buckets between approximate quantiles of the
    distinct values, running sums are per bucket, and the buckets' totals are carried over.
    """
    by = list(by)
    rows = df.where(F.col(col).isNotNull()).select(*by, F.col(col).alias("_v"))
    per = checkpoint(rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_k")))
    group = by or [F.lit(0)]
    most = per.groupBy(*by).agg(F.count(F.lit(1)).alias("_d")).agg(F.max("_d")).first()[0] or 0
    if most <= (ONE_TASK if one_task is None else one_task):
        before = Window.partitionBy(*group).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
        return per.withColumns({"_below": F.coalesce(F.sum("_k").over(before), F.lit(0)), "_n": F.sum("_k").over(Window.partitionBy(*group))})
    cuts = per.groupBy(*by).agg(F.percentile_approx("_v", [k / buckets for k in range(1, buckets)], 10_000).alias("_cuts"), F.sum("_k").alias("_n"))
    per = per.join(cuts, by) if by else per.crossJoin(F.broadcast(cuts))  # one row
    per = per.withColumn("_b", F.size(F.filter("_cuts", lambda x: x < F.col("_v")))).drop("_cuts")
    earlier = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # over the buckets' rows
    carried = per.groupBy(*by, "_b").agg(F.sum("_k").alias("_t")).select(*by, "_b", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_carry"))
    inner = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    return per.join(carried, [*by, "_b"]).withColumn("_below", F.col("_carry") + F.coalesce(F.sum("_k").over(inner), F.lit(0))).drop("_b", "_carry")


def _at(place: Column) -> Column:
    """The value that stands at a place (from 0) of the ranked values, as an aggregate."""
    return F.max(F.when((F.col("_below") <= place) & (place < F.col("_below") + F.col("_k")), F.col("_v")))


def _quantile(q: float) -> Column:
    """Type-7 quantile of ranked values, as an aggregate."""
    h = (F.col("_n") - 1) * q
    low, high = _at(F.floor(h)), _at(F.ceil(h))
    return low + (high - low) * (F.max(h) - F.floor(F.max(h)))


def order_stats(df: DataFrame, col: str, by: Sequence[str] = (), percent: float = 90, trim: float = 0.1) -> DataFrame:
    """Median, RFC 2330 percentile (null where percent < 100 / n), type-7 quartiles and the trimmed mean.

    The trimmed mean leaves out floor(n x trim) values at either end. All come from the
    values' ranks, found bucket by bucket.
    """
    r, n = ranked_values(df, col, by), F.col("_n")
    used = F.greatest(F.lit(0), F.least(F.col("_below") + F.col("_k"), n - F.floor(n * trim)) - F.greatest(F.col("_below"), F.floor(n * trim)))
    percentile = _at(F.greatest(F.ceil(n * F.lit(percent) / 100), F.lit(1)) - 1)
    return r.groupBy(*by).agg(
        _quantile(0.5).alias("median"), _quantile(0.25).alias("q1"), _quantile(0.75).alias("q3"), F.max("_n").alias("n"),
        F.when(F.lit(percent) >= 100 / F.max("_n"), percentile).alias("percentile"), (F.sum(F.col("_v") * used) / F.sum(used)).alias("trimmed_mean"),
    )


def other_means(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Harmonic mean (null if any value is zero) and geometric mean (null if any is negative)."""
    c = F.col(col).cast("double")
    safe = F.when(c != 0, 1 / c)
    log = F.when(c > 0, F.ln(c))
    zero, neg = F.max(F.when(c == 0, 1).otherwise(0)), F.max(F.when(c < 0, 1).otherwise(0))
    return df.where(c.isNotNull()).groupBy(*by).agg(F.when(zero == 0, F.count(c) / F.sum(safe)).alias("harmonic_mean"), F.when(neg == 1, None).when(zero == 1, 0.0).otherwise(F.exp(F.avg(log))).alias("geometric_mean"))


def mode(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """The most frequent value (the smallest of ties), null when nothing repeats."""
    n = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n"))
    best = n.groupBy(*by).agg(F.max(F.struct("_n", (-F.col(col)).alias("_v"))).alias("_m"))
    return best.select(*by, F.when(F.col("_m._n") > 1, -F.col("_m._v")).alias("mode"))


def moments(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Sample skewness and excess kurtosis; null under 3 and 4 values, or where all are equal."""
    c, n = F.col(col), F.count(col)
    g1, g2 = F.skewness(c), F.kurtosis(c)
    skew = F.when((n >= 3) & (F.stddev_samp(c) > 0), g1 * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when((n >= 4) & (F.stddev_samp(c) > 0), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return df.groupBy(*by).agg(skew.alias("skewness"), kurt.alias("kurtosis"))


def _same(by: Sequence[str], p: str) -> Column:
    """Equal groups, nulls among them, where the other side's columns carry a prefix."""
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(p + c))
    return on


def _medians(rows: DataFrame, col: str, by: Sequence[str], near: float = 0.001) -> DataFrame:
    """(*by, _m): exact medians, without sending the values.

    Approximate quantiles just below and above the middle bracket it; what lies under, above and at each value between
    them is counted where the rows are, so a few in a thousand of the values are ranked. The approximation decides only
    how many those are: should a middle lie outside its bracket, all values are ranked.
    """
    by, v = list(by), F.col(col)
    cuts = rows.groupBy(*by).agg(F.percentile_approx(v, [0.5 - near, 0.5 + near], 10_000).alias("_c")).where("_c IS NOT NULL")
    cuts = checkpoint(cuts.select(*[F.col(c).alias("_g" + c) for c in by], F.col("_c")[0].alias("_lo"), F.col("_c")[1].alias("_hi")))
    side = F.when(v < F.col("_lo"), 0).when(v > F.col("_hi"), 2).otherwise(1)
    j = rows.where(v.isNotNull()).join(if_small(cuts, cuts.count()), _same(by, "_g"))
    k = j.select(*by, side.alias("_side"), F.when(side == 1, v).alias("_v")).groupBy(*by, "_side", "_v").agg(F.count(F.lit(1)).alias("_k"))
    group = by or [F.lit(0)]
    before = Window.partitionBy(*group).orderBy("_side", "_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = k.withColumns({"_below": F.coalesce(F.sum("_k").over(before), F.lit(0)), "_n": F.sum("_k").over(Window.partitionBy(*group))})
    m = checkpoint(ranked.groupBy(*by).agg(_quantile(0.5).alias("_m")))
    if m.where("_m IS NULL").isEmpty():
        return m
    return checkpoint(ranked_values(rows, col, by).groupBy(*by).agg(_quantile(0.5).alias("_m")))


def mad(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Median absolute deviation; no task buffers or sorts a group, only what lies close to its medians."""
    by = list(by)
    rows = df.where(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("_x"))
    m = _medians(rows, "_x", by)
    j = rows.join(if_small(m.select(*[F.col(c).alias("_g" + c) for c in by], "_m"), m.count()), _same(by, "_g"))
    return _medians(j.select(*by, F.abs(F.col("_x") - F.col("_m")).alias("_d")), "_d", by).withColumnRenamed("_m", "mad")


def arg_extrema(df: DataFrame, col: str, index: str, by: Sequence[str] = ()) -> DataFrame:
    """Index of the smallest and largest value; the smallest index of ties."""
    return df.groupBy(*by).agg(F.min(F.struct(F.col(col), F.col(index)))[index].alias("min_index"), (-F.max(F.struct(F.col(col), (-F.col(index)).alias("i")))["i"]).alias("max_index"))


def frequency(df: DataFrame, col: str, bins: int | Sequence[float]) -> DataFrame:
    """(upper, n): counts per upper bin limit; N equal bins between minimum and maximum, or given limits.

    Values are compared with limits at six decimals; values above the last given limit are left out.
    """
    rows = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("v"))
    if isinstance(bins, int):
        lo, hi = rows.agg(F.min("v"), F.max("v")).first()
        if lo is None:
            return df.sparkSession.createDataFrame([], "upper double, n long")
        step = (hi - lo) / bins
        limits = [lo + step * (k + 1) for k in range(bins - 1)] + [hi]
    else:
        limits = sorted(map(float, bins))
    table = F.array(*[F.round(F.lit(float(x)), 6) for x in limits])
    rows = rows.select(F.round("v", 6).alias("v"), F.lit(0).alias("k"))
    for step in (1 << b for b in range(len(limits).bit_length() - 1, -1, -1)):  # bisection: k limits are under the value
        on = F.try_element_at(table, F.col("k") + step) < F.col("v")
        rows = rows.select("v", F.when(on, F.col("k") + step).otherwise(F.col("k")).alias("k"))
    n = rows.where(F.col("k") < len(limits)).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.createDataFrame(list(enumerate(limits)), "k int, upper double")
    return spine.join(F.broadcast(n), "k", "left").select("upper", F.coalesce("n", F.lit(0)).alias("n"))


def cumulative_frequency(freq: DataFrame) -> DataFrame:
    """Add cumulative, relative and relative cumulative counts to a frequency table (few rows)."""
    w = Window.partitionBy(F.lit(0)).orderBy("upper").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return freq.withColumns({"cumulative": F.sum("n").over(w), "relative": F.col("n") / total, "relative_cumulative": F.sum("n").over(w) / total})


def least_squares(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Intercept, slope, correlation and root mean square error of y against x."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    rows = df.where(a.isNotNull() & b.isNotNull())
    s = rows.groupBy(*by).agg(F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept"), F.corr(b, a).alias("r"), F.regr_syy(b, a).alias("_yy"), F.regr_sxy(b, a).alias("_xy"), F.count(F.lit(1)).alias("_n"))
    return s.withColumn("rms", F.sqrt(F.greatest(F.lit(0.0), F.col("_yy") - F.col("slope") * F.col("_xy")) / F.col("_n"))).drop("_yy", "_xy", "_n")


def drop_outlier(df: DataFrame, col: str, predicate: Callable[[Column, Column], Column], key: str, by: Sequence[str] = ()) -> DataFrame:
    """Remove the one value farthest from the mean if the predicate(value, mean) says so; the smallest key of ties.

    One row goes, even where others share its key or are equal to it.
    """
    cols = df.columns
    m = df.groupBy(*by).agg(F.avg(col).alias("_mean"))
    j = df.join(m, list(by)) if by else df.crossJoin(F.broadcast(m))
    place = F.struct(F.abs(F.col(col) - F.col("_mean")).alias("d"), (-F.col(key)).alias("k"), F.xxhash64(*cols).alias("h"))
    far = j.groupBy(*by).agg(F.max(F.struct(*[place[x].alias(x) for x in "dkh"], F.col(col).alias("v"), F.col("_mean").alias("m"))).alias("_f"))
    gone = far.where(predicate(F.col("_f.v"), F.col("_f.m"))).select(*[F.col(c).alias(f"_by_{c}") for c in by], (-F.col("_f.k")).alias("_gone"), F.col("_f.h").alias("_hash"))
    on = [F.col(key) == F.col("_gone"), F.xxhash64(*cols) == F.col("_hash"), *[F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]]
    marked = df.join(gone.withColumn("_hit", F.lit(1)), on, "left").select(*cols, "_hit")
    hit = marked.where("_hit = 1")  # the outlier, and rows equal to it
    again = hit.groupBy(*cols).agg((F.count(F.lit(1)) - 1).alias("_n")).where("_n > 0").withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return marked.where("_hit IS NULL").select(*cols).unionByName(again.select(*cols))


def _smoothed(df: DataFrame, by: Sequence[str], order: str, cols: Sequence[str], step: Callable) -> DataFrame:
    """(*by, order, smoothed) along each group's order, by a recurrence step(state, *values) -> (state, value).

    Rows are sorted by Spark and streamed, batch after batch, with the state carried over: time is linear and
    memory that of a batch, however long a group is.
    """
    kinds = dict(df.dtypes)
    shape = ", ".join([*[f"{c} {kinds[c]}" for c in by], f"{order} {kinds[order]}", "smoothed double"])

    def run(batches):
        last, state = None, None
        for b in batches:
            out = []
            groups = zip(*(b[c] for c in by), strict=True) if by else ((),) * len(b)
            for g, *values in zip(groups, *(b[c].astype(float) for c in cols), strict=True):
                if g != last:
                    last, state = g, None
                state, value = step(state, *values)
                out.append(value)
            yield b[[*by, order]].assign(smoothed=out)

    rows = df.where(F.col(cols[0]).isNotNull()).select(*by, order, *cols)
    rows = rows.repartition(*by) if by else rows.repartition(1)
    return rows.sortWithinPartitions(*by, order).mapInPandas(run, shape)


def exp_smooth(df: DataFrame, by: Sequence[str], order: str, col: str, coeff: float) -> DataFrame:
    """(*by, order, smoothed): S0 = x0, S = coeff x previous + (1 - coeff) x value, along each group's order.

    A scan: n steps map the value before to coeff^n times it plus what they add, so rows are sorted by ranges over
    all partitions, each partition runs from zero, and hands on its end to the next where a group goes on there: at
    most two rows per partition, however many groups there are. No task holds a group; a null is a group like others.
    """
    by = list(by)
    keys = by or ["_all"]
    rows = df.where(F.col(col).isNotNull()).select(*by, order, F.col(col).cast("double").alias("_x"))
    rows = rows if by else rows.withColumn("_all", F.lit(0))
    kinds = dict(rows.dtypes)
    shape = ", ".join([*[f"{c} {kinds[c]}" for c in (*keys, order)], "_part int, _n long, _x0 double, _s double"])

    def run(batches):
        part, last, s, n, x0 = TaskContext.get().partitionId(), None, 0.0, 0, 0.0
        for b in batches:
            sums, places, firsts = [], [], []
            groups = zip(*((b[c].astype(object).where(b[c].notna(), None) if b[c].hasnans else b[c]) for c in keys), strict=True)
            for g, x in zip(groups, b["_x"].tolist(), strict=True):
                if g != last:
                    last, s, n, x0 = g, 0.0, 0, x
                s, n = coeff * s + (1 - coeff) * x, n + 1
                sums.append(s)
                places.append(n)
                firsts.append(x0)
            yield b[[*keys, order]].assign(_part=part, _n=places, _x0=firsts, _s=sums)

    local = checkpoint(rows.repartitionByRange(*keys, order).sortWithinPartitions(*keys, order).mapInPandas(run, shape))

    def chain(frame):
        frame = frame.sort_values("_part", ignore_index=True)
        s, before = frame["_x0"].iloc[0], []
        for n, add in zip(frame["_n"].tolist(), frame["_s"].tolist(), strict=True):
            before.append(s)
            s = coeff**n * s + add
        return frame[[*keys, "_part"]].assign(_before=before)

    ends = local.groupBy(*keys, "_part").agg(F.max("_n").alias("_n"), F.max_by("_s", "_n").alias("_s"), F.min("_x0").alias("_x0"))  # a row per partition and group
    parted = ends.withColumn("_parts", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where("_parts > 1").drop("_parts")
    before = parted.groupBy(*keys).applyInPandas(chain, ", ".join([*[f"{c} {kinds[c]}" for c in keys], "_part int, _before double"]))
    before = checkpoint(before.select(*[F.col(c).alias("_g" + c) for c in keys], F.col("_part").alias("_gpart"), "_before"))
    j = local.join(if_small(before, before.count()), _same(keys, "_g") & (F.col("_part") == F.col("_gpart")), "left")
    return j.select(*by, order, (F.col("_s") + F.pow(F.lit(float(coeff)), "_n") * F.coalesce("_before", "_x0")).alias("smoothed"))


def weighted_smooth(df: DataFrame, by: Sequence[str], order: str, col: str, weight: str, coeff: float) -> DataFrame:
    """As exp_smooth, each value and the smoothed one before weighted by their sample counts.

    With a = C W / (W + N) and b = (1 - C) N / (W + N) for the weight W so far and the count N,
    the new value is (a S + b x) / (a + b), the new weight (a W + b N) / (a + b).
    """

    def step(state: tuple[float, float] | None, x: float, n: float) -> tuple[tuple[float, float], float]:
        if state is None:
            return (x, n), x
        s, w = state
        if w + n:
            a, b = coeff * w / (w + n), (1 - coeff) * n / (w + n)
            s, w = (s * a + x * b) / (a + b), (w * a + n * b) / (a + b)
        return (s, w), s

    return _smoothed(df, by, order, [col, weight], step)


def summarise(df: DataFrame, value: Column, by: Sequence[str] = ()) -> DataFrame:
    """Describe any value computed from each row."""
    return describe(df.withColumn("_value", value), "_value", by)

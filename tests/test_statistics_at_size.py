"""Statistics whose rows must not all travel: results against plain computations."""

import random
import statistics

from pyspark.sql import functions as F

from locuspark.functions import statistics as st


def test_median_deviation_ranks_only_what_is_near_the_median(spark, monkeypatch):
    rng = random.Random(3)
    values = {g: [None if i % 90 == 0 else round(rng.lognormvariate(3, 2), 3 if g != 1 else 0) for i in range(n)] for g, n in ((None, 6001), (1, 4000), (2, 7), (3, 2))}
    df = spark.createDataFrame([(g, x) for g, xs in values.items() for x in xs], "g int, x double")
    monkeypatch.setattr(st, "ranked_values", None)  # not needed where the bracket holds the middle
    got = {r.g: r.mad for r in st.mad(df, "x", ["g"]).collect()}

    def want(xs):
        xs = [x for x in xs if x is not None]
        m = statistics.median(xs)
        return statistics.median([abs(x - m) for x in xs])

    assert set(got) == set(values) and all(abs(got[g] - want(xs)) < 1e-9 for g, xs in values.items())
    whole = want([x for xs in values.values() for x in xs])
    assert abs(st.mad(df, "x").first().mad - whole) < 1e-9


def test_medians_outside_the_bracket_are_still_exact(spark, monkeypatch):
    df = spark.createDataFrame([(float(i * i % 97),) for i in range(50)], "x double")
    real = F.percentile_approx
    monkeypatch.setattr(st.F, "percentile_approx", lambda c, q, a: F.transform(real(c, q, a), lambda x: x + 1000))
    assert st._medians(df, "x", []).first()._m == statistics.median([i * i % 97 for i in range(50)])


def test_smoothing_hands_on_only_groups_that_partitions_share(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(g, i, rng.uniform(-5, 9)) for g in [None, *range(60)] for i in range(400 if g in (None, 7) else 5)]
    df = spark.createDataFrame(rows, "g int, i int, x double").repartition(3)
    sizes, real = [], st.checkpoint
    monkeypatch.setattr(st, "checkpoint", lambda d: (lambda c: (sizes.append(c.count()), c)[1])(real(d)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.g, r.i): r.smoothed for r in st.exp_smooth(df, ["g"], "i", "x", 0.4).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want, s = {}, {}
    for g, i, x in rows:
        s[g] = 0.4 * s[g] + 0.6 * x if g in s else x
        want[g, i] = s[g]
    assert set(got) == set(want) and max(abs(got[k] - want[k]) for k in want) < 1e-9
    assert len(sizes) == 2 and 2 <= sizes[1] <= 8

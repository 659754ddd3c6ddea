"""Interval algebra on hand-made and random intervals against position sets."""

import random

from locuspark.operators import intervals as iv


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "chrom string, start long, end long" + extra)


def positions(rows):
    return {(c, p) for c, s, e in rows for p in range(s, e + 1)}


def rows_of(df):
    return [(r["chrom"], r["start"], r["end"]) for r in df.collect()]


def some(seed, n=60, top=400):
    r = random.Random(seed)
    return [(f"c{r.randrange(3)}", s := r.randrange(1, top), s + r.randrange(0, 30)) for _ in range(n)]


def test_set_algebra_equals_position_sets(spark):
    a, b = some(1), some(2)
    da, db = frame(spark, a), frame(spark, b)
    pa, pb = positions(a), positions(b)
    assert positions(rows_of(iv.interval_union(da, db))) == pa | pb
    assert positions(rows_of(iv.interval_intersection(da, db))) == pa & pb
    assert positions(rows_of(iv.interval_difference(da, db))) == pa - pb
    assert positions(rows_of(iv.interval_xor(da, db))) == pa ^ pb
    sizes = spark.createDataFrame([(f"c{i}", 500) for i in range(3)], "chrom string, length long")
    whole = positions([(f"c{i}", 1, 500) for i in range(3)])
    assert positions(rows_of(iv.interval_complement(da, sizes))) == whole - pa


def test_merged_runs_are_disjoint_and_not_adjacent_across_bins(spark):
    a = some(3, 300, 2000)
    for stretch in (10, 50, 1_000_000):
        got = sorted(rows_of(iv.merge_intervals(frame(spark, a), stretch=stretch)))
        assert positions(got) == positions(a)
        assert all(x[0] != y[0] or x[2] + 1 < y[1] for x, y in zip(got, got[1:]))


def test_overlap_join_reports_each_pair_once_at_any_bin_size(spark):
    a = [(f"c{i % 2}", 7 * i + 1, 7 * i + 1 + (i * 13) % 90) for i in range(80)] + [("c0", 1, 5000)]
    b = [(f"c{i % 2}", 11 * i + 1, 11 * i + 1 + (i * 7) % 60) for i in range(60)] + [("c0", 40, 40)]
    want = sorted((x, y) for x in set(a) for y in set(b) if x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2])
    for size, long in ((10, False), (1000, False), (8, True)):
        j = iv.overlap_join(frame(spark, sorted(set(a))), frame(spark, sorted(set(b))), bin_size=size, long_intervals=long)
        got = sorted(((r.a_chrom, r.a_start, r.a_end), (r.b_chrom, r.b_start, r.b_end)) for r in j.collect())
        assert got == want


def test_subtract_keeps_columns_and_repeated_rows(spark):
    a = spark.createDataFrame([("c", 1, 10, "x"), ("c", 1, 10, "x"), ("d", 5, 6, None)], "chrom string, start long, end long, name string")
    b = frame(spark, [("c", 3, 4), ("c", 4, 6)])
    got = sorted((r.chrom, r.start, r.end, r.name or "") for r in iv.subtract_intervals(a, b).collect())
    assert got == [("c", 1, 2, "x"), ("c", 1, 2, "x"), ("c", 7, 10, "x"), ("c", 7, 10, "x"), ("d", 5, 6, "")]


def test_nearest_signs_and_ties(spark):
    a = spark.createDataFrame([("c", 10, 12, 1), ("c", 30, 31, 2), ("c", 20, 20, 3), ("d", 1, 2, 4)], "chrom string, start long, end long, aid long")
    b = spark.createDataFrame([("c", 15, 15, "+", 7), ("c", 25, 25, "-", 8)], "chrom string, start long, end long, strand string, bid long")
    got = {r.aid: (r.bid, r.distance) for r in iv.nearest(a, b, "aid", "bid").collect()}
    assert got == {1: (7, -3), 2: (8, -5), 3: (7, 5)}


def test_empty_inputs(spark):
    none = frame(spark, [])
    a = frame(spark, [("c", 1, 5)])
    assert rows_of(iv.merge_intervals(none)) == []
    assert rows_of(iv.subtract_intervals(a, none)) == [("c", 1, 5)]
    assert iv.overlap_join(a, none).count() == 0


def test_ranges_round_trip(spark):
    p = spark.createDataFrame([(1, v) for v in (1, 2, 3, 9, 11, 12)], "g long, v long")
    text = iv.format_ranges(iv.points_to_ranges(p, ["g"], "v"), ["g"])
    assert text.first().ranges == "1-3,9,11-12"
    assert sorted((r.start, r.end) for r in iv.parse_ranges(text, "ranges").collect()) == [(1, 3), (9, 9), (11, 12)]

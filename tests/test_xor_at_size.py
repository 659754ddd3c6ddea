"""The symmetric difference from the changes of both sides: no subtraction, and the positions that it should hold."""

import random

import pytest

from locuspark.operators import intervals as iv


@pytest.mark.parametrize("stretch", [7, 40, iv.STRETCH])
def test_xor_is_what_one_side_covers(spark, monkeypatch, stretch):
    monkeypatch.setattr(iv, "subtract_intervals", lambda *a, **k: pytest.fail("both sides were subtracted"))
    rng = random.Random(stretch)
    some = lambda: [(rng.choice("cd"), s := rng.randint(1, 300), s + rng.randint(0, 20)) for _ in range(25)]
    left, right = some() + [("c", 400, 409), ("e", 5, 9), ("f", 1, 3)], some() + [("c", 410, 420), ("e", 5, 9), ("g", 2, 2)]
    place = "chrom string, start long, end long"
    got = sorted(map(tuple, iv.interval_xor(spark.createDataFrame(left, place), spark.createDataFrame(right, place), stretch).collect()))
    cover = lambda rows: {(c, p) for c, s, e in rows for p in range(s, e + 1)}
    assert cover(got) == cover(left) ^ cover(right)
    assert all(x[0] != y[0] or x[2] + 1 < y[1] for x, y in zip(got, got[1:])) and ("c", 400, 420) in got and len(got) > 20


def test_xor_of_plain_tables(spark):
    place = "chrom string, start int, end int"
    a, none = spark.createDataFrame([("c", 3, 8), ("c", 9, 9), ("c", 20, 10)], place), spark.createDataFrame([], place)
    assert [tuple(r) for r in iv.interval_xor(a, none).collect()] == [("c", 3, 9)] and iv.interval_xor(a, a).count() == 0

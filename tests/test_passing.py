"""Placements made where they are used: the same rows as those that meet by joins, and no shuffle of placements."""

import contextlib
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from locuspark.operators import passing
from locuspark.operators import shuffle as sh


def tables(spark):
    rng = random.Random(11)
    te = [(2**60 + i, rng.choice(["c", "d", "none"]), 1 + i, 1 + i + rng.choice([3, 20, 90, 400])) for i in range(500)]
    sizes = [("c", 30_000), ("d", 9_000), ("empty", 70)]
    excl = [(c, s, s + rng.randint(1, 300)) for c, n in sizes[:2] for s in range(40, n, 700)]
    sites = [(i, rng.choice(["c", "d"]), p := rng.randint(1, 9_000), p, rng.choice(["+", "-", None])) for i in range(60)]
    place = "chrom string, start long, end long"
    return (
        spark.createDataFrame(te, f"te_id long, {place}").withColumn("rname", F.concat(F.lit("n"), F.col("te_id") % 7)),
        spark.createDataFrame(sizes, "chrom string, length long"),
        spark.createDataFrame(excl, place),
        spark.createDataFrame(sites, f"tss_id long, {place}, strand string"),
    )


def planned(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


MADE = {
    "exact": lambda te, sizes, excl, tss: sh.shuffle_random(te.drop("rname"), sizes, 3, excl, first=2),
    "apart": lambda te, sizes, excl, tss: sh.shuffle_random(te.drop("rname").where("te_id % 20 = 0"), sizes, 2, no_overlap=True, first=2),
    "positions": lambda te, sizes, excl, tss: sh.shuffle_positions(te, sizes, 3, seed=4, first=2),
    "tss": lambda te, sizes, excl, tss: sh.shuffle_tss(te, tss, sizes, 3, seed=4, first=2),
}


@pytest.mark.parametrize("name", MADE)
def test_same_placements_without_a_shuffle(spark, monkeypatch, name):
    made = MADE[name](*tables(spark))
    plan = planned(made)
    assert "MapInArrow" in plan and "Exchange hashpartitioning" not in plan[: plan.index("MapInArrow")]  # above it nothing is dealt again
    rows = lambda d: sorted(map(tuple, d.select("te_id", "chrom", "start", "end", "round").collect()))
    got = rows(made)
    monkeypatch.setattr(passing, "HELD_BYTES", 0)
    joined = MADE[name](*tables(spark))
    assert "MapInArrow" not in planned(joined)
    assert got == rows(joined) and len(got) > 20


def test_parts_of_a_chromosome_give_what_the_whole_gives(spark, monkeypatch):
    rows = lambda d: sorted(map(tuple, d.select("te_id", "chrom", "start", "end", "round").collect()))
    whole = rows(MADE["exact"](*tables(spark)))
    monkeypatch.setattr(passing, "PASSING", 10)
    assert rows(MADE["exact"](*tables(spark))) == whole


def test_tolerant_placements_are_kept_apart_from_what_is_left(spark):
    te, sizes, excl, _ = tables(spark)
    out = sh.shuffle_random(te, sizes, 3, excl, max_excl_fraction=0.2)
    plan = planned(sh.shuffle_random(te.drop("rname"), sizes, 3, excl, max_excl_fraction=0.2))
    assert "MapInArrow" in plan and "FlatMapCoGroups" not in plan
    bad = {c: np.zeros(31_000, bool) for c in "cd"}
    for r in excl.collect():
        bad[r.chrom][r.start : r.end + 1] = True
    got = out.collect()
    assert len(got) == 3 * te.where("chrom <> 'none'").count() and {r.rname for r in got} == {f"n{i}" for i in range(7)}
    lengths = {"c": 30_000, "d": 9_000}
    assert all(1 <= r.start and r.end <= lengths[r.chrom] and bad[r.chrom][r.start : r.end + 1].sum() <= int(0.2 * (r.end - r.start + 1)) for r in got)


def test_keys_are_those_of_spark(spark):
    rows = spark.range(50).select((F.col("id") * 987654321987 - 5).alias("te_id"), F.lit(7).cast("long").alias("round"))
    for seeds in ((3,), (3, -1), (2**40,)):
        got = rows.select(F.xxhash64("te_id").alias("own"), F.xxhash64("te_id", "round", *map(F.lit, seeds)).alias("k")).toPandas()
        assert (passing.drawn_key(got.own.to_numpy(), 7, *seeds) == got.k.to_numpy()).all()

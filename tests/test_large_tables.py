"""Steps that must not grow with rounds or groups: their results against the plain computation."""

import random

from pyspark.sql import functions as F

from locuspark.operators import enrich as en
from locuspark.operators import shuffle as sh
from locuspark.operators.intervals import overlap_join
from locuspark.operators.model import seeded_key


def repeats(spark, n=4000, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = rng.randint(1, 900_000)
        long = rng.choice([120_000, 300_000]) if i % 500 == 0 else rng.randint(20, 600)
        rows.append((i * 3, f"chr{i % 3}", start, start + long))
    return spark.createDataFrame(rows, "te_id long, chrom string, start long, end long")


def test_permutation_backwards(spark):
    n = 997
    d = spark.range(n).select(F.col("id").alias("i"), F.lit(n).cast("long").alias("n"), F.explode(F.array(F.lit(1).cast("long"), F.lit(9).cast("long"))).alias("r"))
    d = d.withColumn("j", sh.permutation(3)("i", "n", "r")).withColumn("k", sh.permutation(3, back=True)("j", "n", "r"))
    assert d.where("k <> i").count() == 0
    assert d.select("r", "j").distinct().count() == 2 * n


def test_placements_near_features_hold_every_hit_and_few_others(spark):
    te = repeats(spark)
    sizes = spark.createDataFrame([("chr0", 700_000), ("chr1", 1_300_000), ("chr2", 900_500)], "chrom string, length long")
    near = spark.createDataFrame([("chr0", 1, 90), ("chr0", 400_000, 400_300), ("chr1", 650_000, 651_000), ("chr2", 900_300, 900_480), ("chr2", 5, 2_000)], "chrom string, start long, end long")
    whole = sh.shuffle_positions(te, sizes, 6, seed=4)
    some = sh.shuffle_positions(te, sizes, 6, seed=4, near=near)
    rows = lambda d: {tuple(r) for r in d.select("round", "te_id", "chrom", "start", "end").collect()}
    hits = lambda d: sorted(map(tuple, overlap_join(d, near).select("a_round", "a_te_id", "a_start", "a_end", "b_start", "overlap").collect()))
    assert hits(some) == hits(whole) and len(hits(some)) > 50
    assert rows(some) < rows(whole)
    assert some.count() == len(rows(some)) < whole.count() / 10


def test_no_repeats_near_anything(spark):
    te = repeats(spark, 5).where("te_id < 0")
    sizes = spark.createDataFrame([("chr0", 700_000)], "chrom string, length long")
    assert sh.shuffle_positions(te, sizes, 3, near=sizes.selectExpr("chrom", "1L AS start", "9L AS end")).count() == 0


def test_keys_of_ids_beyond_the_product_of_64_bits(spark):
    ids = [5, 9_000_000_000, 2**62 + 11]
    got = spark.createDataFrame([(i,) for i in ids], "id long").select("id", seeded_key(F.col("id"), F.lit(4), 7).alias("k")).collect()
    for r in got:
        x = (r.id * 1103515245 + 4 * 12345 + 7) % 2147483648
        assert r.k == x * (x % 65521 + 5) % 2147483647


def test_draws_by_blocks_of_gaps_are_those_of_all_starts(spark):
    rng = random.Random(8)
    gaps, at = [], {"c1": 1, "c2": 1}
    for i in range(60):
        c, n = rng.choice(["c1", "c2"]), rng.randint(1, 40)
        gaps.append((c, at[c], at[c] + n - 1))
        at[c] += n + 3
    items = [(rng.choice(["c1", "c2"]), i, 1 + i % 3, rng.randint(0, 45)) for i in range(500)]
    d = spark.createDataFrame(items, "chrom string, te_id long, round long, _span long")
    keys = {r.te_id: r.k for r in d.select("te_id", F.xxhash64("te_id", "round", F.lit(6)).alias("k")).collect()}
    g = spark.createDataFrame(gaps, "chrom string, start long, end long")
    got = {r.te_id: (r._gap, r._new) for r in sh._draw_exact(d, g, ["chrom"], 6, block=4).collect()}
    want = {}
    for c, i, _, span in items:
        starts = [(s, p) for _, s, e in sorted((s - e, s, e) for x, s, e in gaps if x == c) for p in range(s, e - span + 1)]
        if starts:
            want[i] = starts[keys[i] % len(starts)]
    assert got == want and 0 < len(want) < 500


def test_repeats_as_they_are_come_from_the_same_pass(spark):
    te = repeats(spark).withColumns({"rclass": F.concat(F.lit("c"), F.col("te_id") % 3), "rfam": F.lit("f"), "rname": F.when(F.col("te_id") % 7 > 0, F.concat(F.lit("n"), F.col("te_id") % 7))})
    te = te.unionByName(spark.createDataFrame([(99_999, "other", 5, 90, "c1", "f", None)], te.schema))  # a chromosome without a length
    te = te.unionByName(spark.createDataFrame([(99_998, "chr0", 700_100, 700_900, "c1", "f", "n1")], te.schema))  # beyond the end
    sizes = spark.createDataFrame([("chr0", 700_000), ("chr1", 1_300_000), ("chr2", 900_500)], "chrom string, length long")
    near = spark.createDataFrame([("a", "chr0", 1, 90), ("b", "chr0", 400_000, 400_300), ("c", "chr0", 700_500, 700_600), ("d", "chr2", 5, 2_000), ("e", "other", 60, 99)], "feature string, chrom string, start long, end long")
    keep = ("chrom", "start", "end", *en.LEVELS)
    both = sh.shuffle_positions(te, sizes, 4, seed=4, keep=keep, near=near, as_they_are=True)
    obs, exp = en.observed_and_expected(both, near, ["feature"])
    rows = lambda d: sorted(map(str, d.select(*[c for c in (*en.LEVELS, "hits", "round") if c in d.columns]).collect()))
    assert rows(obs) == rows(en.observed_hits(te, near, ["feature"])) and len(rows(obs)) > 10
    assert rows(exp) == rows(en.observed_hits(sh.shuffle_positions(te, sizes, 4, seed=4, keep=keep), near, ["feature"], extra=("round",)))
    assert both.where("round IS NULL").count() < te.count() / 10

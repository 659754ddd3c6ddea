"""Enrichment tests: work that must not grow with the genome, the rounds or the levels, and the results it must still give."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from locuspark.functions import binomial as bi
from locuspark.operators import compose as cm
from locuspark.operators.model import pick_transcript


@pytest.mark.parametrize("x, n, low, high", [(300, 10_000, 0.02674401378941485, 0.03353336420521941), (18_000, 600_000, 0.0295697997081393, 0.0304347463003537), (18_000, 36_000_000, 0.0004927237771996, 0.0005073567423200)])
def test_limits_need_few_outcomes(monkeypatch, x, n, low, high):
    seen, plain = [], bi._log_pmf
    monkeypatch.setattr(bi, "_log_pmf", lambda n, p, lo, hi: seen.append(hi - lo + 1) or plain(n, p, lo, hi))
    got = bi.clopper_pearson(x, n)
    assert got == pytest.approx((low, high), rel=1e-11)
    assert sum(seen) < 50_000


def test_limits_are_those_of_exact_sums():
    from fractions import Fraction
    from math import comb

    for x, n in [(0, 5), (1, 7), (5, 7), (6, 7), (7, 7), (3, 40), (39, 40)]:
        low, high = bi.clopper_pearson(x, n)
        tail = lambda p, ks: float(sum(comb(n, k) * Fraction(p) ** k * (1 - Fraction(p)) ** (n - k) for k in ks))  # noqa: E731, B023
        assert low == 0.0 if x == 0 else tail(low, range(x, n + 1)) == pytest.approx(0.025, rel=1e-11)
        assert high == 1.0 if x == n else tail(high, range(x + 1)) == pytest.approx(0.025, rel=1e-11)


def planned(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_picks_are_the_least_keys_and_rounds_are_not_sorted(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(30)]), tr, rng.randint(1, 9)) for tr in rng.sample(range(10**12), 200)]
    index = spark.createDataFrame(rows, "gene long, tr long, n_exons long")

    def key(tr, r):
        x = (tr % 2147483648 * 1103515245 + r * 12345 + 5) % 2147483648
        return x * (x % 65521 + r + 1) % 2147483647, tr

    want = {(r, g, *min((t for t in rows if t[0] == g), key=lambda t: key(t[1], r))[1:]) for r in (1, 2, 3) for g in {t[0] for t in rows}}
    picked = pick_transcript(index, 3, seed=5)
    assert {tuple(r) for r in picked.select("round", "gene", "tr", "n_exons").collect()} == want
    assert "Window" not in planned(picked)


def test_levels_are_made_of_sets_of_kinds(spark):
    rng = random.Random(9)
    rows = [(1 + i % 2, rng.randint(0, 60), c := rng.choice("ab"), c + rng.choice("xy"), rng.choice(["n1", "n2", None]), a := rng.choice([None, "old"]), a and rng.choice([None, "new"])) for i in range(400)]
    hits = spark.createDataFrame(rows, "round int, feature int, rclass string, rfam string, rname string, age1 string, age2 string")
    want = {}
    for r, f, c, m, n, a, b in rows:
        levels = [("tot", "tot", "tot"), (c, "tot", "tot"), (c, m, "tot"), (c, m, n)]
        aged = [("age", "cat.1", "tot"), ("age", "cat.2", "tot"), ("age", "cat.1", a), *([("age", "cat.2", b)] if b else [])] if a else []
        for level in levels + aged:
            want.setdefault((r, *level), set()).add(f)
    got = cm.hits_by_level(hits, ["feature"], ["round"], aged=True)
    assert {tuple(r)[:-1]: r.hits for r in got.select("round", "rclass", "rfam", "rname", "hits").collect()} == {k: len(v) for k, v in want.items()}
    plan = planned(got)
    assert plan.index("Generate explode") < plan.index("collect_set")  # above it: levels are made after equal sets are counted
    assert got.where(F.col("hits") <= 0).isEmpty()

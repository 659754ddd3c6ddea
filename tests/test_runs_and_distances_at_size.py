"""Runs of N and distances of transcripts: what is dealt again stays small, and the results are those of the plain computation."""

import contextlib
import io
import random
import re

from locuspark.functions import sequences as sq
from locuspark.operators import model as md


def planned(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_runs_of_n_whole_and_across_chunks(spark):
    rng = random.Random(2)
    seqs = [(f"s{i}", "".join(rng.choice(["A", "c", "é", "N" * rng.randint(1, 25), "n", "ß"]) for _ in range(rng.randint(0, 60)))) for i in range(30)]
    seqs += [("all", "N" * 95), ("none", "ACGT"), ("empty", ""), ("null", None)]
    chunks = sq.chunked(spark.createDataFrame(seqs, "chrom string, seq string"), 10)
    want = sorted((c, m.start() + 1, m.end()) for c, s in seqs for m in re.finditer("[Nn]+", s or "") if m.end() - m.start() >= 3)
    got = sq.n_runs(chunks, 3)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100
    assert "Generate" not in planned(got)  # runs come from the chunks as they are; none was dealt again by its chunk
    inner = spark.createDataFrame([("x", 1, "ACNNGTNAAC")], "chrom string, start long, seq string")
    assert sq.n_runs(inner, 3).count() == 0 and [tuple(r) for r in sq.n_runs(inner, 2).collect()] == [("x", 3, 4)]


def test_distances_of_genes_are_those_of_pairs(spark):
    rng = random.Random(6)
    rows = [(tr % 9, tr, rng.choice(["c", "c", "d"]), s := rng.randint(1, 400), s + rng.randint(0, 120)) for tr in range(40) for _ in range(rng.randint(1, 5))]
    rows += [(3, 1, "c", 50, 60), (None, 77, "c", 1, 9), (None, 78, "c", 1, 9)]  # a transcript of two genes, and two of none
    exons = spark.createDataFrame(rows, "gene int, tr int, chrom string, start long, end long")
    made = md.gene_aed(exons)
    found = lambda d: sorted((r.gene, r.tr_a, r.tr_b, round(r.aed, 12)) for r in d.collect())
    assert found(made) == found(md.aed(md.transcript_pairs(exons), exons)) and made.count() > 50
    plan = planned(made)
    assert "tr_a" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)  # no pair is dealt again

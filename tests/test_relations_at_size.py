"""Relations of features and line items: what is written and sent must not grow with the levels above a leaf."""

import os

import pytest
from pyspark.sql import functions as F

from locuspark.operators import annotation as an
from locuspark.plans.fixtures import Fixtures
from locuspark.sources import writers as wr

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def hierarchy(spark):
    rows = [("g1", None, "gene"), ("g2", None, "gene"), ("g3", None, "gene"), ("t1", "g1", "mRNA"), ("t2", "g2", "transcript"), ("u2", "t2", "part"), ("c9", "u2", "CDS")]
    rows += [(f"e{i}", "t1" if i % 2 else "u2", "exon") for i in range(300)]
    att = F.when(F.col("p").isNull(), F.create_map(F.lit("ID"), F.array("feature_id"))).otherwise(F.create_map(F.lit("ID"), F.array("feature_id"), F.lit("Parent"), F.array("p")))
    return spark.createDataFrame(rows, "feature_id string, p string, type string").withColumn("attributes", att).drop("p")


@pytest.fixture
def sizes(monkeypatch):
    out, real = [], an.checkpoint
    monkeypatch.setattr(an, "checkpoint", lambda df: (lambda d: (out.append(d.count()), d)[1])(real(df)))
    return out


def test_flags_of_all_levels_without_pairs_of_leaves(spark, sizes):
    f = hierarchy(spark)
    got = {r.feature_id: (r.has_mrna, r.has_cds, r.is_coding) for r in an.coding_flags(f, an.relations(f)).collect()}
    assert got == {"g1": (True, False, True), "g2": (False, True, True), "g3": (False, False, False)}
    assert max(sizes) < 20


def test_children_of_all_levels_without_pairs_of_leaves(spark, sizes):
    f = hierarchy(spark)
    got = {r.feature_id for r in wr.with_children(f, f.where("feature_id IN ('g2', 'g3')")).collect()}
    assert got == {"g2", "g3", "t2", "u2", "c9"} | {f"e{i}" for i in range(0, 300, 2)}
    assert max(sizes) < 20


def test_descendants_write_each_relation_once(spark, sizes):
    rel = an.relations(hierarchy(spark))
    assert an.descendants(rel).count() == 304 + 150 + 1 + 151 + 151  # of depth 1; deeper ones of g1, u2 of g2, those below u2 of t2 and of g2
    assert sum(sizes) < 330


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_line_items_cross_the_network_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Fixtures(spark, SF).exon._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(") == 4  # customers, orders twice, line items

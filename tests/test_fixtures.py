"""Derived tables: how their shuffles are dealt, and the coding parts from a transcript's own rows."""

from locuspark.plans import fixtures as fs


def test_shuffles_are_dealt_by_rows_of_the_tables(spark, monkeypatch):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    kept = {n: spark.conf.get(n) for n in names}
    try:
        fx = fs.Fixtures(spark, "/root/testdata/sf0.001")
        rows = fx.table("lineitem").count()
        assert {n: spark.conf.get(n) for n in names} == kept  # small tables change nothing
        monkeypatch.setattr(fs, "TASK_ROWS", 200)
        fs.Fixtures(spark, "/root/testdata/sf0.001").table("lineitem")
        assert int(spark.conf.get(names[0])) == -(-rows // 200)
        assert spark.conf.get(names[1]) == fs.TASK_READ
        fs.Fixtures(spark, "/root/testdata/sf0.001").table("customer")
        assert int(spark.conf.get(names[0])) == -(-rows // 200)  # never fewer again
    finally:
        for n, v in kept.items():
            spark.conf.set(n, v)


def test_coding_parts_need_no_join(spark):
    fx = fs.Fixtures(spark, "/root/testdata/sf0.001")
    exon, tr = fx.raw("exon"), fx.raw("tr")
    want = spark.sql(fs.DERIVED["cds"][1], exon=exon, tr=tr)
    got = fx.raw("cds")
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    joins = lambda d: d._jdf.queryExecution().optimizedPlan().toString().count("Join Inner")
    assert joins(got) == joins(exon) < joins(want)

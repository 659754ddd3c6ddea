"""All queries of the library and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locuspark.plans.fixtures import Fixtures, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, *needs: str, sql: str | None = None):
    """Register a function of the derived tables as a query; ``sql`` is its DuckDB body over the fixtures named."""

    def add(make: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = make(Fixtures(spark, sf_dir))
            return out.withColumnsRenamed({"start": "st", "end": "en"})

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = oracle(*needs, body=sql)
        return make

    return add


from locuspark.plans import annotation_queries, composition_queries, enrichment_queries, interval_queries, model_queries, source_queries, statistics_queries  # noqa: E402,F401

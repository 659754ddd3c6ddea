"""Put the reports of many runs side by side: long tables, zero-filled grids and wide tables."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.storage import if_small


def merge_summaries(runs: dict[str, DataFrame]) -> DataFrame:
    """One long table with the run's name as a column."""
    tagged = [df.select(F.lit(name).alias("run"), *df.columns) for name, df in runs.items()]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def region_label(col: Column) -> Column:
    """Region of a run's file name: 01.up, 02.exons, 02.CDS, 02.UTR, 03.dw or 04.introns by its ending, nd if it has none of them."""
    return region_of_run(col)[1]


#: Endings of a run's file name and the region each one stands for (fixed values).
REGIONS = (
    (r"^(.*)\.UTRs$", "02.UTR"),
    (r"^(.*)\.CDS$", "02.CDS"),
    (r"^(.*)\.dw\..+?\.corr$", "03.dw"),
    (r"^(.*)\.up\..+?\.corr$", "01.up"),
    (r"^(.*)\.introns\..+?$", "04.introns"),
    (r"^(.*)\.exons$", "02.exons"),
)


def region_of_run(col: Column) -> tuple[Column, Column]:
    """(name, region) of a run's file name; both nd if it does not end as one of the feature sets does."""
    name, region = F.lit("nd"), F.lit("nd")
    for rule, label in reversed(REGIONS):
        name, region = F.when(col.rlike(rule), F.regexp_extract(col, rule, 1)).otherwise(name), F.when(col.rlike(rule), label).otherwise(region)
    return name, region


def merge_class_tables(long: DataFrame, classes: Sequence[str], value: str = "value") -> DataFrame:
    """(run, region, metric, one column per class), zero where a run lacks one."""
    return long.withColumn("region", region_label(F.col("run"))).groupBy("run", "region", "metric").pivot("class6", list(classes)).agg(F.sum(value)).fillna(0)


def filled_grid(long: DataFrame, keys: Sequence[Sequence[str]], values: Sequence[str], fill: float = 0) -> DataFrame:
    """All combinations of the given key sets' distinct values, ``fill`` where the table has no row.

    The key sets are report dimensions (runs, types, categories), few rows each.
    """
    sides = [long.select(*k).distinct() for k in keys]
    spine = functools.reduce(lambda a, b: a.join(if_small(b, b.count(), 100_000), F.lit(True)), sides)  # the grid is their product
    flat = [c for k in keys for c in k]
    return spine.join(long, flat, "left").select(*flat, *[F.coalesce(F.col(v), F.lit(fill)).alias(v) for v in values])


def merge_age_tables(long: DataFrame) -> DataFrame:
    """Amounts per age as a share of their run's set, zero-filled over run x type x category."""
    share = long.withColumn("pct", 100 * F.col("amount") / F.col("set_len"))
    return filled_grid(share, [["run"], ["type", "category"]], ["amount", "pct"])


def run_subset(col: Column) -> tuple[Column, Column]:
    """A run's file name without its last two parts, and these (filter.parse), which name its subset.

    A name of fewer than three parts is all subset; a missing filter is empty.
    """
    p = F.split(col, r"\.")
    name = F.when(F.size(p) > 2, F.array_join(F.slice(p, 1, F.greatest(F.size(p) - 2, F.lit(0))), ".")).otherwise(F.lit(""))
    return name, F.when(F.size(p) > 1, F.substring_index(col, ".", -2)).otherwise(F.concat(F.lit("."), col))


def merge_enrichment(long: DataFrame, runs: Sequence[str], values: Sequence[str] = ("obs", "p")) -> DataFrame:
    """One row per repeat, a column per run and value; zero for absent counts, null for absent p-values."""
    wide = long.groupBy("rclass", "rfam", "rname").pivot("run", list(runs)).agg(*[F.max(v).alias(v) for v in values])
    keys = ("rclass", "rfam", "rname")
    value = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(0)) if c.endswith("_obs") else F.col(f"`{c}`")
    return wide.select(*keys, *[value(c).alias(c) for c in wide.columns if c not in keys])


def enrichment_matrix(long: DataFrame, n: int) -> DataFrame:
    """Add direction (by the permutation rank) and odds (observed over expected, null for nothing expected)."""
    half = F.col("rank") <= n / 2
    return long.withColumns({"direction": F.when(half, "DEPLETED").otherwise("ENRICHED"), "odds": F.when(F.col("exp") > 0, F.col("obs") / F.col("exp"))})

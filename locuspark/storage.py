"""The folder that driver and executors share, for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a temporary folder on a local master, else an error.

    Executors of a cluster do not see the driver's temporary folder, so there is no fallback there.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if sc.applicationId not in _LOCAL:
        _LOCAL[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="locuspark-")
    return _LOCAL[sc.applicationId]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def if_small(df: DataFrame, rows: int, most: int = 1_000_000) -> DataFrame:
    """Broadcast a side of few columns whose counted rows are few; beyond that the join shuffles."""
    return F.broadcast(df) if rows <= most else df


def ordinals(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add _i: each row's place (from 0) among those of equal ``by`` in the given order, and _n, how many those are.

    Rows are sorted once over all partitions, by ranges, and written; a row's place is its running number within
    its partition, less the first one of its ``by`` there, plus the rows of its ``by`` in the partitions before.
    No task holds a group and nothing is asked of the order's type. Equal rows take places in any order.
    """
    by = list(by)
    spread = checkpoint(df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33).alias("_part")
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = spread.groupBy(*by, part).agg(F.min("_m").alias("_low"), F.count(F.lit(1)).alias("_k"))  # a row per partition and per group at most
    held = checkpoint(held.select(*by, "_part", (F.coalesce(F.sum("_k").over(earlier), F.lit(0)) - F.col("_low")).alias("_shift"), F.sum("_k").over(Window.partitionBy(*by)).alias("_n")))
    out = spread.withColumn("_part", part).join(if_small(held, held.count()), [*by, "_part"])
    return out.withColumn("_i", F.col("_m") + F.col("_shift")).drop("_m", "_part", "_shift")

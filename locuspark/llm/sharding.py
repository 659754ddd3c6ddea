"""Sharding: sampled splitters cut the key order into ranges, ranges into shards of equal bytes.

Keys are (hash of the text, doc_id, number of the row), so equal texts are neighbours and no
key is shared: rows of one text and id, or of none, are cut like any others. A size-weighted
sample of keys gives quantile boundaries; ranges that turn out overfull are sampled again and
subdivided. Exact range totals (one row per range) then place every record: its place in
the order of all bytes decides its shard, its place in the order of all rows its slot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuspark.llm.shared import checkpoint


def weighted_splitters(records: DataFrame, ranges: int, per_range: int = 24, seed: int = 5) -> list[tuple[int, int, int]]:
    """At most ``ranges - 1`` boundary keys (h, doc_id, row) at quantiles of a size-weighted sample.

    A record is drawn with a chance in proportion to its size; the sample's expected
    number of rows is ranges x per_range whatever the input, so the driver's part is bounded.
    """
    total = records.agg(F.sum("size")).first()[0]
    if not total:
        return []
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(ranges * per_range / total))
    draw = F.pmod(F.xxhash64("h", "doc_id", "row", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    got = records.where(draw < chance).select("h", "doc_id", "row", (F.col("size") / chance).alias("w")).collect()
    got = sorted((r["h"], -(1 << 63) if r["doc_id"] is None else r["doc_id"], r["row"], r["w"]) for r in got)
    if not got:
        return []
    cum = np.cumsum([w for *_, w in got])
    at = np.searchsorted(cum, cum[-1] * np.arange(1, ranges) / ranges)
    return sorted({got[min(i, len(got) - 1)][:3] for i in at})


def keys_below(splitters: list[np.ndarray], keys: list[np.ndarray]) -> np.ndarray:
    """How many splitters are at or below each key; splitters and keys are columns, splitters in ascending order."""
    if len(splitters) == 1:
        return np.searchsorted(splitters[0], keys[0], "right")
    low, high = (np.searchsorted(splitters[0], keys[0], side) for side in ("left", "right"))
    at = low.copy()
    for k in np.unique(low[low < high]):  # keys whose first column is that of splitters: the other columns decide
        same = (low == k) & (high > k)
        end = high[same][0]
        at[same] = k + keys_below([s[k:end] for s in splitters[1:]], [c[same] for c in keys[1:]])
    return at


def with_range(records: DataFrame, splitters: list[tuple[int, int, int]]) -> DataFrame:
    """Add ``rng``: how many splitters are at or below the key."""
    if not splitters:
        return records.withColumn("rng", F.lit(0))

    columns = [np.array(x, np.int64) for x in zip(*splitters, strict=True)]

    @F.pandas_udf("int")
    def find(h: pd.Series, d: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series(keys_below(columns, [x.to_numpy(np.int64) for x in (h, d, r)]).astype(np.int32))

    return records.withColumn("rng", find("h", F.coalesce("doc_id", F.lit(-(1 << 63))), "row"))


def shard_by_bytes(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", range_rows: int = 2_000_000, rounds: int = 8
) -> DataFrame:
    """Law ``bytes``: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    Shards hold equal bytes to within one record, in the order of (text hash, doc_id), so a
    group of equal texts is split only where a shard is full. A null text counts as empty
    (size 1, crc 0); null ids sort first; repeated rows each get a slot; extra columns are
    ignored; an empty table gives no rows. The number of ranges follows from ``range_rows``,
    the rows (of some 40 bytes, without texts) that one task places; ranges are subdivided
    until none is overfull (``rounds`` at most: a round cuts an overfull range into eight).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    records = checkpoint(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.monotonically_increasing_id().alias("row"),  # kept by the checkpoint
        )
    )
    ranges = max(64, -(-records.count() // range_rows))
    splitters = weighted_splitters(records, ranges)
    for k in range(rounds):
        ranged = with_range(records, splitters)
        totals = ranged.groupBy("rng").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("size").alias("most")).collect()
        full = sum(r["bytes"] for r in totals)
        over = [r["rng"] for r in totals if r["n"] > 1 and r["bytes"] > 4 * full / ranges + 2 * r["most"]]
        if not over or k == rounds - 1:
            break
        more = weighted_splitters(ranged.where(F.col("rng").isin(over)), max(8, 8 * len(over)), seed=17 + k)
        if not set(more) - set(splitters):
            break
        splitters = sorted({*splitters, *more})
    totals = sorted((r["rng"], r["bytes"], r["n"]) for r in totals)
    at = {}
    bytes_before = rows_before = 0
    for rng, size, n in totals:
        at[rng] = (bytes_before, rows_before)
        bytes_before, rows_before = bytes_before + size, rows_before + n
    total = max(bytes_before, 1)
    first = [[r, *at[r]] for r in sorted(at)]
    offsets = docs.sparkSession.createDataFrame(first, "rng int, bytes_before long, rows_before long")
    w = Window.partitionBy("rng").orderBy("h", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("bytes_before") + F.col("upto") - F.col("size") / 2
    placed = checkpoint(
        ranged.join(F.broadcast(offsets), "rng")
        .withColumns({"upto": F.sum("size").over(w), "place": F.col("rows_before") + F.row_number().over(Window.partitionBy("rng").orderBy("h", "doc_id", "row")) - 1})
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / total)).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "place")
    )
    starts = placed.groupBy("shard").agg(F.min("place").alias("start"))
    return placed.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("start")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the records of each shard, in slot order, under path/shard=k, one file each per writing task."""
    rows = docs.join(placed.select(F.col("doc_id").alias(id_col), "shard", "slot"), id_col)
    spread = rows.repartition("shard", F.floor(F.col("slot") / 100_000))
    spread.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

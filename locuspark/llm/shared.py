"""What several operators share: shared storage, block joins over sorted runs, components."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.storage import checkpoint, shared_folder, shared_path  # noqa: F401

def if_small(df: DataFrame, rows: int, size: int = 0, most: int = 500_000, most_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast a side whose counted rows are few and whose texts (``size`` bytes in all) are short; beyond that the join shuffles."""
    return F.broadcast(df) if rows <= most and size <= most_bytes else df


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of few rows, so that a worker holds few texts as Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def column(batch: pa.RecordBatch, name: str) -> list:
    """A column as a Python list, nulls as None."""
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def whole_runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Batches of rows sorted by keys, cut anew so that no run of equal keys is split."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        if held:
            last = tuple(held[-1][k].iloc[-1] for k in keys)
            if tuple(batch[k].iloc[-1] for k in keys) == last:
                held.append(batch)
                continue
            batch = pd.concat([*held, batch], ignore_index=True)
        same = np.ones(len(batch), bool)
        for k in keys:
            same &= (batch[k] == batch[k].iloc[-1]).to_numpy()
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield batch.iloc[:cut].reset_index(drop=True)
        held = [batch.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def run_bounds(frame: pd.DataFrame, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of equal keys in sorted rows."""
    change = np.zeros(len(frame), bool)
    change[:1] = True
    for k in keys:
        v = frame[k].to_numpy()
        change[1:] |= v[1:] != v[:-1]
    starts = np.flatnonzero(change)
    return starts, np.append(starts[1:], len(frame))


def min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n nodes over the undirected edges a-b."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def block_rows(rows: DataFrame, slim: DataFrame, keys: list[str], most: int, salt: str) -> DataFrame:
    """Deal home rows (role 0) and visiting rows (role 1) of each key to blocks of bounded size.

    A key whose rows number at most ``most`` is one block. A hotter key is cut into a grid:
    home rows by ``salt`` into row blocks, visitors into column blocks, and each block pair
    is a task of its own, so every home row still meets every visitor, exactly once.
    ``slim`` holds keys and role of the same rows, for counting. ``hot`` says which keys were cut.
    """
    counted = slim.groupBy(*keys).agg(F.sum(1 - F.col("role")).alias("homes"), F.sum("role").alias("visits"))
    hot = checkpoint(
        counted.where((F.col("homes") > most) | (F.col("visits") > 4 * most)).select(
            *keys,
            F.ceil(F.col("homes") / most).cast("int").alias("nh"),
            F.ceil(F.col("visits") / (4 * most)).cast("int").alias("nv"),
        )
    )
    if hot.isEmpty():
        return rows.withColumns({"hb": F.lit(0), "vb": F.lit(0), "hot": F.lit(False)})
    at = F.xxhash64(salt, F.lit(11))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    one = lambda n: F.array(F.pmod(at, n).cast("int"))
    home = F.col("role") == 0
    nh, nv = F.coalesce("nh", F.lit(1)), F.greatest(F.coalesce("nv", F.lit(1)), F.lit(1))
    nh = F.greatest(nh, F.lit(1))
    return (
        rows.join(hot, keys, "left")
        .withColumn("hot", F.col("nh").isNotNull())
        .withColumn("hb", F.explode(F.when(home, one(nh)).otherwise(every(nh))))
        .withColumn("vb", F.explode(F.when(home, every(nv)).otherwise(one(nv))))
        .drop("nh", "nv")
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components: (node, component), component the smallest node reachable.

    ``edges`` has two long columns. Nodes without an edge to another node are not returned.
    Alternating large-star and small-star steps; each step's minimum is a partial
    aggregate and each join splits hot keys under AQE, so a hub is never one task.
    Lineage is cut by a reliable checkpoint every round; only two numbers reach the driver.
    """
    a, b = edges.columns
    both = edges.where(F.col(a) != F.col(b))
    now = checkpoint(both.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    mark = lambda d: d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    before = mark(now)
    while before[0]:
        around = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = around.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            around.join(least, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("hi"), F.least("m", "u").alias("lo"))
            .distinct()
        )
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = checkpoint(small.union(low.select("hi", F.col("m").alias("lo"))).distinct())
        after = mark(now)
        if after == before:
            break
        before = after
    top = now.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(top)


_SAFE = re.compile(r"(?<=\S) (?=\S)")


def text_blocks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A text in blocks of about ``size`` characters, cut at a space between two words.

    The space starts the next block. A text without such a space is one block.
    """
    at = 0
    while len(text) - at > size:
        found = _SAFE.search(text, at + size)
        if not found:
            break
        cut = found.start()
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text

"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations.

Vectors are rotated by three rounds of random signs and a Walsh-Hadamard transform; the
largest coordinate and its sign is the cross-polytope code. K codes make one bucket, and
each of L tables is visited at the home bucket and at its likeliest neighbours
(multiprobe). Buckets are compared exactly, in double precision, block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from locuspark.llm.shared import block_rows, checkpoint, components, min_labels, run_bounds, whole_runs

#: Vectors that one task hashes, and widths that are planned before.
HASHED, PLANNED = 20_000, 8
#: Rows of one block of a bucket, rows that a bucket is meant to hold, and tables beyond which shorter codes are taken.
BLOCK, FILL, MOST_TABLES = 1024, 128, 60


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        pair = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x


def padded_width(width: int) -> int:
    """The power of two that vectors are padded to; at least 32, as signs give narrow ones too few rotations."""
    return 1 << max(5, (width - 1).bit_length())


def bucket_codes(x: np.ndarray, tables: int, codes: int, probes: int, seed: int = 7) -> np.ndarray:
    """Bucket ids of 32 bits, shape (rows, tables, probes); the first of each table is the home bucket."""
    n, width = x.shape
    if not codes:
        return np.zeros((n, tables, probes), np.uint32)
    d = padded_width(width)
    padded = np.zeros((n, d))
    padded[:, :width] = x
    out = np.empty((n, tables, probes), np.uint32)
    for t in range(tables):
        best = np.empty((codes, 3, n), np.int64)
        loss = np.empty((codes, 3, n))
        for k in range(codes):
            sign = np.random.default_rng([seed, t, k]).choice([-1.0, 1.0], size=(3, d))
            y = padded
            for r in range(3):
                y = hadamard(y * sign[r]) / math.sqrt(d)
            size = np.abs(y)
            order = np.argsort(-size, axis=1, kind="stable")[:, :3]
            if order.shape[1] < 3:
                order = np.pad(order, ((0, 0), (0, 3 - order.shape[1])), mode="edge")
            value = np.take_along_axis(y, order, axis=1)
            best[k] = (2 * order + (value < 0)).T
            top = np.abs(value)
            loss[k] = ((top[:, :1] - top) ** 2).T
        choices = [tuple([0] * codes)]
        for k in range(codes):
            choices += [tuple(j if i == k else 0 for i in range(codes)) for j in (1, 2)]
            choices += [tuple(1 if i in (k, m) else 0 for i in range(codes)) for m in range(k)]
        cost = np.stack([sum(loss[k, c[k]] for k in range(codes)) for c in choices])
        cost[0] = -1
        bucket = np.stack([sum(best[k, c[k]] * (2 * d) ** k for k in range(codes)) for c in choices])
        bucket = (bucket ^ (bucket >> 32)) & 0xFFFFFFFF  # folded alike for all, so that equal codes stay equal
        take = np.argsort(cost, axis=0, kind="stable")[:probes]
        out[:, t, : len(take)] = np.take_along_axis(bucket, take, axis=0).T
        out[:, t, len(take) :] = out[:, t, :1]
    return out


@lru_cache(maxsize=64)
def plan_tables(rows: int, width: int, threshold: float, probes: int, recall: float) -> tuple[int, int, int]:
    """(tables, codes, probes): codes grow with the rows; tables follow from pairs drawn at the threshold.

    Up to ``BLOCK`` rows are one bucket (no codes), where every pair meets. Of up to ``probes``
    buckets a table, as many are visited as take the fewest visits in all for the promised recall. Where pairs at
    the threshold meet too seldom, codes are given up until it takes no more than
    ``MOST_TABLES`` tables; at one code it takes as many as it takes.
    """
    if rows <= BLOCK:
        return 1, 0, 1
    d = padded_width(width)
    codes = max(1, round(math.log(rows / FILL) / math.log(2 * d)))
    rng, draws = np.random.default_rng(3), min(4000, max(500, (1 << 20) // d))
    a = rng.normal(size=(draws, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(draws, width))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    b = threshold * a + math.sqrt(1 - threshold**2) * b
    while True:
        x, y = bucket_codes(a, 2, codes, probes, 99), bucket_codes(b, 2, codes, probes, 99)
        plans = []
        for p in range(min(2, probes), probes + 1):
            met = float(((x[:, :, :1] == y[:, :, :p]).any(2) | (y[:, :, :1] == x[:, :, :p]).any(2)).mean())
            if met:
                tables = max(2, math.ceil(math.log(1 - recall) / math.log1p(-min(met, 0.999))))
                plans.append((tables * p, tables, codes, p))
        if plans and (min(plans)[1] <= MOST_TABLES or codes == 1):
            return min(plans)[1:]
        if codes == 1:
            raise ValueError(f"no drawn pair at a cosine of {threshold} met: the threshold is too low for hashing")
        codes -= 1


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by powers of two first, so that squares neither vanish nor overflow."""
    _, e = np.frexp(np.abs(v).max(1, keepdims=True))
    v = np.ldexp(v, -e)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _links(batches: Iterator[pd.DataFrame], threshold: float, kind: str) -> Iterator[pd.DataFrame]:
    """For each block: how many vectors each one is linked with, and the smallest id of its links.

    Home rows (role 0) meet all rows of the bucket; in a block of a hot bucket they meet its visitors (role 1), which
    hold the bucket's own home rows once more.
    """
    keys = ["w", "tab", "bucket", "hb", "vb"]
    for frame in whole_runs(batches, keys):
        starts, ends = run_bounds(frame, keys)
        role = frame["role"].to_numpy()
        ids, many = frame["rep"].to_numpy(), frame["many"].to_numpy()
        raw, code, hot = frame["vec"].to_numpy(), frame["codes"].to_numpy(), frame["hot"].to_numpy()
        out_id, out_n, out_low = [], [], []
        for s, e in zip(starts, ends, strict=True):
            h = int((role[s:e] == 0).sum())
            first = h if hot[s] else 0  # of the rows that home rows meet
            if not h or first == e - s or e - s < 2:
                continue
            v = unit(np.stack([np.frombuffer(x, kind) for x in raw[s:e]]).astype(np.float64))
            i, j = np.nonzero(v[:h] @ v[first:].T >= threshold)
            j = j + first
            own = ids[s:e]
            keep = own[i] != own[j]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            c = np.stack([np.frombuffer(x, "<u4") for x in code[s:e]])
            c = c[:, 1:].reshape(e - s, -1, int(c[0, 0]))  # tables x probes
            t = int(frame["tab"].iloc[s])
            x, y = c[i], c[j]
            met_x = (x[:, :, :1] == y).any(2)
            met_y = (y[:, :, :1] == x).any(2)
            keep = ~(met_x | met_y)[:, :t].any(1)
            keep &= (own[i] < own[j]) | ~met_y[:, t]
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            order, back = np.unique(own, return_inverse=True)
            n = np.zeros(len(order), np.int64)
            np.add.at(n, back[i], many[s:e][j])
            np.add.at(n, back[j], many[s:e][i])
            low = min_labels(len(order), back[i], back[j])
            got = np.flatnonzero(n)
            out_id.append(order[got])
            out_n.append(n[got])
            out_low.append(order[low[got]])
        if out_id:
            yield pd.DataFrame({"rep": np.concatenate(out_id), "n": np.concatenate(out_n), "low": np.concatenate(out_low)})


def embedding_neighbours(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    probes: int = 4,
    recall: float = 0.9995,
) -> DataFrame:
    """Link vectors of cosine >= threshold: (vec_id, n_links, component_id, kept).

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing and are their own component. Repeated rows (equal id and vector) are one
    vector. Vectors link within their own width only; all widths are one job, and tables
    and codes follow from the number of vectors of a width. A null id links with nothing
    and has a null component. Extra columns are ignored; an empty table gives an empty
    result. Equal vectors are collapsed first and counted by their number. Components other
    than floats are kept as doubles. Near-dense clusters cost their number of links, spread
    over block pairs. Vectors are hashed once; a row of the result of hashing holds all
    the buckets that its vector visits.
    """
    single = isinstance(vectors.schema[vector_col].dataType.elementType, FloatType)
    kind, element = ("<f4", "float") if single else ("<f8", "double")
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{element}>").alias("v")).distinct()
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("v", lambda x: x != 0)
    base = checkpoint(base.withColumn("ok", F.coalesce(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & some, F.lit(False))))
    classes = checkpoint(
        base.where("ok")
        .groupBy("v")
        .agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("many"))
    )
    sized = classes.withColumn("w", F.size("v"))
    # hashing is dear and its input small: a number of partitions of its own, which no coalescing undoes
    parts = max(classes.sparkSession.sparkContext.defaultParallelism, classes.count() // HASHED)
    sized = sized.join(sized.groupBy("w").agg(F.count(F.lit(1)).alias("n")), "w").repartition(parts, "rep")

    # the commonest widths are planned once, here; tasks plan the rest, each for itself
    common = classes.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(PLANNED).collect()
    plans = {(r["w"], r["count"]): plan_tables(r["count"], r["w"], threshold, probes, recall) for r in common}

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for big in batches:
            for (w, n), same in big.groupby(["w", "n"], sort=False):
                tables, codes, visited = plans.get((w, n)) or plan_tables(int(n), int(w), threshold, probes, recall)
                for at in range(0, len(same), 256):
                    part = same.iloc[at : at + 256]
                    vec = np.stack(part["v"].to_numpy()).astype(kind)
                    c = bucket_codes(unit(vec.astype(np.float64)), tables, codes, visited)
                    first = np.ones(c.shape, bool)  # a bucket visited twice counts once
                    for k in range(1, visited):
                        first[:, :, k] = (c[:, :, k : k + 1] != c[:, :, :k]).all(2)
                    # table, whether the home bucket is visited by its own row, role and bucket of each visit in one number
                    place = (np.arange(tables, dtype=np.int64) << 34)[None, :, None] | c.astype(np.int64)
                    place[:, :, 0] |= 1 << 33
                    visits = [np.concatenate([place[i, :, 0] & ~(1 << 33), place[i][first[i]] | (1 << 32)]) for i in range(len(part))]
                    shown = [np.concatenate([[visited], r.ravel()]).astype("<u4").tobytes() for r in c]
                    yield pd.DataFrame({"w": part["w"], "rep": part["rep"], "many": part["many"], "vec": [r.tobytes() for r in vec], "codes": shown, "visits": visits})

    coded = checkpoint(sized.mapInPandas(hashed, "w int, rep long, many long, vec binary, codes binary, visits array<long>"))
    visit = F.col("visit")
    place = [F.shiftright(visit, 34).cast("int").alias("tab"), (F.shiftright(visit, 33).bitwiseAND(1) == 1).alias("own"), F.shiftright(visit, 32).bitwiseAND(1).cast("int").alias("role"), visit.bitwiseAND(0xFFFFFFFF).alias("bucket")]
    rows = coded.withColumn("visit", F.explode("visits")).select("w", *place, "rep", "many", "vec", "codes")
    slim = coded.select("w", F.explode("visits").alias("visit")).select("w", *place)
    blocks = block_rows(rows, slim, ["w", "tab", "bucket"], BLOCK, "rep").where("hot OR NOT own").drop("own")  # elsewhere home rows meet each other as they are
    order = ["w", "tab", "bucket", "hb", "vb"]
    linked = checkpoint(
        blocks.repartition(*order).sortWithinPartitions(*order, "role").mapInPandas(lambda b: _links(b, threshold, kind), "rep long, n long, low long")
    )
    counts = linked.groupBy("rep").agg(F.sum("n").alias("n"))
    comps = components(linked.select("rep", "low"))
    of_class = checkpoint(
        classes.join(counts, "rep", "left")
        .join(comps, F.col("rep") == F.col("node"), "left")
        .select(F.col("v"), (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    good = base.where("ok").join(of_class, "v").select("vec_id", "n_links", "component_id")
    rest = base.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
    return good.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

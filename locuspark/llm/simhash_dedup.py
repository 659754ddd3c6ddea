"""SimHash near-dedup: segment-popcount embedding and a grid range-join under Manhattan distance.

A 64-bit fingerprint maps to the bit counts of its 32 two-bit segments. The Manhattan
distance of two count vectors is at most the Hamming distance, so linked fingerprints
(3 bits or fewer) are within 3 in the whole vector and, by the pigeonhole principle,
within 1 in one of its two halves. Each half is a grid of unit cells: a fingerprint
lives in its own cell and visits that cell and the cells one step up in one
coordinate, which meets every pair within 1. Pairs that meet are verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.llm.shared import block_rows, checkpoint, column, components, min_labels, run_bounds, text_slices, whole_runs

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SEGMENTS = 16  # two-bit segments of a half
_POWERS = 3 ** np.arange(_SEGMENTS, dtype=np.int64)
#: Rows of one block of a cell.
BLOCK = 1024


def fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; no words give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    ones, step = np.zeros(64, np.int64), 65536
    for at in range(0, n, step):  # bounded memory whatever the length
        h = [digest(b" ".join(words[i : i + width]), 42) for i in range(at, min(n, at + step))]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def simhash_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, text_key, fp): fp the fingerprint's bits as a signed long, text_key a hash of the text. A null text is an empty one, of fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            fps = np.array([fingerprint(t, width) for t in column(b, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(text_col).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def _grid(batches: Iterator[pd.DataFrame], slim: bool) -> Iterator[pd.DataFrame]:
    for b in batches:
        fp = b["fp"].to_numpy().astype(np.int64).view(np.uint64)
        parts = []
        for half in (0, 1):
            word = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
            pairs = (word[:, None] >> np.arange(0, 32, 2, dtype=np.uint64)) & np.uint64(3)
            counts = ((pairs & np.uint64(1)) + (pairs >> np.uint64(1))).astype(np.int64)
            cell = counts @ _POWERS
            up = cell[:, None] + _POWERS
            possible = counts < 2  # a segment holds two bits, so no count is above 2
            row, seg = np.nonzero(possible)
            at = np.concatenate([np.arange(len(fp)), np.arange(len(fp)), row])
            cells = np.concatenate([cell, cell, up[row, seg]])
            role = np.concatenate([np.zeros(len(fp), np.int64), np.ones(len(fp) + len(row), np.int64)])
            out = {"half": np.full(len(at), half), "cell": cells, "role": role}
            if not slim:
                out |= {"rep": b["rep"].to_numpy()[at], "fp": b["fp"].to_numpy()[at]}
            parts.append(pd.DataFrame(out))
        yield pd.concat(parts, ignore_index=True)


def _verified(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """A spanning forest of the exact links of each block."""
    keys = ["half", "cell", "hb", "vb"]
    for frame in whole_runs(batches, keys):
        starts, ends = run_bounds(frame, keys)
        fp = frame["fp"].to_numpy().astype(np.int64).view(np.uint64)
        role, rep = frame["role"].to_numpy(), frame["rep"].to_numpy()
        size = ends - starts
        found_a, found_b = [], []
        # short runs: all rows at once, one offset after another
        short = np.flatnonzero((size >= 2) & (size <= 64))
        if len(short):
            at = np.concatenate([np.arange(starts[k], ends[k]) for k in short])
            end = np.repeat(ends[short], size[short])
            at, end = at[role[at] == 0], end[role[at] == 0]
            for step in range(1, int(size[short].max())):
                live = at + step < end
                at, end = at[live], end[live]
                other = at + step
                hit = (role[other] == 1) & (fp[at] != fp[other]) & (np.bitwise_count(fp[at] ^ fp[other]) <= most)
                found_a.append(rep[at[hit]])
                found_b.append(rep[other[hit]])
        for k in np.flatnonzero(size > 64):
            s, e = starts[k], ends[k]
            h = s + int((role[s:e] == 0).sum())
            for i in range(s, h, 256):
                j = min(h, i + 256)
                x, y = np.nonzero(np.bitwise_count(fp[i:j, None] ^ fp[None, h:e]) <= most)
                a, b = rep[i + x], rep[h + y]
                keep = a != b
                if keep.any():
                    a, b = _forest(a[keep], b[keep])
                    found_a.append(a)
                    found_b.append(b)
        if found_a and sum(map(len, found_a)):
            a, b = _forest(np.concatenate(found_a), np.concatenate(found_b))
            yield pd.DataFrame({"a": a, "b": b})


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    nodes, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    low = min_labels(len(nodes), back[: len(a)], back[len(a) :])
    other = low != np.arange(len(nodes))
    return nodes[other], nodes[low[other]]


def fingerprint_components(fps: DataFrame, most: int = 3) -> DataFrame:
    """(fp, component_id) of distinct fingerprints linked at ``most`` differing bits (3 or fewer).

    ``fps`` has doc_id and fp. The component is the smallest doc_id reachable.
    """
    if most > 3:
        raise ValueError("the grid of two halves meets all pairs up to 3 bits only")
    reps = checkpoint(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    known = reps.where(F.col("rep").isNotNull())
    kinds = "half int, cell long, role int"
    rows = known.mapInPandas(lambda b: _grid(b, False), f"{kinds}, rep long, fp long")
    slim = known.mapInPandas(lambda b: _grid(b, True), kinds)
    order = ["half", "cell", "hb", "vb"]
    edges = (
        block_rows(rows, slim, ["half", "cell"], BLOCK, "rep")
        .repartition(*order)
        .sortWithinPartitions(*order, "role")
        .mapInPandas(lambda b: _verified(b, most), "a long, b long")
    )
    comps = components(edges)
    return checkpoint(
        reps.join(comps, reps.rep == comps.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    )


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most: int = 3) -> DataFrame:
    """Near-duplicate groups by SimHash: (doc_id, fingerprint as 16 hex digits, component_id).

    One row per input row. Words are runs of anything but ASCII white space, A-Z lower-cased.
    Null and empty texts have fingerprint zero and link like any other; a null doc_id is
    grouped but never names a group (a group of null ids only has a null component).
    Repeated rows repeat in the result. Extra columns are ignored; an empty table gives none.
    Whole texts are read, however long.
    """
    fps = checkpoint(simhash_fingerprints(docs, id_col, text_col, width))
    groups = fingerprint_components(fps, most)
    return fps.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most: int = 3) -> DataFrame:
    """The rows of docs that are left when each near-duplicate group keeps one; all columns stay.

    A group keeps its row of the smallest doc_id, rows with a null id coming last; where
    several texts have that id, the one with the smallest text hash. Of rows of one id and
    text any one stays. Texts that link with nothing stay whether or not they have an id,
    so ids that are null or shared by different texts cost no document.
    """
    fps = checkpoint(simhash_fingerprints(docs, id_col, text_col, width))
    groups = fingerprint_components(fps.select(F.col("fp").alias("doc_id"), "fp"), most)  # fingerprints name the groups
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    first = fps.groupBy("fp").agg(least).join(groups, "fp").groupBy("component_id").agg(F.min("first").alias("first"))
    known = lambda c: F.coalesce(c.cast("long"), F.lit(-(1 << 63)))
    keep = first.select(known(F.col("first.doc_id")).alias("_keep_one_id"), F.col("first.text_key").alias("_keep_one_text")).distinct()
    keyed = docs.withColumns({"_keep_one_id": known(F.col(id_col)), "_keep_one_text": _text_key(text_col)})
    on = ["_keep_one_id", "_keep_one_text"]
    return keyed.join(keep, on, "left_semi").dropDuplicates(on).select(*docs.columns)

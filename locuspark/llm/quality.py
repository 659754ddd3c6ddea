"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.shared import column, text_slices

#: Byte classes of the UTF-8 text.
_CLASS = np.zeros(256, np.int64)
for _chars, _k in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3), (b" \t\r\x0b\x0c", 4), (b"\n", 5), (b".,;:'\"-()", 6), (b"!?", 7), (b"#$%&*@+=<>|~^_\\/{}[]`", 8)):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 9
#: How many statistics ``statistics`` gives.
N_FEATURES = 24


def statistics(text: str | None) -> np.ndarray:
    """Document statistics of a whole text; null counts as empty."""
    text = text or ""
    out = np.zeros(N_FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(len(raw), 1)
    counts = np.bincount(raw, minlength=256)
    share = np.bincount(_CLASS, weights=counts, minlength=10) / n
    out[:10] = share
    p = counts[counts > 0] / n
    out[10] = -(p * np.log(p)).sum() if len(raw) else 0
    words = text.split()
    m = max(len(words), 1)
    uniq = Counter(words)
    out[11] = len(raw) / m
    out[12] = len(uniq) / m
    out[13] = max(uniq.values(), default=0) / m
    out[14] = np.log1p(len(words))
    out[15] = sum(a == b for a, b in zip(words, words[1:], strict=False)) / m
    lines = [x for x in text.split("\n") if x.strip()]
    k = max(len(lines), 1)
    out[16] = len(set(lines)) / k
    out[17] = np.log1p(len(lines))
    out[18] = m / k
    out[19] = max(Counter(lines).values(), default=0) / k
    firsts = [w[0] for w in words]
    lasts = [w[-1] for w in words]
    out[20] = sum(c.isupper() for c in firsts) / m
    out[21] = sum(not c.isalnum() for c in lasts) / m
    out[22] = sum(len(w) == 1 for w in words) / m
    out[23] = sum(c in ".!?" for c in lasts) / m
    return out


@dataclass
class Forest:
    """Trees flattened into arrays: a node's feature (-1: a leaf), limit, children, value; roots by tree."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: all rows go down all trees at once."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[at]
                inner = f >= 0
                down = np.where(x[rows, np.maximum(f, 0)] <= self.limit[at], self.left[at], self.right[at])
                at = np.where(inner, down, at)
            total += self.value[at]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.1, least: int = 10, ridge: float = 1.0) -> Forest:
    """Fit logistic loss; splits are sought on histograms of quantile bins."""
    n, width = x.shape if x.size else (0, N_FEATURES)
    prior = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    bias = float(np.log(prior / (1 - prior)))
    feature, limit, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for a, v in ((feature, -1), (limit, 0.0), (left, 0), (right, 0), (value, 0.0)):
            a.append(v)
        return len(feature) - 1

    if n >= 2 * least and 0 < y.mean() < 1:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
        binned = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(width)], axis=1)
        flat = binned + np.arange(width) * bins
        score = np.full(n, bias)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            roots.append(node())
            level = {roots[-1]: np.arange(n)}
            for d in range(depth + 1):
                following = {}
                for at, rows in level.items():
                    sg, sh = g[rows].sum(), h[rows].sum()
                    cut = None
                    if d < depth and len(rows) >= 2 * least:
                        where = flat[rows].ravel()
                        hist = [np.bincount(where, np.repeat(w, width), width * bins).reshape(width, bins).cumsum(1) for w in (g[rows], h[rows], np.ones(len(rows)))]
                        gl, hl, nl = (v[:, :-1] for v in hist)
                        gain = gl**2 / (hl + ridge) + (sg - gl) ** 2 / (sh - hl + ridge) - sg**2 / (sh + ridge)
                        gain[(nl < least) | (len(rows) - nl < least)] = -1
                        f, b = np.unravel_index(gain.argmax(), gain.shape)
                        cut = (int(f), int(b)) if gain[f, b] > 1e-6 and b < len(cuts[f]) else None
                    if cut is None:
                        value[at] = float(rate * sg / (sh + ridge))
                        score[rows] += value[at]
                        continue
                    feature[at], limit[at] = cut[0], float(cuts[cut[0]][cut[1]])
                    left[at], right[at] = node(), node()
                    low = binned[rows, cut[0]] <= cut[1]
                    following[left[at]], following[right[at]] = rows[low], rows[~low]
                level = following
    arrays = (np.array(a) for a in (feature or [-1], limit or [0.0], left or [0], right or [0], value or [0.0]))
    return Forest(*arrays, np.array(roots, int), depth, bias)


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit_quality(
    docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", **how
) -> Forest:
    """Fit on at most ``max_rows`` labelled documents (the bound), drawn by hash of their id, none of them held out.

    Null labels and ids are left out; repeated labels of a document count by their mean; of
    several texts of one id one is taken, the same in every run.
    """
    marked = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
        .where(F.col("y").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg((F.avg("y") >= 0.5).cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            x = pa.array([statistics(t).tolist() for t in column(b, "text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(b.schema.get_field_index("y")), x], ["doc_id", "y", "x"])

    got = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .join(F.broadcast(marked), "doc_id")  # bounded by max_rows rows of 16 bytes
        .mapInArrow(run, "doc_id long, y double, x array<double>")
        .groupBy("doc_id")
        .agg(F.min(F.struct("x", "y")).alias("one"))
        .select("doc_id", "one.x", "one.y")
        .toPandas()
        .sort_values("doc_id")
    )
    x = np.stack(got["x"].to_numpy()) if len(got) else np.zeros((0, N_FEATURES))
    return boost(x, got["y"].to_numpy(float), **how)


def score_quality(docs: DataFrame, model: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score), one row per input row; a null text scores as an empty one, a null id is held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            x = np.stack([statistics(t) for t in column(b, "text")])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(model.predict(x))], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double")


def keep_quality(docs: DataFrame, model: Forest, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text scores at the threshold or above; all columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            x = np.stack([statistics(t) for t in column(b, text_col)])
            yield b.filter(pa.array(model.predict(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)

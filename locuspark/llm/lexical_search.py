"""Ranked lexical search: item tiles times document tiles as dense float64 matrix products.

Documents are read once per batch of items: every slice of documents becomes one row that holds
the slice's term counts over the items' vocabulary, and its share of the corpus statistics. With
those known, a slice is a dense tile of impacts, an item tile a dense matrix of term repeats over
its own compact vocabulary, and BLAS multiplies them. All numbers are integers: vocabulary tiles
are cut so that every partial sum stays under 2^53, so float64 is exact, and tiles are added as
64-bit integers. Tasks keep each item's best documents, ties by id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuspark.llm.shared import column, shared_path

#: Documents of a tile, terms of a vocabulary tile, cells of an item tile.
DOC_TILE, TERM_TILE, ITEM_CELLS = 512, 2048, 1 << 20
#: Sums of integers under this are exact in float64.
EXACT = 1 << 53
#: Highest weight-free impact: 10^9 tf / (1000 tf + 12 m) is under 10^6.
MOST_IMPACT = 1_000_000
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(data: bytes, block: int = 1 << 20) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text, block by block: runs of digits, letters and all beyond ASCII; only A-Z are lowered."""
    at = 0
    while at < len(data):
        end = at + block
        while end < len(data) and _LETTERS[data[end]] != 32:
            end += 1
        yield data[at:end].translate(_LETTERS).split()
        at = end


def _tiles(batches: Iterator[pa.RecordBatch], most_bytes: int = 16 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of at most DOC_TILE documents and about ``most_bytes`` of text."""
    ids, texts, held = [], [], 0
    for b in batches:
        for i, t in zip(column(b, "doc_id"), b.column(1), strict=True):
            data = t.as_py() or b""
            if ids and (len(ids) == DOC_TILE or held + len(data) > most_bytes):
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(i)
            texts.append(data)
            held += len(data)
    if ids:
        yield ids, texts


def count_tiles(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """One row per document tile: its documents with a term of the vocabulary, their counts, and the tile's statistics."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        width = max(len(place), 1)
        for ids, texts in _tiles(batches):
            size = np.zeros(len(ids), np.int64)
            cells, many = [], []
            for k, data in enumerate(texts):
                for words in terms(data):
                    size[k] += len(words)
                    hit = np.array([place[w] for w in words if w in place], np.int64)
                    cell, n = np.unique(hit + k * width, return_counts=True)
                    cells.append(cell)
                    many.append(n)
            cell, back = np.unique(np.concatenate([*cells, np.zeros(0, np.int64)]), return_inverse=True)  # long texts come in several blocks
            tf = np.bincount(back, np.concatenate([*many, np.zeros(0, np.int64)]), len(cell)).astype(np.int64)
            doc, term = cell // width, cell % width
            used, row = np.unique(doc, return_inverse=True)
            seen, df = np.unique(term, return_counts=True)
            one = [
                [[ids[i] for i in used]],
                [size[used].tolist()],
                [row.astype(np.int32).tobytes()],
                [term.astype(np.int32).tobytes()],
                [tf.tobytes()],
                [seen.tolist()],
                [df.tolist()],
                [int((size > 0).sum())],
                [int(size.sum())],
            ]
            kinds = [pa.list_(pa.int64())] * 2 + [pa.binary()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(one, kinds, strict=True)], ["ids", "n", "row", "term", "tf", "seen", "df", "docs", "total"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "ids array<long>, n array<long>, row binary, term binary, tf binary, seen array<long>, df array<long>, docs long, total long")


def term_weights(df: np.ndarray, docs: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def item_tiles(items: list[Counter], weights: np.ndarray) -> list[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """Tiles of items: (item numbers, vocabulary tiles), a vocabulary tile being (term numbers, terms x items repeats).

    A tile holds items of like length and closes at ITEM_CELLS cells; its vocabulary tiles close at TERM_TILE
    terms or where a sum of impacts could reach 2^53. A term that could reach it alone is dealt to several rows.
    """
    out, todo = [], sorted((k for k, x in enumerate(items) if x), key=lambda k: len(items[k]))
    while todo:
        chosen, seen = [], set()
        while todo and (not chosen or (len(chosen) + 1) * len(seen | items[todo[0]].keys()) <= ITEM_CELLS):
            chosen.append(todo.pop(0))
            seen |= items[chosen[-1]].keys()
        tiles, rows, sums = [], [], np.zeros(len(chosen), object)
        for t in sorted(seen):
            left = np.array([items[k][t] for k in chosen], np.int64)
            each = max(int(weights[t]), 1) * MOST_IMPACT
            most = max((EXACT - 1) // each, 1)
            while left.any():
                part = np.minimum(left, most)
                left = left - part
                cost = part.astype(object) * each
                if rows and (len(rows) == TERM_TILE or (sums + cost).max() >= EXACT):
                    tiles.append(rows)
                    rows, sums = [], np.zeros(len(chosen), object)
                rows.append((t, part))
                sums = sums + cost
        tiles.append(rows)
        out.append((np.array(chosen), [(np.array([t for t, _ in r]), np.array([p for _, p in r], np.float64)) for r in tiles]))
    return out


class BestOf:
    """Each item's best documents so far: score descending, then null ids, then ids ascending."""

    def __init__(self, k: int):
        self.k, self.floor = k, {}
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.some = np.zeros(0, bool)

    def add(self, items: np.ndarray, scores: np.ndarray, docs: np.ndarray, some: np.ndarray) -> None:
        """Scores of documents x items; what ties with an item's last kept one stays in the running."""
        floor = np.array([self.floor.get(i, 1) for i in items.tolist()])
        d, i = np.nonzero(scores >= floor)
        if not len(d):
            return
        item, score = np.r_[self.item, items[i]], np.r_[self.score, scores[d, i]]
        doc, some = np.r_[self.doc, docs[d]], np.r_[self.some, some[d]]
        order = np.lexsort((doc, some, -score, item))
        item = item[order]
        first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
        rank = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
        keep = order[rank < self.k]
        last = rank == self.k - 1
        self.floor |= dict(zip(item[last].tolist(), score[order][last].tolist(), strict=True))
        self.item, self.score, self.doc, self.some = item[rank < self.k], score[keep], doc[keep], some[keep]


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_batch(docs: DataFrame, found: list, k: int, id_col: str, text_col: str) -> DataFrame:
    """Best documents of the items of one batch."""
    spark = docs.sparkSession
    counted = [Counter(w for words in terms(bytes(r["text"] or b"")) for w in words) for r in found]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*counted)))}
    path = shared_path(spark, "term-tiles")
    count_tiles(docs, vocabulary, id_col, text_col).write.parquet(path)
    tiles = spark.read.parquet(path)
    n_docs, total = tiles.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    seen = tiles.select(F.explode(F.arrays_zip("seen", "df")).alias("x")).groupBy(F.col("x.seen").alias("term")).agg(F.sum("x.df").alias("df"))
    df = np.zeros(len(vocabulary), np.int64)
    for r in seen.collect():  # a row for each term of the batch
        df[r["term"]] = r["df"]
    weights = term_weights(df, n_docs)
    made = item_tiles([Counter({vocabulary[w]: n for w, n in c.items()}) for c in counted], weights)
    shared = spark.sparkContext.broadcast((made, weights, [r["item_id"] for r in found]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, weight, names = shared.value
        best, width = BestOf(k), len(weight)
        for b in batches:
            for t in b.to_pylist():
                if not t["ids"]:
                    continue
                some = np.array([i is not None for i in t["ids"]])
                ids = np.array([i or 0 for i in t["ids"]], np.int64)
                row, term = np.frombuffer(t["row"], np.int32), np.frombuffer(t["term"], np.int32)
                tf, n = np.frombuffer(t["tf"], np.int64), np.array(t["n"], np.int64)
                m = 75 + (25 * n * n_docs) // total
                impact = (weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[row]))).astype(np.float64)
                order = np.argsort(term, kind="stable")
                row, term, impact = row[order], term[order], impact[order]
                start = np.searchsorted(term, np.arange(width + 1))
                for items, parts in groups:
                    score = np.zeros((len(ids), len(items)), np.int64)
                    for words, repeats in parts:
                        long = start[words + 1] - start[words]
                        at = np.repeat(start[words] - np.r_[0, np.cumsum(long)[:-1]], long) + np.arange(long.sum())
                        dense = np.zeros((len(ids), len(words)))
                        dense[row[at], np.repeat(np.arange(len(words)), long)] = impact[at]
                        score += (dense @ repeats).astype(np.int64)
                    best.add(items, score, ids, some)
        doc = pa.array(best.doc, pa.int64(), mask=~best.some)
        out = [pa.array(best.item), pa.array([names[i] for i in best.item.tolist()], pa.int64()), doc, pa.array(best.score)]
        yield pa.RecordBatch.from_arrays(out, ["item", "item_id", "doc_id", "score"])

    kept = tiles.select("ids", "n", "row", "term", "tf").mapInArrow(run, "item long, item_id long, doc_id long, score long")
    some = _best(kept.withColumn("part", F.spark_partition_id() % 64), ["item", "part"], k)  # a task sends each item k rows at most
    return _best(some, ["item"], k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_search(
    items: DataFrame, docs: DataFrame, k: int = 20, item_id: str = "item_id", item_text: str = "text", id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = 1 << 20
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, scores above zero only, ties by ascending id.

    Every item row is a query of its own, repeated ids or not, and so is every document row; null ids come first
    among equal scores. Null and empty texts have no terms: such items return nothing, such documents count for
    nothing. Extra columns are ignored; empty tables give no rows. Items are taken in batches of about
    ``batch_bytes`` of text, the part that driver and workers hold; each batch reads all documents once.
    """
    text = F.col(item_text).cast("string")
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), text.cast("binary").alias("text"))
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    batches = max(1, -(-size // batch_bytes))
    out = None
    for b in range(batches):
        found = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)) == b).collect()
        best = _search_batch(docs, found, k, id_col, text_col)
        out = best if out is None else out.union(best)
    return out


#: The same in DuckDB over documents and benchmark.
ORACLE_SQL = r"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
word AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM low),
tf AS (SELECT doc_id, term, count(*) AS tf FROM word GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM size),
ask AS (
  SELECT item_id, term, count(*) AS q
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, corpus WHERE term IN (SELECT term FROM ask) GROUP BY term),
scored AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::BIGINT AS score
  FROM ask JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (doc_id), corpus GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""

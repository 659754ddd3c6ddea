"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

Items fall into partitions by their number of shingles (powers of two). A partition's
sketch size is the least that no contained item can escape: an item of n shingles that is
contained to a share t misses at most n - ceil(t n) of them, so of its n - ceil(t n) + 1
smallest hashes one is in the document. Documents are looked up by the hashes that reach
the largest sketch value; hits are verified by counting exact shingles. An item of fewer
words than a shingle has one shingle, its whole word sequence, and documents are cut to
that width as well. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuspark.llm.shared import checkpoint, if_small


def words_of(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles_of(words: Column, width: int, hashed: bool) -> Column:
    """The word shingles of a word array, in order; fewer words than the width give none."""
    make = lambda i: F.slice(words, i, width)
    each = (lambda i: F.xxhash64(make(i))) if hashed else (lambda i: F.array_join(make(i), " "))
    kind = "array<bigint>" if hashed else "array<string>"
    n = F.size(words)
    return F.when(n >= width, F.transform(F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1))), each)).otherwise(F.array().cast(kind))


def item_shingles(words: Column, width: int) -> Column:
    """An item's shingles: those of its words, or its whole word sequence where the words are fewer than the width."""
    short = F.size(words).between(1, width - 1)
    return F.when(short, F.array(F.array_join(words, " "))).otherwise(shingles_of(words, width, False))


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def contaminated_rows(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 5,
    threshold: float = 0.8,
) -> DataFrame:
    """(doc_id, text_key, item_id, n_shingles, n_contained) of pairs at the threshold or above.

    A document is a row's id and text hash, so rows of other texts under the same id or
    without an id neither add to each other's shingles nor share their fate.
    """
    row = ["doc_id", "text_key"]
    doc = docs.select(F.col(id_col).alias("doc_id"), _text_key(text_col).alias("text_key"), F.col(text_col).alias("doc_text"))
    # the words are a column of their own: inside the shingles' lambda they would be split anew for each shingle
    def exploded(df: DataFrame, hashed: bool, name: str) -> DataFrame:
        cut = [shingles_of(F.col("ws"), w, hashed) for w in widths]
        return df.withColumn("ws", words_of(F.col("doc_text"))).select(*row, F.explode(F.concat(*cut) if len(cut) > 1 else cut[0]).alias(name))

    item = checkpoint(
        items.select(F.col(item_col).alias("item_id"), words_of(F.col(item_text_col)).alias("ws"))
        .select("item_id", F.explode(item_shingles(F.col("ws"), width)).alias("shingle"), F.least(F.size("ws"), F.lit(width)).alias("words"))
        .select("item_id", "shingle", "words", F.xxhash64(F.split("shingle", " ", -1)).alias("hash"))
        .distinct()
    )
    widths = sorted({width, *(r["words"] for r in item.select("words").distinct().collect())})  # at most ``width`` numbers
    sized = item.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"))
    need = F.ceil(F.col("n_shingles") * threshold - 1e-9)
    of_item = Window.partitionBy("item_id")
    part = F.floor(F.log2("n"))
    top = F.pow(F.lit(2), part + 1) - 1  # the largest size of the partition
    keep = F.least(F.col("n"), F.floor(top * (1 - threshold) + 1e-9) + 1)
    ranked = item.withColumns({"n": F.count(F.lit(1)).over(of_item), "rank": F.row_number().over(of_item.orderBy("hash"))})
    sketch = ranked.where(F.col("rank") <= keep).select("hash").distinct()
    bound = sketch.agg(F.max("hash"), F.count(F.lit(1))).first()
    hashes = exploded(doc, True, "hash")
    hashes = hashes.where(F.col("hash") <= F.lit(bound[0]).cast("long"))
    hit = checkpoint(hashes.join(if_small(sketch, bound[1]), "hash", "left_semi").select(F.col("doc_id").alias("d2"), F.col("text_key").alias("t2")).distinct())
    shingles = item.select("item_id", "shingle")
    size = shingles.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("shingle")), F.lit(0))).first()
    same = F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("text_key") == F.col("t2"))
    held = (
        exploded(doc.join(if_small(hit, hit.count()), same, "left_semi"), False, "shingle")
        .join(if_small(shingles, size[0], size[1]), "shingle")
        .groupBy(*row, "item_id", "shingle")
        .agg(F.lit(1).alias("one"))
        .groupBy(*row, "item_id")
        .agg(F.count(F.lit(1)).alias("n_contained"))
    )
    return (
        held.join(sized.withColumnRenamed("item_id", "i2"), F.col("item_id").eqNullSafe(F.col("i2")))
        .where(F.col("n_contained") >= need)
        .select(*row, "item_id", "n_shingles", "n_contained")
    )


def contamination(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_contained, containment) of pairs at the threshold or above.

    Containment is the share of the item's distinct shingles that the document holds.
    Null and empty texts hold no shingle and match nothing. An item of fewer words than
    the width is held where its words follow one another in the document. Rows that share an id, or have none, are compared each by itself; an id
    and item with several such rows at the threshold are one row, of the largest
    containment. Repeated item ids are one item with the shingles of all their rows. Empty
    tables give no rows; extra columns are ignored. ``how`` is contaminated_rows'.
    """
    pairs = contaminated_rows(docs, items, **how).groupBy("doc_id", "item_id", "n_shingles").agg(F.max("n_contained").alias("n_contained"))
    return pairs.withColumn("containment", F.col("n_contained") / F.col("n_shingles"))


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs that hold no item at the threshold; all columns stay.

    Only the rows that hold one go, not others under the same id or without an id.
    """
    leaks = contaminated_rows(docs, items, id_col=id_col, text_col=text_col, **how)
    leaks = checkpoint(leaks.select(F.col("doc_id").alias("_leaked_id"), F.col("text_key").alias("_leaked_text")).distinct())
    leaks = if_small(leaks, leaks.count())
    return docs.join(leaks, docs[id_col].eqNullSafe(leaks["_leaked_id"]) & (_text_key(text_col) == leaks["_leaked_text"]), "left_anti")


ORACLE_SQL = r"""
WITH dw AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS w, generate_subscripts(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+'), 1) AS i FROM documents),
iw AS (SELECT item_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')) AS w, generate_subscripts(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+'), 1) AS i FROM benchmark),
sh AS (SELECT item_id, count(*) AS k, string_agg(w, ' ' ORDER BY i) AS s FROM iw GROUP BY item_id HAVING count(*) < 5),
dl AS (SELECT doc_id, w, lead(w, 1) OVER o AS w1, lead(w, 2) OVER o AS w2, lead(w, 3) OVER o AS w3, lead(w, 4) OVER o AS w4 FROM dw WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
ds AS (SELECT DISTINCT doc_id, w || ' ' || w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 AS s FROM dl WHERE w4 IS NOT NULL
  UNION SELECT doc_id, CASE k WHEN 1 THEN w WHEN 2 THEN w || ' ' || w1 WHEN 3 THEN w || ' ' || w1 || ' ' || w2 ELSE w || ' ' || w1 || ' ' || w2 || ' ' || w3 END AS s FROM dl, (SELECT DISTINCT k FROM sh) WHERE s IS NOT NULL),
its AS (SELECT DISTINCT item_id, concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) AS s FROM iw WINDOW o AS (PARTITION BY item_id ORDER BY i) QUALIFY lead(w, 4) OVER o IS NOT NULL
  UNION ALL SELECT item_id, s FROM sh),
n AS (SELECT item_id, count(*) AS n_shingles FROM its GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS n_contained FROM ds JOIN its USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_contained, n_contained / n_shingles AS containment
FROM c JOIN n USING (item_id) WHERE n_contained >= ceil(n_shingles * 0.8 - 1e-9)
"""

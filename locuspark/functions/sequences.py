"""Sequence expressions and jobs over distributed sequence tables."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.storage import checkpoint

#: Complements of the IUPAC codes (fixed values).
_FROM, _TO = "ACGTRYSWKMBDHVNacgtryswkmbdhvn", "TGCAYRSWMKVHDBNtgcayrswmkvhdbn"
#: Bases of each IUPAC code (fixed values).
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "M": "AC", "R": "AG", "W": "AT", "S": "CG", "Y": "CT", "K": "GT", "V": "ACG", "H": "ACT", "D": "AGT", "B": "CGT", "X": "GATC", "N": "GATC"}
#: Amino acids of the standard code, codons in the order T, C, A, G of each place (fixed values).
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, _FROM, _TO))


def translate_cds(seq: Column) -> Column:
    """Protein of a coding sequence: white space and digits removed, X for unknown codons, no trailing stop."""
    clean = F.upper(F.regexp_replace(seq, r"[\s0-9]", ""))
    codes = F.create_map(*[x for c, a in zip(map("".join, product("TCAG", repeat=3)), CODE, strict=True) for x in (F.lit(c), F.lit(a))])
    # codons are cut once; the lambda sees one codon at a time
    each = F.transform(F.regexp_extract_all(clean, F.lit("(...)"), 1), lambda c: F.coalesce(F.try_element_at(codes, c), F.lit("X")))
    return F.regexp_replace(F.array_join(each, ""), r"\*$", "")


def gc_content(seq: Column) -> Column:
    """Share of upper-case G and C; null for an empty sequence."""
    return F.when(F.length(seq) > 0, F.length(F.regexp_replace(seq, "[^GC]", "")) / F.length(seq))


def expand_iupac(col: Column) -> Column:
    """The bases of a string of codes, in order, one list."""
    m = F.create_map(*[x for k, v in IUPAC.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.flatten(F.transform(F.split(F.upper(col), ""), lambda c: F.coalesce(F.try_element_at(m, c), F.array().cast("array<string>"))))


def float_cmp(a: Column, b: Column, op: str, digits: int = 6) -> Column:
    x, y = F.round(a, digits), F.round(b, digits)
    return {"<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[op]


def chunked(seqs: DataFrame, size: int, id_col: str = "chrom", seq_col: str = "seq") -> DataFrame:
    """(chrom, chunk, start, seq): a sequence cut into chunks of ``size``; start is 1-based."""
    n = F.ceil(F.length(seq_col) / size).cast("int")
    c = seqs.where(F.length(seq_col) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0), n - 1)))
    return c.select(F.col(id_col).alias("chrom"), "chunk", (F.col("chunk") * size + 1).cast("long").alias("start"), F.substring(F.col(seq_col), F.col("chunk") * size + 1, F.lit(size)).alias("seq"))


def extract(parts: DataFrame, chunks: DataFrame, size: int, key: str = "tr") -> DataFrame:
    """(key, seq): the spliced sequence of each key's parts in reading direction.

    Parts meet the chunks they touch in an equi-join; pieces are put together per key.
    """
    p = parts.withColumn("chunk", F.explode(F.sequence(F.floor((F.col("start") - 1) / size).cast("int"), F.floor((F.col("end") - 1) / size).cast("int"))))
    c = chunks.select(F.col("chrom").alias("_c"), F.col("chunk").alias("_k"), F.col("start").alias("_s"), F.col("seq").alias("_seq"))
    j = p.join(c, (F.col("chrom") == F.col("_c")) & (F.col("chunk") == F.col("_k")))
    lo = F.greatest(F.col("start"), F.col("_s"))
    hi = F.least(F.col("end"), F.col("_s") + F.length("_seq") - 1)
    piece = j.withColumns({"_at": lo, "_piece": F.substring(F.col("_seq"), (lo - F.col("_s") + 1).cast("int"), (hi - lo + 1).cast("int"))}).where(hi >= lo)
    whole = piece.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_piece"))), lambda x: x["_piece"]), "").alias("_seq"), F.min("strand").alias("strand"))
    return whole.select(key, F.when(F.col("strand") == "-", revcomp(F.col("_seq"))).otherwise(F.col("_seq")).alias("seq"))


def n_runs(chunks: DataFrame, min_len: int = 10) -> DataFrame:
    """(chrom, start, end) of runs of N, 1-based; runs that cross chunk edges are put together.

    ``chunks`` as from ``chunked``. All letters of a batch are looked at in one array. Runs inside a chunk are whole;
    only those that touch its edges join where they touch, and runs that are too short for either stay behind.
    """
    from locuspark.operators.intervals import merge_intervals

    def found(batches):
        for b in batches:
            length = b["seq"].str.len().to_numpy(np.int64)
            first = np.r_[0, np.cumsum(length + 1)[:-1]].astype(np.int64)  # a separator follows each chunk
            letters = np.frombuffer(("\n".join(b["seq"]) + "\n").encode("latin-1", "replace"), np.uint8)
            change = np.diff(np.r_[0, (letters == ord("N")) | (letters == ord("n")), 0].astype(np.int8))
            low, high = np.flatnonzero(change == 1), np.flatnonzero(change == -1) - 1
            k = np.searchsorted(first, low, "right") - 1
            low, high = low - first[k], high - first[k]
            edge = (low == 0) | (high == length[k] - 1)
            keep = edge | (high - low + 1 >= min_len)
            start = b["start"].to_numpy(np.int64)[k]
            yield pd.DataFrame({"chrom": b["chrom"].to_numpy()[k], "start": start + low, "end": start + high, "edge": edge})[keep]

    c = chunks.where("seq IS NOT NULL AND seq <> ''").select("chrom", F.col("start").cast("long").alias("start"), "seq")
    pieces = checkpoint(c.mapInPandas(found, f"chrom {dict(c.dtypes)['chrom']}, start long, end long, edge boolean"))
    across = merge_intervals(pieces.where("edge")).where(F.col("end") - F.col("start") + 1 >= min_len)
    return pieces.where("NOT edge").select("chrom", "start", "end").unionByName(across.select("chrom", "start", "end"))


def wrapped(seq: Column, width: int = 50) -> Column:
    return F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")

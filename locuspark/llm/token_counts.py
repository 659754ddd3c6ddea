"""Token counts: a map-side lookup in two tiers, without shuffling pre-tokens.

Tier one is a broadcast hash table of the token lengths of frequent pre-tokens, of bounded
size. Tier two is each worker's own bounded cache; what neither holds is encoded once.
The vocabulary's own whole words and some documents of every partition fill tier one; it
changes the speed only, never a count. The cache has two generations, so that it is never
dropped as a whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.shared import column, text_slices

#: The pre-token pattern of the vocabulary file (fixed values).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
#: The same for lower-case ASCII texts, which the plain engine scans in half the time.
ASCII_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"
#: Entries of one generation of a worker's cache, and the longest piece that is kept.
CACHE, LONGEST = 300_000, 64


class _Known(dict):
    """Token counts of pieces: the broadcast tier and the newer cache; a miss looks into the older cache, then asks."""

    older: dict[str, int] = {}

    def __init__(self, frequent: dict[str, int]):
        super().__init__(frequent)
        self.asked: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self.older.get(piece)
        if n is None:
            self.asked.append(piece)
            return 0
        self[piece] = n
        return n


class PieceCounter:
    """Counts tokens of texts for a word-end BPE vocabulary that lower-cases and drops white space."""

    def __init__(self, path: str, frequent: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            self.added = [a["content"] for a in json.load(f)["added_tokens"]]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))))
        self.piece, self.ascii_piece = regex.compile(PIECES), re.compile(ASCII_PIECES)
        self.start(frequent)

    def start(self, frequent: dict[str, int]) -> None:
        """Begin with the broadcast tier alone."""
        self.frequent, self.known = frequent, _Known(frequent)

    def pieces(self, text: str) -> tuple[int, list[str]]:
        """(special strings, pre-tokens) of a text."""
        parts = self.special.split(text) if any(s in text for s in self.added) else [text]
        found: list[str] = []
        for part in parts:
            if part.isascii():
                found += self.ascii_piece.findall(part.lower())
            else:  # lower-casing goes character by character
                found += self.piece.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return len(parts) - 1, found

    def lengths(self, pieces: list[str]) -> dict[str, int]:
        """Token counts of pieces by the library, encoded together."""
        return {p: len(e.ids) for p, e in zip(pieces, self.tokenizer.encode_batch(pieces, add_special_tokens=False), strict=True)}

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; what no tier holds is encoded once for all the texts."""
        if len(self.known) > CACHE + len(self.frequent):  # the newer cache becomes the older one
            older, self.known = self.known, _Known(self.frequent)
            older.older = {}
            self.known.older = older
        known, out, open_ = self.known, [], []
        get = known.__getitem__
        for text in texts:
            n, found = self.pieces(text)
            out.append(n + sum(map(get, found)))
            if known.asked:
                open_.append((len(out) - 1, known.asked))
                known.asked = []
        if open_:
            fresh = self.lengths(list({p for _, asked in open_ for p in asked}))
            for k, asked in open_:
                out[k] += sum(map(fresh.__getitem__, asked))
            known.update((p, n) for p, n in fresh.items() if len(p) <= LONGEST)
        return out


@lru_cache(maxsize=2)
def worker_counter(path: str) -> PieceCounter:
    """One counter and cache per Python worker, for all tasks it runs."""
    return PieceCounter(path, {})


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", per_partition: int = 16, size: int = 65_536) -> dict[str, int]:
    """The broadcast tier: at most ``size`` pre-tokens and their token counts.

    Half of it are the most frequent pieces of a sample, the first ``per_partition`` documents of every
    partition, counted where they are read; the rest are the vocabulary's whole words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen, left = worker_counter(path), Counter(), per_partition
        for b in batches:
            for t in column(b.slice(0, left), "text"):
                seen.update(counter.pieces(t or "")[1])
            left -= b.num_rows
            if left <= 0:
                break
        top = seen.most_common(size // 2)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    known = [r["piece"] for r in counted.where(F.length("piece") <= LONGEST).orderBy(F.desc("n"), "piece").limit(size // 2).collect()]
    counter = PieceCounter(path, {})
    lengths = counter.lengths(known)
    for w in counter.tokenizer.get_vocab(with_added_tokens=False):
        if len(lengths) >= size:
            break
        if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalpha() and w[:-4].islower():
            lengths.setdefault(w[:-4], 1)
    return lengths


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row, whole texts.

    Null and empty texts count zero bytes and tokens. Special strings inside texts count as
    one token each, as the tokenizers library has it by default; none are added at the
    ends. Repeated rows repeat; extra columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(docs, path, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(path)
        if counter.frequent is not table.value:
            counter.start(table.value)
        for b in text_slices(batches):
            texts = [t or "" for t in column(b, "text")]
            n = np.array(counter.counts(texts), np.int64)
            size = pa.array([len(t.encode("utf-8")) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

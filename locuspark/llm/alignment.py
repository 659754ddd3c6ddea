"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Both token rows cover the same bytes. In an interval that begins and ends at shared cuts, an end
common to both near the middle is located by bisection, and both halves are taken in turn; an
interval without one is a leaf group. A space between two words is a cut of both tokenizers, so a
text falls into words first; new words are aligned together, each once, and kept in the worker's
bounded cache. Counts of id pairs over the corpus come from sums per slice of documents, joined
back per slice.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.bpe import byte_alphabet
from locuspark.llm.packing import cut_up
from locuspark.llm.shared import column, if_small, shared_path, text_blocks, text_slices

#: Documents of a slice, and characters after which it is closed.
SLICE_DOCS, SLICE_CHARS = 2048, 8 << 20
#: Entries of one generation of a worker's cache, and the longest word that is kept.
CACHE, LONGEST = 250_000, 64
#: An id pair is one number: A id, then B id in so many bits.
B_BITS = 20
_DOUBLE, _CUT, _BYTE = regex.compile(r"^\s|\s\s|\s$"), regex.compile(r"(?<=\S) (?=\S)"), regex.compile("<0x([0-9A-F]{2})>")


def middle_cuts(ea: np.ndarray, eb: np.ndarray, i: np.ndarray, j: np.ndarray, k: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval (tokens i:j of A, k:m of B, with the same last end) the places of a common end near its middle; -1 if it has none but the last.

    From A's middle end the search bisects to the next end of B, from that to the next end of A, and so on until
    two are equal; where the interval ends first, it goes back from the middle the same way.
    """
    x_of, y_of = np.full(len(i), -1), np.full(len(i), -1)
    todo = np.flatnonzero((j - i > 1) & (m - k > 1))
    mid = (i + j - 1) >> 1

    def found(at: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        hit = eb[y] == ea[x]
        x_of[at[hit]], y_of[at[hit]] = x[hit], y[hit]
        return ~hit

    at, x = todo, mid[todo]
    while len(at):
        y = np.searchsorted(eb, ea[x])
        on = found(at, x, y)
        at, x = at[on], np.searchsorted(ea, eb[y[on]])
        inside = x < j[at] - 1
        at, x = at[inside], x[inside]
    at = todo[x_of[todo] < 0]
    x = mid[at] - 1
    while len(at):
        inside = x >= i[at]
        at, x = at[inside], x[inside]
        y = np.searchsorted(eb, ea[x], "right") - 1
        inside = y >= k[at]
        at, x, y = at[inside], x[inside], y[inside]
        on = found(at, x, y)
        at, x = at[on], np.searchsorted(ea, eb[y[on]], "right") - 1
    return x_of, y_of


def align(ea: np.ndarray, eb: np.ndarray, i: np.ndarray, j: np.ndarray, k: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Leaf groups as columns (A from, A to, B from, B to), in order, of intervals whose last ends are equal.

    ``ea`` and ``eb`` are the ascending byte ends of the tokens. All intervals are halved together, level by level.
    """
    leaves = [np.zeros((4, 0), np.int64)]
    while len(i):
        x, y = middle_cuts(ea, eb, i, j, k, m)
        cut = x >= 0
        leaves.append(np.stack([i, j, k, m])[:, ~cut])
        i, j, k, m, x, y = (v[cut] for v in (i, j, k, m, x, y))
        i, j, k, m = np.r_[i, x + 1], np.r_[x + 1, j], np.r_[k, y + 1], np.r_[y + 1, m]
    out = np.concatenate(leaves, axis=1)
    return out[:, np.argsort(out[0])]


class Aligner:
    """Aligns texts word by word for a byte-level vocabulary (A) and a sentencepiece model (B); new words are aligned together."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings are plain text
        value = {c: b for b, c in byte_alphabet().items()}
        entries = self.a.get_vocab(with_added_tokens=True)
        a_bytes = {i: bytes(value[c] for c in t) if all(c in value for c in t) else t.encode() for t, i in entries.items()}
        self.a_bytes = [a_bytes.get(i, b"") for i in range(max(a_bytes) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            byte = _BYTE.fullmatch(self.b.id_to_piece(i))
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte and self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode())
        if not all(a_bytes.values()) or not all(self.b_bytes):
            raise ValueError("a token without bytes: several tokens could end at one place")
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        shown = lambda n, sep: np.array([f"{i}{sep}" for i in range(n)], object)
        self.a_text = shown(len(self.a_bytes), ","), shown(len(self.a_bytes), "|")
        self.b_text = shown(len(self.b_bytes), ","), shown(len(self.b_bytes), ";")
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A of all words after a space, tokens per word; the same of B."""
        ids, many = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 4096):
            part = [" " + w for w in words[at : at + 4096]]
            done = self.a.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(done.ids, np.int64))
            many.append(np.bincount(np.array(done.word_ids, np.int64), minlength=len(part)))
        rows = self.b.encode(words, num_threads=1)
        return np.concatenate(ids), np.concatenate(many), np.fromiter(chain.from_iterable(rows), np.int64), np.fromiter(map(len, rows), np.int64, len(rows))

    def learn(self, words: list[str]) -> dict[str, tuple | None]:
        """(A tokens, B tokens, groups, their text, pair numbers as bytes) of each word; None if its tokens do not spell space and word."""
        a, na, b, nb = self.encoded(words)
        want = [b" " + w.encode() for w in words]
        size = np.fromiter(map(len, want), np.int64, len(want))
        good = np.ones(len(words), bool)
        for ids, n, spelled, sizes in ((a, na, self.a_bytes, self.a_size), (b, nb, self.b_bytes, self.b_size)):
            own = np.bincount(np.repeat(np.arange(len(words)), n), sizes[ids], len(words)).astype(np.int64)
            made = b"".join(map(spelled.__getitem__, ids.tolist()))
            if made != b"".join(want) or (own != size).any():
                good &= [x == y for x, y in zip(cut_up(made, np.cumsum(own)), want, strict=True)]
        out: dict[str, tuple | None] = dict.fromkeys(words)
        a, b, na, nb = a[np.repeat(good, na)], b[np.repeat(good, nb)], na[good], nb[good]
        j, m = np.cumsum(na), np.cumsum(nb)
        ga, ja, gb, mb = align(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), j - na, j, m - nb, m)
        groups = np.searchsorted(ga, np.r_[0, j])  # each word's first group
        pairs = ((a[ja - 1] << B_BITS) | b[mb - 1]).astype(np.int64).tobytes()  # tokens have bytes, so only the last ones of a group end together
        text = np.empty(len(a) + len(b), object)
        last_a, last_b = np.zeros(len(a), np.int8), np.zeros(len(b), np.int8)
        last_a[ja - 1], last_b[mb - 1] = 1, 1
        text[np.arange(len(a)) + np.repeat(gb, ja - ga)] = np.where(last_a, self.a_text[1][a], self.a_text[0][a])
        text[np.arange(len(b)) + np.repeat(ja, mb - gb)] = np.where(last_b, self.b_text[1][b], self.b_text[0][b])
        text, at = text.tolist(), (j + m).tolist()
        lines = ["".join(text[x:y]) for x, y in zip([0, *at], at, strict=False)]
        kept = [w for w, ok in zip(words, good.tolist(), strict=True) if ok]
        out.update(zip(kept, zip(na.tolist(), nb.tolist(), np.diff(groups).tolist(), lines, cut_up(pairs, 8 * groups[1:]), strict=True), strict=True))
        return out

    def words(self, text: str) -> list[str]:
        """The parts between single spaces that stand between two words."""
        return _CUT.split(text) if _DOUBLE.search(text) else text.split(" ")

    def aligned(self, texts: list[str]) -> list[list[tuple | None]]:
        """What ``learn`` says of each text's words; words that are not known are aligned together."""
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        rows = [self.words(t) for t in texts]
        asked = set().union(*rows).difference(known)
        fresh = asked.difference(older)
        known.update((w, older[w]) for w in asked - fresh)
        known.update(self.learn(list(fresh)))
        out = [list(map(known.__getitem__, row)) for row in rows]
        for w in fresh:
            if len(w) > LONGEST:
                del known[w]
        return out


@lru_cache(maxsize=1)
def worker_aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner and cache per Python worker, for all tasks it runs."""
    return Aligner(a_path, b_path)


class _Sums:
    """Digest columns of one document, block by block."""

    def __init__(self) -> None:
        self.good, self.n, self.sha = True, np.zeros(3, np.int64), hashlib.sha256()
        self.keys, self.many = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, words: list[tuple | None]) -> None:
        self.good = self.good and None not in words
        if not self.good:
            return
        if self.n[2]:
            self.sha.update(b";")
        self.n += (sum([w[0] for w in words]), sum([w[1] for w in words]), sum([w[2] for w in words]))
        self.sha.update("".join([w[3] for w in words])[:-1].encode())
        keys, many = np.unique(np.frombuffer(b"".join([w[4] for w in words]), np.int64), return_counts=True)
        self.keys, self.many = (keys, many) if not len(self.keys) else merged([self.keys, keys], [self.many, many])


def merged(keys: list[np.ndarray], many: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    one, back = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_inverse=True)
    return one, np.bincount(back, np.concatenate([*many, np.zeros(0, np.int64)]), len(one)).astype(np.int64)


_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_PART = f"slice long, {_DOC}, at binary, many binary, pairs array<long>, sums array<long>"


def slice_links(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """A row per document, and one per slice of documents with the slice's id pairs and their counts; documents point into those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_aligner(a_path, b_path)
        first = TaskContext.get().partitionId() << 32
        made, rows, held = 0, [], 0

        def closed() -> pa.RecordBatch:
            pairs, sums = merged([d.keys for _, d in rows], [d.many for _, d in rows])
            name = first + made
            docs = [
                [name, i, *(d.n.tolist() if d.good else (0, 0, 0)), int(d.many.sum()), d.sha.hexdigest() if d.n[2] and d.good else "",
                 np.searchsorted(pairs, d.keys).astype(np.int32).tobytes(), d.many.astype(np.int32).tobytes(), None, None]
                for i, d in rows
            ]
            docs.append([name, *[None] * 8, pairs.tolist(), sums.tolist()])
            kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*docs, strict=True), kinds, strict=True)], [x.split(" ")[0] for x in _PART.split(", ")])

        for b in text_slices(batches, 256):
            texts = [t or "" for t in column(b, "text")]
            short = iter(model.aligned([t for t in texts if t and len(t) <= 1 << 20]))
            for i, t in zip(column(b, "doc_id"), texts, strict=True):
                d = _Sums()
                if t and len(t) <= 1 << 20:
                    d.add(next(short))
                elif t:
                    for block in text_blocks(t):
                        d.add(model.aligned([block.removeprefix(" ") if block is not t and d.n[2] else block])[0])
                        if not d.good:
                            break
                if not d.good:
                    d.keys = d.many = np.zeros(0, np.int64)
                rows.append((i, d))
                held += len(t)
            if len(rows) >= SLICE_DOCS or held >= SLICE_CHARS:
                yield closed()
                made, rows, held = made + 1, [], 0
        if rows:
            yield closed()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, _PART)


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per input row, whole texts.

    Texts that are null, empty, or whose tokens of A or B do not spell space and text, have zeros and ''. Null ids
    stay null; repeated rows repeat, and count as often; extra columns are ignored; an empty table gives no rows.
    ``n_best`` counts the links whose pair's count is the highest of its B id in the corpus, ties included.
    """
    spark = docs.sparkSession
    links_path, counts_path = shared_path(spark, "token-links"), shared_path(spark, "pair-counts")
    slice_links(docs, a_path, b_path, id_col, text_col).write.parquet(links_path)
    own = spark.read.parquet(links_path)
    own = own.where(F.col("pairs").isNotNull()).select("slice", F.explode(F.arrays_zip("pairs", "sums")).alias("x")).select("slice", F.col("x.pairs").alias("pair"), F.col("x.sums").alias("n"))
    pair_counts(own).write.parquet(counts_path)
    counts = spark.read.parquet(counts_path)
    told = own.select("slice", "pair").join(if_small(counts, counts.count()), "pair").select("slice", "pair", "n", "best")
    each = spark.read.parquet(links_path).where(F.col("pairs").isNull()).drop("pairs", "sums")

    def looked_up(key: tuple, docs: pa.Table, table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("pair").to_numpy())
        count = table.column("n").to_numpy()[order]
        best = table.column("best").to_numpy(zero_copy_only=False)[order]
        n_best, total = [], []
        for at, many in zip(docs.column("at").to_pylist(), docs.column("many").to_pylist(), strict=True):
            at, many = np.frombuffer(at, np.int32), np.frombuffer(many, np.int32).astype(np.int64)
            n_best.append(int(many[best[at]].sum()))
            total.append(int((many * count[at]).sum()))
        out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))

    out = each.groupBy("slice").cogroup(told.groupBy("slice")).applyInArrow(looked_up, f"{_DOC}, n_best long, count_sum long")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def pair_counts(own: DataFrame) -> DataFrame:
    """(pair, n, best) from (slice, pair, n): the corpus-wide count of each id pair, and whether its B id has no higher one."""
    counts = own.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND((1 << B_BITS) - 1))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # a row per B id at most
    return counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))

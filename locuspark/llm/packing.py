"""Packing documents into token sequences of several context sizes.

A document's whole windows are sequences of their own. What is left of it is routed to the
smallest tier (2048, 1024, 512, 256 tokens) that holds it. Each tier is packed from the longest
down: a piece opens a window of its tier, and the gap is filled by the best fitting pieces of the
shorter tiers, the last part of it by the head of a piece that is cut. So every sequence is full,
at a power of two. Under 256 tokens remain of a task; those of 64 tasks are packed together, and
only their last sequence is padded. Full sequences are dealt to step groups of equal tokens.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.bpe import byte_alphabet
from locuspark.llm.shared import column, shared_path, text_blocks, text_slices
from locuspark.llm.token_counts import ASCII_PIECES, PIECES

#: Context sizes, longest first.
TIERS = (2048, 1024, 512, 256)
#: Pieces that wait in a task before they are packed; tasks whose rests are packed together.
POOL, TASKS = 2048, 64
#: Entries of one generation of a worker's cache (and of its pieces), and the longest word that is kept.
CACHE, LONGEST = 400_000, 64


def cut_up(data: bytes, ends: np.ndarray) -> list[bytes]:
    """The stretches of ``data`` that end at each of ``ends``."""
    at = ends.tolist()
    return [data[x:y] for x, y in zip([0, *at], at, strict=False)]


class WordIds:
    """Ids of texts for a vocabulary that drops white space, word by word: no token crosses white space.

    New words are split into pieces, new pieces encoded by the model alone; both are kept, words in two generations.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.model = Tokenizer(whole.model)
        self.added = {a.content: np.uint32(i).tobytes() for i, a in whole.get_added_tokens_decoder().items()}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.space, self.odd = regex.compile(r"\p{White_Space}+"), regex.compile("[\x1c-\x1f]")
        self.piece, self.ascii_piece = regex.compile("\n|" + PIECES), re.compile("\n|" + ASCII_PIECES)
        self.letters = byte_alphabet()
        self.words, self.older, self.pieces = dict(self.added), {}, {"\n": b""}

    def split(self, text: str) -> list[str]:
        """The stretches between white space, and special strings; four control characters are white space to Python alone."""
        out: list[str] = []
        for k, part in enumerate(self.special.split(text) if any(s in text for s in self.added) else [text]):
            out += [part] if k % 2 else [w for w in self.space.split(part) if w] if self.odd.search(part) else part.split()
        return out

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words: their pieces as the vocabulary's rules cut them, lower-cased character by character."""
        plain = [w for w in words if w.isascii()]
        other = [w for w in words if not w.isascii()]
        found = self.ascii_piece.findall("\n".join([*plain, ""]).lower())
        found += self.piece.findall(unicodedata.normalize("NFC", "\n".join([*other, ""])).replace("Σ", "σ").lower()) if other else []
        if len(self.pieces) > CACHE:
            self.pieces = {"\n": b""}
        new = list(set(found).difference(self.pieces))
        shown = [p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(self.letters) for p in new]
        for at in range(0, len(new), 4096):
            done = self.model.encode(shown[at : at + 4096], is_pretokenized=True, add_special_tokens=False)
            ends = np.searchsorted(done.word_ids, np.arange(len(new[at : at + 4096])), side="right")
            self.pieces.update(zip(new[at : at + 4096], cut_up(np.array(done.ids, np.uint32).tobytes(), 4 * ends), strict=True))
        values = list(map(self.pieces.__getitem__, found))
        size = np.fromiter(map(len, values), np.int64, len(values))
        return dict(zip(plain + other, cut_up(b"".join(values), np.cumsum(size)[size == 0]), strict=True))  # only the line ends between words are empty

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if len(self.words) > CACHE:
            self.words, self.older = dict(self.added), self.words
        rows = [self.split(t) for t in texts]
        asked = set().union(*rows).difference(self.words)
        fresh = asked.difference(self.older)
        self.words.update((w, self.older[w]) for w in asked - fresh)
        self.words.update(self.learn(list(fresh)))
        out = [b"".join(map(self.words.__getitem__, row)) for row in rows]
        for w in fresh:
            if len(w) > LONGEST:
                del self.words[w]
        return out

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        """The same for texts of any length, a long one block by block."""
        blocks = [list(text_blocks(t)) for t in texts]
        done = iter(self.encode([b for bs in blocks if len(bs) == 1 for b in bs]))
        return [next(done) if len(bs) == 1 else b"".join(self.encode([b])[0] for b in bs) for bs in blocks]


@lru_cache(maxsize=2)
def worker_ids(path: str) -> WordIds:
    """One encoder and cache per Python worker, for all tasks it runs."""
    return WordIds(path)


class Piece:
    """A run of a document's ids: where it starts, the ids as bytes, and the document's number of ids."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: bytes, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def __len__(self) -> int:
        return len(self.ids) >> 2

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[: 4 * n], self.total), Piece(self.doc, self.start + n, self.ids[4 * n :], self.total)


class Pool:
    """Waiting pieces by length, with a bit set for each length that is there."""

    def __init__(self) -> None:
        self.by: dict[int, list[Piece]] = defaultdict(list)
        self.bits, self.count, self.tokens = 0, 0, 0

    def put(self, piece: Piece) -> None:
        n = len(piece)
        self.by[n].append(piece)
        self.bits |= 1 << n
        self.count += 1
        self.tokens += n

    def take(self, n: int) -> Piece:
        piece = self.by[n].pop()
        if not self.by[n]:
            self.bits &= ~(1 << n)
        self.count -= 1
        self.tokens -= n
        return piece

    def longest(self, most: int) -> int:
        """The greatest length of at most ``most``; 0 if there is none."""
        low = self.bits & ((1 << (most + 1)) - 1)
        return low.bit_length() - 1 if low else 0

    def shortest(self, over: int) -> int:
        """The least length over ``over``; 0 if there is none."""
        high = self.bits >> (over + 1)
        return (high & -high).bit_length() + over if high else 0


class TierPacker:
    """Packs pieces into full windows of the tiers; what is left at last is under the smallest tier."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers, self.pool = tiers, Pool()

    def add(self, doc, ids: bytes) -> Iterator[list[Piece]]:
        """Route one document: its whole windows come out at once, the rest waits in its tier."""
        rest, window = Piece(doc, 0, ids, len(ids) >> 2), self.tiers[0]
        while len(rest) >= window:
            head, rest = rest.cut(window)
            yield [head]
        if len(rest):
            self.pool.put(rest)

    def window(self, tier: int) -> list[Piece]:
        """One full window: the longest piece that fits it, then its gap from shorter pieces, the last one cut."""
        pool, out, gap = self.pool, [], tier
        while gap:
            n = pool.longest(gap)
            if n:
                out.append(pool.take(n))
                gap -= n
            else:
                head, rest = pool.take(pool.shortest(gap)).cut(gap)
                out.append(head)
                pool.put(rest)
                gap = 0
        return out

    def pack(self, last: bool) -> Iterator[list[Piece]]:
        """Pack the tiers from the longest down; before the end, short pieces are kept for the gaps to come."""
        pool = self.pool
        for k, tier in enumerate(self.tiers):
            below = self.tiers[k + 1] if k + 1 < len(self.tiers) else 0
            while pool.tokens >= tier and pool.longest(tier) > below and (last or pool.count > POOL // 2):
                yield self.window(tier)
        for tier in self.tiers if last else ():
            while pool.tokens >= tier:  # only pieces of shorter tiers are left
                yield self.window(tier)


_SHAPE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context int, step_group long, ids binary, task int"
_NAMES = [x.split(" ")[0] for x in _SHAPE.split(", ")]


class _Rows:
    """Sequences as rows: ids within a task, offsets, and step groups of ``step_tokens`` of one context size."""

    def __init__(self, first: int, step_tokens: int, with_ids: bool, task: int):
        self.first, self.step_tokens, self.with_ids, self.task = first, step_tokens, with_ids, task
        self.rows: list[tuple] = []
        self.made, self.of = 0, defaultdict(int)

    def put(self, pieces: list[Piece]) -> None:
        size, at = sum(map(len, pieces)), 0
        context = size if size in TIERS else TIERS[0]
        step = self.first + (TIERS.index(context) << 28) + self.of[context] * context // self.step_tokens
        for p in pieces:
            ids = p.ids if self.with_ids else None
            self.rows.append((p.doc, p.start, len(p), zlib.crc32(p.ids), p.total, self.first + self.made, at, context, step, ids, None))
            at += len(p)
        self.made += 1
        self.of[context] += 1

    def wait(self, p: Piece) -> None:
        """A piece that the task could not pack."""
        self.rows.append((p.doc, p.start, len(p), None, p.total, None, None, None, None, p.ids, self.task))

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.binary(), pa.int32()]
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows, strict=True), kinds, strict=True)], _NAMES)
        self.rows = []
        return out


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, step_tokens: int = 32_768, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step_group and, if asked for, its ids.

    ``context`` is the window a sequence is padded to: its own length at 2048, 1024, 512 or 256, else 2048. Full
    sequences of one size and task fill step groups of ``step_tokens`` tokens. A null or empty text is its end id
    alone; null ids stay null; repeated rows are documents of their own; extra columns are ignored; an empty table
    gives no rows. A document is cut at whole windows and where its piece fills the last part of a gap. Pieces are
    written to the shared folder once, so sequence ids are those of one run.
    """
    spark = docs.sparkSession
    end = np.uint32(end_id).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, packer = worker_ids(path), TierPacker()
        task = TaskContext.get().partitionId()
        rows = _Rows(task << 32, step_tokens, with_ids, task)
        for b in text_slices(batches, 512):
            for doc, ids in zip(column(b, "doc_id"), model.encode_whole([t or "" for t in column(b, "text")]), strict=True):
                for pieces in packer.add(doc, ids + end):
                    rows.put(pieces)
                if packer.pool.count >= POOL:
                    for pieces in packer.pack(last=False):
                        rows.put(pieces)
            if rows.rows:
                yield rows.batch()
        for pieces in packer.pack(last=True):
            rows.put(pieces)
        while n := packer.pool.longest(TIERS[0]):
            rows.wait(packer.pool.take(n))
        if rows.rows:
            yield rows.batch()

    def rests(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """The rests of some tasks, in full windows and one padded one."""
        rows, packer = _Rows((1 << 61) + (key[0] << 32), step_tokens, with_ids, 0), TierPacker()
        frame = frame.sort_values(["task", "doc_id", "start"])
        for r in frame.itertuples(index=False):
            packer.pool.put(Piece(None if r.doc_id is None else int(r.doc_id), int(r.start), r.ids, int(r.doc_tokens)))
        while packer.pool.tokens >= TIERS[0]:
            rows.put(packer.window(TIERS[0]))
        if packer.pool.count:
            last = []
            while n := packer.pool.longest(TIERS[0]):
                last.append(packer.pool.take(n))
            rows.put(last)
        return rows.batch().to_pandas(types_mapper={pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}.get)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = shared_path(spark, "packed")
    texts.mapInArrow(run, _SHAPE).write.parquet(out)
    made = spark.read.parquet(out)
    some = made.where(F.col("task").isNotNull()).select(F.col("doc_id").cast("string"), "start", "doc_tokens", "ids", "task")
    rest = some.groupBy(F.floor(F.col("task") / TASKS).alias("tasks")).applyInPandas(rests, _SHAPE)
    return made.where(F.col("task").isNull()).union(rest).drop("task", *([] if with_ids else ["ids"]))

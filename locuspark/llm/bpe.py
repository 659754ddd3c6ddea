"""BPE encoding and decoding with a pair occurrence index.

All new pre-tokens of a batch are laid out as one row of symbols. An index maps each
adjacent pair that has a rank to all its positions. Ranks are applied in ascending order;
a merge updates the index lists of the pairs to its left and right. Pieces that are done
stay in the worker's bounded cache.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.shared import column, text_slices

#: The byte-level pre-token pattern (fixed values).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Entries of a worker's cache, after which it starts anew.
CACHE = 150_000
#: Documents whose new pieces are merged together.
GROUP = 2048


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class PairIndexBPE:
    """Encoder and decoder for a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_alphabet()
        value = {c: b for b, c in letters.items()}
        self.of_byte = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.bytes_of = {i: bytes(value[c] for c in t) for t, i in vocab.items() if all(c in value for c in t)}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.merges: list[tuple[int, int, int]] = []
        made: dict[int, int] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            one = (vocab[a], vocab[b], vocab[a + b])
            if made.get(one[0], -1) >= rank or made.get(one[1], -1) >= rank:
                raise ValueError("a merge uses a symbol before it is made; ascending ranks would not be final")
            made.setdefault(one[2], rank)
            self.merges.append(one)
        pairs = np.array([(a << 20) | b for a, b, _ in self.merges], np.int64)
        self.keys, self.ranks = np.unique(pairs, return_index=True)
        self.piece = regex.compile(PIECES)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache: dict[str, tuple[int, str, bytes]] = {}

    def rank_of(self, sym: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs of symbols at left and right; -1 for pairs that never merge."""
        key = (sym[left] << 20) | sym[right]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece, all pieces merged together through one pair index."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        sym = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        nxt = np.arange(1, len(sym) + 1)
        prv = np.arange(-1, len(sym) - 1)
        full = sizes > 0
        nxt[ends[full] - 1] = -1
        prv[(ends - sizes)[full]] = -1
        where: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def index(left: np.ndarray, right: np.ndarray) -> None:
            """Add pairs to the lists of their ranks."""
            rank = self.rank_of(sym, left, right)
            left, rank = left[rank >= 0], rank[rank >= 0]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            left, rank = left[order], rank[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, at in zip(rank[np.r_[0, cut]].tolist(), np.split(left, cut), strict=True):
                if r not in where:
                    where[r] = []
                    heapq.heappush(active, r)
                where[r].append(at)

        i = np.flatnonzero(nxt >= 0)
        index(i, nxt[i])
        while active:
            rank = heapq.heappop(active)
            a, b, new = self.merges[rank]
            i = np.unique(np.concatenate(where.pop(rank)))
            j = nxt[i]
            i = i[(sym[i] == a) & (j >= 0) & (sym[j] == b)]  # an earlier merge may have taken one of the two
            if a == b:  # of overlapping pairs in a row the left one goes first
                taken, keep = -1, []
                for x in i.tolist():
                    if x != taken:
                        keep.append(x)
                        taken = nxt[x]
                i = np.array(keep, np.int64)
            if not len(i):
                continue
            j = nxt[i]
            k = nxt[j]
            sym[i], sym[j] = new, -1
            nxt[i] = k
            prv[k[k >= 0]] = i[k >= 0]
            p = prv[i]
            index(np.concatenate([p[p >= 0], i[k >= 0]]), np.concatenate([i[p >= 0], k[k >= 0]]))
        alive = np.flatnonzero(sym >= 0)
        ids, upto = sym[alive].tolist(), np.searchsorted(alive, ends).tolist()
        return [ids[x:y] for x, y in zip([0, *upto], upto, strict=False)]

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens and special strings of a text, in order."""
        if self.split and any(x in text for x in self.special):
            out: list[str] = []
            for k, part in enumerate(self.split.split(text)):
                out += [part] if k % 2 else self.piece.findall(part)
            return out
        return self.piece.findall(text)

    def looked_up(self, texts: list[str]) -> list[list[tuple[int, str, bytes]]]:
        """For each text, (tokens, ids as text, bytes) of its pieces, in order; new pieces are merged together first.

        Pieces that are known are kept as references into the cache, new ones once each.
        """
        if len(self.cache) > CACHE:
            self.cache = {}
        get, fresh, out = self.cache.get, {}, []
        for t in texts:
            out.append([get(p) or fresh.setdefault(p, p) for p in self.pieces(t)])
        if fresh:
            self.learn(list(fresh))
            known = self.cache
            out = [[known[d] if type(d) is str else d for d in row] for row in out]
        return out

    def learn(self, new: list[str]) -> None:
        """Put new pieces into the cache."""
        plain = [p for p in new if p not in self.special]
        for p, ids in zip(plain, self.encode_pieces([p.encode("utf-8") for p in plain]), strict=True):
            self.cache[p] = (len(ids), ",".join(map(str, ids)), b"".join(self.bytes_of[i] for i in ids))
        for p in set(new) & self.special.keys():
            self.cache[p] = (1, str(self.special[p]), self.bytes_of[self.special[p]])

    def ids(self, text: str) -> list[int]:
        return [int(i) for d in self.looked_up([text])[0] for i in d[1].split(",")]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def worker_model(path: str) -> PairIndexBPE:
    """One model and cache per Python worker, for all tasks it runs."""
    return PairIndexBPE(path)


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256), one row per input row; ids only if asked for.

    Whole texts are encoded; null and empty ones have no tokens. Special strings inside
    texts are their own ids, none are added. Decoding goes from the ids back through the
    vocabulary's bytes. Repeated rows repeat; extra columns are ignored; an empty table
    gives no rows.
    """

    names = ["doc_id", "n_tokens", *(["ids"] if with_ids else []), "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(path)
        for b in text_slices(batches, GROUP):
            rows = model.looked_up([t or "" for t in column(b, "text")])
            n, ids, digest, back = [], [], [], []
            for k, done in enumerate(rows):
                rows[k] = None
                line = ",".join([d[1] for d in done])
                n.append(sum([d[0] for d in done]))
                digest.append(hashlib.sha256(line.encode()).hexdigest())
                text = b"".join([d[2] for d in done]).decode("utf-8", "replace")
                back.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
                if with_ids:
                    ids.append(np.array(line.split(","), np.int32) if line else np.zeros(0, np.int32))
            out = [b.column(0), pa.array(n, pa.int64()), *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), pa.array(digest, pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shape = "doc_id long, n_tokens long, " + ("ids array<int>, " if with_ids else "") + "ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, shape)


def bpe_decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from token ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(path)
        for b in text_slices(batches):
            text = pa.array([None if x is None else model.decode(x) for x in column(b, "ids")], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), text], ["doc_id", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")

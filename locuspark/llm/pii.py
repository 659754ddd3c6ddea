"""Personal data: fixed patterns, and a semi-Markov conditional random field for what they miss.

The field works on chains of atoms (digit groups with short separators between them, or the
names of a written-out address). A segment gets a label; its length is bounded by what the kinds
allow: 19 digits, or a written address from its first name on. Features look at the whole span:
digits in all, groups, separators, checksum, octets, cue words. The best segmentation, boundaries and labels together, is found by dynamic programming over
segment ends. Spans of the fixed patterns are given: the field labels only what is
outside them. Weights are fitted here by maximum likelihood on generated examples.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuspark.llm.shared import column, text_slices

KINDS = ("email", "ip", "card", "phone")
#: Digits of the longest entity.
MOST_DIGITS = 19

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SOME = re.compile(r"[0-9@]|[(\[] ?at ?[)\]]", re.I)
_GROUP = re.compile(r"[0-9]++")
_GAP = re.compile(r"[ ().\-/]{1,3}\Z")
_AT = r" ?[(\[] ?at ?[)\]] ?"
_DOT = r" ?(?:\.|[(\[] ?dot ?[)\]]) ?"
_WRITTEN = re.compile(rf"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++){_AT}([A-Za-z0-9-]++)((?:{_DOT}[A-Za-z0-9-]++)++)", re.I)
_NAME = re.compile(rf"{_DOT}([A-Za-z0-9-]++)", re.I)
_CUES = {"email": ("mail", "contact"), "ip": ("ip", "host", "server"), "card": ("card", "visa", "payment"), "phone": ("tel", "phone", "call", "fax", "mobile")}


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind as listed, then by start."""
    out: list[tuple[str, int, int]] = []
    end, at = 0, text.find("@")
    while at >= 0:  # from each @ to both sides: linear on any text
        left = at
        while left > end and text[left - 1] in _LOCAL_CHARS:
            left -= 1
        m = _DOMAIN.match(text, at + 1) if left < at else None
        if m:
            out.append(("email", left, m.end()))
            end = m.end()
        at = text.find("@", at + 1 if not m else max(end, at + 1))
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40:  # 19 digits and 18 separators at most
            d = re.sub("[ -]", "", m.group())
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def chains(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring digit groups, of 9 digits or more or four groups or more, and the names of written-out addresses.

    An address has four groups and every other entity nine digits, so shorter runs hold none.
    """
    out, run = [], []
    for m in _GROUP.finditer(text):
        if run and not (m.start() - run[-1][1] <= 3 and _GAP.match(text[run[-1][1] : m.start()])):
            out.append(run)
            run = []
        run.append(m.span())
    out.append(run)
    out = [r for r in out if len(r) >= 4 or sum(e - s for s, e in r) >= 9]
    return out + [[m.span(1), m.span(2), *(n.span(1) for n in _NAME.finditer(text, m.start(3), m.end(3)))] for m in _WRITTEN.finditer(text)]


def span_of(text: str, atoms: list[tuple[int, int]], i: int, j: int) -> tuple[int, int]:
    """Start and end of the segment of atoms i..j-1, with an opening + or bracket."""
    s = atoms[i][0]
    if s and text[s - 1] == "(" and text[s].isdigit() and ")" in text[s : atoms[j - 1][1]]:
        s -= 1
    if s and text[s - 1] == "+":
        s -= 1
    return s, atoms[j - 1][1]


def traits(text: str, atoms: list[tuple[int, int]], i: int, j: int) -> list[str]:
    """What the features see of a whole segment."""
    s, e = span_of(text, atoms, i, j)
    body = text[s:e]
    out = ["any"]
    if any(c.isalpha() for c in body) or re.search(_AT, text[atoms[0][1] : atoms[1][0]] if len(atoms) > 1 else "", re.I):
        last = text[atoms[j - 2][1] : s] if j - i < 2 else text[atoms[j - 2][1] : atoms[j - 1][0]]
        name = text[atoms[j - 1][0] : e]
        out += ["written", "from-name" if i == 0 else "from-host", f"names-{min(j - i, 4)}", "rest" if j < len(atoms) else "whole"]
        out.append("sentence" if last.startswith(".") and last.endswith(" ") else "dot" if "." in last else "written-dot")
        return [*out, "capital" if name[:1].isupper() and not name.isupper() else "plain", "top-level" if name.isalpha() and len(name) >= 2 else "no-top-level"]
    groups = [text[a:b] for a, b in atoms[i:j]]
    n = sum(map(len, groups))
    seps = {c for k in range(i, j - 1) for c in text[atoms[k][1] : atoms[k + 1][0]]}
    out.append(f"digits-{n if 9 <= n <= 12 else 'few' if n < 9 else '13-15' if n < 16 else '16' if n == 16 else '17-19' if n < 20 else 'many'}")
    out.append(f"groups-{min(j - i, 5)}")
    out.append("seps-" + "".join(sorted(seps)) if len(seps) < 3 else "seps-mixed")
    if body[0] == "+":
        out.append("plus")
    if 13 <= n <= 19:
        out.append("luhn" if luhn("".join(groups)) else "not-luhn")
    if j - i == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups):
        out.append("octets" + "".join(sorted(seps)))
    sizes = [len(g) for g in groups]
    if max(sizes) == 1:
        out.append("single-digits")
    if sizes[-2:] == [3, 4] and (j - i == 3 or (j - i == 4 and sizes[0] <= 3)) and sizes[-3] == 3:
        out.append("3-3-4")
    if sizes[:3] == [4, 4, 4]:
        out.append("4-4-4")
    if (s and text[s - 1].isalnum()) or (e < len(text) and text[e].isalnum()):
        out.append("glued")
    before = text[max(0, s - 16) : s].lower()
    out += [f"cue-{k}" for k, cues in _CUES.items() if any(c in before for c in cues)]
    return out


def union(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the disjoint stretches that the spans cover, in order."""
    starts, ends = [], []
    for s, e in sorted((s, e) for _, s, e in spans):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def touches(stretches: tuple[list[int], list[int]], s: int, e: int) -> bool:
    """Whether [s, e) shares a position with a stretch."""
    starts, ends = stretches
    k = bisect_left(starts, e)
    return k > 0 and ends[k - 1] > s


class SemiMarkov:
    """Weights per (label, trait) and per label change; best and expected segmentations."""

    def __init__(self) -> None:
        self.w: dict[tuple[str, str], float] = {}

    def span_score(self, label: str, seen: list[str]) -> float:
        return sum([self.w.get((label, x), 0.0) for x in seen])

    def score(self, label: str, seen: list[str], prev: str) -> float:
        return self.span_score(label, seen) + self.w.get((label, "after-" + prev), 0.0)

    @staticmethod
    def segments(text: str, atoms: list, barred: tuple[list[int], list[int]]) -> dict[int, list[tuple[int, str, list[str]]]]:
        """By end: (start, label, traits); labels other than O only where no given span is.

        A phone number has 9 to 15 digits, not all of them apart, a card 13 to 19 that pass Luhn, an address four
        groups of up to three; a written address begins with its chain.
        """
        out: dict[int, list] = {}
        written = len(atoms) > 1 and not _GAP.match(text[atoms[0][1] : atoms[1][0]])
        upto = [0]
        for s, e in atoms:
            upto.append(upto[-1] + e - s)
        for j in range(1, len(atoms) + 1):
            out[j] = [(j - 1, "O", ["one"])]
            for i in (0,) if written else range(j - 1, -1, -1):
                n = upto[j] - upto[i]
                if written:
                    kinds = ("email",)
                elif n > MOST_DIGITS:
                    break
                else:
                    four = j - i == 4 and n <= 12 and all(b - a <= 3 for a, b in atoms[i:j])
                    card = 13 <= n <= 19 and luhn("".join([text[a:b] for a, b in atoms[i:j]]))
                    kinds = (*(("ip",) if four else ()), *(("card",) if card else ()), *(("phone",) if 9 <= n <= 15 and n > j - i else ()))
                if not kinds:
                    continue
                s, e = span_of(text, atoms, i, j)
                if touches(barred, s, e):
                    continue
                seen = traits(text, atoms, i, j)
                out[j] += [(i, k, seen) for k in kinds]
        return out

    def best(self, text: str, atoms: list, barred: tuple[list[int], list[int]]) -> list[tuple[str, int, int]]:
        segs, states = self.segments(text, atoms, barred), ("O", *KINDS)
        after = {label: [(p, self.w.get((label, "after-" + p), 0.0)) for p in states] for label in states}
        at: dict[tuple[int, str], tuple[float, tuple | None, int]] = {(0, "O"): (0.0, None, 0)}
        scores: dict[tuple[str, ...], dict[str, float]] = {}  # of each set of traits met
        for j in range(1, len(atoms) + 1):
            into: dict[tuple[int, str], tuple[float, tuple]] = {}  # the best way into a segment of a label that starts at i
            for i, label, seen in segs[j]:
                if (i, label) not in into:
                    into[i, label] = max(((at[i, p][0] + w, (i, p)) for p, w in after[label] if (i, p) in at), key=lambda x: x[0])
                known = scores.setdefault(tuple(seen), {})
                if label not in known:
                    known[label] = self.span_score(label, seen)
                v, prev = into[i, label]
                v += known[label]
                if (j, label) not in at or v > at[j, label][0]:
                    at[j, label] = (v, prev, i)
        state = max((k for k in at if k[0] == len(atoms)), key=lambda k: at[k][0])
        out = []
        while state[0]:
            _, prev, i = at[state]
            if state[1] != "O":
                out.append((state[1], *span_of(text, atoms, i, state[0])))
            state = prev
        return out

    def gradient(self, text: str, atoms: list, gold: dict[tuple[int, int], str]) -> tuple[dict[tuple[str, str], float], float]:
        """Gradient and value of the log-likelihood, by forward and backward sums over segmentations."""
        segs, n, states = self.segments(text, atoms, ([], [])), len(atoms), ("O", *KINDS)
        arcs = [(i, j, label, prev, seen) for j in segs for i, label, seen in segs[j] for prev in (states if i else ("O",))]
        val = [self.score(a[2], a[4], a[3]) for a in arcs]
        fore, back = {(0, "O"): 0.0}, {(n, s): 0.0 for s in states}
        for k in sorted(range(len(arcs)), key=lambda k: arcs[k][1]):
            i, j, label, prev, _ = arcs[k]
            if (i, prev) in fore:
                v = fore[i, prev] + val[k]
                fore[j, label] = np.logaddexp(fore[j, label], v) if (j, label) in fore else v
        for k in sorted(range(len(arcs)), key=lambda k: -arcs[k][0]):
            i, j, label, prev, _ = arcs[k]
            if (j, label) in back:
                v = back[j, label] + val[k]
                back[i, prev] = np.logaddexp(back[i, prev], v) if (i, prev) in back else v
        z = back[0, "O"]
        grad: dict[tuple[str, str], float] = {}
        for k, (i, j, label, prev, seen) in enumerate(arcs):
            if (i, prev) in fore and (j, label) in back:
                p = math.exp(fore[i, prev] + val[k] + back[j, label] - z)
                for x in (*seen, "after-" + prev):
                    grad[label, x] = grad.get((label, x), 0.0) - p
        at, prev, value = 0, "O", -z
        while at < n:
            j = next((j for (i, j) in gold if i == at), at + 1)
            label = gold.get((at, j), "O")
            seen = traits(text, atoms, at, j) if label != "O" else ["one"]
            for x in (*seen, "after-" + prev):
                grad[label, x] = grad.get((label, x), 0.0) + 1
            value += self.score(label, seen, prev)
            at, prev = j, label
        return grad, float(value)

    def step(self, text: str, atoms: list, gold: dict[tuple[int, int], str], rate: float) -> None:
        """One gradient step, with a little decay of the weights."""
        for k, g in self.gradient(text, atoms, gold)[0].items():
            self.w[k] = self.w.get(k, 0.0) + rate * (g - 0.002 * self.w.get(k, 0.0))


def examples(n: int, seed: int) -> Iterator[tuple[str, str, int, int]]:
    """Generated (text, kind or O, start, end): personal data in many spellings, and numbers that are none."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    for _ in range(n):
        kind = rng.choice((*KINDS, "O", "O", "O"))
        cue, follow = rng.choice(("", "", *_CUES.get(kind, ("no", "item")))) + " ", " and"
        if kind == "email":
            dot, names = rng.choice((" (dot) ", " [dot] ", ".")), [rng.choice(("host", "mail", "my-site", "example", "x1")) for _ in range(rng.choice((1, 1, 2, 2, 7)))]
            body = f"{rng.choice(('jo', 'ann.b', 'x_1'))} {rng.choice(('(at)', '[at]'))} {dot.join([*names, rng.choice(('org', 'com', 'de', 'net', 'info'))])}"
            follow = rng.choice((" and", " and", ". Then", ". Please", ". We"))
        elif kind == "ip":
            body = rng.choice((".", " . ", ". ")).join(str(rng.choice((rng.randrange(256), rng.randrange(256), 10, 192, 0, 1))) for _ in range(4))
            if max(map(len, body.replace(".", " ").split())) == 1:
                kind = "O"  # numbers of a list
        elif kind == "card":
            d = rng.choice("3456") + digits(14)
            d += next(c for c in "0123456789" if luhn(d + c))
            n = rng.choice((4, 4, 1))
            body = rng.choice((".", "/", " - ", ". ") if n == 4 else ("/", ".", " / ")).join(d[k : k + n] for k in range(0, 16, n))
        elif kind == "phone":
            sep = rng.choice("-. ")
            body = rng.choice((f"({digits(3)}) {digits(3)}{sep}{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"1-{digits(3)}-{digits(3)}-{digits(4)}"))
        else:
            sep = rng.choice((" ", "-", ".", "/", ", "))
            first = rng.randrange(1, 5)
            body = rng.choice((digits(9), digits(10), digits(16), digits(22), rng.choice(("/", ".", " ", " / ", "-")).join(digits(rng.randrange(6, 24))), rng.choice((" ", ". ", ".) ")).join(str(first + k) for k in range(rng.randrange(4, 8))), " ".join(digits(rng.randrange(1, 4)) for _ in range(rng.randrange(4, 9))), sep.join(digits(rng.randrange(1, 6)) for _ in range(rng.randrange(2, 7))), f"20{digits(2)}-{digits(2)}-{digits(2)} {digits(2)}-{digits(2)}"))
        yield f"on {cue}{body}{follow}", kind, len(cue) + 3, len(cue) + 3 + len(body)


@lru_cache(maxsize=2)
def fitted(n: int = 420, epochs: int = 6, seed: int = 3) -> SemiMarkov:
    """The field with weights of maximum likelihood on ``n`` generated examples."""
    model = SemiMarkov()
    made = list(examples(n, seed))
    for epoch in range(epochs):
        for text, kind, s, e in made:
            for atoms in chains(text):
                gold = {}
                if kind != "O":
                    inside = [k for k, (a, b) in enumerate(atoms) if s <= a and b <= e]
                    if inside:
                        gold[inside[0], inside[-1] + 1] = kind
                model.step(text, atoms, gold, 0.3 / (1 + epoch))
    return model


def find_spans(text: str, model: SemiMarkov) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each by kind as listed, then by start."""
    if not _SOME.search(text):
        return [], []
    base = base_spans(text)
    order = lambda x: (KINDS.index(x[0]), x[1], x[2])
    barred = union(base)
    added = []
    for atoms in chains(text):
        if not all(touches(barred, a, b) for a, b in atoms):
            added += model.best(text, atoms, barred)
    return base, sorted([*base, *added], key=order)


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans, base_list): arrays of (kind, start, end) in code points, end exclusive.

    One row per input row, repeated rows included. Null and empty texts hold none. Extra
    columns are ignored, whatever their names; an empty table gives no rows; a null id stays
    null; texts are read whole, in time linear in their length.
    """
    model = fitted()
    one = "array<struct<kind:string,start:long,end:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        shaped = lambda x: [{"kind": k, "start": s, "end": e} for k, s, e in x]
        for b in text_slices(batches):
            got = [find_spans(t or "", model) for t in column(b, "text")]
            spans = [pa.array([shaped(x[k]) for x in got], kind) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *spans], ["doc_id", "base", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, base {one}, spans {one}")


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans as text, from find_pii's rows."""
    line = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every span of personal data replaced by [KIND]; all columns stay, null texts too."""
    model = fitted()

    def clean(t: str | None) -> str | None:
        spans = sorted(find_spans(t or "", model)[1], key=lambda x: (x[1], -x[2]))
        if not spans:
            return t
        parts, at = [], 0
        for kind, s, e in spans:
            if s >= at:
                parts += [t[at:s], f"[{kind.upper()}]"]
            at = max(at, e)
        return "".join([*parts, t[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            k = b.schema.get_field_index(text_col)
            arrays = list(b.columns)
            arrays[k] = pa.array([clean(t) for t in column(b, text_col)], b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)

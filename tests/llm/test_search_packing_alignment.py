"""Ranked search, packing and token alignment against brute force."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from locuspark.llm import alignment, lexical_search, packing
from locuspark.llm.queries import QUERIES, tokenizer_path
from tests.oracle import connect, normal

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, score int, n long, task int"  # names the operators use themselves
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def docs(spark, texts, first=0):
    rows = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], DOCS)


ODD = [
    None, "", " ", "  a", "a ", "a\n b", "one  two   three", "\n", "Ab ab AB", "ÀÉ é é ﬁ ½ ｘ", "a<|endoftext|>b <|endoftext|> c", "A<|ENDOFTEXT|>", "<s> x </s> <unk>",
    "it's they'll 'S we've", "x\x00y \x1c z\x1fq", "a▁b", "日本語 テキスト 日本", "　 a b c", "😀 👩‍👩‍👧 é", "123 4567 8,9.0", "word " * 900, "é" * 700, "tab\tin\r\nlines\x0b\x0c", "İstanbul ΣΑΣ ς", "same text", "same text",
]


# ranked search


def ranked(items, texts, k=20):
    """Scores of all pairs, plainly."""
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    tf = {i: Counter(WORD.findall(low(t))) for i, t in texts}
    size = {i: sum(c.values()) for i, c in tf.items() if c}
    n, total = len(size), sum(size.values())
    df = Counter(w for c in tf.values() for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, length in size.items():
            m = 75 + (25 * length * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1000000000 * tf[d][w]) // (1000 * tf[d][w] + 12 * m)) for w in WORD.findall(low(text)))
            if s > 0:
                scores.append((-s, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def test_search_equals_all_pairs_with_ties_and_odd_texts(spark):
    rng = random.Random(3)
    words = ["w%d" % i for i in range(60)] + ["É", "Zz", "7"]
    texts = list(enumerate([*ODD, *[" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(700)], *["tie tie w1"] * 40]))
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(30)] + [(40, None), (41, ""), (42, "tie"), (43, "nowhere"), (44, "W1 w1 w1, W2"), (45, "é")]
    got = lexical_search.ranked_search(spark.createDataFrame(items, "item_id long, text string"), docs(spark, texts).repartition(5))
    want = ranked(items, texts)
    assert sorted(map(tuple, got.collect())) == want
    small = lexical_search.ranked_search(spark.createDataFrame(items, "item_id long, text string"), docs(spark, texts), batch_bytes=300)
    assert sorted(map(tuple, small.collect())) == want


def test_search_null_ids_repeated_rows_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b"), (1, "c")], "item_id long, text string")
    got = lexical_search.ranked_search(items, docs(spark, [(None, "a b c"), (5, "a b c"), (5, "a b c"), (2, "zzz")]))
    assert [(r.item_id, r["rank"], r.doc_id) for r in got.orderBy("item_id", "rank").collect()] == [(1, 1, None), (1, 1, None), (1, 2, 5), (1, 2, 5), (1, 3, 5), (1, 3, 5)]
    assert lexical_search.ranked_search(items, docs(spark, [])).count() == 0
    assert lexical_search.ranked_search(items.limit(0), docs(spark, ["a"])).count() == 0


def test_search_matches_sql(spark):
    got = QUERIES["op11_lexical_search"](spark, SF).toPandas()
    assert normal(got) == normal(connect(SF).execute(lexical_search.ORACLE_SQL).df())
    assert got.groupby("item_id").size().max() == 20


def test_vocabulary_tiles_stay_exact(monkeypatch):
    monkeypatch.setattr(lexical_search, "EXACT", 40_000_000)
    items = [Counter({0: 30, 1: 2}), Counter({1: 1, 2: 5}), Counter()]
    tiles = lexical_search.item_tiles(items, np.array([3, 10, 1]))
    seen = defaultdict(int)
    for chosen, parts in tiles:
        for term, repeats in parts:
            assert ((repeats * np.maximum(np.array([3, 10, 1])[term], 1)[:, None] * 1_000_000).sum(axis=0) < 40_000_000).all()
            for t, row in zip(term, repeats, strict=True):
                for k, q in zip(chosen, row, strict=True):
                    seen[k, t] += int(q)
    assert {x: q for x, q in seen.items() if q} == {(k, t): q for k, c in enumerate(items) for t, q in c.items()}


def test_long_texts_are_read_in_blocks_at_terms():
    data = ("Alpha beta, " * 5000 + "x" * 3000 + " end").encode()
    assert [w for block in lexical_search.terms(data, 100) for w in block] == [w.lower().encode() for w in WORD.findall(data.decode())]


# packing


def whole_ids(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    model.no_truncation()
    model.no_padding()
    return [[*e.ids, 1] for e in model.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_packed(rows, want):
    """Pieces make up every document's ids once; sequences are gapless and of at most 2048 tokens. Returns the padded share."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(want)
    for d, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        assert [p.start for p in pieces] == np.cumsum([0, *[p.length for p in pieces]])[:-1].tolist()
        assert sum(p.length for p in pieces) == len(want[d]) == pieces[0].doc_tokens
        for p in pieces:
            assert p.length > 0 and p.doc_tokens == len(want[d])
            assert p.ids_crc32 == zlib.crc32(np.array(want[d][p.start : p.start + p.length], "<u4").tobytes())
    padded = 0
    for pieces in by_seq.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0, *[p.length for p in pieces]])[:-1].tolist()
        size = sum(p.length for p in pieces)
        assert size <= 2048
        padded += 0 if size & (size - 1) == 0 else 2048 - size
        assert {p.context for p in pieces} == {size if size in packing.TIERS else 2048} and len({p.step_group for p in pieces}) == 1
    return padded


def test_packing_odd_texts(spark):
    rng = random.Random(1)
    texts = [*ODD, *[" ".join(rng.choices(["alpha", "beta", "gamma,", "Δέλτα", "x1"], k=rng.randint(0, 3000))) for _ in range(120)]]
    rows = packing.pack_documents(docs(spark, texts).repartition(3), tokenizer_path("word_bpe_49k.json")).collect()
    assert check_packed(rows, dict(enumerate(whole_ids(texts)))) < 2048


def test_packing_the_given_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = table.collect()
    rows = QUERIES["op12_packing"](spark, SF).collect()
    padded = check_packed(rows, dict(zip([r.doc_id for r in texts], whole_ids([r.text for r in texts]), strict=True)))
    assert padded < 2048


def test_packing_null_and_repeated_ids_returned_ids_and_empty_tables(spark):
    big = (1 << 62) + 1
    got = packing.pack_documents(docs(spark, [(None, "a b"), (None, None), (big, "c"), (big, "c")]), tokenizer_path("word_bpe_49k.json"), with_ids=True).collect()
    want = whole_ids(["a b", None, "c", "c"])
    assert sorted((r.doc_id or 0, np.frombuffer(r.ids, np.uint32).tolist()) for r in got) == sorted(zip([0, 0, big, big], want, strict=True))
    assert packing.pack_documents(docs(spark, []), tokenizer_path("word_bpe_49k.json")).count() == 0


def test_packer_fills_every_window_and_balances_steps():
    rng, packer, rows = random.Random(2), packing.TierPacker(), packing._Rows(0, 8192, False, 0)
    for d in range(3000):
        for seq in packer.add(d, bytes(4 * rng.choice([1, 3, 80, 100, 200, 250, 300, 300, 400, 400, 700, 1500, 5000]))):
            rows.put(seq)
        if packer.pool.count >= packing.POOL:
            for seq in packer.pack(last=False):
                rows.put(seq)
            assert packer.pool.count < packing.POOL
    for seq in packer.pack(last=True):
        rows.put(seq)
    assert packer.pool.tokens < packing.TIERS[-1]
    steps, sizes = defaultdict(int), defaultdict(int)
    for r in rows.rows:
        sizes[r[5], r[7]] += r[2]
        steps[r[7], r[8]] += r[2]
    assert all(n == context for (_, context), n in sizes.items())
    short = Counter(context for (context, _), n in steps.items() if n != 8192)
    assert all(n == 1 for n in short.values()) and {c for c, _ in steps} == set(packing.TIERS)


# alignment


def aligned_plainly(texts):
    """The contract's columns from whole-text encodings."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    letters = {c: b for b, c in alignment.byte_alphabet().items()}
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    rows, pairs = [], Counter()
    for t in texts:
        want = (" " + (t or "")).encode()
        ia, ib = a.encode(" " + (t or ""), add_special_tokens=False).ids, b.encode(t or "")
        xa = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
        xb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not t or b"".join(xa) != want or b"".join(xb) != want:
            rows.append(None)
            continue
        ea, eb = np.cumsum([len(x) for x in xa]).tolist(), np.cumsum([len(x) for x in xb]).tolist()
        ends = sorted(set(ea) & set(eb))
        groups, i, k = [], 0, 0
        for e in ends:
            j, m = ea.index(e, i) + 1, eb.index(e, k) + 1
            groups.append(",".join(map(str, ia[i:j])) + "|" + ",".join(map(str, ib[k:m])))
            i, k = j, m
        link = [(x, y) for x, p in zip(ia, ea, strict=True) for y in [dict(zip(eb, ib, strict=True)).get(p)] if y is not None] if len(ea) < 3000 else None
        if link is None:
            at = dict(zip(eb, ib, strict=True))
            link = [(x, at[p]) for x, p in zip(ia, ea, strict=True) if p in at]
        pairs.update(link)
        rows.append((len(ia), len(ib), len(groups), link, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, y), n in pairs.items():
        most[y] = max(most[y], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((r[0], r[1], r[2], len(r[3]), sum(pairs[x] == most[x[1]] for x in r[3]), sum(pairs[x] for x in r[3]), r[4]))
    return out


def align_query(spark, table):
    out = alignment.align_tokenizers(table, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return {r.doc_id: tuple(r)[1:] for r in out.collect()}


def test_alignment_of_odd_texts(spark, monkeypatch):
    rng = random.Random(5)
    texts = [*ODD, *["".join(rng.choices("ab é\n\t '.1日<|>s", k=rng.randint(1, 60))) for _ in range(150)]]
    got = align_query(spark, docs(spark, texts).repartition(3))
    assert [got[i] for i in range(len(texts))] == aligned_plainly(texts)


def test_alignment_of_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_token_alignment"](spark, SF).collect()}
    assert [got[r.doc_id] for r in rows] == aligned_plainly([r.text for r in rows])


def test_alignment_of_long_texts_null_ids_and_empty_tables(spark):
    long = " ".join(random.Random(7).choices(["the", "entre", "ouaux,", "x  y"], k=300_000))
    assert len(long) > 1 << 20
    got = align_query(spark, docs(spark, [(None, long), (3, long + "▁"), (4, None)]))
    want = aligned_plainly([long, None, None])
    assert got[None] == want[0] and got[3] == want[1] and got[4] == want[2]
    assert align_query(spark, docs(spark, [])) == {}


@pytest.mark.parametrize("seed", range(40))
def test_leaf_groups_are_the_gaps_between_common_ends(seed):
    rng = random.Random(seed)
    ends, parts, at = ([], []), [], 0
    for _ in range(rng.randint(1, 30)):  # intervals side by side
        n = rng.randint(1, 60)
        here = [sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n}) for _ in range(2)]
        parts.append([len(ends[0]), len(ends[0]) + len(here[0]), len(ends[1]), len(ends[1]) + len(here[1])])
        for row, add in zip(ends, here, strict=True):
            row += [at + e for e in add]
        at += n
    i, j, k, m = np.array(parts).T
    ga, ja, gb, mb = (x.tolist() for x in alignment.align(np.array(ends[0]), np.array(ends[1]), i, j, k, m))
    assert [ends[0][x - 1] for x in ja] == sorted(set(ends[0]) & set(ends[1])) == [ends[1][x - 1] for x in mb]
    assert ga == [0, *ja[:-1]] and gb == [0, *mb[:-1]]


def test_no_intervals_no_groups():
    none = np.zeros(0, np.int64)
    assert alignment.align(none, none, none, none, none, none).shape == (4, 0)

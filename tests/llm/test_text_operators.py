"""Extraction, personal data, tokens, encoding, decontamination, quality, sharding and archives."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from locuspark.llm import bpe, decontamination, html_text, pii, quality, sharding, token_counts, warc
from locuspark.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, h long"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", 1) for i, t in enumerate(texts)], DOCS)


# html


def test_main_text_of_a_page():
    page = """<!doctype html><html><head><title>No</title><script>var a="</p>";</script></head><body><header>Site</header><nav><ul><li><a href=/>Home</a></ul></nav>
    <div class="ad banner">Buy</div><aside>Side</aside><article><h1>A &amp; B</h1><p>First <b>line</b>
    goes   on.<br>Same<p>Short.<div class="comments"><p>A reader says a long, long thing about the article that is not part of it.</p></div><form><label>Mail</label></form></article>
    <div class="cookie-notice">We use cookies</div><footer>&copy; x</footer>"""
    assert html_text.main_text(page) == "A & B\nFirst line goes on. Same\nShort."


def test_pages_without_named_main_part():
    long = "word " * 40
    page = f"<div>Menu</div><ul><li><a href=a>One long link text that goes on</a><li><a href=b>Another long link text here</a></ul><div>{long}</div><p>tail</p>"
    assert html_text.main_text(page).split("\n")[0] == long.strip()
    assert "link text" not in html_text.main_text(page)


def test_names_of_wrappers_and_articles():
    page = """<body><div class="layout has-sidebar with-menu"><div class="sidebar-left"><p>Side</p></div><article class="post category-search"><h1>A</h1><p>One.</p></article>
    <section id="talk"><article class="comment"><p>A reader says a long, long thing about the article.</p></article></section></div></body>"""
    assert html_text.main_text(page) == "A\nOne."
    assert html_text.main_text('<div id="page-menu"><p>Out</p><main><p>Text.</p></main></div>') == "Text."


@pytest.mark.parametrize("page", [None, "", "   ", "<br>", "<script>x", "<!-- never closed"])
def test_pages_without_text(page):
    assert html_text.main_text(page) == ""


def test_extract_edges(spark):
    df = spark.createDataFrame([(1, "u", "<article>x &eacute; \U0001f600</article>", "t"), (None, None, None, "t"), (1, "u", "<article>x</article>", "t")], "page_id long, url string, html string, text string")
    got = html_text.extract_text(df).collect()
    assert sorted((r.n_chars, r.text) for r in got) == [(0, ""), (1, "x"), (5, "x é \U0001f600")]
    assert html_text.extract_text(df.limit(0)).count() == 0
    assert html_text.main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"


@pytest.mark.parametrize(
    "aside",
    [
        "<form><select name=c>" + "".join(f"<option value={i}>Country {i}" for i in range(250)) + "</select></form>",
        "<form><select name=c>" + "".join(f"<optgroup label={i}><option>City {i}" for i in range(250)) + "</select></form>",
        "<nav>" + "<span class=s>x" * 400 + "</nav>",
        "<ul><li class=share>" + "<font color=red>x" * 30 + "<li>",
    ],
)
def test_unclosed_markup_does_not_reach_over_the_page(aside):
    long = "The text of the article is a paragraph of more than a hundred letters, so that it weighs as the main text does."
    reader = html_text._Lines()
    reader.feed("<option>a<option>b<optgroup label=x><option>c")
    assert [t for t, *_ in reader.stack] == ["optgroup", "option"]
    assert html_text.main_text(f"<html><body><div class=top>{aside}<p>{long}</p></div></body></html>").endswith(long)
    assert html_text.main_text(f"<html><body>{aside}<article><p>{long}</p></article></body></html>").endswith(long)


def test_window_sums_decide_and_markup_only_weighs():
    hundred = "A paragraph of main text that nothing in the markup names as such, but which is as long as any other one."
    assert html_text.main_text(f'<div><p>{hundred}</p></div><div class="story"><p>Hi.</p></div>') == f"{hundred}\nHi."
    assert html_text.main_text("<div><p>Short article of forty characters here.</p></div>") == "Short article of forty characters here."
    assert html_text.main_text(f'<p>{hundred} <span class="ad">Buy now</span> On.</p>') == f"{hundred} On."
    assert html_text.main_text(f'<div><span class="promo">Ad <span>inner</span> ad</span>{hundred}</div>') == hundred
    menu = "<ul>" + "<li><a href=x>One of the links of a menu</a>" * 9 + "</ul>"
    assert html_text.main_text(f'<body class="post">{menu}<p>{hundred}</p><p>{hundred}</p><div>© 2024 Somebody. All rights reserved.</div></body>') == f"{hundred}\n{hundred}"
    assert html_text.main_text(f"<div>Home | News | About us</div><div>x</div><p>{hundred}</p>".replace("<div>x</div>", "")) == hundred
    assert html_text.main_text(f"<article><p>{hundred}</p><p>See <a href=y>that</a></p></article><footer>Foot</footer>") == f"{hundred}\nSee that"


def test_regions_equal_plain_windows():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 5, 40):
        for _ in range(60):
            w = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 120, n)).astype(float)
            sums = [sum(w[i : i + html_text.WINDOW]) for i in range(n)]
            limit, want, inside = min(html_text.SURGE, max(sums, default=0) / 2), [], False
            for i in range(n):
                inside = sums[i] > 0 and (inside or (w[i] > 0 and sums[i] >= limit))
                want.append(inside and w[i] > 0)
            assert html_text.regions(w).tolist() == want


def test_made_pages_of_other_layouts():
    """Pages with known main text, wrapped in layouts that the tables do not hold."""
    rng = random.Random(8)
    words = "ground water level rises slowly after every winter storm because rivers carry more than fields can hold".split()
    para = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(14, 60))).capitalize() + "."
    links = "<ul>" + "".join(f"<li><a href=/{w}>{w}</a>" for w in words[:7]) + "</ul>"
    for k in range(40):
        want = [para() for _ in range(rng.randrange(1, 7))]
        body = "".join(f"<p>{x}" + rng.choice(("", "</p>")) for x in want)
        wrap = rng.choice(("<article>{}</article>", "<main>{}</main>", '<div id="content">{}</div>', "<div><div>{}</div></div>", '<section class="entry-content">{}</section>', "{}"))
        before = rng.choice((f"<nav>{links}</nav>", f'<div class="top-menu">{links}</div>', f"<header><a href=/>Site</a>{links}</header>", f"<div>{links}</div>"))
        after = rng.choice(('<aside><p>A sidebar speaks at length about quite another thing.</p></aside>', '<div class="comments"><p>I do not agree with a word of this, and here is why.</p></div>', '<div id="footer">Made by us</div>', '<form><label>Your mail</label><input></form>', '<div class="cookie-consent">We use cookies to make this site work for you.</div>'))
        page = f"<html><head><title>t</title></head><body>{before}{wrap.format(body)}{after}<script>x()</script></body></html>"
        assert html_text.main_text(page) == "\n".join(want), (k, page)


# personal data


def plain_base(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub(r"\D", "", m[0])
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return out


ONLY = "The only text of this page goes on for a while and says what it has to say, in one paragraph of its own."


@pytest.mark.parametrize("names", ['id="content-search"', 'class="share-page-article"', 'class="search-results"', 'class="widget-area-less"', 'class="my-share-of-the-story"', 'id="modal-verbs-explained"'])
def test_a_name_that_only_hints_does_not_lose_the_only_text(names):
    assert html_text.main_text(f"<body><header>Site</header><div {names}><p>{ONLY}</p></div><footer>Foot</footer></body>") == ONLY
    assert html_text.main_text(f"<body><p>Home</p><div {names}><p>{ONLY}</p></div></body>").endswith(ONLY)


@pytest.mark.parametrize("names", ['class="comment-list"', 'id="post-comments"', 'class="ad-slot-3"', 'class="cookie-notice"', 'class="left sidebar"', 'class="related-posts"'])
def test_plain_names_of_other_parts_stay_out_even_alone(names):
    assert html_text.main_text(f"<body><div {names}><p>{ONLY}</p></div></body>") == ""
    assert html_text.main_text(f"<body><article><p>Short.</p></article><div {names}><p>{ONLY * 30}</p></div></body>") == "Short."


def test_lines_of_articles_stay_whatever_stands_between():
    long = "x" * 240
    advert = '<div class="ad"><p>a</p><p>b</p><p>c</p></div>'
    assert html_text.main_text(f"<article><p>{long}</p>{advert}<p>The end.</p></article>") == f"{long}\nThe end."
    assert html_text.main_text(f"<article><h2>A</h2>{advert}<p>{long}</p></article>") == f"A\n{long}"
    assert html_text.main_text(f"<article><p>A | B</p>{advert}<p>Copyright 2020 was the year.</p></article>") == "A | B\nCopyright 2020 was the year."


def test_rights_paths_and_links_alone_on_a_page():
    assert html_text.main_text("<p>Copyright law is the subject here and nothing else.</p>") == "Copyright law is the subject here and nothing else."
    assert html_text.main_text("<div>A | B</div>") == "A | B"
    assert html_text.main_text(f"<p>{ONLY}</p><p>{ONLY}</p><p>© 2024 A Company. All rights reserved.</p>") == f"{ONLY}\n{ONLY}"
    linked = f"<p><a href=x>{ONLY}</a></p>" * 3
    assert html_text.main_text(f"<ul><li><a href=/>Home</a><li><a href=b>Blog</a></ul>{linked}") == "\n".join([ONLY] * 3)
    assert html_text.main_text("<ul><li><a href=/>Home</a><li><a href=b>Blog</a></ul>") == ""


def test_base_spans_equal_the_patterns():
    r = random.Random(6)
    for _ in range(3000):
        t = "".join(r.choice(["a", "B", "@", "@", ".", ".", "-", " ", "+", "1", "4", "0", "255", "4242", "(", ")", "\n", "é", "x.y", "%", "00"]) for _ in range(r.randrange(60)))
        assert pii.base_spans(t) == plain_base(t), t
    assert [k for k, *_ in pii.base_spans("a.b@c.de 10.0.0.255, 4242 4242 4242 4242, +1 (234) 555-7890")] == ["email", "ip", "card", "phone"]


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "a@" * 100_000, "+1 " * 100_000, "1 " * 200_000, "1 (2) " * 30_000):
        pii.find_spans(t, pii.fitted())


def test_field_adds_what_the_patterns_miss_and_leaves_plain_numbers():
    model = pii.fitted()
    kinds = lambda t: [(k, t[s:e]) for k, s, e in pii.find_spans(t, model)[1]]
    assert kinds("call (234) 555-7890 now") == [("phone", "(234) 555-7890")]
    assert kinds("write to jo (at) host (dot) org please")[0][0] == "email"
    for t in ("on 2024-01-02 at 12", "part 123456789012345678901234 of it", "commit b7db7aa4a5fcc78305", "Version 2.0.1", "1 2 3 4 5 6 7 8 9 10 11"):
        assert kinds(t) == [], t
    both = "+1 (234) 555-7890 and a@b.cd"
    assert kinds(both) == [("email", "a@b.cd"), ("phone", "+1 (234) 555-7890")]


def test_held_out_accuracy_of_the_field():
    model, right, n = pii.fitted(), 0, 0
    for text, kind, s, e in pii.examples(300, seed=99):
        got = pii.find_spans(text, model)[1]
        want = {(kind, s, e)} if kind != "O" else set()
        base = {x for x in pii.base_spans(text)}
        right += set(got) - base == want - base
        n += 1
    assert right / n >= 0.85


def all_segmentations(n):
    """All ways to cut n atoms: lists of (start, end)."""
    if n == 0:
        yield []
        return
    for i in range(n):
        for rest in all_segmentations(i):
            yield [*rest, (i, n)]


@pytest.mark.parametrize("text", ["call (234) 555-7890 now", "ip 10 . 0 . 0 . 1 up", "4242.4242/4242 - 4242 12", "jo (at) host.org. Then", "1 2 3 4 555-123-4567"])
def test_best_equals_all_segmentations(text):
    rng = random.Random(text)
    fitted = pii.fitted()
    for trial in range(4):
        model = pii.SemiMarkov()
        model.w = {k: v if trial == 0 else rng.uniform(-2, 2) for k, v in fitted.w.items()}
        for atoms in pii.chains(text):
            segs = {}
            for j, rows in model.segments(text, atoms, ([], [])).items():
                for i, label, seen in rows:
                    segs.setdefault((i, j), []).append((label, seen))
            best = None
            for cut in all_segmentations(len(atoms)):
                paths = [(0.0, "O", [])]
                for i, j in cut:
                    paths = [(v + model.score(label, seen, prev), label, [*path, (label, i, j)]) for v, prev, path in paths for label, seen in segs.get((i, j), [])]
                for v, _, path in paths:
                    if best is None or v > best[0]:
                        best = (v, path)
            want = [(label, *pii.span_of(text, atoms, i, j)) for label, i, j in best[1] if label != "O"]
            got = sorted(model.best(text, atoms, ([], [])), key=lambda x: x[1])
            score = lambda spans: sorted(spans, key=lambda x: x[1])
            assert got == score(want)


def test_entities_of_many_groups_and_names():
    found = lambda t: [(k, t[s:e]) for k, s, e in pii.find_spans(t, pii.fitted())[1]]
    assert found("write to jo [at] a.b.c.d.e.f.g.com now") == [("email", "jo [at] a.b.c.d.e.f.g.com")]
    assert found("card 4/1/1/1/1/1/1/1/1/1/1/1/1/1/1/1 here") == [("card", "4/1/1/1/1/1/1/1/1/1/1/1/1/1/1/1")]
    for t in ("scores 1/2/3/4/5/6/7/8/9/1/2/3 here", "row 0 1 1 0 1 0 0 1 1 1 0 1 0 1 1 0 1 0 1 end"):
        assert all(k == "card" for k, _ in found(t)), t


def test_gradient_equals_finite_differences():
    rng = random.Random(2)
    model = pii.SemiMarkov()
    model.w = {k: rng.uniform(-1, 1) for k in pii.fitted().w}
    text = "call (234) 555-7890 and"
    (atoms,) = pii.chains(text)
    gold = {(0, 3): "phone"}
    grad, _ = model.gradient(text, atoms, gold)
    for k in list(grad)[::3]:
        at = model.w.get(k, 0.0)
        value = []
        for d in (1e-5, -1e-5):
            model.w[k] = at + d
            value.append(model.gradient(text, atoms, gold)[1])
        model.w[k] = at
        assert abs((value[0] - value[1]) / 2e-5 - grad[k]) < 1e-4, k


def test_short_addresses_and_where_sentences_end():
    found = lambda t: [(k, t[s:e]) for k, s, e in pii.find_spans(t, pii.fitted())[1]]
    assert found("host 10 . 0 . 0 . 1 is up") == [("ip", "10 . 0 . 0 . 1")]
    assert found("Mail jo (at) host (dot) org. Then wait.") == [("email", "jo (at) host (dot) org")]
    assert found("x" * 300 + "jo (at) " + "h" * 200 + " (dot) org") == [("email", "x" * 300 + "jo (at) " + "h" * 200 + " (dot) org")]
    for t in ("1. 2. 3. 4. 5.", "pages 12, 13, 14, 15", "won 3-2 4-1 0-0 2-2"):
        assert found(t) == [], t


def test_pii_nulls_repeats_and_clashing_names(spark):
    rows = [(None, "a@b.cd", 1, "x"), (1, "a@b.cd", 2, "y"), (1, "a@b.cd", 2, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, base int, spans string")
    got = pii.pii_digest(pii.find_pii(df)).collect()
    assert sorted((str(r.doc_id), r.spans) for r in got) == [("1", "email:0:6"), ("1", "email:0:6"), ("None", "email:0:6")]
    assert pii.redact(df).columns == df.columns and pii.redact(df).where("text = '[EMAIL]'").count() == 3


def test_pii_edges(spark):
    df = docs(spark, [None, "", "é a@b.cd", "x" * 100_000 + " +1 (234) 555-7890"])
    got = {r.doc_id: r for r in pii.pii_digest(pii.find_pii(df)).collect()}
    assert got[0].spans == "" and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[2].spans == "email:2:8" and got[2].n_email == 1 and got[3].n_phone == 1
    assert [r.text for r in pii.redact(df).orderBy("doc_id").collect()][2] == "é [EMAIL]"
    assert pii.redact(df).columns == df.columns and pii.find_pii(df.limit(0)).count() == 0


# tokens

ALPHABET = [chr(c) for c in (*range(0, 0x250), 0x130, 0x3A3, 0x3C2, 0x2028, 0x2003, 0x3000, 0x200B, 0x301, 0x4E2D, 0x1F600, 0xFEFF)]


def texts(n, seed):
    r = random.Random(seed)
    for _ in range(n):
        t = "".join(r.choice(ALPHABET) if r.random() < 0.4 else r.choice("  aab'sS'T'Re 12\n\t!!") for _ in range(r.randrange(50)))
        yield t + r.choice(["", "", "<|endoftext|>aaaa", "<|startoftext|> x", "aaaaaaaaaaa" * 9])


def test_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tok, ts = Tokenizer.from_file(path), [*texts(800, 1), "", "a" * 50_000]
    want = [len(e.ids) for e in tok.encode_batch(ts, add_special_tokens=False)]
    assert token_counts.PieceCounter(path, {}).counts(ts) == want
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(ts[:200])] + [(999, None, 9)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in token_counts.token_counts(df, path, limit=5).collect()}
    assert all(got[i].n_tokens == want[i] and got[i].over_limit == (want[i] > 5) and got[i].n_bytes == len(ts[i].encode()) for i in range(200))
    assert got[999].n_tokens == got[999].n_bytes == 0
    assert token_counts.token_counts(df.limit(0), path).count() == 0


def test_encoding_equals_the_library_and_decodes_back(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    tok, ts = Tokenizer.from_file(path), [*texts(800, 2), "", "z" * 20_000, "ab" * 20_000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ts)] + [(9999, None, "x")], "doc_id long, text string, ids string")
    enc = bpe.bpe_encode(df, path)
    got = {r.doc_id: r for r in enc.collect()}
    for i, e in enumerate(tok.encode_batch(ts, add_special_tokens=False)):
        assert got[i].ids == e.ids and got[i].n_tokens == len(e.ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, e.ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(tok.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.bpe_decode(enc, path).collect()}
    assert all(back[i] == t for i, t in enumerate(ts)) and back[9999] == "" and got[9999].ids == []
    assert bpe.bpe_encode(df.limit(0), path).count() == 0


def test_counts_and_encoding_of_null_ids_and_repeated_rows(spark):
    rows = [(None, "Some text, 12 words"), (None, None), (4, "twice é"), (4, "twice é"), (4, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    counts = token_counts.token_counts(df, tokenizer_path("word_bpe_49k.json")).collect()
    encoded = bpe.bpe_encode(df, tokenizer_path("byte_bpe_50k.json"), with_ids=False).collect()
    for got in (counts, encoded):
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [(False, 4)] * 3 + [(True, 0)] * 2
        same = [tuple(r)[1:] for r in got if r.doc_id == 4]
        assert len(set(same)) == 2 and sum(r.n_tokens == 0 for r in got if r.doc_id is None) == 1


# decontamination


def test_contamination_equals_brute_force(spark):
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choices(vocab, k=r.choice([3, 5, 6, 12, 30, 70])))) for i in range(25)] + [(90, None), (91, "")]
    ds = []
    for i in range(120):
        t = r.choices(vocab, k=r.randrange(0, 200))
        if i % 3 == 0:
            own = items[r.randrange(25)][1].split()
            own = [w.upper() + "," if r.random() < 0.5 else w for w in own]
            if i % 2:
                own[len(own) // 2] = "changed"
            t[len(t) // 2 : len(t) // 2] = own
        ds.append((i, " ".join(t)))
    ds += [(200, None), (201, ""), (None, ds[0][1]), ds[3]]
    words = lambda t: re.findall(r"[a-z0-9]+", (t or "").lower())
    shingles = lambda t: {tuple(words(t)[k : k + 5]) for k in range(len(words(t)) - 4)} or ({tuple(words(t))} if words(t) else set())
    held = defaultdict(set)
    for d, t in ds:
        held[d] |= {tuple(words(t)[k : k + n]) for n in (3, 5) for k in range(len(words(t)) - n + 1)}
    want = {(d, i, len(shingles(t)), len(shingles(t) & held[d])) for d in held for i, t in items if shingles(t) and len(shingles(t) & held[d]) >= 0.8 * len(shingles(t)) - 1e-9}
    df, it = spark.createDataFrame([(d, t, "s") for d, t in ds], "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_contained) for r in decontamination.contamination(df, it).collect()}
    assert got == want and len(want) > 20
    left = decontamination.decontaminated(df, it)
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == {d for d in held} - {w[0] for w in want}
    assert decontamination.contamination(df.limit(0), it).count() == 0
    assert decontamination.contamination(df, it.limit(0)).count() == 0


def test_contamination_of_rows_with_shared_and_null_ids(spark):
    w = [f"w{i}" for i in range(44)]
    item, half, rest, clean = " ".join(w), " ".join(w[:24]), " ".join(w[20:]), "other words that are in no item of any benchmark"
    rows = [(None, item, "leak"), (None, clean, "a"), (None, None, "b"), (None, half, "c"), (None, rest, "d"), (7, half, "e"), (7, rest, "f"), (8, item, "leak"), (8, clean, "g"), (8, item + " more words", "leak")]
    df, it = spark.createDataFrame(rows, "doc_id long, text string, _leaked_id string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontamination.decontaminated(df, it)
    assert got.columns == df.columns and sorted(r[2] for r in got.collect()) == list("abcdefg")
    pairs = [tuple(r) for r in decontamination.contamination(df, it).collect()]
    assert sorted(pairs, key=str) == [(8, 1, 40, 40, 1.0), (None, 1, 40, 40, 1.0)]


def test_items_of_fewer_words_than_a_shingle(spark):
    df = spark.createDataFrame([(1, "we saw the red fox run"), (2, "the red dog, a fox"), (3, "The RED, fox"), (4, "fox"), (5, None)], "doc_id long, text string")
    it = spark.createDataFrame([(1, "The red fox!"), (2, "red fox run away quickly now"), (3, " .. "), (4, "dog")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontamination.contamination(df, it).collect()) == [(1, 1), (2, 4), (3, 1)]
    long = spark.createDataFrame([(1, "x y z " * 40_000 + "the red fox")], "doc_id long, text string")
    assert decontamination.contamination(long, it).count() == 1


# quality


def test_forest_learns_and_is_traversed_alike(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    f = quality.boost(x[:1000], y[:1000], trees=60)
    p = f.predict(x[1000:])
    assert ((p > 0.5) == y[1000:]).mean() > 0.9 and p.min() >= 0 and p.max() <= 1

    def one(row):
        total = f.bias
        for root in f.roots:
            at = root
            while f.feature[at] >= 0:
                at = f.left[at] if row[f.feature[at]] <= f.limit[at] else f.right[at]
            total += f.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([one(r) for r in x[:50]], f.predict(x[:50]))
    assert np.allclose(quality.boost(x[:0], y[:0]).predict(x[:3]), 0.5)


def test_the_first_split_is_the_best_of_all(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 12, size=(300, 5)).astype(float)
    y = ((x[:, 2] > 6) ^ (rng.random(300) < 0.15)).astype(float)
    forest = quality.boost(x, y, trees=1, depth=1, least=10)
    p = y.mean()
    g, h = y - p, np.full(300, p * (1 - p))
    gain = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
    best = max((gain(x[:, f] <= c) + gain(x[:, f] > c), f, c) for f in range(5) for c in np.unique(x[:, f]) if min((x[:, f] <= c).sum(), (x[:, f] > c).sum()) >= 10)
    root = forest.roots[0]
    assert (forest.feature[root], forest.limit[root]) == best[1:]
    for side, rows in ((forest.left[root], x[:, best[1]] <= best[2]), (forest.right[root], x[:, best[1]] > best[2])):
        assert forest.value[side] == pytest.approx(0.1 * g[rows].sum() / (h[rows].sum() + 1))


def test_quality_edges_and_accuracy(spark):
    r = random.Random(5)
    words = ["the", "and", "river", "stone", "of", "walks", "slowly", "under", "trees", "we"]
    good = [" ".join(r.choices(words, k=60)).capitalize() + "." for _ in range(300)]
    bad = [" ".join(w.upper() + "!!" for w in r.choices(words, k=60)) for _ in range(300)]
    ts = [t for pair in zip(good, bad) for t in pair]
    df = docs(spark, [*ts, None, "", "x" * 200_000])
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(600)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(df, labels)
    got = {x.doc_id: x for x in quality.score_quality(df, model).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(600))
    assert sum((got[i].score >= 0.7) == (i % 2 == 0) for i in range(600) if got[i].held_out) / sum(got[i].held_out for i in range(600)) > 0.95
    assert all(0 <= got[i].score <= 1 for i in got) and len(got) == 603
    assert quality.keep_quality(df, model).columns == df.columns
    none = quality.fit_quality(df, labels.limit(0))
    assert quality.score_quality(df, none).first().score == 0.5 and quality.score_quality(df.limit(0), model).count() == 0


def test_quality_of_repeated_ids_and_clashing_names(spark):
    r = random.Random(1)
    ts = [("plain words in a calm line " * r.randrange(2, 9)) if k % 2 else ("BUY NOW!!! " * r.randrange(2, 30)) for k in range(400)]
    df = spark.createDataFrame([(k // 2 * 2 + k % 2, t, 0.5, True) for k, t in enumerate(ts)] + [(1, ts[0], 0.5, True), (None, ts[0], 0.5, True)], "doc_id long, text string, score double, held_out boolean")
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(400)] + [(1, 0, 0), (1, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    few = quality.fit_quality(df, labels, max_rows=60)
    got = quality.score_quality(df, few).collect()
    assert len(got) == 402 and sum(x.doc_id == 1 for x in got) == 2
    assert sum((x.score >= 0.7) == (x.doc_id % 2 == 1) for x in got if x.doc_id not in (None, 1)) >= 390
    assert quality.keep_quality(df, few).columns == df.columns
    other = df.select(df.doc_id.alias("key"), df.text.alias("body"))
    same = quality.fit_quality(other, labels.withColumnRenamed("doc_id", "key"), max_rows=60, id_col="key", text_col="body")
    assert np.array_equal(same.value, few.value) and quality.score_quality(other, same, "key", "body").count() == 402


# sharding


def test_shards_are_equal_in_bytes(spark):
    r = random.Random(7)
    ts = ["hot text " * 40] * 300 + ["w" * r.randrange(0, 4000) for _ in range(600)] + [None, "", "é" * 10]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ts)] + [(0, ts[0], 1)], "doc_id long, text string, shard long")
    got = sharding.shard_by_bytes(df, range_rows=30).collect()
    assert len(got) == len(ts) + 1
    by = defaultdict(list)
    for x in got:
        by[x.shard].append(x)
        t = ts[x.doc_id] or ""
        assert x.size == len(t.encode()) + 1 and x.text_crc32 == zlib.crc32(t.encode()) and x.law == "bytes" and x.grown_shard is None
    most = max(x.size for x in got)
    sums = [sum(x.size for x in v) for v in by.values()]
    assert len(by) == 8 and max(sums) - min(sums) <= 2 * most
    assert all(sorted(x.slot for x in v) == list(range(len(v))) for v in by.values())
    split = Counter(x.shard for x in got if x.doc_id < 300)
    assert len(split) <= 4  # equal texts stay together but where a shard is full
    assert sharding.shard_by_bytes(df.limit(0)).count() == 0


@pytest.mark.parametrize("range_rows", [7, 10_000])
def test_shards_equal_a_plain_prefix_sum(spark, range_rows):
    from pyspark.sql import functions as F

    r = random.Random(11)
    ts = ["same " * 30] * 400 + ["w" * r.randrange(0, 900) for _ in range(500)] + ["x" * 60_000, None, ""]
    ids = [r.choice((None, 5, k, k)) for k in range(len(ts))]
    df = spark.createDataFrame([(i, t, 3, "z") for i, t in zip(ids, ts)], "doc_id long, text string, slot int, law string")
    rows = df.select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("size"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc")).collect()
    rows = sorted(((x.h, x.doc_id is not None, x.doc_id or 0, x.size, x.crc) for x in rows))
    total, upto, want, slots = sum(x[3] for x in rows), 0, Counter(), Counter()
    for _, known, i, size, crc in rows:
        upto += size
        shard = min(7, int((upto - size / 2) * 8 // total))
        want[i if known else None, size, crc, shard, slots[shard]] += 1
        slots[shard] += 1
    got = Counter((x.doc_id, x.size, x.text_crc32, x.shard, x.slot) for x in sharding.shard_by_bytes(df, range_rows=range_rows).collect())
    assert got == want


# archives


def test_archives_round_trip(spark):
    rows = [(5, "http://a/\r\nx", "<p>same</p>"), (2, None, "<p>same</p>"), (9, "u", None), (7, "u", ""), (3, "u", "é" * 50_000), (None, "n", "<p>same</p>"), (None, "m", "alone")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string").repartition(3)
    made = warc.write_archives(df, archive_bytes=100)
    index = made.read_index(spark)
    got = {(r.page_id, r.url): r for r in warc.read_records(index).collect()}
    assert len(got) == len(rows)
    b32 = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    for page, url, html in rows:
        r = got[page, url and url.replace("\r", "%0D").replace("\n", "%0A")]
        assert r.payload_bytes == len((html or "").encode()) and r.payload_digest == b32(html)
        first = {"<p>same</p>": 2, "": 7}.get(html or "", page)
        assert (r.record_type, r.refers_to) == (("response", None) if page == first else ("revisit", first))
        assert bytes(r.payload) == ((html or "").encode() if r.record_type == "response" else b"")
    some = warc.read_records(index.where("page_id IN (3, 7)"), gap=0, most=64)
    assert sorted(r.page_id for r in some.collect()) == [3, 7]
    assert warc.write_archives(df.limit(0)).read_index(spark).count() == 0


def test_repeated_rows_get_a_record_each(spark):
    df = spark.createDataFrame([(4, "u", "a")] * 3 + [(4, "u", "b"), (6, "u", "a"), (None, "u", "a"), (None, "u", "")], "page_id long, url string, html string").repartition(2)
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.read_records(warc.write_archives(df).read_index(spark), with_payload=False).collect())
    assert got == {(4, "response", None): 4, (6, "revisit", 4): 1, (None, "revisit", 4): 1, (None, "response", None): 1}


def test_ranges_join_neighbours_only():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("b", 0, 3), ("b", 100, 50)]
    assert [(p, s, e, len(x)) for p, s, e, x in warc._ranges(iter(rows), gap=10, most=100)] == [("a", 0, 15, 2), ("a", 40, 45, 1), ("b", 0, 3, 1), ("b", 100, 150, 1)]


def test_rows_of_one_text_and_id_are_cut_too(spark):
    from locuspark.llm.sharding import keys_below, weighted_splitters, with_range

    rng = np.random.default_rng(4)
    splitters = sorted({tuple(rng.integers(0, 4, 3).tolist()) for _ in range(20)})
    keys = rng.integers(0, 4, (300, 3))
    got = keys_below([np.array(c) for c in zip(*splitters, strict=True)], list(keys.T))
    assert got.tolist() == [sum(s <= tuple(k) for s in splitters) for k in keys.tolist()]
    hot = spark.range(6000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "1L AS size", "7L AS h", "id AS row")
    ranges = with_range(hot, weighted_splitters(hot, 16)).groupBy("rng").count().collect()
    assert len(ranges) == 16 and max(r["count"] for r in ranges) < 3 * 6000 / 16
    df = spark.createDataFrame([(None, "")] * 900 + [(i, f"text {i}") for i in range(300)], "doc_id long, text string")
    rows = sharding.shard_by_bytes(df).collect()
    assert len(rows) == 1200
    for k in range(8):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
    sizes = [sum(r["size"] for r in rows if r.shard == k) for k in range(8)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)

"""Page extraction on written pages; chat formatting against a plain
rendering and back."""

import hashlib
import random

import numpy as np
import pytest

from valora.llm import chat, extract, tokens
from valora.llm.extract import IN, LOOSE, OUT, blocks, main_text
from valora.llm.session import table


@pytest.mark.parametrize(("page", "expected"), [
    ("<p>a &amp; <b>b</b>c<br>d\n e</p><p>f", [(LOOSE, "a & bc d e"), (LOOSE, "f")]),
    ("<nav>menu<article><h1>T</h1><p>x<p>y</article><footer>z</footer>",
     [(OUT, "menu"), (IN, "T"), (IN, "x"), (IN, "y"), (OUT, "z")]),
    ('<article><header><h2>S</h2><p>by me</p></header>t<div class="post comments">c<article>d</article></div>e</article>',
     [(IN, "S"), (OUT, "by me"), (IN, "t"), (OUT, "c"), (OUT, "d"), (IN, "e")]),
    ('<script>var t="</p><article>";</script><div hidden>h</div><div role=main>m<form>q</form></div>',
     [(OUT, "h"), (IN, "m"), (OUT, "q")]),
    ("1 < 2 &lt;b&gt; &#233;&nbsp;x<!-- <p>no --> end", [(LOOSE, "1 < 2 <b> é x end")]),
    ('<div class="ad">buy</div><table><tr><td>k<td>v</table>', [(OUT, "buy"), (LOOSE, "k"), (LOOSE, "v")]),
    ("", []),
    ('<article class="post has-sidebar">x</article><main id="share-enabled">y</main>', [(IN, "x"), (IN, "y")]),
    ('<div class="no-sidebar"><p>x</p></div><div class="main-nav">n</div>', [(LOOSE, "x"), (OUT, "n")]),
    ('<div class="header-fixed"><div class="notice" role="main">x</div>z</div>', [(IN, "x"), (OUT, "z")]),
    ('<article><div class="entry-header"><h1>T</h1></div><p class="notice">n</p><p class="related-law">l</p>'
     '<div class="ad">buy</div></article>', [(IN, "T"), (IN, "n"), (IN, "l"), (OUT, "buy")]),
    ('<article><div class="header"><h1>T</h1></div><div class="widget">most of it all</div><div class="share">s</div></article>',
     [(IN, "T"), (IN, "most of it all"), (OUT, "s")]),
    ('<article>short<div id="comments"><h3>Comments</h3><article class="comment">long comment</article></div></article>',
     [(IN, "short"), (OUT, "Comments"), (OUT, "long comment")]),
    ('<article><div hidden><div class="ad"><h1>T</h1>long hidden text</div></div>x</article>',
     [(OUT, "T"), (OUT, "long hidden text"), (IN, "x")]),
    ('<div id="comments"><article class="comment">c</article></div>', [(OUT, "c")]),
])
def test_blocks(page, expected):
    assert blocks(page) == expected


def test_host_decides_where_no_article_is_marked(spark):
    menu = "home news sport weather travel money help"
    own = {k: " ".join(f"w{k}x{j}" for j in range(9)) for k in range(4)}
    rows = [(k, f"https://A.org/{k}?x", f"<div>{menu}</div><p>{own[k]}</p>", "x") for k in range(4)]
    rows += [(10, "http://b.org/", f"<div>{menu}</div><p>b</p>", "x"), (11, None, None, "x"), (12, "bad", "", None),
             (13, "http://a.org/z", f"<article>{menu}</article><p>out</p>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    out = main_text(df)
    assert out.columns == [*df.columns, "text"]
    got = {r.page_id: r.text for r in out.collect()}
    assert got == {**own, 10: f"{menu}\n\nb", 11: "", 12: "", 13: menu}
    assert main_text(df.limit(0)).count() == 0


def test_phrases_of_few_pages_stay(spark):
    """Unmarked pages: a quotation within or as a block of two of eight pages
    stays, as does a page given under three ids; a menu of all pages and a
    block of half of them go."""
    menu, section = "home news sport weather travel money", "more from our own section here"
    quote, block = "to be or not to be that", "all the world is but a stage"
    own = {k: [f"w{k}x{j}" for j in range(9)] for k in range(8)}
    rows, expected = [], {}
    for k, words in own.items():
        said = [" ".join(words[:4] + ([quote] if k < 2 else []) + words[4:])] + ([block] if k in (2, 3) else [])
        rows.append((k, "http://a.org/", f"<div>{menu} {k}</div>" + (f"<div>{section}</div>" if k % 2 else "")
                     + "".join(f"<p>{x}</p>" for x in said)))
        expected[k] = "\n\n".join([str(k), *said])
    alone = "the only text of this host given under three ids"
    rows += [(20 + k, "http://b.org/", f"<script>{k}</script><p>{alone}</p>") for k in range(3)]
    expected |= {20 + k: alone for k in range(3)}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in main_text(df).collect()} == expected


def _shared(x, y):
    return next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))


def test_suffix_order_against_sorting():
    rng = random.Random(3)
    for letters in (1, 2, 3, 9) * 25:
        rows = [[rng.randrange(letters) for _ in range(rng.randrange(40))] for _ in range(rng.randrange(1, 6))]
        bounds = np.cumsum([0, *map(len, rows)])
        order, shared = extract.suffix_order(np.array([t for row in rows for t in row], np.int64), bounds)
        suffixes = [row[i:] for row in rows for i in range(len(row))]
        inorder = [suffixes[i] for i in order]
        assert sorted(order) == list(range(len(suffixes))) and inorder == sorted(suffixes)
        assert list(shared) == [0, *map(_shared, inorder, inorder[1:])][:len(suffixes)]


@pytest.mark.parametrize("piece", [20, 1 << 18])
def test_repeats_of_every_page_against_brute_force(spark, monkeypatch, piece):
    """Pages with and without an article, hosts of one or several pieces and
    parts: the tokens that a host's repeats cover, and what that leaves."""
    monkeypatch.setattr(extract, "PIECE", piece)
    monkeypatch.setattr(extract, "PAGES", 4 if piece == 20 else 1 << 16)
    rng = random.Random(5)
    phrases = [[f"f{k}t{j}" for j in range(rng.randrange(3, 12))] for k in range(6)]
    rows, streams = [], {}
    for page in range(60):
        host, marked = f"h{min(page % 5, 2)}", page % 2 == 0
        said = [rng.choice([*phrases[:2 + page % 5], [f"w{page}x{j}" for j in range(rng.randrange(1, 9))]]) for _ in range(rng.randrange(6))]
        if page % 7 == 0 and page > 6:
            said = streams[page - 14 if page > 13 else page - 1][2]
        streams[page] = host, marked, said
        parts = "".join(f"<{'nav' if marked and k % 2 else 'div'}>{' '.join(b)}</{'nav' if marked and k % 2 else 'div'}>" for k, b in enumerate(said))
        rows.append((page, f"http://{host}/{page}", f"<body>{parts}{'<article>text</article>' if marked else ''}</body>", "x"))
    known = {}
    for host, marked, said in streams.values():
        known.setdefault((host, marked), set()).add(tuple(t for b in said for t in b))
    runs = {}
    for key, texts in known.items():
        texts.discard(())
        for text in texts:
            for run in {text[i:i + 6] for i in range(len(text) - 5)}:
                runs[key, run] = runs.get((key, run), 0) + 1
    expected, some_left = {}, False
    for page, (host, marked, said) in streams.items():
        text = [t for b in said for t in b]
        total, covered, wide = len(known[host, marked]), set(), set()
        for i in range(len(text) - 5):
            n = runs[(host, marked), tuple(text[i:i + 6])]
            if n >= 3 and 4 * n >= total:
                covered |= set(range(i, i + 6))
            if n >= 3 and 3 * n >= 2 * total:
                wide |= set(range(i, i + 6))
        left, at = [], 0
        for b in said:
            places = range(at, at + len(b))
            at += len(b)
            if not covered.issuperset(places):
                left.append(" ".join(t for k, t in zip(places, b) if k not in wide))
        expected[page] = "text" if marked else "\n\n".join(b for b in left if b), len(covered)
        some_left |= marked and len(covered) > 0
    assert some_left
    df = spark.createDataFrame(rows, "page_id long, url string, html string, __main string")
    out = main_text(df, repeated="again")
    assert out.columns == [*df.columns, "text", "again"]
    assert {r.page_id: (r.text, r.again) for r in out.collect()} == expected


HARD = ["\\### Assistant: </turn> ok", "", None, "### a: b</turn>\n### user: x", "\\\\", "\\", "é 漢 🙂 <|endoftext|>", "plain"]


def _plain(rows):
    said = [(r or "", t or "") for r, t in rows]
    every = "".join(f"{r}\n{t}\n" for r, t in said)
    learned = "".join(t for r, t in said if r == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(said), sha(every), len(learned), sha(learned)


@pytest.mark.parametrize("chunk", [8, 1 << 16])
def test_chats_read_back(spark, chunk):
    rows = [(c, k, ["user", "assistant", None, "a: ###b"][(c + k) % 4], t, "x") for c in range(5) for k, t in enumerate(HARD)]
    rows += [(None, 0, "assistant", "no conversation", "x"), (77, None, "assistant", "first", "x"), (77, 0, "user", "", "x"),
             (78, 1, "assistant", "twice", "x"), (78, 1, "assistant", "twice", "x"), (79, 0, "assistant", "word " * 20000, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.format_chats(df, chunk=chunk)).collect()}
    by = {}
    for c, k, r, t, _ in sorted(rows, key=lambda x: (x[0] or -1, -1 if x[1] is None else x[1], x[2] or "", x[3] or "")):
        by.setdefault(c, []).append((r, t))
    assert got == {c: _plain(v) for c, v in by.items()}
    assert chat.digests(chat.format_chats(df.limit(0))).count() == 0


@pytest.mark.parametrize("text", [t for t in HARD if t is not None])
def test_escape(text):
    for role in (False, True):
        written = chat.escape(text, role)
        assert chat.unescape(written) == text
        rest = chat._ESCAPED.sub("", written)
        assert "###" not in rest and "</turn>" not in rest


def test_all_pages_of_a_table(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    out = main_text(pages)
    assert out.count() == pages.count() and out.filter("text = ''").count() == 0


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 1_500_000, "\t " * 700_000, "é" * 400_000])
def test_a_long_run_is_read_back(spark, text):
    df = spark.createDataFrame([(1, 0, "user", "go on"), (1, 1, "assistant", text)],
                               "conv_id long, turn long, role string, text string")
    row = chat.digests(chat.format_chats(df)).first()
    assert row.loss_chars == len(text) and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_pieces_have_the_ids_of_the_whole():
    code, r = tokens.encoder(tokens.vocabulary()), random.Random(8)
    parts = ["word", "é", "12", " ", "  ", "\n", "\r\n", "\t", ", ", "it's", " x", "_", "漢", "🙂"]
    text = "".join(r.choice(parts) for _ in range(60_000))
    assert len(text) > 3 * tokens.PIECE_CHARS and tokens.encode(code, text) == code.encode_ordinary(text)
    assert "".join(tokens.pieces(text)) == text and max(map(len, tokens.pieces(text))) <= tokens.PIECE_CHARS

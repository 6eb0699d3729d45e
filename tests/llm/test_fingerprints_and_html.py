import hashlib
import html
import random
import re

import pytest
from pyspark.sql import functions as F

from layerhouse.llm import html_text, minhash
from layerhouse.llm.queries import QUERIES
from tests.llm.conftest import SF
from tests.llm.test_tokens import tie


# --- fingerprints ---

def shingles(text: str) -> set:
    words = text.encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def jaccard(a: str, b: str) -> float:
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edits(rows: list) -> list:
    """(doc_id, text, edited, next) of every row by the plain rule."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), tie(r[1])))
    texts = [t or "" for _, t in order]
    out = []
    for i, text in enumerate(texts):
        following, cut = texts[(i + 1) % len(texts)], len(text) // 3
        out.append((order[i][0], text, text[:len(text) - cut] + following[:cut], following))
    return out


def check(rows: list, found: list) -> list:
    expected = sorted(((d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e, _ in edits(rows)), key=str)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=str) == expected
    return expected


@pytest.mark.parametrize("partitions", [1, 3, 50])
def test_fingerprints_of_odd_rows(spark, odd_documents, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = minhash.edited_likeness(odd_documents).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    check([tuple(r) for r in odd_documents.select("doc_id", "text").collect()], found)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    blank = [r for r in found if r.doc_id in (2, 3, 4)]
    assert {bytes(r.fingerprint) for r in blank} == {b""}


def test_fingerprint_query(spark, documents):
    found = QUERIES["op5_fingerprints"](spark, SF).collect()
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    check(rows, found)
    by_id = {r.doc_id: r for r in found}
    errors = []
    for doc_id, text, edited, following in edits(rows):
        r = by_id[doc_id]
        assert r.fingerprint == minhash.fingerprint(text.encode()).hex()
        assert r.edited_fingerprint == minhash.fingerprint(edited.encode()).hex()
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, following)]
    assert abs(sum(errors) / len(errors)) < 0.01 and max(map(abs, errors)) < 0.17


def test_fingerprints_of_one_and_no_rows(odd_documents, no_documents):
    one = minhash.edited_likeness(odd_documents.filter("doc_id = -10")).collect()
    check([(-10, "below zero")], one)
    assert one[0].near_next == 1.0
    assert minhash.edited_likeness(no_documents).count() == 0


def test_likeness_is_unbiased_and_equal_texts_are_equal():
    draw = random.Random(3)
    for share in (0.0, 0.3, 0.8, 0.95):
        errors = []
        for _ in range(60):
            words = [str(draw.random()) for _ in range(draw.choice((8, 60, 400)))]
            other = words[:int(len(words) * share)] + [str(draw.random()) for _ in range(len(words) - int(len(words) * share))]
            a, b = " ".join(words), " ".join(other)
            errors.append(minhash.likeness(minhash.fingerprint(a.encode()), minhash.fingerprint(b.encode())) - jaccard(a, b))
        assert abs(sum(errors) / 60) < 0.03
    assert minhash.fingerprint(b"A b  C") == minhash.fingerprint(b"a b c ") != minhash.fingerprint(b"a b")


def test_short_unequal_texts_have_unequal_fingerprints():
    prints = [minhash.fingerprint(f"short text {i}".encode()) for i in range(2000)]
    assert len(set(prints)) == 2000
    near = [minhash.likeness(a, b) for a, b in zip(prints, prints[1:])]
    assert max(near) < 0.05 and sum(near) / len(near) < 0.01


def test_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{i}" for i in range(4000)).encode()
    whole = minhash.fingerprint(text)
    monkeypatch.setattr(minhash, "PIECE_CHARS", 500)
    assert minhash.fingerprint(text) == whole


# --- main text of pages ---

def plain(page: str) -> str:
    """What the generated pages hold between their article tags, by regular expressions."""
    body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    blocks = re.split(r"</?(?:p|h1|article)>", body.group(1).replace("<br>", " ") if body else "")
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in blocks)
    return "\n".join(x for x in blocks if x)


def test_html_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = QUERIES["op10_html_text"](spark, SF)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain(pages[r.page_id].html), len(r.text))


def test_lcs_against_dynamic_programming():
    draw = random.Random(6)
    for _ in range(400):
        a, b = ([draw.choice("abcdefg"[:draw.randint(1, 7)]) for _ in range(draw.randint(0, 14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        kept = [a[i] for i in sorted(html_text.shared(a, b))]
        assert len(kept) == table[-1][-1]
        rest = iter(b)
        assert all(x in rest for x in kept)  # a subsequence of b


def test_lines_of_markup():
    page = """<!DOCTYPE html><HTML><head><title>T</title><style>p{}</style></head><body class="menu-open"><header>Site</header>
    <nav>Home</nav><div id="cookie-notice">We use</div><script>var a = "<p>no</p>";</script>
    <article><header><h1>Big &amp; <b>bold</b></h1></header><p>One<br>two   three<p class=lead>Four&nbsp;five &lt;six&gt; 1 < 2
    <aside>Side</aside><div class="ad">Buy</div><form><p>Mail</form><p>Seven<script>x</script> eight</p>
    <section class="comments"><p>First!</p></section><ul><li>a<li>b</ul><!-- <p>gone</p> --></article>
    <div class="related">More</div><footer>End</footer>"""
    found = html_text.lines(page)
    assert [t for k, t in found if k == "A"] == ["Big & bold", "One two three", "Four five <six> 1 < 2", "Seven eight", "a", "b"]
    assert {t for k, t in found if k == "X"} >= {"Site", "Home", "We use", "Side", "Buy", "Mail", "First!", "More", "End"}
    for broken in ("", "<", "<p", "</p></div>", "<p>a</b></i>", "&am", "<!-- open", "<script>open", "<a href='x", "text only", "<article>" * 500):
        html_text.lines(broken)
    assert html_text.lines("text &copy; only") == [("O", "text © only")]


def frame(spark, rows: list):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({
        "text": F.lit("clash"), "host": F.lit(1), "lines": F.lit(2), "n_chars": F.lit(0)})


def expected(rows: list) -> list:
    """Every page against the nearest of its host in sorted order, without partitions."""
    host = lambda u: m.group(1).lower() if u and (m := re.match(r"(?s).*?://([^/?#]*)", u)) else ""
    path = lambda u: m.group(1) if u and (m := re.match(r"(?s).*?://[^/?#]*([^?#]*)", u)) else ""
    made = sorted(((host(u), path(u), i is not None, i or 0, u is not None, u or "", html_text.lines(h or "")) for i, u, h in rows),
                  key=lambda r: (*r[:6], html_text._packed(r[6])))
    out = []
    for k, row in enumerate(made):
        sides = [made[j] if 0 <= j < len(made) and made[j][0] == row[0] else None for j in (k - 1, k + 1)]
        near = html_text.nearest(row[1], *(None if s is None else (s[1], s) for s in sides))
        text = html_text.main_text(row[6], near[1][6] if near else None)
        out.append((row[3] if row[2] else None, row[5] if row[4] else None, text, len(text)))
    return sorted(out, key=str)


def open_page(i: int) -> str:
    return f"<div>Shop name</div><p>Welcome {i}</p><div>All offers</div><p>Text {i} of the page</p><p>Same words</p>"


PAGES = [
    *((i, f"http://H.example.com/a/{i % 7}/{i}?x={i}", open_page(i)) for i in range(40)),
    *((100 + i, f"http://one{i}.org/", f"<p>alone {i}</p><nav>menu</nav>") for i in range(5)),
    (200, "http://copy.net/1", "<article><p>twin</p></article><p>out</p>"), (201, "http://copy.net/2", "<article><p>twin</p></article><p>out</p>"),
    (300, None, "<p>no url</p>"), (301, None, None), (None, "http://x.org/", ""), (None, None, "<p>no url</p>"),
    (5, "http://H.example.com/a/5/5?x=5", open_page(5)), (302, "broken", "<p>broken</p>")]


@pytest.mark.parametrize("partitions", [1, 4, 60])
def test_differencing_does_not_depend_on_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sorted(map(tuple, html_text.extract(frame(spark, PAGES)).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == expected(PAGES)
    texts = {r[0]: r[2] for r in found}
    assert texts[3] == "Welcome 3\nText 3 of the page"  # what the neighbour shares is gone
    assert texts[100] == "alone 0" and texts[200] == texts[201] == "twin"


def test_no_pages(spark):
    assert html_text.extract(frame(spark, PAGES).limit(0)).count() == 0


def test_differencing_decides_beside_articles():
    page = "<h2>Headline {0}</h2><div>Shop</div><article><p>Body {0}</p><p>More</p></article><p>Coda {0}</p>"
    one, two = (html_text.lines(page.format(i)) for i in (1, 2))
    assert html_text.main_text(one, two) == "Headline 1\nBody 1\nMore\nCoda 1"
    assert html_text.main_text(one, one) == html_text.main_text(one, None) == "Body 1\nMore"


@pytest.mark.parametrize("partitions", [1, 60])
def test_repeated_and_copied_pages_have_the_text_of_the_single_row(spark, partitions):
    single = [(i, f"http://h.org/p?id={i}", open_page(i)) for i in range(10, 20)]
    copies = [*single, *single, *((30 + i, "http://h.org/p?id=15&copy=%d" % i, open_page(15)) for i in range(40))]
    lone = [(100, None, "<p>no url</p>"), (101, None, "<p>no url</p>"), (102, "broken", "<p>no url</p>"), (103, "http://x.org/1", "<p>x</p>")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = html_text.extract(frame(spark, [*copies, *lone])).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == len(copies) + len(lone)
    for r in found:
        i = 15 if 30 <= r.page_id < 70 else r.page_id
        assert r.text == (f"Welcome {i}\nText {i} of the page" if i < 100 else "x" if i == 103 else "no url")


@pytest.mark.parametrize("wrapper", [
    "<div class='content-sidebar-wrap'>", "<div class='has-sidebar'>", "<div class='layout no-sidebar'>", "<form action='/' id='aspnetForm'>",
    "<div id='search'>", "<div class='widget menu'>"])
def test_wrappers_do_not_hide_articles(wrapper):
    end = "</form>" if "form" in wrapper else "</div>"
    assert html_text.lines(f"{wrapper}<main><p>Text<div class=ad>Buy</div></main>{end}") == [("A", "Text"), ("X", "Buy")]
    if "has-" in wrapper or "no-" in wrapper or "form" in wrapper:
        assert html_text.lines(f"{wrapper}<p>Text</p>{end}") == [("O", "Text")]


def test_doubtful_blocks_stay_for_the_differencing():
    page = "<article><h1>Title</h1><section id='{}'><p>Part</p></section></article><div class='related'><article>Card</article></div>"
    for name in ("discussion", "social-policy", "search-engine"):
        assert html_text.lines(page.format(name)) == [("A", "Title"), ("A", "Part"), ("X", "Card")]
    assert html_text.lines("<main><form><p>All</form></main>") == [("A", "All")]
    assert html_text.lines("<div class='site-footer'>End</div><p>x</p>") == [("X", "End"), ("O", "x")]


def test_words_in_values_and_other_names_are_no_attributes():
    """Titles, alternative texts and data attributes may hold any word."""
    for tag in ("<p title=\"The hidden valley\">", "<section data-hidden=\"false\">", "<div data-id=\"comments\">", "<p data-style=\"display:none\">",
                "<p title='class=ad id=footer'>", "<p alt = \"role=navigation\" lang=en>", "<p data-class=ad x-hidden>", "<p title=hidden>",
                "<p hidden-at=\"1\">", "<p title=\"a > b\" data-role=\"banner\">"):
        close = f"</{tag[1:].split()[0]}>"
        assert html_text.lines(f"<article><h1>Head</h1>{tag}Body text{close}</article>") == [("A", "Head"), ("A", "Body text")], tag
    for wrapper in ("<div title=\"hidden gems\">", "<div data-hidden=\"false\">", "<div data-aria-hidden=true>"):
        assert html_text.lines(f"{wrapper}<main><article><p>Text</p></article></main></div>") == [("A", "Text")], wrapper
    for tag in ("<p hidden>", "<p data-x=1 hidden=\"\">", "<p class=ad>", "<p style=\"color:red; display: none\">", "<p aria-hidden='true'>", "<p/hidden>", "<p id=\"footer\" >"):
        assert html_text.lines(f"<article><p>Text</p>{tag}Gone</p></article>") == [("A", "Text"), ("X", "Gone")], tag
